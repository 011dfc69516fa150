"""Fill-in-middle, ranked search and piece encoding against brute force and the public library, with odd rows."""

import base64
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2

from conftest import SF
from tidemark.llm import fill_in_middle, golay_simhash, license_scan, packing, piece_bpe, queries, ranked_search, zip_warc
from tidemark.llm.common import read
from tidemark.session import scratch

DOCS = "doc_id long, text string, id long, terms string, n int, output string"
LONG = "wörd one\n" * 40_000
ODD = [
    (1, None, 1, "a", 1, None),
    (2, "", 2, "a", 1, ""),
    (3, "\n", 2, "a", 1, ""),
    (4, "no line end", 9, "a", 1, ""),
    (5, "a\n\nb\r\nc", 9, "a", 1, ""),
    (5, "a\n\nb\r\nc", 9, "a", 1, ""),
    (None, "É ▁ 😀\n日本\n", None, "a", 1, ""),
    (8, "holds <S>\nand more\n", None, "a", 1, ""),
    (9, LONG, None, "a", 1, ""),
    (10, "<<P\n>S><\nM>\n<", None, "a", 1, ""),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


def texts(spark):
    return [(r.doc_id, r.text) for r in read(spark, SF, "documents").select("doc_id", "text").collect()]


# fill in the middle --------------------------------------------------------------------------------------


def brute_fim(doc_id, text, rate=100):
    text, key = text or "", "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"7:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_op11_odd_rows(spark, odd):
    for rate in (100, 40):
        got = fill_in_middle.transform(odd, rate=rate)
        text = fill_in_middle.restored(got.form, got.output)
        rows = sorted(map(tuple, got.select("id", "n", "form", "prefix_chars", "middle_chars", "output").collect()), key=repr)
        assert rows == sorted(((r[0], *brute_fim(r[0], r[1], rate)) for r in ODD), key=repr)
        back = sorted((r.id or -1, r.t) for r in got.select("id", text.alias("t")).collect())
        assert back == sorted((r[0] or -1, r[1] or "") for r in ODD)
    assert fill_in_middle.transform(odd.limit(0)).count() == 0


def test_op11_query_equals_brute_force(spark):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for doc_id, text in texts(spark):
        *head, output = brute_fim(doc_id, text)
        want.append((doc_id, *head, sha(output), sha(text or "")))
    assert sorted(map(tuple, queries.op11_fill_in_middle(spark, SF).collect())) == sorted(want)


def test_op11_slices(spark, odd, monkeypatch):
    whole = sorted(map(tuple, fill_in_middle.transform(odd).collect()), key=repr)
    monkeypatch.setattr(fill_in_middle, "SLICE_BYTES", 8)
    monkeypatch.setattr(fill_in_middle, "OUT_BYTES", 1)
    assert sorted(map(tuple, fill_in_middle.transform(odd).collect()), key=repr) == whole


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=200))
def test_op11_marks(data):
    words = fill_in_middle.as_words(np.frombuffer(data, np.uint8))
    for marks, want in (
        (fill_in_middle.equal_bytes(words, 10), [b == 10 for b in data]),
        (fill_in_middle.continuations(words), [b & 0xC0 == 0x80 for b in data]),
    ):
        at = np.flatnonzero(want)
        assert marks.rank(np.arange(len(data) + 1)).tolist() == [sum(want[:i]) for i in range(len(data) + 1)]
        assert marks.select(np.arange(1, len(at) + 1)).tolist() == at.tolist()


# ranked search -------------------------------------------------------------------------------------------


def brute_search(docs, items, top):
    terms = lambda t: re.findall(
        r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(d, Counter(w), len(w)) for d, t in docs if (w := terms(t))]
    n_docs, total, df = len(held), sum(n for _, _, n in held), Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, counts, n in held:
            m = 50 + 50 * n * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 20 * m))
                for t in set(terms(text)) if t in counts)
            if score:
                found.append((-score, d is None, d))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=repr)


def random_docs(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "Größe", "B2", "x"] + [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(300)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(70)]  # ties beyond the top
    docs += [(None, docs[3][1]), (7, docs[7][1]), (n + 200, None), (n + 201, ""), (n + 202, "-- !"), (n + 203, "the " * 50_000)]
    items = [(i, " ".join(rng.choice(words) for _ in range(25)) + " THE") for i in range(12)]
    items += [(20, None), (21, ""), (22, "unheard-of"), (23, docs[3][1]), (0, "B2 b2 größe GRÖSSE"), (None, "x")]
    return docs, items


@pytest.mark.parametrize(("top", "block_docs", "item_bytes"), [(50, 1 << 16, 4 << 20), (5, 64, 4 << 20), (3, 100, 200)])
def test_op12_equals_brute_force(spark, monkeypatch, top, block_docs, item_bytes):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(ranked_search, "ITEM_BYTES", item_bytes)
    docs, items = random_docs(top, 700)
    frame = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, score long").repartition(3)
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = sorted(map(tuple, ranked_search.search(frame, asked, top).collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_search(docs, items, top)
    assert ranked_search.search(frame.limit(0), asked).count() == 0
    assert ranked_search.search(frame, asked.limit(0)).count() == 0


def test_op12_stops_creating_accumulators():
    """A rare term decides: the common one makes no accumulator, and survivors still get their exact sums."""
    import pyarrow as pa

    n, rng = 5000, np.random.default_rng(1)
    rare = np.sort(rng.choice(n, 60, replace=False))
    rows = [([0] if i in set(rare.tolist()) else []) + [1] for i in range(n)]
    known = ranked_search.Statistics(n, 2 * n, np.array([4000, 3], np.int64), np.array([60, n]))
    sizes = np.array([len(r) for r in rows])
    terms = np.concatenate([np.array(r) for r in rows])
    block = ranked_search.Block(pa.array(range(n)), np.full(n, 2), sizes, terms, np.ones(len(terms), np.int64), known)
    at, scores = block.best([0, 1], 50, 0)
    assert at.tolist() == rare.tolist() and len(set(scores.tolist())) == 1
    assert not block.scores.any()


# pieces --------------------------------------------------------------------------------------------------

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = list(" ▁\n\tab.,<s>0x0A é㍿ﬁ́😀\x00ing") + ["  ", "    ", "<s>", "</s>", "<unk>", "<0x0A>", " the", "▁▁", "x" * 60]


@pytest.fixture(scope="module")
def blob():
    with open(PATH, "rb") as file:
        return file.read()


def library(sp, text):
    pieces = sp.encode(text, return_type="proto").pieces
    return [p.id for p in pieces], [p.begin for p in pieces], [p.end for p in pieces]


def agree(model, sp, n, seed=0):
    rng = random.Random(seed)
    for _ in range(n):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 120)))
        assert [x.tolist() for x in model.encode(text)] == list(library(sp, text)), repr(text)


def test_op13_equals_the_library(spark, blob):
    sp, model = sentencepiece.SentencePieceProcessor(model_proto=blob), piece_bpe.Model(blob)
    agree(model, sp, 1500)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for doc_id, text in texts(spark):
        ids = sp.encode(text or "")
        assert [x.tolist() for x in model.encode(text or "")] == list(library(sp, text or ""))
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids))))
    assert sorted(map(tuple, queries.op13_piece_bpe(spark, SF).collect())) == sorted(want)


@pytest.mark.parametrize("change", ["map", "squeeze", "no bytes", "suffix", "user-defined", "unused"])
def test_op13_other_models(blob, change):
    """The character map of the library's own NFKC rules, and other settings of a model."""
    proto, rules = sentencepiece_model_pb2.ModelProto(), sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(blob)
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    proto.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    proto.normalizer_spec.remove_extra_whitespaces = change == "squeeze"
    proto.trainer_spec.treat_whitespace_as_suffix = change == "suffix"
    if change == "no bytes":
        proto.trainer_spec.byte_fallback = False
        for piece in proto.pieces:
            piece.type = 1 if piece.type == piece_bpe.BYTE else piece.type
    for piece in proto.pieces:
        if change == "user-defined" and piece.piece in ("the", "ing", "ab"):
            piece.type = piece_bpe.USER_DEFINED
        if change == "unused" and piece.piece in ("▁the", "ing", "in", "▁▁▁▁"):
            piece.type = piece_bpe.UNUSED
    changed = proto.SerializeToString()
    agree(piece_bpe.Model(changed), sentencepiece.SentencePieceProcessor(model_proto=changed), 400)


def test_op13_odd_rows_and_spans(spark, odd, blob):
    model, sp = piece_bpe.share_model(spark, PATH), sentencepiece.SentencePieceProcessor(model_proto=blob)
    coded = piece_bpe.encode(odd, model)
    rows = coded.collect()
    assert sorted((r.id or -1, len(r.ids)) for r in rows) == sorted((r[0] or -1, len(sp.encode(r[1] or ""))) for r in ODD)
    held = {r[0]: (r[1] or "").encode() for r in ODD}
    for r in rows:  # spans stand side by side and cover the source
        data = held[r.id]
        assert r.starts[1:] == r.ends[:-1] and (not r.ids or (r.starts[0], r.ends[-1]) == (0, len(data)))
    back = sorted((r.id or -1, r.text) for r in piece_bpe.decode(coded, model).collect())
    assert back == sorted((r[0] or -1, (r[1] or "").replace("▁", " ")) for r in ODD)
    assert piece_bpe.encode(odd.limit(0), model).count() == 0


def test_op13_decodes_any_ids(spark, blob):
    sp, rng = sentencepiece.SentencePieceProcessor(model_proto=blob), random.Random(4)
    some = [0, 1, 2, *range(3, 259), *range(259, 280), 29871, 29900]
    lists = [[rng.choice(some) for _ in range(rng.randint(0, 12))] for _ in range(600)] + [[1, 259], [2, 1, 29871, 300], []]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(lists)] + [(-1, None)], "id long, ids array<int>")
    got = {r.id: r.text for r in piece_bpe.decode(frame, piece_bpe.share_model(spark, PATH)).collect()}
    assert got.pop(-1) == ""
    assert got == {i: sp.decode(x) for i, x in enumerate(lists)}


# mended operators ----------------------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["<|ENDOFTEXT|>", "<|endoftext|>", "<|StartOfText|>", "T̈", "ẖ", "é", "don't", "a.", "x", "Y", " ", "\n", "\xa0", "<|"]), max_size=9))
def test_op3_ids_of_hostile_texts(parts):
    path, text = public_tokenizers.path("word_bpe_49k.json"), "".join(parts)
    if path not in packing._ENCODERS:
        packing._ENCODERS[path] = packing.Encoder(path)
    encoder = packing._ENCODERS[path]
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["the", "été", "ö", "ß", "×", "÷", "À", "'s", "'", "~'s", "12", "½", "µ", ".", "!!", "###", "_", "\x7f", "\x85", "\x1c", "K",
     "中", "<|endoftext|>", "\u0301", " ", "\t"]), max_size=9))
def test_op3_ids_of_parts(parts):
    test_op3_ids_of_hostile_texts.hypothesis.inner_test(parts)


def test_op3_plain_units_need_the_model_only():
    """Words, digits and marks: ids by the tokenizer's model, without its normalizer, regular expression and offsets."""
    encoder = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    text = "Unbelievable, été größer!! 12 x2y ### the the"
    encoder.memory.tokenizer = None
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_op4_near_copies_make_few_rows(spark):
    """A large group of near copies is joined by pivots: the edges between groups stay fewer than the fingerprints."""
    rng = np.random.default_rng(8)
    centre = int(rng.integers(2**63))
    near = {centre ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 4), replace=False)) for _ in range(3000)}
    chain = [int(rng.integers(2**62))]
    for _ in range(60):  # each within four bits of the one before, the ends far apart
        chain.append(chain[-1] ^ sum(1 << int(b) for b in rng.choice(63, 4, replace=False)))
    alone = [int(x) for x in rng.integers(2**63, size=500)]
    prints = sorted({*near, *chain, *alone})
    got = {r.fp: r.root for r in golay_simhash.groups(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()}
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    x = np.array(prints, np.uint64)
    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i] ^ x[i + 1 :]) <= 4).tolist():
            a, b = sorted((find(prints[i]), find(prints[i + 1 + j])))
            root[b] = a
    assert {p: got.get(p, p) for p in prints} == {p: find(p) for p in prints}


def test_op5_repeated_and_large_records(spark, monkeypatch):
    """Repeated rows, null ids, one payload on most rows, a record beyond the bytes read at once, several packages."""
    monkeypatch.setattr(zip_warc, "READ_BYTES", 4096)
    big = "".join(random.Random(1).choice("abcdefghij") for _ in range(200_000))
    rows = [(i, "u", "hot") for i in range(10, 400)] + [(5, "u", "hot"), (5, "u", "hot"), (5, "v", "other")]
    rows += [(None, "u", "lone"), (None, "u", "lone"), (2, None, big), (1, "w", big), (7, "u", None), (8, "u", "")]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, sha1 int")
    pages = zip_warc.with_references(frame)
    folder = scratch(spark, "warc-test")
    manifest = zip_warc.write_packages(pages.repartition(3), folder, package_bytes=2000)
    assert manifest.count() > 3
    got = zip_warc.read_records(zip_warc.locate(manifest, folder), folder).collect()
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    want = []
    for page, _, html in rows:
        data, refers = (html or "").encode(), first.get(html or "")
        refers = None if refers == page else refers
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((page, len(data), digest, "response" if refers is None else "revisit", refers))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert pages.where("refers_to IS NOT NULL AND html IS NOT NULL").isEmpty()


UNSEEN = {
    "Apache-2.0": ["This project is licensed under the Apache 2.0 license, see the file.", "code under Apache License, version 2.0"],
    "BSD": ["The library comes with a BSD 3-Clause License.", "// SPDX-License-Identifier: BSD-2-Clause"],
    "CC-BY": ["All figures are licensed under CC BY 4.0 unless noted."],
    "CC-BY-NC": ["The data set is licensed under CC BY-NC 4.0 by its makers."],
    "CC-BY-SA": ["Text of this page is licensed under CC BY-SA 4.0 since 2019."],
    "GPL": ["you can redistribute it under the GNU General Public License version 2", "The program is covered by the GNU GPL v3.",
            "# SPDX-License-Identifier: GPL-3.0-or-later"],
    "LGPL": ["released to you under the GNU Lesser General Public License, any version", "/* SPDX-License-Identifier: LGPL-2.1-only */"],
    "MIT": ["Copyright 2020 the makers. MIT License.", "* SPDX-License-Identifier: MIT"],
    "MPL-2.0": ["covered by the Mozilla Public License Version 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "unknown": ["the driver's license of the public library", "a general public debate about free software and its terms",
                "version 2 of the report is public", "the apache helicopter landed", "permission is granted to leave early",
                "identifier of the clause in the form", "a copy of the notice was posted"],
}


def test_op7_held_out_wordings(spark):
    """The classifier alone on wordings it has not seen: accuracy and calibration error; then with the templates."""
    model = license_scan.fit(read(spark, SF.replace("sf0.001", "sf0.01"), "documents"))
    cases = [(family, license_scan.WORD.findall(text.lower())) for family, texts in UNSEEN.items() for text in texts]
    p = model.probabilities([words for _, words in cases])
    truth = np.array([license_scan.FAMILIES.index(f) for f, _ in cases])
    hit = p.argmax(axis=1) == truth
    assert hit.mean() >= 0.85
    assert abs(p.max(axis=1).mean() - hit.mean()) <= 0.2
    named = [[n[0] for n in model.notices(words)] for _, words in cases]
    assert np.mean([got == ([] if f == "unknown" else [f]) for got, (f, _) in zip(named, cases)]) >= 0.9
    assert all(got == [] for got, (f, _) in zip(named, cases) if f == "unknown")


def test_op7_the_classifier_decides(spark, odd):
    """Without its name a template alone finds nothing, and its name alone is refused without a template."""
    model = license_scan.fit(odd)
    words = license_scan.WORD.findall("released under the mit license")
    assert [n[0] for n in model.notices(words)] == ["MIT"]
    weights, model.weights = model.weights, np.zeros_like(model.weights)
    model.bias = np.eye(len(license_scan.FAMILIES))[0] * 50
    assert model.match(words, "MIT") == 1 and model.notices(words) == []
    model.weights, model.bias = weights, np.eye(len(license_scan.FAMILIES))[license_scan.FAMILIES.index("BSD")] * 50
    assert model.notices(words) == []


def test_op7_sample_is_taken_over_whole_texts(spark):
    rows = [(i, "\n".join(f"line {i} {k} " + "x " * 60 for k in range(50))) for i in range(40)] + [(99, None), (100, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    some = license_scan.sampled(docs, 200)
    places = {int(w[2]) for w in some if w[:1] == ["line"]}
    assert 120 <= len(some) <= 300 and all(len(w) <= license_scan.WINDOW for w in some) and (not places or max(places) > 10)
    assert license_scan.sampled(docs, 200) == some and license_scan.sampled(docs.limit(0)) == []
