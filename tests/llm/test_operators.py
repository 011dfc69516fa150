"""The operators against brute force, the public libraries, round trips and held-out labels, with odd rows in each table."""

import base64
import hashlib
import io
import re
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF
from tidemark.llm import byte_bpe, chat, golay_simhash, knn_quality, license_scan, nn_descent, packing, pii_bootstrap
from tidemark.llm import queries, repetition, zip_warc
from tidemark.llm.common import components, read

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, fp string, x int"
LONG = "word " * 30_000
ODD = [
    (1, None, None, None, None, 1, "a", None),
    (2, "", "en", "s", 0, 2, "a", 1),
    (3, "one two three four five", "en", "s", 23, 9, "a", 1),
    (4, "one two three four five", "en", "s", 23, 9, "a", 1),
    (4, "one two three four five", "en", "s", 23, 9, "a", 1),
    (None, "Écrit à mail a.b@c.example.org +49 (30) 1234-5678 or 10.0.0.1 ...", "fr", None, 5, 0, None, 0),
    (6, LONG, "en", "s", 5, 0, "b", 0),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def texts(spark):
    return [(r.doc_id, r.text) for r in read(spark, SF, "documents").select("doc_id", "text").collect()]


def brute_repeat_words(words, window):
    seen, marked = {}, set()
    for i in range(len(words) - window + 1):
        seen.setdefault(tuple(words[i : i + window]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            marked.update(p + k for p in places for k in range(window))
    return len(marked)


def test_op1_equals_brute_force(spark):
    got = {r.doc_id: r for r in queries.op1_suffix_repetition(spark, SF).collect()}
    for doc_id, text in texts(spark):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        repeat, r = brute_repeat_words(words, 8), got[doc_id]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(lines) - len(set(lines)), repeat)
        assert r.base_failed == (len(words) < 20 or 100 * repeat > 30 * len(words))
        assert r.covered_words == brute_repeat_words(words, repetition.MIN_REPEAT)
        assert not (r.base_failed and r.kept)


def brute_maximal_repeats(words, least):
    out = set()
    for n in range(least, len(words)):
        at = {}
        for i in range(len(words) - n + 1):
            at.setdefault(tuple(words[i : i + n]), []).append(i)
        for places in at.values():
            left = {words[i - 1] if i else None for i in places}
            right = {words[i + n] if i + n < len(words) else None for i in places}
            if len(places) > 1 and len(left) > 1 and len(right) > 1:
                out.add((n, tuple(places)))
    return out


def test_op1_maximal_repeats_equal_brute_force():
    rng = np.random.default_rng(17)
    for turn in range(200):
        texts = [" ".join(rng.choice(["a", "b", "c"][: 1 + turn % 3], rng.integers(0, 30))) for _ in range(3)]
        symbols, n_words = repetition._word_symbols(texts)
        got = repetition.maximal_repeats(*repetition.intervals(symbols), symbols, 2)
        of_text = np.searchsorted(np.cumsum(n_words), got[:, 0], "right")
        for k, text in enumerate(texts):
            wanted = brute_maximal_repeats(text.split(), 2)
            assert sorted((n, len(p)) for n, p in wanted) == sorted(map(tuple, got[of_text == k, 1:].tolist()))


def test_op1_spans_are_the_union_of_maximal_repeats(spark):
    rng = np.random.default_rng(19)
    texts = [" ".join(rng.choice(["a", "b", "c", "d"], rng.integers(0, 60))) for _ in range(40)] + [None, "", "x " * 2000]
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    got, rules = {}, {r.doc_id: r for r in repetition.repetition_rules(df, min_repeat=3).collect()}
    for r in repetition.repeated_spans(df, min_repeat=3).collect():
        got.setdefault(r.doc_id, set()).add((r.start_word, r.n_words))
    for i, text in enumerate(texts[:-1]):
        words = (text or "").split()
        repeats = brute_maximal_repeats(words, 3)
        inside = sorted({x for n, places in repeats for p in places for x in range(p, p + n)})
        starts = [x for x in inside if x - 1 not in inside]
        wanted = {(a, next(n for n in range(1, 99) if a + n not in inside)) for a in starts}
        assert got.get(i, set()) == wanted
        assert (rules[i].covered_words, rules[i].n_repeats) == (len(inside), len(repeats))
    last = len(texts) - 1
    assert got[last] == {(0, 2000)} and rules[last].n_repeats == 1997
    assert repetition.repeated_spans(df.limit(0)).count() == 0


def test_op1_odd_rows(odd, none):
    got = repetition.repetition_rules(odd).collect()
    assert len(got) == len(ODD) and sum(r.n_words == 0 for r in got) == 2
    assert next(r for r in got if r.doc_id == 6).n_repeat_words == 30_000
    assert repetition.repetition_rules(none).count() == 0


def test_op2_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 32))
    rows = [[float(v) for v in centres[i % 60] + rng.normal(size=32) * 0.18] for i in range(900)]
    rows += [rows[0], rows[0], None, [0.0] * 32, [float("nan")] + [1.0] * 31, [None] + [1.0] * 31, []]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in enumerate(rows)], "vec_id long, embedding array<float>, label int, node string")
    got = {r.vec_id: r for r in nn_descent.near_duplicates(df).collect()}
    x = np.array([np.array(v, np.float32).astype(float) for v in rows[:902]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    found = np.array([got[i].n_links for i in range(902)])
    assert (found <= near.sum(axis=1)).all() and found.sum() >= 0.9 * near.sum() > 0
    assert got[900].class_id == 0 and got[900].n_links == got[0].n_links >= 2
    assert all(got[i].n_links == 0 and got[i].kept for i in range(902, 907))
    assert nn_descent.near_duplicates(df.limit(0)).count() == 0


def test_op2_large_group_is_counted_whole(spark):
    rng = np.random.default_rng(5)
    tight = rng.normal(size=32) + rng.normal(size=(300, 32)) * 0.02
    edge = tight[0] + rng.normal(size=(40, 32)) * 0.4
    x = np.concatenate([tight, edge, rng.normal(size=(60, 32))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in nn_descent.near_duplicates(df).collect()}
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.9).sum(axis=1) - 1
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= near).all() and found.sum() >= 0.99 * near.sum()
    assert all(got[i].component_id == 0 and got[i].n_links >= 299 for i in range(300))


@pytest.fixture
def starved(monkeypatch):
    """2,000 vectors, most of which link with one other, and a search that starts from next to nothing."""
    for name in ("PROJECTIONS", "REACH", "LIST"):
        monkeypatch.setattr(nn_descent, name, 1)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1000, 256))
    return np.concatenate([x, x + rng.normal(size=x.shape) * 0.44])


def links(x):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return (x @ x.T >= 0.9).sum(axis=1) - 1


def test_op2_searches_until_the_recall_is_reached(spark, starved):
    df = spark.createDataFrame([(i * 50, v.tolist()) for i, v in enumerate(starved)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in nn_descent.near_duplicates(df).collect()}
    wanted, found = links(starved), np.array([got[i * 50].n_links for i in range(len(starved))])
    assert got[0].recall >= 0.9 and (found <= wanted).all()
    assert found[1::2].sum() >= 0.85 * wanted[1::2].sum() > 100  # the rows that no audit asks


def test_op2_audit_asks_rows_that_repeat_a_smaller_id(spark, starved):
    x = np.concatenate([starved, starved[:100]])
    ids = [*range(1, 4001, 2), *range(5000, 15000, 100)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in nn_descent.near_duplicates(df).collect()}
    wanted, found = links(x), np.array([got[i].n_links for i in ids])
    assert (found <= wanted).all() and found.sum() >= 0.85 * wanted.sum() > 100


def test_op2_recall_is_null_where_nothing_is_asked(spark, starved):
    x = np.concatenate([starved[:120], starved[1000:1120]])
    df = spark.createDataFrame([(100 * i + 1, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in nn_descent.near_duplicates(df).collect()}
    wanted, found = links(x), np.array([got[100 * i + 1].n_links for i in range(len(x))])
    assert all(r.recall is None for r in got.values())
    assert (found <= wanted).all() and found.sum() >= 0.9 * wanted.sum() > 100


def test_op2_compares_everything_after_the_last_doubling(spark, starved, monkeypatch):
    monkeypatch.setattr(nn_descent, "PHASES", 0)
    monkeypatch.setattr(nn_descent, "ASKED_BYTES", 1 << 20)  # several blocks
    df = spark.createDataFrame([(i * 50, v.tolist()) for i, v in enumerate(starved)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in nn_descent.near_duplicates(df).collect()}
    assert [got[i * 50].n_links for i in range(len(starved))] == links(starved).tolist()
    assert got[0].recall == 1.0


def test_op2_repeated_and_null_ids_and_mixed_lengths(spark):
    rows = [(1, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (1, [0.0, 1.0], "x"), (None, [1.0, 0.0], "x"), (2, [1.0, 0.0, 0.0], "x")]
    rows += [(3, [-0.0, 2.0], "x"), (4, [0.99, 0.01], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id) for r in nn_descent.near_duplicates(df).collect())
    assert got == [(0, 3, 1), (1, 1, 1), (1, 3, 1), (1, 3, 1), (2, 0, 2), (3, 1, 1), (4, 3, 1)]


def packed_well(rows):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 4096
    return len(by)


def test_op3_pieces_and_places(spark):
    rows = queries.op3_best_fit(spark, SF).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for doc_id, text in texts(spark):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4")
            want[doc_id, n] = (at, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    lower = -(-sum(r.length for r in rows) // 4096)
    assert packed_well(rows) <= 11 / 9 * lower + 1


def test_op3_odd_rows(odd, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(packing.pieces(odd, path)).collect()
    assert sum(r.length for r in rows if r.doc_id in (1, 2)) == 2 and sum(r.doc_id == 4 for r in rows) == 2
    assert sum(r.length for r in rows if r.doc_id == 6) == 30_001
    packed_well(rows)
    assert packing.pack(packing.pieces(none, path)).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=12))
def test_op3_sweep_places_every_rank_once(counts):
    moves, used = packing.sweep(counts, 50), {}
    for length, table in moves.items():
        ends = [*table[1:, 0].tolist(), counts[length]]
        assert table[0, 0] == 0
        for (rank, first, offset), end in zip(table.tolist(), ends):
            for k in range(end - rank):
                used.setdefault(first + k, []).append((offset, length))
    for spans in used.values():
        assert [o for o, _ in sorted(spans)] == [sum(n for _, n in sorted(spans)[:k]) for k in range(len(spans))]
        assert sum(n for _, n in spans) <= 50


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op4_equals_brute_force(spark):
    rows = sorted(queries.op4_golay_simhash(spark, SF).collect(), key=lambda r: r.doc_id)
    prints = [simhash(t) for _, t in sorted(texts(spark))]
    assert [r.fingerprint for r in rows] == [f"{p:016x}" for p in prints]
    ids, root = [r.doc_id for r in rows], list(range(len(rows)))
    for _ in range(len(rows)):
        before = list(root)
        for i in range(len(rows)):
            root[i] = min(root[j] for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 4)
        if root == before:
            break
    assert [r.component_id for r in rows] == [ids[k] for k in root]


def test_op4_keys_cover_every_distance_up_to_four(spark):
    rng = np.random.default_rng(5)
    pairs = []
    for n in range(1, 5):
        for _ in range(500):
            a = int(rng.integers(2**63))
            pairs.append((a, a ^ sum(1 << int(b) for b in rng.choice(63, n, replace=False))))
    df = spark.createDataFrame([(p,) for p in {p for pair in pairs for p in pair}], "fp long")
    found = {(r.a, r.b) for r in golay_simhash.links(df).collect()}
    assert {(min(p), max(p)) for p in pairs} <= found


def test_op4_odd_rows(odd, none):
    got = golay_simhash.near_duplicates(odd).collect()
    assert sorted(r.component_id for r in got if r.doc_id in (1, 2)) == [1, 1]
    assert {r.component_id for r in got if r.doc_id in (3, 4)} == {3} and len(got) == len(ODD)
    assert golay_simhash.near_duplicates(none).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(50, 40), (40, 45), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(21), 0), 40: 40, 45: 40, 50: 40}


def test_op5_round_trip(spark):
    pages = [(3, "http://a b", "same"), (5, None, "same"), (4, "u", None), (9, "u", ""), (None, "u", "same"), (8, "é", "ü" * 70_000)]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, digest int")
    got = {r.page_id: r for r in zip_warc.round_trip(df).collect()}
    for page_id, _, html in pages:
        data = (html or "").encode()
        assert got[page_id].payload_bytes == len(data)
        assert got[page_id].payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {
        3: ("response", None), 5: ("revisit", 3), 4: ("response", None), 9: ("revisit", 4), None: ("revisit", 3), 8: ("response", None)}
    assert {r.record_type for r in zip_warc.round_trip(df, 10**6).collect()} == {"response"}
    assert zip_warc.round_trip(df.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [None, 100])
def test_op5_directories(monkeypatch, limit):
    if limit:  # forces ZIP64 fields and the ZIP64 directory end
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    raw = io.BytesIO()
    content = {f"m{i}": bytes([i]) * (50 * i) for i in range(6)}
    with zipfile.ZipFile(raw, "w") as package:
        package.comment = b"PK\5\6 in a comment"
        for name, data in content.items():
            package.writestr(name, data)
    found = zip_warc.members(raw, len(raw.getvalue()))
    assert {n: raw.getvalue()[a : a + k] for n, (a, k) in found.items()} == content


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    out = []
    for k, pattern in enumerate(BASE.values()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if (k == 0 or k == 1 and all(int(p) <= 255 for p in m[0].split("."))
                    or k == 2 and 14 <= len(digits) <= 19 and luhn(digits) or k == 3 and 10 <= len(digits) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.@-+ 0149()%_é", max_size=60))
def test_op6_base_rules(text):
    assert pii_bootstrap.base_spans(text) == brute_spans(text)


def test_op6_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in queries.op6_pii_bootstrap(spark, SF).collect()}
    for doc_id, text in texts(spark):
        spans = brute_spans(text or "")
        written = ",".join(f"{pii_bootstrap.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        r = got[doc_id]
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == q for _, k, _ in spans) for q in range(4)]
        assert set(filter(None, written.split(","))) <= set(r.spans.split(","))


def test_op6_discovers_and_redacts(spark, odd, none):
    rows = [(i, f"please call me {'+4930' + str(10**7 + i)} soon", "en", "s", 0) for i in range(60)]
    rows += [(100, "please call me 0301234567 soon", "en", "s", 0), (101, "the part number 0301234567 is out", "en", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r.text for r in pii_bootstrap.redact(df).collect()}
    assert out[100] == out[0] == "please call me <PHONE> soon" and out[101] == rows[-1][1]
    kept = pii_bootstrap.redact(odd).collect()
    assert len(kept) == len(ODD) and kept[0].__fields__ == odd.columns
    assert [r.text for r in kept if r.doc_id is None] == ["Écrit à mail <EMAIL> <PHONE> or <IP> ..."]
    assert pii_bootstrap.redact(none).count() == 0 and pii_bootstrap.extract(none).count() == 0
    assert pii_bootstrap.extract(odd).count() == len(ODD)


def test_op6_discovers_groups_behind_and_before_patterns(spark):
    rows = [f"please call me {'+4930' + str(10**7 + i)} soon" for i in range(6)]
    cards = [f"4111 1111 1111 {1000 + i}" for i in range(200)]
    right = [c for c in cards if luhn(re.sub(" ", "", c))]
    wrong = [c for c in cards if c not in right]
    rows += [f"{'abcdefgh'[i % 8]} {c} was charged" for i, c in enumerate([*right[:8], *wrong[:37]])]
    rows += [f"please call me ({30 + i}) 555-{1000 + i} soon" for i in range(40)]
    rows += ["ring me 030 123 4567 soon", "the part number 030 123 4567 is out", "please call me " + "7" * 70 + " soon"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = [r.text for r in sorted(pii_bootstrap.redact(df).collect(), key=lambda r: r.doc_id)]
    assert all(x.endswith(" <CARD> was charged") for x in got[6:51])
    assert got[51:91] == ["please call me (<PHONE> soon"] * 40
    assert got[91] == "ring me <PHONE> soon" and got[92:] == rows[92:]


def test_op7_names_families(spark, odd, none):
    notices = ["x y. Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "the license of the work is free", LONG]
    df = spark.createDataFrame(list(enumerate(notices)), "doc_id long, text string")
    model = license_scan.fit(none)
    got = {r.doc_id: {f.family for f in r.found} for r in license_scan.scan(df, model).collect()}
    assert got == {0: {"MIT"}, 1: {"CC-BY-NC"}, 2: set(), 3: set()}
    assert license_scan.scan(odd, license_scan.fit(odd)).count() == len(ODD)
    assert license_scan.scan(none, model).count() == 0


WRAPPED = {
    "Apache-2.0": "# you may not use this file except in\n# compliance with the License. You may obtain\n# a copy of the License at",
    "BSD": " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the",
    "CC-BY": "licensed under a Creative Commons\n\nAttribution 4.0 International License",
    "CC-BY-NC": "licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License",
    "CC-BY-SA": "licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License",
    "GPL": "# you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n",
    "LGPL": "# you can redistribute it and/or modify it under the terms of the GNU\n# Lesser General Public License as published\n# by the Free Software Foundation",
    "MIT": "Permission is hereby granted, free of\ncharge, to any person obtaining a copy\nof this software",
    "MPL-2.0": "This Source Code Form is subject to\nthe terms of the Mozilla Public\nLicense, v. 2.0",
}


def test_op7_names_notices_across_line_ends(spark, none):
    assert list(WRAPPED) == license_scan.FAMILIES[1:]
    wrapped = list(WRAPPED.values())
    rows = [*wrapped, "\n".join(wrapped), "\n".join(f"a b {w}\nc\n" for w in wrapped), "word\n" * 30 + wrapped[7], "Released under the MIT License.\n" + wrapped[7]]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: [f.family for f in r.found] for r in license_scan.scan(df, license_scan.fit(none)).collect()}
    assert [got[i] for i in range(9)] == [[f] for f in WRAPPED]
    assert sorted(got[9]) == sorted(got[10]) == sorted(WRAPPED)
    assert got[11] == ["MIT"] and got[12] == ["MIT", "MIT"]


def test_op8_held_out_accuracy(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    rows = queries.op8_knn_quality(spark, sf).join(read(spark, sf, "labels"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.9
    assert all(r.predicted == 1 for r in rows if r.quality == 1)


def test_op8_votes_equal_brute_force(spark):
    docs = read(spark, SF, "documents")
    model = knn_quality.fit(docs, read(spark, SF, "labels"))
    got = {r.doc_id: r.score for r in knn_quality.score(docs, model).collect()}
    for doc_id, text in texts(spark)[:80]:
        if not text:
            continue
        vector = model.project(knn_quality.term_counts(text)[None])[0]
        similar = sorted(((float(v @ vector), y) for v, y in zip(model.vectors, model.labels)), reverse=True)
        votes = [(max(c, 0.0) ** knn_quality.POWER, y) for c, y in similar[: knn_quality.NEIGHBOURS]]
        wanted = sum(w * y for w, y in votes) / max(sum(w for w, _ in votes), 1e-12)
        assert got[doc_id] == pytest.approx(wanted, abs=2e-3)


def test_op8_odd_rows(odd, none, spark):
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, None), (6, 0)], "doc_id long, quality int")
    got = knn_quality.score(odd, knn_quality.fit(odd, labels)).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    model = knn_quality.fit(none, labels)
    assert model.prior == 0.5 and {r.score for r in knn_quality.score(odd, model).collect()} == {0.5}
    assert knn_quality.score(none, model).count() == 0


@pytest.fixture(scope="module")
def public():
    with open(queries.RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.load_vocabulary(queries.RANKS, public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=80))
def test_op9_equals_the_library(public, vocabulary, text):
    text = text.encode("utf-8", "replace").decode()
    assert np.frombuffer(vocabulary.encode(text), "<i4").tolist() == public.encode_ordinary(text)


def test_op9_rows(spark, odd, none, public):
    shared = byte_bpe.share_vocabulary(spark, queries.RANKS, public_tokenizers.PATTERN)
    got = byte_bpe.decode(byte_bpe.encode(odd, shared), shared).collect()
    want = [(i, public.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in ODD]
    assert sorted(((r.id, r.ids, bytes(r.bytes)) for r in got), key=str) == sorted(want, key=str)
    assert byte_bpe.encode(none, shared).count() == 0


CONTROLLED = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "s>", "é", " "]), max_size=8).map("".join)


@given(CONTROLLED)
def test_op10_escape_is_reversible(text):
    written = chat.escape(text)
    assert chat.unescape(written) == text and not any(c in written for c in chat.CONTROLS)


def test_op10_odd_rows(spark):
    shared = byte_bpe.share_vocabulary(spark, queries.RANKS, public_tokenizers.PATTERN)
    rows = [(1, 1, "assistant", "</s>"), (1, 0, "tool<|text|>", None), (1, 1, "assistant", "</s>"), (None, None, None, "x"), (2, 0, "assistant", LONG)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, ids int")
    formatted = chat.format_turns(df, shared)
    got = {r.conv_id: r for r in chat.read_conversations(formatted, shared).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[2].loss_chars) == (3, 8, len(LONG))
    assert got[1].turns_sha256 == hashlib.sha256(b"tool<|text|>\n\n" + b"assistant\n</s>\n" * 2).hexdigest()
    assert got[None].turns_sha256 == hashlib.sha256(b"\nx\n").hexdigest()
    whole = {r.conv_id: r for r in chat.assemble(formatted, 50256).collect()}
    assert len(whole[1].ids) == len(whole[1].loss) == got[1].n_tokens and sum(whole[1].loss) == got[1].n_loss_tokens
    assert chat.read_conversations(chat.format_turns(df.limit(0), shared), shared).count() == 0
