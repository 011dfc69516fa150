"""Personal data by bootstrapped contextual extraction.

Seeds are the matches of fixed rules (email, ip, card, phone). Every seed and every other identifier-like token, or run
of tokens written in groups, is an instance with the words beside it, its lexical patterns: two words before, one before
and one after, two after, and one on either side alone. Patterns and instances form a bipartite graph, weighted by
occurrence only through distinct pairs; confidence flows from seeds to patterns to unseen instances for a few rounds, each
an aggregation in Spark. Patterns that stay above the threshold tag the unseen instances they introduce, where those have
the shape of the kind.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows
from tidemark.session import materialise

#: Kinds in the order of the digest, and their rules.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a match can only begin where a run of digits does
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Parameters of the method: rounds, least confidence, least number of distinct seeds under a pattern.
ROUNDS, MIN_CONFIDENCE, MIN_SEEDS = 3, 0.9, 5
CONTEXT_CHARS, MIN_TOKEN, MIN_DIGITS = 60, 6, 5
#: Least and most digits of an unseen instance by kind, and most letters; an email has an @ and no such bounds, an ip three
#: separators.
DIGITS = {"ip": (4, 32, 32), "card": (12, 24, 6), "phone": (7, 15, 3)}
OPENING, CLOSING, EDGES = "([{\"'<", ")]}\"'>.,;:!?", ".,;:!?()[]{}\"'<>|*#$%&"
GROUP = re.compile(r"[(+]*[A-Z]{0,2}[0-9][A-Z0-9()./-]*")
TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
SPAN = "struct<start:long,kind:int,end:long>"
FOUND = (
    f"doc_id long, text_hash long, base array<{SPAN}>, "
    "seen array<struct<start:long,end:long,kind:int,patterns:array<string>,instance:string,shapes:array<int>>>"
)


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches found from each @ backwards, so that long runs without one cost nothing."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            floor = domain.end()
        at = text.find("@", max(at + 1, floor))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed rules' matches, by start and then kind."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 40:
            digits = re.sub("[^0-9]", "", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _words(words: list[str]) -> list[str]:
    return [re.sub(r"[0-9]+", "0", w.strip("()[]{}\"'").lower()) for w in words]


def _patterns(text: str, start: int, end: int) -> list[str]:
    """The contexts of a span, where white space or the text's end bounds it behind brackets, quotes and stops."""
    before = text[max(0, start - CONTEXT_CHARS) : start].rstrip(OPENING)
    after = text[end : end + CONTEXT_CHARS].lstrip(CLOSING)
    left = _words(before.split()[-2:]) if before[-1:].isspace() else []
    right = _words(after.split()[:2]) if after[:1].isspace() else []
    out = [f"{left[-1]} _"] if left else []
    out += [f"{left[0]} {left[1]} _"] if len(left) == 2 else []
    out += [f"_ {right[0]}"] if right else []
    out += [f"_ {right[0]} {right[1]}"] if len(right) == 2 else []
    return out + ([f"{left[-1]} _ {right[0]}"] if left and right else [])


def _shapes(instance: str) -> list[int]:
    """Numbers of the kinds whose shape an unseen instance has."""
    if "@" in instance:
        return [0]
    digits, letters = sum(map(str.isdigit, instance)), sum(map(str.isalpha, instance))
    of = [k for k, (low, high, most) in DIGITS.items() if low <= digits <= high and letters <= most]
    return [KINDS.index(k) for k in of if k != "ip" or len(re.findall("[.:]", instance)) >= 3]


def _candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans of tokens outside the seeds that have an @ or enough digits, and of runs of groups one blank apart."""
    out, run, ahead, taken = set(), [], 0, 0

    def close() -> None:
        if len(run) > 1:
            out.add((run[0][0], run[-1][1]))
        run.clear()

    for m in TOKEN.finditer(text):
        token = m[0].strip(EDGES)
        start = m.start() + m[0].index(token)
        end = start + len(token)
        while ahead < len(base) and base[ahead][0] < end:
            taken = max(taken, base[ahead][2])
            ahead += 1
        if not token or taken > start:
            close()
            continue
        if len(token) >= MIN_TOKEN:
            out.add((start, end))
        if not (run and run[-1][2] + 1 == m.start() and text[m.start() - 1] == " "):
            close()
        if GROUP.fullmatch(m[0].rstrip(CLOSING + "|")):
            run.append((start, end, m.end()))
            if m[0][-1] in ".,;:!?|":
                close()
        else:
            close()
    close()
    fit = lambda x: "@" in x or sum(c.isdigit() for c in x) >= MIN_DIGITS
    return sorted(x for x in out if fit(text[slice(*x)]))


def _seen(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, list[str], str, list[int]]]:
    """Instances with a pattern: (start, end, kind or -1, patterns, instance, kinds of its shape)."""
    spans = [(start, end, kind) for start, kind, end in base] + [(*x, -1) for x in _candidates(text, base)]
    out = [(a, b, k, _patterns(text, a, b), text[a:b].lower(), _shapes(text[a:b]) if k < 0 else []) for a, b, k in spans]
    return [x for x in out if x[3]]


def _docs(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def scan(docs: DataFrame) -> DataFrame:
    """Seeds and instances of every whole text, one row per row."""

    def work(batch: pa.RecordBatch):
        base, seen = [], []
        for text in batch.column(2).to_pylist():
            spans = base_spans(text)
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
            seen.append([dict(zip(("start", "end", "kind", "patterns", "instance", "shapes"), x)) for x in _seen(text, spans)])
        span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
        one = pa.struct([
            ("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("patterns", pa.list_(pa.string())),
            ("instance", pa.string()), ("shapes", pa.list_(pa.int32())),
        ])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(base, pa.list_(span)), pa.array(seen, pa.list_(one))],
            names=["doc_id", "text_hash", "base", "seen"],
        )

    return map_rows(_docs(docs), work, FOUND)


def patterns(
    found: DataFrame, rounds: int = ROUNDS, min_confidence: float = MIN_CONFIDENCE, min_seeds: int = MIN_SEEDS
) -> DataFrame:
    """(pattern, kind, confidence, n_seeds) of the trusted patterns, the best kind of each.

    A seed has belief 1 in its kind. A pattern's confidence in a kind is the share of that kind in the belief of its distinct
    instances, so an unseen one counts against it only as far as it is believed to be of another kind; an unseen instance
    believes the mean of its patterns. The edges are distinct pairs, so a frequent pair counts once.
    """
    edges = materialise(
        found.select(F.inline("seen"))
        .select(F.explode("patterns").alias("pattern"), F.xxhash64("instance").alias("instance"), "kind")
        .distinct(),
        "pii-edges",
    )
    known = edges.where("kind >= 0")
    unseen = edges.where("kind < 0").select("pattern", "instance")
    seeds = known.groupBy("pattern", "kind").agg(F.count("*").alias("n_seeds"))
    belief = None
    for _ in range(rounds):
        mass = seeds.select("pattern", "kind", F.col("n_seeds").cast("double").alias("mass"), "n_seeds")
        if belief is not None:
            more = unseen.join(belief, "instance").groupBy("pattern", "kind").agg(F.sum("belief").alias("mass"))
            mass = mass.unionByName(more.withColumn("n_seeds", F.lit(0).cast("long")))
        rated = mass.groupBy("pattern", "kind").agg(F.sum("mass").alias("mass"), F.sum("n_seeds").alias("n_seeds"))
        total = rated.groupBy("pattern").agg(F.sum("mass").alias("n")).where("n > 0")
        rated = rated.join(total, "pattern").select(
            "pattern", "kind", (F.col("mass") / F.col("n")).alias("confidence"), "n_seeds"
        )
        rated = materialise(rated, "pii-patterns")
        patterns_of = unseen.groupBy("instance").agg(F.count("*").alias("n"))
        belief = unseen.join(rated, "pattern").groupBy("instance", "kind").agg(F.sum("confidence").alias("sum"))
        belief = belief.join(patterns_of, "instance").select("instance", "kind", (F.col("sum") / F.col("n")).alias("belief"))
        belief = materialise(belief, "pii-belief")
    best = rated.where((F.col("confidence") >= min_confidence) & (F.col("n_seeds") >= min_seeds))
    return best.groupBy("pattern").agg(
        F.max(F.struct("confidence", "n_seeds", (-F.col("kind")).alias("k"))).alias("x")
    ).select("pattern", (-F.col("x.k")).alias("kind"), "x.confidence", "x.n_seeds")


def discovered(found: DataFrame, trusted: DataFrame) -> DataFrame:
    """(doc_id, text_hash, more): spans of unseen tokens behind trusted patterns; equal rows share one result."""
    tokens = found.select("doc_id", "text_hash", F.inline("seen")).where("kind < 0").drop("kind", "instance")
    tokens = tokens.withColumn("pattern", F.explode("patterns")).drop("patterns")
    span = F.struct("start", "kind", "end").cast(SPAN).alias("span")
    meant = tokens.join(trusted.select("pattern", "kind"), "pattern").where(F.array_contains("shapes", F.col("kind")))
    return meant.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set(span)).alias("more")  # spans of one text
    )


def _with_more(rows: DataFrame, more: DataFrame) -> DataFrame:
    more = more.select(F.col("doc_id").alias("more_id"), F.col("text_hash").alias("more_hash"), "more")
    same = rows.doc_id.eqNullSafe(more.more_id) & (rows.text_hash == more.more_hash)
    return rows.join(more, same, "left").drop("more_id", "more_hash")


def extract(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of every row: the fixed rules' spans, and all spans by start and kind.

    A null text is empty and has none; null ids stay; repeated rows give repeated results; further columns are left
    out; an empty table gives none.
    """
    found = materialise(scan(docs), "pii-found")
    more = discovered(found, patterns(found))
    none = F.array().cast(f"array<{SPAN}>")
    return _with_more(found.select("doc_id", "text_hash", "base"), more).select(
        "doc_id", "base", F.sort_array(F.concat("base", F.coalesce("more", none))).alias("spans")
    )


def written(spans: str):
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(F.col(spans), lambda s: F.concat_ws(":", names[s.kind], s.start, s.end)))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets, and n_chars to match; null texts stay null.

    Overlapping spans become one, named by the first. All rows and columns stay.
    """
    found = materialise(scan(docs), "pii-found")
    more = materialise(discovered(found, patterns(found)), "pii-more")
    keyed = docs.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    schema = docs.schema

    def work(batch: pa.RecordBatch):
        texts = batch.column("text").to_pylist()
        for i, (text, extra) in enumerate(zip(texts, batch.column("more").to_pylist())):
            spans = base_spans(text) if text else []
            if extra:
                spans = sorted(spans + [(s["start"], s["kind"], s["end"]) for s in extra])
            parts, at, end = [], 0, -1
            for start, kind, stop in spans:
                if start >= max(end, 0):
                    parts += [text[max(at, end) : start], f"<{KINDS[kind].upper()}>"]
                end = max(end, stop)
                at = end
            if parts:
                texts[i] = "".join(parts) + text[end:]
        columns = {name: batch.column(name) for name in schema.names}
        columns["text"] = pa.array(texts, pa.string())
        if "n_chars" in columns:
            sizes = pa.array([None if t is None else len(t) for t in texts], columns["n_chars"].type)
            columns["n_chars"] = sizes
        yield pa.RecordBatch.from_pydict(columns)

    return map_rows(_with_more(keyed, more).drop("text_hash"), work, schema)
