"""Groups of fingerprints: keys that are done are left out, and what is found equals brute force."""

import random

import pytest

from tidemark.llm import golay_simhash


def brute(prints):
    root = {x: x for x in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 4:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    found = {x: top(x) for x in prints}
    linked = [x for x in prints if sum(found[x] == r for r in found.values()) > 1]
    return {x: min(y for y in prints if found[y] == found[x]) for x in linked}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def found(spark, prints, monkeypatch):
    written, write = {}, golay_simhash.materialise

    def count(df, label, *more):
        out = write(df, label, *more)
        written.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(golay_simhash, "materialise", count)
    rows = golay_simhash.groups(spark.createDataFrame([(x,) for x in prints], "fp long")).collect()
    roots = {r["fp"]: r["root"] for r in rows}
    sizes = {r: sum(x == r for x in roots.values()) for r in roots.values()}
    return {fp: r for fp, r in roots.items() if sizes[r] > 1}, written


def test_keys_in_which_all_link_with_the_pivot_are_not_joined(spark, monkeypatch):
    prints = [0] + [1 << i for i in range(40)]
    got, written = found(spark, prints, monkeypatch)
    assert got == dict.fromkeys(prints, 0) and written["simhash-mixed"] == [0]


@pytest.mark.parametrize("pairs_a_row", [0, golay_simhash.PAIRS_A_ROW])
def test_groups_equal_brute_force(spark, monkeypatch, pairs_a_row):
    """Chains, near copies of a few bases, and strangers; with and without further rounds of pivots."""
    monkeypatch.setattr(golay_simhash, "PAIRS_A_ROW", pairs_a_row)
    rnd, prints = random.Random(5), set()
    for _ in range(4):
        base = rnd.getrandbits(64)
        for _ in range(60):
            x = base
            for bit in rnd.sample(range(64), rnd.randint(0, 6)):
                x ^= 1 << bit
            prints.add(signed(x))
        for _ in range(12):
            for bit in rnd.sample(range(64), 4):
                base ^= 1 << bit
            prints.add(signed(base))
    prints = sorted(prints | {signed(rnd.getrandbits(64)) for _ in range(40)})
    assert found(spark, prints, monkeypatch)[0] == brute(prints)


def test_merged_pieces_are_kept_as_bytes():
    """The collector visits lists and not bytes; the memory holds the ids of a piece as they are put out."""
    import public_tokenizers

    from tidemark.llm import byte_bpe

    words = byte_bpe.load_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = words.encode("qzxjv kwvpq, qzxjv")
    assert coded and all(type(x) is bytes for x in [*words.merged.values(), *words.units.values()])
