"""Quality rules by suffix arrays: maximal repeated substrings of a text, their union and their longest.

The words of a batch of texts form one integer string in which no two texts share a symbol, so one suffix array
serves them all and no repeat crosses a text. Prefix doubling refines only suffixes that are still tied, and its
ranks, kept per level, give the common prefix of neighbours in the array by binary descent. Common prefixes nest into
intervals of the array; an interval whose suffixes have different words in front is a maximal repeat.
"""

from __future__ import annotations

import re
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import WORD_SPACES, doc_columns, map_rows, text_slices, utf8

SYMBOLS = "#*$%&|<>"
#: Limits of the rules; all are parameters of :func:`repetition_rules`.
MIN_WORDS, MAX_WINDOW_PERCENT, WINDOW = 20, 30, 8
MIN_REPEAT, MAX_COVERED_PERCENT, MAX_LONGEST = 6, 30, 60
SLICE_CHARS = 1_500_000

RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered_words long, longest_repeat long, n_repeats long"
)
SPANS = "doc_id long, start_word long, n_words long"
_MIXED = -2


def suffix_ranks(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of an integer string, and per doubling level k the rank of each suffix by its first 2**k symbols.

    Equal ranks at level k mean equal prefixes of that length; a suffix that is alone keeps its rank.
    """
    n = len(symbols)
    _, inverse, counts = np.unique(symbols, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[inverse]
    active = np.flatnonzero(counts[inverse] > 1)
    levels, h = [rank.copy()], 1
    while len(active):
        follow = active + h
        second = np.full(len(active), -1, np.int64)
        inside = follow < n
        second[inside] = rank[follow[inside]]
        order = np.lexsort((second, rank[active])) if n > 2**31 else np.argsort(rank[active] * (n + 1) + second + 1, kind="stable")
        active, second = active[order], second[order]
        first = rank[active]
        new_first = np.r_[True, first[1:] != first[:-1]]
        new_both = new_first | np.r_[True, second[1:] != second[:-1]]
        at = np.arange(len(active))
        bucket = np.maximum.accumulate(np.where(new_first, at, 0))
        group = np.maximum.accumulate(np.where(new_both, at, 0))
        rank = rank.copy()
        rank[active] = first + group - bucket
        starts = np.flatnonzero(new_both)
        sizes = np.diff(np.r_[starts, len(active)])
        active = np.sort(active[np.repeat(sizes > 1, sizes)])
        levels.append(rank)
        h *= 2
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    return array, levels


def neighbour_prefixes(array: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """lcp[r]: length of the common prefix of the suffixes at r and r + 1 of the array."""
    n = len(array)
    left, right = array[:-1], array[1:]
    lcp = np.zeros(max(n - 1, 0), np.int64)
    near = np.flatnonzero(levels[0][left] == levels[0][right])
    a, b = left[near].copy(), right[near].copy()
    length = np.zeros(len(near), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        inside = np.maximum(a, b) < n
        same = np.zeros(len(near), bool)
        same[inside] = rank[a[inside]] == rank[b[inside]]
        step = same.astype(np.int64) << k
        a, b, length = a + step, b + step, length + step
    lcp[near] = length
    return lcp


def intervals(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array, and the common prefixes of its neighbours, which nest into intervals."""
    if not len(symbols):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    array, levels = suffix_ranks(symbols)
    return array, neighbour_prefixes(array, levels)


def deepest(array: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each position the length of the deepest interval that holds it: the longest substring from there found elsewhere."""
    out = np.zeros(len(array), np.int64)
    if len(array):
        out[array] = np.maximum(np.r_[lcp, 0], np.r_[0, lcp])
    return out


def covered(reach: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in the union of repeats of ``least`` symbols or more."""
    edge = np.zeros(len(reach) + 1, np.int64)
    at = np.flatnonzero(reach >= least)
    np.add.at(edge, at, 1)
    np.subtract.at(edge, at + reach[at], 1)
    return np.cumsum(edge[:-1]) > 0


def union_spans(inside: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the runs of ``inside``, cut where a text begins."""
    first = np.zeros(len(inside) + 1, bool)
    first[np.cumsum(lengths)] = first[0] = True
    starts = np.flatnonzero(inside & (first[:-1] | ~np.r_[False, inside[:-1]][: len(inside)]))
    ends = np.flatnonzero(inside & (first[1:] | ~np.r_[inside[1:], False][: len(inside)]))
    return starts, ends - starts + 1


def maximal_repeats(array: np.ndarray, lcp: np.ndarray, symbols: np.ndarray, least: int) -> np.ndarray:
    """Rows (position, length, occurrences) of the maximal repeated substrings of ``least`` symbols or more.

    An interval passes its occurrences, and the symbol before them if it is the same for all, on to the one around it,
    so the work is one step per suffix however deep intervals nest. The position is that of one occurrence.
    """
    out = []
    high = np.flatnonzero(lcp >= least)
    for run in np.split(high, np.flatnonzero(np.diff(high) > 1) + 1) if len(high) else []:
        at = array[run[0] : run[-1] + 2]
        before = np.where(at > 0, symbols[np.maximum(at - 1, 0)], -1).tolist()
        at, stack = at.tolist(), []
        for r, height in enumerate([*lcp[run].tolist(), 0]):
            occurrences, left = 1, before[r]
            while stack and stack[-1][0] > height:
                deep, more, other = stack.pop()
                occurrences, left = occurrences + more, left if left == other else _MIXED
                if left == _MIXED:
                    out.append((at[r], deep, occurrences))
            if stack and stack[-1][0] == height:
                _, more, other = stack.pop()
                occurrences, left = occurrences + more, left if left == other else _MIXED
            stack.append((height, occurrences, left))
    return np.array(out, np.int64).reshape(-1, 3)


def _word_symbols(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words of the texts, disjoint between texts, and the number of words of each."""
    symbols, lengths, base = [], [], 0
    for text in texts:
        words = utf8(text or "").split()
        number = dict(zip(dict.fromkeys(words), count(base)))
        symbols.extend(map(number.__getitem__, words))
        lengths.append(len(words))
        base += len(number)
    return np.array(symbols, np.int64), np.array(lengths, np.int64)


def _per_text(values: np.ndarray, lengths: np.ndarray, ufunc: np.ufunc) -> np.ndarray:
    out = np.zeros(len(lengths), np.int64)
    full = np.flatnonzero(lengths)
    if len(full):
        out[full] = ufunc.reduceat(values, (np.cumsum(lengths) - lengths)[full])
    return out


_HAS_WORD = re.compile(rf"[^{WORD_SPACES}]")


def _dup_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if _HAS_WORD.search(line)]
    return len(lines) - len(set(lines))


def repetition_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    window: int = WINDOW,
    max_window_percent: int = MAX_WINDOW_PERCENT,
    min_repeat: int = MIN_REPEAT,
    max_covered_percent: int = MAX_COVERED_PERCENT,
    max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """Counts and verdict of every text.

    Base: fewer than ``min_words`` words, or more than ``max_window_percent`` of them in windows of ``window`` words that
    occur twice, fails. Method: repeats of at least ``min_repeat`` words may cover at most ``max_covered_percent`` of the
    words, and none may be longer than ``max_longest`` words. ``n_repeats`` counts the maximal repeats of that length.

    A null or empty text has no words and fails the base rule. A null id stays null. Rows are judged one by one, so
    repeated rows give repeated results; further columns are ignored; an empty table gives an empty result. Texts of
    any length are read whole.
    """

    def work(batch: pa.RecordBatch):
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for some_ids, some in text_slices(ids, texts, SLICE_CHARS):
            yield pa.RecordBatch.from_arrays(judge(some_ids, some), names=[x.split()[0] for x in RESULT.split(", ")])

    def judge(ids: list, texts: list) -> list[pa.Array]:
        symbols, n_words = _word_symbols(texts)
        array, lcp = intervals(symbols)
        reach = deepest(array, lcp)
        repeat_words = _per_text(covered(reach, window), n_words, np.add)
        starts, lengths = union_spans(covered(reach, min_repeat), n_words)
        ends = np.cumsum(n_words)
        in_repeats = np.bincount(np.searchsorted(ends, starts, "right"), lengths, len(ends)).astype(np.int64)
        longest = _per_text(reach, n_words, np.maximum)
        repeats = maximal_repeats(array, lcp, symbols, min_repeat)
        n_repeats = np.bincount(np.searchsorted(ends, repeats[:, 0], "right"), minlength=len(ends))
        whole = [t or "" for t in texts]
        chars = np.array([len(t) - sum(map(t.count, WORD_SPACES)) for t in whole], np.int64)
        marks = np.array([sum(map(t.count, SYMBOLS)) for t in whole], np.int64)
        lines = np.array([_dup_lines(t) for t in whole], np.int64)
        base = (n_words < min_words) | (100 * repeat_words > max_window_percent * n_words)
        fine = ~base & (100 * in_repeats <= max_covered_percent * n_words) & (longest <= max_longest)
        columns = [n_words, chars, marks, lines, repeat_words, base, fine, in_repeats, longest, n_repeats]
        return [pa.array(ids, pa.int64()), *map(pa.array, columns)]

    return map_rows(doc_columns(docs, id_col, text_col), work, RESULT)


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_repeat: int = MIN_REPEAT
) -> DataFrame:
    """The union of all occurrences of all maximal repeats of a text, as spans of words counted from 0.

    Spans of one text do not touch, and none is longer than its text. Texts without repeats, null texts and empty ones
    give no row; repeated rows give repeated spans; further columns are ignored.
    """

    def work(batch: pa.RecordBatch):
        for ids, texts in text_slices(batch.column(0).to_pylist(), batch.column(1).to_pylist(), SLICE_CHARS):
            symbols, n_words = _word_symbols(texts)
            starts, lengths = union_spans(covered(deepest(*intervals(symbols)), min_repeat), n_words)
            text = np.searchsorted(np.cumsum(n_words), starts, "right")
            columns = [pa.array(ids, pa.int64()).take(pa.array(text)), starts - (np.cumsum(n_words) - n_words)[text], lengths]
            yield pa.RecordBatch.from_arrays([columns[0], *map(pa.array, columns[1:])], names=[x.split()[0] for x in SPANS.split(", ")])

    return map_rows(doc_columns(docs, id_col, text_col), work, SPANS)
