"""Repetition within texts by suffix arrays over words.

The suffixes of all texts of a batch are sorted at once by prefix doubling: words of different texts get different
numbers, so no match crosses texts, and only suffixes that are still equal to a neighbour are sorted on. The ranks
of each doubling are kept; the longest common prefix of two neighbours is read off them from the longest length down.
In an interval of neighbours with common prefixes every suffix begins a repeated substring, and the larger of its two
neighbours' prefixes is its longest one; those that the suffix before doesn't contain are maximal. The union of
their spans gives the covered words.

Defined cases: null and empty texts have no words; texts are judged one by one, whatever their ids; memory is bounded by
`batch_words` and the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_bytes

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def word_numbers(texts: list[list[bytes]]) -> np.ndarray:
    """Numbers of words, equal only for equal words of one text; every text ends with a number of its own."""
    parts, base = [], 0
    for words in texts:
        ids = _Ids()
        part = np.empty(len(words) + 1, np.int64)
        part[:-1] = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        part[-1] = len(ids)
        parts.append(part + base)
        base += len(ids) + 1
    return np.concatenate([*parts, np.empty(0, np.int64)])


def longest_repeats(numbers: np.ndarray, least: int) -> np.ndarray:
    """For every position the length of the longest substring that begins there and occurs elsewhere too; 0 where that is
    shorter than `least`."""
    size = len(numbers)
    result = np.zeros(size, np.int64)
    if size < 2:
        return result
    # The rank of a suffix is the place of the first suffix with the same prefix, in the order of all.
    _, rank, counts = np.unique(numbers, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[rank]
    unsettled, length, levels = np.flatnonzero(np.bincount(rank, minlength=size)[rank] > 1), 1, []
    while len(unsettled):
        levels.append((length, rank.astype(np.int32)))
        after = unsettled + length
        own, following = rank[unsettled], np.where(after < size, rank[np.minimum(after, size - 1)] + 1, 0)
        order = np.argsort(own * (size + 1) + following)
        unsettled, own, following = unsettled[order], own[order], following[order]
        group = np.concatenate(([True], own[1:] != own[:-1]))
        first = group | np.concatenate(([True], following[1:] != following[:-1]))
        place = np.arange(len(unsettled))
        rank = rank.copy()
        rank[unsettled] = own + np.maximum.accumulate(place * first) - np.maximum.accumulate(place * group)
        alone = first & np.append(first[1:], True)
        unsettled, length = unsettled[~alone], length * 2
    usable = [level for length, level in levels if length <= least]
    if not usable or levels[-1][0] * 2 <= least:
        return result
    suffixes = np.empty(size, np.int64)
    suffixes[rank] = np.arange(size)
    close = np.flatnonzero(usable[-1][suffixes[:-1]] == usable[-1][suffixes[1:]])
    sides = suffixes[close], suffixes[close + 1]
    left, right = sides[0].copy(), sides[1].copy()
    for length, level in reversed(levels):
        fits = np.flatnonzero((left < size) & (right < size))
        fits = fits[level[left[fits]] == level[right[fits]]]
        left[fits] += length
        right[fits] += length
    for side in sides:
        result[side] = np.maximum(result[side], left - sides[0])
    result[result < least] = 0
    return result


def maximal_spans(repeats: np.ndarray) -> np.ndarray:
    """Positions whose longest repeat isn't part of that of the position before."""
    before = np.concatenate(([0], repeats[:-1]))
    return np.flatnonzero((repeats > 0) & (before != repeats + 1))


def covered(repeats: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Whether a maximal repeat covers a position."""
    ends = np.zeros(len(repeats) + 1, np.int64)
    np.add.at(ends, begins, 1)
    np.add.at(ends, begins + repeats[begins], -1)
    return np.cumsum(ends[:-1]) > 0


def merged_runs(inside: np.ndarray) -> list[int]:
    """Begin and end of each run, one after the other."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    return edges.tolist()


def code_points(words: list[bytes]) -> np.ndarray:
    """How many code points each word has."""
    if not words:
        return np.zeros(0, np.int64)
    begins = np.frombuffer(b"".join(words), np.uint8) & 0xC0 != 0x80
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    return np.diff(np.concatenate(([0], np.cumsum(begins)))[np.concatenate(([0], ends))])


def repetition(docs: DataFrame, key: str, text: str, *, least: int = 5, short: int = 3, batch_words: int = 400_000) -> DataFrame:
    """One row per row of docs: key, n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word
    that equal an earlier line), n_repeat_words (words in repeated substrings of at least `least` words), covered_chars (code points in words that lie
    in repeated substrings of at least `short` words, at most `least`), longest_repeat (words, of those of `short` at least) and repeat_spans (begin and end
    of the runs of words that repeats of `least` cover)."""
    if not 0 < short <= least:
        raise ValueError("short repeats must not be longer than others")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_chars", "longest_repeat"]
    layout = f"key {docs.schema[key].dataType.simpleString()}, {', '.join(f'{c} bigint' for c in counts)}, repeat_spans array<bigint>"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, rows, size = [], [], [], 0

        def flush():
            repeats = longest_repeats(word_numbers(texts), short)
            longer = np.where(repeats < least, 0, repeats)
            inside, near = (covered(r, maximal_spans(r)) for r in (longer, repeats))
            at, columns, spans = 0, [], []
            for words, row in zip(texts, rows):
                part = slice(at, at + len(words))
                spans.append(merged_runs(inside[part]) if inside[part].any() else [])
                chars = int(code_points(words)[near[part]].sum()) if near[part].any() else 0
                columns.append((*row, int(inside[part].sum()), chars, int(repeats[part].max(initial=0))))
                at += len(words) + 1
            arrays = [pa.array(c, pa.int64()) for c in zip(*columns)]
            return pa.RecordBatch.from_arrays([pa.array(keys, key_type), *arrays, pa.array(spans, pa.list_(pa.int64()))], names=["key", *counts, "repeat_spans"])

        for batch in batches:
            key_type = batch.column("key").type
            for value, content in zip(batch.column("key").to_pylist(), as_bytes(batch.column("text"))):
                words = content.split()
                lines = [line for line in content.split(b"\n") if line.strip()]
                solid = np.frombuffer(content.translate(None, SPACE), np.uint8)
                chars = int(np.count_nonzero(solid & 0xC0 != 0x80))
                rows.append((len(words), chars, len(content) - len(content.translate(None, SYMBOLS)), len(lines) - len(set(lines))))
                keys.append(value)
                texts.append(words)
                size += len(words) + 1
                if size >= batch_words:
                    yield flush()
                    keys, texts, rows, size = [], [], [], 0
        if keys:
            yield flush()

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(measure, layout).withColumnRenamed("key", key)
