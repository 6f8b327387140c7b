"""Phrase collocations by set-oriented mining of relations (SETM).

The relation R1 holds every occurrence of a word: its place, ascending through pieces and words, and its item. Two
places that differ by one are neighbours in a piece; between pieces one place is left out. R(k) is R(k-1) merge-joined with itself on
the next place, so its rows are occurrences of phrases of k words. Occurrences are counted by group; only those of frequent groups stay (a
semi-join) before the next length is made. A phrase can't be more frequent than its parts, so nothing is lost.

Relations are written to the shared folder, sorted by place, in blocks of a bounded number of words; pieces lie in one block. In a
block an item is a number, and a small relation says which group a number stands for and how often it occurs. Only
that one is dealt out by group: even the most frequent one has one row per block there, not one per occurrence. So counts are summed
where the rows of a group meet, and frequent groups come back to the blocks as numbers. A relation is removed once the next one is written.

Defined cases: null and empty texts have no words; a null language counts as `und`; repeated rows count each time; ties are broken by the phrase.
A text without separators is one piece however long it is, and lies in one block. Other columns are not looked at.
"""

from __future__ import annotations

import itertools
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import UPPER, as_bytes, kept, saved, shuffle_partitions
from strata.sinks.layers import remove_folders

#: What ends a piece, and what stands between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
_FOLD = bytes.maketrans(UPPER.encode() + PIECE_ENDS + BLANKS, UPPER.lower().encode() + b"\n" * len(PIECE_ENDS) + b" " * len(BLANKS))

#: A row number is that of its block and that of its item there, in so many bits; a block's that of its task and a count, in so many bits.
ITEM_BITS, COUNT_BITS = 26, 15

#: Scores, of up to a million, are counted in steps of so many.
STEP = 500

_RELATION = [("n", pa.int64()), ("places", pa.binary()), ("items", pa.binary())]
WORDS = pa.schema([("row", pa.int64()), ("lang", pa.string()), ("word", pa.string()), *_RELATION])
PHRASES = pa.schema([("row", pa.int64()), ("first", pa.int64()), ("rest", pa.int64()), *_RELATION])
_TYPES = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"`{f.name}` {_TYPES[f.type]}" for f in schema)


def _packed(numbers: np.ndarray) -> bytes:
    return pa.compress(numbers.astype(np.int32).tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, decompressed_size=4 * n, codec="zstd", asbytes=True), np.int32)


def _block(schema: pa.Schema, block: int, groups: dict, counts: np.ndarray, places: np.ndarray, items: np.ndarray) -> pa.Table:
    """A row for each group of a block, then one with the sorted relation: how far each place is from the one before, and the items."""
    m = len(counts)
    if m > 1 << ITEM_BITS:
        raise ValueError("a piece with more different words than a row number can tell apart")
    columns = {"row": (block << ITEM_BITS) + np.arange(m), "n": counts.astype(np.int64), **groups}
    own = pa.table([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(m, f.type) for f in schema], schema)
    relation = {"row": block << ITEM_BITS, "n": len(places), "places": _packed(np.diff(places, prepend=0)), "items": _packed(items)}
    return own if len(places) == 0 else pa.concat_tables([own, pa.Table.from_pylist([relation], schema)])


def occurrences(docs: DataFrame, text: str, lang: str, block_words: int) -> DataFrame:
    """R1 in blocks: rows row, lang, word, n for the words of a block, and a row row (of its first item), n, places, items."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = iter(range(TaskContext.get().partitionId() << COUNT_BITS, TaskContext.get().partitionId() + 1 << COUNT_BITS))

        def block() -> pa.Table:
            items = np.frombuffer(found, np.int32)
            places = np.arange(len(items)) + np.repeat(np.arange(len(sizes)), np.frombuffer(sizes, np.int32))
            names = [(own, word, item) for own, words in known.items() for word, item in words.items()]
            names.sort(key=lambda x: x[2])
            groups = {"lang": [x[0] for x in names], "word": pa.array([x[1] for x in names], pa.binary()).cast(pa.string())}
            return _block(WORDS, next(number), groups, np.bincount(items, minlength=len(names)), places, items)

        def anew():
            count = itertools.count()
            return array("i"), array("i"), defaultdict(lambda: defaultdict(count.__next__))

        found, sizes, known = anew()
        for batch in batches:
            for own, content in zip(batch.column("lang").to_pylist(), as_bytes(batch.column("text"))):
                numbers = known[own]
                for piece in content.translate(_FOLD).split(b"\n"):
                    words = piece.split()
                    if words:
                        found.extend(map(numbers.__getitem__, words))
                        sizes.append(len(words))
                        if len(found) >= block_words:
                            yield from block().to_batches()
                            found, sizes, known = anew()
                            numbers = known[own]
        if found:
            yield from block().to_batches()

    rows = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(blocks, _ddl(WORDS))


def _longer(relation: DataFrame, frequent: DataFrame, last: bool) -> DataFrame:
    """The next relation: occurrences whose item is one of `frequent` (row, id), merge-joined with themselves on the next place. Of the last one only
    the groups are kept."""

    def extend(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return PHRASES.empty_table()
        row = left.to_pylist()[0]
        places, items = np.cumsum(_unpacked(row["places"], row["n"])), _unpacked(row["items"], row["n"])
        ids, own = right.column("id").to_numpy(), right.column("row").to_numpy() & (1 << ITEM_BITS) - 1
        among = np.full(max(items.max(), own.max()) + 1, -1, np.int64)
        among[own] = np.arange(len(own))
        stays = among[items] >= 0
        places, items = places[stays], among[items[stays]]
        at = np.flatnonzero(places[1:] == places[:-1] + 1)
        pairs, numbers, counts = np.unique(items[at] * len(ids) + items[at + 1], return_inverse=True, return_counts=True)
        first, rest = np.divmod(pairs, len(ids))
        at = at[:0] if last else at
        return _block(PHRASES, key[0].as_py(), {"first": ids[first], "rest": ids[rest]}, counts, places[at], numbers)

    left = relation.where("places is not null").select("row", "n", "places", "items")
    block = F.shiftright("row", ITEM_BITS)
    left, right = left.withColumn("block", block), frequent.select(F.col("row").alias("row"), "id", block.alias("of"))
    return left.groupBy("block").cogroup(right.groupBy("of")).applyInArrow(extend, _ddl(PHRASES))


def _score(a: Column, left: Column, right: Column) -> Column:
    """In decimals of 38 digits: exact for counts of up to ten to the 16th."""
    a, left, right = (x.cast("decimal(16,0)") for x in (a, left, right))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a), left * right)


def _cuts(length: int) -> Column:
    """The cut with the lowest score, of equal ones the first."""
    cuts = []
    for k in range(1, length):
        left, right = F.col("heads")[k - 1], F.col("tails")[length - k - 1]
        cuts.append(F.struct(F.floor(_score(F.col("a"), left, right)).cast("bigint").alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    return F.array_min(F.array(*cuts))


def _frequent(relation: DataFrame, keys: tuple[str, str], least: int) -> tuple[DataFrame, str]:
    """Rows row, keys, a, id of the groups with at least `least` occurrences in all blocks, and where they are kept. A group's id is the first of
    its row numbers, so that its rows meet only once."""
    rows = relation.where(F.col(keys[0]).isNotNull()).select("row", *keys, "n")
    same = W.partitionBy(*keys)
    counted = rows.withColumns({"a": F.sum("n").over(same), "id": F.min("row").over(same)}).where(F.col("a") >= least)
    return kept(counted.drop("n"), "frequent", "zstd")


def frequent_phrases(docs: DataFrame, text: str, lang: str, longest: int, least: int, block_words: int) -> tuple[list[DataFrame], DataFrame]:
    """For each length the groups with at least `least` occurrences: id, lang, phrase, word (the last), a, heads and tails (occurrences of the
    first and the last 1, 2, ... words), and from two words on first and rest (ids of the phrases without the last and the first word).
    Also lang, n: how many words each language has."""
    one, keys = F.array("a"), ("lang", "word")
    relation, folder = kept(occurrences(docs, text, lang, block_words), "occurrences", "zstd")
    totals = saved(relation.where("word is not null").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    frequent, used = _frequent(relation, keys, least)
    first = frequent.where("row = id").select("id", "lang", F.col("word").alias("phrase"), "word", "a", one.alias("heads"), one.alias("tails"))
    levels = [saved(first, "groups")]
    for length in range(2, longest + 1):
        done, keys = [folder, used], ("first", "rest")
        relation, folder = kept(_longer(relation, frequent.select("row", "id"), length == longest), "occurrences", "zstd")
        remove_folders(docs.sparkSession, done)
        if length < longest:
            frequent, used = _frequent(relation, keys, least)
            groups = frequent.where("row = id").select("id", *keys, "a")
        else:
            # Nothing is longer, so only the counts are needed.
            counts = relation.where("first is not null").groupBy(*keys).agg(F.sum("n").alias("a")).where(F.col("a") >= least)
            groups = counts.select(F.lit(None).cast("bigint").alias("id"), *keys, "a")
        begin = levels[-1].select(F.col("id").alias("first"), "lang", F.col("phrase").alias("_begin"), F.col("heads").alias("_heads"))
        end = levels[-1].select(F.col("id").alias("rest"), "word", F.col("tails").alias("_tails"))
        joined = groups.join(begin, "first").join(end, "rest").select(
            "id", "lang", F.concat_ws(" ", "_begin", "word").alias("phrase"), "word", "a",
            F.concat("_heads", F.array("a")).alias("heads"), F.concat("_tails", F.array("a")).alias("tails"), "first", "rest",
        )
        levels.append(saved(joined, "groups"))
    remove_folders(docs.sparkSession, [folder] if longest > 1 else [folder, used])
    return levels, totals


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    *,
    longest: int = 3,
    least: int = 10,
    within: int = 50,
    top: int = 2000,
    block_words: int = 2_000_000,
) -> DataFrame:
    """The first `top` phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    Candidates have 2 to `longest` words and at least `least` occurrences. A candidate is dropped if a longer one holds it and has `within` percent
    of its occurrences or more. Of all longer ones that hold it, one of one word more has the most occurrences, so it is enough to look at these.
    """
    levels, totals = frequent_phrases(docs, text, lang, longest, least, block_words)
    candidates = None
    for length in range(2, longest + 1):
        own = levels[length - 1]
        if length < longest:
            # A longer phrase knows the counts of its parts, so only those parts come that are dropped.
            parts = [F.when(100 * F.col("a") >= within * F.col(side)[length - 1], F.col(part)) for side, part in (("heads", "first"), ("tails", "rest"))]
            dropped = levels[length].select(F.explode(F.array_compact(F.array(*parts))).alias("id")).distinct()
            own = own.join(dropped, "id", "left_anti")
        scored = own.select("lang", "phrase", "a", _cuts(length).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        candidates = scored if candidates is None else candidates.union(scored)
    candidates = saved(candidates, "candidates")
    # How many candidates of a language have about a score, from the highest on: below where that passes `top`, none can be among the first.
    steps = candidates.groupBy("lang", F.floor(F.col("score") / STEP).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    above = F.coalesce(F.sum("n").over(W.partitionBy("lang").orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    floors = steps.withColumn("_above", above).where(F.col("_above") < top).groupBy("lang").agg((F.min("step") * STEP).alias("_floor"))
    likely = candidates.join(floors, "lang").where(F.col("score") >= F.col("_floor")).drop("_floor")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The first ones of a share of these, then of them: no task sorts all phrases of a language, however many have one score.
    salted = likely.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(docs.sparkSession))))
    best = salted.withColumn("rank", F.row_number().over(W.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= top)
    rank = F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("bigint")
    ranked = best.drop("rank", "_salt").withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
