"""Benchmark decontamination over a distributed positional inverted index.

The index is cut by documents into blocks of a bounded number of tokens. A row holds the postings of one term in one
block: the gaps between its ascending positions, where the documents of a block stand one after the other. The row of
the empty term holds the places where documents begin. A phrase is looked for only in the blocks that hold its rarest
term; there the lists of its terms are moved by their offsets and intersected from the rarest on.

Defined cases: null and empty texts have no words and no hits; rows with the same key are judged one by one; phrases
without words are left out; repeated phrases are looked up once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import as_bytes, ascii_lower, saved

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_KEEP = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
#: A byte to itself in lower case where it belongs to a word, else to a space; bytes of other than ASCII are of words.
FOLD = bytes(c if c in _KEEP else 32 for c in bytes(range(256)).lower())


def split_words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def word_array(text: Column) -> Column:
    """The same words by built-in functions."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


@dataclass(frozen=True)
class Index:
    """postings: block, term, n, gaps. documents: block, ord, key, n_words."""

    postings: DataFrame
    documents: DataFrame


def build_index(docs: DataFrame, key: str, text: str, block_tokens: int = 1 << 21) -> Index:
    """Index every word of every text. A task begins a new block once one has `block_tokens` tokens; a document
    is never cut, so a block is bounded by that number and its last document."""
    key_type = docs.schema[key].dataType.simpleString()
    layout = f"block string, key {key_type}, ord int, n_words bigint, term string, n bigint, gaps array<int>"

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids, tokens, keys, sizes, size, key_arrow = _Ids(), [], [], [], 0, None

        def rows(size, **columns):
            block = pa.array([f"{task}-{number}"] * size)
            empty = {"key": key_arrow, "ord": pa.int32(), "n_words": pa.int64(), "term": pa.string(), "n": pa.int64(), "gaps": pa.list_(pa.int32())}
            arrays = {c: columns[c] if c in columns else pa.nulls(size, kind) for c, kind in empty.items()}
            return pa.RecordBatch.from_arrays([block, *arrays.values()], names=["block", *arrays])

        def flush():
            n = len(sizes)
            yield rows(n, key=pa.array(keys, key_arrow), ord=pa.array(np.arange(n, dtype=np.int32)), n_words=pa.array(sizes, pa.int64()))
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int32)
            where = np.concatenate(tokens) if tokens else np.empty(0, np.int32)
            order = np.argsort(where, kind="stable").astype(np.int32)
            counts = np.bincount(where, minlength=len(ids))
            ends = np.cumsum(counts)
            gaps = np.diff(order, prepend=np.int32(0)).astype(np.int32)
            first = ends - counts
            gaps[first] = order[first]
            terms = pa.array([b"", *ids], pa.binary()).cast(pa.string())
            offsets = pa.array(np.concatenate(([0, n], n + ends)).astype(np.int32))
            values = pa.array(np.concatenate((np.diff(starts, prepend=np.int32(0)), gaps)).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, values)
            counted = pa.array(np.concatenate(([n], counts)).astype(np.int64))
            for at in range(0, len(terms), 50_000):
                part = slice(at, at + 50_000)
                yield rows(len(terms[part]), term=terms[part], n=counted[part], gaps=lists[part])

        for batch in batches:
            key_arrow = batch.column("key").type
            for value, content in zip(batch.column("key").to_pylist(), as_bytes(batch.column("text"))):
                words = split_words(content)
                keys.append(value)
                sizes.append(len(words))
                size += len(words)
                if words:
                    tokens.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
                if size >= block_tokens:
                    yield from flush()
                    number += 1
                    ids, tokens, keys, sizes, size = _Ids(), [], [], [], 0
        if keys:
            yield from flush()

    rows = saved(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(index, layout), "index")
    return Index(
        rows.where(F.col("term").isNotNull()).select("block", "term", "n", "gaps"),
        rows.where(F.col("term").isNull()).select("block", "ord", "key", "n_words"),
    )


def _positions(gaps) -> np.ndarray:
    return np.cumsum(np.asarray(gaps, np.int64))


def _exact(lists: list[np.ndarray], offsets: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of a phrase; lists and offsets stand from the rarest term on."""
    starts = lists[0] - offsets[0]
    for positions, offset in zip(lists[1:], offsets[1:]):
        if not len(starts):
            break
        wanted = starts + offset
        at = np.searchsorted(positions, wanted)
        at[at == len(positions)] = 0
        starts = starts[positions[at] == wanted]
    return starts, starts + len(lists)


def _near(lists: list[np.ndarray], slack: int, rarest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends where the terms follow each other with at most `slack` other words between two of them; for each
    end the latest start. Lists stand in the order of the phrase and are first cut to the surroundings of the rarest."""
    reach, anchors = (len(lists) - 1) * (slack + 1), lists[rarest]
    near = []
    for positions in lists:
        at = np.searchsorted(anchors, positions - reach)
        close = at < len(anchors)
        close[close] = anchors[at[close]] <= positions[close] + reach
        near.append(positions[close])
    ends, starts = near[0], near[0]
    for positions in near[1:]:
        before = np.searchsorted(ends, positions) - 1
        fits = before >= 0
        fits[fits] = positions[fits] - ends[before[fits]] <= slack + 1
        starts, ends = starts[before[fits]], positions[fits]
    return starts, ends + 1


def find_phrases(index: Index, phrases: DataFrame, slack: int | None = None) -> DataFrame:
    """Occurrences of phrases (phrase_id, words array) as rows phrase_id, block, ord, start, stop (words of a document).

    Without `slack` the words must follow each other; with it, up to that many other words may stand between two.
    """
    terms = saved(phrases.where(F.size("words") > 0).select("phrase_id", F.posexplode("words").alias("offset", "term")), "phrase-terms")
    vocabulary = saved(terms.select("term").distinct(), "vocabulary")
    held = saved(index.postings.join(vocabulary, "term"), "held-postings")
    frequent = held.groupBy("term").agg(F.sum("n").alias("freq"))
    by_rarity = F.array_sort(F.collect_list(F.struct("freq", "offset", "term"))).alias("terms")
    ranked = terms.join(frequent, "term", "left").groupBy("phrase_id").agg(by_rarity, F.bool_and(F.col("freq").isNotNull()).alias("all_known"))
    ranked = saved(ranked.where("all_known").select("phrase_id", F.col("terms.term").alias("terms"), F.col("terms.offset").alias("offsets")), "ranked-phrases")
    rarest = ranked.select("phrase_id", F.get("terms", F.lit(0)).alias("term"))
    blocks = rarest.join(held.select("term", "block"), "term").select("phrase_id", "block")
    needed = saved(blocks.join(ranked, "phrase_id").select("block", "phrase_id", "terms", "offsets"), "lookups")
    starts = needed.select("block").distinct().select("block", F.lit("").alias("term"))
    wanted = needed.select("block", F.explode("terms").alias("term")).distinct()
    lists = held.join(wanted, ["block", "term"], "left_semi").select("block", "term", "gaps")
    begins = index.postings.where(F.col("term") == "").join(starts, ["block", "term"], "left_semi").select("block", "term", "gaps")
    id_type = phrases.schema["phrase_id"].dataType.simpleString()

    def intersect(needed: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
        known = {term: _positions(gaps) for term, gaps in zip(lists["term"], lists["gaps"])}
        begins, held, found = known.pop("", np.empty(0, np.int64)), known.keys(), []
        for phrase_id, terms, offsets in zip(needed["phrase_id"], needed["terms"], needed["offsets"]):
            if not held >= set(terms):
                continue
            if slack is None:
                first, stop = _exact([known[t] for t in terms], offsets)
            else:
                order = np.argsort(offsets)
                first, stop = _near([known[terms[i]] for i in order], slack, int(offsets[0]))
            if len(first):
                found.append((phrase_id, first, stop))
        first, stop = (np.concatenate([np.empty(0, np.int64), *[f[i] for f in found]]).astype(np.int64) for i in (1, 2))
        own = np.repeat(np.arange(len(found)), [len(f[1]) for f in found])
        doc = np.searchsorted(begins, first, side="right") - 1
        inside = (doc >= 0) & (doc == np.searchsorted(begins, stop - 1, side="right") - 1)
        own, doc, first, stop = own[inside], doc[inside], first[inside], stop[inside]
        block = needed["block"].iloc[0] if len(needed) else ""
        # Plain objects: texts of pandas' own kind may come in several chunks, or in none, which Spark doesn't take.
        names = {c: pd.Series(values, dtype=object) for c, values in (("phrase_id", [found[i][0] for i in own]), ("block", [block] * len(own)))}
        return pd.DataFrame({**names, "ord": doc, "start": first - begins[doc], "stop": stop - begins[doc]})

    pairs = needed.groupBy("block").cogroup(lists.unionByName(begins).groupBy("block"))
    return pairs.applyInPandas(intersect, f"phrase_id {id_type}, block string, ord int, start bigint, stop bigint")


def item_windows(items: DataFrame, item: str, text: str, width: int = 10) -> DataFrame:
    """Windows of `width` consecutive words as rows item_id, phrase_id, words; fewer words are one window."""
    words = items.select(F.col(f"`{item}`").alias("item_id"), word_array(F.col(f"`{text}`")).alias("_words")).where(F.size("_words") > 0)
    begin = F.explode(F.sequence(F.lit(1), F.greatest(F.size("_words") - width + 1, F.lit(1))))
    rows = words.select("item_id", "_words", begin.alias("_at")).select("item_id", F.slice("_words", F.col("_at"), width).alias("words"))
    return rows.select("item_id", F.sha2(F.concat_ws(" ", "words"), 256).alias("phrase_id"), "words").distinct()


def contamination(docs: DataFrame, key: str, text: str, items: DataFrame, item: str, item_text: str, width: int = 10) -> DataFrame:
    """One row per row of docs: key, n_words, n_hit (words inside occurrences of windows), n_items, items_sha256.

    Items without an id count for hits, not among the items.
    """
    index = build_index(docs, key, text)
    windows = saved(item_windows(items, item, item_text, width), "windows")
    found = saved(find_phrases(index, windows.select("phrase_id", "words").dropDuplicates(["phrase_id"])), "matches")
    spot = ["block", "ord"]
    before = W.partitionBy(*spot).orderBy("start", "stop").rowsBetween(W.unboundedPreceding, -1)
    spans = found.select(*spot, "start", "stop").distinct().withColumn("_done", F.coalesce(F.max("stop").over(before), F.lit(0)))
    hits = spans.groupBy(*spot).agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "_done"))).alias("n_hit"))
    owners = found.select(*spot, "phrase_id").distinct().join(windows.select("phrase_id", F.col("item_id").cast("string").alias("_item")), "phrase_id")
    named = owners.groupBy(*spot).agg(F.array_sort(F.collect_set("_item")).alias("_items"))
    joined = index.documents.join(hits, spot, "left").join(named, spot, "left")
    listed = F.coalesce("_items", F.array().cast("array<string>"))
    return joined.select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(listed).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
    )
