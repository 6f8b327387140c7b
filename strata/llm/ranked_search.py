"""Ranked lexical search, a term at a time with a limit on accumulators.

The index is partitioned by documents: a block holds a bounded number of words of whole documents, and in it each term has one posting list with the
document's numbers and the occurrences there. It is built over all terms of all documents, written to the shared folder and can be
searched again. A search reads the lists of the terms asked for and brings them together by block; there every query is answered by
itself:

1. Its terms are taken from the rarest to the most frequent. Each list adds to the accumulators of its documents.
2. Before each list the kth highest partial score is known. Once all lists still to come can't add up to it, a document that has no accumulator yet
   can't get among the first k, so no more are created. A list's bound is its highest value in the block.
3. From there on only documents with an accumulator are updated, and exactly: they are looked up in the lists by binary search.

The first k of all blocks are those of the whole. The first blocks searched give each query a score that k documents are known to reach; for the other
blocks this is the least partial score from the beginning, so that most of them create few accumulators or none.

Queries are sent to the tasks in chunks of at most `chunk_terms` terms, which bounds what is collected and sent; a larger set takes more passes.

Defined cases: null and empty texts have no terms and are never found, but null ids are kept as they are; of equal scores the smaller id is first, null before all,
and rows with one id are documents of their own; a query without terms, or with none that occurs, has no rows; equal query ids are
searched apart, as rows of their own.
"""

from __future__ import annotations

import itertools
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import UPPER, as_bytes, ascii_lower, saved

#: What a term is made of, as a pattern and as a table of bytes that are blanks outside of terms.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in bytes(range(256)).lower())

#: Fixed values of the score: its scale, and how much a document's length counts, in hundredths.
SCALE, LENGTH_SHARE = 1_000_000_000, 90


def build_index(docs: DataFrame, key: str, text: str, block_words: int = 1_000_000) -> DataFrame:
    """Rows block, term, df, docs, tfs (posting lists, numbers of documents ascending as 32-bit integers), and for each block one row without
    a term: keys and sizes (terms with repeats) of its documents that have any."""
    kind = docs.schema[key].dataType.simpleString()
    layout = f"block bigint, term string, df bigint, docs binary, tfs binary, keys array<{kind}>, sizes array<bigint>"

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 32)

        def block(key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            schema = pa.schema([
                ("block", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("docs", pa.binary()), ("tfs", pa.binary()),
                ("keys", pa.list_(key_type)), ("sizes", pa.list_(pa.int64())),
            ])
            own, m = next(number), len(terms)
            where = np.repeat(np.arange(len(sizes)), np.frombuffer(sizes, np.int32))
            spots, tfs = np.unique(np.frombuffer(found, np.int32) * np.int64(len(sizes)) + where, return_counts=True)
            term, doc = np.divmod(spots, len(sizes))
            ends = np.searchsorted(term, np.arange(m + 1))
            lists = [
                pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(values.astype(np.int32))])
                for values in (doc, tfs)
            ]
            names = pa.array(list(terms), pa.binary()).cast(pa.string())
            columns = [pa.array(np.full(m, own)), names, pa.array(np.diff(ends)), *lists, pa.nulls(m, schema.field("keys").type), pa.nulls(m, schema.field("sizes").type)]
            yield from pa.table(columns, schema).to_batches(65_536)
            yield pa.RecordBatch.from_arrays(
                [pa.array([own]), *[pa.nulls(1, schema.field(i).type) for i in range(1, 5)], pa.array([keys], schema.field("keys").type), pa.array([list(sizes)], schema.field("sizes").type)],
                schema=schema,
            )

        def anew():
            count = itertools.count()
            return array("i"), array("i"), [], defaultdict(count.__next__)

        found, sizes, keys, terms = anew()
        for batch in batches:
            key_type = batch.column("key").type
            for own, content in zip(batch.column("key").to_pylist(), as_bytes(batch.column("text"))):
                words = content.translate(_FOLD).split()
                if words:
                    found.extend(map(terms.__getitem__, words))
                    sizes.append(len(words))
                    keys.append(own)
                    if len(found) >= block_words:
                        yield from block(key_type)
                        found, sizes, keys, terms = anew()
        if found:
            yield from block(key_type)

    return saved(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(blocks, layout), "index")


class Block:
    """The documents of a block and the posting lists that were asked for."""

    def __init__(self, sizes: np.ndarray, lists: dict[int, tuple[np.ndarray, np.ndarray]], n_docs: int, n_terms: int):
        norm = 8 * (100 - LENGTH_SHARE + LENGTH_SHARE * sizes * n_docs // n_terms)
        self.values = {t: (docs, SCALE * tfs.astype(np.int64) // (1000 * tfs.astype(np.int64) + norm[docs])) for t, (docs, tfs) in lists.items()}
        self.bounds = {t: int(values.max()) for t, (_, values) in self.values.items()}
        self.scores = np.zeros(len(sizes), np.int64)
        #: How many accumulators were made, and how many documents were only looked up.
        self.made = self.looked_up = 0

    def search(self, terms: list[tuple[int, int]], k: int, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of documents among which are the k best of the block that reach `least`; `terms` are (term, weight), the rarest first."""
        terms = [(t, w) for t, w in terms if t in self.values]
        left = sum(w * self.bounds[t] for t, w in terms)
        scores, survivors, at = self.scores, np.zeros(0, np.int64), 0
        reached = max(least, 1)
        while at < len(terms) and left >= reached:
            term, weight = terms[at]
            docs, values = self.values[term]
            survivors = np.union1d(survivors, docs[scores[docs] == 0])
            scores[docs] += weight * values
            left -= weight * self.bounds[term]
            at += 1
            if len(survivors) >= k:
                reached = max(reached, int(np.partition(scores[survivors], -k)[-k]))
        self.made += len(survivors)
        for term, weight in terms[at:]:
            docs, values = self.values[term]
            spots = np.searchsorted(docs, survivors)
            there = spots < len(docs)
            there[there] = docs[spots[there]] == survivors[there]
            scores[survivors[there]] += weight * values[spots[there]]
            self.looked_up += len(survivors)
        result = scores[survivors]
        scores[survivors] = 0
        good = result >= max(least, 1)
        survivors, result = survivors[good], result[good]
        if len(result) > k:
            good = result >= np.partition(result, -k)[-k]
            survivors, result = survivors[good], result[good]
        return survivors, result


def _search_blocks(lists: DataFrame, queries: list[tuple[int, list[tuple[int, int]], int]], k: int, n_docs: int, n_terms: int, key: str) -> DataFrame:
    """Rows query, key, score: the best of each block of lists. `queries` are (query, its terms by rarity, least score)."""
    kind = lists.schema["keys"].dataType.elementType.simpleString()

    def search(table: pa.Table) -> pa.Table:
        rows = table.column("number").to_numpy(zero_copy_only=False)
        whole = table.column("sizes").combine_chunks()
        own = int(np.flatnonzero(whole.is_valid().to_numpy(zero_copy_only=False))[0])
        keys = table.column("keys").combine_chunks()[own].values
        numbers = [np.frombuffer(b"" if x is None else x, np.int32) for c in ("docs", "tfs") for x in table.column(c).to_pylist()]
        docs, tfs = numbers[: len(rows)], numbers[len(rows) :]
        found = {int(rows[i]): (docs[i], tfs[i]) for i in range(len(rows)) if i != own}
        block = Block(whole[own].values.to_numpy(), found, n_docs, n_terms)
        hits = [(query, *block.search(terms, k, least)) for query, terms, least in queries]
        spots = np.concatenate([h[1] for h in hits]) if hits else np.zeros(0, np.int64)
        scores = np.concatenate([h[2] for h in hits]) if hits else np.zeros(0, np.int64)
        query = np.repeat([h[0] for h in hits], [len(h[1]) for h in hits]).astype(np.int64)
        return pa.table({"query": query, key: keys.take(pa.array(spots.astype(np.int64))), "score": scores})

    own = lists.select("block", "number", "docs", "tfs", "keys", "sizes")
    return own.groupBy("block").applyInArrow(search, f"query bigint, `{key}` {kind}, score bigint")


def search(
    index: DataFrame,
    queries: DataFrame,
    query_key: str,
    query_text: str,
    key: str = "doc_id",
    *,
    k: int = 10,
    first_share: int = 16,
    chunk_terms: int = 200_000,
) -> DataFrame:
    """The k best documents of every query: query_key, rank, key, score. One in `first_share` blocks is searched first."""
    spark = index.sparkSession
    n_docs, n_terms = index.where("sizes is not null").agg(
        F.sum(F.size("sizes")), F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x))
    ).first()
    term_list = F.array_distinct(F.regexp_extract_all(ascii_lower(F.coalesce(F.col(f"`{query_text}`"), F.lit(""))), F.lit(f"({TERM})")))
    # A number first, in a step of its own: beside the generator each term would get one.
    numbered = queries.select(query_key, query_text).withColumns({"_query": F.monotonically_increasing_id(), "_terms": term_list})
    asked = saved(numbered.select(F.col("_query").alias("query"), F.col(f"`{query_key}`").alias("_id"), F.explode("_terms").alias("term")), "queries")
    names = asked.select("query", "_id").distinct()
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), F.asc(key)))
    layout = f"query bigint, `{key}` {index.schema['keys'].dataType.elementType.simpleString()}, score bigint"
    best = spark.createDataFrame([], layout)
    if n_docs:
        terms = saved(asked.select("term").distinct().withColumn("number", F.monotonically_increasing_id()), "terms")
        lists = saved(index.where("term is not null").join(terms, "term"), "lists")
        # In doubles, as everything that follows is in integers.
        weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("bigint")
        weights = lists.groupBy("term", "number").agg(F.sum("df").alias("df")).withColumn("weight", weight)
        by_rarity = F.array_sort(F.collect_list(F.struct("df", "number", "weight")))
        ordered = asked.join(weights, "term").groupBy("query").agg(by_rarity.alias("terms"))
        # Queries by chunks: a running sum of their terms, over narrow rows of the query set only.
        size = F.sum(F.size("terms")).over(W.orderBy("query").rowsBetween(W.unboundedPreceding, -1))
        ordered = saved(ordered.withColumn("chunk", F.floor(F.coalesce(size, F.lit(0)) / chunk_terms)), "ordered")
        whole = index.where("sizes is not null").withColumn("number", F.lit(-1).cast("bigint"))
        columns = ["block", "number", "docs", "tfs", "keys", "sizes"]
        first = F.pmod(F.xxhash64("block"), F.lit(first_share)) == 0
        for chunk in [r[0] for r in ordered.select("chunk").distinct().collect()]:
            rows = ordered.where(F.col("chunk") == chunk).select("query", "terms").collect()
            sent = [(r.query, [(t.number, t.weight) for t in r.terms]) for r in rows]
            blocks = lists.select(*columns).union(whole.select(*columns))
            early = saved(_search_blocks(blocks.where(first), [(q, t, 0) for q, t in sent], k, n_docs, n_terms, key), "found")
            ranked = early.withColumn("rank", rank).where(F.col("rank") == k)
            least = {r.query: r.score for r in ranked.select("query", "score").collect()}
            late = _search_blocks(blocks.where(~first), [(q, t, least.get(q, 0)) for q, t in sent], k, n_docs, n_terms, key)
            best = best.union(early).union(saved(late, "found"))
    ranked = best.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.join(names, "query").select(F.col("_id").alias(query_key), "rank", key, "score")
