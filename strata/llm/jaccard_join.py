"""Self-join of texts by the Jaccard similarity of their word n-grams, with rare-first prefix filtering.

1. Every text becomes the set of its shingles as 64-bit hashes. Texts with equal sets are one node from here on.
   Shingles that occur in several sets of one task are counted, and the most frequent ones are ordered last by their
   counts; all others come first, by hash. Any order gives the same links. The table of frequent shingles has a
   fixed size, whatever the input.
2. The prefix of a set, in that order, is such that two sets that link share a shingle of both prefixes. Postings travel
   packed; lists of a single node end there.
3. Nodes that share a prefix shingle are candidates if their sizes fit (length filter), if enough shingles can follow
   the shared one (positional filter), and if their numbers of shingles between fixed pivots leave room for enough
   shared ones (suffix filter). First every node meets one node of each of its lists only, in rounds, as long as many
   pairs of different components are left and a round at least halves them. What these links leave in different
   components meets in pairs, once, so that no link between components is missed, while the pairs within a large
   group of copies are never listed.
4. A candidate pair is verified on the whole texts.

Defined cases: null texts and texts without words have an empty set and link with nothing; texts of fewer words than a
shingle are one shingle; rows with the same id are judged by their own texts; ids may be null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_bytes, release_worker_memory, saved
from strata.llm.components import components

PIVOTS = 32
POSTING = np.dtype([("h", "<i8"), ("node", "<i8"), ("n", "<i4"), ("pos", "<i4")])
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class Shingler:
    """Sorted distinct shingle hashes of texts; words are lower-cased (A-Z) and separated by ASCII white space."""

    def __init__(self, width: int = 5, remembered: int = 300_000):
        self.width, self.remembered = width, remembered
        self.factors = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(width)], np.uint64)
        self.hashes: dict[bytes, int] = {}

    def _words(self, text: bytes) -> np.ndarray:
        import xxhash

        words, known = text.lower().split(), self.hashes
        if len(known) > self.remembered:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def __call__(self, text: bytes) -> np.ndarray:
        words = self._words(text)
        if not len(words):
            return words
        span = min(len(words), self.width)
        mixed = np.full(len(words) - span + 1, span * 0xD6E8FEB86659FD93 % (1 << 64), np.uint64)
        for i in range(span):
            mixed += words[i : len(words) - span + 1 + i] * self.factors[i]
        for factor, shift in zip(_MIX, (30, 27)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        mixed = np.sort(mixed ^ (mixed >> np.uint64(31)))
        return mixed[np.concatenate(([True], mixed[1:] != mixed[:-1]))]


def _ceil_share(n, num: int, den: int):
    return -(-n * num // den)


def signature(hashes: np.ndarray) -> np.ndarray:
    return np.bincount((hashes >> np.uint64(59)).astype(np.int64), minlength=PIVOTS).astype(np.int32)


def build_nodes(docs: DataFrame, id_column: str, text: str, width: int) -> DataFrame:
    """Rows id, text_key, node, node_check, n, parts for every text, and rows shingle, count for repeated shingles."""
    layout = f"id {docs.schema[id_column].dataType.simpleString()}, text_key binary, node bigint, node_check bigint, n int, parts array<int>, shingle bigint, count int"

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_memory()
        import xxhash

        shingler, seen, repeated, recent, held = Shingler(width), set(), {}, [], 0
        id_type = pa.null()

        def count_repeated():
            """Add the shingles that occur more than once among the recent sets."""
            if recent:
                values, counts = np.unique(np.concatenate(recent), return_counts=True)
                for value, n in zip(values[counts > 1].view(np.int64).tolist(), counts[counts > 1].tolist()):
                    repeated[value] = repeated.get(value, 0) + n

        for batch in batches:
            id_type = batch.column("id").type
            found = []
            for content in as_bytes(batch.column("text")):
                hashes = shingler(content)
                if len(hashes):
                    digest = xxhash.xxh3_128_intdigest(hashes.tobytes())
                    node, check = (x - (1 << 63) for x in divmod(digest, 1 << 64))
                    found.append((node, check, len(hashes), signature(hashes)))
                    if node not in seen:
                        seen.add(node)
                        recent.append(hashes)
                        held += len(hashes)
                        if held > 2_000_000:
                            count_repeated()
                            recent, held = [], 0
                else:
                    found.append((None, None, 0, None))
            node, check, n, parts = zip(*found) if found else ((), (), (), ())
            m = len(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array(node, pa.int64()), pa.array(check, pa.int64()), pa.array(n, pa.int32()), pa.array(parts, pa.list_(pa.int32())), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32())],
                names=["id", "text_key", "node", "node_check", "n", "parts", "shingle", "count"],
            )
        count_repeated()
        m = len(repeated)
        if m:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, id_type), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.list_(pa.int32())), pa.array(repeated.keys(), pa.int64()), pa.array(repeated.values(), pa.int32())],
                names=["id", "text_key", "node", "node_check", "n", "parts", "shingle", "count"],
            )

    body = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), body.alias("text"), _text_key(body).alias("text_key"))
    return saved(rows.mapInArrow(nodes, layout), "nodes")


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def frequent_shingles(nodes: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` most frequent shingles, sorted by hash, and their places in the order."""
    rows = nodes.where("shingle is not null").groupBy("shingle").agg(F.sum("count").alias("count"))
    top = rows.orderBy(F.desc("count"), "shingle").limit(most).toPandas()
    shingles = top["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], (len(top) - order).astype(np.int64)  # the most frequent last


def build_postings(docs: DataFrame, text: str, nodes: DataFrame, width: int, similar: tuple[int, int], frequent_most: int) -> DataFrame:
    """Rows h, node, n, pos of prefix shingles that several nodes hold, and held, the number of a node's rows.

    Postings of rare shingles are dealt by shingle; those of frequent ones, of which one could fill a task, by node.
    """
    spark, (num, den) = docs.sparkSession, similar
    shingles, places = frequent_shingles(nodes, frequent_most)
    table = spark.sparkContext.broadcast((shingles, places))
    total = nodes.agg(F.sum("n")).first()[0] or 0
    n_buckets = 1 + total * (den - num) // den // 400_000

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_memory()
        shingler, seen, held, size = Shingler(width), set(), [], 0
        frequent, place = table.value

        def flush():
            whole = np.concatenate(held)
            rare = (whole["h"].view(np.uint64) % np.uint64(n_buckets)).astype(np.int32)
            dealt = (whole["node"].view(np.uint64) % np.uint64(n_buckets)).astype(np.int32)
            bucket = np.where(np.isin(whole["h"].view(np.uint64), frequent), n_buckets + dealt, rare)
            order = np.argsort(bucket, kind="stable")
            whole, bucket = whole[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            parts = [p.tobytes() for p in np.split(whole, cuts)]
            return pa.RecordBatch.from_arrays([pa.array(bucket[np.concatenate(([0], cuts))]), pa.array(parts, pa.binary())], names=["bucket", "packed"])

        import xxhash

        for batch in batches:
            for content in as_bytes(batch.column("text")):
                hashes = shingler(content)
                if not len(hashes):
                    continue
                node = xxhash.xxh3_128_intdigest(hashes.tobytes()) // (1 << 64) - (1 << 63)
                if node in seen:
                    continue
                seen.add(node)
                n = len(hashes)
                length = n - _ceil_share(n, num, den) + 1
                if len(frequent):
                    at = np.searchsorted(frequent, hashes)
                    at[at == len(frequent)] = 0
                    common = frequent[at] == hashes
                    prefix = hashes[~common][:length]
                    if len(prefix) < length:
                        late = hashes[common][np.argsort(place[at[common]], kind="stable")]
                        prefix = np.concatenate((prefix, late[: length - len(prefix)]))
                else:
                    prefix = hashes[:length]
                posting = np.empty(len(prefix), POSTING)
                posting["h"], posting["node"], posting["n"], posting["pos"] = prefix.view(np.int64), node, n, np.arange(len(prefix))
                held.append(posting)
                size += len(posting)
                if size > 1_000_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    rows = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(postings, "bucket int, packed binary")

    def shared(group: pd.DataFrame) -> pd.DataFrame:
        whole = np.frombuffer(b"".join(group["packed"]), POSTING)
        whole = whole[np.lexsort((whole["node"], whole["h"]))]
        same = whole["h"][1:] == whole["h"][:-1]
        again = same & (whole["node"][1:] == whole["node"][:-1])  # a node that several tasks have met
        whole = whole[np.concatenate(([True], ~again))] if len(whole) else whole
        if len(group) and group["bucket"].iloc[0] < n_buckets:
            same = whole["h"][1:] == whole["h"][:-1]
            whole = whole[np.concatenate((same, [False])) | np.concatenate(([False], same))]
        return pd.DataFrame({c: whole[c] for c in POSTING.names})

    lists = saved(rows.groupBy("bucket").applyInPandas(shared, "h bigint, node bigint, n int, pos int"), "shared-postings")
    return lists.join(lists.groupBy("node").agg(F.count(F.lit(1)).alias("held")), "node")


def _fits(similar: tuple[int, int]) -> Column:
    """Length and positional filter of two postings of one shingle, a_ and b_."""
    num, den = similar
    fits = F.least("a_n", "b_n") * den >= F.greatest("a_n", "b_n") * num
    rest = F.least(F.col("a_n") - F.col("a_pos"), F.col("b_n") - F.col("b_pos"))
    return fits & (rest * (num + den) >= (F.col("a_n") + F.col("b_n")) * num)


def _posting(side: str) -> list[Column]:
    return [F.col(c).alias(f"{side}_{c}") for c in ("node", "n", "pos")]


def _pairs(candidates: DataFrame) -> DataFrame:
    return candidates.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def _stars(postings: DataFrame, similar: tuple[int, int], turn: int) -> DataFrame:
    """Pairs of every node with one node of each of its lists: at first that with the most rows, which of a family of near
    copies is the one with the least changes of its own, in later turns a node by chance. Pairs of one `root` are known."""
    rank = F.col("held") if turn == 0 else F.xxhash64("node", F.lit(turn))
    chosen = postings.groupBy("h").agg(F.max(F.struct(rank.alias("rank"), "node", "n", "pos", "root")).alias("top"))
    chosen = chosen.select("h", F.col("top.root").alias("a_root"), *[F.col(f"top.{c}").alias(f"a_{c}") for c in ("node", "n", "pos")])
    met = postings.select("h", F.col("root").alias("b_root"), *_posting("b")).join(chosen, "h")
    return _pairs(met.where("a_root <> b_root").where(_fits(similar)))


def _plausible(pairs: DataFrame, reps: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Suffix filter: sets with too different numbers of shingles between the pivots can't overlap enough."""
    num, den = similar
    for side in ("a", "b"):
        pairs = pairs.join(reps.select(F.col("node").alias(side), F.col("n").alias(f"{side}_n"), F.col("parts").alias(f"{side}_parts")), side)
    apart = F.aggregate(F.zip_with("a_parts", "b_parts", lambda x, y: F.abs(x - y)), F.lit(0), lambda total, x: total + x)
    both = F.col("a_n") + F.col("b_n")
    # overlap >= num / (num + den) * both, and what is in one set only is both - 2 * overlap
    return pairs.where(apart * (num + den) <= both * (den - num)).select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame, width: int, similar: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) that link. texts: node, text."""
    num, den = similar
    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b"
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sets, size = Shingler(width), {}, 0

        def of(node: int, content: bytes) -> np.ndarray:
            nonlocal size
            if node not in sets:
                if size > 2_000_000:
                    sets.clear()
                    size = 0
                sets[node] = shingler(content)
                size += len(sets[node])
            return sets[node]

        for batch in batches:
            keep = []
            for a, b, left, right in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), as_bytes(batch.column("a_text")), as_bytes(batch.column("b_text"))):
                x, y = of(a, left), of(b, right)
                shared = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(shared * den >= (len(x) + len(y) - shared) * num)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(verify, "a bigint, b bigint")


def _with_roots(links: DataFrame, roots: DataFrame) -> DataFrame:
    """Links that give the components of `links` and of those that gave `roots`."""
    return links.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))


def linked_documents(docs: DataFrame, id_column: str, text: str, *, width: int = 5, similar: tuple[int, int] = (3, 4), frequent_most: int = 1 << 17) -> DataFrame:
    """One row per row of docs: id, n_shingles, component (smallest id reachable by links of at least `similar`).

    `frequent_most` is the size of the table of frequent shingles, which only orders the prefixes.
    """
    rows = build_nodes(docs, id_column, text, width)
    nodes = rows.where("text_key is not null").select("id", "text_key", "node", "node_check", "n", "parts")
    clash = F.when(F.min("node_check") != F.max("node_check"), F.raise_error(F.lit("two sets with one 64-bit hash")))
    chosen = F.min(F.struct("id", "text_key")).alias("chosen")
    reps = nodes.where("node is not null").groupBy("node").agg(chosen, F.min("n").alias("n"), F.min("parts").alias("parts"), F.coalesce(clash.cast("int"), F.lit(0)).alias("clash"))
    reps = saved(reps.where("clash = 0").select("node", "chosen.id", "chosen.text_key", "n", "parts"), "representatives")
    postings = build_postings(docs, text, rows, width, similar, frequent_most)

    def texts_of(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        named = reps.join(wanted, "node", "left_semi").select("node", F.col("id").alias("_id"), F.col("text_key").alias("_key"))
        body = F.col(f"`{text}`")
        found = docs.select(F.col(f"`{id_column}`").alias("id"), body.alias("text"), _text_key(body).alias("text_key"))
        same = (F.col("text_key") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_id"))
        return saved(found.join(named, same).select("node", "text").dropDuplicates(["node"]), "texts")

    open_lists = saved(postings.withColumn("root", F.col("node")), "postings")
    roots = tried = left = None
    for turn in count():
        pairs = _plausible(_stars(open_lists, similar, turn), reps, similar)
        pairs = saved(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        new = saved(verified(pairs, texts_of(pairs), width, similar), "links")
        tried = pairs if tried is None else tried.union(pairs)
        roots = components(new if roots is None else _with_roots(new, roots))
        labelled = open_lists.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        sizes = labelled.groupBy("h", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("h")
        apart = sizes.agg(F.sum("n").alias("_all"), F.sum(F.col("n") * F.col("n")).alias("_own")).where("_all * _all > _own")
        open_lists = saved(labelled.drop("_all", "_own").join(apart, "h"), "open-lists")
        before, left = left, open_lists.agg(F.sum(F.col("_all") - F.col("_own") / F.col("_all")), F.count(F.lit(1))).first()
        # Another turn pays while there are many pairs and the turn before has at least halved them.
        if (left[0] or 0) <= 16 * left[1] or (before is not None and 2 * left[0] > before[0]):
            break
    a_side, b_side = open_lists.select("h", F.col("root").alias("a_root"), *_posting("a")), open_lists.select("h", F.col("root").alias("b_root"), *_posting("b"))
    across = a_side.join(b_side, "h").where("a_node < b_node and a_root <> b_root").where(_fits(similar))
    pairs = saved(_plausible(_pairs(across).join(tried, ["a", "b"], "left_anti"), reps, similar), "pairs")
    roots = components(_with_roots(verified(pairs, texts_of(pairs), width, similar), roots))

    whole = nodes.join(roots, "node", "left").select("id", "n", "node", F.coalesce("root", "node").alias("root"))
    smallest = whole.where("root is not null").groupBy("root").agg(F.min("id").alias("component"))
    return whole.join(smallest, "root", "left").select(
        F.col("id").alias(id_column), F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )
