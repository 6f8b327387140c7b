"""Best-fit packing by a grouping genetic algorithm on islands.

Documents are encoded, what is longer than a sequence is cut, and whole sequences are done. The other pieces are dealt by hash to shards of a bounded number of
pieces. A shard has several islands, each with a population of packings of that shard. A packing is bred from two: whole well-filled bins
of one are injected into the other, bins there that hold any of the same pieces are emptied, and the pieces left without a bin are placed by
best fit, longest first; a mutation empties a few badly filled bins. After every epoch the best packings of an island move to the next island of the shard. A shard whose best packing has no
more bins than its tokens need is done.

Then a shard's best packing counts, but for its worst-filled bins: their pieces meet those of other shards in shards of
the next level, until one shard is left. A level has about an eighth of the pieces of the level before, so all levels together cost little more than the first.

What a task does hangs on its rows and seeds only, so that a task that is run again gives the same. Nothing is collected but counts.

Defined cases: null and empty texts have the closing id alone; repeated rows, missing ids and rows with one id are documents of their own; an empty table has no
sequences. Other columns are not looked at.
"""

from __future__ import annotations

import itertools
import os
import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import record_batch, saved, shuffle_partitions, worker_memory
from strata.llm.word_split import SPECIAL, Splitter, look_up, shares

#: Pieces of a shard, islands of a shard, packings of an island, generations of an epoch, epochs of a level.
SHARD, ISLANDS, POPULATION, GENERATIONS, EPOCHS = 2048, 3, 6, 12, 2
#: Full bins that the tokens of a shard make at least, but for the last shard.
LEAST_BINS = 16


class Ids:
    """The ids of texts. The library's model merges each word once; words are remembered, up to so many."""

    def __init__(self, path: str, remembered: int = 600_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.splitter, self.remembered = Splitter(path), remembered
        tokenizer = self.splitter.tokenizer
        # The merges alone, for words that are split and in symbols already.
        self.merger = Tokenizer(tokenizer.model)
        self.merger.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.is_end = np.zeros(tokenizer.get_vocab_size(), bool)
        self.is_end[[number for token, number in tokenizer.get_vocab().items() if token.endswith(tokenizer.model.end_of_word_suffix)]] = True
        self.known: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        """Words are encoded many at a time; a token with the mark of a word's end shows where the next word begins."""
        for word in words:
            if not word or word[0] == SPECIAL:
                self.known[word] = self.splitter.special[word[1:]].to_bytes(4, "little") if word else b""
        words = [word for word in words if word and word[0] != SPECIAL]
        symbols = [self.splitter.in_symbols(word) for word in words]
        groups = [" ".join(symbols[at : at + 500]) for at in range(0, len(symbols), 500)]
        encoded = self.merger.encode_batch_fast(groups, add_special_tokens=False)
        ids = np.fromiter(itertools.chain.from_iterable(e.ids for e in encoded), "<u4")
        ends = 4 * (np.flatnonzero(self.is_end[ids]) + 1)
        if len(ends) != len(words):
            raise ValueError("a word without a token that ends it")
        whole = ids.tobytes()
        self.known.update(zip(words, map(whole.__getitem__, map(slice, [0, *ends[:-1].tolist()], ends.tolist()))))

    def of(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, null counting as empty, as little-endian unsigned 32-bit integers."""
        words, which, bounds = self.splitter.split(texts)
        own = look_up(self.known, words, self._learn, self.remembered)
        flat, sizes = np.frombuffer(b"".join(own), "<u4"), np.fromiter(map(len, own), np.int32, len(own)) >> 2
        counts = sizes[which]
        ends = np.cumsum(counts)
        # Where each word's ids begin among those of the different words, less where they will stand, once for each of its ids.
        shifts = (np.cumsum(sizes) - sizes)[which] - (ends - counts)
        ids = flat[np.repeat(shifts, counts) + np.arange(ends[-1] if len(ends) else 0)]
        return [ids[low:high] for low, high in itertools.pairwise(np.concatenate(([0], ends))[bounds].tolist())]


def pieces(docs: DataFrame, key: str, text: str, path: str, capacity: int, closing: int) -> DataFrame:
    """Rows item (a number of its own), key, piece, start, length, ids_crc32."""
    fields = [("item", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    layout = f"key {docs.schema[key].dataType.simpleString()}, item bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    end = int(closing).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = worker_memory(("packing", path, os.path.getsize(path), os.path.getmtime(path)), lambda: Ids(path))
        number = itertools.count(TaskContext.get().partitionId() << 33)
        for batch in batches:
            rows: list[tuple] = []
            for at, until in shares(batch.column("text")):
                for row, own in enumerate(ids.of(batch.column("text").slice(at, until - at)), at):
                    for piece, start in enumerate(range(0, len(own) + 1, capacity)):
                        part, last = own[start : start + capacity], start + capacity > len(own)
                        crc = zlib.crc32(np.ascontiguousarray(part))
                        rows.append((row, next(number), piece, start, len(part) + last, zlib.crc32(end, crc) if last else crc))
            owner, *values = zip(*rows) if rows else [()] * 6
            schema = pa.schema([("key", batch.column("key").type), *fields])
            named = dict(zip([name for name, _ in fields], values))
            yield record_batch({"key": batch.column("key").take(pa.array(owner, pa.int64())), **named}, schema)

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return saved(rows.mapInArrow(cut, layout), "pieces")


class Packing:
    """Bins of items, with what each has left. Items are numbers, `sizes` their lengths."""

    __slots__ = ("bins", "left", "capacity", "sizes")

    def __init__(self, sizes: list[int], capacity: int, bins: list[list[int]] = ()):
        self.sizes, self.capacity = sizes, capacity
        self.bins = list(bins)
        self.left = [capacity - sum(map(sizes.__getitem__, own)) for own in self.bins]

    def place(self, items: list[int]) -> None:
        """Each item, in the order given, into the bin where the least is left behind, a new one if none has room."""
        bins, left, sizes = self.bins, self.left, self.sizes
        order = sorted(zip(left, range(len(bins))))
        for item in items:
            size = sizes[item]
            at = bisect_left(order, (size,))
            if at < len(order):
                room, number = order.pop(at)
                bins[number] = [*bins[number], item]
            else:
                room, number = self.capacity, len(bins)
                bins.append([item])
                left.append(room)
            left[number] = room - size
            insort(order, (room - size, number))

    def without(self, dropped: set[int]) -> list[int]:
        """Take bins away; their items, longest first."""
        items = [item for number in dropped for item in self.bins[number]]
        self.bins, self.left = ([x for i, x in enumerate(own) if i not in dropped] for own in (self.bins, self.left))
        return sorted(items, key=lambda i: (-self.sizes[i], i))

    def fitness(self) -> tuple[int, int]:
        """Few bins first, then uneven ones: the sum of the squares of what is in them."""
        return -len(self.bins), sum((self.capacity - x) ** 2 for x in self.left)

    def copy(self) -> Packing:
        other = Packing(self.sizes, self.capacity)
        other.bins, other.left = list(self.bins), list(self.left)
        return other

    def encoded(self) -> bytes:
        """The bin of every item."""
        where = np.zeros(len(self.sizes), np.int32)
        for number, own in enumerate(self.bins):
            where[own] = number
        return where.tobytes()

    @classmethod
    def decoded(cls, sizes: list[int], capacity: int, where: bytes) -> Packing:
        bins: dict[int, list[int]] = {}
        for item, number in enumerate(np.frombuffer(where, np.int32).tolist()):
            bins.setdefault(number, []).append(item)
        return cls(sizes, capacity, list(bins.values()))


def first_packing(sizes: list[int], capacity: int, rng: random.Random, blur: float) -> Packing:
    """Best fit, about from long to short: lengths are blurred by so much for the order, so that packings differ."""
    packing = Packing(sizes, capacity)
    packing.place(sorted(range(len(sizes)), key=lambda i: -sizes[i] * (1 + blur * rng.random())))
    return packing


def crossover(one: Packing, other: Packing, rng: random.Random, most: int = 8) -> Packing:
    """Some of the best-filled bins of `other`, injected into `one`."""
    child = one.copy()
    best = sorted(range(len(other.bins)), key=lambda b: (other.left[b], b))[: max(2 * most, len(other.bins) // 4)]
    chosen = rng.sample(best, min(len(best), rng.randint(1, most)))
    injected = [other.bins[b] for b in chosen]
    inside = {item for own in injected for item in own}
    hit = {b for b, own in enumerate(child.bins) if not inside.isdisjoint(own)}
    displaced = [item for item in child.without(hit) if item not in inside]
    child.bins += injected
    child.left += [other.left[b] for b in chosen]
    child.place(displaced)
    return child


def mutation(packing: Packing, rng: random.Random, most: int = 6) -> Packing:
    """Empties some of the worst-filled bins and a few others, and places their items anew."""
    child, n = packing.copy(), len(packing.bins)
    worst = sorted(range(n), key=lambda b: (-packing.left[b], b))[: rng.randint(1, most)]
    child.place(child.without({*worst, *rng.sample(range(n), min(n, 2))}))
    return child


def evolve(sizes: list[int], capacity: int, population: list[Packing], seed: int, size: int = POPULATION, generations: int = GENERATIONS) -> list[Packing]:
    """The population after so many generations, the best first. An empty one is founded. It ends early where no packing can be better."""
    rng, bound = random.Random(seed), -(-sum(sizes) // capacity)
    own = list(population)
    while len(own) < size:
        own.append(first_packing(sizes, capacity, rng, 0.02 * len(own) if len(own) else 0.0))
        if len(own[-1].bins) <= bound:
            break
    own.sort(key=Packing.fitness, reverse=True)
    for _ in range(generations):
        if len(own[0].bins) <= bound or len(sizes) < 2:
            break
        children = []
        for _ in range(size // 2):
            one, other = sorted(rng.sample(range(len(own)), min(2, len(own))))[:: rng.choice((1, -1))] if len(own) > 1 else (0, 0)
            child = crossover(own[one], own[other], rng)
            children.append(mutation(child, rng) if rng.random() < 0.3 else child)
        # Equal packings would fill the island: of those with one fitness one stays.
        own = list({p.fitness(): p for p in reversed([*own, *children])}.values())
        own.sort(key=Packing.fitness, reverse=True)
        del own[size:]
    return own


def _evolved(state: DataFrame, capacity: int, epoch: int, seed: int) -> DataFrame:
    """One epoch of every island: rows shard, island, sizes, population, bins and squares (of its best packing), done."""

    def breed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("shard", pa.int64()), ("island", pa.int32()), ("sizes", pa.list_(pa.int32())), ("population", pa.list_(pa.binary())),
            ("bins", pa.int64()), ("squares", pa.int64()), ("done", pa.bool_()),
        ])
        for batch in batches:
            for row in batch.to_pylist():
                sizes, kept = row["sizes"], row["population"] or []
                if row["done"]:
                    values = {"population": [kept], "bins": [row["bins"]], "squares": [row["squares"]], "done": [True]}
                else:
                    own = [Packing.decoded(sizes, capacity, p) for p in [*kept, *(row["immigrants"] or [])]]
                    after = evolve(sizes, capacity, own, hash((seed, epoch, row["shard"], row["island"])))
                    bins, squares = after[0].fitness()
                    done = -bins <= -(-sum(sizes) // capacity)
                    values = {"population": [[p.encoded() for p in after[: 1 if done else None]]], "bins": [-bins], "squares": [squares], "done": [done]}
                yield record_batch({"shard": [row["shard"]], "island": [row["island"]], "sizes": [sizes], **values}, schema)

    layout = "shard bigint, island int, sizes array<int>, population array<binary>, bins bigint, squares bigint, done boolean"
    columns = ["shard", "island", "sizes", "population", "immigrants", "bins", "squares", "done"]
    return state.select(*columns).mapInArrow(breed, layout)


def _packed(items: DataFrame, shards: int, capacity: int, level: int, seed: int, islands: int, epochs: int) -> DataFrame:
    """Rows item, length, shard, bin, offset, room (what its bin has left): the best packing of each shard."""
    shard = F.pmod(F.xxhash64("item", F.lit(level)), F.lit(shards))
    listed = F.array_sort(F.collect_list(F.struct("item", F.col("length").cast("int").alias("length"))))
    dealt = saved(items.groupBy(shard.alias("shard")).agg(listed.alias("own")), "shards")
    none = {"population": "array<binary>", "immigrants": "array<binary>", "bins": "bigint", "squares": "bigint"}
    state = dealt.select("shard", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.col("own.length").alias("sizes"))
    state = state.withColumns({c: F.lit(None).cast(t) for c, t in none.items()} | {"done": F.lit(False)})
    # Islands are small rows of much work: many tasks, but not more rows than a task can hold.
    tasks = max(1, min(shards * islands, max(shuffle_partitions(items.sparkSession), shards * islands // 256)))
    for epoch in range(epochs):
        state = saved(_evolved(state.repartition(tasks, "shard", "island"), capacity, epoch, seed), "islands")
        if epoch + 1 < epochs:
            finished = state.groupBy("shard").agg(F.max("done").alias("done"))
            elite = F.slice("population", 1, 2)
            moved = state.select("shard", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"), elite.alias("immigrants"))
            state = state.drop("done").join(moved, ["shard", "island"]).join(finished, "shard")
    best = state.groupBy("shard").agg(F.max_by(F.col("population")[0], F.struct(-F.col("bins"), "squares", -F.col("island"))).alias("best"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [("item", pa.int64()), ("length", pa.int64()), ("shard", pa.int64()), ("bin", pa.int32()), ("offset", pa.int64()), ("room", pa.int64())]
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array([x["length"] for x in row["own"]], np.int64)
                where = np.frombuffer(row["best"], np.int32)
                order = np.argsort(where, kind="stable")
                begins = np.cumsum(lengths[order]) - lengths[order]
                fill = np.bincount(where, lengths).astype(np.int64)
                offset = np.empty(len(where), np.int64)
                offset[order] = begins - (np.cumsum(fill) - fill)[where[order]]
                columns = {
                    "item": [x["item"] for x in row["own"]], "length": lengths, "shard": np.full(len(where), row["shard"]), "bin": where,
                    "offset": offset, "room": capacity - fill[where],
                }
                yield record_batch(columns, pa.schema(names))

    layout = "item bigint, length bigint, shard bigint, bin int, offset bigint, room bigint"
    return saved(dealt.join(best, "shard").select("shard", "own", "best").mapInArrow(spread, layout), "packed")


def pack(
    docs: DataFrame,
    key: str,
    text: str,
    path: str,
    *,
    capacity: int = 4096,
    closing: int = 1,
    shard: int = SHARD,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    seed: int = 7,
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset. `path` names the tokenizer's file, at the same place on
    all executors; every document ends with the id `closing`."""
    cut = pieces(docs, key, text, path, capacity, closing)
    whole = cut.where(F.col("length") == capacity).select("item", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    placed, items, level = [whole], cut.where(F.col("length") < capacity).select("item", "length"), 0
    while True:
        left, tokens = items.agg(F.count("item"), F.coalesce(F.sum("length"), F.lit(0))).first()
        if not left:
            break
        # A shard has some full bins' worth of tokens, so that only a share of it goes on, however short its pieces are.
        shards = max(1, min(-(-left // shard), tokens // (LEAST_BINS * capacity)))
        packed = _packed(items, shards, capacity, level, seed, islands, epochs)
        number = F.lit(level << 56) + F.col("shard") * (1 << 20) + F.col("bin")
        # Of each shard an eighth of the bins, the worst filled, goes on; a full bin never does.
        worst = F.struct(-F.col("room"), "bin")
        bins = packed.where("room > 0").select("shard", "bin", "room").distinct()
        per_shard = packed.groupBy("shard").agg((F.floor(F.max("bin") / 8) + 1).alias("most"))
        ranked = bins.groupBy("shard").agg(F.array_sort(F.collect_list(worst)).alias("bins")).join(per_shard, "shard")
        going = ranked.select("shard", F.explode(F.slice("bins", F.lit(1), F.col("most"))["bin"]).alias("bin"))
        if shards == 1:
            going = going.limit(0)
        split = saved(packed.join(going.withColumn("going", F.lit(True)), ["shard", "bin"], "left").withColumn("sequence_id", number), "split")
        placed.append(split.where("going is null").select("item", "sequence_id", "offset"))
        items, level = split.where("going").select("item", "length"), level + 1
    done = placed[0]
    for other in placed[1:]:
        done = done.union(other)
    return cut.join(done, "item").select(F.col("key").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
