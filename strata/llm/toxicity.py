"""Toxicity: a sparse linear classifier that is regularised by counterfactuals.

A text is the set of its words and of their beginnings. A logistic model with L1 and L2 penalties is fitted on a bounded sample of labelled texts. For
every sampled text with an identity term, copies are made in which the term is replaced by another term of its
group or by a neutral word, and the squared change of the model's logit between text and copy is penalised, with all
features that the swap takes away or brings, beginnings included. Neutral words have no features, so that the logit of
a mention is held to that of no mention. The model then can't lean on the mention of a group, and neutral mentions
keep a low score.

Only words travel: tasks turn sampled texts into words, Spark counts features and chooses the telling ones, tasks turn the texts into their numbers, the
driver fits weights to these numbers, and scoring uses the few features with a weight. Labels, language, source and ids are never features.

Defined cases: null and empty texts get the score of no words; labels that are null are left out, repeated ones count
once (toxic if any says so); without both classes in the sample the score is the share of toxic labels.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import as_bytes, record_batch, release_worker_memory, saved

#: Identity terms by group, the last of each being a neutral word.
IDENTITY_GROUPS = [
    ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "religious"],
    ["christians", "muslims", "jews", "hindus", "buddhists", "atheists", "people"],
    ["black", "white", "asian", "latino", "arab", "african", "european", "american", "human"],
    ["women", "men", "girls", "boys", "people"],
    ["woman", "man", "girl", "boy", "transgender", "person"],
    ["gay", "lesbian", "bisexual", "straight", "queer", "homosexual", "heterosexual", "single"],
    ["immigrants", "refugees", "foreigners", "citizens", "people"],
    ["disabled", "blind", "deaf", "old", "young", "local"],
    ["muslime", "christen", "juden", "hindus", "menschen"],
    ["frauen", "männer", "mädchen", "jungen", "menschen"],
    ["musulmans", "chrétiens", "juifs", "hindous", "gens"],
    ["femmes", "hommes", "filles", "garçons", "gens"],
    ["musulmanes", "cristianos", "judíos", "hindúes", "personas"],
    ["mujeres", "hombres", "chicas", "chicos", "personas"],
]

#: Bytes of the beginnings of words that are features.
PREFIXES = (4, 5)

_FOLD = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in bytes(range(256)).lower())


def word_set(text: bytes) -> set[bytes]:
    return set(text.translate(_FOLD).split())


def features_of(words: set[bytes]) -> set[bytes]:
    """The words, and the beginnings of longer ones, which inflected forms share."""
    return words.union(*[{w[:n] + b"*" for w in words if len(w) > n} for n in PREFIXES])


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[bytes, float]
    #: Words without features.
    neutral: frozenset[bytes] = frozenset()

    def score(self, text: bytes) -> float:
        weights = self.weights
        logit = self.bias + sum(weights[w] for w in sorted(features_of(word_set(text) - self.neutral) & weights.keys()))
        return 1 / (1 + math.exp(-min(max(logit, -500.0), 500.0)))


def swaps(present: set, groups: list[list]) -> list[tuple]:
    """(term, replacement) for every identity term of a text and every other term of its groups."""
    return [(term, other) for group in groups for term in group if term in present for other in group if other != term]


def swapped_features(words: set[bytes], groups: list[list[bytes]], neutral: frozenset[bytes]) -> Iterator[tuple[set[bytes], set[bytes]]]:
    """For each swap of a text the features that it loses and those that it gains; what other words keep is in neither."""
    own = features_of(words - neutral)
    for term, other in swaps(words, groups):
        copy = features_of((words - {term} | {other}) - neutral)
        yield own - copy, copy - own


def fit(
    features: list[np.ndarray],
    labels: np.ndarray,
    changes: Iterable[tuple[tuple[int, ...], tuple[int, ...]]] | Counter,
    n_features: int,
    *,
    l1: float = 2e-4,
    l2: float = 1e-5,
    counterfactual: float = 1.0,
    steps: int = 400,
) -> tuple[float, np.ndarray]:
    """Bias and weights by accelerated proximal gradient descent.

    features: ids of the features of each text; changes: for each swap the ids that are lost and those that are gained, each
    swap as often as it occurs. Minimised is the sum over texts of the logistic loss, of l1 and l2 times the weights'
    norms, and `counterfactual` times the squared changes of the logit. The bias is one more feature, which every text has and no penalty holds.
    """
    m = len(labels)
    texts = np.repeat(np.arange(m), [len(f) + 1 for f in features])
    words = np.concatenate([np.append(f, n_features) for f in features]).astype(np.int64)
    distinct = Counter(changes)
    times = np.array(list(distinct.values()), np.int64)
    sizes = np.array([len(lost) + len(gained) for lost, gained in distinct], np.int64)
    swap = np.repeat(np.arange(len(distinct)), sizes)
    parts = np.array([i for lost, gained in distinct for i in (*lost, *gained)], np.int64)
    signs = np.array([sign for lost, gained in distinct for sign in (*[1.0] * len(lost), *[-1.0] * len(gained))])
    # Scaled by how much each weight bends the sum, one step size fits rare, frequent and swapped words.
    bend = np.bincount(words, minlength=n_features + 1) + 4 * counterfactual * np.bincount(parts, (times * sizes)[swap], n_features + 1)
    scale = 1 / np.sqrt(np.maximum(bend, 1.0))
    free = np.append(np.ones(n_features), 0.0)

    def loss_and_slope(u: np.ndarray) -> tuple[float, np.ndarray]:
        w = u * scale
        logits = np.bincount(texts, w[words], minlength=m)
        gap = np.bincount(swap, signs * w[parts], minlength=len(times))
        loss = np.sum(np.logaddexp(0, logits) - labels * logits) + l2 * m / 2 * np.sum(free * w**2) + counterfactual * np.sum(times * gap**2)
        wrong = 1 / (1 + np.exp(-np.clip(logits, -500, 500))) - labels
        slope = np.bincount(words, wrong[texts], minlength=n_features + 1) + l2 * m * free * w
        slope += 2 * counterfactual * np.bincount(parts, signs * (times * gap)[swap], minlength=n_features + 1)
        return loss, slope * scale

    u = ahead = np.zeros(n_features + 1)
    momentum, step, least = 1.0, 1.0, 1e-9
    for _ in range(steps):
        loss, slope = loss_and_slope(ahead)
        while True:
            moved = ahead - step * slope
            new = np.sign(moved) * np.maximum(np.abs(moved) - step * l1 * m * free * scale, 0)
            delta = new - ahead
            if step < least or loss_and_slope(new)[0] <= loss + slope @ delta + delta @ delta / (2 * step):
                break
            step /= 2
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / faster * (new - u)
        if np.abs(new - u).max() < 1e-4:
            u = new
            break
        u, momentum = new, faster
    w = u * scale
    return float(w[n_features]), w[:n_features]


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned from; a null id counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_texts(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most: int) -> DataFrame:
    """At most `most` labelled texts, chosen by hash of their ids, as rows toxic, words (sorted, by lines).
    Equal texts count once, as toxic if any is."""
    known = labels.select(F.col(key).alias("_key"), F.col(label).alias("_label")).where("_label is not null and _key is not null")
    chosen = known.where(~held_out(F.col("_key"))).groupBy("_key").agg(F.max("_label").alias("_label"))
    chosen = chosen.orderBy(F.xxhash64("_key"), "_key").limit(most)
    texts = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    same = F.md5(F.col("_text").cast("binary"))
    joined = texts.join(chosen, "_key").groupBy(same.alias("_same")).agg(F.max("_label").alias("_label"), F.min("_text").alias("_text"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [b"\n".join(sorted(word_set(content))) for content in as_bytes(batch.column("_text"))]
            yield record_batch({"toxic": batch.column("toxic"), "words": found}, pa.schema([("toxic", pa.int64()), ("words", pa.binary())]))

    return joined.select((F.col("_label") > 0).cast("bigint").alias("toxic"), "_text").mapInArrow(words, "toxic bigint, words binary")


def feature_counts(texts: DataFrame, neutral: frozenset[bytes]) -> DataFrame:
    """Rows feature, n, n_toxic: how many of the sampled texts have a feature, and how many of the toxic ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("feature", pa.binary()), ("n", pa.int64()), ("n_toxic", pa.int64())])
        for batch in batches:
            counts = Counter(), Counter()
            for toxic, words in zip(batch.column("toxic").to_pylist(), batch.column("words").to_pylist()):
                own = features_of(set(words.split(b"\n")) - neutral - {b""})
                counts[0].update(own)
                if toxic:
                    counts[1].update(own)
            names = list(counts[0])
            yield record_batch({"feature": names, "n": [counts[0][x] for x in names], "n_toxic": [counts[1][x] for x in names]}, schema)

    counted = texts.mapInArrow(count, "feature binary, n bigint, n_toxic bigint")
    return counted.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))


def sample_rows(texts: DataFrame, vocabulary: dict[bytes, int], groups: list[list[bytes]], neutral: frozenset[bytes]) -> DataFrame:
    """What the fit needs to know, in numbers of features: a row toxic, own for each text, and a row lost, gained, n for each
    different change by a swap of identity terms."""
    layout = "toxic bigint, own array<int>, lost array<int>, gained array<int>, n bigint"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = pa.list_(pa.int32())
        schema = pa.schema([("toxic", pa.int64()), ("own", ids), ("lost", ids), ("gained", ids), ("n", pa.int64())])
        known = vocabulary.keys()
        numbers = lambda own: tuple(sorted(map(vocabulary.__getitem__, own & known)))
        for batch in batches:
            texts, changes = [], Counter()
            for toxic, words in zip(batch.column("toxic").to_pylist(), batch.column("words").to_pylist()):
                own = set(words.split(b"\n")) - {b""}
                texts.append((toxic, numbers(features_of(own - neutral))))
                changes.update((numbers(lost), numbers(gained)) for lost, gained in swapped_features(own, groups, neutral))
            rows = [(t, own, None, None, None) for t, own in texts] + [(None, None, *change, n) for change, n in changes.items()]
            yield record_batch(dict(zip(schema.names, zip(*rows))) if rows else {c: [] for c in schema.names}, schema)

    return texts.mapInArrow(number, layout)


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    *,
    most: int = 8_000,
    least_texts: int = 3,
    chi2_share: float = 0.002,
    chi2_limits: tuple[float, float] = (5.0, 15.0),
    groups: list[list[str]] = IDENTITY_GROUPS,
    counterfactual: float = 1.0,
    l1: float = 2e-4,
) -> Model:
    """Fit on at most `most` labelled texts. A word or beginning gets a weight only if `least_texts` of them hold it and its share of
    toxic ones differs from the share of all by a chi-square of `chi2_share` of their number, within `chi2_limits`: a statistic of a given effect grows
    with the number of texts, so few labels need a lower limit.

    Features are counted and chosen by Spark; what comes to the driver are the chosen ones and their numbers in the sampled texts.
    """
    texts = saved(training_texts(docs, labels, key, text, label, most), "sample")
    m, toxic = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if toxic in (0, m):
        return Model(500.0 if toxic else -500.0, {})
    terms = [[t.encode() for t in group] for group in groups]
    neutral = frozenset(group[-1] for group in terms)
    share, limit = toxic / m, min(max(chi2_share * m, chi2_limits[0]), chi2_limits[1])
    expected = F.col("n") * share
    telling = feature_counts(texts, neutral).where(F.col("n") >= least_texts)
    telling = telling.where(F.pow(F.col("n_toxic") - expected, F.lit(2)) >= limit * expected * (1 - share))
    identity = features_of({t for group in terms for t in group} - neutral)
    vocabulary = {w: i for i, w in enumerate(sorted({bytes(r.feature) for r in telling.select("feature").collect()} | identity))}
    rows = saved(sample_rows(texts, vocabulary, terms, neutral), "numbers")
    sample = rows.where("own is not null").select("toxic", "own").toArrow()
    changed = rows.where("n is not null").groupBy("lost", "gained").agg(F.sum("n").alias("n")).toArrow()
    own = sample.column("own").combine_chunks()
    features = np.split(own.values.to_numpy(), own.offsets.to_numpy()[1:-1]) if len(own) else []
    changes = Counter({(tuple(x["lost"]), tuple(x["gained"])): x["n"] for x in changed.to_pylist()})
    bias, weights = fit(features, sample.column("toxic").to_numpy().astype(float), changes, len(vocabulary), l1=l1, counterfactual=counterfactual)
    return Model(bias, {w: float(weights[i]) for w, i in vocabulary.items() if weights[i]}, neutral)


def score_texts(docs: DataFrame, text: str, model: Model, name: str = "score") -> DataFrame:
    """The same rows with the score of their text as one more column."""
    layout = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_memory()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            yield batch.append_column(name, pa.array([model.score(t) for t in as_bytes(texts)], pa.float64()))

    return docs.mapInArrow(score, layout)
