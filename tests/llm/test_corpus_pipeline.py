"""The pipeline and each of its stages against plain Python, and the operators' queries against their SQL."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from pathlib import Path

import corpus_pipeline as cp
import llm_data as data
import pytest
from oracle import compare, connect
from strata.llm.bpe_automaton import Encoder
from strata.llm.common import folders_made, saved
from strata.llm.queries import ORACLES, QUERIES, tokenizer_path
from strata.llm.toxicity import Model, train
from strata.plans.workspace import work_dir

ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, None), (3, ""), (3, "two THREE"), (None, "!!")]
KNOWN = 200


def corpus() -> tuple[list[tuple], list[tuple]]:
    """documents and labels: those of llm_data, toxic and neutral texts, near copies of one text under null and repeated ids."""
    rng = random.Random(9)
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(data.texts())]
    labels = []
    for i in range(1000, 1000 + KNOWN):
        text = data.prose(rng, 20) + (" idiot scum" if i % 4 == 0 else "")
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int(i % 4 == 0)))
    rows += [(7, rows[6][1], "de", "t", 1), (None, rows[10][1], None, None, None), (None, None, None, None, None), (5, data.prose(rng, 30), "fr", "u", 5)]
    base = data.prose(rng, 80).split(" ")
    for i in (None, 3000, 3000, 2999, None):
        base = [*base]
        base[rng.randrange(80)] = f"copy{i}"
        rows.append((i, " ".join(base), "es", "v", 9))
    return rows, [*labels, (1000, None), (None, 1), (1001, 0)]


def as_scored(rows, model: Model):
    return [r for r in rows if model.score((r[1] or "").encode()) < 0.5]


def as_deduplicated(rows):
    groups: dict = {}
    for (n, _, group), count in data.linked([(n, r[1]) for n, r in enumerate(rows)]).items():
        assert count == 1
        groups.setdefault(group, []).append(rows[n])
    rank = lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest())
    return [min(own, key=rank) for own in groups.values()]


def as_decontaminated(rows):
    hits = {i: n for i, _, n, _, _ in data.contamination_rows([(n, r[1]) for n, r in enumerate(rows)], ITEMS)}
    return [r for n, r in enumerate(rows) if not hits[n]]


def as_redacted(rows):
    for row in rows:
        parts, at = [], 0
        for start, _, _, end in data.base_secrets(row[1]):
            if start >= at:
                parts += [row[1][at:start], "[secret]"]
            at = max(at, end)
        text = "".join([*parts, row[1][at:]]) if parts else row[1]
        yield (row[0], text, *row[2:4], len(text) if parts else row[4])


def as_tokens(rows):
    from tokenizers import Tokenizer

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    for row in rows:
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids
        yield row[0], len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))


def written(spark, folder, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def counted(df):
    return Counter(tuple(r) for r in df.collect())


def test_pipeline(spark, tmp_path):
    rows, labels = corpus()
    folder = f"file://{tmp_path}"
    docs, marks = written(spark, folder, rows, labels)
    brute = {
        "toxicity": lambda rows: as_scored(rows, train(docs, marks)),
        "near_duplicates": as_deduplicated,
        "decontamination": as_decontaminated,
        "secrets": lambda rows: list(as_redacted(rows)),
        "tokens": lambda rows: list(as_tokens(rows)),
    }
    left = rows
    for name, stage in cp.STAGES:
        # Each stage over all documents, which hold its cases, beside the whole run.
        whole = stage(spark, docs, folder)
        assert name == "tokens" or whole.schema == docs.schema
        assert counted(whole) == Counter(brute[name](rows)), name
        left = brute[name](left)
    assert counted(cp.run(spark, folder)) == Counter(left)
    toxic = {i for i, y in labels if y and i is not None}
    kept = {r[0] for r in left}
    assert not toxic & kept and not {11, 3000} & kept and {10, 12, 14, 2999, 1001} <= kept


def test_pipeline_without_rows(spark, tmp_path):
    folder = f"file://{tmp_path}"
    docs, _ = written(spark, folder, [], [])
    for _, stage in cp.STAGES:
        assert stage(spark, docs, folder).count() == 0
    assert cp.run(spark, folder).count() == 0


def test_only_results_of_stages_stay(spark, tmp_path, monkeypatch):
    """What a stage wrote on its way is gone once its result is there; results, and what others wrote, stay."""
    folder = f"file://{tmp_path}"
    written(spark, folder, [(1, "one", "en", "s", 3), (2, "two", "en", "s", 3)], [])
    other = saved(spark.range(1), "other")

    def stage(spark, docs, sf_dir):
        return docs.join(saved(docs.where("doc_id > 1").select("doc_id"), "step"), "doc_id")

    monkeypatch.setattr(cp, "STAGES", [("first", stage), ("second", stage)])
    shared = Path(work_dir(spark, "none").removeprefix("file://")).parent
    before = {p.name for p in shared.iterdir()}
    assert [r.doc_id for r in cp.run(spark, folder).collect()] == [2]
    made = sorted(p.name.rsplit("-", 1)[0] for p in shared.iterdir() if p.name not in before)
    assert made == ["pipeline-first", "pipeline-second"] and other.count() == 1


@pytest.mark.parametrize("name, lasting", [("near_duplicates", ["chosen", "numbered"]), ("decontamination", ["contaminated"])])
def test_stages_leave_what_their_result_reads(spark, tmp_path, name, lasting):
    """Also where a stage is called alone, as its result is written only later; who asks learns of the folders that stay."""
    rows, labels = corpus()
    folder = f"file://{tmp_path}"
    docs, _ = written(spark, folder, rows, labels)
    shared = Path(work_dir(spark, "none").removeprefix("file://")).parent
    before = {p.name for p in shared.iterdir()} if shared.exists() else set()
    with folders_made() as made:
        left = dict(cp.STAGES)[name](spark, docs, folder)
    stay = {p.name for p in shared.iterdir()} - before
    assert sorted(p.rsplit("-", 1)[0] for p in stay) == lasting
    assert stay <= {p.rsplit("/", 1)[-1] for p in made}
    brute = {"near_duplicates": as_deduplicated, "decontamination": as_decontaminated}
    assert counted(left) == Counter(brute[name](rows))


def test_tokens_of_many_texts_by_the_megabyte(monkeypatch):
    """What a worker needs beside its tables goes by the bytes that are encoded at once."""
    rng, sizes, whole = random.Random(4), [], Encoder.encode_batch
    texts = [data.prose(rng, 300) for _ in range(20)] * 140
    encoder = Encoder(tokenizer_path("word_bpe_49k.json"))
    alone = dict(zip(texts[:20], whole(encoder, texts[:20])))
    monkeypatch.setattr(Encoder, "encode_batch", lambda self, part: sizes.append(sum(map(len, part.to_pylist()))) or whole(self, part))
    assert list(encoder.in_batches(texts)) == [alone[t] for t in texts]
    assert sum(sizes) == sum(map(len, texts)) > 4_000_000 and max(sizes) < 1_100_000


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    if name not in ORACLES:
        assert QUERIES[name](spark, sf_dir).count() > 0
        return
    problem = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
    assert problem is None, problem
