"""A corpus pipeline of five stages; each is written as Parquet and read again as the next one's documents.

toxicity drops documents that the classifier rejects; near_duplicates keeps one document of each group of linked ones, that
with the smallest id; decontamination drops documents that hold a passage of the benchmark; secrets replaces secrets in
the texts; tokens encodes what is left. All but the last return the columns that came in.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.bpe_automaton import encoded
from strata.llm.common import folders_made, free_name, kept, saved, table
from strata.llm.decontamination import contamination
from strata.llm.jaccard_join import linked_documents
from strata.llm.queries import tokenizer_path
from strata.llm.secret_scan import without_secrets
from strata.llm.toxicity import score_texts, train
from strata.sinks.layers import remove_folders


def _text_key() -> Column:
    return F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)


def _alone(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What `make` gives, saved. What was written on the way is removed, as nothing reads it any more."""
    with folders_made() as made:
        df, own = kept(make(), name)
    remove_folders(df.sparkSession, (path for path in made if path != own))
    return df


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below a half. The model learns from the labels of documents that are still there."""
    model, score = train(docs, table(spark, sf_dir, "labels")), free_name(docs, "_score")
    return score_texts(docs, "text", model, score).where(F.col(score) < 0.5).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component. Rows get a number first, so that repeated and missing ids can't confuse them;
    of documents with one id, or without, the first by its text stays."""
    row, rank = free_name(docs, "_row"), free_name(docs, "_rank")
    numbered = saved(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")

    def chosen() -> DataFrame:
        groups = linked_documents(numbered.select(row, "text"), row, "text").select(row, F.col("component_id").alias("_group"))
        ranks = numbered.select(row, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", _text_key().alias("key"), row).alias(rank))
        return ranks.join(groups, row).groupBy("_group").agg(F.min(rank).alias("_first")).select(F.col(f"_first.{row}").alias(row))

    return numbered.join(_alone(chosen, "chosen"), row, "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item. What is decided about a text holds for all rows with it."""
    key = free_name(docs, "_key")

    def hit() -> DataFrame:
        keyed = docs.select(_text_key().alias(key), "text")
        found = contamination(keyed, key, "text", table(spark, sf_dir, "benchmark"), "item_id", "text")
        return found.where("n_hit > 0").select(key).distinct()

    return docs.withColumn(key, _text_key()).join(_alone(hit, "contaminated"), key, "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by a mark and n_chars brought up to date."""
    return without_secrets(docs, "text", "n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded(docs, "doc_id", "text", tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: A fitted classifier decides in the first stage; the tests check the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = _alone(partial(stage, spark, docs, sf_dir), f"pipeline-{name}")
    return docs
