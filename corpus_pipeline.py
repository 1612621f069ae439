"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet before the next reads it. All
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import toxicity
from granary.llm.mixing import mixed
from granary.llm.ngram_join import jaccard_components
from granary.llm.packing import pack_documents
from granary.llm.passage_dedup import near_duplicate_passages
from granary.llm.spans import cut_out
from granary.staging import stage

#: SQL can't express a trained model, pseudorandom draws or a tokenizer.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or of toxic sentences stays below one half. Null and empty texts stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model, score_col="_toxicity").where("_toxicity < 0.5").drop("_toxicity")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group linked by shingles. Null ids stay. Of rows that repeat an id the one stays whose text
    has the smallest hash (then the smallest row), so reruns agree."""
    groups = stage(jaccard_components(docs), "groups")
    gone = groups.where("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = stage(groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if not repeated.head(1):
        return kept
    several = kept.join(repeated, "doc_id", "left_semi")
    row = F.struct(F.sha2(F.coalesce("text", F.lit("")), 256).alias("_hash"), *docs.columns)
    one = several.groupBy(F.col("doc_id").alias("_id")).agg(F.min(row).alias("_row")).select("_row.*").drop("_hash")
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(one)


def cut_near_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their passages that near-copy an earlier document's; what has no word left goes."""
    return cut_out(docs, near_duplicate_passages(docs).select("doc_id", "low", "high"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row for each document and epoch it is drawn in."""
    return mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and place in it."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", one_of_each_group),
    ("passage_dedup", cut_near_passages),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
