"""The corpus pipeline: quality rules, near-dedup, personal data, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of documents (``COLUMNS``), whatever other columns docs has. An empty table gives an
empty result in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domscope.llm import bpe, mixing, near_dedup, pii_crf, quality_rules
from domscope.llm.queries import vocabulary_path
from domscope.llm.storage import partitions, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go. Labels of documents teach the rules.

    A null or wordless text has fewer than ten words and goes; repeated rows have one verdict; a null id
    has no label, which only matters for learning; without labels the base rules decide alone.
    """
    rules = quality_rules.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.apply(docs.select(*COLUMNS), rules).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id. Pairs of similarity 0.8 or more are linked.

    Texts without words are linked with nothing and stay; of equal rows one stays; null ids come last.
    """
    return near_dedup.keep_one(docs.select(*COLUMNS), threshold=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each span is replaced by its kind in brackets, and n_chars counts what is left.

    A null text stays null, with null n_chars; repeated rows stay repeated.
    """
    found = pii_crf.detect(docs.select(*COLUMNS), masked="masked")
    return found.select(
        "doc_id",
        F.col("masked").alias("text"),
        "lang",
        "source",
        F.length("masked").cast("long").alias("n_chars"),
    )


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix draws it, a shard in each partition, in random order.

    Texts without words have size 0 and go with their block's draws; a null source is the last one;
    equal rows may be drawn different numbers of times.
    """
    shards = partitions(spark)
    return mixing.rows_of(mixing.mix(docs.select(*COLUMNS), shards=shards), shards).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and the hash of what they decode to. A null text has no ids and decodes to ''."""
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary_path(), decoded="decoded")
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixture),
    ("bpe", encoding),
]

#: Learned rules, a random mix and BPE are beyond SQL; tests/llm/test_pipeline.py holds the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, each result written to the shared folder and read again; a
    stage's result goes when the next one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, before)
    return docs
