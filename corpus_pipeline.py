"""A corpus pipeline: quality rules, toxicity, near-duplicate removal, secret masking, packing.

Each stage takes rows as they come. Null texts count as empty: they fail the quality rules, and where a
stage gets some nevertheless, they are scored, never near copies, without secrets, and packed at length
0. Rows with null ids are scored, masked and packed like any others and never near copies. Repeated rows
get one verdict from quality and toxicity; of those of one id, the near-duplicate stage keeps one. Very
long texts are read whole. Ties are broken by the smallest id. Empty tables give empty tables. All but
the last stage return the columns they got, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import ngram_join, packing, quality, secrets, toxicity
from gleaner.llm.common import columns, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject, and the frequent lines of the others; n_chars follows the new text."""
    return quality.without_boilerplate(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents scored as toxic; the model learns from the labelled rows that are left."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by a Jaccard similarity of 0.8 or more of five-word shingles."""
    return ngram_join.without_near_duplicates(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in texts by a mark of their kind; n_chars follows the new text."""
    masked = secrets.masked(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length(F.coalesce("text", F.lit(""))).cast("long"))).select(columns(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs documents into bins of 4,096 words; documents of one text never share a bin."""
    plain = F.lower(F.btrim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")))
    words = F.when(plain == "", 0).otherwise(F.length(plain) - F.length(F.translate(plain, " ", "")) + 1)
    return packing.best_fit(docs, F.coalesce(words, F.lit(0)), F.xxhash64(plain))


STAGES = [("quality rules", quality_stage), ("toxicity", toxicity_stage), ("n-gram Jaccard join", duplicates_stage), ("secret scans", secrets_stage), ("best-fit packing", packing_stage)]
#: Trees, joins by similarity and packing have no SQL form; the tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
