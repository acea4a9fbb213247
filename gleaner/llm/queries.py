"""The queries of this subpackage, one for each operator, over the whole tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, fingerprints, html_extract, licenses, ngram_join, oracle_sql, packing, quality, ranking, secrets, token_files, toxicity, whitening
from .common import staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), k=4, per_cent=85)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.array_join("blocks", " ")
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"), "n_template", "n_marked")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents")).select("doc_id", "quality.*")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secrets.BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths in words; a cluster is the documents of one text but for letter case and white space."""
    plain = F.lower(F.btrim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")))
    words = F.when(plain == "", 0).otherwise(F.length(plain) - F.length(F.translate(plain, " ", "")) + 1)
    return packing.best_fit(table(spark, sf_dir, "documents"), F.coalesce(words, F.lit(0)), F.xxhash64(plain))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.with_next(table(spark, sf_dir, "documents"))
    edited = fingerprints.half_replaced(F.col("text"), F.col("next_text"))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "text", "next_text", edited.alias("edited"))
    prints = rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.fingerprint(F.col("text")).alias("fingerprint"), fingerprints.fingerprint(F.col("edited")).alias("edited_fingerprint"), fingerprints.fingerprint(F.col("next_text")).alias("next_fingerprint"),
    )
    near_edited = fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint"))
    near_next = fingerprints.likeness(F.col("fingerprint"), F.col("next_fingerprint"))
    places = fingerprints.edited_places(F.col("fingerprint"), F.col("edited_fingerprint"))
    return prints.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near_edited.alias("near_edited"), near_next.alias("near_next"), F.get(places, F.lit(0)).alias("first_edited_section"), F.size(places).alias("n_edited_sections"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_checksums(spark, token_files.write_token_files(table(spark, sf_dir, "documents")))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("byte_bpe_50k.json", "piece_bpe_32k.model")
    sizes = [alignment.tokenizer(name).size for name in names]
    pairs = alignment.token_pairs(table(spark, sf_dir, "documents"), *names)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    pairs = staged(pairs.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"), "codes", "times"))
    return alignment.with_pair_counts(pairs, alignment.pair_counts(pairs, *sizes), *sizes)


def op12_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(ranking.measured(table(spark, sf_dir, "documents")))
    scored = ranking.score_measured(rows, ranking.fit_measured(rows, table(spark, sf_dir, "labels"), at=0.7))
    return scored.select("doc_id", (ranking.fold(F.col("doc_id")) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=4)


QUERIES = {f.__name__: f for f in (op1_bpe, op2_ngram_join, op3_html, op4_licenses, op5_toxicity, op6_quality, op7_secrets, op8_packing, op9_fingerprints, op10_token_files, op11_alignment, op12_quality_ranking, op13_whitening)}
ORACLE_SQL: dict[str, str] = dict(oracle_sql.ORACLE_SQL)
