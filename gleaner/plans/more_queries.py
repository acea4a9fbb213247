"""Work lists, audits, batches and run totals over the project view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rules, urls
from ..operators import keyed
from ..sources import scans
from ..streaming import ingest
from . import view
from .queries import PRODUCTS, SQL_CLASS, SQL_DOC_LINKS, SQL_GROUP, SQL_NORMAL, SQL_TIER, document_links, products, query, read, repos, scored
from .static_queries import landed_pages

DUE = {"updated_days": "CASE WHEN repository_id % 5 = 0 THEN NULL ELSE CAST(repository_id % 60 AS INT) END", "readme_status": "CASE repository_id % 4 WHEN 0 THEN 'FETCHED' WHEN 1 THEN 'PENDING' WHEN 2 THEN 'FAILED' ELSE 'MISSING' END"}


@query(view.SQL + f""", d AS (SELECT repository_id, status, {DUE["updated_days"]} AS updated_days, {DUE["readme_status"]} AS readme_status FROM repo)
 SELECT repository_id, coalesce(status IN ('PENDING', 'IN_PROGRESS', 'FAILED', 'RATE_LIMITED') AND updated_days IS NULL, false) AS missing, coalesce(status IN ('PENDING', 'IN_PROGRESS', 'FAILED', 'RATE_LIMITED') OR (status = 'ENRICHED' AND (updated_days IS NULL OR updated_days > 30)), false) AS due,
 coalesce(status = 'ENRICHED' AND (readme_status IN ('PENDING', 'FAILED') OR (readme_status = 'FETCHED' AND updated_days > 30)), false) AS readme_due FROM d""")
def refresh_work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which repositories need metadata for the first time, metadata again, or a README."""
    now = F.lit("2026-08-24").cast("timestamp")
    rows = repos(spark, sf_dir).selectExpr("repository_id", "status", *[f"{e} AS {c}" for c, e in DUE.items()]).withColumn("updated", now - F.make_dt_interval("updated_days"))
    candidate = F.when(F.col("status") == "ENRICHED", "CANDIDATE").otherwise("REVIEW")
    status, updated = F.col("status"), F.col("updated")
    no = F.lit(False)
    return rows.select("repository_id", F.coalesce(rules.needs_metadata(status, updated, now), no).alias("missing"), F.coalesce(rules.needs_metadata(status, updated, now, 30), no).alias("due"), F.coalesce(rules.needs_readme(candidate, F.col("readme_status"), updated, now), no).alias("readme_due"))


@query(SQL_DOC_LINKS + """ SELECT doc_id, CASE WHEN is_repo THEN canonical ELSE NULL END AS stored, CASE WHEN NOT is_repo THEN NULL ELSE doc_id % 20 <> 0 END AS agrees FROM k WHERE on_host""")
def link_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw links to the code host against the stored discovery of their document; one in twenty is stored wrongly."""
    links = document_links(spark, sf_dir).where("kind is not null")
    stored = links.where("repo is not null").select("doc_id", F.col("repo.canonical_url").alias("stored"), F.when(F.col("doc_id") % 20 == 0, "someone").otherwise(F.col("repo.owner")).alias("owner"), F.col("repo.repo").alias("name"))
    joined = links.join(stored, "doc_id", "left")
    return joined.select("doc_id", "stored", ((F.col("repo.owner") == F.col("owner")) & (F.col("repo.repo") == F.col("name"))).alias("agrees"))


@query("""WITH q AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'), n AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS i FROM q)
 SELECT conv_id, turn, CAST(floor(i / 12) AS INT) AS batch, substring(trim(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')), 1, 220) AS excerpt FROM n""")
def request_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All requests in order, in batches of twelve, each with an excerpt."""
    rows = keyed.numbered(read(spark, sf_dir, "conversations").where("role = 'user'"), "conv_id", "turn")
    return rows.select("conv_id", "turn", F.floor(F.col("number") / 12).cast("int").alias("batch"), F.substring(F.trim(F.regexp_replace("text", r"\s+", " ")), 1, 220).alias("excerpt"))


SQL_SEARCHED = "repository_id % 3 <> 0"


@query(PRODUCTS + f""", d AS (SELECT *, {DUE["updated_days"]} AS updated_days, {DUE["readme_status"]} AS readme_status FROM products) SELECT repository_id FROM d WHERE {SQL_SEARCHED} AND {SQL_CLASS} = 'PERMISSIVE' AND status = 'ENRICHED' AND NOT archived AND NOT disabled AND repository_id % 7 <> 0 AND days <= 365
 AND kind IN ('APPLICATION', 'STARTER', 'BOILERPLATE', 'UNKNOWN') AND (readme_status IN ('PENDING', 'FAILED') OR (readme_status = 'FETCHED' AND updated_days > 30))""")
def readmes_of_searched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repositories that a search has found (there is a hit of them), whose README is to be read."""
    now = F.lit("2026-08-24").cast("timestamp")
    rows = products(spark, sf_dir).selectExpr("*", *[f"{e} AS {c}" for c, e in DUE.items()]).withColumn("updated", now - F.make_dt_interval("updated_days")).withColumn("fork", F.col("repository_id") % 7 == 0)
    hits = read(spark, sf_dir, "documents").where("doc_id % 3 <> 0").select(F.col("doc_id").alias("repository_id"))
    wanted = rules.readme_prefilter(F.col("status"), F.col("licence"), F.col("archived"), F.col("disabled"), F.col("fork"), F.col("days"), F.col("kind")) & rules.readme_due(F.col("readme_status"), F.col("updated"), now)
    return keyed.pruned(rows.where(wanted).select("repository_id"), hits, ["repository_id"])


SQL_POOLS = view.SQL + f""", v1 AS (SELECT repository_id, bundle, category FROM repo WHERE bundle >= 65 AND repository_id % 2 = 0), v2 AS (SELECT repository_id, CAST((repository_id * 13) % 101 AS INT) AS bundle, category, repository_id % 5 < 2 AS seen FROM repo WHERE (repository_id * 13) % 101 >= 65 AND repository_id % 3 = 0),
 p2 AS (SELECT repository_id, coalesce(v2.bundle, v1.bundle) AS bundle, CASE WHEN v2.repository_id IS NULL THEN 'existing_v1' WHEN seen THEN 'rescued_false_negative' ELSE 'new_gap_fill' END AS origin FROM v1 FULL JOIN v2 USING (repository_id)),
 b AS (SELECT repository_id, CAST((repository_id * 17) % 101 AS INT) AS bundle, repository_id % 4 = 0 AS reused FROM repo WHERE (repository_id * 17) % 101 >= 65 AND repository_id % 7 < 3)"""


@query(SQL_POOLS + """ SELECT repository_id, p2.origin AS origin_v2, CASE WHEN b.repository_id IS NULL THEN 'github_radar_v2' WHEN reused THEN 'reused_existing_analysis' ELSE 'github_search_business' END AS origin_v3, coalesce(b.bundle, p2.bundle) AS bundle, b.repository_id IS NOT NULL AND p2.repository_id IS NOT NULL AS replaced FROM p2 FULL JOIN b USING (repository_id)""")
def pool_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two merges of pools, later tables winning, with where each row came from."""
    rows = repos(spark, sf_dir)
    v1 = rows.where("bundle >= 65 and repository_id % 2 = 0").select("repository_id", "bundle", F.lit("existing_v1").alias("origin_v2"))
    v2 = rows.where("(repository_id * 13) % 101 >= 65 and repository_id % 3 = 0").select("repository_id", ((F.col("repository_id") * 13) % 101).cast("int").alias("bundle"), F.when(F.col("repository_id") % 5 < 2, "rescued_false_negative").otherwise("new_gap_fill").alias("origin_v2"))
    pool = keyed.later_wins(v1, v2, keys=["repository_id"])
    business = rows.where("(repository_id * 17) % 101 >= 65 and repository_id % 7 < 3").select("repository_id", ((F.col("repository_id") * 17) % 101).cast("int").alias("bundle"), F.when(F.col("repository_id") % 4 == 0, "reused_existing_analysis").otherwise("github_search_business").alias("origin_v3"))
    third = keyed.later_wins(pool.select("repository_id", "bundle", F.lit("github_radar_v2").alias("origin_v3")), business, keys=["repository_id"])
    both = third.join(pool.select("repository_id", "origin_v2"), "repository_id", "left")
    return both.select("repository_id", "origin_v2", "origin_v3", "bundle", (F.col("origin_v2").isNotNull() & (F.col("origin_v3") != "github_radar_v2")).alias("replaced"))


@query(view.SQL + """, r AS (SELECT repository_id, category, bundle, row_number() OVER (PARTITION BY category ORDER BY bundle DESC NULLS FIRST, repository_id) AS rank, count(*) OVER (PARTITION BY category) AS n FROM repo WHERE category IN ('CRM', 'BOOKING', 'INVOICING', 'POS') AND bundle >= 65)
 SELECT repository_id, category, CAST(rank AS INT) AS rank, n >= 3 AS enough FROM r WHERE rank <= 3""")
def critical_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best three of each critical category, and whether there are three."""
    rows = repos(spark, sf_dir).where("category in ('CRM', 'BOOKING', 'INVOICING', 'POS') and bundle >= 65").select("repository_id", "category", "bundle")
    top = keyed.top_per_key(rows, ["category"], [F.desc_nulls_first("bundle"), F.asc("repository_id")], 3)
    counts = rows.groupBy("category").agg((F.count("*") >= 3).alias("enough"))
    return top.join(counts, "category").select("repository_id", "category", "rank", "enough")


# Categories whose leaders are audited.
CRITICAL = ["CRM", "BOOKING", "HR", "INVOICING", "CUSTOMER_SUPPORT", "PROJECT_MANAGEMENT", "PROPERTY_MANAGEMENT", "LMS", "POS", "INVENTORY"]


@query(view.SQL + f""", m AS (SELECT *, {SQL_NORMAL} AS category_v2 FROM repo WHERE is_complete), c AS (SELECT unnest([{", ".join(f"'{c}'" for c in CRITICAL)}]) AS category)
 SELECT c.category, least(3, count(m.repository_id)) AS found, count(m.repository_id) >= 3 AS enough FROM c LEFT JOIN m ON m.category_v2 = c.category GROUP BY c.category""")
def critical_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each of ten critical categories, also those without a row, how many leaders an audit finds, and whether they are three."""
    rows = repos(spark, sf_dir).where("is_complete").select("repository_id", rules.normalized_category(F.col("category")).alias("category"), "bundle")
    top = keyed.top_per_key(rows.where(F.col("category").isin(CRITICAL)), ["category"], [F.desc_nulls_first("bundle"), F.asc("repository_id")], 3)
    return keyed.leaders(top, "category", CRITICAL, 3)


@query("""SELECT role AS status, count(*) AS requests, sum(length(text)) AS characters, count(DISTINCT conv_id) AS runs, count(*) = (SELECT count(*) FROM conversations) AS complete FROM conversations GROUP BY role""")
def run_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    each = rows.groupBy("role", "conv_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("c"))
    by_status = each.groupBy(F.col("role").alias("status")).agg(F.sum("n").alias("requests"), F.sum("c").alias("characters"), F.count("*").alias("runs"))
    total = by_status.agg(F.sum("requests")).scalar()
    return by_status.select("status", "requests", "characters", "runs", (F.col("requests") == total).alias("complete"))


@query("""WITH r AS (SELECT conv_id % 5 AS version, conv_id, turn, role, length(text) AS n FROM conversations), u AS (SELECT * FROM r WHERE role = 'user'), a AS (SELECT conv_id, turn - 1 AS turn, n FROM r WHERE role <> 'user')
 SELECT version, count(*) AS pool, count(a.n) AS completed, count(*) - count(a.n) AS failed, CAST(sum(u.n) AS BIGINT) AS input_size, CAST(coalesce(sum(a.n), 0) AS BIGINT) AS output_size, CASE WHEN count(a.n) = count(*) THEN 'COMPLETED' ELSE 'FAILED' END AS status FROM u LEFT JOIN a ON a.conv_id = u.conv_id AND a.turn = u.turn GROUP BY version""")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs by version: requests, answers, sizes of both, and complete only if every row of the pool has its answer."""
    rows = read(spark, sf_dir, "conversations").select((F.col("conv_id") % 5).alias("version"), "conv_id", "turn", "role", F.length("text").alias("n"))
    answers = rows.where("role <> 'user'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("n").alias("out"))
    sums = rows.where("role = 'user'").join(answers, ["conv_id", "turn"], "left").groupBy("version").agg(F.count("*").alias("pool"), F.count("out").alias("completed"), F.sum("n").alias("input_size"), F.coalesce(F.sum("out"), F.lit(0)).alias("output_size"))
    return sums.select("version", "pool", "completed", (F.col("pool") - F.col("completed")).alias("failed"), "input_size", "output_size", F.when(F.col("completed") == F.col("pool"), "COMPLETED").otherwise("FAILED").alias("status"))


@query(view.SQL + f""", s AS (SELECT *, {SQL_GROUP} AS grp, {SQL_TIER} AS tier FROM repo) SELECT grp, tier, count(*) AS n, count_if(repository_id % 50 = 0) AS corrected, count_if(bundle >= 80 AND repository_id % 50 <> 0) AS passed FROM s GROUP BY grp, tier""")
def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = F.col("repository_id") % 50 == 0
    return scored(spark, sf_dir).groupBy("grp", "tier").agg(F.count("*").alias("n"), F.count_if(fixed).alias("corrected"), F.count_if((F.col("bundle") >= 80) & ~fixed).alias("passed"))


@query(view.SQL + """, a AS (SELECT repository_id AS id FROM repo WHERE bundle >= 60), b AS (SELECT repository_id AS id FROM repo WHERE is_complete) SELECT (SELECT count(*) FROM a) AS first, (SELECT count(*) FROM b) AS second, (SELECT count(*) FROM a JOIN b USING (id)) AS overlap, (SELECT count(*) FROM (SELECT id FROM a UNION SELECT id FROM b)) AS everything""")
def selection_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = repos(spark, sf_dir).select((F.col("bundle") >= 60).alias("a"), F.col("is_complete").alias("b"))
    return flags.agg(F.count_if("a").alias("first"), F.count_if("b").alias("second"), F.count_if(F.col("a") & F.col("b")).alias("overlap"), F.count_if(F.col("a") | F.col("b")).alias("everything"))


@query("""SELECT doc_id, doc_id IN (SELECT o_custkey FROM orders) AS has_publication FROM documents""")
def known_and_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose id has an order, and those without: new against known."""
    documents = read(spark, sf_dir, "documents").select("doc_id")
    known = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"))
    return keyed.flagged(documents, known, "doc_id", "has_publication")


@query("SELECT count(*) AS messages, count(*) AS links, count(*) AS duplicates, count_if(page_id % 3 = 0) AS known FROM pages")
def ingest_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of one batch in which every page stands twice and a third of the messages is known."""
    pages = landed_pages(spark, sf_dir)
    batch = scans.typed_messages(scans.page_messages(pages.union(pages)))
    known = read(spark, sf_dir, "pages").where("page_id % 3 = 0").select(F.lit("chan").alias("channel"), F.col("page_id").alias("message_id"))
    return ingest.batch_counters(batch, known)


@query("SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'PENDING' WHEN page_id % 4 = 1 THEN 'DROP' ELSE NULL END AS reason FROM pages WHERE page_id % 4 < 2")
def reinspect_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inspections that are open or failed, and all that were dropped."""
    rows = read(spark, sf_dir, "pages").selectExpr("page_id", "CASE page_id % 4 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'COMPLETED' ELSE 'COMPLETED' END AS status", "CASE WHEN page_id % 4 = 1 THEN 'DROP' ELSE 'REVIEW' END AS decision")
    open_ = F.col("status").isin("PENDING", "FAILED", "CLONE_FAILED")
    return rows.where(open_ | (F.col("decision") == "DROP")).select("page_id", F.when(open_, F.col("status")).otherwise(F.col("decision")).alias("reason"))


@query()
def shortlist_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .queries import shortlisted

    return shortlisted(spark, sf_dir)[0].groupBy("grp").agg(F.count("*").alias("n"), F.min("final_rank").alias("best"))


@query("""SELECT page_id, len(list_distinct(list_filter(regexp_extract_all(html, 'href="([^"]*)"', 1), lambda x: x <> ''))) AS n_links, regexp_matches(url, '^https?://[^/]+/') AS is_page FROM pages""")
def page_link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return read(spark, sf_dir, "pages").select("page_id", F.size(F.array_distinct(F.filter(raw, lambda x: x != ""))).cast("long").alias("n_links"), F.regexp_extract(urls.normalize_url(F.col("url")), urls.PARTS, 2).rlike(".").alias("is_page"))
