"""Queries over a folder of parquet tables, each beside the SQL that states the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import outcomes, rules, static, urls
from ..functions.literal_index import Indexed
from ..operators import keyed, shortlist, similarity
from ..sources import scans
from . import view
from .view import choose, repos

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
NOW = "2026-08-24"


def query(sql: str | None = None):
    """Registers a query under its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are computed once a row: inline() keeps the optimizer from copying them to each place that uses one."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_has(field: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({field}, {q('(?i)' + pattern)}), false)"


def sql_points(condition: str, n: int) -> str:
    return f"(CASE WHEN {condition} THEN {n} ELSE 0 END)"


def sql_in(values) -> str:
    return "(" + ", ".join(map(q, values)) + ")"


def sql_first(field: str, patterns: list[tuple[str, str]], other: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {sql_has(field, p)} THEN {q(label)}" for p, label in patterns) + f" ELSE {other} END"


# --- Links -----------------------------------------------------------------------------------------

SQL_ENCODED = """CASE WHEN regexp_matches({0}, '[^!#-;=?-_a-z|~]') THEN array_to_string(list_transform(string_split({0}, ''), lambda c: CASE WHEN c > '~' OR c IN (' ', '"', '<', '>', '`', '{{', '}}')
 THEN regexp_replace(hex(encode(c)), '(..)', '%\\1', 'g') ELSE c END), '') ELSE {0} END"""
SQL_LINKS = f"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS raw FROM pages),
 b AS (SELECT page_id, url, regexp_replace(trim(raw), '[),.;:!?\\]}}]+$', '') AS link FROM a),
 c AS (SELECT page_id, CASE WHEN regexp_matches(link, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN link WHEN starts_with(link, '/') THEN concat(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*'), link) ELSE NULL END AS link FROM b),
 d AS (SELECT page_id, lower(regexp_extract(link, '^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)(\\?[^#]*)?', 1)) AS scheme, lower(regexp_extract(link, '^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)(\\?[^#]*)?', 2)) AS host,
  regexp_extract(link, '^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)(\\?[^#]*)?', 3) AS path FROM c),
 targets AS (SELECT DISTINCT page_id, concat(scheme, '://', host, '/', split_part({SQL_ENCODED.format("path")}, '/', 2)) AS target FROM d WHERE scheme IN ('http', 'https'))"""


def link_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("raw"))
    link = urls.normalize_url(F.col("raw"), F.col("url"))
    found = pages.select("page_id", link.alias("link")).where("link is not null")
    target = F.concat(F.regexp_extract("link", r"^[^/]+//[^/?#]+", 0), F.lit("/"), F.get(F.split(F.regexp_extract("link", urls.PARTS, 3), "/"), F.lit(1)))
    return found.select("page_id", target.alias("target")).distinct()


@query(SQL_LINKS + " SELECT target, count(*) AS n_pages FROM targets GROUP BY target ORDER BY n_pages DESC, target LIMIT 20")
def top_link_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_targets(spark, sf_dir).groupBy("target").agg(F.count("*").alias("n_pages")).orderBy(F.desc("n_pages"), "target").limit(20)


@query("""WITH c AS (SELECT page_id, url, concat(lower(regexp_extract(url, '^([a-zA-Z]+)://([^/?#]*)', 1)), '://', lower(regexp_extract(url, '^([a-zA-Z]+)://([^/?#]*)', 2)),
 CASE WHEN regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^#]*)', 1) END) AS canonical FROM pages)
 SELECT canonical, min(page_id) AS first_page, count(*) AS copies FROM c GROUP BY canonical""")
def url_canonical_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", urls.normalize_url(F.col("url")).alias("canonical"))
    return pages.groupBy("canonical").agg(F.min("page_id").alias("first_page"), F.count("*").alias("copies"))


LINK = f"concat(CASE WHEN doc_id % 4 = 0 THEN 'https://GitHub.com/' WHEN doc_id % 4 = 1 THEN 'github.com/' WHEN doc_id % 4 = 2 THEN 'http://www.github.com:80/' ELSE 'https://example.org/' END, CASE WHEN doc_id % 9 = 0 THEN 'topics' ELSE upper(source) END, '/Repo', CAST(doc_id % 50 AS STRING), {choose(8, ['', '.git', '/issues/1', '/tree/main', '/blob/x', '/releases).', '/wiki', '#top'])})"


def document_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").selectExpr("doc_id", f"{LINK} AS link")
    return rows.withColumn("kind", urls.link_kind(F.col("link"))).withColumn("repo", urls.repository_link(F.col("link")))


SQL_DOC_LINKS = f"""WITH l AS (SELECT doc_id, {LINK} AS link FROM documents), k AS (SELECT doc_id, doc_id % 4 <> 3 AS on_host, doc_id % 4 <> 3 AND doc_id % 9 <> 0 AS is_repo,
 concat('https://github.com/', lower(regexp_extract(link, '/(src[0-9]+|SRC[0-9]+)/', 1)), '/repo', CAST(doc_id % 50 AS STRING)) AS canonical,
 CASE doc_id % 8 WHEN 2 THEN 'issues' WHEN 3 THEN 'tree' WHEN 4 THEN 'blob' WHEN 5 THEN 'releases' WHEN 6 THEN 'other' ELSE 'root' END AS kind, doc_id % 8 = 1 AS dot_git FROM l)"""


@query(SQL_DOC_LINKS + " SELECT CASE WHEN is_repo THEN kind ELSE NULL END AS path_kind, dot_git AS has_dot_git, count(*) AS n FROM k WHERE on_host GROUP BY 1, 2")
def link_path_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_links(spark, sf_dir).where("kind is not null")
    return rows.groupBy(F.col("kind.path_kind").alias("path_kind"), F.col("kind.has_dot_git").alias("has_dot_git")).agg(F.count("*").alias("n"))


@query(SQL_DOC_LINKS + """, e AS (SELECT canonical, count(DISTINCT doc_id) AS n FROM k WHERE is_repo GROUP BY canonical)
 SELECT count(*) AS links, count_if(on_host) AS host_links, count_if(is_repo) AS repository_links, count_if(on_host AND NOT is_repo) AS system_links, count_if(is_repo AND kind = 'issues') AS issue_links,
 count_if(on_host AND dot_git) AS dot_git_links, (SELECT count(*) FROM e) AS unique_repositories, count_if(is_repo) - (SELECT count(*) FROM e) AS duplicates, (SELECT count(*) FROM e WHERE n > 1) AS repeated FROM k""")
def extraction_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_links(spark, sf_dir)
    is_repo = F.col("repo").isNotNull()
    flags = rows.agg(
        F.count("*").alias("links"), F.count("kind").alias("host_links"), F.count("repo").alias("repository_links"), F.count_if(F.col("kind").isNotNull() & ~is_repo).alias("system_links"),
        F.count_if(F.col("kind.path_kind") == "issues").alias("issue_links"), F.count_if(F.col("kind.has_dot_git")).alias("dot_git_links"),
    )
    each = rows.where(is_repo).select("doc_id", "repo.canonical_url").distinct().groupBy("canonical_url").agg(F.count("*").alias("n"))
    totals = each.agg(F.count("*").alias("unique_repositories"), F.count_if(F.col("n") > 1).alias("repeated"))
    rows = flags.withColumn("t", totals.select(F.struct("unique_repositories", "repeated")).scalar())
    return rows.select(*flags.columns, "t.*", (F.col("repository_links") - F.col("t.unique_repositories")).alias("duplicates"))


# Four links of a document, the second into the repository of the first, and the last like the first.
LINK_AT = f"concat(CASE WHEN (doc_id + pos // 2) % 4 = 0 THEN 'https://GitHub.com/' WHEN (doc_id + pos // 2) % 4 = 1 THEN 'github.com/' WHEN (doc_id + pos // 2) % 4 = 2 THEN 'http://www.github.com:80/' ELSE 'https://example.org/' END, CASE WHEN (doc_id + pos // 2) % 9 = 0 THEN 'topics' ELSE upper(source) END, '/Repo', CAST((doc_id + pos // 2) % 50 AS STRING), {choose(8, ['', '.git', '/issues/1', '/tree/main', '/blob/x', '/releases).', '/wiki', '#top']).replace('doc_id', '(doc_id + pos)')})"
SQL_LINK_ARRAYS = f"""WITH x AS (SELECT doc_id, source, pos FROM documents CROSS JOIN (VALUES (0), (1), (2), (3)) v(pos)), l AS (SELECT doc_id, pos, {LINK_AT} AS link, source, (doc_id + pos // 2) AS d, (doc_id + pos) % 8 AS form FROM x),
 k AS (SELECT doc_id, pos, link, d % 4 <> 3 AS on_host, d % 4 <> 3 AND d % 9 <> 0 AS is_repo, concat('https://github.com/', lower(source), '/repo', CAST(d % 50 AS STRING)) AS canonical, form FROM l),
 f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, canonical ORDER BY pos) AS nth FROM k WHERE is_repo) WHERE nth = 1)"""


def placed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each link of each document with its place, kind and repository."""
    rows = read(spark, sf_dir, "documents").select("doc_id", "source", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("pos"))
    rows = rows.selectExpr("doc_id", "pos", LINK_AT.replace("pos // 2", "pos div 2") + " AS link")
    return once(rows, {"kind": urls.link_kind(F.col("link")), "repo": urls.repository_link(F.col("link"))})


@query(SQL_LINK_ARRAYS + " SELECT doc_id, canonical AS repository, link AS first_link, CAST(pos AS INT) AS place FROM f")
def first_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first link of a document to each repository; later ones to the same are ignored."""
    rows = placed_links(spark, sf_dir).where("repo is not null").select("doc_id", "pos", "link", F.col("repo.canonical_url").alias("repository"))
    first = rows.groupBy("doc_id", "repository").agg(F.min(F.struct("pos", "link")).alias("first"))
    return first.select("doc_id", "repository", F.col("first.link").alias("first_link"), F.col("first.pos").alias("place"))


@query(SQL_LINK_ARRAYS + """, e AS (SELECT canonical, count(*) AS n FROM f GROUP BY canonical) SELECT (SELECT count(*) FROM documents) AS messages, count_if(on_host) AS host_links, count_if(is_repo) AS repository_links, (SELECT count(*) FROM f) AS occurrences, count_if(on_host AND NOT is_repo) AS invalid_links,
 count_if(is_repo AND form = 2) AS issues, count_if(is_repo AND form = 3) AS tree, count_if(is_repo AND form = 4) AS blob, count_if(is_repo AND form = 5) AS releases, count_if(on_host AND form = 1) AS dot_git, count_if(is_repo AND form = 6) AS other_paths,
 (SELECT count(*) FROM e) AS unique_repositories, (SELECT count(*) FROM f) - (SELECT count(*) FROM e) AS duplicates, (SELECT count(*) FROM e WHERE n > 1) AS repeated FROM k""")
def extraction_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All counters of an extraction: links by kind, occurrences (a repository once a message), and repositories seen once or more."""
    rows = placed_links(spark, sf_dir)
    is_repo = F.col("repo").isNotNull()
    kinds = {"issues": "issues", "tree": "tree", "blob": "blob", "releases": "releases", "other_paths": "other"}
    each = rows.groupBy("doc_id").agg(
        F.count("kind").alias("host_links"), F.count("repo").alias("repository_links"), F.count_if(F.col("kind").isNotNull() & ~is_repo).alias("invalid_links"), F.count_if(F.col("kind.has_dot_git")).alias("dot_git"),
        *[F.count_if(is_repo & (F.col("kind.path_kind") == k)).alias(n) for n, k in kinds.items()],
    )
    sums = each.agg(F.count("*").alias("messages"), *[F.sum(c).alias(c) for c in each.columns if c != "doc_id"])
    by_repository = first_links(spark, sf_dir).groupBy("repository").agg(F.count("*").alias("n"))
    totals = by_repository.agg(F.sum("n").alias("occurrences"), F.count("*").alias("unique_repositories"), F.count_if(F.col("n") > 1).alias("repeated"))
    rows = sums.withColumn("t", totals.select(F.struct("*")).scalar())
    return rows.select(*sums.columns, "t.*", (F.col("t.occurrences") - F.col("t.unique_repositories")).alias("duplicates"))


VIEWS = choose(7, ["4.03K", "1,2K", "2M", "unknown", " 12 ", "3.5B", "4,030"])
DATES = choose(4, ["2025-01-02T04:00:00+00:00", "not a date", "2024-02-29T23:30:00+02:00", "2023-12-31T00:00:00Z"])
CHANNELS = choose(5, ["@some_channel", "https://t.me/s/Other_Channel/", "t.me/third", "x", "bad name"])


@query(f"""SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 4030 WHEN 1 THEN 1200 WHEN 2 THEN 2000000 WHEN 4 THEN 12 WHEN 5 THEN 3500000000 WHEN 6 THEN 4 ELSE NULL END AS views,
 CASE doc_id % 4 WHEN 0 THEN 1735790400 WHEN 2 THEN 1709242200 WHEN 3 THEN 1703980800 ELSE NULL END AS published, CASE doc_id % 5 WHEN 0 THEN 'some_channel' WHEN 1 THEN 'Other_Channel' WHEN 2 THEN 'third' ELSE NULL END AS channel FROM documents""")
def views_dates_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").selectExpr("doc_id", f"{VIEWS} AS v", f"{DATES} AS d", f"{CHANNELS} AS c")
    return rows.select("doc_id", urls.parse_views(F.col("v")).alias("views"), F.unix_seconds(urls.parse_date(F.col("d"))).alias("published"), urls.channel_name(F.col("c")).alias("channel"))


# --- Licences and screening ------------------------------------------------------------------------

SQL_CLASS = f"""CASE WHEN coalesce(upper(trim(spdx)), '') IN ('', 'NOASSERTION') THEN 'NO_LICENSE' WHEN upper(trim(spdx)) IN {sql_in(rules.PERMISSIVE)} THEN 'PERMISSIVE'
 WHEN regexp_matches(upper(trim(spdx)), '^(?:AGPL|GPL|LGPL)-|^MPL-') THEN 'COPYLEFT' WHEN {" OR ".join(f"contains(upper(trim(spdx)), {q(m)})" for m in rules.RESTRICTED)} THEN 'RESTRICTED' ELSE 'UNKNOWN' END"""
SQL_GATE = f"""CASE WHEN coalesce(status = 'UNAVAILABLE', false) OR coalesce(archived, false) OR coalesce(disabled, false) OR {SQL_CLASS} = 'RESTRICTED' THEN 'EXCLUDED'
 WHEN coalesce(status = 'ENRICHED' AND {SQL_CLASS} = 'PERMISSIVE' AND days <= 365, false) THEN 'CANDIDATE' ELSE 'REVIEW' END"""


@query(view.SQL + f""", t AS (SELECT repository_id, {sql_first("text", rules.LICENCE_TEXTS)} AS detected, CASE WHEN coalesce(spdx, '') <> '' THEN coalesce({sql_first("spdx", rules.LICENCE_IDS)}, upper(spdx)) ELSE NULL END AS family, {SQL_CLASS} AS category FROM repo)
 SELECT repository_id, detected, family, category, CASE WHEN detected IS NOT NULL AND family IS NOT NULL THEN detected = family ELSE NULL END AS matches FROM t""")
def licence_text_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = once(repos(spark, sf_dir), {"low": rules.lowered(F.col("text"))})
    rows = once(rows, {"detected": rules.licence_in_text(F.col("low"), True), "family": rules.licence_family(F.col("spdx"))})
    detected, family = F.col("detected"), F.col("family")
    return rows.select("repository_id", detected.alias("detected"), family.alias("family"), rules.licence_class(F.col("spdx"))["category"].alias("category"), rules.licence_matches(detected, family).alias("matches"))


def gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repos(spark, sf_dir).withColumn("licence", rules.licence_class(F.col("spdx"))["category"])
    return rows.withColumn("gate", rules.metadata_gate(F.col("status"), F.col("archived"), F.col("disabled"), F.col("licence"), F.col("days")))


@query(view.SQL + f"""SELECT s.v AS gate, l.v AS licence, count(repository_id) AS n, count_if(coalesce(active, false)) AS active FROM (VALUES ('CANDIDATE'), ('REVIEW'), ('EXCLUDED')) s(v) CROSS JOIN (VALUES ('PERMISSIVE'), ('COPYLEFT'), ('RESTRICTED'), ('NO_LICENSE'), ('UNKNOWN')) l(v)
 LEFT JOIN (SELECT repository_id, {SQL_GATE} AS gate, {SQL_CLASS} AS licence, {SQL_CLASS} = 'PERMISSIVE' AND NOT archived AND NOT disabled AND days <= 365 AS active FROM repo) r ON r.gate = s.v AND r.licence = l.v GROUP BY 1, 2""")
def status_counts_zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gated(spark, sf_dir)
    active = rules.active_permissive(F.col("licence"), F.col("archived"), F.col("disabled"), F.col("days"))
    counts = rows.groupBy("gate", "licence").agg(F.count("*").alias("n"), F.count_if(active).alias("active"))
    every = spark.createDataFrame([(g, c) for g in ("CANDIDATE", "REVIEW", "EXCLUDED") for c in ("PERMISSIVE", "COPYLEFT", "RESTRICTED", "NO_LICENSE", "UNKNOWN")], "gate string, licence string")
    return every.join(counts, ["gate", "licence"], "left").fillna(0, ["n", "active"])


FIELDS = """, f AS (SELECT *, lower(concat_ws(' ', coalesce(name, ''), coalesce(description, ''))) AS title, lower(concat_ws(' ', coalesce(name, ''), coalesce(description, ''), coalesce(topics, ''))) AS identity, lower(coalesce(readme, '')) AS low_readme,
 lower(concat_ws(' ', coalesce(name, ''), coalesce(description, ''), coalesce(topics, ''), coalesce(homepage, ''), coalesce(readme, ''))) AS everything FROM repo)"""
SQL_FIELD = {"title": "title", "identity": "identity", "readme": "low_readme", "everything": "everything"}
SQL_SIGNALS = [(sql_has(SQL_FIELD[f], p), n, reason, app) for f, p, n, reason, app in rules.SIGNALS] + [("coalesce(homepage, '') <> ''", 4, "project homepage", False)]
PRODUCTS = (
    view.SQL + FIELDS + f""", s AS (SELECT *, {sql_points("coalesce(readme, '') <> ''", 4)} + {" + ".join(sql_points(c, n) for c, n, _, _ in SQL_SIGNALS)} AS raw_score, {" + ".join(sql_points(c, 1) for c, _, _, a in SQL_SIGNALS if a)} AS app_signals,
 {" + ".join(sql_points(c, 1) for c, _, _, _ in SQL_SIGNALS)} AS n_reasons FROM f),
 k AS (SELECT *, CASE {" ".join(f"WHEN {sql_has(SQL_FIELD[f], p)} THEN {q(kind)}" for kind, f, p in rules.KINDS)} WHEN app_signals >= 3 OR (app_signals >= 2 AND raw_score >= 45) THEN 'APPLICATION' ELSE 'UNKNOWN' END AS kind FROM s),
 p AS (SELECT *, least(100, greatest(0, raw_score - CASE WHEN kind IN {sql_in(rules.EXCLUDED_KINDS)} THEN 45 WHEN kind IN ('LIBRARY', 'FRAMEWORK') THEN 22 WHEN kind IN ('CLI_TOOL', 'DEV_TOOL') THEN 12 ELSE 0 END)) AS product,
 least(100, CASE WHEN kind = 'APPLICATION' THEN 28 WHEN kind IN ('BOILERPLATE', 'STARTER') THEN 16 ELSE 0 END + {sql_points(sql_has("low_readme", rules.PREVIEW) + " OR coalesce(homepage, '') <> ''", 10)}
 + {sql_points(sql_has("low_readme", rules.SETUP), 12)} + {sql_points(sql_has("everything", rules.BUSINESS_USE), 14)} + {sql_points(sql_has("everything", rules.CUSTOMISING), 10)}
 + CASE WHEN days IS NULL THEN 0 WHEN days <= 30 THEN 10 WHEN days <= 90 THEN 8 WHEN days <= 365 THEN 5 ELSE 1 END + CASE WHEN coalesce(stars, 0) >= 1000 THEN 3 WHEN coalesce(stars, 0) >= 100 THEN 2 WHEN coalesce(stars, 0) > 0 THEN 1 ELSE 0 END) AS template, {SQL_GATE} AS gate FROM k),
 products AS (SELECT *, CASE WHEN gate = 'EXCLUDED' OR kind IN {sql_in(rules.EXCLUDED_KINDS)} THEN 'EXCLUDED' WHEN gate = 'CANDIDATE' AND (kind = 'APPLICATION' OR (kind IN ('STARTER', 'BOILERPLATE') AND template >= 50)) THEN 'CANDIDATE' ELSE 'REVIEW' END AS candidate_status FROM p)"""
)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repositories with product signals, kind, scores and status; each text is prepared once a row."""
    rows = view.topics_array(gated(spark, sf_dir))
    homepage, readme = F.col("homepage"), F.col("readme")
    rows = once(rows, {f"low_{k}": v for k, v in rules.product_fields(F.col("name"), F.col("description"), F.col("topic_list"), homepage, readme).items()})
    index = rules.literal_index(rules.product_patterns())
    rows = rows.withColumn("literals", index.found(F.col("low_everything")))
    fields = {k: Indexed(f"low_{k}", index, "literals", k == "everything") for k in ("title", "identity", "readme", "everything")}
    rows = once(rows, {"signals": rules.product_signals(fields, homepage, readme)})
    rows = once(rows, {"kind": rules.product_kind(fields, F.col("signals.score"), F.col("signals.app_signals"))})
    product = rules.clamp(F.col("signals.score") - rules.kind_penalty(F.col("kind")))
    rows = once(rows, {"product": product, "template": rules.template_potential(fields, F.col("kind"), homepage, F.col("days"), F.col("stars"))})
    return rows.drop("low_title", "low_identity", "low_everything", "literals").withColumn("candidate_status", rules.narrowed_status(F.col("gate"), F.col("kind"), F.col("template")))


@query(PRODUCTS + " SELECT repository_id, kind, product, template, CAST(app_signals AS INT) AS app_signals, CAST(n_reasons AS INT) AS n_reasons, candidate_status FROM products")
def product_kind_and_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products(spark, sf_dir).select("repository_id", "kind", "product", "template", "signals.app_signals", F.size("signals.reasons").alias("n_reasons"), "candidate_status")


SQL_ELIGIBLE = f"""candidate_status = 'REVIEW' AND kind NOT IN {sql_in(rules.EXCLUDED_KINDS)} AND coalesce(readme, '') <> '' AND CASE WHEN kind IN ('LIBRARY', 'FRAMEWORK') THEN product >= 55 AND template >= 55 AND {sql_has("readme", rules.REVIEW_LIBRARY)}
 ELSE product >= 25 OR template >= 40 OR kind IN ('APPLICATION', 'STARTER', 'BOILERPLATE') END"""
SQL_PRIORITY = "CASE kind " + " ".join(f"WHEN {q(k)} THEN {n}" for k, n in rules.KIND_PRIORITY.items()) + " ELSE 99 END"


@query(PRODUCTS + f""", u AS (SELECT repository_id AS id, 0 AS section, 0 AS priority, 0 AS signal FROM products WHERE candidate_status = 'CANDIDATE' UNION ALL SELECT repository_id, 1, {SQL_PRIORITY}, template * 2 + product FROM products WHERE {SQL_ELIGIBLE})
 SELECT id, CAST(row_number() OVER (ORDER BY section, priority, signal DESC, id) AS INT) AS pool_rank, CASE WHEN section = 0 THEN 'CANDIDATE' ELSE 'REVIEW' END AS source FROM u ORDER BY pool_rank LIMIT 300""")
def review_pool_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = products(spark, sf_dir)
    rows = similarity.staged(rows.select("repository_id", "candidate_status", "kind", "product", "template", rules.eligible_review(F.col("candidate_status"), F.col("kind"), F.col("product"), F.col("template"), F.col("readme")).alias("eligible")))
    reviews = rows.where("eligible")
    reviews = reviews.select(F.col("repository_id").alias("id"), rules.kind_priority(F.col("kind")).alias("priority"), (F.col("template") * 2 + F.col("product")).alias("signal"))
    return shortlist.pool_fill(rows.where("candidate_status = 'CANDIDATE'").select(F.col("repository_id").alias("id")), reviews, 300)


# --- Categories and gaps ---------------------------------------------------------------------------

WINDOW = 12_000


def discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repositories with ranked categories, discovery and standalone scores; rejected ones left out."""
    rows = products(spark, sf_dir)
    kind, none = F.col("kind"), F.lit("")
    name, text = F.regexp_replace("name", "[-_.]", " "), F.coalesce("description", none)
    topics, readme = F.regexp_replace(F.coalesce("topics", none), "[-_]", " "), F.substring(F.coalesce("readme", none), 1, WINDOW)
    parts = {"name": name, "text": text, "topics": topics, "readme": readme}
    rows = once(rows, {f"d_{k}": rules.lowered(v) for k, v in parts.items()})
    rows = once(rows, {"d_combined": F.concat_ws("\n", *[f"d_{k}" for k in parts])})
    groups = [*rules.CATEGORIES.values(), rules.STANDALONE, rules.NEGATIVE]
    index = rules.literal_index([p for patterns in groups for p in patterns])
    table = rules.PatternTable(groups, index)
    rows = rows.withColumn("literals", index.found(F.col("d_combined")))
    rows = once(rows, {"hits": table.hits("literals")})
    n = len(rules.CATEGORIES)
    rows = once(rows, {"business": F.slice("hits", 1, n), "signs": table.matches(f"slice(hits, {n + 1}, 2)", {"d_combined": 1})})
    bonus = F.when(kind == "APPLICATION", 25).when(kind.isin("STARTER", "BOILERPLATE"), 12).when(kind == "UNKNOWN", 5).otherwise(0)
    standalone = F.get("signs", F.lit(0)) * 5 + rules.points(F.coalesce("homepage", none) != "", 8) + bonus - F.get("signs", F.lit(1)) * 20
    developer = rules.has(F.concat_ws(" ", "d_name", "d_text", "d_topics"), rules.DEVELOPER_ONLY, True)
    rows = once(rows, {"standalone": F.least(F.lit(100), F.greatest(F.lit(0), standalone)), "developer": developer})
    rows = once(rows, {"metadata": table.matches("business", {"d_name": 10, "d_text": 8, "d_topics": 7}), "places": F.transform(table.occurrences("business", "d_readme"), lambda x: x * 2)})

    names = F.array(*map(F.lit, rules.CATEGORIES))
    scored = F.transform("metadata", lambda m, i: F.struct((-(m + F.get("places", i))).alias("minus"), i.alias("ordinal"), F.get(names, i).alias("category"), m.alias("metadata")))
    rows = once(rows, {"ranked": F.array_sort(F.filter(scored, lambda s: s["minus"] < 0))}).withColumn("top", F.get("ranked", F.lit(0)))
    weak = (F.col("top.metadata") == 0) & ((-F.col("top.minus") < 6) | (F.col("standalone") < 30) | F.col("developer"))
    rows = rows.where(F.col("top").isNotNull() & (F.col("standalone") >= 15) & ~weak)
    strong = F.transform(F.slice(F.filter("ranked", lambda s: s["minus"] <= -4), 1, 5), lambda s: s["category"])
    return rows.withColumn("categories", strong).withColumn("primary", F.col("top.category")).withColumn("discovery", F.least(F.lit(100), -F.col("top.minus") + F.col("standalone")))


def sql_matches(patterns: list[str], field: str) -> str:
    return "(" + " + ".join(sql_points(sql_has(field, p), 1) for p in patterns) + ")"


def sql_occurrences(patterns: list[str], field: str) -> str:
    return "(" + " + ".join(f"least(3, len(regexp_extract_all({field}, {q('(?i)' + p)})))" for p in patterns) + ")"


def sql_metadata(patterns: list[str]) -> str:
    return f"({sql_matches(patterns, 'd_name')} * 10 + {sql_matches(patterns, 'd_text')} * 8 + {sql_matches(patterns, 'd_topics')} * 7)"


DISCOVERED = (
    PRODUCTS + f""", d0 AS (SELECT *, regexp_replace(name, '[-_.]', ' ', 'g') AS d_name, coalesce(description, '') AS d_text, regexp_replace(coalesce(topics, ''), '[-_]', ' ', 'g') AS d_topics, substring(coalesce(readme, ''), 1, {WINDOW}) AS d_readme FROM products),
 d1 AS (SELECT *, concat_ws(chr(10), d_name, d_text, d_topics, d_readme) AS combined FROM d0),
 d2 AS (SELECT *, [{", ".join(f"{{'minus': -({sql_metadata(p)} + {sql_occurrences(p, 'd_readme')} * 2), 'ordinal': {i}, 'category': {q(c)}, 'metadata': {sql_metadata(p)}}}" for i, (c, p) in enumerate(rules.CATEGORIES.items()))}] AS everyone FROM d1),
 d3 AS (SELECT *, list_sort(list_filter(everyone, lambda s: s.minus < 0)) AS ranked, least(100, greatest(0, {sql_matches(rules.STANDALONE, "combined")} * 5 + {sql_points("coalesce(homepage, '') <> ''", 8)}
 + CASE WHEN kind = 'APPLICATION' THEN 25 WHEN kind IN ('STARTER', 'BOILERPLATE') THEN 12 WHEN kind = 'UNKNOWN' THEN 5 ELSE 0 END - {sql_matches(rules.NEGATIVE, "combined")} * 20)) AS standalone FROM d2),
 discovered AS (SELECT *, ranked[1].category AS "primary", list_transform(list_filter(ranked, lambda s: s.minus <= -4)[1:5], lambda s: s.category) AS categories, least(100, -ranked[1].minus + standalone) AS discovery FROM d3
 WHERE len(ranked) > 0 AND standalone >= 15 AND NOT (ranked[1].metadata = 0 AND (-ranked[1].minus < 6 OR standalone < 30 OR {sql_has("concat_ws(' ', d_name, d_text, d_topics)", rules.DEVELOPER_ONLY)})))"""
)


@query(DISCOVERED + """ SELECT repository_id, "primary" AS primary_category, array_to_string(categories, ',') AS categories, CAST(discovery AS INT) AS discovery, CAST(standalone AS INT) AS standalone FROM discovered""")
def category_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovered(spark, sf_dir).select("repository_id", F.col("primary").alias("primary_category"), F.array_join("categories", ",").alias("categories"), "discovery", "standalone")


def sql_overlap(categories: list[str]) -> str:
    return f"list_has_any(categories, [{', '.join(map(q, categories))}])"


def sql_quota(limit: int) -> str:
    steps, taken = [], []
    for i, (categories, quota) in enumerate(rules.GAP_TARGETS):
        rest = " AND ".join(f"id NOT IN (SELECT id FROM t{j})" for j in taken)
        steps.append(f"t{i} AS (SELECT id, {i + 1} AS target FROM pool WHERE {sql_overlap(categories)}{' AND ' + rest if rest else ''} ORDER BY discovery DESC, standalone DESC, id LIMIT {quota})")
        taken.append(i)
    chosen = " UNION ALL ".join(f"SELECT * FROM t{i}" for i in taken)
    return ", ".join(steps) + f", chosen AS ({chosen}), fill AS (SELECT id, 0 AS target FROM pool WHERE id NOT IN (SELECT id FROM chosen) ORDER BY discovery DESC, standalone DESC, id LIMIT (SELECT greatest(0, {limit} - count(*)) FROM chosen))"


@query(DISCOVERED + f""", pool AS (SELECT repository_id AS id, categories, discovery, standalone FROM discovered WHERE NOT (bundle >= 65)), {sql_quota(150)} SELECT * FROM chosen UNION ALL SELECT * FROM fill""")
def gap_quota_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repositories without a good earlier tier, by quota of category targets, then by score."""
    rows = discovered(spark, sf_dir).where(~rules.tier(F.col("bundle")).isin("STRONG", "POSSIBLE"))
    pool = similarity.staged(rows.select(F.col("repository_id").alias("id"), "categories", "discovery", "standalone"))
    return shortlist.quota_selection(pool, [F.desc("discovery"), F.desc("standalone"), F.asc("id")], limit=150)


# Evidence of an application that stands alone.
EVIDENCE = r"self[ -]?hosted|docker[ -]?compose|screenshots?|live demo|web application|frontend.{0,40}backend|authentication|deploy"


@query(PRODUCTS + f""", m AS (SELECT repository_id AS id, bundle < 50 AND is_complete AS required, {sql_points("is_complete", 70)} + {sql_points("kind = 'APPLICATION'", 35)} + {sql_points("product >= 70", 25)} + {sql_points("template >= 70", 20)} + {sql_points("coalesce(homepage, '') <> ''", 10)}
 + {sql_points(sql_has("readme", EVIDENCE), 15)} + {sql_points("repository_id = 37", 1000)} AS rank FROM products WHERE bundle < 65)
 SELECT id, required, CAST(rank AS INT) AS rank, CAST(row_number() OVER (ORDER BY required DESC, rank DESC, id) AS INT) AS position FROM m ORDER BY position LIMIT 100""")
def missed_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low-scored repositories with evidence for more, those marked complete first; 37 is on the mandatory list."""
    rows = products(spark, sf_dir).where(rules.tier(F.col("bundle")).isin("WEAK", "REJECT"))
    evidence = [(F.col("is_complete"), 70), (F.col("kind") == "APPLICATION", 35), (F.col("product") >= 70, 25), (F.col("template") >= 70, 20), (F.coalesce("homepage", F.lit("")) != "", 10), (rules.has(F.col("readme"), EVIDENCE), 15), (F.col("repository_id").isin(37), 1000)]
    rank = rules.total([rules.points(c, n) for c, n in evidence])
    rows = rows.select(F.col("repository_id").alias("id"), ((F.col("bundle") < 50) & F.col("is_complete")).alias("required"), rank.alias("rank"))
    order = [F.desc("required"), F.desc("rank"), F.asc("id")]
    return rows.orderBy(*order).limit(100).withColumn("position", F.row_number().over(Window.orderBy(*order)))


# --- Scores and shortlist --------------------------------------------------------------------------

PARTS = {"business_usefulness_score": "usefulness", "ease_of_deployment_score": "deployment", "ease_of_customization_score": "customization", "visual_value_score": "visual", "client_project_potential_score": "client_use", "end_user_clarity_score": "clarity"}
SQL_SCORE = f"CASE WHEN {' AND '.join(f'{c} IS NULL' for c in PARTS.values())} THEN bundle ELSE CAST(floor(" + "+".join(["bundle * CAST(0.52 AS DOUBLE)", *[f" coalesce({c}, bundle) * CAST({rules.SCORE_WEIGHTS[n]} AS DOUBLE)" for n, c in PARTS.items()]]) + " + 0.5) AS INT) END"
SQL_GROUP = "CASE " + " ".join(f"WHEN category IN {sql_in(c)} THEN {q(g)}" for g, (c, _, _) in rules.GROUPS.items()) + " ELSE 'OTHER_BUSINESS' END"
SQL_TIER = "CASE WHEN bundle >= 80 THEN 'STRONG' WHEN bundle >= 65 THEN 'POSSIBLE' WHEN bundle >= 50 THEN 'WEAK' ELSE 'REJECT' END"
SQL_NORMAL = f"CASE WHEN category IN {sql_in(rules.SAME_CATEGORY)} THEN category " + " ".join(f"WHEN category = {q(a)} THEN {q(b)}" for a, b in rules.OTHER_CATEGORY.items()) + " ELSE 'OTHER' END"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repos(spark, sf_dir)
    score = rules.selection_score(F.col("bundle"), {n: F.col(c) for n, c in PARTS.items()})
    return rows.withColumn("score", score).withColumn("grp", rules.category_group(F.col("category"))).withColumn("tier", rules.tier(F.col("bundle")))


@query(view.SQL + f""", s AS (SELECT *, {SQL_SCORE} AS score, {SQL_GROUP} AS grp FROM repo) SELECT repository_id, score, grp, {SQL_TIER} AS tier, {SQL_NORMAL} AS normalized, CASE WHEN deployment IS NULL THEN 'UNKNOWN' WHEN deployment >= 75 THEN 'LOW' WHEN deployment >= 50 THEN 'MEDIUM' ELSE 'HIGH' END AS complexity,
 concat(CASE WHEN bundle >= 80 THEN 'STRONG' ELSE 'POSSIBLE' END, ' commercial candidate; selected for ', grp, ' coverage with ', CAST(score AS VARCHAR), '/100 composite deployment, customization, visual and business value.') AS reason FROM s""")
def composite_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = shortlist.reason_selected(F.col("grp"), F.col("score"), F.col("bundle"))
    return scored(spark, sf_dir).select("repository_id", "score", "grp", "tier", rules.normalized_category(F.col("category")).alias("normalized"), rules.complexity(F.col("deployment")).alias("complexity"), reason.alias("reason"))


def shortlist_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir)
    words = rules.tokens(F.col("text"))
    return rows.select(F.col("repository_id").alias("id"), F.concat_ws("/", "owner", "name").alias("repository"), "grp", "bundle", "score", words.alias("tokens"))


def shortlisted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The shortlist and its near-duplicates; texts are read from their own table, so that the join of labels sends none."""
    tokens = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), rules.tokens(F.col("text")).alias("tokens"))
    return shortlist.diversity_shortlist(shortlist_rows(spark, sf_dir), tokens=tokens)


@query()
def diversity_shortlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortlisted(spark, sf_dir)[0]


@query()
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortlisted(spark, sf_dir)[1]


SQL_TOKENS = f"list_distinct(list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: length(w) >= 4 AND w NOT IN {sql_in(rules.STOP_WORDS)}))"


@query(f"""WITH t AS (SELECT doc_id, source, {SQL_TOKENS} AS tokens FROM documents), c AS (SELECT source, list_sort(tokens) AS tokens, min(doc_id) AS head, count(*) AS members FROM t WHERE len(tokens) > 0 GROUP BY ALL),
 p AS (SELECT x.source, x.head AS a, y.head AS b, len(list_intersect(x.tokens, y.tokens)) AS common, len(x.tokens) AS nx, len(y.tokens) AS ny FROM c x JOIN c y ON x.source = y.source AND x.head < y.head WHERE 100 * least(len(x.tokens), len(y.tokens)) >= 62 * greatest(len(x.tokens), len(y.tokens)))
 SELECT source, a, b, round(common / (nx + ny - common), 3) AS similarity FROM p WHERE common / (nx + ny - common) >= 0.62 UNION ALL SELECT t.source, c.head, t.doc_id, 1.0 FROM t JOIN c ON t.source = c.source AND list_sort(t.tokens) = c.tokens WHERE t.doc_id <> c.head""")
def token_jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of different token sets of one source by their smallest ids, and of each further copy with its set's smallest."""
    rows = read(spark, sf_dir, "documents").select("doc_id", "source", rules.tokens(F.col("text")).alias("tokens"))
    pairs = similarity.similar_pairs(rows, "doc_id", "source", "tokens")
    return pairs.select(F.col("group").alias("source"), "a", "b", F.round("similarity", 3).alias("similarity"))


# --- Reports ---------------------------------------------------------------------------------------

BANDS = [(0, 19), (20, 39), (40, 59), (60, 79), (80, 100)]


@query("SELECT " + ", ".join(f"count_if(p_size * 2 BETWEEN {a} AND {b}) AS size_{a}_{b}, count_if(CAST(floor(p_retailprice) AS INT) % 101 BETWEEN {a} AND {b}) AS price_{a}_{b}" for a, b in BANDS) + " FROM part")
def score_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, price = F.col("p_size") * 2, F.floor("p_retailprice").cast("int") % 101
    return read(spark, sf_dir, "part").agg(*[F.count_if(c.between(a, b)).alias(f"{n}_{a}_{b}") for a, b in BANDS for n, c in (("size", size), ("price", price))])


PART_TIER = "CASE WHEN p_size * 2 >= 80 THEN 'STRONG' WHEN p_size * 2 >= 65 THEN 'POSSIBLE' WHEN p_size * 2 >= 50 THEN 'WEAK' ELSE 'REJECT' END"
TIERS = ["STRONG", "POSSIBLE", "WEAK", "REJECT"]


@query("SELECT p_brand AS category, count(*) AS total, " + ", ".join(f"count_if({PART_TIER} = '{t}') AS {t.lower()}" for t in TIERS) + " FROM part GROUP BY p_brand")
def category_tier_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select(F.col("p_brand").alias("category"), rules.tier(F.col("p_size") * 2).alias("tier"))
    wide = rows.groupBy("category").pivot("tier", TIERS).agg(F.count(F.lit(1))).fillna(0)
    return wide.select("category", rules.total([F.col(t) for t in TIERS]).alias("total"), *[F.col(t).alias(t.lower()) for t in TIERS])


@query("SELECT p_brand AS category, p_partkey, p_retailprice, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC NULLS FIRST, p_size DESC NULLS FIRST, p_partkey) AS rank FROM part) WHERE rank <= 20")
def top_n_per_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc_nulls_first("p_retailprice"), F.desc_nulls_first("p_size"), F.asc("p_partkey")]
    return keyed.top_per_key(read(spark, sf_dir, "part"), ["p_brand"], order, 20).select(F.col("p_brand").alias("category"), "p_partkey", "p_retailprice", "rank")


FOCUS = {"sales": ["CRM", "BOOKING", "POS", "ECOMMERCE"], "people": ["HRM", "LMS"], "money": ["INVOICING", "EXPENSES"], "support": ["HELPDESK", "CRM"], "none": ["NOTHING"]}
SQL_FOCUS = "(VALUES " + ", ".join(f"({q(f)}, {q(c)})" for f, cs in FOCUS.items() for c in cs) + ") f(label, category)"


def focus_table(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(f, c) for f, cs in FOCUS.items() for c in cs], "label string, category string"))  # a fixed list


@query(view.SQL + f" SELECT f.label, count(repository_id) AS pool, count_if(coalesce(bundle >= 80, false)) AS shortlist FROM {SQL_FOCUS} LEFT JOIN repo ON repo.category = f.category GROUP BY f.label")
def focus_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_category = repos(spark, sf_dir).groupBy("category").agg(F.count("*").alias("pool"), F.count_if(F.col("bundle") >= 80).alias("shortlist"))
    return focus_table(spark).join(by_category, "category", "left").groupBy("label").agg(F.coalesce(F.sum("pool"), F.lit(0)).alias("pool"), F.coalesce(F.sum("shortlist"), F.lit(0)).alias("shortlist"))


SQL_GROUPS = "(VALUES " + ", ".join(f"({q(g)}, {low}, {high})" for g, (_, low, high) in rules.GROUPS.items()) + ") g(grp, minimum, maximum)"


@query(view.SQL + f""", s AS (SELECT *, {SQL_GROUP} AS grp FROM repo) SELECT g.grp, CAST(minimum AS INT) AS minimum, count(repository_id) AS available, count_if(coalesce(bundle >= 90, false)) AS selected FROM {SQL_GROUPS} LEFT JOIN s ON s.grp = g.grp GROUP BY g.grp, minimum HAVING count_if(coalesce(bundle >= 90, false)) < minimum""")
def target_shortfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = scored(spark, sf_dir).groupBy("grp").agg(F.count("*").alias("available"), F.count_if(F.col("bundle") >= 90).alias("selected"))
    wide = shortlist.group_targets(spark).join(counts, "grp", "left").fillna(0, ["available", "selected"])
    return wide.where("selected < minimum").select("grp", "minimum", "available", "selected")


@query("""WITH b AS (SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_shipdate < TIMESTAMP '1995-01-01' GROUP BY 1), a AS (SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_shipdate >= TIMESTAMP '1995-01-01' GROUP BY 1)
 SELECT d.p_brand AS category, coalesce(b.n, 0) AS before, coalesce(a.n, 0) AS after, coalesce(a.n, 0) - coalesce(b.n, 0) AS delta FROM (SELECT DISTINCT p_brand FROM part) d LEFT JOIN b USING (p_brand) LEFT JOIN a USING (p_brand)""")
def before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    early = F.col("l_shipdate") < F.lit("1995-01-01").cast("timestamp_ntz")
    lines = read(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count_if(early).alias("before"), F.count_if(~early).alias("after"))
    parts = read(spark, sf_dir, "part").select("p_brand", F.col("p_partkey").alias("l_partkey"))
    wide = parts.join(lines, "l_partkey", "left").groupBy(F.col("p_brand").alias("category")).agg(F.coalesce(F.sum("before"), F.lit(0)).alias("before"), F.coalesce(F.sum("after"), F.lit(0)).alias("after"))
    return wide.withColumn("delta", F.col("after") - F.col("before"))


@query("SELECT g.grp, count(repository_id) AS pool, count(repository_id) < least(5, minimum) AS short FROM " + SQL_GROUPS + f" LEFT JOIN (WITH repo AS (SELECT " + ", ".join(f"{view.COLUMNS[c]} AS {c}" for c in ("repository_id", "category", "bundle")) + f" FROM documents) SELECT *, {SQL_GROUP} AS grp FROM repo WHERE bundle >= 97) s ON s.grp = g.grp GROUP BY g.grp, minimum")
def target_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = scored(spark, sf_dir).where("bundle >= 97").groupBy("grp").agg(F.count("*").alias("pool"))
    wide = shortlist.group_targets(spark).join(counts, "grp", "left").fillna(0, ["pool"])
    return wide.select("grp", "pool", (F.col("pool") < F.least(F.lit(5), F.col("minimum"))).alias("short"))


@query("SELECT doc_id, source FROM documents ORDER BY md5(concat(CAST(doc_id AS VARCHAR), ':7')), doc_id LIMIT 100")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """100 documents drawn by a hash; the sample is the feature."""
    return shortlist.hash_sample(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", 7, 100)


# --- Keyed tables ----------------------------------------------------------------------------------

LATEST = "row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END DESC NULLS FIRST, ts DESC NULLS FIRST, event_id)"


@query(f"SELECT user_id, event_id, event_type, value FROM (SELECT *, {LATEST} AS r FROM events) WHERE r = 1")
def latest_analysis_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row of each user; rows that were never audited (no audit time) come first."""
    rows = read(spark, sf_dir, "events").withColumn("audited", F.when(F.col("event_id") % 3 != 0, F.col("ts")))
    return keyed.latest_per_key(rows, ["user_id"], [F.desc_nulls_first("audited"), F.desc_nulls_first("ts"), F.asc("event_id")]).select("user_id", "event_id", "event_type", "value")


SQL_UPSERT = """WITH o AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS first_seen, max(event_id) AS last_seen FROM events WHERE event_id % 2 = 0 GROUP BY ALL), w AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS first_seen, max(event_id) AS last_seen FROM events WHERE event_id % 2 = 1 GROUP BY ALL)"""


@query(SQL_UPSERT + " SELECT user_id, event_type, coalesce(o.n, 0) + coalesce(w.n, 0) AS n, least(o.first_seen, w.first_seen) AS first_seen, greatest(o.last_seen, w.last_seen) AS last_seen FROM o FULL JOIN w USING (user_id, event_type)")
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events")
    old, new = (events.where(F.col("event_id") % 2 == k).groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_seen"), F.max("event_id").alias("last_seen")) for k in (0, 1))
    return keyed.upsert(old, new, ["user_id", "event_type"], {"n": "add", "first_seen": "min", "last_seen": "max"})


@query("""WITH a AS (SELECT o_custkey AS k, max(o_totalprice) AS v FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1), b AS (SELECT o_custkey AS k, min(o_totalprice) AS v FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
 SELECT k, coalesce(b.v, a.v) AS v, CASE WHEN b.k IS NULL THEN 'existing' WHEN a.k IS NULL THEN 'new' ELSE 'replaced' END AS origin FROM a FULL JOIN b USING (k)""")
def later_wins_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "k")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    a = orders.where(~urgent).groupBy("k").agg(F.max("o_totalprice").alias("v")).withColumn("pool", F.lit("a"))
    b = orders.where(urgent).groupBy("k").agg(F.min("o_totalprice").alias("v")).withColumn("pool", F.lit("b"))
    merged = keyed.flagged(keyed.later_wins(a, b, keys=["k"]), a, "k", "in_a")
    return merged.select("k", "v", F.when(F.col("pool") == "a", "existing").when(F.col("in_a"), "replaced").otherwise("new").alias("origin"))


@query("""WITH p AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 200000) SELECT c_custkey, c_custkey IN (SELECT k FROM p) AS kept FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def stale_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with orders, split into those kept by the new key set and the stale ones."""
    orders = read(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    rows = keyed.pruned(read(spark, sf_dir, "customer").select("c_custkey"), orders, ["c_custkey"])
    good = orders.where("o_totalprice > 200000").select("c_custkey")
    return keyed.pruned(rows, good, ["c_custkey"]).withColumn("kept", F.lit(True)).union(keyed.stale(rows, good, ["c_custkey"]).withColumn("kept", F.lit(False)))


@query("""WITH n AS (SELECT c_custkey, c_nationkey AS nation, c_custkey % 40 AS bucket, CAST(c_custkey % 300 AS BIGINT) AS api FROM customer), s AS (SELECT s_suppkey, s_nationkey AS nation, s_suppkey % 40 AS bucket, s_suppkey AS api FROM supplier)
 SELECT c_custkey, coalesce((SELECT min(s_suppkey) FROM s WHERE s.nation = n.nation AND s.bucket = n.bucket), (SELECT min(s_suppkey) FROM s WHERE s.api = n.api)) AS s_suppkey FROM n""")
def or_key_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = read(spark, sf_dir, "customer").selectExpr("c_custkey", "c_nationkey AS nation", "c_custkey % 40 AS bucket", "c_custkey % 300 AS api")
    known = read(spark, sf_dir, "supplier").selectExpr("s_suppkey", "s_nationkey AS nation", "s_suppkey % 40 AS bucket", "s_suppkey AS api")
    return keyed.match_by_either_key(new, known, ["nation", "bucket"], ["api"], "s_suppkey").select("c_custkey", "s_suppkey")


@query("""SELECT p_brand AS category, count(*) AS raw_hits, count(DISTINCT l_partkey) AS unique_hits, count(DISTINCT CASE WHEN l_discount <= 0.02 THEN l_partkey END) AS preliminary, min(l_shipdate) AS first_seen, max(l_shipdate) AS last_seen FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def search_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = read(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("hits"), F.bool_or(F.col("l_discount") <= 0.02).alias("good"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
    rows = each.join(read(spark, sf_dir, "part").select("p_brand", F.col("p_partkey").alias("l_partkey")), "l_partkey")
    return rows.groupBy(F.col("p_brand").alias("category")).agg(F.sum("hits").alias("raw_hits"), F.count("*").alias("unique_hits"), F.count_if("good").alias("preliminary"), F.min("first").alias("first_seen"), F.max("last").alias("last_seen"))


@query("""SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'NEW' WHEN doc_id % 3 = 0 AND coalesce(text, '') <> '' THEN 'CHANGED' ELSE 'SAME' END AS state FROM documents""")
def change_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against stored fingerprints: one in ten isn't stored, one in three is stored with other text."""
    rows = read(spark, sf_dir, "documents")
    old = rows.where("doc_id % 10 <> 0").select("doc_id", keyed.fingerprint(F.lit("v1").alias("v"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.coalesce("text", F.lit("")), F.when(F.coalesce("text", F.lit("")) != "", "x").otherwise(""))).otherwise(F.coalesce("text", F.lit(""))).alias("text")).alias("fingerprint"))
    new = rows.select("doc_id", keyed.fingerprint(F.lit("v1").alias("v"), F.coalesce("text", F.lit("")).alias("text")).alias("fingerprint"))
    return keyed.changed(old, new, ["doc_id"]).select("doc_id", "state")


# --- Requests, responses, corrections --------------------------------------------------------------


@query("""WITH q AS (SELECT conv_id, turn, text, row_number() OVER (ORDER BY conv_id, turn) AS n FROM conversations WHERE role = 'user'), r AS (SELECT conv_id, turn, text FROM conversations WHERE role <> 'user')
 SELECT q.conv_id, q.turn, length(q.text) > 200 AS truncated, length(substring(q.text, 1, 200)) AS sent, CASE WHEN r.text IS NULL THEN 'FAILED' ELSE 'COMPLETED' END AS status FROM q LEFT JOIN r ON r.conv_id = q.conv_id AND r.turn = q.turn + 1""")
def request_response_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each request with its text cut to a length, matched with the answer of the next turn; without one it failed."""
    rows = read(spark, sf_dir, "conversations")
    requests = rows.where("role = 'user'").select("conv_id", "turn", (F.length("text") > 200).alias("truncated"), F.length(F.substring("text", 1, 200)).alias("sent"))
    answers = rows.where("role <> 'user'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").isNotNull().alias("answered"))
    return requests.join(answers, ["conv_id", "turn"], "left").select("conv_id", "turn", "truncated", "sent", F.when(F.coalesce("answered", F.lit(False)), "COMPLETED").otherwise("FAILED").alias("status"))


RESPONSE = {"score": "CAST((doc_id * 7) % 130 - 10 AS INT)", "kind": choose(4, ["APPLICATION", "LIBRARY", "NONSENSE", None]), "name": "CASE WHEN doc_id % 6 = 0 THEN '' ELSE substring(text, 1, 1 + doc_id % 260) END", "reasons": "CAST(doc_id % 11 AS INT)"}


@query("WITH r AS (SELECT doc_id, " + ", ".join(f"{e} AS {c}" for c, e in RESPONSE.items()) + """ FROM documents), v AS (SELECT doc_id, score, concat_ws(',', CASE WHEN score BETWEEN 0 AND 100 THEN NULL ELSE 'score' END, CASE WHEN kind IN ('APPLICATION', 'LIBRARY') THEN NULL ELSE 'kind' END,
 CASE WHEN length(name) BETWEEN 1 AND 200 THEN NULL ELSE 'name' END, CASE WHEN reasons BETWEEN 2 AND 8 THEN NULL ELSE 'reasons' END) AS violations FROM r)
 SELECT doc_id, violations, CASE WHEN violations <> '' THEN NULL WHEN score >= 80 THEN 'STRONG' WHEN score >= 65 THEN 'POSSIBLE' WHEN score >= 50 THEN 'WEAK' ELSE 'REJECT' END AS tier FROM v""")
def response_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed JSON answers read under a schema; each row names the rules it breaks, and valid ones get a tier."""
    landed = read(spark, sf_dir, "documents").selectExpr("doc_id", *[f"{e} AS {c}" for c, e in RESPONSE.items()])
    landed = landed.select("doc_id", F.to_json(F.struct("score", "kind", "name", F.transform(F.sequence(F.lit(0), F.col("reasons")), lambda i: F.concat(F.lit("r"), i.cast("string"))).alias("reasons"))).alias("response"))
    parsed = landed.select("doc_id", F.from_json("response", "score int, kind string, name string, reasons array<string>").alias("r"))
    broken = [("score", F.col("r.score").between(0, 100)), ("kind", F.col("r.kind").isin("APPLICATION", "LIBRARY")), ("name", F.length("r.name").between(1, 200)), ("reasons", (F.size("r.reasons") - 1).between(2, 8))]
    violations = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in broken]))
    rows = parsed.withColumn("violations", F.array_join(violations, ","))
    return rows.select("doc_id", "violations", F.when(F.col("violations") == "", rules.tier(F.col("r.score"))).alias("tier"))


@query(view.SQL + f""", c AS (SELECT repository_id, CAST(repository_id % 101 AS INT) AS new_score FROM repo WHERE repository_id % 50 = 0 AND quality IS NOT NULL), a AS (SELECT r.repository_id, coalesce(c.new_score, r.bundle) AS bundle, c.new_score - r.bundle AS delta, CASE WHEN c.new_score IS NOT NULL THEN 'CORRECTED' WHEN r.bundle >= 80 THEN 'PASS' ELSE NULL END AS audit, concat_ws('; ', 'kept', r.category, CASE WHEN c.new_score IS NOT NULL THEN concat('Quality audit correction: worth ', CAST(c.new_score AS VARCHAR)) END) AS reasons, CASE WHEN c.new_score IS NOT NULL THEN concat('worth ', CAST(c.new_score AS VARCHAR)) WHEN r.bundle >= 80 THEN 'README reviewed' END AS note FROM repo r LEFT JOIN c USING (repository_id) WHERE r.quality IS NOT NULL)
 SELECT repository_id, bundle, delta, delta IS NOT NULL AND delta <> 0 AS changed, audit, reasons, note, CASE WHEN audit IS NOT NULL THEN '2026-08-24' END AS audited_on, {SQL_TIER} AS tier FROM a""")
def correction_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores set right by a table of corrections, with the reason appended; those audited without one pass, with a note and the time."""
    rows = repos(spark, sf_dir).where("quality is not null").select("repository_id", F.col("bundle").alias("old"), F.array(F.lit("kept"), F.col("category")).alias("reasons"))
    fixes = rows.where("repository_id % 50 = 0").select("repository_id", (F.col("repository_id") % 101).cast("int").alias("new"))
    fixes = fixes.withColumn("said", F.concat(F.lit("worth "), F.col("new").cast("string")))
    audited = rows.where("old >= 80").select("repository_id")
    merged = keyed.flagged(rows, audited, "repository_id", "audited").join(fixes, "repository_id", "left")
    merged = merged.withColumn("bundle", F.coalesce("new", "old")).withColumn("delta", F.col("new") - F.col("old"))
    audit = F.when(F.col("new").isNotNull(), "CORRECTED").when(F.col("audited"), "PASS")
    return merged.select(
        "repository_id", "bundle", "delta", F.coalesce(F.col("delta") != 0, F.lit(False)).alias("changed"), audit.alias("audit"), F.array_join(F.array_compact(F.concat("reasons", F.array(F.concat(F.lit("Quality audit correction: "), F.col("said"))))), "; ").alias("reasons"),
        F.coalesce("said", F.when(F.col("audited"), "README reviewed")).alias("note"), F.when(audit.isNotNull(), NOW).alias("audited_on"), rules.tier(F.col("bundle")).alias("tier"),
    )


@query(view.SQL + f""", u AS (SELECT repository_id AS id, 0 AS section FROM repo WHERE bundle >= 95 UNION ALL (SELECT repository_id, 1 FROM repo WHERE bundle BETWEEN 65 AND 79 ORDER BY bundle DESC, repository_id LIMIT 20) UNION ALL (SELECT repository_id, 2 FROM repo WHERE is_complete AND bundle >= 65 ORDER BY bundle DESC, repository_id LIMIT 20))
 SELECT id, min(section) AS section FROM u GROUP BY id""")
def audit_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repos(spark, sf_dir).select(F.col("repository_id").alias("id"), "bundle", "is_complete")
    order = [F.desc("bundle"), F.asc("id")]
    parts = [rows.where("bundle >= 95"), rows.where("bundle between 65 and 79").orderBy(*order).limit(20), rows.where("is_complete and bundle >= 65").orderBy(*order).limit(20)]
    return keyed.ordered_union(parts, "id", "bundle").select("id", "section")


@query(view.SQL + f""" SELECT repository_id, CASE WHEN status = 'ENRICHED' THEN 'ENRICHED' WHEN status = 'UNAVAILABLE' THEN 'UNAVAILABLE' WHEN status = 'PENDING' THEN 'RATE_LIMITED' ELSE 'FAILED' END AS outcome, CASE WHEN status = 'FAILED' THEN length(substring(coalesce(text, ''), 1, 2000)) ELSE NULL END AS message_length FROM repo""")
def fetch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses read from a landed fetch log: an answer, not found, out of quota, or another failure with its message."""
    http = F.when(F.col("status") == "ENRICHED", 200).when(F.col("status") == "UNAVAILABLE", 404).when(F.col("status") == "PENDING", 403).otherwise(500)
    log = repos(spark, sf_dir).select("repository_id", http.alias("http_status"), F.when(F.col("status") == "PENDING", 0).otherwise(10).alias("remaining"), F.coalesce("text", F.lit("")).alias("error"))
    rows = once(log, {"found": outcomes.metadata_outcome(F.col("http_status"), F.col("remaining"), F.col("error"))})
    return rows.select("repository_id", F.col("found.state").alias("outcome"), F.when(F.col("found.state") == "FAILED", F.length("found.error_message")).alias("message_length"))


# --- Landed JSON -----------------------------------------------------------------------------------


@query(view.SQL + f""" SELECT repository_id AS github_id, owner AS owner_login, name, description, CASE WHEN homepage = '' THEN NULL ELSE homepage END AS homepage, stars, len(string_split(topics, ' ')) AS n_topics, spdx AS license_spdx, archived, days AS days_since_last_push, CAST(repository_id % 900 AS INT) AS repository_age_days FROM repo""")
def metadata_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repository records as JSON, read under the schema and flattened, with ages at a fixed date."""
    rows = view.topics_array(repos(spark, sf_dir))
    now = F.lit(NOW).cast("timestamp")

    def ago(days: Column) -> Column:
        return F.date_format(now - F.make_dt_interval(days), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    record = F.struct(
        F.col("repository_id").alias("id"), F.struct(F.col("owner").alias("login")).alias("owner"), "name", "description", "homepage", F.col("stars").alias("stargazers_count"),
        F.when(F.col("topics").isNotNull(), F.col("topic_list")).alias("topics"), "archived", ago((F.col("repository_id") % 900).cast("int")).alias("created_at"), ago(F.lit(0)).alias("updated_at"), ago(F.col("days")).alias("pushed_at"), F.struct(F.col("spdx").alias("spdx_id")).alias("license"),
    )
    parsed = rows.select(F.from_json(F.to_json(record), scans.REPOSITORY_SCHEMA).alias("r")).select("r.*")
    mapped = scans.mapped_metadata(parsed, now)
    return mapped.select("github_id", "owner_login", "name", "description", "homepage", "stars", F.when(F.size("topics") > 0, F.size("topics")).cast("long").alias("n_topics"), "license_spdx", "archived", "days_since_last_push", "repository_age_days")


@query("SELECT doc_id AS repository_id, replace(coalesce(text, ''), chr(13) || chr(10), chr(10)) AS readme_text, concat('sha', CAST(doc_id AS VARCHAR)) AS readme_sha FROM documents")
def readme_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.regexp_replace(F.base64(F.encode(F.coalesce("text", F.lit("")), "UTF-8")), "(.{60})", "$1\n")
    landed = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("repository_id"), F.to_json(F.struct(content.alias("content"), F.lit("base64").alias("encoding"), F.concat(F.lit("sha"), F.col("doc_id").cast("string")).alias("sha"))).alias("response"))
    return scans.readme_texts(landed)


SQL_TERMS = "(VALUES " + ", ".join(f"({i}, {q(c)}, {q(t)})" for i, (c, ts) in enumerate(scans.SEARCH_TERMS.items()) for t in ts) + ") s(ordinal, category, term)"


@query(f"""WITH h AS (SELECT DISTINCT d.doc_id, s.category, s.term FROM documents d JOIN {SQL_TERMS} ON d.doc_id % 27 = s.ordinal AND (d.doc_id % 2 = 0 OR length(s.term) > 15))
 SELECT d.doc_id AS repository_id, count(h.term) AS n_queries, count(h.term) > 0 AS from_search, max(h.category) AS category, array_to_string(list_sort(list(h.term) FILTER (h.term IS NOT NULL)), ',') AS terms, min(concat('"', h.term, '" in:name,description,readme archived:false fork:false stars:>=5 pushed:>=2025-08-24')) FILTER (h.term IS NOT NULL) AS first_query FROM documents d LEFT JOIN h USING (doc_id) GROUP BY d.doc_id""")
def search_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All search hits of a repository as arrays; the catalogue is a fixed list, hits are derived from the ids."""
    catalogue = F.broadcast(scans.search_catalogue(spark, NOW).select("ordinal", "category", "term", "query_text"))
    documents = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("repository_id"), (F.col("doc_id") % 27).cast("int").alias("ordinal"))
    hits = documents.join(catalogue, "ordinal").where("repository_id % 2 = 0 or length(term) > 15")
    each = hits.groupBy("repository_id").agg(F.collect_set("term").alias("terms"), F.collect_set("category").alias("categories"), F.min("query_text").alias("first_query"))
    wide = documents.select("repository_id").join(each, "repository_id", "left")
    n = F.when(F.col("terms").isNull(), 0).otherwise(F.size("terms")).cast("long")
    return wide.select("repository_id", n.alias("n_queries"), (n > 0).alias("from_search"), F.array_max("categories").alias("category"), F.array_join(F.array_sort("terms"), ",").alias("terms"), "first_query")


@query(view.SQL + f""" SELECT repository_id, {SQL_NORMAL} AS category, coalesce(usefulness, bundle, 0) AS usefulness, coalesce(deployment, 50) AS deployment, coalesce(client_use, 40) AS client_use, CAST(floor((coalesce(clarity, bundle, 0) + coalesce(usefulness, bundle, 0)) / 2.0 + 0.5) AS INT) AS clarity,
 coalesce(description, name) AS description, {sql_has("readme", r"!\[[^\]]*\]\([^)]*\)|screenshot")} OR coalesce(homepage, '') <> '' AS has_demo, CASE WHEN deployment IS NULL THEN 'UNKNOWN' WHEN deployment >= 75 THEN 'LOW' WHEN deployment >= 50 THEN 'MEDIUM' ELSE 'HIGH' END AS setup, coalesce(is_complete, false) AS complete, CASE WHEN repository_id % 4 = 3 THEN 'r0; r1; r2' ELSE 'Reused current structured AI analysis.; Commercial score preserved from the existing analysis.' END AS reasons,
 CASE repository_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'e0' WHEN 2 THEN 'e0; e1' ELSE 'e0; e1; e2' END AS examples, repository_id % 3 <> 0 OR coalesce(visual, 0) > 50 AS complex, coalesce(description, name) AS proposition FROM repo WHERE bundle >= 50""")
def reuse_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier analyses in the terms of the later model: missing scores fall back on the bundle score or on defaults."""
    rows = repos(spark, sf_dir).where("bundle >= 50")
    # What an earlier response held: reasons (a number of them strings), examples, and a flag that may be missing.
    held = F.transform(F.sequence(F.lit(0), (F.col("repository_id") % 4).cast("int")), lambda i: F.when(i == F.lit(3), F.lit("5")).otherwise(F.concat(F.lit('"r'), i.cast("string"), F.lit('"'))))
    rows = rows.withColumn("reasons", F.when(F.col("repository_id") % 4 == 0, "5").otherwise(F.concat(F.lit("["), F.array_join(F.when(F.col("repository_id") % 4 == 3, held).otherwise(F.array(F.lit('"r0"'))), ","), F.lit("]"))))
    rows = rows.withColumn("examples", F.concat(F.lit("["), F.array_join(F.filter(F.transform(F.sequence(F.lit(0), (F.col("repository_id") % 5).cast("int")), lambda i: F.when(i > 0, F.concat(F.lit('"e'), (i - 1).cast("string"), F.lit('"')))), lambda x: x.isNotNull()), ","), F.lit("]")))
    rows = rows.withColumn("infrastructure", F.when(F.col("repository_id") % 3 == 0, F.coalesce("visual", F.lit(0)) > 50))
    useful, complete = F.coalesce("usefulness", "bundle", F.lit(0)), F.coalesce("clarity", "bundle", F.lit(0))
    return rows.select(
        "repository_id", rules.normalized_category(F.col("category")).alias("category"), useful.alias("usefulness"), F.coalesce("deployment", F.lit(50)).alias("deployment"), F.coalesce("client_use", F.lit(40)).alias("client_use"),
        rules.half_up((complete + useful) / 2).alias("clarity"), F.coalesce("description", "name").alias("description"), rules.has_demo(F.col("homepage"), F.col("readme")).alias("has_demo"), rules.complexity(F.col("deployment")).alias("setup"),
        F.coalesce("is_complete", F.lit(False)).alias("complete"), F.array_join(rules.reasons_or_default(F.col("reasons")), "; ").alias("reasons"), F.array_join(F.slice(rules.only_strings(F.col("examples")), 1, 3), "; ").alias("examples"), F.coalesce("infrastructure", F.lit(True)).alias("complex"), F.coalesce("description", "name").alias("proposition"),
    )
