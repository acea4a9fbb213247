"""Responses against their schemas, requests, second passes, and joins of pools, analyses and inspections."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import outcomes, responses, rules
from ..operators import keyed, shortlist, similarity
from ..sources import scans
from . import view
from .queries import DISCOVERED, EVIDENCE, NOW, PRODUCTS, SQL_TIER, discovered, once, products, q, query, read, sql_has, sql_in, sql_matches, sql_points
from .static_queries import FILES, SQL_FACTS, tree_facts
from .view import choose, repos

# --- Responses -------------------------------------------------------------------------------------


def sql_value(i: int, field: tuple) -> str:
    """JSON of a value that keeps the rule of a field, from a document's own columns."""
    kind, *rule = field
    if kind == "or_null":
        return f"CASE WHEN doc_id % 3 = 0 THEN 'null' ELSE {sql_value(i, rule[0])} END"
    if kind == "flag":
        return f"CASE WHEN (doc_id + {i}) % 2 = 0 THEN 'true' ELSE 'false' END"
    if kind == "number":
        return f"CAST((coalesce(n_chars, 0) * {i + 3}) % 101 AS STRING)"
    if kind == "text":
        return "concat('\"', coalesce(source, 'none'), ' ', CAST(coalesce(n_chars, 0) AS STRING), '\"')"
    if kind == "name":
        return f"concat('\"', {choose(len(rule[0]), rule[0])}, '\"')"
    if kind == "names":
        return f"concat('[\"', {choose(len(rule[0]), rule[0])}, '\"', repeat(',\"{rule[0][0]}\"', CAST(doc_id % {rule[1]} AS INT)), ']')"
    least, most = rule[1], rule[2]
    return f"concat('[\"one\"', repeat(',\"two\"', CAST({max(0, least - 1)} + doc_id % {most - max(0, least - 1)} AS INT)), ']')"


def sql_broken(field: tuple) -> str:
    """JSON of a value that breaks it, in one of three ways; the fifth and the first way are no value and null."""
    kind, *rule = field
    if kind == "or_null":
        return sql_broken(rule[0])
    ways = {
        "flag": ["'\"true\"'", "'1'", "'[]'"], "number": ["'\"5\"'", f"'{rule[1] + 1 if kind == 'number' else 0}'", "'1.5'"], "text": ["'5'", f"concat('\"', repeat('a', {rule[0] + 1 if kind == 'text' else 1}), '\"')", "'\"\"'"],
        "name": ["'5'", "'\"NOT_KNOWN\"'", "'\"\"'"], "names": ["'\"CRM\"'", "'[\"NOT_KNOWN\"]'", f"concat('[\"CRM\"', repeat(',\"CRM\"', {rule[1] if kind == 'names' else 1}), ']')"],
        "texts": ["'\"one\"'", f"concat('[\"one\"', repeat(',\"two\"', {rule[2] if kind == 'texts' else 1}), ']')", "'[\"one\",\"\"]'"],
    }[kind]
    return f"CASE (doc_id // 64) % 3 WHEN 0 THEN {ways[0]} WHEN 1 THEN {ways[1]} ELSE {ways[2]} END"


def sql_response(schema: dict[str, tuple]) -> str:
    """A landed response of each document; in most of them one field is broken, in some the text is."""
    parts = []
    for i, (name, field) in enumerate(schema.items()):
        broken = f"CASE (doc_id // 8) % 5 WHEN 0 THEN ',\"{name}\":null' WHEN 1 THEN '' ELSE concat(',\"{name}\":', {sql_broken(field)}) END"
        parts.append(f"CASE WHEN doc_id % {len(schema) + 5} = {i} THEN {broken} ELSE concat(',\"{name}\":', {sql_value(i, field)}) END")
    return f"concat(CASE WHEN doc_id % 97 = 0 THEN '[' ELSE '{{' END, '\"further\":0', {', '.join(parts)}, CASE WHEN doc_id % 89 = 0 THEN '' ELSE '}}' END)"


def spark_sql(text: str) -> str:
    """The division of whole numbers, which Spark writes otherwise."""
    return text.replace("doc_id // 8", "doc_id div 8").replace("doc_id // 64", "doc_id div 64")


def sql_good(name: str, field: tuple) -> str:
    kind, *rule = field
    path, type_ = f"'$.{name}'", f"json_type(j, '$.{name}')"
    if kind == "or_null":
        return f"({type_} = 'NULL' OR {sql_good(name, rule[0])})"
    if kind == "flag":
        return f"{type_} = 'BOOLEAN'"
    if kind == "number":
        n = f"TRY_CAST(json_extract_string(j, {path}) AS DOUBLE)"
        return f"({type_} IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND {n} = floor({n}) AND {n} BETWEEN {rule[0]} AND {rule[1]})"
    held = f"json_extract_string(j, {path})"
    if kind == "text":
        return f"({type_} = 'VARCHAR' AND length({held}) BETWEEN 1 AND {rule[0]})"
    if kind == "name":
        return f"({type_} = 'VARCHAR' AND {held} IN {sql_in(rule[0])})"
    least, most = (0, rule[1]) if kind == "names" else (rule[1], rule[2])
    one = f"x->>'$' IN {sql_in(rule[0])}" if kind == "names" else f"length(x->>'$') BETWEEN 1 AND {rule[0]}"
    return f"({type_} = 'ARRAY' AND json_array_length(j, {path}) BETWEEN {least} AND {most} AND len(list_filter(json_extract(j, '$.{name}[*]'), lambda x: json_type(x) = 'VARCHAR' AND {one})) = json_array_length(j, {path}))"


def sql_schema(name: str, schema: dict[str, tuple]) -> str:
    broken = ", ".join(f"CASE WHEN coalesce({sql_good(f, field)}, false) THEN NULL ELSE '{f}' END" for f, field in schema.items())
    return f"""(WITH r AS (SELECT doc_id, {sql_response(schema)} AS response FROM documents), p AS (SELECT doc_id, CASE WHEN json_valid(response) THEN CAST(response AS JSON) ELSE NULL END AS j FROM r),
 v AS (SELECT doc_id, concat_ws(',', {broken}) AS violations, TRY_CAST(json_extract_string(j, '$.commercialBundleScore') AS INT) AS score FROM p)
 SELECT doc_id, '{name}' AS schema, violations, CASE WHEN violations <> '' THEN NULL WHEN score >= 80 THEN 'STRONG' WHEN score >= 65 THEN 'POSSIBLE' WHEN score >= 50 THEN 'WEAK' ELSE 'REJECT' END AS tier FROM v)"""


@query(" UNION ALL ".join(f"SELECT * FROM {sql_schema(n, s)}" for n, s in responses.SCHEMAS.items()))
def response_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses of three kinds: the fields that break their rules, and the tier of those that keep all."""
    found = None
    for name, schema in responses.SCHEMAS.items():
        landed = read(spark, sf_dir, "documents").selectExpr("doc_id", f"{spark_sql(sql_response(schema))} AS response")
        parsed = once(landed, {"parsed": F.try_parse_json("response")})
        checked = once(parsed, {"broken": responses.violations(F.col("parsed"), schema)})
        tier = rules.tier(responses.member(F.col("parsed"), "commercialBundleScore", "int"))
        rows = checked.select("doc_id", F.lit(name).alias("schema"), F.array_join("broken", ",").alias("violations"), F.when(F.size("broken") == 0, tier).alias("tier"))
        found = rows if found is None else found.union(rows)
    return found


SQL_BATCH = "WITH a AS (SELECT doc_id, concat(source, '/', 'Repo', CAST(doc_id AS VARCHAR)) AS full_name, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 10) AS BIGINT) AS batch FROM documents)"


@query(SQL_BATCH + " SELECT batch, count(*) AS sent, count_if(doc_id % 7 <> 0) AS completed, count_if(doc_id % 7 = 0) AS failed, min(CASE WHEN doc_id % 7 = 0 THEN concat('Batch response missing ', full_name) END) AS first_error FROM a GROUP BY batch")
def batch_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests in batches of ten, matched with the answers by their lower-cased name; one without an answer has failed."""
    documents = read(spark, sf_dir, "documents").select("doc_id", F.concat("source", F.lit("/Repo"), F.col("doc_id").cast("string")).alias("full_name"))
    sent = keyed.numbered(documents, "doc_id").withColumn("batch", F.floor(F.col("number") / 10))
    answers = documents.where("doc_id % 7 <> 0").select(F.lower("full_name").alias("name"), F.lit(True).alias("answered"))
    rows = sent.withColumn("name", F.lower("full_name")).join(answers, "name", "left")
    missing = F.col("answered").isNull()
    return rows.groupBy("batch").agg(F.count("*").alias("sent"), F.count_if(~missing).alias("completed"), F.count_if(missing).alias("failed"), F.min(F.when(missing, F.concat(F.lit("Batch response missing "), "full_name"))).alias("first_error"))


# --- Requests --------------------------------------------------------------------------------------

README_MOST = 600
SQL_PREVIOUS = "CASE WHEN repository_id % 3 = 1 THEN NULL ELSE"


def analysed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repositories with the earlier analysis of two thirds of them as a struct, or null."""
    rows = products(spark, sf_dir)
    earlier = rows.where("repository_id % 3 <> 1").select(
        "repository_id", F.struct(F.lit("product-selection-v1").alias("version"), "category", F.col("bundle").alias("score"), rules.tier(F.col("bundle")).alias("tier"), "description", F.array(F.lit("first"), F.col("category")).alias("reasons")).alias("earlier")
    )
    return rows.join(earlier, "repository_id", "left")


@query(PRODUCTS + ", " + ", ".join(f"""r{v} AS (SELECT '{v}' AS variant, repository_id, concat(owner, '/', name) AS full_name, least(length(coalesce(readme, '')), {README_MOST}) + CASE WHEN length(coalesce(readme, '')) > {README_MOST} THEN {len(responses.CUT[v])} ELSE 0 END AS readme_length,
 length(coalesce(readme, '')) > {README_MOST} AS truncated, spdx AS license, kind, CAST(product AS INT) AS product, CAST(len(string_split(topics, ' ')) AS INT) AS n_topics, {"CAST(bundle AS INT)" if v == "gap" else "NULL"} AS previous_score,
 {f"{SQL_PREVIOUS} {SQL_TIER} END" if v == "selection" else "NULL"} AS existing_tier FROM products)""" for v in responses.SCHEMAS) + " SELECT * FROM rproduct UNION ALL SELECT * FROM rgap UNION ALL SELECT * FROM rselection")
def analysis_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of three kinds as JSON, read back: names, the cut README, and what earlier stages have found."""
    rows = similarity.staged(analysed(spark, sf_dir).select("repository_id", "owner", "name", "description", "topics", "topic_list", "homepage", "stars", "days", "spdx", "readme", "kind", "product", "template", "bundle", "category", "earlier"))
    own = [rules.display_name(F.concat_ws("/", "owner", "name"), F.lit("")).alias("fullName"), F.col("description"), F.when(F.col("topics").isNotNull(), F.col("topic_list")).otherwise(F.array().cast("array<string>")).alias("topics"), F.col("homepage"), F.col("stars"), F.col("spdx").alias("license")]
    scores = [F.col("product").alias("productLikenessScore"), F.col("template").alias("templatePotentialScore")]
    more = [F.array("category").alias("targetBusinessCategories"), F.array(F.concat(F.lit('"'), F.lower("category"), F.lit('"'))).alias("searchQueries"), F.col("earlier").alias("existingAiAnalysis")]
    context = F.struct(rules.tier(F.col("bundle")).alias("previousStageStatus"), F.col("bundle").alias("previousScore"), F.lit(None).cast("string").alias("reevaluationReason"), F.lit(None).cast("string").alias("discoveryReason"))
    fields = {"product": [*own, F.col("kind").alias("deterministicKind"), *scores], "gap": [*own, F.col("kind").alias("deterministicKind"), *scores], "selection": [*own, F.col("kind").alias("repositoryKind"), *scores, *more]}
    found = None
    for variant, held in fields.items():
        asked = rows.select("repository_id", responses.request(held, F.col("readme"), README_MOST, variant, context if variant == "gap" else None).alias("request"))
        back = once(asked, {"r": F.parse_json("request")})
        at = lambda name, kind="string": responses.member(F.col("r"), name, kind)
        part = back.select(
            F.lit(variant).alias("variant"), "repository_id", at("repository.fullName").alias("full_name"), F.length(at("repository.readme")).alias("readme_length"), at("repository.readmeTruncated", "boolean").alias("truncated"), at("repository.license").alias("license"),
            F.coalesce(at("repository.deterministicKind"), at("repository.repositoryKind")).alias("kind"), at("repository.productLikenessScore", "int").alias("product"), F.nullif(F.size(at("repository.topics", "array<string>")), F.lit(0)).alias("n_topics"),
            at("secondPassContext.previousScore", "int").alias("previous_score"), at("repository.existingAiAnalysis.tier").alias("existing_tier"),
        )
        found = part if found is None else found.union(part)
    return found


# --- Second pass -----------------------------------------------------------------------------------

SQL_RANK = [("is_complete", 70, "'previous AI marked is_complete_application=true'"), ("kind = 'APPLICATION'", 35, "'deterministic kind APPLICATION'"), ("product >= 70", 25, "concat('high deterministic product likeness ', CAST(product AS VARCHAR))"), ("template >= 70", 20, "concat('high deterministic template potential ', CAST(template AS VARCHAR))"), ("coalesce(homepage, '') <> ''", 10, "'homepage/demo present'"), (sql_has("readme", EVIDENCE), 15, "'README has standalone/UI/deployment evidence'")]


def missed_reasons() -> tuple[Column, Column]:
    """Points and reasons of a low-scored repository for a second look."""
    number = lambda c: F.col(c).cast("string")
    evidence = [
        (F.col("is_complete"), 70, F.lit("previous AI marked is_complete_application=true")), (F.col("kind") == "APPLICATION", 35, F.lit("deterministic kind APPLICATION")), (F.col("product") >= 70, 25, F.concat(F.lit("high deterministic product likeness "), number("product"))),
        (F.col("template") >= 70, 20, F.concat(F.lit("high deterministic template potential "), number("template"))), (F.coalesce("homepage", F.lit("")) != "", 10, F.lit("homepage/demo present")), (F.col("evidence"), 15, F.lit("README has standalone/UI/deployment evidence")),
    ]
    found = F.array_compact(F.array(*[F.when(c, reason) for c, _, reason in evidence]))
    return rules.total([rules.points(c, n) for c, n, _ in evidence]), F.when(F.size(found) == 0, F.array(F.lit("suspicious low-scoring product candidate"))).otherwise(found)


@query(PRODUCTS + f""", m AS (SELECT repository_id, CAST({" + ".join(sql_points(c, n) for c, n, _ in SQL_RANK)} AS INT) AS rank, concat_ws('; ', {", ".join(f"CASE WHEN {c} THEN {r} END" for c, _, r in SQL_RANK)}) AS reasons FROM products WHERE bundle < 65)
 SELECT repository_id, rank, CASE WHEN reasons = '' THEN 'suspicious low-scoring product candidate' ELSE reasons END AS reasons FROM m""")
def missed_reasons_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every low-scored repository with the points and reasons for a second look."""
    rows = once(products(spark, sf_dir).where(rules.tier(F.col("bundle")).isin("WEAK", "REJECT")), {"evidence": rules.has(F.col("low_readme"), EVIDENCE, True)})
    rank, reasons = missed_reasons()
    return rows.select("repository_id", rank.alias("rank"), F.array_join(reasons, "; ").alias("reasons"))


SQL_REASONS = f"""concat_ws('; ', concat('matched ', ranked[1].category, ' business terminology (', CAST(-ranked[1].minus AS VARCHAR), ')'), CASE kind WHEN 'UNKNOWN' THEN 'deterministic kind UNKNOWN; included for under-classification audit' WHEN 'APPLICATION' THEN 'deterministic classifier marked APPLICATION' END,
 concat(CAST({sql_matches(rules.STANDALONE, "combined")} AS VARCHAR), ' standalone/deployment/UI signals', CASE WHEN coalesce(homepage, '') <> '' THEN '; homepage present' ELSE '' END))"""


def discovery_reasons() -> Column:
    """Why a repository was discovered: its first category, its kind, and signs that it stands alone."""
    signs = F.concat(rules.matches(rules.STANDALONE, F.col("d_combined")).cast("string"), F.lit(" standalone/deployment/UI signals"), F.when(F.coalesce("homepage", F.lit("")) != "", "; homepage present").otherwise(""))
    first = F.concat(F.lit("matched "), F.col("top.category"), F.lit(" business terminology ("), (-F.col("top.minus")).cast("string"), F.lit(")"))
    kind = F.when(F.col("kind") == "UNKNOWN", "deterministic kind UNKNOWN; included for under-classification audit").when(F.col("kind") == "APPLICATION", "deterministic classifier marked APPLICATION")
    return F.array_compact(F.array(first, kind, signs))


STORED = "CASE WHEN repository_id % 10 = 0 THEN NULL WHEN repository_id % 4 = 0 THEN 'old' ELSE 'same' END"


@query(DISCOVERED + f""", g AS (SELECT repository_id, {SQL_REASONS} AS discovery_reason FROM discovered WHERE NOT (bundle >= 65)), missed AS (SELECT repository_id, CAST({" + ".join(sql_points(c, n) for c, n, _ in SQL_RANK)} AS INT) AS rank, concat_ws('; ', {", ".join(f"CASE WHEN {c} THEN {r} END" for c, _, r in SQL_RANK)}) AS reevaluation_reason FROM products WHERE bundle < 50 AND is_complete)
 SELECT repository_id, CASE WHEN missed.rank IS NOT NULL THEN 'FALSE_NEGATIVE' ELSE 'GAP_FILL' END AS pool_source, CASE WHEN repository_id % 3 = 1 THEN NULL ELSE {SQL_TIER} END AS previous_tier, CASE WHEN repository_id % 3 = 1 THEN NULL ELSE bundle END AS previous_score, g.discovery_reason, missed.reevaluation_reason,
 CASE WHEN {STORED} IS NULL THEN 'NEW' WHEN {STORED} = 'old' THEN 'PENDING' ELSE 'COMPLETED' END AS state, CASE WHEN {STORED} = 'same' THEN 'earlier' ELSE NULL END AS error FROM g FULL JOIN missed USING (repository_id) JOIN products p USING (repository_id)""")
def second_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pool of a second pass: gap fills and false negatives with their reasons, the earlier tier and score, and what a changed fingerprint resets."""
    gap = discovered(spark, sf_dir).where(~rules.tier(F.col("bundle")).isin("STRONG", "POSSIBLE")).select("repository_id", F.array_join(discovery_reasons(), "; ").alias("discovery_reason"))
    rows = once(products(spark, sf_dir).where("bundle < 50 and is_complete"), {"evidence": rules.has(F.col("low_readme"), EVIDENCE, True)})
    missed = rows.select("repository_id", F.array_join(missed_reasons()[1], "; ").alias("reevaluation_reason"))
    previous = repos(spark, sf_dir).where("repository_id % 3 <> 1").select("repository_id", rules.tier(F.col("bundle")).alias("previous_tier"), F.col("bundle").alias("previous_score"))
    pool = gap.join(missed, "repository_id", "full_outer").join(previous, "repository_id", "left")
    print_ = keyed.fingerprint(F.lit("v2").alias("prompt"), F.col("repository_id"), F.col("discovery_reason"), F.col("reevaluation_reason"), F.col("previous_score"))
    pool = similarity.staged(pool.withColumn("fingerprint", print_))
    stored = pool.where("repository_id % 10 <> 0").select("repository_id", F.when(F.col("repository_id") % 4 == 0, "other").otherwise(F.col("fingerprint")).alias("fingerprint"), F.lit("COMPLETED").alias("status"), F.lit("earlier").alias("error"))
    found = keyed.reset_changed(stored, pool, ["repository_id"])
    source = F.when(F.col("reevaluation_reason").isNotNull(), "FALSE_NEGATIVE").otherwise("GAP_FILL")
    return found.select("repository_id", source.alias("pool_source"), "previous_tier", "previous_score", "discovery_reason", "reevaluation_reason", F.coalesce("status", F.lit("NEW")).alias("state"), "error")


# --- Joins and lists -------------------------------------------------------------------------------

SQL_POOL = view.SQL + """, a AS (SELECT repository_id, CAST((repository_id * 41) % 101 AS INT) AS score, concat('worth of ', name) AS proposition FROM repo WHERE repository_id % 2 = 0 AND bundle >= 65)"""


def pool_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pool with repository and current analysis (of every other one), each by a left join."""
    rows = repos(spark, sf_dir)
    pool = rows.where("bundle >= 65").select("repository_id", "bundle", rules.tier(F.col("bundle")).alias("tier"), "category")
    analyses = rows.where("repository_id % 2 = 0 and bundle >= 65").select("repository_id", ((F.col("repository_id") * 41) % 101).cast("int").alias("new_score"), F.concat(F.lit("worth of "), "name").alias("proposition"))
    return pool.join(rows.select("repository_id", F.concat_ws("/", "owner", "name").alias("repository"), "spdx", "stars"), "repository_id", "left").join(analyses, "repository_id", "left")


@query(SQL_POOL + f""", p AS (SELECT r.repository_id, concat_ws('/', owner, name) AS repository, bundle, {SQL_TIER} AS tier, category, spdx, stars, a.score AS new_score, a.proposition FROM repo r LEFT JOIN a USING (repository_id) WHERE bundle >= 65)
 SELECT CAST(row_number() OVER (ORDER BY bundle DESC, repository, repository_id) AS INT) AS rank, repository, bundle, tier, category, spdx, stars, new_score, proposition FROM p ORDER BY rank LIMIT 150""")
def pool_top150(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc("bundle"), F.asc("repository"), F.asc("repository_id")]
    top = pool_rows(spark, sf_dir).orderBy(*order).limit(150)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order))).select("rank", "repository", "bundle", "tier", "category", "spdx", "stars", "new_score", "proposition")


BUSINESS = ["CRM", "BOOKING", "HRM", "INVOICING", "HELPDESK", "EMAIL_MARKETING", "POS", "PROJECT_MANAGEMENT", "REAL_ESTATE", "HOTEL", "LMS", "SURVEY", "CMS", "DASHBOARD", "TIME_TRACKING", "EXPENSES", "ECOMMERCE"]
LISTS = {
    "top_business": ("bundle >= 65 AND category IN " + sql_in(BUSINESS), ["bundle DESC", "repository_id"], 30), "top_new": ("bundle >= 65 AND repository_id % 2 = 0", ["new_score DESC NULLS LAST", "repository_id"], 30),
    "false_negatives": ("bundle < 65 AND repository_id % 2 = 0", ["delta DESC NULLS LAST", "repository_id"], 30), "most_starred": ("stars IS NOT NULL", ["stars DESC", "repository_id"], 20), "longest": ("n_chars IS NOT NULL", ["n_chars DESC", "repository_id"], 20),
    "pool_order": ("bundle >= 65", ["bundle DESC", "stars DESC NULLS LAST", "repository_id"], 100), "most_useful": ("usefulness IS NOT NULL", ["usefulness DESC", "bundle DESC", "repository_id"], 20), "easiest": ("deployment IS NOT NULL", ["deployment DESC", "bundle DESC", "repository_id"], 20),
    "freshest": ("days IS NOT NULL", ["days", "repository_id"], 20), "stalest": ("days IS NOT NULL", ["days DESC", "repository_id"], 20), "weakest": ("bundle IS NOT NULL", ["bundle", "repository_id"], 20), "complete": ("is_complete", ["bundle DESC", "repository_id"], 120),
}
NEW_SCORE = "CASE WHEN repository_id % 2 = 0 THEN CAST((repository_id * 41) % 101 AS INT) END"


@query(view.SQL + f", s AS (SELECT *, {NEW_SCORE} AS new_score, {NEW_SCORE} - bundle AS delta FROM repo) " + " UNION ALL ".join(f"(SELECT '{n}' AS list, CAST(row_number() OVER (ORDER BY {', '.join(o)}) AS INT) AS place, repository_id FROM s WHERE {c} ORDER BY place LIMIT {k})" for n, (c, o, k) in LISTS.items()))
def report_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of the reports, each the first rows by one to three keys."""
    rows = repos(spark, sf_dir).withColumn("new_score", F.expr(NEW_SCORE)).withColumn("delta", F.col("new_score") - F.col("bundle"))
    return shortlist.top_lists(rows, LISTS, "repository_id")


SQL_SHORT = f"short AS (SELECT repository_id, CASE repository_id % 4 WHEN 0 THEN 'CRM' WHEN 1 THEN 'BOOKING' WHEN 2 THEN 'LMS' END AS category FROM (SELECT DISTINCT {FILES['repository_id']} AS repository_id FROM pages) WHERE repository_id % 5 <> 4)"


@query(SQL_FACTS + ", " + SQL_SHORT + """ SELECT coalesce(short.category, 'UNKNOWN') AS category, count_if(decision = 'READY_FOR_SANDBOX') AS ready, count_if(decision = 'REVIEW') AS review, count_if(decision = 'DROP') AS dropped FROM facts LEFT JOIN short USING (repository_id) GROUP BY 1""")
def shortlist_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static decisions by the category that the shortlist gives a repository; those not on it are unknown."""
    short = read(spark, sf_dir, "pages").selectExpr(f"{FILES['repository_id']} AS repository_id").distinct().where("repository_id % 5 <> 4")
    short = short.withColumn("category", F.when(F.col("repository_id") % 4 == 0, "CRM").when(F.col("repository_id") % 4 == 1, "BOOKING").when(F.col("repository_id") % 4 == 2, "LMS"))
    rows = tree_facts(spark, sf_dir).select("repository_id", "decision").join(short, "repository_id", "left").withColumn("category", F.coalesce("category", F.lit("UNKNOWN")))
    wide = rows.groupBy("category").pivot("decision", ["READY_FOR_SANDBOX", "REVIEW", "DROP"]).agg(F.count(F.lit(1))).fillna(0)
    return wide.select("category", F.col("READY_FOR_SANDBOX").alias("ready"), F.col("REVIEW").alias("review"), F.col("DROP").alias("dropped"))


# --- Landed answers --------------------------------------------------------------------------------


def landed(df: DataFrame) -> str:
    """Writes lines of text into a new folder, as a collector would."""
    path = f"{similarity.shared(df.sparkSession)}/landed/{uuid.uuid4().hex}"
    df.write.text(path)
    return path


@query(view.SQL + """ SELECT CASE WHEN repository_id % 20 = 7 THEN NULL ELSE repository_id END AS id, repository_id % 20 = 7 AS broken, CASE WHEN repository_id % 20 = 7 THEN NULL ELSE concat(owner, '/', name) END AS full_name, CASE WHEN repository_id % 20 = 7 THEN NULL ELSE stars END AS stars,
 CASE WHEN repository_id % 20 = 7 THEN NULL ELSE spdx END AS spdx FROM repo""")
def landed_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repository answers landed as lines of JSON and scanned under their schema; broken lines keep their text and nothing else."""
    rows = repos(spark, sf_dir)
    record = F.to_json(F.struct(F.col("repository_id").alias("id"), F.struct(F.col("owner").alias("login")).alias("owner"), "name", F.concat("owner", F.lit("/"), "name").alias("full_name"), F.col("stars").alias("stargazers_count"), F.struct(F.col("spdx").alias("spdx_id")).alias("license")))
    line = F.when(F.col("repository_id") % 20 == 7, F.substring(record, 1, 25)).otherwise(record)
    found = scans.repository_records(spark, landed(rows.select(line.alias("value"))))
    whole = F.col("_corrupt").isNull()
    return found.select(*[F.when(whole, c).alias(n) for n, c in (("id", F.col("id")), ("full_name", F.col("full_name")), ("stars", F.col("stargazers_count")), ("spdx", F.col("license.spdx_id")))], (~whole).alias("broken"))


@query(view.SQL + """, h AS (SELECT repository_id, category, lower(category) AS term FROM repo WHERE repository_id % 3 <> 0) SELECT category, count(*) AS raw, count(DISTINCT repository_id % 500) AS unique_ids, count_if(coalesce(stars, 0) >= 5) AS starred, min(repository_id % 500) AS first_id FROM h JOIN repo USING (repository_id, category) GROUP BY category""")
def landed_search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search answers landed by query, their items exploded and counted by category."""
    rows = repos(spark, sf_dir).where("repository_id % 3 <> 0")
    item = F.struct((F.col("repository_id") % 500).alias("id"), "name", F.concat("owner", F.lit("/"), "name").alias("full_name"), F.struct(F.col("owner").alias("login")).alias("owner"), F.col("stars").alias("stargazers_count"))
    page = rows.withColumn("page", F.expr("repository_id div 1000"))  # an answer holds a thousand hits at most
    answers = page.groupBy("category", "page").agg(F.to_json(F.struct(F.count("*").alias("total_count"), F.lit(False).alias("incomplete_results"), F.collect_list(item).alias("items"))).alias("response"))
    hits = scans.search_hits(answers.select("category", F.lower("category").alias("query_text"), "response"))
    return hits.groupBy("category").agg(F.count("*").alias("raw"), F.count_distinct("id").alias("unique_ids"), F.count_if(F.coalesce("stargazers_count", F.lit(0)) >= 5).alias("starred"), F.min("id").alias("first_id"))


SQL_CALL = "CASE doc_id % 6 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 403 WHEN 3 THEN 500 WHEN 4 THEN 403 ELSE 200 END"


@query(f"""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'SKIPPED' WHEN {SQL_CALL} = 200 THEN 'COMPLETED' WHEN doc_id % 6 = 2 THEN 'RATE_LIMITED' ELSE 'FAILED' END AS search_state, CASE WHEN {SQL_CALL} = 200 THEN 'FETCHED' WHEN doc_id % 6 = 1 THEN 'MISSING' ELSE 'FAILED' END AS readme_state,
 CASE WHEN doc_id % 4 <> 0 AND {SQL_CALL} <> 200 THEN length(substring(coalesce(text, ''), 1, 2000)) END AS message_length FROM documents""")
def fetch_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of search queries and READMEs from a landed log of calls; completed queries are skipped."""
    log = read(spark, sf_dir, "documents").selectExpr("doc_id", f"{SQL_CALL} AS http_status", "CASE WHEN doc_id % 6 = 2 THEN 0 ELSE 10 END AS remaining", "text AS error", "CASE WHEN doc_id % 4 = 0 THEN 'COMPLETED' ELSE 'PENDING' END AS stored")
    call = [F.col("http_status"), F.col("remaining")]
    rows = once(log, {"search": outcomes.search_outcome(*call, F.coalesce("error", F.lit(""))), "readme": outcomes.readme_outcome(*call), "due": rules.needs_search(F.col("stored"))})
    return rows.select("doc_id", F.when(F.col("due"), F.col("search.state")).otherwise("SKIPPED").alias("search_state"), F.col("readme.state").alias("readme_state"), F.when(F.col("due"), F.length("search.error_message")).alias("message_length"))


SQL_STATUS = "CASE WHEN n_chars IS NULL OR n_chars % 11 = 0 THEN NULL ELSE list_extract([200, 404, 403, 403, 429, 500, 502, 200, 410], CAST(n_chars % 9 + 1 AS INT)) END"


@query(f"""WITH c AS (SELECT doc_id, text, {SQL_STATUS} AS status, CAST(length(text) % 3 AS INT) AS remaining FROM documents), f AS (SELECT *, coalesce(status BETWEEN 200 AND 299, false) AS ok, coalesce(status = 429 OR (status = 403 AND remaining = 0), false) AS limited, coalesce(status = 404, false) AS missing FROM c)
 SELECT doc_id, CASE WHEN ok THEN 'ENRICHED' WHEN missing THEN 'UNAVAILABLE' WHEN limited THEN 'RATE_LIMITED' ELSE 'FAILED' END AS metadata_state, CASE WHEN ok THEN NULL WHEN missing THEN '404' WHEN limited THEN 'rate_limited' ELSE coalesce('http_' || CAST(status AS VARCHAR), 'unknown') END AS metadata_code,
 md5(CASE WHEN ok THEN NULL WHEN missing OR limited THEN text ELSE substring(text, 1, 2000) END) AS metadata_message, CASE WHEN ok THEN 'FETCHED' WHEN missing THEN 'MISSING' ELSE 'FAILED' END AS readme_state,
 CASE WHEN ok THEN 'COMPLETED' WHEN limited THEN 'RATE_LIMITED' ELSE 'FAILED' END AS search_state, CASE WHEN ok THEN NULL WHEN limited THEN 'rate_limited' WHEN missing THEN 'not_found' ELSE coalesce('http_' || CAST(status AS VARCHAR), 'unknown') END AS search_code, limited AS stops FROM f""")
def call_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States, codes and messages of landed calls in three variants, statuses and quotas from the texts' lengths."""
    statuses = [200, 404, 403, 403, 429, 500, 502, 200, 410]
    status = F.when(F.col("n_chars") % 11 != 0, F.get(F.array(*map(F.lit, statuses)), (F.col("n_chars") % 9).cast("int")))
    calls = read(spark, sf_dir, "documents").select("doc_id", "text", status.alias("status"), (F.length("text") % 3).alias("remaining"))
    call = [F.col("status"), F.col("remaining")]
    rows = once(calls, {"metadata": outcomes.metadata_outcome(*call, F.col("text")), "readme": outcomes.readme_outcome(*call), "search": outcomes.search_outcome(*call, F.col("text"))})
    return rows.select(
        "doc_id", F.col("metadata.state").alias("metadata_state"), F.col("metadata.error_code").alias("metadata_code"), F.md5("metadata.error_message").alias("metadata_message"),
        F.col("readme.state").alias("readme_state"), F.col("search.state").alias("search_state"), F.col("search.error_code").alias("search_code"), outcomes.stops(*call).alias("stops"),
    )


@query("""WITH r AS (SELECT conv_id, turn, length(text) AS n, length(replace(coalesce(text, ''), ' ', '')) AS plain FROM conversations WHERE role <> 'user')
 SELECT conv_id % 5 AS version, count(*) AS requests, CAST(sum(CASE WHEN turn % 7 = 0 THEN 0 ELSE coalesce(n, 0) END) AS BIGINT) AS input_tokens, CAST(sum(CASE WHEN turn % 7 = 0 OR turn % 5 = 0 THEN 0 ELSE plain END) AS BIGINT) AS output_tokens FROM r GROUP BY 1""")
def usage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests and tokens of landed responses by version of the run; some responses are broken or state no usage."""
    stated = F.struct(F.coalesce(F.length("text"), F.lit(0)).alias("input_tokens"), F.when(F.col("turn") % 5 != 0, F.length(F.replace(F.coalesce("text", F.lit("")), F.lit(" "), F.lit("")))).alias("output_tokens"))
    landed = F.to_json(F.struct(F.lit("x").alias("id"), F.struct(F.col("text").alias("output")).alias("answer"), stated.alias("usage")))
    rows = read(spark, sf_dir, "conversations").where("role <> 'user'").select((F.col("conv_id") % 5).alias("version"), F.when(F.col("turn") % 7 == 0, F.lit("{broken")).otherwise(landed).alias("response"))
    used = once(rows, {"used": outcomes.usage(F.col("response"))})
    return used.groupBy("version").agg(F.count("*").alias("requests"), F.sum("used.input_tokens").alias("input_tokens"), F.sum("used.output_tokens").alias("output_tokens"))


# --- Reports ---------------------------------------------------------------------------------------


@query(view.SQL + f""", s AS (SELECT *, {SQL_TIER} AS tier FROM repo) SELECT 'tiers' AS section, tier AS name, count(*) AS n FROM s GROUP BY tier UNION ALL SELECT 'categories', category, count(*) FROM s GROUP BY category UNION ALL SELECT 'pool', 'total', count_if(bundle >= 65) FROM s""")
def report_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as JSON, one section a row with its rows nested, and read again by the next stage."""
    rows = repos(spark, sf_dir).select("category", "bundle", rules.tier(F.col("bundle")).alias("tier"))
    tiers, categories = (rows.groupBy(F.col(c).alias("name")).agg(F.count("*").alias("n")).withColumn("section", F.lit(s)) for c, s in (("tier", "tiers"), ("category", "categories")))
    pool = rows.agg(F.count_if(F.col("bundle") >= 65).alias("n")).select(F.lit("total").alias("name"), "n", F.lit("pool").alias("section"))
    every = tiers.unionByName(categories).unionByName(pool)
    nested = every.groupBy("section").agg(F.sort_array(F.collect_list(F.struct("name", "n"))).alias("rows"))  # rows of tiers and categories, fixed lists
    path = f"{similarity.shared(spark)}/reports/{uuid.uuid4().hex}"
    keyed.write_report(nested, path)
    return keyed.read_report(spark, path, "section string, rows array<struct<name:string,n:long>>").select("section", F.inline("rows"))
