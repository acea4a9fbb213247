"""Static inspection of repository files, its reports, and the replayed stream of pages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, static
from ..operators import keyed, similarity
from ..sources import scans
from ..streaming import ingest, stateful
from ..streaming.message_table import MessageTable
from .queries import once, q, query, read, sql_has, sql_points
from .view import choose

PATHS = ["readme.txt", "package.json", "docker-compose.yml", "src/index.ts", "tests/a.test.ts", ".env.example", "prisma/migrations/1.sql", "db/seed.ts", "LICENSE", "node_modules/x/index.js", "vercel.json", "pnpm-lock.yaml", "docs/README.md", "packages.d/package.json"]
READMES = ["A dashboard application with React and postgres. Installation: npm install. Screenshots below. Stripe billing.", "A client library and sdk wrapper.", "Booking platform. Quick start with docker. Uses redis, mysql and OpenAI. Set API_KEY and SECRET_TOKEN.\n\n  pnpm install --frozen\nnpm run build\nnpm ci", "Notes.", "CRM system, Next.js and Django, sqlite, admin panel, getting started, deploy."]
MANIFESTS = ['{"name":"a","scripts":{"dev":"next dev","test":"vitest","postinstall":"node scripts/x"},"dependencies":{"react":"^16.1","express":"4"}}', '{"scripts":{"build":"tsc"},"workspaces":["packages/*"],"dependencies":{"node-sass":"1"}}', '{"name":"c","workspaces":false,"dependencies":{"twilio":"1","mongoose":"2"}}', '{"name":"broken","dependencies":{"firebase":']
LICENCE_FILES = ["MIT License\n\nPermission is hereby granted, free of charge", "GNU General Public License version 3", "Apache License Version 2.0", "All rights reserved"]
ENVS = ["DB_HOST=x\nAPP_SECRET=1", "API=1\nMAIL_PORT=25", ""]
EACH = 14
FILES = {
    "repository_id": f"CAST(floor(page_id / {EACH}) AS BIGINT)",
    "path": f"concat(CASE WHEN page_id % 5 = 0 THEN concat('apps/', CAST(page_id AS STRING), '/') ELSE '' END, {choose(EACH, PATHS)})",
    "size": "length(html)",
    "content": f"CASE page_id % {EACH} WHEN 0 THEN {choose(5, READMES)} WHEN 12 THEN {choose(5, READMES)} WHEN 1 THEN {choose(4, MANIFESTS)} WHEN 13 THEN {choose(4, MANIFESTS)} WHEN 5 THEN {choose(3, ENVS)} WHEN 8 THEN {choose(4, LICENCE_FILES)} ELSE '' END",
}
FILES = {k: v.replace("doc_id", "page_id") for k, v in FILES.items()}
STATED = choose(5, ["MIT", "GPL-3.0", "Apache-2.0", None, "MIT"]).replace("doc_id", "repository_id")
ROOT_README = r"^readme(?:\.[^.]+)?$"
# Words in READMEs and manifests that speak for a user interface, a way to run, an application, a library.
UI_WORDS, RUNTIME_WORDS = "screenshots?|demo|dashboard|admin panel|web app|web application", "installation|quick start|getting started|deploy"
APP_WORDS, LIBRARY_WORDS = "crm|booking|inventory|dashboard|management|platform|application|system|self.host", r"\b(?:sdk|library|framework|plugin|wrapper)\b"


def first_texts(files: DataFrame, flag: str, order: list[Column], most: int, name: str, joined: str = "\n") -> DataFrame:
    """(repository_id, name): the contents of the first `most` files of a role, in order; cut before they are gathered."""
    top = keyed.top_per_key(files.where(flag).select("repository_id", "path", "content"), ["repository_id"], order, most, "place")
    held = F.array_sort(F.collect_list(F.struct("place", "content")))
    return top.groupBy("repository_id").agg(F.array_join(F.transform(held, lambda x: x["content"]), joined).alias(name))


def tree_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts_of_files(read(spark, sf_dir, "pages").selectExpr(*[f"{e} AS {c}" for c, e in FILES.items()]))


def facts_of_files(files: DataFrame) -> DataFrame:
    """One row of facts a repository, from its wanted files (repository_id, path, size, content); contents are read of a few files by role."""
    known = scans.repository_files(files).select("repository_id", "path", "size", static.file_name(F.col("path")).alias("name"), *static.role_flags(F.col("path")))
    known = similarity.staged(known)  # numbers and paths, read for the facts and for what is wanted
    held = known.groupBy("repository_id").agg(*[F.bool_or(r).alias(r.replace("is_", "has_")) for r in (*static.ROLES, "is_manifest")], F.count("*").alias("n_files"), F.sum("size").alias("total_size"), F.collect_set("name").alias("names"))  # 8,000 names at most
    roles = ["is_readme", "is_manifest", "is_env", "is_licence"]
    wanted = known.select("repository_id", "path", *roles).where(" or ".join(roles))
    read_ = similarity.staged(files.select("repository_id", "path", "content").join(wanted, ["repository_id", "path"]))
    path = [F.col("path")]
    manifests = keyed.top_per_key(read_.where("is_manifest"), ["repository_id"], path, static.MOST_MANIFESTS, "place").withColumn("object", static.manifest_object(F.col("content"))).where("object is not null")
    ordered = F.array_sort(F.collect_list(F.struct("place", "object")))
    packages = manifests.groupBy("repository_id").agg(F.array_join(F.transform(ordered, lambda x: x["object"]), "\n").alias("packages"), F.array_sort(F.flatten(F.collect_list(static.scripts(F.col("path"), F.col("object"))))).alias("scripts"), F.bool_or(static.has_workspaces(F.col("object"))).alias("workspaces"))
    root_first = [F.when(rules.has(F.col("path"), ROOT_README), 0).otherwise(1), *path]
    for part in (packages, first_texts(read_, "is_readme", root_first, 1, "readme"), first_texts(read_, "is_licence", path, 1, "licence_text"), first_texts(read_, "is_env", path, static.MOST_ENVS, "env_text")):
        held = held.join(part, "repository_id", "left")
    held = held.fillna("", ["packages", "readme", "licence_text", "env_text"]).fillna(False, ["workspaces"]).withColumn("scripts", F.coalesce("scripts", F.array().cast("array<string>")))
    low = rules.lowered
    texts = {"evidence": F.concat_ws("\n", "packages", "readme"), "low_packages": low(F.col("packages")), "low_readme": low(F.col("readme")), "low_licence": low(F.col("licence_text"))}
    held = once(held, texts | {"low_evidence": low(texts["evidence"]), "stated": rules.licence_family(F.expr(STATED)), "manager": static.package_manager(F.col("names"), F.col("has_manifest"))})
    in_evidence = {n: static.labels(F.col("low_evidence"), found, True) for n, found in (("stack", static.STACK), ("frontend", static.FRONTEND), ("backend", static.BACKEND), ("databases", static.DATABASES), ("services", static.SERVICES))}
    held = once(held, in_evidence | {"deprecated": static.labels(F.col("low_packages"), static.DEPRECATED, True)})
    detected = F.when(F.col("has_licence"), rules.licence_in_text(F.col("low_licence"), True)).otherwise(rules.licence_in_text(F.col("low_readme"), True))
    by_file = F.array_compact(F.array(*[F.when(F.array_contains("names", f), label) for f, label in static.STACK_FILES.items()]))
    some = {"detected": detected, "stack_found": F.array_sort(F.array_distinct(F.concat("stack", by_file))), "paid": F.array_intersect("services", F.array(*map(F.lit, static.PAID)))}
    some |= {"install": static.install_commands(F.col("readme"), F.col("manager")), "variables": static.environment_variables(F.concat_ws("\n", "evidence", "env_text")), "monorepo": F.col("has_workspace") | F.col("workspaces")}
    some |= {"tests": F.col("has_test") | F.exists("scripts", lambda s: rules.has(s, static.TEST_SCRIPT)), "suspicious": F.filter("scripts", lambda s: rules.has(s, static.SUSPICIOUS))}
    some |= {"ui": (F.size("frontend") > 0) | rules.has(F.col("low_readme"), UI_WORDS, True), "runtime": F.exists("scripts", lambda s: rules.has(s, static.RUNTIME_SCRIPT)) | F.col("has_docker") | rules.has(F.col("low_readme"), RUNTIME_WORDS, True)}
    held = once(held, some).drop("stack").withColumnRenamed("stack_found", "stack")
    held = once(held, {
        "matches": rules.licence_matches(F.col("detected"), F.col("stated")), "library": rules.has(F.concat_ws("\n", F.substring("low_readme", 1, 5000), "low_packages"), LIBRARY_WORDS, True) & ~F.col("ui"),
        "standalone": rules.has(F.concat_ws("\n", "low_readme", "low_packages"), APP_WORDS, True) & F.col("runtime") & (F.col("ui") | F.col("has_docker")),
    })
    facts = {
        "standalone": F.col("standalone"), "ui": F.col("ui"), "runtime": F.col("runtime"), "docker": F.col("has_docker"), "env": F.col("has_env"), "tests": F.col("tests"), "migrations": F.col("has_migration"),
        "seed": F.col("has_seed"), "deployment": F.col("has_deployment"), "licence_matches": F.col("matches"), "licence_detected": F.col("detected"), "deprecated": F.size("deprecated") > 0, "paid": F.size("paid") > 0,
        "databases": F.size("databases"), "monorepo": F.col("monorepo"), "manifest": F.col("has_manifest"), "library": F.col("library"),
    }
    held = once(held, {"score": static.decision_score(facts)})
    return held.withColumn("setup", static.setup_complexity(F.col("score"), facts["databases"], facts["paid"])).select("*", F.inline(F.array(static.static_decision(facts, F.col("score")))))


def sql_labels(field: str, labels: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {sql_has(field, p)} THEN {q(label)} END" for p, label in labels) + "], lambda x: x IS NOT NULL)"


SQL_LICENCE = lambda field: "CASE " + " ".join(f"WHEN {sql_has(field, p)} THEN {q(v)}" for p, v in rules.LICENCE_TEXTS) + " ELSE NULL END"
SQL_STATED = f"CASE {' '.join(f'WHEN {sql_has(STATED, p)} THEN {q(v)}' for p, v in rules.LICENCE_IDS)} ELSE upper({STATED}) END"
SQL_FACTS = (
    "WITH a AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in FILES.items()) + f""" FROM pages), b0 AS (SELECT *, row_number() OVER (PARTITION BY repository_id ORDER BY len(string_split(path, '/')), path) AS file_rank FROM a
 WHERE NOT regexp_matches(path, '(^|/)({"|".join(s.replace(".", "[.]") for s in static.SKIPPED)})(/|$)')),
 b AS (SELECT *, lower(regexp_extract(path, '[^/]*$')) AS name, {", ".join(f"{sql_has('path', p)} AS {r}" for r, p in static.ROLES.items())}, ends_with(path, '{static.MANIFEST}') AS is_manifest, CASE WHEN json_valid(content) AND content <> '' THEN content END AS object FROM b0 WHERE file_rank <= 8000),
 s0 AS (SELECT *, row_number() OVER (PARTITION BY repository_id ORDER BY path) AS place FROM b WHERE is_manifest),
 s AS (SELECT repository_id, list_sort(flatten(list(list_transform(json_keys(object, '$.scripts'), lambda k: concat(path, ':', k, '=', json_extract_string(object, concat('$.scripts.', k))))))) AS scripts FROM s0 WHERE place <= 30 AND object IS NOT NULL AND json_extract(object, '$.scripts') IS NOT NULL GROUP BY repository_id),
 w AS (SELECT repository_id, string_agg(object, chr(10) ORDER BY path) AS packages, bool_or(coalesce(json_type(object, '$.workspaces') IN ('ARRAY', 'OBJECT'), false)) AS workspaces FROM s0 WHERE place <= 30 AND object IS NOT NULL GROUP BY repository_id),
 c0 AS (SELECT repository_id, count(*) AS n_files, sum(size) AS total_size, {", ".join(f"bool_or({r}) AS {r.replace('is_', 'has_')}" for r in (*static.ROLES, "is_manifest"))}, list(DISTINCT name) AS names, coalesce(arg_min(content, concat(CASE WHEN contains(path, '/') THEN '1' ELSE '0' END, path)) FILTER (is_readme), '') AS readme,
 coalesce(arg_min(content, path) FILTER (is_licence), '') AS licence_text, coalesce(string_agg(content, chr(10) ORDER BY path) FILTER (is_env), '') AS env_text FROM b GROUP BY repository_id),
 c AS (SELECT c0.*, coalesce(w.packages, '') AS packages, coalesce(w.workspaces, false) AS workspaces FROM c0 LEFT JOIN w USING (repository_id)),
 d AS (SELECT c.*, coalesce(s.scripts, []) AS scripts, concat(packages, chr(10), readme) AS evidence, {SQL_STATED} AS stated, CASE WHEN has_licence THEN {SQL_LICENCE("licence_text")} ELSE {SQL_LICENCE("readme")} END AS detected FROM c LEFT JOIN s USING (repository_id)),
 e AS (SELECT *, {sql_labels("evidence", static.FRONTEND)} AS frontend, {sql_labels("evidence", static.DATABASES)} AS databases, {sql_labels("evidence", static.SERVICES)} AS services, {sql_labels("packages", static.DEPRECATED)} AS deprecated,
 CASE WHEN detected IS NOT NULL AND stated IS NOT NULL THEN detected = stated ELSE NULL END AS matches, CASE {" ".join(f"WHEN {'has_manifest' if k == static.MANIFEST else f'list_contains(names, {q(k)})'} THEN {q(m)}" for k, m in static.LOCKS)} ELSE NULL END AS manager FROM d),
 f AS (SELECT *, list_filter(services, lambda x: x IN ({", ".join(map(q, static.PAID))})) AS paid, has_workspace OR workspaces AS monorepo, has_test OR len(list_filter(scripts, lambda x: {sql_has("x", static.TEST_SCRIPT)})) > 0 AS tests,
 len(list_filter(scripts, lambda x: {sql_has("x", static.SUSPICIOUS)})) AS n_suspicious, len(frontend) > 0 OR {sql_has("readme", UI_WORDS)} AS ui, len(list_filter(scripts, lambda x: {sql_has("x", static.RUNTIME_SCRIPT)})) > 0 OR has_docker OR {sql_has("readme", RUNTIME_WORDS)} AS runtime FROM e),
 g AS (SELECT *, {sql_has("concat(substring(readme, 1, 5000), chr(10), packages)", LIBRARY_WORDS)} AND NOT ui AS library, {sql_has("concat(readme, chr(10), packages)", APP_WORDS)} AND runtime AND (ui OR has_docker) AS standalone FROM f),
 h AS (SELECT *, least(100, greatest(0, 20 + {sql_points("standalone", 20)} + {sql_points("ui", 12)} + {sql_points("runtime", 12)} + {sql_points("has_docker", 8)} + {sql_points("has_env", 5)} + {sql_points("tests", 6)} + {sql_points("has_migration", 5)} + {sql_points("has_seed", 4)} + {sql_points("has_deployment", 4)}
 + CASE WHEN coalesce(matches, true) THEN 4 ELSE -12 END - {sql_points("len(deprecated) > 0", 8)} - {sql_points("len(paid) > 0", 4)} - {sql_points("len(databases) > 1", 3)} - {sql_points("monorepo", 3)})) AS score FROM g),
 facts AS (SELECT *, CASE WHEN score >= 78 AND len(databases) <= 1 AND len(paid) = 0 THEN 'LOW' WHEN score >= 55 THEN 'MEDIUM' ELSE 'HIGH' END AS setup, CASE WHEN coalesce(NOT matches AND detected = 'GPL', false) THEN 'DROP' WHEN library OR (NOT runtime AND NOT has_docker AND NOT has_manifest) THEN 'REVIEW'
 WHEN score >= 75 AND standalone AND coalesce(matches, true) THEN 'READY_FOR_SANDBOX' ELSE 'REVIEW' END AS decision, CASE WHEN coalesce(NOT matches AND detected = 'GPL', false) THEN {q(static.REASONS["conflict"])} WHEN library THEN {q(static.REASONS["library"])}
 WHEN NOT runtime AND NOT has_docker AND NOT has_manifest THEN {q(static.REASONS["nothing"])} WHEN score >= 75 AND standalone AND coalesce(matches, true) THEN {q(static.REASONS["ready"])} ELSE {q(static.REASONS["other"])} END AS reason,
 list_sort(list_distinct(list_filter(list_concat(list_filter(list_transform(regexp_extract_all(readme, {q(static.COMMANDS)}), lambda c: trim(c, concat(' ', chr(10), chr(9)))), lambda c: {sql_has("c", r"install|\bci\b")}), [CASE manager {" ".join(f"WHEN {q(m)} THEN {q(c)}" for m, c in static.INSTALL.items())} END]), lambda c: c IS NOT NULL))) AS install,
 list_sort(list_filter(list_distinct(regexp_extract_all(concat(evidence, chr(10), env_text), '\\b[A-Z][A-Z0-9_]{{2,}}\\b')), lambda x: x NOT IN ({", ".join(map(q, static.NOT_VARIABLES))}))) AS variables FROM h)"""
)


@query(SQL_FACTS + " SELECT repository_id, CAST(n_files AS BIGINT) AS n_files, CAST(total_size AS BIGINT) AS total_size, detected, matches, manager, monorepo, tests, array_to_string(databases, ',') AS databases, array_to_string(paid, ',') AS paid, CAST(n_suspicious AS INT) AS n_suspicious, CAST(score AS INT) AS score, setup, decision, reason, array_to_string(variables, ',') AS variables, array_to_string(install, ';') AS install FROM facts")
def tree_facts_and_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_facts(spark, sf_dir).select("repository_id", "n_files", "total_size", "detected", "matches", "manager", "monorepo", "tests", F.array_join("databases", ",").alias("databases"), F.array_join("paid", ",").alias("paid"), F.size("suspicious").alias("n_suspicious"), "score", "setup", "decision", "reason", F.array_join("variables", ",").alias("variables"), F.array_join("install", ";").alias("install"))


@query(SQL_FACTS + " SELECT decision, count(*) AS n, count_if(list_contains(databases, 'PostgreSQL')) AS postgres, count_if(len(databases) > 0) AS with_database, count_if(has_docker) AS docker, count_if(len(paid) > 0) AS paid, count_if(len(paid) = 0 AND NOT list_has_any(services, ['Supabase', 'Firebase', 'AWS/S3'])) AS local_only, count_if(has_seed) AS seed, count_if(has_env) AS env FROM facts GROUP BY decision")
def infrastructure_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = {"postgres": F.array_contains("databases", "PostgreSQL"), "with_database": F.size("databases") > 0, "docker": F.col("has_docker"), "paid": F.size("paid") > 0, "local_only": (F.size("paid") == 0) & ~F.arrays_overlap("services", F.array(F.lit("Supabase"), F.lit("Firebase"), F.lit("AWS/S3"))), "seed": F.col("has_seed"), "env": F.col("has_env")}
    return tree_facts(spark, sf_dir).groupBy("decision").agg(F.count("*").alias("n"), *[F.count_if(c).alias(n) for n, c in counts.items()])


@query(SQL_FACTS + f""", k AS (SELECT repository_id, frontend, list_concat({sql_labels("evidence", static.STACK)}, [{", ".join(f"CASE WHEN list_contains(names, {q(n)}) THEN {q(v)} END" for n, v in static.STACK_FILES.items())}]) AS stack, {sql_labels("evidence", static.BACKEND)} AS backend, services, deprecated FROM facts)
 SELECT repository_id, {", ".join(f"array_to_string(list_sort(list_distinct(list_filter({c}, lambda x: x IS NOT NULL))), ',') AS {c}" for c in ("stack", "frontend", "backend", "services", "deprecated"))} FROM k""")
def tree_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sets of labels of an inspection: stack, front end, back end, services and old dependencies, each sorted."""
    sets = ("stack", "frontend", "backend", "services", "deprecated")
    return tree_facts(spark, sf_dir).select("repository_id", *[F.array_join(F.array_sort(F.array_distinct(c)), ",").alias(c) for c in sets])


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel pages over the table `pages`: one message a page, its address and text from the row."""
    message = F.format_string(
        '<div class="tgme_widget_message" data-post="chan/%d"><div class="tgme_widget_message_text">%s <a href="%s">x</a> https://github.com/Own/Repo%d</div><span class="tgme_widget_message_views">%d.5K</span><time datetime="2025-01-02T03:04:05+00:00"></time></div>',
        F.col("page_id"), F.regexp_replace("html", "[<>&]", " "), F.col("url"), F.col("page_id") % 40, F.col("page_id") % 9,
    )
    rows = read(spark, sf_dir, "pages").select(F.concat(F.lit("https://t.me/s/chan?before="), F.col("page_id").cast("string")).alias("page_url"), F.lit("chan").alias("channel"), message.alias("html"))
    return rows.withColumn("crawled_at", F.lit("2025-02-01").cast("timestamp"))


@query("SELECT page_id AS message_id, concat('https://github.com/own/repo', CAST(page_id % 40 AS VARCHAR)) AS repository, CAST((page_id % 9) * 1000 + 500 AS BIGINT) AS views FROM pages")
def stream_ingest_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages land twice and are streamed into the message table, which holds each message once."""
    base = f"{similarity.shared(spark)}/ingest/{uuid.uuid4().hex}"
    landed_pages(spark, sf_dir).write.parquet(f"{base}/landing")
    landed_pages(spark, sf_dir).write.mode("append").parquet(f"{base}/landing")
    ingest.ingest(spark, f"{base}/landing", f"{base}/messages", f"{base}/checkpoint")
    table = MessageTable(spark, f"{base}/messages").read()
    return table.select("message_id", F.get("repository_links", F.lit(0)).alias("repository"), "views")


@query("SELECT page_id AS message_id, CAST((page_id % 9) * 1000 + 500 AS BIGINT) AS views FROM pages")
def stream_first_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages land twice and are streamed through a deduplication whose state a watermark bounds."""
    base = f"{similarity.shared(spark)}/ingest/{uuid.uuid4().hex}"
    landed_pages(spark, sf_dir).write.parquet(f"{base}/landing")
    landed_pages(spark, sf_dir).withColumn("crawled_at", F.col("crawled_at") + F.expr("interval 1 hour")).write.mode("append").parquet(f"{base}/landing")
    stateful.ingest_first_copies(spark, f"{base}/landing", f"{base}/messages", f"{base}/checkpoint", "1 day")
    return spark.read.parquet(f"{base}/messages").select("message_id", "views")


@query("SELECT page_id AS message_id, CAST((page_id % 9) * 1000 + 500 AS BIGINT) AS views, TIMESTAMP '2025-02-01 01:00:00' AS crawled_at FROM pages")
def stream_late_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two crawls of each page, the newer one read first for every other page: the newer wins, by the state of its key."""
    base = f"{similarity.shared(spark)}/ingest/{uuid.uuid4().hex}"
    pages = landed_pages(spark, sf_dir)
    newer = pages.withColumn("crawled_at", F.col("crawled_at") + F.expr("interval 1 hour"))
    older = pages.withColumn("html", F.regexp_replace("html", r"\.5K</span>", ".1K</span>"))
    even = F.regexp_extract("page_url", r"\d+$", 0).cast("long") % 2 == 0
    newer.where(even).unionByName(older.where(~even)).write.parquet(f"{base}/landing")
    older.where(even).unionByName(newer.where(~even)).write.mode("append").parquet(f"{base}/landing")
    stateful.ingest_newest_crawls(spark, f"{base}/landing", f"{base}/messages", f"{base}/checkpoint", "1 day", "2 days")
    table = MessageTable(spark, f"{base}/messages").read()
    return table.select("message_id", "views", "crawled_at")


@query(SQL_FACTS + " SELECT repository_id, CAST(score AS INT) AS score FROM facts ORDER BY score DESC, repository_id LIMIT 20")
def top_inspected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tree_facts(spark, sf_dir).select("repository_id", "score")
    return rows.orderBy(F.desc("score"), "repository_id").limit(20)


TREE = {"repository_id": "CAST(floor(page_id / 400) AS BIGINT)", "path": FILES["path"], "size": "length(html)", "position": "page_id"}


@query("WITH t AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in TREE.items()) + f""" FROM pages), n AS (SELECT *, lower(regexp_extract(path, '[^/]*$')) AS name FROM t), l AS (SELECT *, {sql_has("name", static.INSPECTED_NAMES)} AS wanted, row_number() OVER (PARTITION BY repository_id ORDER BY position) AS place FROM n
 WHERE NOT starts_with(path, '/') AND ({sql_has("name", static.INSPECTED_NAMES)} OR {sql_has("path", static.INSPECTED_FOLDERS)})), m AS (SELECT *, row_number() OVER (PARTITION BY repository_id ORDER BY wanted DESC, len(string_split(path, '/')), lower(path), position) AS nth FROM l WHERE place <= 240)
 SELECT repository_id, path, position, wanted AND nth <= 24 AS with_content FROM m""")
def static_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an inspection lists and reads of landed file trees."""
    tree = read(spark, sf_dir, "pages").selectExpr(*[f"{e} AS {c}" for c, e in TREE.items()])
    return scans.selected_tree(tree).select("repository_id", "path", "position", "with_content")
