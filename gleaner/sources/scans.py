"""Scans of landed data: pages, API records, model responses, repository files, the search catalogue."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rules, urls
from ..functions.static import wanted_path

REPOSITORY_SCHEMA = """id long, node_id string, owner struct<login:string,avatar_url:string>, name string, full_name string, html_url string,
description string, homepage string, stargazers_count int, forks_count int, watchers_count int, open_issues_count int, subscribers_count int,
language string, topics array<string>, size int, default_branch string, created_at string, updated_at string, pushed_at string, archived boolean,
disabled boolean, fork boolean, visibility string, license struct<spdx_id:string,name:string,url:string>"""
SEARCH_SCHEMA = """total_count long, incomplete_results boolean, items array<struct<id:long,node_id:string,name:string,full_name:string,html_url:string,
owner:struct<login:string,avatar_url:string>,description:string,fork:boolean,archived:boolean,disabled:boolean,stargazers_count:int,pushed_at:string,license:struct<spdx_id:string>>>"""
README_SCHEMA = "content string, encoding string, sha string"
MESSAGE_SCHEMA = "channel string, message_id long, position int, text string, html string, anchors array<string>, published string, edited string, views_text string, raw_source string"
# Search phrases by category.
SEARCH_TERMS = {
    "CRM": ["crm", "customer relationship management", "sales pipeline", "lead management"],
    "BOOKING": ["booking system", "appointment scheduling", "reservation system", "scheduling app"],
    "HR": ["hr management", "human resources management", "employee management", "applicant tracking system"],
    "INVOICING": ["invoicing application", "invoice management", "billing system"],
    "ACCOUNTING": ["accounting software", "bookkeeping application", "general ledger"],
    "EXPENSES": ["expense management", "expense tracker", "reimbursement management"],
    "ERP": ["erp system", "enterprise resource planning", "business management suite"],
    "POS": ["point of sale", "pos system", "retail checkout"],
    "INVENTORY": ["inventory management", "stock management", "warehouse management"],
    "ECOMMERCE": ["ecommerce platform", "online store", "shopping cart application"],
    "CUSTOMER_SUPPORT": ["customer support platform", "support ticket system", "customer service software"],
    "HELPDESK": ["helpdesk software", "help desk ticketing", "ticketing system"],
    "PROJECT_MANAGEMENT": ["project management application", "task management system", "kanban project management"],
    "PROPERTY_MANAGEMENT": ["property management software", "rental property management", "tenant management"],
    "REAL_ESTATE": ["real estate management", "real estate listings", "realtor crm"],
    "RESTAURANT": ["restaurant management", "restaurant ordering system", "restaurant pos"],
    "HOTEL": ["hotel management system", "hotel reservation system", "hospitality management"],
    "LMS": ["learning management system", "lms platform", "online learning platform"],
    "CLIENT_PORTAL": ["client portal", "customer portal", "member portal"],
    "FORM_BUILDER": ["form builder application", "form builder platform", "online forms software"],
    "SURVEY": ["survey builder", "survey platform", "questionnaire application"],
    "MARKETING": ["marketing automation", "marketing campaign management", "marketing platform"],
    "EMAIL_MARKETING": ["email marketing platform", "newsletter software", "email campaign management"],
    "SOCIAL_MEDIA": ["social media management", "social media scheduler", "social publishing platform"],
    "TIME_TRACKING": ["time tracking application", "timesheet management", "time tracker software"],
    "PAYROLL": ["payroll management", "payroll software", "salary management"],
    "DOCUMENT_MANAGEMENT": ["document management system", "document workflow", "document archive management"],
}


def search_catalogue(spark: SparkSession, as_of: str) -> DataFrame:
    """(category, term, query_text): each phrase, asked for in projects active within a year of `as_of`."""
    rows = spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(SEARCH_TERMS.items())], "ordinal int, category string, terms array<string>")
    since = F.date_format(F.date_sub(F.lit(as_of).cast("date"), 365), "yyyy-MM-dd")
    query = F.format_string('"%s" in:name,description,readme archived:false fork:false stars:>=5 pushed:>=%s', F.col("term"), since)
    return rows.select("ordinal", "category", F.explode("terms").alias("term")).withColumn("query_text", query)


def repository_records(spark: SparkSession, path: str) -> DataFrame:
    """Landed repository responses, one JSON record a line; broken ones keep their text in `_corrupt`."""
    return spark.read.schema(f"{REPOSITORY_SCHEMA}, _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def search_hits(pages: DataFrame) -> DataFrame:
    """One row a hit of landed search answers (category, query_text, response)."""
    parsed = pages.withColumn("r", F.from_json("response", SEARCH_SCHEMA))
    return parsed.select("category", "query_text", F.explode("r.items").alias("item")).select("category", "query_text", "item.*", F.to_json("item").alias("raw"))


def readme_texts(rows: DataFrame) -> DataFrame:
    """(repository_id, readme_text, readme_sha) of landed README answers (repository_id, response)."""
    parsed = rows.withColumn("r", F.from_json("response", README_SCHEMA))
    return parsed.select("repository_id", F.when(F.lower("r.encoding") == "base64", rules.decoded_readme(F.col("r.content"))).alias("readme_text"), F.col("r.sha").alias("readme_sha"))


def mapped_metadata(records: DataFrame, now: Column) -> DataFrame:
    """Repository records as flat metadata rows; strict dates: a bad created or updated time fails the job."""
    created, updated, pushed = (F.to_timestamp(c) for c in ("created_at", "updated_at", "pushed_at"))
    return records.select(
        F.col("id").alias("github_id"), "node_id", F.col("owner.login").alias("owner_login"), F.col("owner.avatar_url").alias("owner_avatar"), "name", "full_name",
        F.col("html_url").alias("canonical_url"), "description", F.nullif("homepage", F.lit("")).alias("homepage"), F.col("stargazers_count").alias("stars"),
        F.col("forks_count").alias("forks"), F.col("watchers_count").alias("watchers"), F.col("open_issues_count").alias("open_issues"), F.col("subscribers_count").alias("subscribers"),
        F.col("language").alias("primary_language"), F.coalesce("topics", F.array().cast("array<string>")).alias("topics"), "size", "default_branch",
        created.alias("created_at"), updated.alias("updated_at"), pushed.alias("pushed_at"), "archived", "disabled", "fork", "visibility",
        F.col("license.spdx_id").alias("license_spdx"), F.col("license.name").alias("license_name"), F.col("license.url").alias("license_url"),
        rules.age_in_days(pushed, now).alias("days_since_last_push"), rules.age_in_days(created, now).alias("repository_age_days"),
    )


def repository_files(files: DataFrame, most: int = 8000) -> DataFrame:
    """(repository_id, path, size, depth, file_rank) of the wanted files of each repository, the first `most` by depth and path.

    The cut is the feature of the inspection. It is made in parts of each repository first, so that no
    task sorts all files of a large one, and contents don't take part.
    """
    from ..operators.keyed import top_per_key

    rows = files.where(wanted_path(F.col("path"))).select("repository_id", "path", "size", F.size(F.split("path", "/")).alias("depth"))
    order = [F.col("depth"), F.col("path")]
    parts = top_per_key(rows.withColumn("part", F.pmod(F.xxhash64("path"), F.lit(64))), ["repository_id", "part"], order, most, "part_rank")
    return top_per_key(parts.drop("part", "part_rank"), ["repository_id"], order, most, "file_rank")


# Signs that a landed tree writes otherwise, as Spark hides files whose names begin with a dot or an underscore.
ESCAPED = {"%2E": ".", "%5F": "_", "%25": "%"}
# Fixed value: how the names of empty files end, which have a byte, as Spark passes over files of none.
EMPTY = "%00"


def landed_trees(spark: SparkSession, path: str, names: str = "*") -> DataFrame:
    """(repository_id, path, size) of the files below `path`/repository_id=<id>/ whose names the glob `names` takes; contents aren't read.

    What stands behind the folder of the repository is the path in its tree. A dot or underscore at the
    beginning of a name is landed as %2E or %5F, a percent sign as %25, and an empty file as one byte
    under its name and %00.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names).load(path)
    return _places(files).select("repository_id", "path", F.when(F.col("empty"), 0).otherwise(F.col("length")).alias("size"))


def landed_contents(spark: SparkSession, path: str, names: str, most_bytes: int) -> DataFrame:
    """(repository_id, path, content) of such files; none of more than `most_bytes` is read, and bytes that aren't UTF-8 become replacement marks."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names).load(path)
    files = files.where(F.col("length") <= most_bytes)  # pushed to the source, which looks at it before it reads
    return _places(files).select("repository_id", "path", F.when(F.col("empty"), "").otherwise(F.make_valid_utf8(F.col("content").cast("string"))).alias("content"))


def _places(files: DataFrame) -> DataFrame:
    parts = r"/repository_id=(\d+)/(.*)$"
    inner = F.regexp_replace(F.regexp_extract("path", parts, 2), EMPTY + "$", "")
    for written, sign in ESCAPED.items():
        inner = F.replace(inner, F.lit(written), F.lit(sign))
    found = files.where(F.col("path").rlike(parts)).withColumn("empty", F.col("path").endswith(EMPTY))
    return found.withColumn("repository_id", F.regexp_extract("path", parts, 1).cast("long")).withColumn("path", inner)


def landed_repository_files(spark: SparkSession, path: str, read_names: str, most_bytes: int) -> DataFrame:
    """(repository_id, path, size, content) of landed trees, as the table of repository files has them; contents of some files by name and size, null for the others."""
    return landed_trees(spark, path).join(landed_contents(spark, path, read_names, most_bytes), ["repository_id", "path"], "left")


def selected_tree(tree: DataFrame) -> DataFrame:
    """(repository_id, path, size, position, with_content) of landed trees: safe paths that an inspection lists, the first of each in tree order, and which of them it reads, those least deep first."""
    from ..functions import static
    from ..operators.keyed import top_per_key

    listed = top_per_key(tree.where(static.listed_path(F.col("path"))), ["repository_id"], [F.col("position")], static.MOST_LISTED, "_place").drop("_place")
    order = [F.desc("_wanted"), F.size(F.split("path", "/")), F.collate("path", "UNICODE"), F.col("position")]
    ranked = listed.withColumn("_wanted", static.read_path(F.col("path"))).withColumn("_place", F.row_number().over(Window.partitionBy("repository_id").orderBy(*order)))  # rows are bounded by the cut above
    return ranked.withColumn("with_content", F.col("_wanted") & (F.col("_place") <= static.MOST_READ)).drop("_wanted", "_place")


class Messages(HTMLParser):
    """Collects the elements of one page that carry a message, each with what stands inside."""

    SINGLE = frozenset("area base br col embed hr img input link meta param source track wbr".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, dict | None, bool]] = []
        self.found: list[dict] = []

    def holders(self) -> list[dict]:
        return [m for _, m, _ in self.open if m]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in attrs}
        classes, raw = set(a.get("class", "").split()), self.get_starttag_text() or ""
        holders = self.holders()
        for m in holders:
            m["raw"].append(raw)
            if m["depth"]:
                m["html"].append(raw)
                if tag == "a" and a.get("href"):
                    m["anchors"].append(a["href"])
            inside_edit = any("tgme_widget_message_edited" in c for c in m["classes"])
            if tag == "time" and "datetime" in a:
                if inside_edit or "edited" in classes:
                    m["edited"] = m["edited"] or a["datetime"]
                m["published"] = m["published"] or ("" if inside_edit or "edited" in classes else a["datetime"])
            if "data-edited" in a:
                m["edited"] = m["edited"] or a.get("datetime") or a["data-edited"]
        own = None
        if "data-post" in a:
            own = {"post": a["data-post"], "raw": [raw], "html": [], "text": [], "anchors": [], "published": "", "edited": "", "views": [], "data_views": a.get("data-views", ""), "depth": 0, "done": False, "seen_views": False, "in_views": 0, "classes": []}
            self.found.append(own)
        if tag not in self.SINGLE:
            for m in [*holders, *([own] if own else [])]:
                m["classes"].append(classes)
                if m["depth"]:
                    m["depth"] += 1
                elif not m["done"] and classes & {"js-message_text", "tgme_widget_message_text"}:
                    m["depth"] = 1
                if m["in_views"]:
                    m["in_views"] += 1
                elif not m["seen_views"] and m is not own and (classes & {"tgme_widget_message_views"} or "data-views" in a):
                    m["in_views"], m["seen_views"] = 1, True
            self.open.append((tag, own, True))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in self.SINGLE:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if at is None:
            return
        while len(self.open) > at:
            name, own, _ = self.open.pop()
            for m in [*self.holders(), *([own] if own else [])]:
                m["raw"].append(f"</{name}>")
                m["classes"] = m["classes"][:-1]
                if m["depth"]:
                    m["depth"] -= 1
                    if m["depth"]:
                        m["html"].append(f"</{name}>")
                    else:
                        m["done"] = True
                if m["in_views"]:
                    m["in_views"] -= 1

    def handle_data(self, data: str) -> None:
        for m in self.holders():
            m["raw"].append(data)
            if m["depth"]:
                m["text"].append(data)
                m["html"].append(data)
            if m["in_views"]:
                m["views"].append(data)


#: Letters of pages after which their messages are passed on.
PARSED_CHARS = 1 << 20


def page_messages(pages: DataFrame) -> DataFrame:
    """(page_url, MESSAGE_SCHEMA) of the messages of each page (page_url, channel, html): own channel, numeric id, the first of an id; with the page's crawled_at, if it has one."""
    timed = "crawled_at" in pages.columns

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["page_url", "channel", "message_id", "position", "text", "html", "anchors", "published", "edited", "views_text", "raw_source", *(["crawled_at"] if timed else [])]
        for batch in batches:
            out, held = [], 0
            for url, channel, html, *when in zip(*(batch[c] for c in batch.columns), strict=True):
                parser, seen = Messages(), set()
                parser.feed(html or "")
                parser.close()
                held += len(html or "")
                for position, m in enumerate(parser.found):
                    owner, slash, number = m["post"].rpartition("/")
                    if not slash or not owner or owner.lower() != (channel or "").lower() or not (number.isascii() and number.isdigit()) or len(number) > 18 or number in seen:
                        continue
                    seen.add(number)
                    has_text = m["done"] or m["depth"]
                    text = "".join(m["text"]).replace("\xa0", " ").strip() if has_text else None
                    out.append((url, channel, int(number), position, text, "".join(m["html"]) if has_text else None, m["anchors"], m["published"] or None, m["edited"] or None, "".join(m["views"]).strip() or m["data_views"] or None, "".join(m["raw"]), *when))
                if held > PARSED_CHARS:  # a batch of pages isn't held with all that is read of it
                    yield pd.DataFrame(out, columns=names)
                    out, held = [], 0
            yield pd.DataFrame(out, columns=names)

    time = ["crawled_at"] if timed else []
    return pages.select("page_url", "channel", "html", *time).mapInPandas(read, f"page_url string, {MESSAGE_SCHEMA}{', crawled_at timestamp' if timed else ''}")


def typed_messages(raw: DataFrame) -> DataFrame:
    """Message rows with link arrays, dates and views as columns."""
    links = urls.link_arrays(F.col("anchors"), F.col("text"), F.col("page_url"))
    return raw.withColumn("links", links).select(
        "page_url", "channel", "message_id", "position", urls.parse_date(F.col("published")).alias("published_at"), urls.parse_date(F.col("edited")).alias("edited_at"),
        "text", "html", "links.external_links", "links.repository_links", urls.parse_views(F.col("views_text")).alias("views"), "raw_source", *(["crawled_at"] if "crawled_at" in raw.columns else []),
    )
