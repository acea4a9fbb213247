"""A view of projects over the tables `documents` and `labels`, in SQL that Spark and DuckDB both read.

Ids, texts and sources are the tables' own; what they lack (licences, dates, phrases of product pages)
is derived from the id, so that every rule has rows to decide on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def choose(by: int, values: list[str | None]) -> str:
    """A CASE over doc_id modulo `by`."""
    cases = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'") for i, v in enumerate(values))
    return f"CASE doc_id % {by} {cases} ELSE NULL END"


NAMES = ["crm-suite", "booking.hub", "awesome-list", "invoice_kit", "ops-cli", "shop", "forum-starter", "ml-library"]
DESCRIPTIONS = [
    "A self-hosted CRM for small teams with a sales pipeline", "Online booking and appointment scheduling", "A curated list of tools", "Invoicing and accounting web app",
    "A command line helper", "Ecommerce platform with shopping cart and inventory management", "Starter kit for project management and time tracking", None,
    "Help desk with support tickets and live chat", "A python package for data analytics", "Learning management system and online courses", "Real estate and property management dashboard",
    "Form builder and survey platform for the client portal", "Restaurant ordering, table reservation and hotel management", "Email marketing and newsletter platform", "A framework",
    "Employee management and applicant tracking, human resources", "Payroll and expense tracking, recurring billing",
]
SNIPPETS = [
    "Live demo and screenshots. docker-compose up. Installation: getting started with postgres. Login and dashboard, web application, frontend and backend, self-hosted.",
    "Installation by docker. Authentication with oauth. A ready to use web app.", "See the list below.", "Quick start: npm install. Business use: invoice, billing system. Theme and plugin support.",
    "Self hosted, production ready, database mysql, admin panel, sign in. Customizable, white label.", "", "Deploy with docker compose. CRM, crm and CRM again, crm. Mobile app.", "An sdk for developers. Client library.",
    "preview.png shows the admin ui. Project management, kanban board, task management.",
]
LICENCES = ["MIT", "Apache-2.0", "GPL-3.0", None, "BUSL-1.1", "ISC", "mpl-2.0", "NOASSERTION", "LicenseRef-x", "BSD-3-Clause", "CC-BY-NC-4.0"]
CATEGORY_LIST = ["CRM", "BOOKING", "HRM", "INVOICING", "HELPDESK", "EMAIL_MARKETING", "POS", "PROJECT_MANAGEMENT", "REAL_ESTATE", "HOTEL", "LMS", "SURVEY", "CMS", "DASHBOARD", "AI_AGENT", "SECURITY", "TIME_TRACKING", "PODCASTS", "EXPENSES", "ECOMMERCE"]

COLUMNS = {
    "repository_id": "doc_id",
    "owner": "source",
    "name": f"concat({choose(8, NAMES)}, '-', CAST(doc_id AS STRING))",
    "description": choose(18, DESCRIPTIONS),
    "topics": choose(5, ["web app", "crm dashboard", None, "analytics cms", "cli tools"]),
    "homepage": "CASE WHEN doc_id % 3 = 0 THEN concat('https://example.com/', CAST(doc_id AS STRING)) WHEN doc_id % 3 = 1 THEN '' ELSE NULL END",
    "readme": f"CASE WHEN doc_id % 19 = 0 THEN NULL ELSE concat(coalesce(text, ''), ' ', {choose(9, SNIPPETS)}) END",
    "stars": "CASE WHEN doc_id % 23 = 0 THEN NULL ELSE CAST((doc_id * 37) % 2500 AS INT) END",
    "days": "CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CAST((doc_id * 13) % 500 AS INT) END",
    "archived": "CASE WHEN doc_id % 17 = 0 THEN NULL ELSE doc_id % 13 = 0 END",
    "disabled": "CASE WHEN doc_id % 31 = 0 THEN NULL ELSE doc_id % 29 = 0 END",
    "spdx": choose(11, LICENCES),
    "status": choose(6, ["ENRICHED", "ENRICHED", "ENRICHED", "UNAVAILABLE", "PENDING", "FAILED"]),
    "category": choose(20, CATEGORY_LIST),
    "bundle": "CAST((doc_id * 31) % 101 AS INT)",
    "usefulness": "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST((doc_id * 7) % 101 AS INT) END",
    "deployment": "CASE WHEN doc_id % 4 IN (0, 1) THEN NULL ELSE CAST((doc_id * 11) % 101 AS INT) END",
    "customization": "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST((doc_id * 17) % 101 AS INT) END",
    "visual": "CASE WHEN doc_id % 4 IN (0, 2) THEN NULL ELSE CAST((doc_id * 19) % 101 AS INT) END",
    "client_use": "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST((doc_id * 23) % 101 AS INT) END",
    "clarity": "CASE WHEN doc_id % 4 IN (0, 3) THEN NULL ELSE CAST((doc_id * 29) % 101 AS INT) END",
    "is_complete": "coalesce(quality, 0) = 1 AND doc_id % 2 = 0",
    "quality": "quality",
    "toxic": "toxic",
    "text": "text",
    "n_chars": "n_chars",
}
SQL = "WITH repo AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in COLUMNS.items()) + " FROM documents LEFT JOIN labels USING (doc_id))"


def repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return documents.join(labels, "doc_id", "left").selectExpr(*[f"{e} AS {c}" for c, e in COLUMNS.items()])


def topics_array(df: DataFrame) -> DataFrame:
    return df.withColumn("topic_list", F.when(F.col("topics").isNull(), F.array().cast("array<string>")).otherwise(F.split("topics", " ")))
