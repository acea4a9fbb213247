"""Columns for licences, screening, product kinds, business categories and composite scores.

Patterns are in lower case and hold for any. Word bounds are written \\b here and turned into look-arounds
over ASCII letters, digits and the underscore for Spark (`java`), as its own \\b would also take letters
beyond ASCII for words.
"""

from __future__ import annotations

import re
from functools import cache, reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .literal_index import Indexed, LiteralIndex, quoted

# Licence ids and markers by class.
PERMISSIVE = ["MIT", "APACHE-2.0", "BSD-2-CLAUSE", "BSD-3-CLAUSE", "ISC", "0BSD"]
RESTRICTED = ["BUSL", "SSPL", "ELASTIC-2.0", "COMMONS-CLAUSE", "POLYFORM", "LICENSE-REF", "PROPRIETARY", "CC-BY-NC"]
LICENCE_TEXTS = [
    (r"apache license\s*(?:version )?2\.0|apache-2\.0", "Apache-2.0"),
    (r"mit license|permission is hereby granted, free of charge", "MIT"),
    (r"gnu (?:general public license|affero general public license)|\b(?:a?gpl)[ -]?[23]", "GPL"),
    (r"mozilla public license|mpl-2\.0", "MPL-2.0"),
    (r"bsd [23]-clause|redistribution and use in source and binary", "BSD"),
    (r"isc license", "ISC"),
]
LICENCE_IDS = [("apache", "Apache-2.0"), (r"\bmit\b", "MIT"), ("gpl|agpl|lgpl", "GPL"), ("mozilla|mpl", "MPL-2.0"), ("bsd", "BSD"), ("isc", "ISC")]

# Product signals (field, pattern, points, reason, counts as an application signal).
BUSINESS_USE = r"\b(?:crm|erp|booking|ecommerce|project management|analytics|cms|helpdesk|invoic|knowledge base|automation|collaboration)\b"
PICTURE = r"!\[[^\]]*\]\([^)]*\)|screenshots?"
SIGNALS = [
    ("readme", PICTURE + r"|preview\.png|demo\.gif", 10, "screenshots or visual demo", True),
    ("everything", r"live demo|demo at|try it online", 8, "live demo", True),
    ("readme", r"docker-compose|compose\.ya?ml", 12, "docker compose setup", True),
    ("readme", "docker", 5, "docker setup", False),
    ("readme", "installation|getting started|quick start|how to install", 8, "installation documentation", False),
    ("everything", "self-hosted|self hosted", 15, "self-hosted product", True),
    ("everything", "login|authentication|oauth|sign in", 9, "authentication", True),
    ("everything", "dashboard|admin panel|admin ui", 10, "dashboard or admin UI", True),
    ("everything", "database|postgres|mysql|sqlite|mongodb", 7, "database integration", True),
    ("everything", r"web application|web app|frontend|react app|next\.js app|mobile app", 10, "application frontend", True),
    ("everything", BUSINESS_USE, 13, "business use case", True),
]
# What speaks for a template.
PREVIEW = PICTURE + "|preview|live demo"
SETUP = "docker-compose|installation|getting started|quick start"
CUSTOMISING = "theme|customiz|plugin|extension|self-hosted|white label"
# Kinds by the first pattern that matches.
KINDS = [
    ("AWESOME_LIST", "title", r"awesome[- ]|curated list"),
    ("BOOK", "identity", r"free programming books|\bbook\b|reading list"),
    ("COURSE", "identity", r"\bcourse\b|curriculum|bootcamp"),
    ("TUTORIAL", "identity", r"tutorial|walkthrough|step-by-step|roadmap|\b\d+ days\b|教程|科普|学习|从零构建"),
    ("ALGORITHM_COLLECTION", "identity", "algorithms?|leetcode|competitive programming"),
    ("RESOURCE_COLLECTION", "identity", "resources?|cheatsheet|interview questions|prompts collection|api collection|workflow collection|all of (?:the )?workflows"),
    ("CONFIG", "title", r"dotfiles|\.config|configuration files|\bconfigs?\b|\bprompt\b"),
    ("BOILERPLATE", "identity", "boilerplate"),
    ("STARTER", "identity", "starter(?: kit| template)?|scaffold"),
    ("FRAMEWORK", "identity", r"\bframework\b"),
    ("LIBRARY", "identity", r"\b(?:sdk|library|package for|npm package|python package)\b"),
    ("CLI_TOOL", "identity", r"\b(?:cli|command line|terminal ui)\b"),
    ("DEV_TOOL", "title", r"linter|formatter|debugger|ide|developer tool|devtool|toolkit|\btools?\b|\bskills?\b|workflow orchestrator|application proxy|reverse proxy|code graph|code intelligence|vulnerability scanner|penetration testing|\bmcp\b|\bplugin\b|helper scripts|infrastructure-as-code|\bapi client\b|\bapi gateway\b"),
    ("UNKNOWN", "identity", r"\b(?:research|paper|benchmark|dataset|model training|research summary)\b|研究总结"),
]
EXCLUDED_KINDS = ["AWESOME_LIST", "BOOK", "COURSE", "TUTORIAL", "ALGORITHM_COLLECTION", "RESOURCE_COLLECTION", "CONFIG"]
KIND_PRIORITY = {"APPLICATION": 0, "STARTER": 1, "BOILERPLATE": 2, "UNKNOWN": 3, "DEV_TOOL": 4, "CLI_TOOL": 5, "LIBRARY": 6, "FRAMEWORK": 6}
REVIEW_LIBRARY = "self-hosted|web app|desktop app|dashboard|complete product|ready to use"

# Business categories, in order, and the phrases that speak for each.
CATEGORIES: dict[str, list[str]] = {
    "CRM": [r"\bcrm\b", "customer relationship", "customer management"],
    "SALES": ["sales pipeline", "sales management", "sales team", "deal tracking"],
    "LEAD_MANAGEMENT": ["lead management", "lead tracking", "manage(?:ment)? of leads", "sales leads?"],
    "BOOKING": [r"\bbooking(?:s)?\b", "reservation system", "online reservation", "reservation management"],
    "APPOINTMENTS": [r"\bappointments?\b", "appointment schedul", "appointment management", "book appointments?"],
    "CALENDAR_BUSINESS": ["business calendar", "team schedul", "availability slots?", "calendar schedul"],
    "HR": ["human resources", "employee management", "workforce management", "people management"],
    "HRM": [r"\bhrm(?:s)?\b", "human resource management"],
    "ATS": ["applicant tracking", "recruit(?:ment|ing) system", "hiring platform", "job candidates?"],
    "INVOICING": [r"\binvoic(?:e|es|ing)\b", "billing system", "billing platform"],
    "ACCOUNTING": [r"\baccounting\b", "bookkeeping", "general ledger"],
    "EXPENSES": ["expense management", "expense tracking", "reimbursements?"],
    "PAYROLL": [r"\bpayroll\b", "salary management"],
    "POS": ["point[ -]of[ -]sale", r"\bpos system\b", "retail checkout"],
    "ECOMMERCE": ["e[ -]?commerce", "online store", "shopping cart", "web shop"],
    "INVENTORY": ["inventory management", "stock management", "warehouse management"],
    "ERP": [r"\berp\b", "enterprise resource planning", "business management suite"],
    "CUSTOMER_SUPPORT": ["customer support", "support platform", "customer service", "support team"],
    "HELPDESK": ["help[ -]?desk", "ticketing system", "support tickets?"],
    "LIVE_CHAT": ["live chat", "customer chat", "website chat widget"],
    "MARKETING": ["marketing platform", "marketing automation", "campaign management", "marketing campaigns?"],
    "EMAIL_MARKETING": ["email marketing", "newsletter platform", "email campaigns?", "mailing list"],
    "SOCIAL_MEDIA": ["social media management", "social scheduling", "social publishing"],
    "PROPERTY_MANAGEMENT": ["property management", "tenant management", "rental propert"],
    "REAL_ESTATE": ["real estate", "realtor", "property listings?"],
    "RESTAURANT": ["restaurant management", "restaurant ordering", "food ordering", "table reservation"],
    "HOTEL": ["hotel management", "hospitality management", "room booking"],
    "LMS": ["learning management system", r"\blms\b", "online learning platform"],
    "COURSE_PLATFORM": ["course platform", "course management", "online courses?", "e[ -]?learning platform"],
    "FORM_BUILDER": ["form builder", "forms platform", "create.*forms"],
    "SURVEY": ["survey builder", "survey platform", "questionnaire"],
    "PROJECT_MANAGEMENT": ["project management", "task management", "kanban board", "issue tracking", "team projects?"],
    "TIME_TRACKING": ["time track(?:er|ing)", "timesheets?", "work hours"],
    "DOCUMENT_MANAGEMENT": ["document management", "document workflow", "manage documents"],
    "CLIENT_PORTAL": ["client portal", "customer portal", "member portal"],
    "SUBSCRIPTION_MANAGEMENT": ["subscription management", "recurring billing", "manage subscriptions"],
    "CMS": ["content management system", "headless cms", r"\bcms\b"],
    "ANALYTICS": ["analytics platform", "web analytics", "business intelligence", "data analytics"],
    "DASHBOARD": ["admin dashboard", "business dashboard", "analytics dashboard"],
}
# What speaks for and against an application that stands alone, and targets of gaps.
STANDALONE = ["self[ -]?hosted", "docker[ -]?compose", "docker compose", "installation", "getting started", "deploy(?:ment)?", "live demo", "screenshots?", "authentication", "sign[ -]?in", "dashboard", "web application", "frontend.{0,30}backend", "database", "production"]
NEGATIVE = ["curated list", "awesome list", "collection of (?:links|resources|libraries)", "tutorial collection", "sdk for", "client library", "component library", "icon (?:set|collection)", "interview questions"]
DEVELOPER_ONLY = r"\b(?:llm|agents?|claude|inference|model weights?|sdk|client library|framework|database|protocol|kernel|runtime|developer tool)\b"
GAP_TARGETS = [
    (["CRM", "SALES", "LEAD_MANAGEMENT"], 10),
    (["BOOKING", "APPOINTMENTS", "CALENDAR_BUSINESS"], 10),
    (["HR", "HRM", "ATS"], 10),
    (["INVOICING", "FINANCE", "ACCOUNTING", "EXPENSES", "PAYROLL"], 10),
    (["CUSTOMER_SUPPORT", "HELPDESK", "LIVE_CHAT"], 10),
    (["MARKETING", "EMAIL_MARKETING", "SOCIAL_MEDIA"], 10),
    (["ECOMMERCE", "POS", "INVENTORY"], 10),
    (["PROJECT_MANAGEMENT", "TIME_TRACKING"], 10),
    (["PROPERTY_MANAGEMENT", "REAL_ESTATE"], 5),
    (["RESTAURANT", "HOTEL"], 5),
    (["LMS", "COURSE_PLATFORM"], 5),
    (["CLIENT_PORTAL", "FORM_BUILDER", "SURVEY"], 5),
]
# Groups of the shortlist with their categories, floor and ceiling.
GROUPS = {
    "CRM_SALES": (["CRM", "SALES", "LEAD_MANAGEMENT"], 10, 15),
    "BOOKING": (["BOOKING", "APPOINTMENTS", "CALENDAR_BUSINESS"], 8, 12),
    "HR_ATS": (["HR", "HRM", "ATS"], 6, 10),
    "FINANCE": (["INVOICING", "ACCOUNTING", "FINANCE", "EXPENSES", "PAYROLL"], 8, 12),
    "ERP_INVENTORY_POS": (["ERP", "INVENTORY", "POS"], 10, 15),
    "ECOMMERCE": (["ECOMMERCE"], 5, 10),
    "CUSTOMER_SUPPORT": (["CUSTOMER_SUPPORT", "HELPDESK", "LIVE_CHAT"], 5, 8),
    "PROJECT_MANAGEMENT": (["PROJECT_MANAGEMENT"], 8, 12),
    "PROPERTY_REAL_ESTATE": (["PROPERTY_MANAGEMENT", "REAL_ESTATE"], 4, 7),
    "LMS": (["LMS", "COURSE_PLATFORM"], 4, 7),
    "CMS": (["CMS"], 5, 8),
    "ANALYTICS_DASHBOARD": (["ANALYTICS", "DASHBOARD"], 8, 12),
    "AUTOMATION": (["AUTOMATION"], 8, 12),
    "AI": (["AI", "AI_ASSISTANT", "AI_AGENT"], 8, 12),
    "PRODUCTIVITY": (["PRODUCTIVITY", "FILE_MANAGEMENT", "DOCUMENT_MANAGEMENT", "TIME_TRACKING"], 8, 12),
    "CONTENT_MEDIA": (["CONTENT", "SOCIAL_MEDIA", "COMMUNICATION"], 5, 10),
    "DEVELOPER_PRODUCT": (["DEVELOPER_PRODUCT", "SECURITY"], 0, 20),
}
# Categories of the first model mapped to those of the second; others become OTHER.
SAME_CATEGORY = [
    "CRM", "SALES", "BOOKING", "HR", "ATS", "INVOICING", "ACCOUNTING", "FINANCE", "PAYROLL", "ERP", "POS", "INVENTORY", "ECOMMERCE",
    "CUSTOMER_SUPPORT", "PROJECT_MANAGEMENT", "PROPERTY_MANAGEMENT", "REAL_ESTATE", "RESTAURANT", "HOTEL", "LMS", "CLIENT_PORTAL", "MARKETING",
    "EMAIL_MARKETING", "SOCIAL_MEDIA", "TIME_TRACKING", "DOCUMENT_MANAGEMENT", "CMS", "ANALYTICS", "DASHBOARD", "AUTOMATION", "PRODUCTIVITY",
]
OTHER_CATEGORY = {"LEAD_MANAGEMENT": "SALES", "APPOINTMENTS": "BOOKING", "CALENDAR_BUSINESS": "BOOKING", "HRM": "HR", "EXPENSES": "FINANCE", "HELPDESK": "CUSTOMER_SUPPORT", "LIVE_CHAT": "CUSTOMER_SUPPORT", "COURSE_PLATFORM": "LMS", "FORM_BUILDER": "FORMS", "SURVEY": "SURVEYS"}
SCORE_WEIGHTS = {"business_usefulness_score": 0.12, "ease_of_deployment_score": 0.08, "ease_of_customization_score": 0.08, "visual_value_score": 0.07, "client_project_potential_score": 0.08, "end_user_clarity_score": 0.05}
STOP_WORDS = ["open", "source", "self", "hosted", "application", "system", "platform", "ready", "management", "готовая", "система", "управления"]


def java(pattern: str, either_case: bool = True) -> str:
    """A pattern for Spark: a word bound is a place where ASCII word characters begin or end.

    A bound at the beginning of an alternative stands before a word character, any other after one.
    """
    word = "[A-Za-z0-9_]"
    plain = re.sub(r"(^|[|(:])\\b", rf"\1(?<!{word})", pattern).replace(r"\b", f"(?!{word})")
    return ("(?i)" if either_case else "") + plain


@cache
def alternatives(pattern: str) -> list[str]:
    """The parts between the bars that stand outside groups and classes."""
    out, depth, in_class, escaped = [""], 0, False, False
    for c in pattern:
        if not escaped and not in_class:
            depth += (c == "(") - (c == ")")
            if c == "|" and not depth:
                out.append("")
                continue
        if not escaped:
            in_class = c == "[" or in_class and c != "]"
        escaped = c == "\\" and not escaped
        out[-1] += c
    return out


def pieces_of(part: str) -> list[tuple[str, str]]:
    """(piece, repeat) of one alternative: characters, escapes, classes and groups, each with what repeats it."""
    return re.findall(r"(\\.|\[(?:\\.|[^\]])*\]|\((?:\?[:!=<]+)?(?:\\.|\[(?:\\.|[^\]])*\]|\([^()]*\)|[^()\[\\])*\)|[^\\\[(])([?*+]|\{\d*,?\d*\})?", part)


@cache
def needed(part: str) -> list[str]:
    """Texts of which an alternative needs at least one; none if it isn't known."""
    runs, groups, run = [], [], ""
    for piece, repeat in pieces_of(part):
        letter = piece[1:] if re.fullmatch(r"\\[^A-Za-z0-9]", piece) else piece if len(piece) == 1 and piece not in ".^$" else ""
        if letter and not repeat:
            run += letter
            continue
        runs.append(run + (letter if repeat == "+" else ""))
        run = ""
        if piece.startswith("(?:") and not repeat:
            inner = [needed(x) for x in alternatives(piece[3:-1])]
            groups += [[x for xs in inner for x in xs]] if all(inner) else []
    best = max([*runs, run], key=len)
    return [best] if len(best) > 2 or best and not groups else max(groups, key=lambda g: min(map(len, g)), default=[])


def lowered(text: Column) -> Column:
    """Lower case as patterns without regard to case see it: the long s is an s."""
    return F.replace(F.lower(text), F.lit("\u017f"), F.lit("s"))


def literal_index(patterns: list[str]) -> LiteralIndex:
    """An index of the texts of which the patterns need some."""
    return LiteralIndex([x for p in patterns for part in alternatives(p) for x in needed(part)])


def plain_text(part: str) -> bool:
    """Whether an alternative of a pattern is a text without signs."""
    return len(needed(part)) == 1 and re.sub(r"\\([^A-Za-z0-9])", r"\1", part) == needed(part)[0]


def has(text: Column | Indexed, pattern: str, low: bool = False) -> Column:
    """Whether the text has the pattern, in any letter case; `low` says that the text is in lower case already, as an indexed one is.

    Alternatives of plain text are looked up as such, and a pattern is tried only where a text that it
    needs is there.
    """
    if isinstance(text, Indexed):
        return F.expr(indexed_has(text, pattern))
    text = text if low else lowered(text)
    found = []
    for part in alternatives(pattern):
        if plain_text(part):
            found.append(text.contains(needed(part)[0]))
        elif texts := needed(part):
            found.append(reduce(or_, [text.contains(x) for x in texts]) & text.rlike(java(part, False)))
        else:
            found.append(text.rlike(java(part, False)))
    return F.coalesce(reduce(or_, found), F.lit(False))


def indexed_has(text: Indexed, pattern: str) -> str:
    """The same for an indexed text, as SQL."""
    found = []
    for part in alternatives(pattern):
        some = " OR ".join(text.has(x) for x in needed(part))
        found.append(text.contains(needed(part)[0]) if plain_text(part) else f"(({some}) AND {text.rlike(java(part, False))})" if some else text.rlike(java(part, False)))
    return f"coalesce({' OR '.join(found)}, false)"


def total(columns: list[Column]) -> Column:
    return reduce(add, columns)


def points(condition: Column, n: int) -> Column:
    return F.when(condition, n).otherwise(0)


def half_up(x: Column) -> Column:
    return F.floor(x + 0.5).cast("int")


def clamp(x: Column) -> Column:
    return F.least(F.lit(100), F.greatest(F.lit(0), half_up(x)))


def licence_class(spdx: Column) -> Column:
    """struct(category, review_required, bundle_candidate) of a licence id."""
    id_ = F.upper(F.trim(spdx))
    category = F.when(F.coalesce(id_, F.lit("")).isin("", "NOASSERTION"), "NO_LICENSE").when(id_.isin(PERMISSIVE), "PERMISSIVE")
    category = category.when(id_.rlike(r"^(?:AGPL|GPL|LGPL)-|^MPL-"), "COPYLEFT")
    category = category.when(reduce(lambda a, b: a | b, [id_.contains(m) for m in RESTRICTED]), "RESTRICTED").otherwise("UNKNOWN")
    return F.struct(category.alias("category"), category.isin("NO_LICENSE", "COPYLEFT", "UNKNOWN").alias("review_required"), (category == "PERMISSIVE").alias("bundle_candidate"))


def first_label(text: Column, rules: list[tuple[str, str]], low: bool = False) -> Column:
    found = F.lit(None).cast("string")
    for pattern, label in reversed(rules):
        found = F.when(has(text, pattern, low), label).otherwise(found)
    return found


def licence_in_text(text: Column, low: bool = False) -> Column:
    return first_label(text, LICENCE_TEXTS, low)


def licence_family(id_: Column) -> Column:
    """The family of a licence id; an unknown id in upper case, none for none."""
    return F.when(F.coalesce(id_, F.lit("")) != "", F.coalesce(first_label(id_, LICENCE_IDS), F.upper(id_)))


def licence_matches(detected: Column, stated: Column) -> Column:
    return F.when(detected.isNotNull() & stated.isNotNull(), detected == stated)


def metadata_gate(status: Column, archived: Column, disabled: Column, licence: Column, days_since_push: Column) -> Column:
    out = (status == "UNAVAILABLE") | F.coalesce(archived, F.lit(False)) | F.coalesce(disabled, F.lit(False)) | (licence == "RESTRICTED")
    good = (status == "ENRICHED") & (licence == "PERMISSIVE") & (days_since_push <= 365)
    return F.when(F.coalesce(out, F.lit(False)), "EXCLUDED").when(F.coalesce(good, F.lit(False)), "CANDIDATE").otherwise("REVIEW")


def active_permissive(licence: Column, archived: Column, disabled: Column, days_since_push: Column, *more: Column) -> Column:
    """Permissive, neither archived nor disabled (unknown doesn't count as no), pushed within a year, and `more`."""
    every = [licence == "PERMISSIVE", ~archived, ~disabled, days_since_push <= 365, *more]
    return F.coalesce(reduce(lambda a, b: a & b, every), F.lit(False))


def needs_metadata(status: Column, updated: Column, now: Column, refresh_days: int | None = None) -> Column:
    open_ = status.isin("PENDING", "IN_PROGRESS", "FAILED", "RATE_LIMITED")
    if refresh_days is None:
        return updated.isNull() & open_
    return open_ | ((status == "ENRICHED") & (updated.isNull() | (updated < now - F.make_dt_interval(F.lit(refresh_days)))))


def needs_readme(candidate: Column, readme_status: Column, updated: Column, now: Column, stale_days: int | None = 30) -> Column:
    """Candidates without a README, or (unless `stale_days` is None) with an old one."""
    return (candidate == "CANDIDATE") & readme_due(readme_status, updated, now, stale_days)


def readme_due(readme_status: Column, updated: Column, now: Column, stale_days: int | None = 30) -> Column:
    missing = readme_status.isin("PENDING", "FAILED")
    return missing if stale_days is None else missing | ((readme_status == "FETCHED") & (updated < now - F.make_dt_interval(F.lit(stale_days))))


def readme_prefilter(status: Column, licence: Column, archived: Column, disabled: Column, fork: Column, days_since_push: Column, kind: Column) -> Column:
    """What a repository found by search must be, in place of a candidate, for its README to be read."""
    return active_permissive(licence, archived, disabled, days_since_push, status == "ENRICHED", ~fork, kind.isin("APPLICATION", "STARTER", "BOILERPLATE", "UNKNOWN"))


def needs_search(status: Column, refresh: bool = False) -> Column:
    """Whether a search query is asked: not one that is completed, unless all are asked again, nor one in work."""
    return F.coalesce(status, F.lit("PENDING")) != ("PROCESSING" if refresh else "COMPLETED")


def product_fields(name: Column, description: Column, topics: Column, homepage: Column, readme: Column) -> dict[str, Column]:
    """The lower-cased texts that product rules look at."""
    none = F.lit("")
    title = F.concat_ws(" ", F.coalesce(name, none), F.coalesce(description, none))
    identity = F.concat_ws(" ", title, F.array_join(F.coalesce(topics, F.array().cast("array<string>")), " "))
    everything = F.concat_ws(" ", identity, F.coalesce(homepage, none), F.coalesce(readme, none))
    return {k: lowered(v) for k, v in {"title": title, "identity": identity, "readme": F.coalesce(readme, none), "everything": everything}.items()}


def product_patterns() -> list[str]:
    """All patterns that are tried on the fields of a product."""
    return [p for _, p, *_ in SIGNALS] + [p for _, _, p in KINDS] + [PREVIEW, SETUP, CUSTOMISING, BUSINESS_USE]


def product_signals(fields: dict[str, Column | Indexed], homepage: Column, readme: Column) -> Column:
    """struct(score, app_signals, reasons) of the weighted signals."""
    found = [(has(fields[f], p, True), n, reason, app) for f, p, n, reason, app in SIGNALS]
    found.append((F.coalesce(homepage, F.lit("")) != "", 4, "project homepage", False))
    score = points(F.coalesce(readme, F.lit("")) != "", 4) + total([points(c, n) for c, n, _, _ in found])
    apps = total([points(c, 1) for c, _, _, app in found if app])
    return F.struct(score.alias("score"), apps.alias("app_signals"), F.array_compact(F.array(*[F.when(c, reason) for c, _, reason, _ in found])).alias("reasons"))


def product_kind(fields: dict[str, Column | Indexed], score: Column, app_signals: Column) -> Column:
    found = F.when((app_signals >= 3) | ((app_signals >= 2) & (score >= 45)), "APPLICATION").otherwise("UNKNOWN")
    for kind, field, pattern in reversed(KINDS):
        found = F.when(has(fields[field], pattern, True), kind).otherwise(found)
    return found


def kind_penalty(kind: Column) -> Column:
    return F.when(kind.isin(EXCLUDED_KINDS), 45).when(kind.isin("LIBRARY", "FRAMEWORK"), 22).when(kind.isin("CLI_TOOL", "DEV_TOOL"), 12).otherwise(0)


def template_potential(fields: dict[str, Column | Indexed], kind: Column, homepage: Column, days: Column, stars: Column) -> Column:
    stars = F.coalesce(stars, F.lit(0))
    parts = [
        F.when(kind == "APPLICATION", 28).when(kind.isin("BOILERPLATE", "STARTER"), 16).otherwise(0),
        points(has(fields["readme"], PREVIEW, True) | (F.coalesce(homepage, F.lit("")) != ""), 10),
        points(has(fields["readme"], SETUP, True), 12),
        points(has(fields["everything"], BUSINESS_USE, True), 14),
        points(has(fields["everything"], CUSTOMISING, True), 10),
        F.when(days.isNull(), 0).when(days <= 30, 10).when(days <= 90, 8).when(days <= 365, 5).otherwise(1),
        F.when(stars >= 1000, 3).when(stars >= 100, 2).when(stars > 0, 1).otherwise(0),
    ]
    return clamp(total(parts))


def narrowed_status(metadata_status: Column, kind: Column, template: Column) -> Column:
    """Rules may narrow the gate's status, never promote it."""
    starter = kind.isin("STARTER", "BOILERPLATE") & (template >= 50)
    stays = (metadata_status == "CANDIDATE") & ((kind == "APPLICATION") | starter)
    return F.when((metadata_status == "EXCLUDED") | kind.isin(EXCLUDED_KINDS), "EXCLUDED").when(stays, "CANDIDATE").otherwise("REVIEW")


def eligible_review(status: Column, kind: Column, product: Column, template: Column, readme: Column) -> Column:
    product, template = F.coalesce(product, F.lit(0)), F.coalesce(template, F.lit(0))
    library = (product >= 55) & (template >= 55) & has(readme, REVIEW_LIBRARY)
    other = (product >= 25) | (template >= 40) | kind.isin("APPLICATION", "STARTER", "BOILERPLATE")
    base = (status == "REVIEW") & ~kind.isin(EXCLUDED_KINDS) & (F.coalesce(readme, F.lit("")) != "")
    return F.coalesce(base & F.when(kind.isin("LIBRARY", "FRAMEWORK"), library).otherwise(other), F.lit(False))


def kind_priority(kind: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in KIND_PRIORITY.items() for x in kv])[kind], F.lit(99))


def tier(score: Column) -> Column:
    return F.when(score >= 80, "STRONG").when(score >= 65, "POSSIBLE").when(score >= 50, "WEAK").otherwise("REJECT")


def complexity(score: Column) -> Column:
    return F.when(score.isNull(), "UNKNOWN").when(score >= 75, "LOW").when(score >= 50, "MEDIUM").otherwise("HIGH")


def matches(patterns: list[str], text: Column | Indexed) -> Column:
    """How many of the patterns the text, in lower case, has."""
    if isinstance(text, Indexed):
        return F.expr(" + ".join(f"CASE WHEN {indexed_has(text, p)} THEN 1 ELSE 0 END" for p in patterns))
    return total([points(has(text, p, True), 1) for p in patterns])


def occurrences(patterns: list[str], text: Column | Indexed, most: int = 3) -> Column:
    """Places of all patterns in a text in lower case, `most` a pattern at most; only patterns that the text has are counted."""
    if isinstance(text, Indexed):
        return F.expr(" + ".join(f"CASE WHEN {indexed_has(text, p)} THEN least({text.count(java(p, False))}, {most}) ELSE 0 END" for p in patterns))
    return total([F.when(has(text, p, True), F.least(F.regexp_count(text, F.lit(java(p, False))), F.lit(most))).otherwise(0) for p in patterns])


class PatternTable:
    """Groups of patterns as one array that rows are looked up in, so that an expression stays small however many patterns there are.

    An entry has the literals of the index of which the pattern needs one (none if it isn't known), its
    text if it is plain, and its pattern for Spark. All is SQL over named columns.
    """

    def __init__(self, groups: list[list[str]], index: LiteralIndex):
        self.groups, self.index = groups, index

    def entry(self, pattern: str) -> str:
        parts = alternatives(pattern)
        literals = sorted({self.index.places[x] for part in parts for x in needed(part)}) if all(map(needed, parts)) else []
        plain = quoted(needed(pattern)[0]) if len(parts) == 1 and plain_text(pattern) else "CAST(NULL AS STRING)"
        return f"named_struct('literals', CAST(array({', '.join(map(str, literals))}) AS array<int>), 'plain', {plain}, 'pattern', {quoted(java(pattern, False))})"

    def hits(self, seen: str) -> Column:
        """The entries of each group that a text may have, by what the index has found in it."""
        table = "array(" + ", ".join("array(" + ", ".join(map(self.entry, patterns)) + ")" for patterns in self.groups) + ")"
        return F.expr(f"transform({table}, patterns -> filter(patterns, p -> size(p.literals) = 0 OR exists(p.literals, i -> get({seen}, i))))")

    @staticmethod
    def matches(hits: str, weights: dict[str, int]) -> Column:
        """For each group, the weights of all texts (columns) that have a pattern, summed over its patterns."""
        has = [f"CASE WHEN IF(p.plain IS NULL, {text} RLIKE p.pattern, contains({text}, p.plain)) THEN {n} ELSE 0 END" for text, n in weights.items()]
        return F.expr(f"transform({hits}, patterns -> aggregate(patterns, 0, (n, p) -> n + {' + '.join(has)}))")

    @staticmethod
    def occurrences(hits: str, text: str, most: int = 3) -> Column:
        """For each group, the places of its patterns in a text, `most` a pattern at most."""
        return F.expr(f"transform({hits}, patterns -> aggregate(patterns, 0, (n, p) -> n + least(regexp_count({text}, p.pattern), {most})))")


def normalized_category(category: Column) -> Column:
    known = {c: c for c in SAME_CATEGORY} | OTHER_CATEGORY
    return F.coalesce(F.create_map(*[F.lit(x) for kv in known.items() for x in kv])[category], F.lit("OTHER"))


def category_group(category: Column) -> Column:
    known = {c: g for g, (members, _, _) in GROUPS.items() for c in members}
    return F.coalesce(F.create_map(*[F.lit(x) for kv in known.items() for x in kv])[category], F.lit("OTHER_BUSINESS"))


def selection_score(bundle: Column, parts: dict[str, Column]) -> Column:
    """The weighted mean of a bundle score and six partial scores, which it stands for where they are missing."""
    weighted = bundle * 0.52
    for name, weight in SCORE_WEIGHTS.items():
        weighted = weighted + F.coalesce(parts[name], bundle) * weight
    none = reduce(lambda a, b: a & b, [parts[n].isNull() for n in SCORE_WEIGHTS])
    return F.when(none, bundle.cast("int")).otherwise(half_up(weighted))


def tokens(*texts: Column) -> Column:
    """Different words of four or more letters or digits, without stop words."""
    whole = F.lower(F.concat_ws(" ", *[F.coalesce(t, F.lit("")) for t in texts]))
    split = F.split(F.regexp_replace(whole, r"[^\p{L}\p{N}]+", " "), " ")
    return F.array_distinct(F.filter(split, lambda w: (F.length(w) >= 4) & ~w.isin(STOP_WORDS)))


def token_similarity(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def age_in_days(earlier: Column, now: Column) -> Column:
    days = F.floor((now.cast("timestamp").cast("double") - earlier.cast("timestamp").cast("double")) / 86400).cast("int")
    return F.when(days < 0, 0).otherwise(days)


def decoded_readme(content: Column) -> Column:
    """Text of a base64 payload, white space ignored, line ends unified."""
    raw = F.decode(F.try_to_binary(F.regexp_replace(content, r"\s", ""), F.lit("base64")), "UTF-8")
    return F.regexp_replace(raw, "\r\n", "\n")


def only_strings(json_array: Column) -> Column:
    """The strings of a JSON array; anything else in it, or another value, is left out."""
    items = F.from_json(json_array, "array<string>")
    quoted = F.from_json(json_array, "array<variant>")
    kept = F.filter(F.transform(quoted, lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))), lambda x: x.isNotNull())
    return F.when(items.isNull(), F.array().cast("array<string>")).otherwise(kept)


def all_strings(json_array: Column) -> Column:
    """A JSON array if all of it is strings, else an empty array."""
    kept = only_strings(json_array)
    return F.when(F.size(kept) == F.coalesce(F.json_array_length(json_array), F.lit(-1)), kept).otherwise(F.array().cast("array<string>"))


# Reasons where an earlier analysis has fewer than two.
DEFAULT_REASONS = ["Reused current structured AI analysis.", "Commercial score preserved from the existing analysis."]


def reasons_or_default(json_array: Column) -> Column:
    kept = only_strings(json_array)
    return F.when(F.size(kept) >= 2, kept).otherwise(F.array(*map(F.lit, DEFAULT_REASONS)))


def has_demo(homepage: Column, readme: Column) -> Column:
    return (F.coalesce(homepage, F.lit("")) != "") | has(readme, r"!\[[^\]]*\]\([^)]*\)|screenshot")


def display_name(full_name: Column, url: Column) -> Column:
    return F.coalesce(full_name, F.regexp_replace(url, r"^https?://[^/]+/", ""))
