"""Columns for model analyses: rules of landed responses, and the requests that they answer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names that responses may use.
REPOSITORY_KINDS = ["APPLICATION", "LIBRARY", "FRAMEWORK", "CLI_TOOL", "DEV_TOOL", "AWESOME_LIST", "BOOK", "COURSE", "TUTORIAL", "ALGORITHM_COLLECTION", "RESOURCE_COLLECTION", "CONFIG", "STARTER", "BOILERPLATE", "UNKNOWN"]
TIERS = ["STRONG", "POSSIBLE", "WEAK", "REJECT"]
COMPLEXITY = ["LOW", "MEDIUM", "HIGH", "UNKNOWN"]
BUSINESS_CATEGORIES = [
    "CRM", "SALES", "BOOKING", "HR", "ATS", "INVOICING", "ACCOUNTING", "FINANCE", "ERP", "POS", "INVENTORY", "ECOMMERCE", "CUSTOMER_SUPPORT", "PROJECT_MANAGEMENT", "PROPERTY_MANAGEMENT", "REAL_ESTATE", "RESTAURANT",
    "HOTEL", "LMS", "CLIENT_PORTAL", "FORMS", "SURVEYS", "MARKETING", "EMAIL_MARKETING", "SOCIAL_MEDIA", "TIME_TRACKING", "PAYROLL", "DOCUMENT_MANAGEMENT", "CMS", "ANALYTICS", "DASHBOARD", "AUTOMATION", "PRODUCTIVITY", "OTHER",
]
PRODUCT_CATEGORIES = [
    "CRM", "SALES", "LEAD_MANAGEMENT", "ERP", "PROJECT_MANAGEMENT", "BOOKING", "APPOINTMENTS", "CALENDAR_BUSINESS", "ECOMMERCE", "INVENTORY", "POS", "CMS", "ANALYTICS", "DASHBOARD", "CUSTOMER_SUPPORT", "HELPDESK", "LIVE_CHAT",
    "KNOWLEDGE_BASE", "HR", "HRM", "ATS", "FINANCE", "INVOICING", "ACCOUNTING", "EXPENSES", "PAYROLL", "MARKETING", "EMAIL_MARKETING", "AUTOMATION", "AI_ASSISTANT", "AI_AGENT", "CONTENT", "SOCIAL_MEDIA", "PROPERTY_MANAGEMENT",
    "REAL_ESTATE", "RESTAURANT", "HOTEL", "LMS", "COURSE_PLATFORM", "FORM_BUILDER", "SURVEY", "TIME_TRACKING", "DOCUMENT_MANAGEMENT", "CLIENT_PORTAL", "SUBSCRIPTION_MANAGEMENT", "COMMUNICATION", "PRODUCTIVITY", "FILE_MANAGEMENT",
    "SECURITY", "DEVELOPER_PRODUCT", "OTHER",
]
# Fields of responses. A whole number within bounds, a text of 1 to so many letters, yes or no, a name of a
# list, and lists of texts or names of at least and at most so many; `or_null` allows null beside it.
SCORE, FLAG = ("number", 0, 100), ("flag",)


def text(most: int) -> tuple:
    return "text", most


def texts(each: int, most: int, least: int = 0) -> tuple:
    return "texts", each, least, most


def or_null(field: tuple) -> tuple:
    return "or_null", field


PRODUCT = {
    "aiRepositoryKind": ("name", REPOSITORY_KINDS), "actualProductName": text(200), "productCategory": ("name", PRODUCT_CATEGORIES), "shortProductDescription": text(600), "isCompleteApplication": FLAG, "canBeSelfHosted": FLAG,
    "hasMeaningfulUi": FLAG, "requiresComplexInfrastructure": FLAG, "canBeRebranded": FLAG, "canBeUsedAsClientProject": FLAG, "targetUsers": texts(160, 8), "businessUseCases": texts(200, 8), "majorSetupDependencies": texts(160, 12),
    "potentialBundlePositioning": text(500), "analysisConfidence": SCORE, "productCompletenessScore": SCORE, "businessUsefulnessScore": SCORE, "easeOfDeploymentScore": SCORE, "easeOfCustomizationScore": SCORE,
    "visualDemoValueScore": SCORE, "clientResalePotentialScore": SCORE, "bundleUniquenessScore": SCORE, "commercialBundleScore": SCORE, "bundleScoreReasons": texts(240, 8, 2),
}
GAP = PRODUCT | {
    "previousStageStatus": or_null(("name", TIERS)), "previousScore": or_null(SCORE), "reevaluationReason": or_null(text(800)), "discoveryReason": or_null(text(800)), "scoreChanged": FLAG, "scoreDelta": or_null(("number", -100, 100)),
    "buyerValueProposition": text(300), "clientProjectExamples": texts(120, 3),
}
SELECTION = {
    "actualProductName": text(200), "productCategory": ("name", BUSINESS_CATEGORIES), "secondaryCategories": ("names", BUSINESS_CATEGORIES, 5), "shortProductDescription": text(600), "whatUserGets": text(500), "targetUsers": texts(160, 8),
    "businessUseCases": texts(200, 8), "isCompleteApplication": FLAG, "isSelfHostable": FLAG, "hasMeaningfulUi": FLAG, "hasDemoOrScreenshots": FLAG, "canBeRebranded": FLAG, "canBeUsedForClientProjects": FLAG,
    "requiresComplexInfrastructure": FLAG, "majorDependencies": texts(160, 12), "likelySetupComplexity": ("name", COMPLEXITY), "likelyCustomizationComplexity": ("name", COMPLEXITY), "commercialRisks": texts(240, 8),
    "analysisConfidence": SCORE, "productCompletenessScore": SCORE, "businessUsefulnessScore": SCORE, "easeOfDeploymentScore": SCORE, "easeOfCustomizationScore": SCORE, "visualValueScore": SCORE, "clientProjectPotentialScore": SCORE,
    "endUserClarityScore": SCORE, "bundleUniquenessScore": SCORE, "commercialBundleScore": SCORE, "commercialBundleReasons": texts(240, 8, 2), "buyerValueProposition": text(300), "clientProjectExamples": texts(120, 3),
}
SCHEMAS = {"product": PRODUCT, "gap": GAP, "selection": SELECTION}
# What a cut README ends with, and what is asked for.
CUT = {"product": "\n\n[README TRUNCATED FOR COST CONTROL]", "gap": "\n\n[README TRUNCATED FOR COST CONTROL]", "selection": "\n[README TRUNCATED]"}
PRODUCT_TASK = "Assess suitability as one deployable, documented, customizable product in a commercial bundle of 100 open-source applications. This is not a GitHub quality or popularity score."
SELECTION_TASK = "Assess this repository as one independently valuable application in a commercial bundle of deployable, documented, customizable open-source products."
TASK = {"product": PRODUCT_TASK, "gap": PRODUCT_TASK, "selection": SELECTION_TASK}


def member(response: Column, name: str, kind: str = "variant") -> Column:
    """What stands under a name in a JSON object, or null where it is missing, of another kind, or the response is no object."""
    return F.try_variant_get(response, f"$.{name}", kind)


def kind_of(value: Column) -> Column:
    return F.schema_of_variant(value)


def good(value: Column, field: tuple) -> Column:
    """Whether a variant keeps the rule of a field; null where it is missing."""
    kind, *rule = field
    if kind == "or_null":
        return (kind_of(value) == "VOID") | good(value, rule[0])
    if kind == "flag":
        return kind_of(value) == "BOOLEAN"
    if kind == "number":
        n = F.try_variant_get(value, "$", "double")
        return kind_of(value).rlike("^(BIGINT|DECIMAL|DOUBLE)") & (n == F.floor(n)) & n.between(*rule)
    if kind in ("text", "name"):
        held = F.try_variant_get(value, "$", "string")
        return (kind_of(value) == "STRING") & (F.length(held).between(1, rule[0]) if kind == "text" else held.isin(rule[0]))
    one, least, most = (("name", rule[0]), 0, rule[1]) if kind == "names" else (("text", rule[0]), rule[1], rule[2])
    held = F.try_variant_get(value, "$", "array<variant>")
    return kind_of(value).startswith("ARRAY") & F.size(held).between(least, most) & F.forall(held, lambda x: F.coalesce(good(x, one), F.lit(False)))


def violations(response: Column, schema: dict[str, tuple]) -> Column:
    """Names of the fields of a parsed response that break their rules; all of them if there is no object. Other fields may stand beside."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(good(member(response, name), field), F.lit(False)), name) for name, field in schema.items()]))


def cut_readme(readme: Column, most: int, variant: str) -> Column:
    """struct(readme, truncated): at most so many letters, and a mark where there were more."""
    whole = F.coalesce(readme, F.lit(""))
    longer = F.length(whole) > most
    return F.struct(F.when(longer, F.concat(F.substring(whole, 1, most), F.lit(CUT[variant]))).otherwise(whole).alias("readme"), longer.alias("truncated"))


def request(fields: list[Column], readme: Column, most: int, variant: str, context: Column | None = None) -> Column:
    """The request of one repository as JSON: its fields, the README cut, the task, and the context of a second pass."""
    held = cut_readme(readme, most, variant)
    parts = [F.struct(*fields, held["readme"].alias("readme"), held["truncated"].alias("readmeTruncated")).alias("repository"), F.lit(TASK[variant]).alias("task")]
    return F.to_json(F.struct(*parts, *([context.alias("secondPassContext")] if context is not None else [])), {"ignoreNullFields": "false"})
