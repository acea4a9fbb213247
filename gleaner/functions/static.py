"""Facts of one repository file by its path, and labels of collected texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import has, java, points, total

# Folders that are skipped, and patterns of paths by role.
SKIPPED = [".git", "node_modules", ".next", "dist", "build", "coverage", "vendor", ".venv", "venv", "target"]
ROLES = {
    "is_readme": r"(?:^|/)readme(?:\.[^./]+)?$",
    "is_test": r"(?:^|/)(?:test|tests|__tests__|spec)\b",
    "is_docker": r"(?:^|/)(?:dockerfile(?:\..+)?|docker-compose(?:\..+)?\.ya?ml|compose\.ya?ml)$",
    "is_env": r"(?:^|/)\.env(?:\.[\w-]+)?(?:\.example|\.sample|\.template)?$|env\.example|example\.env",
    "is_migration": r"(?:^|/)(?:migrations?|prisma/schema\.prisma|alembic|db/migrate)",
    "is_seed": r"(?:^|/)(?:seed|fixtures?|demo(?:\.|/|_))|(?:seed|demo)[^/]*$",
    "is_deployment": r"vercel\.json|netlify\.toml|render\.yaml|fly\.toml|railway|helm|kubernetes|k8s|docker-compose|terraform",
    "is_licence": r"(?:^|/)(?:license|copying)(?:\.[^./]+)?$",
    "is_workspace": r"(?:^|/)(?:pnpm-workspace\.yaml|turbo\.json|nx\.json)$|^(?:apps|packages|services)/",
}
# Names of files that an inspection lists, folders that it lists too, and names whose content it reads.
INSPECTED_NAMES = r"^(readme(?:\.[^.]+)?|license(?:\.[^.]+)?|copying(?:\.[^.]+)?|package\.json|composer\.json|pyproject\.toml|requirements\.txt|cargo\.toml|go\.mod|gemfile|dockerfile(?:\..+)?|docker-compose(?:\..+)?\.ya?ml|compose\.ya?ml|\.env(?:\..+)?|vercel\.json|netlify\.toml|fly\.toml|render\.yaml|railway\.json|pnpm-workspace\.yaml|turbo\.json|nx\.json)$"
INSPECTED_FOLDERS = r"(?:^|/)(?:migrations?|prisma/schema\.prisma|seed|fixtures?|demo)(?:/|\.|$)"
#: Most files listed and read of one repository, manifests and environment files read in an inspection, and variables reported.
MOST_LISTED, MOST_READ, MOST_MANIFESTS, MOST_ENVS, MOST_VARIABLES = 240, 24, 30, 20, 150
# Fixed value: how the path of a manifest ends.
MANIFEST = "package.json"
# Labels by what a text mentions.
FRONTEND = [(r"next(?:\.js)?", "Next.js"), (r"\breact\b", "React"), (r"vue(?:\.js)?", "Vue"), ("svelte", "Svelte"), ("angular", "Angular"), ("tailwind", "Tailwind CSS")]
BACKEND = [("laravel", "Laravel"), ("django", "Django"), ("fastapi", "FastAPI"), ("nestjs", "NestJS"), ("express", "Express"), ("rails", "Rails"), ("spring boot", "Spring Boot"), ("phoenix", "Phoenix")]
STACK = [
    (r"next(?:\.js)?", "Next.js"), (r"\breact\b", "React"), (r"vue(?:\.js)?", "Vue"), ("svelte", "Svelte"), ("angular", "Angular"), ("laravel", "Laravel"), ("django", "Django"), ("fastapi", "FastAPI"), ("flask", "Flask"),
    ("nestjs", "NestJS"), ("express", "Express"), ("rails", "Rails"), ("spring boot", "Spring Boot"), ("phoenix", "Phoenix"), (r"golang|go\.mod", "Go"), (r"rust|cargo\.toml", "Rust"),
]
# Labels by the file names of a tree.
STACK_FILES = {"go.mod": "Go", "cargo.toml": "Rust", "composer.json": "PHP/Composer", "requirements.txt": "Python", "pyproject.toml": "Python"}
DATABASES = [("postgres(?:ql)?", "PostgreSQL"), ("mysql|mariadb", "MySQL/MariaDB"), ("sqlite", "SQLite"), ("mongodb|mongoose", "MongoDB"), ("redis", "Redis")]
SERVICES = [("stripe", "Stripe"), ("openai", "OpenAI"), ("anthropic|claude", "Anthropic"), ("twilio", "Twilio"), ("sendgrid", "SendGrid"), ("resend", "Resend"), ("aws|s3", "AWS/S3"), ("supabase", "Supabase"), ("firebase", "Firebase"), ("google oauth|google cloud", "Google"), ("sentry", "Sentry")]
# Services that cost.
PAID = ["Stripe", "OpenAI", "Anthropic", "Twilio", "SendGrid", "Resend", "AWS/S3", "Google"]
# Dependencies that are out of date.
DEPRECATED = [('"node-sass"', "node-sass"), ('"request"', "request"), ('"bower"', "bower"), (r'"react"\s*:\s*"\^?(?:15|16)\.', "React <=16"), (r'"next"\s*:\s*"\^?(?:9|10|11|12)\.', "Next.js <=12"), (r'"angular"\s*:\s*"\^?[0-9]\.', "AngularJS/old Angular")]
# Package managers by file, and how each installs.
LOCKS = [("pnpm-lock.yaml", "pnpm"), ("yarn.lock", "yarn"), ("bun.lockb", "bun"), ("bun.lock", "bun"), ("package.json", "npm"), ("composer.lock", "composer"), ("poetry.lock", "poetry"), ("cargo.lock", "cargo")]
INSTALL = {"npm": "npm install", "pnpm": "pnpm install", "yarn": "yarn", "bun": "bun install", "composer": "composer install", "poetry": "poetry install", "cargo": "cargo build"}
# Words in capitals that are no environment variables.
NOT_VARIABLES = ["README", "MIT", "GPL", "API", "URL", "HTTP", "HTTPS", "JSON", "SQL", "CSS", "HTML", "CI", "CD", "UI", "ID", "JWT", "UUID", "POSTGRES"]
# Commands in READMEs, and scripts that run, test, or deserve a look.
COMMANDS = r"(?im)^\s*(?:npm|pnpm|yarn|bun|composer|poetry|pip|cargo)\s+(?:install|ci|run\s+(?:dev|start|build|test)|dev|start|build)\b[^\n]*"
RUNTIME_SCRIPT, TEST_SCRIPT = ":(?:dev|start|build|serve|preview|test|test:|e2e|lint)=", ":(?:test|test:|e2e|vitest|jest|pytest)="
SUSPICIOUS = r":(?:preinstall|install|postinstall|prepare|prepack|postpack)=|curl|wget|powershell|chmod \+x|\./scripts/|node scripts/"


def safe_path(path: Column) -> Column:
    """Relative and without steps upwards."""
    return ~path.startswith("/") & ~F.array_contains(F.split(path, "/"), "..")


def listed_path(path: Column) -> Column:
    """Whether a static inspection lists a file of a tree: by its name, or by a folder on its way."""
    return safe_path(path) & (has(file_name(path), INSPECTED_NAMES, True) | has(path, INSPECTED_FOLDERS))


def read_path(path: Column) -> Column:
    """Whether it reads the content too."""
    return has(file_name(path), INSPECTED_NAMES, True)


def wanted_path(path: Column) -> Column:
    """Not in a skipped folder, relative, and without steps upwards."""
    return ~F.arrays_overlap(F.split(path, "/"), F.array(*map(F.lit, SKIPPED))) & safe_path(path)


def file_name(path: Column) -> Column:
    return F.lower(F.element_at(F.split(path, "/"), -1))


def is_manifest(path: Column) -> Column:
    """In its own letter case, unlike the other roles."""
    return path.endswith(MANIFEST)


def role_flags(path: Column) -> list[Column]:
    return [*(has(path, p).alias(name) for name, p in ROLES.items()), is_manifest(path).alias("is_manifest")]


def labels(text: Column, rules: list[tuple[str, str]], low: bool = False) -> Column:
    """The labels of the patterns that the text has, in order."""
    return F.array_compact(F.array(*[F.when(has(text, p, low), label) for p, label in rules]))


def package_manager(names: Column, has_manifest: Column | None = None) -> Column:
    """By the first lock file, of lower-cased names; a manifest (by `has_manifest`, else by its plain name) without one speaks for the manager that stands in its place."""
    found = F.lit(None).cast("string")
    has_manifest = F.array_contains(names, MANIFEST) if has_manifest is None else has_manifest
    for lock, manager in reversed(LOCKS):
        found = F.when(has_manifest if lock == MANIFEST else F.array_contains(names, lock), manager).otherwise(found)
    return found


def manifest_object(manifest: Column) -> Column:
    """The text of a manifest that is a JSON object, {} for another value, null for what isn't JSON."""
    value = F.try_parse_json(manifest)
    return F.when(value.isNotNull(), F.when(F.schema_of_variant(value).startswith("OBJECT"), manifest).otherwise("{}"))


def has_workspaces(manifest: Column) -> Column:
    """Whether a manifest states workspaces; null, false, 0 and the empty text don't count."""
    value = F.try_variant_get(F.try_parse_json(manifest), "$.workspaces", "variant")
    kind, plain = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    return F.coalesce((kind != "VOID") & (kind.startswith("ARRAY") | kind.startswith("OBJECT") | ~plain.isin("false", "0", "")), F.lit(False))


def scripts(path: Column, manifest: Column) -> Column:
    """`path:name=command` of each script of a package manifest; none if it can't be read."""
    held = F.map_entries(F.from_json(F.get_json_object(manifest, "$.scripts"), "map<string,string>"))
    return F.coalesce(F.transform(held, lambda e: F.concat(path, F.lit(":"), e["key"], F.lit("="), e["value"])), F.array().cast("array<string>"))


def install_commands(readme: Column, manager: Column) -> Column:
    written = F.transform(F.regexp_extract_all(readme, F.lit(COMMANDS), F.lit(0)), lambda c: F.trim(F.regexp_replace(c, r"^\s+", "")))
    written = F.filter(written, lambda c: has(c, r"install|\bci\b"))
    default = F.create_map(*[F.lit(x) for kv in INSTALL.items() for x in kv])[manager]
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(F.coalesce(written, F.array().cast("array<string>")), F.array(default)))))


def environment_variables(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(java(r"\b[A-Z][A-Z0-9_]{2,}\b", either_case=False)), F.lit(0))
    return F.slice(F.array_sort(F.array_except(found, F.array(*map(F.lit, NOT_VARIABLES)))), 1, MOST_VARIABLES)


def decision_score(f: dict[str, Column]) -> Column:
    """20 and signed points for each fact; 0 to 100."""
    terms = [
        F.lit(20), points(f["standalone"], 20), points(f["ui"], 12), points(f["runtime"], 12), points(f["docker"], 8), points(f["env"], 5), points(f["tests"], 6),
        points(f["migrations"], 5), points(f["seed"], 4), points(f["deployment"], 4), F.when(F.coalesce(f["licence_matches"], F.lit(True)), 4).otherwise(-12),
        points(f["deprecated"], -8), points(f["paid"], -4), points(f["databases"] > 1, -3), points(f["monorepo"], -3),
    ]
    return F.least(F.lit(100), F.greatest(F.lit(0), total(terms)))


def setup_complexity(score: Column, databases: Column, paid: Column) -> Column:
    return F.when((score >= 78) & (databases <= 1) & ~paid, "LOW").when(score >= 55, "MEDIUM").otherwise("HIGH")


# Why an inspection ends as it does.
REASONS = {
    "conflict": "License file appears GPL while stored metadata is not GPL; legal mismatch requires exclusion.",
    "library": "Library/SDK/framework wording is present without enough static UI evidence; retain for human review rather than auto-drop.",
    "nothing": "No documented or detectable runtime path, package manifest, or container configuration in inspected files; retain for review.",
    "ready": "Documented runtime path, standalone product evidence and self-hosting signals are present.",
    "other": "Static evidence is insufficient for an automated sandbox-ready decision; review setup and runtime behavior without executing code.",
}


def static_decision(f: dict[str, Column], score: Column) -> Column:
    """struct(decision, reason): DROP for a copyleft text under another licence, READY for good evidence, else REVIEW."""
    conflict = F.coalesce(~f["licence_matches"] & (f["licence_detected"] == "GPL"), F.lit(False))
    nothing = ~f["runtime"] & ~f["docker"] & ~f["manifest"]
    ready = (score >= 75) & f["standalone"] & F.coalesce(f["licence_matches"], F.lit(True))
    case = F.when(conflict, "conflict").when(f["library"], "library").when(nothing, "nothing").when(ready, "ready").otherwise("other")
    decision = F.when(case == "conflict", "DROP").when(case == "ready", "READY_FOR_SANDBOX").otherwise("REVIEW")
    return F.struct(decision.alias("decision"), F.create_map(*[F.lit(x) for kv in REASONS.items() for x in kv])[case].alias("reason"))
