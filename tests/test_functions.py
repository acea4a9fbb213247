import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleaner.functions import responses, rules, static, urls


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "link,canonical",
    [
        ("https://github.com/Owner/Repo.git", "https://github.com/owner/repo"),
        ("https://github.com/owner/repo/issues/3", "https://github.com/owner/repo"),
        ("http://github.com/owner/repo", "https://github.com/owner/repo"),
        ("github.com/owner/repo).", "https://github.com/owner/repo"),
        ("https://github.com/owner/repo?tab=x#y", "https://github.com/owner/repo"),
        ("https://www.github.com/owner/repo/blob/main/a", "https://github.com/owner/repo"),
        ("https://github.com/owner/repo/releases", "https://github.com/owner/repo"),
        ("https://github.com/my-org/my.repo_1", "https://github.com/my-org/my.repo_1"),
        ("https://github.com/topics/x", None),
        ("https://github.com/trending", None),
        ("https://github.com/settings/profile", None),
        ("https://github.com/marketplace/y", None),
        ("https://example.com/owner/repo", None),
        (None, None),
        ("", None),
    ],
)
def test_repository_links(spark, link, canonical):
    found = spark.createDataFrame([(link,)], "l string").select(urls.repository_link(F.col("l"))["canonical_url"].alias("c")).first()["c"]
    assert found == canonical


def test_urls(spark):
    rows = [("HTTP://Example.COM:80/a#f", "http://example.com/a"), ("https://x.org:443", "https://x.org/"), ("/rel", "https://base.org/rel"), ("q?x=1", "https://base.org/dir/q?x=1"), ("mailto:a@b.c", None), ("//cdn.org/é", "https://cdn.org/%C3%A9"), ("https://a b/", None)]
    got = spark.createDataFrame(rows, "l string, e string").select(urls.normalize_url(F.col("l"), F.lit("https://base.org/dir/page")).alias("g"), "e").collect()
    assert [r["g"] for r in got] == [r["e"] for r in got]
    text = spark.createDataFrame([("см. https://github.com/a/bи github.com/c/d, да",)], "t string")
    links = text.select(urls.link_arrays(F.array(F.lit("http://x.org/?a=1#z"), F.lit("https://github.com/A/B")), F.col("t"), F.lit("https://t.me/")).alias("l")).first()["l"]
    assert links["repository_links"] == ["https://github.com/a/b", "https://github.com/c/d"]
    assert links["external_links"][0] == "http://x.org/?a=1" and len(links["external_links"]) == 4


def test_link_kinds(spark):
    rows = [("https://github.com/o/r/issues/1", "issues"), ("https://github.com/o/r/tree/x", "tree"), ("https://github.com/o/r/blob/x", "blob"), ("https://github.com/o/r/releases", "releases"), ("https://github.com/o/r.git", "root"), ("https://github.com/o/r/wiki", "other"), ("https://github.com/topics/x", None)]
    got = spark.createDataFrame(rows, "l string, e string").select(urls.link_kind(F.col("l")).alias("k"), "e").collect()
    assert [r["k"]["path_kind"] for r in got] == [r["e"] for r in got] and got[4]["k"]["has_dot_git"]
    assert one(spark, urls.link_kind(F.lit("https://example.org/a/b"))) is None


@pytest.mark.parametrize("text,views", [("4.03K", 4030), ("1,2K", 1200), ("2M", 2_000_000), ("unknown", None), ("4,030", 4), (None, None), ("", None)])
def test_views(spark, text, views):
    assert one(spark, urls.parse_views(F.lit(text))) == views


@pytest.mark.parametrize("spdx,category", [("MIT", "PERMISSIVE"), (" apache-2.0 ", "PERMISSIVE"), ("AGPL-3.0", "COPYLEFT"), ("MPL-2.0", "COPYLEFT"), ("BUSL-1.1", "RESTRICTED"), (None, "NO_LICENSE"), ("NOASSERTION", "NO_LICENSE"), ("LicenseRef-x", "UNKNOWN"), ("WTFPL", "UNKNOWN")])
def test_licence_class(spark, spdx, category):
    assert one(spark, rules.licence_class(F.lit(spdx)))["category"] == category


@pytest.mark.parametrize("days,status", [(365, "CANDIDATE"), (366, "REVIEW"), (None, "REVIEW")])
def test_gate(spark, days, status):
    gate = rules.metadata_gate(F.lit("ENRICHED"), F.lit(False), F.lit(None).cast("boolean"), F.lit("PERMISSIVE"), F.lit(days).cast("int"))
    assert one(spark, gate) == status
    assert one(spark, rules.metadata_gate(F.lit("ENRICHED"), F.lit(True), F.lit(False), F.lit("PERMISSIVE"), F.lit(1))) == "EXCLUDED"


def product(spark, name, description, topics, homepage, readme, days, stars):
    df = spark.createDataFrame([(name, description, topics, homepage, readme, days, stars)], "name string, description string, topics array<string>, homepage string, readme string, days int, stars int")
    fields = rules.product_fields(*[F.col(c) for c in ("name", "description", "topics", "homepage", "readme")])
    signals = rules.product_signals(fields, F.col("homepage"), F.col("readme"))
    df = df.withColumn("s", signals).withColumn("kind", rules.product_kind(fields, F.col("s.score"), F.col("s.app_signals")))
    df = df.withColumn("score", rules.clamp(F.col("s.score") - rules.kind_penalty(F.col("kind")))).withColumn("template", rules.template_potential(fields, F.col("kind"), F.col("homepage"), F.col("days"), F.col("stars")))
    return df.withColumn("status", rules.narrowed_status(F.lit("CANDIDATE"), F.col("kind"), F.col("template"))).first()


def test_product_archetypes(spark):
    app = product(spark, "crm", "Self-hosted CRM", ["crm"], "https://x.org", "Live demo ![shot](a.png) docker-compose installation login dashboard postgres web application", 5, 100)
    assert (app["kind"], app["status"]) == ("APPLICATION", "CANDIDATE") and app["score"] >= 70
    awesome = product(spark, "awesome-things", "A curated list", [], None, "list", 5, 500_000)
    assert (awesome["kind"], awesome["status"]) == ("AWESOME_LIST", "EXCLUDED") and awesome["template"] < 20
    tool = product(spark, "kit", "Developer toolkit", [], None, "readme", 5, 10)
    assert (tool["kind"], tool["status"]) == ("DEV_TOOL", "REVIEW")
    nothing = product(spark, None, None, None, None, None, None, None)
    assert nothing["kind"] == "UNKNOWN" and nothing["score"] == 0


@pytest.mark.parametrize("score,tier", [(80, "STRONG"), (79, "POSSIBLE"), (65, "POSSIBLE"), (64, "WEAK"), (50, "WEAK"), (49, "REJECT")])
def test_tiers(spark, score, tier):
    assert one(spark, rules.tier(F.lit(score))) == tier


def test_categories_and_groups(spark):
    pairs = [("FORM_BUILDER", "FORMS"), ("HELPDESK", "CUSTOMER_SUPPORT"), ("AI_ASSISTANT", "OTHER"), (None, "OTHER")]
    for a, b in pairs:
        assert one(spark, rules.normalized_category(F.lit(a))) == b
    assert one(spark, rules.category_group(F.lit("LEAD_MANAGEMENT"))) == "CRM_SALES" and one(spark, rules.category_group(F.lit("PODCASTS"))) == "OTHER_BUSINESS"


def test_review_eligibility(spark):
    def ok(kind, product_, template, readme="self-hosted"):
        return one(spark, rules.eligible_review(F.lit("REVIEW"), F.lit(kind), F.lit(product_), F.lit(template), F.lit(readme)))

    assert not ok("BOOK", 90, 90) and ok("APPLICATION", 1, 1) and ok("LIBRARY", 60, 60) and not ok("LIBRARY", 54, 60) and not ok("UNKNOWN", 24, 39) and not ok("APPLICATION", 1, 1, "")


def test_word_bounds_are_ascii(spark):
    assert one(spark, rules.has(F.lit("éapi client"), r"\bapi client\b")) and not one(spark, rules.has(F.lit("rapi client"), r"\bapi client\b"))


def test_ages_and_readmes(spark):
    age = rules.age_in_days(F.lit(dt.datetime(2026, 8, 19)), F.lit("2026-08-24").cast("timestamp"))
    assert one(spark, age) == 5 and one(spark, rules.age_in_days(F.lit("2027-01-01").cast("timestamp"), F.lit("2026-08-24").cast("timestamp"))) == 0
    assert one(spark, rules.age_in_days(F.lit(None).cast("timestamp"), F.lit("2026-08-24").cast("timestamp"))) is None
    assert one(spark, rules.decoded_readme(F.lit("YQ0K\nYg=="))) == "a\nb" and one(spark, rules.decoded_readme(F.lit("!!"))) is None


def test_string_arrays(spark):
    assert one(spark, rules.only_strings(F.lit('["a", 1, "b"]'))) == ["a", "b"] and one(spark, rules.all_strings(F.lit('["a", 1]'))) == []
    assert one(spark, rules.all_strings(F.lit('["a", "b"]'))) == ["a", "b"] and one(spark, rules.only_strings(F.lit("{}"))) == []


def test_static_columns(spark):
    assert one(spark, static.scripts(F.lit("a/package.json"), F.lit('{"scripts":{"dev":"next dev"}}'))) == ["a/package.json:dev=next dev"]
    assert one(spark, static.scripts(F.lit("p"), F.lit("{broken"))) == []
    assert one(spark, static.install_commands(F.lit("Use\nnpm install x\nnpm run dev"), F.lit("pnpm"))) == ["npm install x", "pnpm install"]
    assert one(spark, static.environment_variables(F.lit("set API_KEY and URL, DB2_HOST API_KEY"))) == ["API_KEY", "DB2_HOST"]
    assert one(spark, static.package_manager(F.array(F.lit("yarn.lock"), F.lit("package.json")))) == "yarn"
    assert not one(spark, static.wanted_path(F.lit("a/node_modules/x"))) and not one(spark, static.wanted_path(F.lit("../x"))) and one(spark, static.wanted_path(F.lit("src/x.ts")))


def test_patterns_against_plain_search(spark):
    """Texts looked up before patterns leave the answer as it is, for every pattern of the rules."""
    import random
    import re

    rnd = random.Random(3)
    patterns = [p for _, p, *_ in rules.SIGNALS] + [p for _, _, p in rules.KINDS] + [p for c in rules.CATEGORIES.values() for p in c] + rules.STANDALONE + rules.NEGATIVE + [rules.DEVELOPER_ONLY, rules.PREVIEW, rules.SETUP]
    patterns += [p for p, _ in rules.LICENCE_TEXTS + rules.LICENCE_IDS + static.STACK + static.DEPRECATED + static.SERVICES] + [*static.ROLES.values(), static.INSPECTED_NAMES, static.INSPECTED_FOLDERS, static.TEST_SCRIPT, static.RUNTIME_SCRIPT, static.SUSPICIOUS]
    words = sorted({w for p in patterns for w in re.findall(r"[a-z0-9]{2,}", re.sub(r"\\\\.", " ", p))})
    texts = ["", "CRM", "pre-crm_x", "éapp"] + ["".join(rnd.choice([*words, *words, ".", "/", "-", "_", " ", " ", " ", "[", "](", ")", "![", "3", "é", "\n"]) for _ in range(rnd.randint(1, 12))) for _ in range(400)]
    texts = [t.upper() if i % 5 == 0 else t for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").cache()
    found = 0
    for at in range(0, len(patterns), 40):
        part = patterns[at : at + 40]
        for r in df.select("i", *[rules.has(F.col("t"), p).alias(f"p{k}") for k, p in enumerate(part)]).collect():
            for k, p in enumerate(part):
                want = bool(re.search(p.replace(r"\d", "[0-9]"), texts[r["i"]], re.I | re.A))
                assert r[f"p{k}"] == want, (p, texts[r["i"]])
                found += want
    assert found > 500


@pytest.mark.parametrize("link,resolved", [("../x", "https://e.org/p/x"), ("../../../x", "https://e.org/x"), ("./y/.", "https://e.org/p/q/y/"), ("/a/b/../c/./d", "https://e.org/a/c/d"), ("/a/..", "https://e.org/a/"), ("/a/../", "https://e.org/"), ("/a/%2e%2E/b", "https://e.org/b"), ("/a/...", "https://e.org/a/"), ("/.a/..b", "https://e.org/.a/..b")])
def test_dot_segments(spark, link, resolved):
    assert one(spark, urls.normalize_url(F.lit(link), F.lit("https://e.org/p/q/r"))) == resolved


def test_json_members(spark):
    v = F.try_parse_json(F.lit('{"a": {"types": ["x", 1]}, "n": 5, "s": "t"}'))
    member = responses.member
    assert one(spark, member(v, "a.types", "array<variant>").isNotNull()) and one(spark, member(v, "n", "int")) == 5 and one(spark, member(v, "missing", "string")) is None
    assert one(spark, member(v, "s", "array<variant>")) is None and one(spark, member(F.try_parse_json(F.lit("[1]")), "s", "string")) is None


def test_response_rules(spark):
    import json

    good = {"actualProductName": "n", "productCategory": "CRM", "secondaryCategories": [], "shortProductDescription": "d", "whatUserGets": "w", "targetUsers": [], "businessUseCases": ["u"], "majorDependencies": [], "commercialRisks": [], "buyerValueProposition": "b", "clientProjectExamples": [], "commercialBundleReasons": ["a", "b"], "likelySetupComplexity": "LOW", "likelyCustomizationComplexity": "UNKNOWN"}
    good |= {n: True for n, f in responses.SELECTION.items() if f == responses.FLAG} | {n: 100 for n, f in responses.SELECTION.items() if f == responses.SCORE}
    assert set(good) == set(responses.SELECTION)

    def broken(**changes):
        held = {k: v for k, v in (good | changes).items() if v != "missing"}
        return one(spark, responses.violations(F.try_parse_json(F.lit(json.dumps(held))), responses.SELECTION))

    assert broken() == [] and broken(further=1) == [] and broken(analysisConfidence=5.0) == []
    for name, value in [("analysisConfidence", 101), ("analysisConfidence", -1), ("analysisConfidence", 1.5), ("analysisConfidence", "5"), ("analysisConfidence", None), ("isSelfHostable", 1), ("whatUserGets", ""), ("whatUserGets", "x" * 501), ("whatUserGets", "missing"), ("productCategory", "LEAD_MANAGEMENT"), ("secondaryCategories", ["CRM"] * 6), ("secondaryCategories", ["NO"]), ("commercialBundleReasons", ["a"]), ("commercialBundleReasons", ["a", 1]), ("commercialBundleReasons", ["a", ""]), ("clientProjectExamples", ["x"] * 4), ("targetUsers", {"0": "x"})]:
        assert broken(**{name: value}) == [name], (name, value)
    assert len(one(spark, responses.violations(F.try_parse_json(F.lit("[]")), responses.SELECTION))) == len(responses.SELECTION)


def test_names_and_similarity(spark):
    assert one(spark, rules.display_name(F.lit(None).cast("string"), F.lit("https://github.com/a/b"))) == "a/b" and one(spark, rules.display_name(F.lit("x/y"), F.lit("u"))) == "x/y"
    a, b = rules.tokens(F.lit("Alpha beta gamma open")), rules.tokens(F.lit("alpha, BETA delta"))
    assert abs(one(spark, rules.token_similarity(a, b)) - 0.5) < 1e-9 and one(spark, rules.token_similarity(a, rules.tokens(F.lit("")))) == 0


def test_manifests(spark):
    texts = ['{"workspaces":["a"]}', '{"workspaces":false}', '{"workspaces":""}', '{"workspaces":null}', '{"workspaces":{}}', "[1]", "broken", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [tuple(r) for r in df.orderBy("i").select(static.has_workspaces(F.col("t")), static.manifest_object(F.col("t"))).collect()]
    assert got == [(True, texts[0]), (False, texts[1]), (False, texts[2]), (False, texts[3]), (True, texts[4]), (False, "{}"), (False, None), (False, None)]


def test_literal_index_finds_what_patterns_find(spark):
    """Every pattern of the rules, on texts made of what they need, through the index of a whole text and of its parts."""
    import random
    import re

    from gleaner.functions.literal_index import Indexed, LiteralIndex

    patterns = [p for ps in (*rules.CATEGORIES.values(), rules.STANDALONE, rules.NEGATIVE) for p in ps] + rules.product_patterns()
    index = rules.literal_index(patterns)
    rnd = random.Random(12)
    pool = [*index.literals, *[x[:-1] for x in index.literals if len(x) > 3], "é", "x", " ", "-", "\n", "_", "docker", "compose.yml", "create some forms", "frontend and a backend", "pos system", "crms", "acrm"]
    texts = [None, "", *("".join(rnd.choice(pool) + rnd.choice(["", " ", " ", "\n", "-"]) for _ in range(rnd.randrange(1, 14))) for _ in range(150)), " ".join(index.literals)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("head", F.substring("t", 1, 40)).withColumn("seen", index.found(F.col("t")))
    rows = df.select("t", "seen").collect()
    assert all([x in (r["t"] or "") for x in index.literals] == r["seen"] for r in rows)
    whole, part = Indexed("t", index, "seen", True), Indexed("head", index, "seen", False)
    for at in range(0, len(patterns), 25):
        some = patterns[at : at + 25]
        pairs = [(rules.has(x, p, True), rules.has(c, p, True)) for p in some for x, c in ((whole, F.col("t")), (part, F.col("head")))]
        assert df.select(*[F.count_if(a != b).alias(f"n{i}") for i, (a, b) in enumerate(pairs)]).first() == tuple([0] * len(pairs))
    groups = [*rules.CATEGORIES.values(), rules.STANDALONE, rules.NEGATIVE, ["[0-9]+"]]
    table = rules.PatternTable(groups, index)
    looked = df.where("t is not null").withColumn("hits", table.hits("seen"))
    rows = looked.select("t", "head", table.matches("hits", {"t": 100, "head": 1}).alias("m"), table.occurrences("hits", "head").alias("o")).collect()
    plain = lambda p: re.compile(p.replace(r"\d", "[0-9]"), re.A)
    for r in rows:
        assert r["m"] == [sum(100 * bool(plain(p).search(r["t"])) + bool(plain(p).search(r["head"])) for p in ps) for ps in groups]
        assert r["o"] == [sum(min(3, len(plain(p).findall(r["head"]))) for p in ps) for ps in groups]
    counts = [(rules.occurrences([p], part), rules.occurrences([p], F.col("head"))) for p in rules.STANDALONE]
    assert df.select(*[F.count_if(a != b).alias(f"n{i}") for i, (a, b) in enumerate(counts)]).first() == tuple([0] * len(counts))
    assert LiteralIndex(["a", "", "a", "b"]).places == {"a": 0, "b": 1}
    assert df.limit(0).select(rules.has(whole, "crm", True)).count() == 0


def test_outcomes_of_calls(spark):
    from gleaner.functions import outcomes

    calls = [(200, 5), (204, 0), (404, 0), (403, 0), (403, 3), (429, 9), (500, 0), (410, 1), (None, None)]
    df = spark.createDataFrame([(i, *c, "m" * 3000) for i, c in enumerate(calls)], "i int, status int, remaining int, message string")
    call = [F.col("status"), F.col("remaining")]
    rows = df.select("i", outcomes.metadata_outcome(*call, F.col("message")).alias("m"), outcomes.readme_outcome(*call).alias("r"), outcomes.search_outcome(*call, F.col("message")).alias("s"), outcomes.stops(*call).alias("stops")).orderBy("i").collect()
    states = [(r["m"]["state"], r["m"]["error_code"], len(r["m"]["error_message"] or ""), r["r"]["state"], r["s"]["state"], r["s"]["error_code"], len(r["s"]["error_message"] or ""), r["stops"]) for r in rows]
    done, limited = ("ENRICHED", None, 0, "FETCHED", "COMPLETED", None, 0, False), ("RATE_LIMITED", "rate_limited", 3000, "FAILED", "RATE_LIMITED", "rate_limited", 2000, True)
    assert states == [done, done, ("UNAVAILABLE", "404", 3000, "MISSING", "FAILED", "not_found", 2000, False), limited, ("FAILED", "http_403", 2000, "FAILED", "FAILED", "http_403", 2000, False), limited,
                      *[("FAILED", c, 2000, "FAILED", "FAILED", c, 2000, False) for c in ("http_500", "http_410", "unknown")]]


def test_usage_of_responses(spark):
    from gleaner.functions import outcomes

    texts = ['{"usage":{"input_tokens":7,"output_tokens":3}}', '{"usage":{"input_tokens":7}}', '{"usage":null}', "[]", "{broken", None, '{"usage":{"input_tokens":"x"}}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [tuple(r["u"]) for r in df.select("i", outcomes.usage(F.col("t")).alias("u")).orderBy("i").collect()] == [(7, 3), (7, 0), (0, 0), (0, 0), (0, 0), (0, 0), (0, 0)]


def test_manifests_in_their_own_letter_case(spark):
    paths = ["package.json", "a/my-package.json", "a/Package.json", "PACKAGE.JSON", "package.json.bak"]
    assert [one(spark, static.is_manifest(F.lit(p))) for p in paths] == [True, True, False, False, False]
    names = F.array(F.lit("my-package.json"))
    assert one(spark, static.package_manager(names, F.lit(True))) == "npm" and one(spark, static.package_manager(names)) is None


def test_landed_trees_give_the_facts_of_the_table(spark, tmp_path):
    """A tree of all pages, written file by file, read by its folders, with contents of files by name and size."""
    import os

    from gleaner.plans import static_queries
    from gleaner.sources import scans

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    files = pages.selectExpr(*[f"{e} AS {c}" for c, e in static_queries.FILES.items()]).withColumn("size", F.octet_length("content").cast("long"))
    rows = [r for r in files.dropDuplicates(["repository_id", "path"]).collect()]
    table = spark.createDataFrame(rows, files.schema)

    def escaped(name):
        name = name.replace("%", "%25")
        return {".": "%2E", "_": "%5F"}.get(name[:1], name[:1]) + name[1:]

    for r in rows:
        place = tmp_path / "trees" / f"repository_id={r['repository_id']}" / "/".join(map(escaped, r["path"].split("/")))
        os.makedirs(place.parent, exist_ok=True)
        if r["content"]:
            place.write_bytes(r["content"].encode())
        else:
            place.with_name(place.name + "%00").write_text("\n")
    (tmp_path / "trees" / "stray.txt").write_text("not in a repository")
    names = "{*[rR][eE][aA][dD][mM][eE]*,*package.json,*[eE][nN][vV]*,[lL][iI][cC][eE][nN][sS][eE]*,[cC][oO][pP][yY][iI][nN][gG]*}"
    landed = scans.landed_repository_files(spark, f"{tmp_path}/trees", names, 250_000)
    assert sorted(map(tuple, landed.select("repository_id", "path").collect())) == sorted((r["repository_id"], r["path"]) for r in rows)
    want = {tuple(r) for r in static_queries.facts_of_files(table).select("repository_id", "n_files", "total_size", "detected", "score", "decision", F.array_join("variables", ","), F.array_join("install", ","), F.array_join("stack", ",")).collect()}
    got = {tuple(r) for r in static_queries.facts_of_files(landed).select("repository_id", "n_files", "total_size", "detected", "score", "decision", F.array_join("variables", ","), F.array_join("install", ","), F.array_join("stack", ",")).collect()}
    assert got == want and len(got) > 3
    small = scans.landed_contents(spark, f"{tmp_path}/trees", names, 10)
    assert small.where(F.octet_length("content") > 10).count() == 0 and "LessThanOrEqual(length,10)" in small._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    listed = scans.landed_trees(spark, f"{tmp_path}/trees")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in listed.split("ReadSchema")[1]
