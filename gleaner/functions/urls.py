"""Columns for links: canonical URLs, repository links, view counts and channel names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a link in a text may consist of, and the roots of the code host that aren't owners.
URL_IN_TEXT = r"(?:https?://|(?:www\.)?github\.com/)[A-Za-z\d._~:/?#\[\]@!$&'()*+,;=%-]+"
TRAILING = r"[),.;:!?\]}]+$"
RESERVED_ROOTS = [
    "about", "account", "actions", "apps", "collections", "contact", "customer-stories", "dashboard", "dependabot", "discussions", "enterprise",
    "events", "guides", "join", "explore", "features", "login", "marketplace", "mobile", "new", "notifications", "orgs", "plans", "pricing",
    "readme", "search", "security", "sessions", "settings", "signup", "skills", "solutions", "site", "sponsors", "stars", "support", "team",
    "topics", "trending", "users",
]
PARTS = r"^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"


def bound(value: Column, body) -> Column:
    """Computes `value` once a row, and `body` of it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def percent_encoded(text: Column) -> Column:
    """Code points beyond printable ASCII, blanks and quotes in percent form."""

    def one(c: Column) -> Column:
        coded = F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")
        return F.when((c > "~") | c.isin(" ", '"', "<", ">", "`", "{", "}"), coded).otherwise(c)

    return F.when(text.rlike(r'[^!#-;=?-_a-z|~]'), F.array_join(F.transform(F.split(text, ""), one), "")).otherwise(text)


def without_dots(path: Column) -> Column:
    """A path whose segments . and .. (also written %2e) are resolved; steps above the root stay there."""
    up, here = r"(?i)^(?:\.|%2e){2}$", r"(?i)^(?:\.|%2e)$"

    def step(done: Column, segment: Column) -> Column:
        return F.when(segment.rlike(up), F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))).when(segment.rlike(here), done).otherwise(F.concat(done, F.array(segment)))

    def walked(segments: Column) -> Column:
        folder = F.when(F.element_at(segments, -1).rlike(r"(?i)^(?:\.|%2e){1,2}$"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        return F.array_join(F.concat(F.aggregate(segments, F.array().cast("array<string>"), step), folder), "/")

    return F.when(path.rlike(r"(?i)/(?:\.|%2e){1,2}(?:/|$)"), bound(F.split(path, "/"), walked)).otherwise(path)


def resolved(link: Column, base: Column) -> Column:
    """A link made absolute by the page it stands on."""
    scheme, origin = F.regexp_extract(base, PARTS, 1), F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", 0)
    path = F.regexp_extract(base, PARTS, 3)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "[^/]*$", ""))
    return (
        F.when(link.rlike(r"(?i)^(?:www\.)?github\.com(?:/|$)"), F.concat(F.lit("https://"), link))
        .when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.startswith("?"), F.concat(origin, F.when(path == "", "/").otherwise(path), link))
        .when((link == "") | link.startswith("#"), F.regexp_replace(base, "#.*$", ""))
        .otherwise(F.concat(origin, folder, link))
    )


def normalize_url(link: Column, base: Column | None = None) -> Column:
    """The canonical http(s) URL, or null: no trailing punctuation, fragment or default port; lower-case host."""
    trimmed = F.regexp_replace(F.trim(link), TRAILING, "")

    def canonical(url: Column) -> Column:
        scheme, host = F.lower(F.regexp_extract(url, PARTS, 1)), F.lower(F.regexp_extract(url, PARTS, 2))
        host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).otherwise(F.regexp_replace(host, ":443$", ""))
        path, query = F.regexp_extract(url, PARTS, 3), F.regexp_extract(url, PARTS, 4)
        path = F.when(path == "", F.lit("/")).otherwise(without_dots(path))
        whole = F.concat(scheme, F.lit("://"), host, percent_encoded(path), percent_encoded(query))
        return F.when(scheme.isin("http", "https") & host.rlike(r"^[^\s<>^|%]+$"), whole)

    return bound(resolved(trimmed, base if base is not None else F.lit("https://t.me/")), canonical)


def on_code_host(canonical: Column) -> Column:
    return F.coalesce(F.regexp_extract(canonical, PARTS, 2).isin("github.com", "www.github.com"), F.lit(False))


def segments_of(canonical: Column) -> Column:
    return F.filter(F.split(F.regexp_extract(canonical, PARTS, 3), "/"), lambda s: s != "")


def repository_of(canonical: Column) -> Column:
    """struct(owner, repo, canonical_url) of a canonical URL, or null."""

    def read(segments: Column) -> Column:
        owner = F.lower(F.get(segments, F.lit(0)))
        repo = F.lower(F.regexp_replace(F.get(segments, F.lit(1)), r"(?i)\.git$", ""))
        good = on_code_host(canonical) & ~owner.isin(RESERVED_ROOTS)
        good = good & owner.rlike(r"^[a-z\d](?:[a-z\d-]{0,37}[a-z\d])?$") & repo.rlike(r"^[a-z\d._-]{1,100}$")
        return F.when(good, F.struct(owner.alias("owner"), repo.alias("repo"), F.concat(F.lit("https://github.com/"), owner, F.lit("/"), repo).alias("canonical_url")))

    return bound(segments_of(canonical), read)


def repository_link(url: Column) -> Column:
    """struct(owner, repo, canonical_url) of a link to a repository of the code host, or null."""
    return bound(normalize_url(url), repository_of)


def is_code_host(url: Column) -> Column:
    return on_code_host(normalize_url(url))


def link_kind(url: Column) -> Column:
    """struct(path_kind, has_dot_git) of a link to the code host: where in a repository it leads; null elsewhere."""

    def read(canonical: Column) -> Column:
        segments = segments_of(canonical)
        third = F.lower(F.get(segments, F.lit(2)))
        kind = F.when(repository_of(canonical).isNull(), F.lit(None).cast("string")).when(third.isin("issues", "tree", "blob", "releases"), third)
        kind = kind.when(F.size(segments) > 2, "other").otherwise("root")
        return F.when(on_code_host(canonical), F.struct(kind.alias("path_kind"), F.coalesce(F.get(segments, F.lit(1)).rlike(r"(?i)\.git$"), F.lit(False)).alias("has_dot_git")))

    return bound(normalize_url(url), read)


def urls_from_text(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(URL_IN_TEXT), F.lit(0)), F.array().cast("array<string>"))


def unique_urls(urls: Column) -> Column:
    """Different URLs in the order of their first place; nulls go."""
    return F.array_distinct(F.array_compact(urls))


def link_arrays(anchors: Column, text: Column, base: Column) -> Column:
    """struct(external_links, repository_links): anchors first, then links written in the text."""
    every = F.concat(F.coalesce(anchors, F.array().cast("array<string>")), urls_from_text(text))
    external = unique_urls(F.transform(every, lambda x: normalize_url(x, base)))
    return bound(external, lambda x: F.struct(x.alias("external_links"), unique_urls(F.transform(x, lambda u: repository_link(u)["canonical_url"])).alias("repository_links")))


def parse_views(text: Column) -> Column:
    """1.2K, 3M and the like as a number; a comma is read as a point; null if malformed."""
    clean = F.upper(F.regexp_replace(F.regexp_replace(F.trim(text), ",", "."), r"(?U)\s", ""))
    number = F.regexp_extract(clean, r"^(\d+(?:\.\d+)?)([KMB])?$", 1)
    scale = F.when(clean.endswith("K"), 1e3).when(clean.endswith("M"), 1e6).when(clean.endswith("B"), 1e9).otherwise(1.0)
    return F.when(number != "", F.floor(number.try_cast("double") * scale + 0.5).cast("long"))


def parse_date(text: Column) -> Column:
    return F.try_to_timestamp(text)


def channel_name(text: Column) -> Column:
    """The name in a channel link or handle, or null."""
    name = F.regexp_replace(F.regexp_replace(F.trim(text), r"(?i)^(?:https?://)?t\.me/(?:s/)?", ""), "^@|/+$", "")
    return F.when(name.rlike(r"^[A-Za-z][A-Za-z0-9_]{3,31}$"), name)
