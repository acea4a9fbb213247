"""Quality rules on whole documents and on lines across documents, in DataFrame functions alone.

Each document gets word, symbol, line and repetition counts. Beside these, normalised lines are hashed
and counted over distinct documents of each host (the column `source`); lines above the limit are
boilerplate and go, and a document that has too little left without them is rejected.

Distinct texts of a host are its documents: a line counts once for each, however often the text recurs,
and texts that differ at all are two. So pages of one host that are alike but for a line are boilerplate
of that host, of whatever share of their lines, and go; removing copies of good texts is the work of the
near-duplicate join, which can come first where copies are to be saved.

Null texts have no words and fail the base rules. Null hosts are one host. Repeated rows get the same
verdict and count once. Very long texts are read whole. An empty table gives no rows. Columns of the
input stay as they are, but for one that has the name asked for the verdict, a struct, which it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns, free_name, small_or_shuffled, staged

# White space of the word rule, and the symbols that are counted.
SPACE, SYMBOLS = " \t\n\x0b\f\r", "#*$%&|<>"


def bound(value: Column, body) -> Column:
    """Computes `value` once a row, and `body` of it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def repeated_words(words: Column) -> Column:
    """Words that stand in a window of three found twice or more, the first time included."""

    def covered(windows: Column) -> Column:
        def positions(ordered: Column) -> Column:
            def twice(x: Column, i: Column) -> Column:
                before, after = F.get(ordered, i - 1), F.get(ordered, i + 1)
                return F.coalesce(before["h"] == x["h"], F.lit(False)) | F.coalesce(after["h"] == x["h"], F.lit(False))

            places = F.transform(F.filter(ordered, twice), lambda x: x["at"])
            return F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))))

        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(bound(ordered, positions))

    hashed = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(bound(hashed, covered))


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE)) != ""


def document_rules(text: Column) -> Column:
    """A struct of the counts that one text has by itself."""
    text = F.coalesce(text, F.lit(""))
    no_space, no_symbols = F.translate(text, SPACE, ""), F.translate(text, SYMBOLS, "")

    def counts(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), repeated_words(words).cast("long").alias("n_repeat_words"))

    lines = bound(F.filter(F.split(text, "\n"), has_word), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return F.struct(
        bound(words_of(text), counts).alias("words"),
        F.length(no_space).cast("long").alias("word_chars"),
        (F.length(text) - F.length(no_symbols)).cast("long").alias("n_symbols"),
        lines.cast("long").alias("n_dup_lines"),
    )


def line_hashes(documents: DataFrame) -> DataFrame:
    """(k1, k2, lines): a hash of host and text, and (h, n) of each different line: its hash on the host, its length."""
    plain = F.lower(F.regexp_replace(F.btrim("text", F.lit(SPACE)), r"[\x20\x09\x0B-\x0D]+", " "))
    lines = F.filter(F.split(plain, "\n"), has_word)
    hashed = F.transform(lines, lambda x: F.struct(F.xxhash64("source", F.btrim(x, F.lit(SPACE))).alias("h"), F.length(x).alias("n")))
    keys = [F.xxhash64("source", "text").alias("k1"), F.xxhash64("text", F.lit(7), "source").alias("k2")]
    return documents.where(F.col("text").isNotNull()).select(*keys, hashed.alias("lines"))


def frequent_lines(hashes: DataFrame, max_documents: int) -> DataFrame:
    """(h, n_documents) of the lines that more than `max_documents` distinct documents of their host hold, from a staged table of line_hashes."""
    each = hashes.select("k1", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    counted = each.distinct().groupBy("h").agg(F.count("*").alias("n_documents"))
    return staged(counted.where(F.col("n_documents") > max_documents))


def documents_with_frequent_lines(documents: DataFrame, max_documents: int = 50, least_left: float = 0.2) -> DataFrame:
    """(k1, k2, frequent, depleted) of the documents that hold frequent lines: their hashes, and whether less than `least_left` of all characters stand outside them."""
    hashed = staged(line_hashes(documents))  # texts are cut and hashed once, though lines are read twice
    frequent = small_or_shuffled(frequent_lines(hashed, max_documents).select("h"))
    total = F.aggregate("lines", F.lit(0), lambda a, x: a + x["n"])
    each = hashed.select("k1", "k2", total.alias("total"), F.posexplode("lines").alias("at", "line")).select("k1", "k2", "total", "at", "line.h", "line.n")
    found = each.join(frequent, "h").groupBy("k1", "k2").agg(F.first("total").alias("total"), F.collect_set(F.struct("at", "h", "n")).alias("found"))  # a set, as rows repeat
    left = F.col("total") - F.aggregate("found", F.lit(0), lambda a, x: a + x["n"])
    return staged(found.select("k1", "k2", F.array_distinct(F.transform("found", lambda x: x["h"])).alias("frequent"), (left < least_left * F.col("total")).alias("depleted")))


def joined(documents: DataFrame, found: DataFrame, columns: list[Column], rows: int | None = None) -> DataFrame:
    """All documents, with columns of those that hold frequent lines."""
    k1, k2 = free_name(documents, "_k1"), free_name(documents, "_k2")
    named = small_or_shuffled(found, rows).select(F.col("k1").alias(k1), F.col("k2").alias(k2), *columns)
    keys = [F.xxhash64("source", "text"), F.xxhash64("text", F.lit(7), "source")]
    return documents.join(named, (keys[0] == F.col(k1)) & (keys[1] == F.col(k2)), "left").drop(k1, k2)


def quality_rules(documents: DataFrame, min_words: int = 50, max_repeated: float = 0.5, max_documents: int = 50, least_left: float = 0.2, found: DataFrame | None = None, name: str = "quality") -> DataFrame:
    """The documents with a struct column `name`: counts, base_failed and kept.

    `found` is the result of `documents_with_frequent_lines`, where it is there already.
    """
    found = documents_with_frequent_lines(documents, max_documents, least_left) if found is None else found
    counts, depleted = free_name(documents, "_rules"), free_name(documents, "_depleted")
    marked = documents.withColumn(counts, document_rules(F.col("text")))
    marked = joined(marked, found.where("depleted"), [F.lit(True).alias(depleted)])
    words, repeated = F.col(f"{counts}.words.n_words"), F.col(f"{counts}.words.n_repeat_words")
    failed = (words < min_words) | (repeated > max_repeated * words)
    fields = [words.alias("n_words"), *(F.col(f"{counts}.{c}").alias(c) for c in ("word_chars", "n_symbols", "n_dup_lines")), repeated.alias("n_repeat_words")]
    verdict = F.struct(*fields, failed.alias("base_failed"), (~failed & F.col(depleted).isNull()).alias("kept"))
    return marked.select(*[x for x, c in zip(columns(documents), documents.columns, strict=True) if c.lower() != name.lower()], verdict.alias(name))


def without_boilerplate(documents: DataFrame, max_documents: int = 50, least_left: float = 0.2) -> DataFrame:
    """The documents that the rules keep, their frequent lines removed; the other lines stay as they are, in order.

    The counts of the verdict are those of the whole text. `n_chars` follows a text that has changed.
    """
    found = documents_with_frequent_lines(documents, max_documents, least_left)
    verdict, held = free_name(documents, "_quality"), free_name(documents, "_frequent")
    kept = quality_rules(documents, max_documents=max_documents, least_left=least_left, found=found, name=verdict).where(F.col(f"{verdict}.kept")).drop(verdict)
    clean = found.where("not depleted")
    size = clean.agg(F.sum(F.size("frequent") + 1)).first()[0] or 0
    rows = joined(kept, clean, [F.col("frequent").alias(held)], size)

    def stays(line: Column) -> Column:
        plain = F.lower(F.regexp_replace(line, r"[\x20\x09\x0B-\x0D]+", " "))  # as in line_hashes
        return ~F.array_contains(held, F.xxhash64("source", F.btrim(plain, F.lit(SPACE))))

    changed = F.col(held).isNotNull()
    rows = rows.withColumn("text", F.when(changed, F.array_join(F.filter(F.split("text", "\n"), stays), "\n")).otherwise(F.col("text")))
    if "n_chars" in documents.columns:
        rows = rows.withColumn("n_chars", F.when(changed & F.col("n_chars").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.select(columns(documents))
