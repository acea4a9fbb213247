"""Document fingerprints as Merkle trees over paragraphs and sections, in DataFrame functions alone.

A text is cut into paragraphs (a line; long ones after each sentence, and at 200 code points at most),
each hashed; eight neighbours make a section, hashed over its paragraphs; the root is hashed over the
sections. A fingerprint states all three levels, so that equal texts have equal fingerprints, roots
test equality, sections that differ lead to the paragraphs that were edited, and likeness needs no text.

    root : section section ... : paragraph paragraph ...      (hexadecimal, joined by commas)

Null texts count as empty; an empty text has a root and nothing below. Likeness is 1 for equal roots,
else twice the common paragraphs over all paragraphs of both. Of rows with one doc_id, the order of
their texts' hashes decides; null ids stand first. No row drops out, repeated rows come back as often as
they are there, and an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import order_buckets, staged

PARAGRAPH, FAN_OUT = r"[^\n.!?]{1,200}[\n.!?]*|[\n.!?]{1,200}", 8


def bound(value: Column, body) -> Column:
    """Computes `value` once a row, and `body` of it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text, as a string."""

    def tree(leaves: Column) -> Column:
        def with_sections(sections: Column) -> Column:
            return F.concat_ws(":", F.sha2(F.concat_ws(",", sections), 256), F.concat_ws(",", sections), F.concat_ws(",", leaves))

        starts = F.sequence(F.lit(0), F.greatest(F.size(leaves) - 1, F.lit(0)), F.lit(FAN_OUT))
        sections = F.transform(starts, lambda i: F.substring(F.md5(F.concat_ws(",", F.slice(leaves, i + 1, FAN_OUT))), 1, 16))
        return bound(F.when(F.size(leaves) > 0, sections).otherwise(F.array().cast("array<string>")), with_sections)

    leaves = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0)), lambda p: F.substring(F.md5(p), 1, 12))
    return bound(leaves, tree)


def root(print_: Column) -> Column:
    return F.substring_index(print_, ":", 1)


def paragraphs(print_: Column) -> Column:
    held = F.substring_index(print_, ":", -1)
    return F.when(held == "", F.array().cast("array<string>")).otherwise(F.split(held, ","))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1."""

    def compare(x: Column, y: Column) -> Column:
        both = F.size(x) + F.size(y)
        return F.when(both == 0, F.lit(0.0)).otherwise(2.0 * F.size(F.array_intersect(x, y)) / both)

    parts = bound(F.array_distinct(paragraphs(a)), lambda x: bound(F.array_distinct(paragraphs(b)), lambda y: compare(x, y)))
    return F.when(root(a) == root(b), F.lit(1.0)).otherwise(parts)


def edited_places(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the sections of `a` that `b` lacks: where an edit is."""
    sections = [F.split(F.get(F.split(x, ":"), F.lit(1)), ",") for x in (a, b)]
    return F.when(root(a) == root(b), F.array().cast("array<int>")).otherwise(
        bound(sections[1], lambda y: F.filter(F.transform(sections[0], lambda s, i: F.when(~F.array_contains(y, s), i)), lambda i: i.isNotNull()))
    )


def with_next(documents: DataFrame) -> DataFrame:
    """(doc_id, text, next_text): the text of the next document by doc_id, after the last that of the first.

    The order is cut into ranges; the first row of each range is also sent to the end of the range before
    it (that of the first range to the last), and a window finds the next text within each range.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows, bucket, _ = order_buckets(rows, "doc_id")
    rows = rows.withColumn("bucket", bucket)
    firsts = staged(rows.groupBy("bucket").agg(F.min_by("text", F.struct("doc_id", F.xxhash64("text"))).alias("text")))
    turn = Window.orderBy("bucket")  # only numbers of ranges go through this window, 65,536 at most
    highest = F.max("bucket").over(turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ahead = firsts.select("bucket", F.coalesce(F.lag("bucket").over(turn), highest).alias("to"))
    guests = firsts.join(ahead, "bucket").select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("to").alias("bucket"), F.lit(True).alias("guest"))
    order = Window.partitionBy("bucket").orderBy("guest", "doc_id", F.xxhash64("text"))
    both = rows.withColumn("guest", F.lit(False)).union(guests).withColumn("next_text", F.lead("text").over(order))
    return both.where("not guest").select("doc_id", "text", "next_text")


def half_replaced(text: Column, other: Column) -> Column:
    """The last floor(n / 2) code points of `text` replaced by the first as many of `other`."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every document."""
    return documents.select("doc_id", fingerprint(F.col("text")).alias("fingerprint"))
