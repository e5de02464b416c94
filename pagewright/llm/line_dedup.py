"""Line dedup over overlapping windows of three lines.

The lines of a text that hold a word, trimmed of spaces, are numbered; every three consecutive ones
form a window, known by a 128-bit hash. A window's first occurrence is the one in the smallest
(doc_id, text hash, position), null ids last. All lines that any later occurrence covers go, overlapping
occurrences merging; everything else stays as it was, blank lines and line order included.

Windows are made, counted and looked up natively: the window hashes are shuffled twice, the texts
once. Joins on a window that a large share of the rows hold are split by AQE.

Defined results: null texts stay null; texts of fewer than three lines with words have no window and
stay; rows repeated with id and text count as one document and are treated alike; where occurrences
of one window overlap in a text, the lines before the second one stay; documents all of whose lines
go keep an empty text (or their blank lines); texts of any length are taken whole; an empty table
gives an empty result. Extra columns pass through; without_repeats() replaces those that have the name
of a column it adds, first_only() none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pagewright.llm.common import WORD, bind

WINDOW = 3


def numbered(text: Column) -> Column:
    """array<struct<at, line>> of the lines with a word: place among all lines, trimmed line."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x, i: F.struct(i.alias("at"), F.trim(x).alias("line")))
    return F.filter(lines, lambda x: x.line.rlike(WORD))


def windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, th, pos, h1, h2: one row per window, pos from 0."""

    def hashed(lines: Column) -> Column:
        def one(i: Column) -> Column:
            part = F.transform(F.slice(lines, i, width), lambda x: x.line)
            return F.struct((i - 1).alias("pos"), F.xxhash64(part).alias("h1"), F.xxhash64(F.lit(1), F.array_join(part, "\n")).alias("h2"))

        return F.when(F.size(lines) >= width, F.transform(F.sequence(F.lit(1), F.size(lines) - (width - 1)), one))

    found = docs.select("doc_id", F.xxhash64("text").alias("th"), F.explode(bind(numbered(F.col("text")), hashed)).alias("w"))
    return found.select("doc_id", "th", "w.pos", "w.h1", "w.h2")


def later_windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, th, starts: the windows of each document that occurred before."""
    every = windows(docs, width)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "pos")
    first = every.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last").select("h1", "h2", "first")
    later = every.join(first, ["h1", "h2"]).filter(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("pos")).alias("starts"))


def without_repeats(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """docs with `text` rid of repeated windows, and n_lines, n_removed added."""
    gone = later_windows(docs.select("doc_id", "text"), width).withColumnsRenamed({"doc_id": "__id", "th": "__th", "starts": "__starts"})
    on = docs["doc_id"].eqNullSafe(gone["__id"]) & (F.xxhash64(docs["text"]) == gone["__th"])
    both = docs.join(gone, on, "left").drop("__id", "__th").withColumn("__lines", numbered(F.col("text")))
    covered = F.array_distinct(F.flatten(F.transform("__starts", lambda s: F.sequence(s, s + (width - 1)))))
    both = both.withColumn("__gone", covered).withColumn("__all", F.split("text", "\n", -1))
    both = both.withColumn("n_lines", F.size("__lines").cast("long")).withColumn("n_removed", F.coalesce(F.size("__gone"), F.lit(0)).cast("long"))
    places = F.transform("__gone", lambda i: F.get("__lines", i).at)
    kept = F.array_except(F.sequence(F.lit(0), F.size("__all") - 1), places)
    left = F.array_join(F.transform(kept, lambda i: F.get("__all", i)), "\n")
    return both.withColumn("text", F.when(F.col("__gone").isNotNull(), left).otherwise(F.col("text"))).drop("__starts", "__lines", "__gone", "__all")


def first_only(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """docs with `text` rid of repeated windows, all columns kept whatever their names."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    held = docs.select("doc_id", "text", F.struct(F.lit(0).alias("__none"), *[F.col(f"`{c}`") for c in rest]).alias("__rest"))
    got = without_repeats(held, width)
    return got.select(*[F.col(c) if c in ("doc_id", "text") else F.col("__rest")[c].alias(c) for c in docs.columns])
