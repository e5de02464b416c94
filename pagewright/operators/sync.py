"""Incremental sync: what to visit, what changed, what to write.

Joins are equi-joins on the post id or the url; state is a table of records, rewritten as a snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pagewright.functions.tables import materialise
from pagewright.operators.quality import warnings
from pagewright.operators.target import child_blocks, properties, replace_children
from pagewright.plans.records import records, with_scope


def visit_queue(found: DataFrame, recheck: DataFrame, limit: int = 0) -> DataFrame:
    """url, rank: the URLs found (url, page_no, pos), then those to recheck (url, pos), each once, `limit` of them at most (0: all).

    Discovery order is kept; what is rechecked comes last and so is the first to fall to the limit.
    """
    place = lambda again, page: F.struct(F.lit(again).alias("recheck"), page.cast("long").alias("page_no"), F.col("pos").cast("long").alias("pos"))
    both = found.select("url", place(0, F.col("page_no")).alias("at")).unionByName(recheck.select("url", place(1, F.lit(0)).alias("at")))
    once = both.groupBy("url").agg(F.min("at").alias("at"))
    return once.orderBy("at", "url").limit(limit) if limit > 0 else once


def append_missing(found: DataFrame, recheck: DataFrame) -> DataFrame:
    """The recheck rows whose url is not among those found."""
    return recheck.join(found.select("url"), "url", "left_anti")


def recheck(target: DataFrame, limit: int = 20) -> DataFrame:
    """The `limit` (at most 100) open records that were checked longest ago; rows without url or id go after the limit."""
    if limit <= 0:
        return target.limit(0)
    oldest = target.filter(F.col("status") == "모집 중").orderBy(F.col("last_checked").asc_nulls_first(), "post_id").limit(min(limit, 100))
    return oldest.filter((F.coalesce("source_url", F.lit("")) != "") & (F.coalesce("post_id", F.lit("")) != ""))


def with_categories(pages: DataFrame, listing: DataFrame) -> DataFrame:
    """pages with fallback_categories from the listing (url, categories)."""
    return pages.join(listing.select("url", F.col("categories").alias("fallback_categories")), "url", "left")


def latest(target: DataFrame) -> DataFrame:
    """One row a post id: the least recently written wins no tie twice, so the order is by last_checked, then hash."""
    w = W.partitionBy("post_id").orderBy(F.col("last_checked").desc_nulls_last(), "content_hash")
    return target.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def outcome(old_hash: Column, new_hash: Column) -> Column:
    return F.when(old_hash.isNull(), "created").when(old_hash != new_hash, "updated").otherwise("unchanged")


def changes(found: DataFrame, target: DataFrame) -> DataFrame:
    """found with outcome, by the hash that the target holds for the post id."""
    known = latest(target).select("post_id", F.col("content_hash").alias("__old"))
    return found.join(known, "post_id", "left").withColumn("outcome", outcome(F.col("__old"), F.col("content_hash"))).drop("__old")


def missing(fetched: DataFrame, target: DataFrame, id_pattern: str = r"/archives/(\d+)") -> DataFrame:
    """post_id, outcome of pages that are gone: known posts are marked (updated), others skipped."""
    gone = fetched.filter("status = 'not_found'").select(F.regexp_extract("url", id_pattern, 1).alias("post_id"))
    known = target.select("post_id", F.lit(True).alias("known")).distinct()
    return gone.join(known, "post_id", "left").select("post_id", F.when(F.col("known"), "updated").otherwise("skipped").alias("outcome"))


def apply_changes(target: DataFrame, changed: DataFrame, gone: DataFrame, as_of) -> DataFrame:
    """The target after a run: a snapshot, to be written in one piece. changed: of changes(); gone: of missing().

    New and changed records are written as properties() has them, cut and blanked. Unchanged records are not touched, their last check included. Records of pages that are gone are
    marked for review.
    """
    today = F.lit(as_of).cast("date")
    fresh = properties(changed.filter("outcome <> 'unchanged'"), as_of, F.col("outcome") == "updated").select(*target.columns)
    lost = gone.filter("outcome = 'updated'").select("post_id", F.lit(True).alias("__gone")).distinct()
    kept = latest(target).join(fresh.select("post_id"), "post_id", "left_anti").join(lost, "post_id", "left")
    mark = F.coalesce("__gone", F.lit(False))
    kept = kept.withColumns({"status": F.when(mark, "확인 필요").otherwise(F.col("status")), "collection_status": F.when(mark, "검토 필요").otherwise(F.col("collection_status")), "last_checked": F.when(mark, today).otherwise(F.col("last_checked"))})
    return kept.drop("__gone").unionByName(fresh).select(*target.columns)


def counters(outcomes: DataFrame) -> DataFrame:
    """One row: created, updated, unchanged, skipped, errors of rows (outcome)."""
    return outcomes.agg(*[F.count_if(F.col("outcome") == n).alias(n) for n in ("created", "updated", "unchanged", "skipped", "errors")])


def filter_counters(found: DataFrame) -> DataFrame:
    """One row: in_scope, filtered_non_design, filtered_ambiguous of rows (bucket)."""
    return found.agg(*[F.count_if(F.col("bucket") == n).alias(n) for n in ("in_scope", "filtered_non_design", "filtered_ambiguous")])


def run(fetched: DataFrame, listing: DataFrame, target: DataFrame, as_of, site: str = "", children: DataFrame | None = None) -> dict[str, DataFrame]:
    """One sync of fetched pages (url, status, html): the new target and child table, the outcomes, warnings and both summaries.

    The records of the run are kept in the shared folder; the target is not written here.
    """
    good = with_categories(fetched.filter("status = 'ok'").select("url", "html"), listing)
    scoped = materialise(with_scope(records(good, as_of, site)), "records")  # pages are parsed once
    decided = changes(scoped.filter("scope = 'in_scope'").drop("scope", "bucket"), target)
    gone = missing(fetched, target)
    failed = fetched.filter("status = 'error'").select(F.lit("errors").alias("outcome"))
    outcomes = decided.select("outcome").unionByName(gone.select("outcome")).unionByName(failed)
    changed = decided.filter("outcome <> 'unchanged'")
    blocks = child_blocks(changed)
    said = decided.select("post_id", "source_url", warnings(F.col("body_blocks"), F.col("content_type"), F.col("employment_types")).alias("warnings")).filter(F.size("warnings") > 0)
    return {
        "target": apply_changes(target, decided, gone, as_of),
        "children": blocks if children is None else replace_children(children, blocks, changed),
        "changes": decided, "warnings": said, "summary": counters(outcomes), "filter_summary": filter_counters(scoped),
    }
