"""One run from settings to summaries: discover, queue, fetch, turn into records, write, report.

    PAGEWRIGHT_LISTING_URL=https://... PAGEWRIGHT_SITE_URL=https://... python -m pagewright.job

The target and its child table are Spark tables, written as snapshots. Exit codes: 0 all went well,
1 some posts failed, 2 the site refused and nothing was written.
"""

from __future__ import annotations

import datetime as dt
import json
import sys
from collections.abc import Callable
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagewright.functions.settings import Settings, from_env
from pagewright.functions.tables import materialise
from pagewright.operators import sync, target
from pagewright.plans.records import preview
from pagewright.sources.listing import discover, listing_links, stop_page

Fetch = Callable[[list[str]], DataFrame]
#: Listing pages that are fetched together where the settings name no number.
TOGETHER = 10


def polite(spark: SparkSession, settings: Settings) -> Fetch:
    """Fetches urls one after another with the settings' delay."""
    from pagewright.sources.http import PoliteHttp

    spark.dataSource.register(PoliteHttp)
    return lambda urls: spark.read.format("polite_http").option("urls", "\n".join(urls)).option("base", settings.site_url).option("delay", settings.delay_seconds).load()


def refused(pages: DataFrame) -> bool:
    return not pages.filter(F.col("status").isin("blocked", "rate_limited")).isEmpty()


def listing_pages(spark: SparkSession, settings: Settings, fetch: Fetch) -> DataFrame:
    """page_no, page_url, status, html of the listing pages, up to the settings' number or the end of the listing."""
    budget, top, got, first = settings.page_budget(), settings.listing_url.rstrip("/"), None, 1
    host = urlparse(settings.site_url or settings.listing_url).netloc
    while True:
        numbers = range(first, first + (budget or TOGETHER))
        urls = [(n, settings.listing_url if n == 1 else f"{top}/page/{n}/") for n in numbers]
        named = spark.createDataFrame(urls, "page_no int, page_url string")
        part = materialise(named.join(fetch([u for _, u in urls]).withColumnRenamed("url", "page_url"), "page_url").select("page_no", "page_url", "status", "html"), "listing")
        got = part if got is None else got.unionByName(part)
        if budget or refused(part) or stop_page(listing_links(got.filter("status = 'ok'"), host), got.select("page_no", "status"), 0) < numbers[-1]:
            return got
        first = numbers[-1] + 1


def run(spark: SparkSession, settings: Settings, fetch: Fetch, as_of: dt.date, say: Callable[[str], None] = print) -> int:
    """A whole run; returns the exit code. say gets previews of a dry run, warnings and both summaries."""
    children_table = f"{settings.target_table}_children"
    if settings.dry_run:
        held = spark.createDataFrame([], target.SCHEMA)
    else:
        held = spark.table(settings.target_table)
        target.validate(held.schema)
    pages = listing_pages(spark, settings, fetch)
    if refused(pages):
        say("the site refused; nothing was written")
        return 2
    found = materialise(discover(pages, urlparse(settings.site_url or settings.listing_url).netloc, settings.page_budget()), "found")
    again = sync.recheck(held, settings.recheck_limit if settings.mode == "recent" and not settings.dry_run else 0)
    again = again.select(F.col("source_url").alias("url"), F.monotonically_increasing_id().alias("pos"))
    queue = [r.url for r in sync.visit_queue(found, again, settings.max_posts).orderBy("at", "url").collect()]  # the urls that one polite client visits
    fetched = materialise(fetch(queue), "fetched")
    if refused(fetched):
        say("the site refused; nothing was written")
        return 2
    children = spark.table(children_table) if spark.catalog.tableExists(children_table) else None
    got = sync.run(fetched, found, held, as_of, settings.site_name, children)
    for r in got["warnings"].collect():
        say(f"WARNING {r.post_id} {r.source_url}: {', '.join(r.warnings)}")
    counts = got["summary"].first().asDict()
    if settings.dry_run:
        for r in preview(got["changes"].drop("outcome")).collect():
            say(r.preview)
        counts = counts | {"created": 0, "updated": 0, "unchanged": 0, "skipped": sum(counts[n] for n in ("created", "updated", "unchanged", "skipped"))}
    else:
        rows, blocks = materialise(got["target"], "target"), materialise(got["children"], "children")
        rows.write.mode("overwrite").format("parquet").saveAsTable(settings.target_table)
        blocks.write.mode("overwrite").format("parquet").saveAsTable(children_table)
    say("FILTER_SUMMARY=" + json.dumps(got["filter_summary"].first().asDict(), ensure_ascii=False))
    say("SYNC_SUMMARY=" + json.dumps(counts, ensure_ascii=False))
    return 1 if counts["errors"] else 0


def main() -> int:
    settings = from_env()
    spark = SparkSession.builder.appName("pagewright").getOrCreate()
    return run(spark, settings, polite(spark, settings), dt.date.today())


if __name__ == "__main__":
    sys.exit(main())
