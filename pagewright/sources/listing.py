"""Discovery: listing pages to ordered distinct post URLs, and the fetched pages' states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pagewright.functions.urls import normalize_post_url
from pagewright.plans.records import page_rows

#: What became of a fetch.
FETCH_STATUS = ("ok", "not_found", "blocked", "rate_limited", "error")


def listing_links(listing: DataFrame, site_host: str) -> DataFrame:
    """page_no, pos, url, categories of every post link on listing pages (page_no, page_url, html, status optional)."""
    pages = listing.select("page_no", F.col("page_url").alias("url"), "html")
    got = page_rows(pages, keep=("page_no",), fields=("links",)).select("page_no", "url", F.posexplode("links").alias("pos", "link"))
    post = normalize_post_url(F.col("link.href"), F.col("url"), site_host)
    return got.select("page_no", "pos", post.alias("url"), "link.categories").filter("url is not null")


def first_seen(links: DataFrame) -> DataFrame:
    """url, page_no, pos, categories: where a URL stood first, and the categories named at its last link that names any."""
    at = F.struct("page_no", "pos")
    named = F.max_by("categories", F.when(F.size("categories") > 0, at))
    got = links.groupBy("url").agg(F.min(at).alias("at"), named.alias("categories"))
    return got.select("url", "at.page_no", "at.pos", F.coalesce("categories", F.array().cast("array<string>")).alias("categories"))


def stop_page(links: DataFrame, pages: DataFrame, max_pages: int = 3) -> Column | int:
    """The last listing page that discovery reads: before a missing page, at the second page in a row without a new URL, at max_pages (0: none)."""
    news = first_seen(links).groupBy("page_no").agg(F.count(F.lit(1)).alias("new"))
    every = pages.join(news, "page_no", "left").select("page_no", F.coalesce("new", F.lit(0)).alias("new"), "status")
    w = W.orderBy("page_no")  # one row a listing page
    over = (F.col("new") == 0) & (F.lag("new", 1, 1).over(w) == 0)
    ended = every.withColumn("ends", over).filter((F.col("status") == "not_found") | F.col("ends"))
    at = ended.select(F.when(F.col("status") == "not_found", F.col("page_no") - 1).otherwise(F.col("page_no")).alias("n")).agg(F.min("n")).first()[0]
    last = at if at is not None else every.agg(F.max("page_no")).first()[0] or 0
    return min(last, max_pages) if max_pages > 0 else last


def discover(listing: DataFrame, site_host: str, max_pages: int = 3) -> DataFrame:
    """url, page_no, pos, categories of the posts found, each once, for order by page_no, pos."""
    pages = listing if "status" in listing.columns else listing.withColumn("status", F.lit("ok"))
    links = listing_links(pages.filter("status = 'ok'"), site_host)
    return first_seen(links.filter(F.col("page_no") <= stop_page(links, pages.select("page_no", "status"), max_pages)))


def next_page_url(next_href: Column, listing_url: Column, page_no: Column) -> Column:
    return F.coalesce(next_href, F.concat(F.regexp_replace(listing_url, "/+$", ""), F.lit("/page/"), (page_no + 1).cast("string"), F.lit("/")))


def require_access(pages: DataFrame) -> DataFrame:
    """pages, failing before anything is written where the site refused: blocked and rate limited fetches end a run."""
    refused = F.col("status").isin("blocked", "rate_limited")
    return pages.withColumn("status", F.when(refused, F.raise_error(F.concat(F.lit("the site refused: "), "url"))).otherwise(F.col("status")))
