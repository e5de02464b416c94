"""From pages to records: one row in, one row a role out, without a shuffle once the pages are dealt over the tasks.

The page function runs once; all that follows are expressions over its struct. A page with two or
more role markers becomes a row for each role it keeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pagewright.functions.ship import ship
from pagewright.functions.tables import dealt
from pagewright.functions.text import activity_period, all_text, location, split_title
from pagewright.functions.vocabulary import GENERIC_PREFIXES
from pagewright.operators import classify, dates, quality, sections
from pagewright.sources.html import NO_TITLE, PAGE, parsed

#: The fields that a record's hash covers, in its order; where it was found is not among them.
HASHED = (
    "post_id title content_type site_categories organization role_or_program design_fields experience_class experience_raw employment_types "
    "target_audience location key_duties qualifications preferred_qualifications essay_questions pre_assignment benefits_prize deadline "
    "activity_period published_date status apply_url collection_status quality_reasons body_blocks"
).split()
RECORD = ["post_id", "source_url", *HASHED[1:], "content_hash"]
POST_ID = r"/archives/(\d+)"
#: Bytes of HTML that one task parses, and what a page counts for beside its own.
TASK_BYTES, PAGE_BYTES = 4 << 20, 256


def content_hash(names: list[str] | None = None, reasons: tuple[str, ...] = quality.REASONS) -> Column:
    """sha256 of the fields as JSON: names sorted, those of the quality reasons too, blocks as pairs, nulls written out."""
    as_written = {
        "body_blocks": lambda x: F.transform(x, lambda b: F.array(b.kind, b.text)),
        "quality_reasons": lambda x: F.struct(*[x[n].alias(n) for n in sorted(reasons)]),
    }
    fields = [as_written.get(n, lambda x: x)(F.col(n)).alias(n) for n in sorted(names or HASHED)]
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def roles(title: Column, marks: Column, blocks: Column) -> Column:
    """array<struct<suffix, role, blocks>> of a page that lists several roles, null for any other page.

    Two or more numbered job lines split it by their numbers, and only design roles stay, maybe none;
    else two or more design role markers split it, counted from 1. Blocks before the first go.
    marks: array<struct<h, role>> beside blocks.
    """
    place = lambda test: F.filter(F.transform(marks, lambda m, i: F.when(test(m), i)), lambda i: i.isNotNull())
    numbered, named = place(lambda m: classify.numbered_role(m.h).isNotNull()), place(lambda m: m.role)

    def cut(at: Column, suffix) -> Column:
        def one(i: Column, n: Column) -> Column:
            end = F.coalesce(F.get(at, n + 1), F.size(blocks))
            return F.struct(suffix(i, n).alias("suffix"), F.get(marks, i).h.alias("role"), F.slice(blocks, i + 1, end - i).alias("blocks"), F.transform(F.slice(marks, i + 1, end - i), lambda m: m.h).alias("hs"))

        return F.transform(at, one)

    by_number = F.filter(cut(numbered, lambda i, n: classify.numbered_role(F.get(marks, i).h)), lambda r: classify.is_design_role(r.role, r.hs))
    by_name = cut(named, lambda i, n: (n + 1).cast("string"))
    return F.when(F.size(numbered) >= 2, by_number).when(F.size(named) >= 2, by_name)


def page_rows(pages: DataFrame, site: str = "", keep: tuple[str, ...] = (), fields: tuple[str, ...] = tuple(PAGE.names)) -> DataFrame:
    """The columns keep, url and the page struct's fields of each row of pages, only what they need is worked out.

    categories become site_categories: a page's own come before those of the listing.
    """
    ship(pages.sparkSession)
    if "fallback_categories" not in pages.columns:
        pages = pages.withColumn("fallback_categories", F.array().cast("array<string>"))
    held = [F.col(n) for n in keep]
    pages = dealt(pages.select(*held, "url", "html", "fallback_categories"), F.coalesce(F.octet_length("html"), F.lit(0)) + PAGE_BYTES, TASK_BYTES)
    got = pages.select(*held, "url", F.coalesce("fallback_categories", F.array().cast("array<string>")).alias("fallback"), parsed(F.col("html"), F.col("url"), site, fields).alias("page"))
    own = lambda: F.when(F.size("page.categories") > 0, F.col("page.categories")).otherwise(F.col("fallback")).alias("site_categories")
    return got.select(*held, "url", *[own() if n == "categories" else F.col(f"page.{n}") for n in fields])


def records(pages: DataFrame, as_of, site: str = "", id_pattern: str = POST_ID) -> DataFrame:
    """RECORD columns of every role on pages (url, html, fallback_categories optional). as_of: the run date.

    Pages whose url holds no id fail the job, as they are no posts.
    """
    p = page_rows(pages, site, fields=("categories", "title", "published_raw", "apply_url", "had_images", "blocks"))
    today = F.lit(as_of).cast("date")
    post_id = F.regexp_extract("url", id_pattern, 1)
    p = p.withColumn("base_id", F.when(post_id == "", F.raise_error(F.concat(F.lit("no post id in "), F.col("url")))).otherwise(post_id))
    p = p.withColumn("marked", sections.labelled(F.col("blocks"))).withColumn("body", all_text(F.col("blocks")))
    p = p.withColumn("published_date", dates.published_date(F.col("published_raw")))
    title, body, cats = F.col("title"), F.col("body"), F.col("site_categories")
    p = p.withColumn("content_type", classify.content_type(title, cats, body, F.col("apply_url")))
    p = p.withColumn("sides", split_title(title, body, sorted(GENERIC_PREFIXES))).withColumn("exp", classify.experience(title, cats, body, F.col("content_type")))
    p = p.withColumn("employment_types", classify.employment_types(title, body, F.col("content_type")))
    p = p.withColumn("deadline", dates.deadline(body, F.col("published_date"), today)).withColumn("benefits_prize", sections.benefits(F.col("marked")))
    p = p.withColumns({"location": location(body), "activity_period": activity_period(body), "status": dates.status(title, body, F.col("deadline"), today)})
    split = roles(title, F.transform("marked", lambda b: F.struct(b.h.alias("h"), b.role.alias("role"))), F.col("blocks"))
    p = p.withColumn("split", split)
    # a page that is not split is one role without a suffix; one that is split may keep none
    whole = F.array(F.struct(F.lit(None).cast("string").alias("suffix"), F.lit("").alias("role"), F.col("blocks").alias("blocks"), F.array().cast("array<string>").alias("hs")))
    p = p.withColumn("r", F.explode(F.coalesce("split", whole))).drop("split", "marked")
    child = F.col("r.suffix").isNotNull()
    p = p.withColumn("child", child).withColumn("body_blocks", F.col("r.blocks")).withColumn("marked", sections.labelled(F.col("body_blocks")))
    job = F.col("child") | (F.col("content_type") == classify.JOB)
    p = p.withColumns(sections.structured(F.col("marked"), job))
    named = F.when(F.col("child"), F.concat("title", F.lit("｜"), "r.role")).otherwise(F.col("title"))
    text = all_text(F.col("body_blocks"))
    own = classify.employment_types(F.col("r.role"), text, F.lit(classify.JOB))
    p = p.withColumns(
        {
            "post_id": F.when(F.col("child"), F.concat("base_id", F.lit("-"), "r.suffix")).otherwise(F.col("base_id")),
            "source_url": F.col("url"),
            "organization": F.col("sides.organization"),
            "role_or_program": F.when(F.col("child"), F.col("r.role")).otherwise(F.col("sides.role")),
            "design_fields": F.when(F.col("child"), classify.design_fields(F.col("r.role"), text)).otherwise(classify.design_fields(F.col("title"), F.col("key_duties"))),
            "experience_class": F.col("exp.class"),
            "experience_raw": F.col("exp.raw"),
            "employment_types": F.when(F.col("child") & (F.size(own) > 0), own).otherwise(F.col("employment_types")),
            "title": named,
        }
    )
    found = {n: F.col(n) for n in ("key_duties", "target_audience", "qualifications", "preferred_qualifications", "essay_questions", "pre_assignment")}
    images = F.col("had_images") & ~F.col("child")
    p = p.withColumn("quality_reasons", quality.reasons(F.col("title"), job, F.col("body_blocks"), F.col("marked"), images, found, NO_TITLE))
    p = p.withColumn("collection_status", quality.collection_status(F.col("quality_reasons")))
    return p.withColumn("content_hash", content_hash()).select(*RECORD)


def with_scope(found: DataFrame) -> DataFrame:
    """records with scope and bucket."""
    from pagewright.functions.text import heading_text

    heads = F.transform("body_blocks", lambda b: heading_text(b.text))
    scope = classify.scope(F.col("content_type"), F.col("title"), F.col("role_or_program"), heads, F.col("quality_reasons.image_only_content"))
    return found.withColumn("scope", scope).withColumn("bucket", classify.scope_bucket(F.col("scope")))


def preview(found: DataFrame) -> DataFrame:
    """records as JSON without their bodies, of which the first eight blocks, the last and the counts are shown; heading candidates where duties are missing."""
    n, blocks = F.size("body_blocks"), F.col("body_blocks")
    rest = [F.col(c) for c in found.columns if c != "body_blocks"]
    heads = F.when(F.col("quality_reasons.missing_job_duties"), sections.heading_candidates(sections.labelled(blocks)))
    shown = F.struct(*rest, n.alias("body_blocks_total"), F.greatest(F.lit(0), n - 8).alias("body_blocks_omitted"), F.slice(blocks, 1, 8).alias("body_blocks_preview"), F.try_element_at(blocks, F.lit(-1)).alias("body_blocks_last"), heads.alias("heading_candidates"))
    return found.select("post_id", F.to_json(shown, {"ignoreNullFields": "false"}).alias("preview"))


