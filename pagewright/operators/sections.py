"""Sections of a page's blocks, as folds over the block array of its row: nothing is exploded or shuffled.

`labelled` adds to each block what decides about it; every extractor folds over that array.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pagewright.functions import rules
from pagewright.functions.rules import is_full, java, joined_kind, section_kind
from pagewright.functions.text import clean_text, decoration_only, heading_text, join_complete_lines, let, lines
from pagewright.operators.classify import design_fields

EMPTY = "array<string>"
JOB = "채용공고"


def role_marker(kind: Column, heading: Column) -> Column:
    """A heading or numbered line that names a design role."""
    shaped = kind.startswith("heading") | heading.rlike(java(r"\A\d{1,2}[.)]\s*"))
    return shaped & is_full(rules.ROLE_MARKER, heading) & (F.size(design_fields(heading, F.lit(""))) > 0)


def labelled(blocks: Column) -> Column:
    """array<struct<i, kind, text, h, logical, role, skip, notice>>; blocks has to be a plain column.

    logical: the kind of a heading, also of one split over up to three neighbouring blocks.
    skip: empty or decoration. notice: a date or place line that ends any section.
    """
    heads = F.transform(blocks, lambda b: F.struct(heading_text(b.text).alias("h"), section_kind(b.text).alias("k")))

    def over(hs: Column) -> Column:
        def one(b: Column, i: Column) -> Column:
            at = lambda n: F.when(i + n >= 0, F.get(hs, i + n).h)
            spans = F.array(*[F.array(*[at(n) for n in span]) for span in ((-1, 0), (0, 1), (-1, 0, 1), (0, 1, 2))])
            split = F.get(F.filter(F.transform(spans, joined_kind), lambda k: k.isNotNull()), F.lit(0))

            def made(text: Column, here: Column) -> Column:
                logical = F.when(here.k.isNotNull(), here.k).otherwise(split)
                return F.struct(
                    i.alias("i"), b.kind.alias("kind"), text.alias("text"), here.h.alias("h"), logical.alias("logical"), role_marker(b.kind, here.h).alias("role"),
                    ((text == "") | decoration_only(text)).alias("skip"), text.rlike(java(r"\A" + rules.DATE_NOTICE)).alias("notice"),
                )

            return let(clean_text(b.text), lambda t: let(F.get(hs, i), lambda h: made(t, h)))

        return F.transform(blocks, one)

    return let(heads, over)


def combined(parts: Column) -> Column:
    """The lines of several parts in order, each once, without empty ones."""
    return F.array_distinct(F.filter(F.flatten(parts), lambda t: t != ""))


def section(blocks: Column, kind: str | None, most: int = 1800, patterns: list[str] | None = None, combine: bool = False) -> Column:
    """The text under headings of `kind`, or under headings that hold one of `patterns`.

    Candidates: each run of content after such a heading, up to any other heading, role or notice.
    With combine all of them in order, each line once; else the latest of those that a canonical
    heading opened, if any did, and of all otherwise.
    """
    candidate = "array<struct<prio:int,start:int,out:array<string>>>"
    zero = F.struct(F.lit(False).alias("on"), F.lit(0).alias("prio"), F.lit(-1).alias("start"), F.array().cast(EMPTY).alias("out"), F.array().cast(candidate).alias("done"))

    def state(on: Column, prio: Column, start: Column, out: Column, done: Column) -> Column:
        return F.struct(on.alias("on"), prio.alias("prio"), start.alias("start"), out.alias("out"), done.alias("done"))

    def closed(a: Column) -> Column:
        return F.concat(a["done"], F.array(F.struct(a["prio"].alias("prio"), a["start"].alias("start"), a["out"].alias("out"))))

    def step(a: Column, x: Column) -> Column:
        heading = x["kind"].startswith("heading")
        target = x["logical"].eqNullSafe(F.lit(kind)) if kind else heading & x["h"].rlike(java("|".join(patterns or [])))  # never a notice line
        same = x["logical"].eqNullSafe(F.lit(kind) if kind else F.lit(None).cast("string"))
        none = F.array().cast(EMPTY)
        ends = x["notice"]
        if kind in ("duties", "audience", "preferred"):
            ends = ends | is_full(rules.URL_ONLY, x["text"]) | is_full(rules.HOMEPAGE, x["text"])
        opened = F.when(is_full(rules.CANONICAL, x["h"]), 2).otherwise(1)
        stops = x["logical"].isNotNull() | heading | x["role"]
        return (
            F.when(target & ~a["on"], state(F.lit(True), opened, x["i"], none, a["done"]))
            .when(~a["on"], a)
            .when(stops & same & (F.size(a["out"]) == 0), a)
            .when(~stops & x["skip"], a)
            .when(stops | ends, state(target, a["prio"], F.when(target, x["i"]).otherwise(a["start"]), none, closed(a)))
            .otherwise(state(F.lit(True), a["prio"], a["start"], F.concat(a["out"], F.array(x["text"])), a["done"]))
        )

    found = F.aggregate(blocks, zero, step, lambda a: F.when(a["on"], closed(a)).otherwise(a["done"]))
    if combine:
        chosen = combined(F.transform(found, lambda c: F.filter(F.transform(c.out, clean_text), lambda t: ~decoration_only(t))))
    else:
        chosen = F.coalesce(F.array_max(F.transform(found, lambda c: F.struct(c.prio.alias("prio"), c.start.alias("start"), c.out.alias("out")))).out, F.array().cast(EMPTY))
    return join_complete_lines(F.filter(chosen, lambda t: ~decoration_only(t)), most)


def key_duties(blocks: Column, job: Column) -> Column:
    other = [r"활동\s*내용", r"프로그램\s*내용", r"공모\s*주제", r"모집\s*분야", r"주요\s*활동"]
    return F.when(job, section(blocks, "duties")).otherwise(section(blocks, None, patterns=other))


def essay_questions(blocks: Column) -> Column:
    """Blank where all lines only ask for a cover letter."""
    found = section(blocks, "essay")
    asked = lambda t: F.exists(lines(t), lambda x: (x != "") & ~is_full(rules.ESSAY_SUBMISSION, x))
    return let(found, lambda t: F.when(asked(t), t).otherwise(""))


def pre_assignment(blocks: Column) -> Column:
    """The first assignment section; further assignment headings before its content are content if their text differs."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("first"), F.array().cast(EMPTY).alias("out"))

    def step(a: Column, x: Column) -> Column:
        is_task = x["logical"].eqNullSafe(F.lit("assignment"))
        state = lambda at, first, out: F.struct(F.lit(at).alias("at"), first.alias("first"), out.alias("out"))
        more = F.concat(a["out"], F.array(x["h"]))
        return (
            F.when((a["at"] == 0) & is_task, state(1, x["h"], a["out"]))
            .when(a["at"] != 1, a)
            .when(is_task & (F.size(a["out"]) == 0), F.when((x["h"] != "") & (x["h"] != a["first"]), state(1, a["first"], more)).otherwise(a))
            .when(x["logical"].isNotNull() | x["kind"].startswith("heading"), state(2, a["first"], a["out"]))
            .when(x["skip"], a)
            .otherwise(state(1, a["first"], F.concat(a["out"], F.array(x["text"]))))
        )

    return join_complete_lines(F.aggregate(blocks, zero, step, lambda a: a["out"]), 1800)


def structured(blocks: Column, job: Column) -> dict[str, Column]:
    """The six sections as columns over the labelled blocks."""
    return {
        "key_duties": key_duties(blocks, job),
        "target_audience": F.when(job, F.lit("")).otherwise(section(blocks, "audience", 1200)),
        "qualifications": F.when(job, section(blocks, "audience", combine=True)).otherwise(F.lit("")),
        "preferred_qualifications": section(blocks, "preferred"),
        "essay_questions": essay_questions(blocks),
        "pre_assignment": pre_assignment(blocks),
    }


def benefits(blocks: Column) -> Column:
    return section(blocks, "benefits", 1200)


def has_section(blocks: Column, kind: str) -> Column:
    return F.exists(blocks, lambda b: b.logical.eqNullSafe(F.lit(kind)))


def heading_candidates(blocks: Column) -> Column:
    """Short blocks with their place, normalized text and section; the audience section is shown as qualifications."""
    short = F.filter(blocks, lambda b: F.length(b.text) <= 100)
    shown = lambda b: F.when(b.logical == "audience", "qualifications").otherwise(b.logical)
    return F.transform(short, lambda b: F.struct(b.i.alias("index"), b.kind.alias("kind"), b.text.alias("text"), b.h.alias("normalized"), shown(b).alias("section")))
