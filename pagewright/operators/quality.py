"""Data quality of a record: ten reasons to look at it again."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from pagewright.functions import rules
from pagewright.functions.rules import is_full, is_leak
from pagewright.functions.text import all_text, clean_text, decoration_only, heading_text, lines
from pagewright.operators.sections import has_section, role_marker
from pagewright.plans.repeats import unresolved

REASONS = (
    "suspicious_title missing_body missing_job_duties image_only_content unresolved_repetition empty_qualifications_section "
    "empty_preferred_section empty_essay_questions_section empty_pre_assignment_section inconsistent_structured_sections"
).split()


def unresolved_repetition(blocks: Column) -> Column:
    """Whether a section between headings repeats a long run; only pages of eight blocks or more can, so others skip Python's work."""

    @F.pandas_udf(T.BooleanType())
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(lambda bs: unresolved([(b["kind"], b["text"]) for b in bs]) if bs is not None and len(bs) >= 8 else False)

    return run(blocks)


def consistent(blocks: Column, sections: dict[str, Column]) -> Column:
    """Every section line starts a body line, and the core sections hold nothing that is no content. blocks: labelled."""
    cleaned = lambda text: F.filter(F.transform(lines(text), clean_text), lambda x: x != "")
    body = F.array_distinct(F.filter(F.transform(blocks, lambda b: b.text), lambda t: t != ""))
    ok = F.lit(True)
    for text in sections.values():
        ok = ok & F.forall(cleaned(text), lambda x: F.exists(body, lambda b: F.startswith(b, x)))
    for name in ("key_duties", "qualifications", "preferred_qualifications"):
        bad = lambda x: is_leak(x) | role_marker(F.lit("paragraph"), heading_text(x))
        ok = ok & ~F.exists(cleaned(sections[name]), bad)
    return ok


def reasons(title: Column, job: Column, blocks: Column, labelled: Column, had_images: Column, sections: dict[str, Column], no_title: str) -> Column:
    """struct of the ten booleans, in the order of REASONS."""
    s = sections
    empty = lambda kind, *names: has_section(labelled, kind) & (F.concat(*[s[n] for n in names]) == "")
    found = {
        "suspicious_title": (title == no_title) | is_full(rules.SECTION_TITLE, title),
        "missing_body": F.size(blocks) == 0,
        "missing_job_duties": job & (s["key_duties"] == ""),
        "image_only_content": had_images & (F.length(all_text(blocks)) < 300),
        "unresolved_repetition": unresolved_repetition(blocks),
        "empty_qualifications_section": empty("audience", "qualifications", "target_audience"),
        "empty_preferred_section": empty("preferred", "preferred_qualifications"),
        "empty_essay_questions_section": empty("essay", "essay_questions"),
        "empty_pre_assignment_section": empty("assignment", "pre_assignment"),
        "inconsistent_structured_sections": (F.size(F.filter(labelled, lambda b: b.role)) >= 2) | ~consistent(labelled, s),
    }
    return F.struct(*[F.coalesce(found[n], F.lit(False)).alias(n) for n in REASONS])


def collection_status(reasons: Column) -> Column:
    any_one = F.lit(False)
    for n in REASONS:
        any_one = any_one | reasons[n]
    return F.when(any_one, "검토 필요").otherwise("정상")


def warnings(blocks: Column, kind: Column, employment: Column) -> Column:
    """What a run reports about a record that it keeps."""
    return F.array_compact(
        F.array(
            F.when(F.size(blocks) == 0, "empty_body"),
            F.when(kind == "기타·확인 필요", "unclassified"),
            F.when((kind == "채용공고") & (F.size(employment) == 0), "no_employment_type"),
        )
    )
