"""Dates: published day, deadline and open or closed status, against an explicit run date."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pagewright.functions.rules import java
from pagewright.functions.text import clean_text, lines

# How dates are written, and the lines that hold deadlines.
FULL = r"(20\d{2})\s*[년./-]\s*(\d{1,2})\s*[월./-]\s*(\d{1,2})\s*일?"
SHORT = r"(?<!\d)(\d{1,2})\s*[월./-]\s*(\d{1,2})\s*일?"
TOKEN = r"((?:20\d{2}\s*[년./-]\s*)?\d{1,2}\s*[월./-]\s*\d{1,2}\s*일?)"
DEADLINE_LINE = r"마감|접수\s*기간|지원\s*기간|모집\s*기간|신청\s*기간|접수기간|지원기간"


def day(year: Column, month: Column, dom: Column) -> Column:
    """A date, null where there is none such."""
    return F.try_to_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(dom.cast("string"), 2, "0")), "yyyy-MM-dd")


def published_date(raw: Column) -> Column:
    """The local day of a timestamp, its offset not applied; else the first day written in it."""
    iso = F.try_to_date(F.regexp_extract(raw, r"\A(\d{4}-\d{2}-\d{2})(?:\z|[T ]\d{2}:?\d{2})", 1), "yyyy-MM-dd")
    g = lambda n: F.regexp_extract(raw, r"(20\d{2})[-./](\d{1,2})[-./](\d{1,2})", n)
    return F.coalesce(iso, day(g(1), g(2), g(3)))


def date_token(token: Column, year: Column) -> Column:
    """A full date, or month and day in the reference year."""
    full = lambda n: F.regexp_extract(token, "(?U)" + FULL, n)
    short = lambda n: F.regexp_extract(token, "(?U)" + SHORT, n)
    return F.when(full(1) != "", day(full(1), full(2), full(3))).otherwise(F.when(short(1) != "", day(year, short(1), short(2))))


def deadline(body: Column, published: Column, as_of: Column) -> Column:
    """The last date of the first deadline line (with the next three) that has one; over 180 days before publication means next year."""
    year = F.coalesce(F.year(published), F.year(as_of))
    ls = F.transform(lines(body), clean_text)

    def over(every: Column) -> Column:
        joined = F.transform(every, lambda x, i: F.when(x.rlike(java(DEADLINE_LINE)), F.array_join(F.slice(every, i + 1, F.lit(4)), " ")))
        dates = F.transform(F.array_compact(joined), lambda x: F.array_compact(F.transform(F.regexp_extract_all(x, F.lit("(?U)" + TOKEN), F.lit(1)), lambda t: date_token(t, year))))
        first = F.get(F.filter(dates, lambda d: F.size(d) > 0), F.lit(0))
        return F.get(first, F.size(first) - 1)

    found = F.transform(F.array(ls), over)[0]
    later = F.coalesce(day(F.year(found) + 1, F.month(found), F.dayofmonth(found)), found)
    return F.when(F.datediff(published, found) > 180, later).otherwise(found)


def status(title: Column, body: Column, until: Column, as_of: Column) -> Column:
    """Closed if the text says so in its lead or the deadline has passed, else open."""
    lead = F.concat(title, F.lit("\n"), F.left(body, F.lit(2500)))
    # What says that a posting is closed.
    ended = r"(?:^|\n)\s*(?:지원\s*종료|모집\s*종료|채용\s*마감|접수(?:가|는)?\s*종료(?:되었습니다)?|지원(?:이)?\s*종료(?:되었습니다)?)\s*[.!！。]?\s*(?:$|\n)"
    said = lead.rlike(java(r"마감된\s*공고|공고는\s*비공개")) | lead.rlike(java(ended))
    return F.when(said | F.coalesce(until < as_of, F.lit(False)), "마감").otherwise("모집 중")
