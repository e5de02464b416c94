"""Text functions. Each works on a Column; those the HTML edge needs too have a Python twin of the same name plus `_py`.

Null text counts as empty everywhere, as the records hold no null text.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

#: A character that only decorates a heading: white space, joiners, marks, punctuation, symbols.
DECORATION = r"[\s\x{200D}\p{M}\p{P}\p{S}]"


def let(value: Column, body) -> Column:
    """body(value), with value in the plan and worked out once however often body uses it."""
    return F.transform(F.array(value), body)[0]


def clean_text(text: Column) -> Column:
    """White space put in order; character references stay (see clean_markup)."""
    t = F.translate(F.coalesce(text, F.lit("")), "\u200b\ufeff", "")
    for pattern, by in ((r"[\t\r\f\x0B]+", " "), (" {2,}", " "), (r"\n +", "\n"), (r" +\n", "\n"), (r"\n{3,}", "\n\n")):
        t = F.regexp_replace(t, pattern, by)
    return F.regexp_replace(t, r"(?U)\A\s+|\s+\z", "")


def trimmed(text: Column) -> Column:
    """text without space characters of any kind (Zs) at its ends; tabs and line ends stay."""
    return F.regexp_replace(text, r"\A\p{Zs}+|(?<!\p{Zs})\p{Zs}+\z", "")


def clean_text_py(text: str | None) -> str:
    t = html.unescape(text or "").replace("\u200b", "").replace("\ufeff", "")
    # a pattern is only looked for where the text holds its shortest match
    if "\t" in t or "\r" in t or "\f" in t or "\v" in t:
        t = re.sub(r"[\t\r\f\v]+", " ", t)
    for held, pattern, by in (("  ", " {2,}", " "), ("\n ", r"\n +", "\n"), (" \n", r" +\n", "\n"), ("\n\n\n", r"\n{3,}", "\n\n")):
        if held in t:
            t = re.sub(pattern, by, t)
    return t.strip()


@F.pandas_udf(T.StringType())
def _unescaped(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda x: html.unescape(x) if x is not None else x)


def clean_markup(text: Column) -> Column:
    """clean_text with character references resolved first; only texts with an ampersand go through Python's table."""
    return clean_text(_unescaped(text))


def is_decoration(ch: str) -> bool:
    return ch.isspace() or ch == "\u200d" or unicodedata.category(ch)[0] in "MPS"


def decoration_only(text: Column) -> Column:
    return clean_text(text).rlike(rf"(?U)\A{DECORATION}+\z")


def decoration_only_py(text: str) -> bool:
    t = clean_text_py(text)
    return t != "" and all(map(is_decoration, t))


def heading_text(text: Column) -> Column:
    """Text without decoration at both ends and with straight apostrophes."""
    plain = F.translate(clean_text(text), "’‘ʼ", "'''")
    return clean_text(F.regexp_replace(plain, rf"(?U)\A{DECORATION}+|{DECORATION}+\z", ""))


def heading_text_py(text: str) -> str:
    t = clean_text_py(text).translate({ord(c): "'" for c in "’‘ʼ"})
    inside = [i for i, c in enumerate(t) if not is_decoration(c)]
    return clean_text_py(t[inside[0] : inside[-1] + 1]) if inside else ""


#: Line-leading bullets; dashes need a space.
COMPACT_BULLET = r"\A[ㆍ•·]\s*(\S.*)\z"
SPACED_BULLET = r"\A[\-–—]\s+(\S.*)\z"


def bullet_text(text: Column) -> Column:
    """What follows a bullet, null without one."""

    def of(t: Column) -> Column:
        found = [F.nullif(F.regexp_extract(t, "(?Ud)" + p, 1), F.lit("")) for p in (COMPACT_BULLET, SPACED_BULLET)]
        return let(F.coalesce(*found), lambda x: F.when(x.isNotNull(), clean_text(x)))

    return let(clean_text(text), of)


def bullet_text_py(text: str) -> str | None:
    t = clean_text_py(text)
    found = re.match(COMPACT_BULLET.replace(r"\z", "$").replace(r"\A", ""), t) or re.match(SPACED_BULLET.replace(r"\z", "$").replace(r"\A", ""), t)
    return clean_text_py(found[1]) if found else None


def all_text(blocks: Column) -> Column:
    """The non-empty block texts, one a line."""
    return F.array_join(F.filter(F.transform(blocks, lambda b: b.text), lambda t: t != ""), "\n")


def text_length(blocks: Column) -> Column:
    return F.aggregate(blocks, F.lit(0), lambda n, b: n + F.length(b.text))


def truncate_at_boundary(text: Column, most: int) -> Column:
    """text up to the last white space or sentence end within `most` characters, cut hard where there is none."""

    def cut(t: Column) -> Column:
        prefix = F.left(t, F.lit(most + 1))
        ends = F.array(*[F.regexp_extract(prefix, rf"(?sU)\A(.*{end})", 1) for end in (r"\s", r"[.!?。！？](?=\s|\z)")])
        longest = let(ends, lambda e: F.when(F.length(e[0]) >= F.length(e[1]), e[0]).otherwise(e[1]))
        return F.when(F.length(t) <= most, t).otherwise(clean_text(let(longest, lambda x: F.when(x != "", x).otherwise(F.left(t, F.lit(most))))))

    return let(text, cut)


def join_complete_lines(lines: Column, most: int) -> Column:
    """The longest run of leading lines whose joined length is at most `most`; a first line that is longer is truncated."""
    zero = F.struct(F.lit(-1).alias("n"), F.array().cast("array<string>").alias("out"), F.lit(True).alias("go"))

    def step(acc: Column, x: Column) -> Column:
        n = acc["n"] + 1 + F.length(x)
        fits = acc["go"] & (n <= most)
        return F.struct(F.when(fits, n).otherwise(acc["n"]).alias("n"), F.when(fits, F.concat(acc["out"], F.array(x))).otherwise(acc["out"]).alias("out"), fits.alias("go"))


    def joined(every: Column) -> Column:
        kept = F.aggregate(every, zero, step, lambda acc: acc["out"])
        first = F.get(every, F.lit(0))
        return F.when(F.length(first) > most, truncate_at_boundary(first, most)).otherwise(F.array_join(kept, "\n"))

    return clean_text(let(lines, joined))


def line_value(text: Column, labels: str, most: int = 500) -> Column:
    """What follows the first of `labels` on its line, two characters at least."""
    # Fixed value: a label, a colon and the value.
    return F.left(clean_text(F.regexp_extract(text, rf"(?iuU)(?:{labels})\s*[:：]?\s*([^\n]{{2,{most}}})", 1)), F.lit(most))


def organizer(text: Column) -> Column:
    # Labels.
    return clean_text(F.regexp_extract(text, r"(?U)(?:주최|주관|운영기관|기관명)\s*[:：]\s*([^\n]{2,80})", 1))


def location(text: Column) -> Column:
    # Labels.
    return line_value(text, r"근무지|근무\s*장소|활동\s*지역|근무\s*지역|근무장소|근무주소", 250)


def activity_period(text: Column) -> Column:
    # Labels.
    return line_value(text, r"활동\s*기간|교육\s*기간|프로그램\s*기간|인턴\s*기간", 500)


def split_title(title: Column, body: Column, generic: list[str]) -> Column:
    """struct<organization, role>: the two sides of the first separator there is, tried in this order."""
    out = F.struct(organizer(body).alias("organization"), title.alias("role"))
    for sep in reversed(["｜", "|", " – ", " - "]):
        at = F.instr(title, sep)
        left = clean_text(F.substr(title, F.lit(1), at - 1))
        right = clean_text(F.substr(title, at + len(sep)))
        side = F.struct(F.when(left.isin(generic), organizer(body)).otherwise(left).alias("organization"), F.when(right == "", title).otherwise(right).alias("role"))
        out = F.when(at > 0, side).otherwise(out)
    return out


# Fixed value: what separates roles.
ROLE_SEPARATOR = r"\s*(?:,|/|·|•|\||\b및\b)\s*"


def role_fragments(role: Column) -> Column:
    """The parts of a delimited role list; none without a delimiter."""
    parts = F.transform(F.split(role, "(?U)" + ROLE_SEPARATOR, -1), clean_text)

    def trimmed(x: Column) -> Column:
        # What is trimmed from a role.
        for pattern in (r"\A[\s()\[\]{}]+|[\s()\[\]{}]+\z", r"\s*(?:등\s*)?(?:신입\s*및\s*경력)?채용\s*\z", r"\s*등\s*모집\s*\z"):
            x = F.regexp_replace(x, "(?U)" + pattern, "")
        return x

    parts = F.transform(parts, trimmed)
    return F.when(role.rlike("(?U)" + ROLE_SEPARATOR), F.filter(parts, lambda x: x != "")).otherwise(F.array().cast("array<string>"))


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]", -1)


def wrap(text: Column, most: int = 1900) -> Column:
    """Chunks of at most `most` characters, cut at the last line feed, space or sentence end; the rest loses leading white space."""

    def cut(s: str | None) -> list[str]:
        out, rest = [], s or ""
        while len(rest) > most:
            at = max(rest.rfind("\n", 0, most + 1), rest.rfind(" ", 0, most + 1), rest.rfind(". ", 0, most + 1) + 1)
            at = at if at >= 1 else most
            out.append(rest[:at])
            rest = rest[at:].lstrip()
        return [*out, rest] if rest else out

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def long(parts: pd.Series) -> pd.Series:
        return parts.map(cut)

    short = F.when(F.length(text) > 0, F.array(text)).otherwise(F.array().cast("array<string>"))
    return F.when(F.length(text) > most, long(text)).otherwise(short)
