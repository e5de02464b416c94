"""Section kinds of headings, and the predicates over lines, generated from the vocabulary.

Patterns are written once, in the syntax that Python and Java share; `java()` adds the flags that
give them Unicode meaning in Spark.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, functions as F

from pagewright.functions.text import clean_text, clean_text_py, decoration_only, heading_text, heading_text_py, let
from pagewright.functions.vocabulary import SECTION_BOUNDARY_HEADINGS, SECTION_HEADINGS

KINDS = tuple(SECTION_HEADINGS)


def java(pattern: str, full: bool = False) -> str:
    return "(?iuUd)" + (rf"\A(?:{pattern})\z" if full else pattern)


def loose(value: str) -> str:
    """The value as a pattern in which each space stands for any white space or none."""
    return "".join(r"\s*" if c == " " else c if c.isalnum() else "\\" + c for c in value)


def ahead(values: list[str], others: str = "") -> str:
    """A look-ahead for the first two characters of the values in loose(), or one of others: most places of a text fail it at once."""
    seconds: dict[str, set[str]] = {c: {""} for c in others}
    for v in values:
        seconds.setdefault(v[0], set()).add(v[1:2].strip())
    either = lambda cs: "[" + "".join(map(re.escape, sorted(cs))) + "]"
    pairs = "|".join(re.escape(a) + ("" if "" in bs else either(bs)) for a, bs in sorted(seconds.items()))
    return rf"(?={either(seconds)})(?={pairs})"


#: kind -> alternatives, as they are and with decoration trimmed
PATTERNS = {k: [loose(v) for v in vs] for k, vs in SECTION_HEADINGS.items()}
EXACT = {k: "|".join(loose(heading_text_py(v)) for v in vs) for k, vs in SECTION_HEADINGS.items()} | {"boundary": "|".join(map(loose, SECTION_BOUNDARY_HEADINGS))}
TITLES = "|".join(sorted((p for ps in PATTERNS.values() for p in ps), key=len, reverse=True))
# The forms of section titles and bracketed parts.
#: A whole line that is a section title, with or without brackets and colon.
SECTION_TITLE = rf"\s*[\[(]?\s*(?:{TITLES})\s*(?:\([^)]*\))?\s*[:：]?\s*[\])]?\s*"
INLINE_TITLE = rf"{ahead([v for vs in SECTION_HEADINGS.values() for v in vs], '[')}(?:\[\s*(?:{TITLES})\s*\]|(?:{TITLES}))"

# Fixed values: (longest, pattern, kind) of headings that are sentences.
SENTENCES = [
    (60, r".+?(?:디자이너|Designer|디자인\s*직무|디자인\s*팀)(?:는|은)\s*이렇게\s*일해요", "duties"),
    (60, r".+?에서는\s*이런\s*일을\s*해요", "duties"),
    (80, r".+?는\s*두\s*가지\s*방식으로\s*지원할\s*수\s*있어요", "boundary"),
    (100, r".+?로서\s*하게\s*될\s*일은\s*다음과\s*같습니다", "duties"),
    (10**6, r"(?:Design|Service\s*&\s*Business)\s*>.*", "boundary"),
]
# Fixed value: what stands in brackets.
BRACKETED = r"[\(（【\[]\s*([^\)）】\]]{2,50})\s*[\)）】\]]"
# Patterns of lines that are never section content, or mean something of their own.
URL_ONLY = r"(?:https?://|www\.)\S+"
LEAK = r"(?:사전과제\s*확인하기|※?\s*지원\s*시\s*직군\s*/\s*직무\s*설정|직군\s*/\s*직무\s*설정|(?:Design|Service\s*&\s*Business)\s*>.*)"
RESUME_GUIDANCE = r"(?:이력서|지원서).*?(?:작성|기재)|개인\s*인적\s*사항.*?(?:시기|기재)|학력.*?대외활동.*?인턴.*?(?:시기|작성|기재)"
ESSAY_SUBMISSION = r"(?:(?:국문\s*)?이력서\s*(?:및|와|,)?\s*)?(?:자유\s*양식\s*)?자기\s*소개서\s*(?:제출|첨부|파일)?(?:해\s*주세요|필수)?[.!]?"
TRAILING_NOISE = (
    r"(?:최신\s*댓글|추천\s*(?:아티클|콘텐츠|공고)|오늘\s*핫한\s*공고|함께\s*보면\s*좋은\s*커리어\s*정보|관련\s*공고|카톡\s*(?:채팅방|오픈채팅)|"
    r"공유\s*(?:안내|하기)|댓글\s*(?:남기기|목록))"
)
DATE_NOTICE = r"(?:게시일|등록일|접수\s*(?:기간|마감)|지원(?:서)?\s*(?:기간|접수\s*마감)|마감일|마감\s*기한|근무\s*(?:지|장소|조건))\s*[:：]?"
HOMEPAGE = r".*홈페이지.*(?:블로그|SNS).*"
CANONICAL = r"(?:주요|담당|수행)\s*업무|업무\s*내용|자격\s*요건|지원\s*자격|지원자격|공통\s*지원\s*자격|우대\s*사항|우대\s*요건|우대\s*자격"
ROLE_MARKER = r"\s*(?:\d{1,2}[.)]\s*)?(?=\S)(?:.*?)(?:디자이너|디자인|UI\s*/?\s*UX|그래픽|BX|브랜드|일러스트)(?:.*?)(?:인턴|디자이너|직무|부문)\s*"
NUMBERED_JOB = r"\s*(\d{1,2})[.)]\s*\S.{0,100}(?:인턴|디자이너|매니저|개발|기획|마케팅|직무|채용)\s*"
APPLY_LABEL = r"지원(?:하러\s*가기|하기)"


@lru_cache(maxsize=512)
def compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern, re.I)


def full_py(pattern: str, text: str) -> bool:
    return compiled(pattern).fullmatch(text) is not None


@lru_cache(maxsize=50_000)
def section_kind_py(text: str) -> str | None:
    t = clean_text_py(text)
    tried = [heading_text_py(x) for x in re.findall(BRACKETED, t)] + [heading_text_py(t)]
    for c in filter(None, tried):
        for kind, pattern in EXACT.items():
            if full_py(pattern, c):
                return kind
    return next((kind for most, pattern, kind in SENTENCES if tried[-1] and len(tried[-1]) <= most and full_py(pattern, tried[-1])), None)


def section_kind(text: Column) -> Column:
    """Kind of a heading, `boundary`, or null. Bracketed parts are tried first, then the whole, then the sentences."""

    def of(c: Column) -> Column:
        out = F.lit(None).cast("string")
        for kind, pattern in reversed(EXACT.items()):
            out = F.when(c.rlike(java(pattern, full=True)), F.lit(kind)).otherwise(out)
        return out

    def sentence(whole: Column) -> Column:
        out = F.lit(None).cast("string")
        for most, pattern, kind in reversed(SENTENCES):
            out = F.when((F.length(whole) <= most) & whole.rlike(java(pattern, full=True)), F.lit(kind)).otherwise(out)
        return F.when(whole != "", out)

    def over(t: Column) -> Column:
        inner = F.transform(F.regexp_extract_all(t, F.lit(java(BRACKETED)), F.lit(1)), heading_text)
        tried = F.concat(inner, F.array(heading_text(t)))
        return let(tried, lambda cs: F.coalesce(F.get(F.filter(F.transform(cs, of), lambda k: k.isNotNull()), F.lit(0)), let(F.element_at(cs, -1), sentence)))

    return let(clean_text(text), over)


def joined_kind(pieces: Column) -> Column:
    """Kind of a heading that is split over neighbouring blocks; pieces: their heading texts, null beyond the ends."""
    ok = F.forall(pieces, lambda p: F.coalesce((p != "") & (F.length(p) <= 30), F.lit(False)))
    kind = lambda w: F.when(w.rlike(java(r"지원\s*자격\s*요건", full=True)), F.lit("audience")).otherwise(section_kind(w))
    return F.when(ok, let(F.array_join(pieces, " "), kind))


def is_full(pattern: str, text: Column) -> Column:
    return text.rlike(java(pattern, full=True))


def is_leak(line: Column) -> Column:
    return decoration_only(line) | is_full(URL_ONLY, line) | is_full(LEAK, line) | section_kind(line).isNotNull()
