"""Classifiers: ordered first-match rules and multi-label taggers as single expressions over the row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pagewright.functions.rules import NUMBERED_JOB, RESUME_GUIDANCE, is_full, java
from pagewright.functions.text import clean_text, lines, role_fragments

CONTEST, JOB, ACTIVITY, EDUCATION, CAREER, OTHER = "공모전", "채용공고", "대외활동", "교육·프로그램", "커리어 콘텐츠", "기타·확인 필요"

# Design fields and the words that show them, in output order.
DESIGN_FIELDS = [
    ("UI/UX", r"ui\s*/?\s*ux|ux\s*/?\s*ui|사용자 경험|인터페이스"),
    ("프로덕트", r"프로덕트\s*디자|product\s*design"),
    ("BX/브랜드", r"\bbx\b|브랜드\s*디자|브랜딩|brand(?:ing)?\s*design"),
    ("그래픽", r"그래픽\s*디자|graphic\s*design"),
    ("콘텐츠", r"콘텐츠\s*디자|content\s*design|sns\s*콘텐츠"),
    ("영상/모션", r"영상|모션|motion|video|릴스"),
    ("VMD", r"\bvmd\b|비주얼\s*머천"),
    ("패키지", r"패키지\s*디자|package\s*design"),
    ("공간/무대", r"인테리어(?:\s*디자인)?|interior\s*design|공간\s*디자|무대\s*디자|전시\s*디자|spatial"),
    ("웹", r"웹\s*디자|web\s*design"),
    ("캐릭터/일러스트", r"캐릭터|일러스트|illustrat|만화|웹툰|comic"),
    ("산업/제품", r"산업\s*디자|제품\s*디자|industrial\s*design"),
    ("패션", r"패션\s*디자|fashion\s*design"),
]
# Words that make a content type.
CONTEST_WORDS = r"공모전|컨테스트|콘테스트|competition|contest|(?:design.*challenge|challenge.*design)"
JOB_WORDS = r"채용|인턴|신입|경력|디자이너|designer|아르바이트|알바|정규직|계약직|developer|engineer|manager|scientist|assistant|\bRA\b"
JOB_URL = r"(?:/careers?(?:/|$)|/career/job-detail|/jobs?(?:/|$)|/job_posting/|greetinghr\.com|greenhouse\.io|recruit|careers)"
ACTIVITY_WORDS = r"대외활동|서포터즈|기자단|앰배서더|크루\s*모집|봉사단"
EDUCATION_WORDS = r"교육|부트캠프|아카데미|워크숍|세미나|멘토링"
EDITORIAL_WORDS = r"인터뷰|포트폴리오|취업토크|커리어|노하우|필요한가\??|하는 법"
# Roles inside and outside the scope.
DESIGN_ROLE = (
    r"(?:디자이너|일러스트레이터|디자인\s*(?:직무|인턴|어시스턴트)|"
    r"(?:프로덕트|제품|UI\s*/?\s*UX|UX\s*/?\s*UI|UI|UX|비주얼|그래픽|콘텐츠|브랜드|BX|모션|캐릭터|공간|패션)\s*디자인(?:\s*(?:직무|인턴))?|"
    r"Product\s+Designer|Visual\s+Designer|Graphic\s+Designer|UI\s+Designer|UX\s+Designer|"
    r"Brand(?:ing)?\s+Designer|Creative\s+Designer|Content\s+Designer|Motion\s+Designer|"
    r"Design\s+Assistant|Design\s+Intern|디자인\s*센터.*인턴|마케팅\s*디자인\s*담당자|"
    r"(?:UXUI|UX\s*/\s*UI|UI\s*/\s*UX)\s*QA|디자인\s*QA|Design\s*QA|UXUI\s*업무\s*보조)"
)
NON_DESIGN_ROLE = (
    r"(?:Developer|Engineer|Software\s+Engineer|Research\s+Scientist|Research\s+Assistant|\bRA\b|"
    r"Data\s+Scientist|ML\s+Engineer|AI\s+Engineer|Product\s+Manager|Product\s+Owner|Marketer|"
    r"Marketing|Sales|Operation|Planning|개발자|엔지니어|연구원|마케터|컨서베이터|큐레이터|"
    r"영업\s*담당|인사\s*담당|재무\s*담당|(?<![A-Za-z])MD(?![A-Za-z])|(?<![A-Za-z])(?:BI\s*)?PM(?![A-Za-z]))"
)
DESIGN_PROGRAM = (
    r"(?:디자인|디자이너|UI\s*/?\s*UX|UX\s*/?\s*UI|시각디자인|프로덕트\s*디자인|"
    r"그래픽|일러스트|Illustration|만화|웹툰|포스터|캐릭터|시각\s*창작|제품\s*디자인|"
    r"공간\s*디자인|패키지\s*디자인|Product\s+Design|Visual\s+Design|Graphic\s+Design|(?<![A-Za-z])Design(?![A-Za-z]))"
)
GENERIC_ROLE = r"(?:관리|마케팅|영업|기획|운영|개발|연구|인사|재무)(?:\s*(?:직무|직군|부문|담당|매니저))?"
DESIGN_FRAGMENT = r"(?:디자인|UX|UI|UI\s*/?\s*UX|UX\s*/?\s*UI|브랜드|콘텐츠|그래픽|모션|비주얼|프로덕트|Product\s+Design|Visual\s+Design|Graphic\s+Design)"
# Application paths.
SERVICE_PATH, DESIGN_PATH = r"\AService\s*&\s*Business\s*>", r"\ADesign\s*>"


def has(text: Column, pattern: str) -> Column:
    return text.rlike(java(pattern))


def has_cased(text: Column, pattern: str) -> Column:
    return text.rlike("(?Ud)" + pattern)


def any_of(values: Column, *names: str) -> Column:
    return F.arrays_overlap(values, F.array(*map(F.lit, names)))


def labels(text: Column, table: list[tuple[str, str]]) -> Column:
    """The labels whose pattern occurs, in table order."""
    return F.array_compact(F.array(*[F.when(has(text, p), F.lit(name)) for name, p in table]))


def content_type(title: Column, categories: Column, body: Column, apply_url: Column) -> Column:
    both = F.lower(F.concat(title, F.lit("\n"), F.left(body, F.lit(5000))))
    return (
        F.when(has_cased(both, CONTEST_WORDS), CONTEST)
        .when(any_of(categories, "신입/인턴", "주니어경력") | has(title, JOB_WORDS) | F.coalesce(has(apply_url, JOB_URL), F.lit(False)), JOB)
        .when(has_cased(both, ACTIVITY_WORDS), ACTIVITY)
        .when(any_of(categories, "교육/대외활동") & has_cased(both, EDUCATION_WORDS + "|과정|프로그램"), EDUCATION)
        .when(has_cased(title, EDITORIAL_WORDS) | any_of(categories, "커리어TV", "취업토크"), CAREER)
        .when(has_cased(both, EDUCATION_WORDS), EDUCATION)
        .otherwise(OTHER)
    )


def design_fields(title: Column, text: Column) -> Column:
    return labels(F.lower(F.concat(title, F.lit("\n"), F.left(text, F.lit(4000)))), DESIGN_FIELDS)


def experience(title: Column, categories: Column, body: Column, kind: Column) -> Column:
    """struct<class, raw>: the first rule that holds."""
    useful = F.filter(lines(F.left(body, F.lit(8000))), lambda x: ~has(x, RESUME_GUIDANCE))
    text = F.array_join(F.concat(F.array(title), useful), "\n")
    first = lambda p: F.nullif(F.regexp_extract(text, "(?Ud)" + p, 0), F.lit(""))
    # How experience is written.
    span = first(r"신입\s*[~·/및-]+\s*(\d+)\s*년")
    either = first(r"경력\s*무관|신입\s*[·/&및]+\s*경력")
    years = first(r"(?:경력|실무\s*경험|관련\s*경험)\s*[:：]?\s*(\d+)\s*년(?:\s*(?:이상|이하|~\s*\d+\s*년))?|(?<!\d)(\d{1,2})\s*년\s*(?:이상|이하)\s*(?:경력|경험)?")
    out = lambda c, raw: F.struct(F.lit(c).alias("class"), raw.alias("raw"))
    entry = any_of(categories, "신입/인턴")
    return (
        F.when(kind != JOB, out("해당 없음", F.lit("")))
        .when(span.isNotNull(), out("경력무관", clean_text(span)))
        .when(either.isNotNull(), out("경력무관", clean_text(either)))
        .when(years.isNotNull(), out("경력", clean_text(years)))
        .when(title.contains("인턴") | (entry & text.contains("인턴")), out("인턴", F.lit("인턴")))
        .when(text.contains("신입") | entry, out("신입", F.lit("신입")))
        .when(any_of(categories, "주니어경력") | title.contains("경력"), out("경력", F.lit("경력")))
        .otherwise(out("확인 필요", F.lit("")))
    )


# Employment types and the words that show them.
EMPLOYMENT = [
    ("정규직", r"정규직"),
    ("계약직", r"계약직"),
    ("인턴", r"체험형\s*인턴|(?<!전환형\s)인턴"),
    ("전환형 인턴", r"전환형\s*인턴|채용\s*연계형\s*인턴"),
    ("프리랜서", r"프리랜서"),
    ("아르바이트", r"아르바이트|알바"),
    ("파트타임", r"파트\s*타임|part[- ]?time"),
]
# Lines about employment, and about later postings.
EMPLOYMENT_LINE = r"고용\s*형태|근무\s*형태|근무\s*조건|채용\s*형태|인턴|아르바이트|알바|계약직|파트\s*타임"
FUTURE_LINE = r"향후|추후|공고에\s*지원|지원하더라도"


def employment_types(title: Column, body: Column, kind: Column) -> Column:
    """Types named in the title or in lines about employment, not about other postings or résumés."""
    useful = F.filter(lines(F.left(body, F.lit(10000))), lambda x: has(x, EMPLOYMENT_LINE) & ~has(x, FUTURE_LINE) & ~has(x, RESUME_GUIDANCE))
    found = labels(F.array_join(F.concat(F.array(title), useful), "\n"), EMPLOYMENT)
    found = F.when(F.array_contains(found, "전환형 인턴"), F.array_remove(found, "인턴")).otherwise(found)
    return F.when(kind == JOB, found).otherwise(F.array().cast("array<string>"))


def numbered_role(heading: Column) -> Column:
    """The number of a numbered job line, null for other lines."""
    return F.nullif(F.regexp_extract(heading, java(rf"\A(?:{NUMBERED_JOB})\z"), 1), F.lit(""))


def is_design_role(title: Column, headings: Column) -> Column:
    """Whether a numbered role is a design role: by its application path, else by its title."""
    # Words that name a design role.
    explicit = r"(?:디자이너|디자인|Designer|Product\s+Design|Visual\s+Design|Graphic\s+Design|UI\s*/?\s*UX\s+Design|BX\s*/?\s*Brand\s+Design|Content\s+Design)"
    return F.when(F.exists(headings, lambda h: has(h, SERVICE_PATH)), False).when(F.exists(headings, lambda h: has(h, DESIGN_PATH)), True).otherwise(has(title, explicit))


def mixed_roles(role: Column) -> Column:
    parts = role_fragments(clean_text(role))
    design = lambda x: has(x, DESIGN_ROLE) | is_full(DESIGN_FRAGMENT, x)
    other = lambda x: ~has(x, DESIGN_ROLE) & (has(x, NON_DESIGN_ROLE) | is_full(GENERIC_ROLE, x))
    return (F.size(parts) >= 2) & F.exists(parts, design) & F.exists(parts, other)


def scope(kind: Column, title: Column, role: Column, headings: Column, image_only: Column) -> Column:
    """in_scope, or the reason why a record is none of the opportunities asked for. headings: heading texts of its blocks."""
    text = clean_text(F.when(role == "", title).otherwise(role))
    path = F.exists(headings, lambda h: has(h, DESIGN_PATH))
    job = (
        F.when(F.exists(headings, lambda h: has(h, SERVICE_PATH)), "non_design_role")
        .when(mixed_roles(text) & ~path, F.when((F.size(headings) == 0) | image_only, "no_isolated_design_role").otherwise("ambiguous_mixed_roles"))
        .when(path | has(text, DESIGN_ROLE), "in_scope")
        .otherwise("non_design_role")
    )
    return F.when(kind == JOB, job).when(kind.isin(CONTEST, ACTIVITY, EDUCATION) & has(text, DESIGN_PROGRAM), "in_scope").otherwise("non_design_opportunity")


def scope_bucket(scope: Column) -> Column:
    return F.when(scope == "in_scope", "in_scope").when(scope.isin("ambiguous_mixed_roles", "no_isolated_design_role"), "filtered_ambiguous").otherwise("filtered_non_design")
