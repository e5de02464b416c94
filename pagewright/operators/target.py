"""The target table: schema, its validation and migration, properties and child blocks of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pagewright.functions.text import wrap
from pagewright.operators.classify import JOB

_S, _D, _A = T.StringType(), T.DateType(), T.ArrayType(T.StringType())
# Columns of the target, their labels and types.
COLUMNS = [
    ("title", "공고명", _S), ("content_type", "콘텐츠 유형", _S), ("site_categories", "사이트 원분류", _A), ("organization", "기관/회사명", _S),
    ("role_or_program", "직무/프로그램명", _S), ("design_fields", "디자인 분야", _A), ("experience_class", "경력 분류", _S), ("experience_raw", "경력 원문", _S),
    ("employment_types", "고용형태", _A), ("target_audience", "지원 대상", _S), ("qualifications", "자격요건", _S), ("preferred_qualifications", "우대사항", _S),
    ("essay_questions", "자소서 문항", _S), ("pre_assignment", "사전과제", _S), ("location", "근무·활동 지역", _S), ("key_duties", "주요 업무·활동", _S),
    ("benefits_prize", "혜택·상금", _S), ("deadline", "마감일", _D), ("activity_period", "활동 기간", _S), ("published_date", "게시일", _D), ("status", "공고 상태", _S),
    ("source_url", "원문 링크", _S), ("apply_url", "지원 링크", _S), ("post_id", "게시물 ID", _S), ("last_checked", "최종 확인일", _D), ("collection_status", "수집 상태", _S),
    ("changed", "원문 변경", T.BooleanType()), ("content_hash", "원문 해시", _S),
]
# What the closed domains may hold; wider than what the classifiers give.
DOMAINS = {
    "content_type": ["채용공고", "공모전", "대외활동", "교육·프로그램", "커리어 콘텐츠", "기타·확인 필요"],
    "experience_class": ["신입", "인턴", "경력", "경력무관", "해당 없음", "확인 필요"],
    "employment_types": ["정규직", "계약직", "체험형 인턴", "전환형 인턴", "인턴", "프리랜서", "아르바이트", "파트타임"],
    "status": ["모집 중", "마감", "확인 필요"],
    "collection_status": ["정상", "검토 필요", "일부 누락"],
}
SECTIONS = ("qualifications", "preferred_qualifications", "essay_questions", "pre_assignment")
REQUIRED = ("key_duties", "target_audience", *SECTIONS)
SCHEMA = T.StructType([T.StructField(n, t) for n, _, t in COLUMNS])


def schema_problems(schema: T.StructType, required: dict[str, T.DataType] | None = None) -> tuple[list[str], list[str]]:
    """(missing, of a wrong type) among the required columns."""
    wanted = required or {n: _S for n in REQUIRED}
    there = {f.name: f.dataType for f in schema}
    return [n for n in wanted if n not in there], [n for n, t in wanted.items() if n in there and there[n] != t]


def validate(schema: T.StructType) -> None:
    missing, wrong = schema_problems(schema)
    if missing or wrong:
        said = [f"missing: {', '.join(missing)}"] * bool(missing) + [f"wrong type: {', '.join(wrong)}"] * bool(wrong)
        raise ValueError(f"the target lacks required columns ({'; '.join(said)}); migrate it first")


def create(spark: SparkSession, table: str) -> None:
    """An empty target; fails if a table of that name exists."""
    if spark.catalog.tableExists(table):
        raise ValueError(f"{table} exists already")
    spark.createDataFrame([], SCHEMA).write.format("parquet").saveAsTable(table)


def migrate(df: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """df with the section columns it lacks, empty, and the names added and found. A second run adds nothing; a wrong type is an error."""
    missing, wrong = schema_problems(df.schema, {n: _S for n in SECTIONS})
    if wrong:
        raise ValueError(f"wrong type: {', '.join(wrong)}")
    return df.withColumns({n: F.lit("") for n in missing}) if missing else df, missing, [n for n in SECTIONS if n not in missing]


def migrate_table(spark: SparkSession, table: str) -> tuple[list[str], list[str]]:
    """Adds the section columns that a stored table lacks and looks again; the names added and those found. Nothing but columns is touched."""
    _, missing, there = migrate(spark.table(table))
    if missing:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'{n} STRING' for n in missing)})")
        spark.catalog.refreshTable(table)
    still, wrong = schema_problems(spark.table(table).schema, {n: _S for n in SECTIONS})
    if still or wrong:
        raise ValueError(f"{table} was not migrated: {', '.join([*still, *wrong])}")
    return missing, there


def outside_domains(rows: DataFrame) -> DataFrame:
    """post_id, column, value of what rows hold outside the closed domains."""
    held = F.explode(F.array(*[F.struct(F.lit(n).alias("column"), (F.col(n) if n == "employment_types" else F.array(n)).alias("values")) for n in DOMAINS]))
    allowed = F.create_map(*[x for n, vs in DOMAINS.items() for x in (F.lit(n), F.array(*map(F.lit, vs)))])
    each = rows.select("post_id", held.alias("d")).select("post_id", "d.column", F.explode("d.values").alias("value"))
    return each.filter(F.col("value").isNotNull() & ~F.array_contains(F.element_at(allowed, F.col("column")), F.col("value")))


def properties(found: DataFrame, as_of, changed: Column | bool = False) -> DataFrame:
    """Records as rows of the target: titles and short texts cut, fields of the other kind of posting blank, checked today."""
    job = F.col("content_type") == JOB
    own = {n: F.left(n, F.lit(1900 if n == "title" else 1800)) for n in ("title", "organization", "role_or_program", "experience_raw", "location", "benefits_prize", "activity_period")}
    own |= {"target_audience": F.when(job, "").otherwise(F.col("target_audience")), "qualifications": F.when(job, F.col("qualifications")).otherwise("")}
    own |= {"last_checked": F.lit(as_of).cast("date"), "changed": changed if isinstance(changed, Column) else F.lit(changed)}
    return found.select(*[own.get(n, F.col(n)).cast(t).alias(n) for n, _, t in COLUMNS])


def child_blocks(found: DataFrame, batch: int = 100, most: int = 1900) -> DataFrame:
    """post_id, pos, batch, kind, texts, link: a heading, the body in pieces of `most` characters, a divider and the source."""
    known = ["heading_1", "heading_2", "heading_3", "paragraph", "bulleted_list_item", "numbered_list_item", "quote", "divider"]
    one = lambda kind, text, link=None: F.struct(F.lit(kind).alias("kind") if isinstance(kind, str) else kind.alias("kind"), text.alias("text"), (F.lit(link).cast("string") if link is None else link).alias("link"))

    def pieces(b: Column) -> Column:
        kind = F.when(b.kind.isin(known), b.kind).otherwise("paragraph")
        starts = F.sequence(F.lit(0), F.greatest(F.length(b.text) - 1, F.lit(0)), F.lit(most))
        return F.when(b.kind == "divider", F.array(one(kind, F.lit("")))).otherwise(F.transform(starts, lambda s: one(kind, F.substr(b.text, s + 1, F.lit(most)))))

    head = F.array(one("heading_2", F.lit("원문")))
    tail = F.array(one("divider", F.lit("")), one("paragraph", F.concat(F.lit("출처: "), "source_url"), F.col("source_url")))
    rows = found.select("post_id", F.posexplode(F.concat(head, F.flatten(F.transform("body_blocks", pieces)), tail)).alias("pos", "b"))
    return rows.select("post_id", "pos", F.floor(F.col("pos") / batch).cast("int").alias("batch"), "b.kind", wrap(F.col("b.text"), most).alias("texts"), "b.link")


def replace_children(children: DataFrame, fresh: DataFrame, changed: DataFrame) -> DataFrame:
    """The child table with the blocks of changed posts replaced, as one snapshot."""
    return children.join(changed.select("post_id").distinct(), "post_id", "left_anti").unionByName(fresh.join(changed.select("post_id").distinct(), "post_id", "left_semi"))


def blocks_of(children: DataFrame) -> DataFrame:
    """post_id, blocks (kind, text) in order: the child table read back, a post a row."""
    one = F.struct("pos", "kind", F.array_join("texts", "").alias("text"))
    got = children.groupBy("post_id").agg(F.array_sort(F.collect_list(one)).alias("all"))
    return got.select("post_id", F.transform("all", lambda b: F.struct(b.kind.alias("kind"), b.text.alias("text"))).alias("blocks"))


def plain_text(kind: Column, texts: Column, url: Column, name: Column) -> Column:
    """A typed property as text: title and rich_text joined, url and select as they are, else empty."""
    return F.coalesce(F.when(kind.isin("title", "rich_text"), F.array_join(texts, "")).when(kind == "url", url).when(kind == "select", name), F.lit(""))
