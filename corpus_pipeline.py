"""The corpus pipeline: quality rules, language identification, line dedup, near-duplicate detection, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's result as
Parquet in the shared folder and rereads it as the next one's docs. All stages but the last return
the columns of documents. A stage works on all rows that the one before kept:

* quality_rules drops documents that the threshold table rejects;
* language_id learns from the rows with a language and drops documents without a letter and those
  that fit no language better than the others together (posterior under `LEAST_POSTERIOR`);
* line_dedup removes repeated three-line windows and sets n_chars to the new length;
* near_dedup keeps one row, that of the smallest doc_id, of each group of near copies (five words, 0.8);
* packing returns the pieces and their places.

Defined results: null and empty texts, and those without a word, are rejected by the first stage, and
by the second if it is run alone; texts of any length are worked on whole; rows repeated with id and
text are judged alike by the first three stages and are one row after near_dedup; ties go to the
smaller doc_id, null ids last; an empty table gives an empty one from every stage; extra columns pass
through all stages but the last unchanged, whatever their names (only n_chars is set anew).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagewright.llm import langid, line_dedup, minhash, packing, quality
from pagewright.llm.common import materialise, read

LEAST_POSTERIOR = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokens

    pieces = langid.load_pieces(tokens.path("piece_bpe_32k.model"))
    judged = langid.predict(docs, pieces, langid.train(docs.select("text", "lang"), pieces), added=("__lang", "__score"))
    kept = judged.filter((F.col("__lang") != "und") & (F.col("__score") >= LEAST_POSTERIOR))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    got = line_dedup.first_only(docs)
    return got.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else got


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs, width=5, per_cent=80)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokens

    with open(tokens.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    return packing.pack(docs.select("doc_id", "text"), spec, tokens.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("packing", packing_stage),
]

#: SQL can express neither the trained language model nor the packing; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
