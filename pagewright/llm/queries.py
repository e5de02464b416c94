"""One thin query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagewright.llm import bpe, chat, hmm, langid, line_dedup, minhash, packing, quality, topk, url_filter
from pagewright.llm.common import read

#: The URL rules of the contract: verdict, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = {"conv_id": F.lit(-7), "turn": F.col("id"), "role": F.when(F.col("id") == 0, "user").otherwise("assistant"), "text": F.lit("\\### Assistant: </turn> ok")}
    own = spark.range(2).select(*[added[f.name].cast(f.dataType).alias(f.name) for f in rows.schema])
    tree = chat.as_tree(rows.unionByName(own))
    return chat.digest(chat.format_paths(tree)).withColumnRenamed("conv", "conv_id")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_stop_words")


def op9_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(read(spark, sf_dir, "documents").select("doc_id", "text"), langid.fold(F.col("doc_id"), 7) == 2)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.with_rules(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokens

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, bpe.load_ranks(tokens.path("byte_bpe_multi_50k.tiktoken")), tokens.PATTERN)


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), width=3, per_cent=85)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_repeats(docs).select("doc_id", "n_lines", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokens

    docs = read(spark, sf_dir, "documents")
    pieces = langid.load_pieces(tokens.path("piece_bpe_32k.model"))
    train = docs.filter(langid.fold(F.col("doc_id"), 5) != 0).select("text", "lang")
    held_out = F.coalesce(langid.fold(F.col("doc_id"), 5) == 0, F.lit(False))
    asked = docs.select("doc_id", held_out.alias("held_out"), "text")
    return langid.predict(asked, pieces, langid.train(train, pieces), keep=["doc_id", "held_out"])


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokens

    with open(tokens.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    return packing.pack(read(spark, sf_dir, "documents").select("doc_id", "text"), spec, tokens.PATTERN)


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def queries() -> dict:
    return {f.__name__: f for f in (op1_byte_bpe, op2_minhash_dedup, op3_line_dedup, op4_language_id, op5_best_fit_packing, op6_topk_search, op7_chat_format, op8_quality_rules, op9_hmm_score, op10_url_filter)}


def oracle_sql() -> dict[str, str]:
    from pagewright.llm import oracles

    return dict(oracles.SQL)
