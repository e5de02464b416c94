"""The stages of the pipeline on small tables, each against a plain version of its own; run() as a whole."""

import itertools
import zlib

import corpus_pipeline
import public_tokenizers as tokens
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagewright.llm import quality
from pagewright.llm.common import read

EN = "the house on the hill was old and it had a garden with many trees in it"
DE = "das haus auf dem berg war alt und es hatte einen garten mit vielen bäumen"
SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, texts):
    """Documents with columns that have the names of those the stages add; a null id, a repeated row."""
    rows = [(i, t, "de" if t and "das" in t else "en", "s", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, rows[0], (None, *rows[0][1:])], SHAPE)
    for c in ("n_lines", "n_removed", "lang_pred", "score", "kept", "comp", "n_words", "__rest"):
        df = df.withColumn(c, F.lit(f"my {c}"))
    return df


def untouched(got, docs):
    assert got.columns == docs.columns
    assert got.filter(" or ".join(f"`{c}` <> 'my {c}'" for c in docs.columns[5:])).count() == 0
    return sorted(((r.doc_id, r.text) for r in got.collect()), key=str)


def plain_quality(text):
    ws = (text or "").split()
    lines = [x for x in (text or "").split("\n") if x.split()]
    grams = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    twice = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)}
    symbols, stops = sum((text or "").count(c) for c in "#*$%&|<>"), sum(w.lower() in quality.STOP_WORDS for w in ws)
    long = sum(map(len, ws))
    return len(ws) >= 10 and len(twice) <= 0.2 * len(ws) and 2.5 * len(ws) <= long <= 15 * len(ws) and symbols <= 0.3 * len(ws) and stops >= 0.02 * len(ws) and len(lines) - len(set(lines)) <= 0.3 * len(lines)


def test_quality_rules(spark, sf_dir):
    docs = table(spark, [EN, "few words", None, "", EN + " #" * 8, "a b " * 20, f"{EN}\n{EN}", "zzzz " * 3 + EN, DE + " " + " ".join(f"w{i}" for i in range(20_000))])
    wanted = sorted(((r.doc_id, r.text) for r in docs.collect() if plain_quality(r.text)), key=str)
    assert untouched(corpus_pipeline.quality_rules(spark, docs, sf_dir), docs) == wanted and 0 < len(wanted) < docs.count()


def test_language_id(spark, sf_dir):
    docs = table(spark, [EN, DE, "12 34 !", None, "", " ".join([EN] * 300), DE.upper()])
    wanted = sorted(((r.doc_id, r.text) for r in docs.collect() if any(c.isalpha() for c in r.text or "")), key=str)
    assert untouched(corpus_pipeline.language_id(spark, docs, sf_dir), docs) == wanted


def test_line_dedup(spark, sf_dir):
    docs = table(spark, ["a\nb\nc\nd", "x\nb\nc\nd\ny", None, "", "p\n\nq", "x\nb\nc\nd\ny"])
    got = corpus_pipeline.line_dedup_stage(spark, docs, sf_dir)
    assert untouched(got, docs) == sorted([(0, "a\nb\nc\nd"), (0, "a\nb\nc\nd"), (1, "x\ny"), (2, None), (3, ""), (4, "p\n\nq"), (5, ""), (None, "")], key=str)
    assert got.filter("n_chars <> length(text)").count() == 0


def test_near_dedup(spark, sf_dir):
    base = " ".join(f"w{i}" for i in range(100))
    texts = [base, base + " more", EN, None, "", "other words " * 30, DE, base.upper()]
    docs = table(spark, texts)

    def grams(t):
        ws = t.lower().split()
        return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))}

    near = lambda x, y: bool(x and y) and 10 * len(grams(x) & grams(y)) >= 8 * len(grams(x) | grams(y))
    wanted = [(i, t) for i, t in enumerate(texts) if not any(near(u, t) for u in texts[:i])]
    assert untouched(corpus_pipeline.near_dedup(spark, docs, sf_dir), docs) == sorted(wanted, key=str)


def test_packing(spark, sf_dir):
    texts = [EN, None, "", " ".join([DE] * 200), EN]
    docs = table(spark, texts)
    with open(tokens.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        library = Tokenizer.from_str(f.read())
    got = sorted(((r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.packing_stage(spark, docs, sf_dir).collect()), key=str)
    wanted = []
    for i, t in [*enumerate(texts), (0, EN), (None, EN)]:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        cuts = sorted({0, len(ids), *range(len(ids), 0, -1024)}) if len(ids) > 1024 else [0, len(ids)]
        for n, (a, b) in enumerate(itertools.pairwise(cuts)):
            wanted.append((i, n, b - a, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[a:b]))))
    assert got == sorted(wanted, key=str)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_empty_table(spark, sf_dir, name, stage):
    docs = table(spark, [EN]).limit(0)
    got = stage(spark, docs, sf_dir)
    assert got.count() == 0 and (name == "packing" or got.columns == docs.columns)


def test_run_packs_each_kept_document_once(spark, sf_dir):
    """What run() packs is what the stages keep one after another, clean documents among it."""
    got = corpus_pipeline.run(spark, sf_dir)
    by_doc = got.groupBy("doc_id").agg(F.min("start").alias("a"), F.max(F.col("start") + F.col("length")).alias("b"), F.sum("length").alias("n"))
    assert by_doc.filter("a <> 0 or b <> n").count() == 0
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
    docs = read(spark, sf_dir, "documents")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, sf_dir)
    assert {r.doc_id for r in by_doc.collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
