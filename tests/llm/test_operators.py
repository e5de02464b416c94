"""Small cases of each operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names; and brute force."""

import hashlib
import inspect
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as tokens
import pytest
import tiktoken
from pyspark.sql import functions as F

from pagewright.llm import bpe, chat, hmm, langid, line_dedup, minhash, packing, quality, topk, url_filter
from pagewright.llm.queries import oracle_sql, queries
from tests.compare import same

RANKS = bpe.load_ranks(tokens.path("byte_bpe_multi_50k.tiktoken"))
TEXTS = [None, "", " ", "a", "don't stop 123  x\n\n y z", "éàç 中文字 😀👍🏽", "ab" * 700, "word " * 3000, "\t\x0b odd \x1c space"]


def docs(spark, texts, extra=False):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumn("n_words", F.lit("x")).withColumn("kept", F.lit("x")).withColumn("score", F.lit("x")) if extra else df


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    same(queries()[name](spark, sf_dir), oracle_sql()[name], sf_dir)


def test_bpe_equals_library(spark):
    library = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    wanted = [library.encode_ordinary(t or "") for t in TEXTS]
    got = bpe.round_trip(docs(spark, TEXTS), RANKS, tokens.PATTERN).orderBy("doc_id").collect()
    for r, ids, t in zip(got, wanted, TEXTS, strict=True):
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert bpe.round_trip(docs(spark, []), RANKS, tokens.PATTERN).count() == 0
    few = docs(spark, ["a b", "a b"], extra=True).withColumn("n_tokens", F.lit("mine"))
    twice = bpe.round_trip(few.unionByName(few), RANKS, tokens.PATTERN).collect()
    assert len(twice) == 4 and {(r.n_tokens, r.ids_sha256) for r in twice} == {(twice[0].n_tokens, twice[0].ids_sha256)}


def test_bpe_in_higher_order_functions(spark):
    few = {t: i for t, i in RANKS.items() if i < 2000}
    library = tiktoken.Encoding("few", pat_str=tokens.PATTERN, mergeable_ranks=few, special_tokens={})
    v = bpe.Vocabulary(few, tokens.PATTERN)
    short = [t[:400] if t else t for t in TEXTS]
    ids = v.encode(F.col("text"))
    got = docs(spark, short).select("doc_id", ids.alias("ids"), v.decode(ids).alias("back")).orderBy("doc_id").collect()
    assert [list(r.ids) for r in got] == [library.encode_ordinary(t or "") for t in short]
    assert [bytes(r.back).decode() for r in got] == [t or "" for t in short]


def brute_components(texts, width, per_cent):
    sets = []
    for t in texts:
        ws = (t or "").encode().lower().split()
        k = min(width, len(ws))
        sets.append({tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)} if ws else set())
    comp = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        inter = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * inter >= per_cent * (len(sets[a]) + len(sets[b]) - inter):
            old, new = max(comp[a], comp[b]), min(comp[a], comp[b])
            comp = [new if c == old else c for c in comp]
    return [len(s) for s in sets], comp


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = list(TEXTS)
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.choice([1, 1, 3, 40])):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    sizes, comp = brute_components(texts, 3, 85)
    got = minhash.near_duplicates(docs(spark, texts, extra=True), width=3, per_cent=85, small=8, depth=2).orderBy("doc_id").collect()
    assert [r.n_shingles for r in got] == sizes
    assert [r.component_id for r in got] == comp
    assert [r.kept for r in got] == [i == c for i, c in enumerate(comp)]


def family(size):
    """Texts at 0.71 to each other by a common template, and each at 0.80 to one other: one by one, sets of 100 words, threshold included."""
    pairs = []
    for i in range(size // 2):
        both = [f"t{j}" for j in range(83)] + [f"p{i}-{j}" for j in range(6)]
        pairs += [" ".join(both + [f"u{i}-{k}-{j}" for j in range(11)]) for k in range(2)]
    return pairs


def test_branching_keeps_pairs_together(spark):
    """Production trees and branches; nodes over 40 branch, those of 600 documents of a family at 0.71 several times."""
    got = minhash.near_duplicates(docs(spark, family(600)), width=1, per_cent=80, small=40).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(i, i - i % 2) for i in range(600)}


def test_large_nodes_in_blocks(spark):
    """What is large after the last level is compared in blocks: nothing branches here."""
    got = minhash.near_duplicates(docs(spark, family(300)), width=1, per_cent=80, small=16, depth=0).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(i, i - i % 2) for i in range(300)}


def test_sets_without_bloom_filter(spark):
    asked = docs(spark, family(20)).unionByName(spark.createDataFrame([(None, "a b c")], "doc_id long, text string"))
    reps = minhash.sketches(asked, 1, 48).filter("doc_id % 2 = 0 or doc_id is null").select(F.coalesce("doc_id", F.lit(-1)).alias("c"), "fp", "doc_id")
    both = [sorted((r.c, bytes(r.s)) for r in minhash.sets_of(asked, reps, 1, bits).collect()) for bits in (1 << 24, 0)]
    assert both[0] == both[1] and [c for c, _ in both[0]] == [-1, *range(0, 20, 2)]


def test_keep_one_drops_rows_not_ids(spark):
    a, b = "a b c d e f g", "h i j k l m n"
    rows = [(1, a, "x"), (5, a, "y"), (5, b, "z"), (7, b, "w"), (None, b, "v"), (9, None, "u"), (9, "", "t"), (3, "o p q", "s"), (3, "o p q", "s")]
    kept = minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, comp string"))
    assert kept.columns == ["doc_id", "text", "comp"]
    assert sorted((r.comp, r.doc_id, r.text) for r in kept.collect()) == [("s", 3, "o p q"), ("t", 9, ""), ("u", 9, None), ("x", 1, a), ("z", 5, b)]


def test_near_duplicates_without_links(spark):
    assert minhash.near_duplicates(docs(spark, [])).count() == 0
    got = minhash.near_duplicates(docs(spark, [None, "", "a b"])).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id, r.kept) for r in got] == [(0, 0, True), (0, 1, True), (1, 2, True)]
    twice = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in minhash.near_duplicates(twice).collect()) == [(-1, 1, False), (1, 1, True), (1, 1, True)]


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101)], "a long, b long")
    got = {r.id: r.comp for r in minhash.components(edges).collect()}
    assert {got[i] for i in range(41)} == {0} and got[101] == 100


def test_line_dedup(spark):
    a, b = "one x\ntwo\n\nthree\nfour", "zero\none x \ntwo\nthree\nlast"
    got = line_dedup.without_repeats(docs(spark, [a, b, None, "", "one x\ntwo", "p\np\np\np\np"], extra=True)).orderBy("doc_id").collect()
    assert [r.text for r in got] == [a, "zero\nlast", None, "", "one x\ntwo", "p"]
    assert [(r.n_lines, r.n_removed) for r in got] == [(4, 0), (5, 3), (0, 0), (0, 0), (2, 0), (5, 4)]
    assert line_dedup.without_repeats(docs(spark, [])).count() == 0
    twice = spark.createDataFrame([(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc\n" + "long line " * 20_000)], "doc_id long, text string").withColumn("n_lines", F.lit("mine"))
    only = line_dedup.first_only(twice)
    assert only.columns == twice.columns and sorted((r.doc_id, len(r.text), r.n_lines) for r in only.collect()) == [(1, 5, "mine"), (1, 5, "mine"), (2, 200_000, "mine")]
    assert line_dedup.first_only(twice.limit(0)).count() == 0


def test_language_id(spark):
    rng = random.Random(2)
    said = {"en": "the house is on the hill and the water was cold".split(), "de": "das haus ist auf dem berg und das wasser war kalt".split()}
    rows = [(lang, " ".join(rng.choice(ws) for _ in range(30))) for lang, ws in said.items() for _ in range(20)] + [(None, "x"), ("en", None)]
    pieces = langid.load_pieces(tokens.path("piece_bpe_32k.model"))
    model = langid.train(spark.createDataFrame(rows, "lang string, text string"), pieces)
    asked = docs(spark, [None, "12 !", "the cold water", "das kalte wasser", "the " * 50_000, "w" * 5000], extra=True)
    got = langid.predict(asked, pieces, model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got][:5] == ["und", "und", "en", "de", "en"]
    assert all(0 <= r.score <= 1 for r in got) and got[0].score == 0
    none = langid.train(spark.createDataFrame([], "lang string, text string"), pieces)
    assert {r.lang_pred for r in langid.predict(asked, pieces, none).collect()} == {"und"}


def test_segmentations_are_summed():
    lattice = langid.Lattice(["a", "b", "ab", "abb"])
    probs = np.array([[0.1], [0.2], [0.3], [0.05], [0.01]])
    # a|b|b + ab|b + abb, and c through the unknown piece
    wanted = [math.log(0.1 * 0.2 * 0.2 + 0.3 * 0.2 + 0.05), math.log(0.01)]
    assert np.allclose(lattice.score(["abb", "c"], probs)[:, 0], wanted)
    e = lattice.expected(["abb"], np.array([[2.0]]), probs[:, 0])[:, 0]
    total = 0.1 * 0.2 * 0.2 + 0.3 * 0.2 + 0.05
    assert np.allclose(e, [2 * 0.004 / total, 2 * (2 * 0.004 + 0.06) / total, 2 * 0.06 / total, 2 * 0.05 / total, 0])


def segmentations(word, pieces):
    """All ways to cut a word into pieces, letters that are no piece as None."""
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in pieces or n == 1:
            for rest in segmentations(word[n:], pieces):
                yield [word[:n] if word[:n] in pieces else None, *rest]


def test_long_words_are_summed_whole():
    rng = random.Random(9)
    pieces = ["a", "b", "ab", "aaaaaaaaaaaab", "abababababababab", "bba"]
    probs = np.array([[rng.random() / 50] for _ in range(len(pieces) + 1)])
    at = {p: i for i, p in enumerate(pieces)} | {None: len(pieces)}
    words = ["ab" * 9 + "aaaaaaaaaaaab", "abc" * 5, "ababababababababaaaaaaaaaaaab", "cba"]
    for w, got in zip(words, langid.Lattice(pieces).score(words, probs)[:, 0], strict=True):
        ways = [[at[p] for p in way] for way in segmentations(w, at)]
        assert math.isclose(got, math.log(math.fsum(math.prod(probs[i, 0] for i in way) for way in ways)), rel_tol=1e-9)
    huge, logs = "ab" * 4000, [0.0]
    for end in range(1, len(huge) + 1):
        ways = [logs[end - len(p)] + math.log(probs[at[p], 0]) for p in pieces if huge.startswith(p, end - len(p)) and end >= len(p)]
        logs.append(max(ways) + math.log(sum(math.exp(x - max(ways)) for x in ways)))
    assert math.isclose(langid.Lattice(pieces).score([huge], probs)[0, 0], logs[-1])
    weights = langid.Lattice(pieces).expected(words, np.ones((4, 1)), probs[:, 0])[:, 0]
    every = [(w, way) for w in words for way in segmentations(w, at)]
    share = {w: math.fsum(math.prod(probs[at[p], 0] for p in way) for x, way in every if x == w) for w in words}
    wanted = np.zeros(len(pieces) + 1)
    for w, way in every:
        for p in way:
            wanted[at[p]] += math.prod(probs[at[q], 0] for q in way) / share[w]
    assert np.allclose(weights, wanted)


def test_language_query_equals_brute_force(spark):
    """Training by expected counts over all segmentations, prediction by the sum over them, written out plainly; ties, repeated rows, clashing names."""
    rows = [(1, "aab b", "x"), (2, "aab b", "x"), (3, "Bba, ba ab", "y"), (4, "abab", None), (5, None, "x"), (6, "zz", "y")]
    pieces = ["▁a", "a", "b", "ab", "▁b", "ba", "z"]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, probs = langid.train(df.select("text", "lang"), pieces)
    at = {p: i for i, p in enumerate(pieces)} | {None: len(pieces)}
    prior = np.array([1 / (i + 100) for i in range(len(pieces))] + [1e-7])
    prior /= prior.sum()
    table = np.full((len(pieces) + 1, 2), 0.05)
    of = lambda w: [[at[p] for p in way] for way in segmentations("▁" + w, at)]
    for _, text, lang in rows:
        for w in langid.split(text) if lang else []:
            ways = of(w)
            total = sum(math.prod(prior[i] for i in way) for way in ways)
            for way in ways:
                for i in way:
                    table[i, "xy".index(lang)] += math.prod(prior[j] for j in way) / total
    assert langs == ["x", "y"] and np.allclose(probs, table / table.sum(axis=0))
    asked = df.unionByName(df).withColumn("score", F.lit("mine"))
    got = langid.predict(asked, pieces, (langs, probs), added=("found", "how")).orderBy("doc_id").collect()
    assert len(got) == 12 and {r.score for r in got} == {"mine"}
    for r in got:
        logs = [sum(math.log(sum(math.prod(probs[i, k] for i in way) for way in of(w))) for w in langid.split(r.text)) for k in range(2)]
        wanted = ("und", 0.0) if not langid.split(r.text) else (langs[int(logs[1] > logs[0])], 1 / (1 + math.exp(min(logs) - max(logs))))
        assert r.found == wanted[0] and math.isclose(r.how, wanted[1])
    even = langid.predict(asked.limit(1), pieces, (langs, np.repeat(probs[:, :1], 2, axis=1))).first()
    assert (even.lang_pred, even.score) == ("x", 0.5)
    assert langid.predict(df.limit(0), pieces, (langs, probs)).count() == 0


def spec():
    with open(tokens.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def test_packing(spark):
    from tokenizers import Tokenizer

    texts = [*TEXTS, "<|endoftext|> x", *("tok " * n for n in range(1, 60))]
    library = Tokenizer.from_str(spec())
    wanted = [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    rows = packing.pack(docs(spark, texts), spec(), tokens.PATTERN, size=64).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, ids in enumerate(wanted):
        at = 0
        for n, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at) and (n == 0 or r.length == 64)
            assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    for part in by_seq.values():
        at = 0
        for r in sorted(part, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert packing.pack(docs(spark, []), spec(), tokens.PATTERN).count() == 0


def test_local_search_improves_and_keeps_all():
    rng = random.Random(4)
    for least in (1, 20, 40):
        sizes = [rng.randint(least, 100) for _ in range(300)]
        loose = [[i] for i in range(300)]
        for start in (loose, packing.best_fit(sizes, 100)):
            got = packing.improve([list(b) for b in start], sizes, 100)
            assert sorted(itertools.chain(*got)) == list(range(300)) and max(sum(sizes[i] for i in b) for b in got) <= 100
            assert len(got) <= len(start)
        assert len(packing.improve(loose, sizes, 100)) <= 1.05 * len(packing.best_fit(sizes, 100)) + 1


def test_every_step_of_the_search_raises_the_sum():
    sizes, before = [50, 20, 20, 45, 44, 11], None
    part = packing.Bins([[0, 1, 2], [3, 4], [5]], sizes, 100)
    for b in (0, 1, 2, 1, 0):
        while moves := part.step(b):
            before = sum(f * f for f in part.fill)
            part.move(moves)
            assert sum(f * f for f in part.fill) > before and max(part.fill) <= 100
    assert before and sorted(part.fill) == [0, 90, 100]


def test_topk_repeated_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (7, [0.9]), (7, [0.9]), (8, [0.5]), (0, [1.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.search(df, F.col("vec_id") == 0, k=3).collect()]
    assert sorted(got) == sorted(2 * [(0, 1, 0, 65536), (0, 2, 7, 256 * 230), (0, 3, 7, 256 * 230)])


def test_topk(spark):
    """Partitions stay apart, so that keys of both sides have to meet by their hash."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run_topk(spark)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def run_topk(spark):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(300)] + [(i, [0.5] * 8) for i in range(300, 360)]
    rows += [(400, None), (450, []), (451, [1.0, None]), (452, [float("nan")] * 8), (453, [float("inf")] * 8), (454, [1.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    got = [tuple(r) for r in topk.search(df, F.col("vec_id") % 50 == 0, block_rows=40, block_components=200).collect()]
    ints = {i: np.floor(256 * np.float32(v).astype(float)).astype(int) for i, v in rows[:360]}
    wanted = []
    for q in range(0, 360, 50):
        best = sorted((-int(ints[q] @ ints[x]), x) for x in ints if x != q)[:5]
        wanted += [(q, n + 1, x, -s) for n, (s, x) in enumerate(best)]
    assert sorted(got) == sorted(wanted)
    assert topk.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_chat(spark):
    odd = "a </turn> <turn:user> \\b \\l <|x|>\n"
    rows = [(1, 0, "user", odd), (1, 1, "assistant", odd), (2, None, None, None), (2, 1, "assistant", ""), (2, 1, "assistant", ""), (None, 0, "a>b", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_paths(chat.as_tree(df))
    back = {r.conv: [tuple(t) for t in r.t] for r in out.select("conv", chat.read_back(F.col("formatted")).alias("t")).collect()}
    assert back == {1: [("user", odd), ("assistant", odd)], 2: [("", ""), ("assistant", ""), ("assistant", "")], None: [("a>b", "x")]}
    d = {r.conv: r for r in chat.digest(out).collect()}
    assert (d[1].loss_chars, d[1].loss_sha256) == (len(odd), hashlib.sha256(odd.encode()).hexdigest()) and d[2].n_turns == 3
    assert chat.format_paths(chat.as_tree(df.limit(0))).count() == 0


def test_chat_trees(spark):
    # 1 -> 2 -> (3 -> 4, 5), and a tie between the leaves of conversation 2
    rows = [(1, 1, None, "u", "a", 0.0), (1, 2, 1, "v", "b", 0.0), (1, 3, 2, "u", "c", 0.1), (1, 4, 3, "v", "d", 0.1), (1, 5, 2, "u", "e", 0.5), (2, 1, None, "u", "x", 0.0), (2, 2, 1, "v", "y", 1.0), (2, 3, 1, "v", "z", 1.0)]
    tree = spark.createDataFrame(rows, "conv long, node long, parent long, role string, text string, score double")
    got = chat.format_paths(tree, top=2).select("conv", "rank", F.transform(chat.read_back(F.col("formatted")), lambda t: t.text).alias("t")).collect()
    assert {(r.conv, r.rank): "".join(r.t) for r in got} == {(1, 1): "abe", (1, 2): "abcd", (2, 1): "xy", (2, 2): "xz"}


def test_chat_paths_to_the_end(spark):
    """A branching at each of 12 turns, a parent that is not there, a circle, a clashing column."""
    rows = [(1, 1, None, "u", "r", 0.0)] + [(1, 2 * i + j, 2 * i - 1 if i > 1 else 1, "v", f"{i}{'ab'[j]}", float(j)) for i in range(1, 13) for j in (0, 1)]
    rows += [(2, 5, 4, "u", "orphan", 0.0), (3, 1, 2, "u", "x", 0.0), (3, 2, 1, "u", "y", 0.0), (4, 1, None, None, "long " * 30_000, 0.0)]
    kids = {}
    for c, n, p, *_ in rows[:25]:
        kids.setdefault(p, []).append(n)
    text, score = {r[1]: r[4] for r in rows[:25]}, {r[1]: r[5] for r in rows[:25]}

    def walk(n):
        return [[n, *rest] for k in kids[n] for rest in walk(k)] if n in kids else [[n]]

    wanted = sorted(walk(1), key=lambda p: (-sum(score[n] for n in p), p[-1]))[:3]
    tree = spark.createDataFrame(rows, "conv long, node long, parent long, role string, text string, score double").withColumn("rank", F.lit("x"))
    got = chat.format_paths(tree, top=3).select("conv", "rank", F.transform(chat.read_back(F.col("formatted")), lambda t: t.text).alias("t")).collect()
    found = {(r.conv, r["rank"]): list(r.t) for r in got}
    assert found == {(1, i + 1): [text[n] for n in p] for i, p in enumerate(wanted)} | {(2, 1): ["orphan"], (4, 1): ["long " * 30_000]}


def test_quality_filter_splits_words_once(spark):
    plan = quality.keep_good(docs(spark, TEXTS))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    named = docs(spark, ["The house on the hill was old and it had a garden with many trees in it."] * 2, extra=True).withColumn("a.b", F.lit(1))
    assert quality.keep_good(named).columns == named.columns and quality.keep_good(named).count() == 2


def test_quality(spark):
    good = "The house on the hill was old and it had a garden with many trees in it."
    got = quality.judge(docs(spark, [*TEXTS, good, "a b c d e " * 4, good + " ###" * 20], extra=True)).orderBy("doc_id").collect()
    assert [r.kept for r in got[len(TEXTS) :]] == [True, False, False]
    assert got[0].n_words == 0 and got[0].base_failed and got[7].n_repeat_words == 3000 and got[len(TEXTS) + 1].n_repeat_words == 20
    kept = quality.keep_good(docs(spark, [good, None], extra=True))
    assert kept.columns == ["doc_id", "text", "n_words", "kept", "score"] and kept.count() == 1 and quality.judge(docs(spark, [])).count() == 0


def test_repeat_words_equal_brute_force(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    wanted = []
    for t in texts:
        ws = t.split()
        seen = Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
        wanted.append(len({j for i in range(len(ws) - 4) if seen[tuple(ws[i : i + 5])] > 1 for j in range(i, i + 5)}))
    assert [r.n_repeat_words for r in quality.judge(docs(spark, texts)).orderBy("doc_id").collect()] == wanted


def test_hmm_recursions():
    rng = np.random.default_rng(0)
    m = hmm.start_model(2, np.array([3.0, 2.0, 1.0]))
    seqs = [rng.integers(0, 3, n) for n in (1, 4, 6)]
    for numbers, lengths, obs in hmm.batches_of(seqs, cells=8):
        got = m.forward(lengths, obs)
        first, moves, emits = m.counts(lengths, obs)
        assert np.isclose(first.sum(), len(numbers)) and np.isclose(moves.sum(), (lengths - 1).sum()) and np.isclose(emits.sum(), lengths.sum())
        for i, ll in zip(numbers, got, strict=True):
            total = 0.0
            for path in itertools.product(range(2), repeat=len(seqs[i])):
                p = m.first[path[0]] * m.emit[seqs[i][0], path[0]]
                for t in range(1, len(path)):
                    p *= m.move[path[t - 1], path[t]] * m.emit[seqs[i][t], path[t]]
                total += p
            assert np.isclose(ll, math.log(total))


def test_hmm_scores(spark):
    texts = [*TEXTS, "The cat sat", "the cat ran", "unseen words here"]
    asked = docs(spark, texts)
    held = F.col("doc_id") == len(texts) - 1
    got = hmm.score(asked, held, own=5, rest=4, frequent=3).orderBy("doc_id").collect()
    seen = Counter(w for t in texts[:-1] for w in hmm.tokens(t))
    n, v = sum(seen.values()), len(seen)
    for r, t in zip(got, texts, strict=True):
        ws = hmm.tokens(t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(seen[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in ws)) and r.score < 0
    assert hmm.score(docs(spark, []), held).count() == 0


def test_hmm_score_with_one_state_is_the_class_unigram(spark):
    """The composed score written out plainly: class frequency times the frequency in the class. Repeated rows, a clashing column."""
    texts = ["a a b", "a a b", "c b xyz", None, "q"]
    got = hmm.score(docs(spark, texts, extra=True), F.col("doc_id") == 4, states=1, own=2, rest=3, frequent=3).orderBy("doc_id").collect()
    seen = Counter(w for t in texts[:4] for w in hmm.tokens(t))
    most = sorted(seen, key=lambda w: (-seen[w], w.decode()))[:2]  # 4 x a, 4 x end
    classes = {w: i for i, w in enumerate(most)}
    of = lambda w: classes.get(w, 2 + zlib.crc32(w[-2:]) % 3)
    mass, kinds = Counter(), Counter()
    for w, n in seen.items():
        mass[of(w)] += n
        kinds[of(w)] += 1
    n = sum(seen.values())
    for r, t in zip(got, texts, strict=True):
        wanted = sum(math.log10((mass[of(w)] + 0.01) / (n + 0.05) * (seen[w] + 1) / (mass[of(w)] + kinds[of(w)] + 1)) for w in hmm.tokens(t))
        assert math.isclose(r.score, wanted, rel_tol=1e-6)


def test_frequent_tokens_are_bounded_not_lost(spark):
    counts = spark.createDataFrame([(f"w{i}", 1) for i in range(20)], "token string, c long")
    assert 5 <= len(hmm.most_frequent(counts, 10)) <= 10 and len(hmm.most_frequent(counts, 30)) == 20
    more = counts.unionByName(spark.createDataFrame([("x", 9), ("y", 5)], "token string, c long"))
    got = hmm.most_frequent(more, 6)
    assert list(got)[:2] == [b"x", b"y"] and 3 <= len(got) <= 6 and hmm.most_frequent(counts.limit(0), 5) == {}


def test_hmm_states_are_trained(spark):
    """Held-out texts of an alternating language: what is next follows from the state, which a class unigram can't tell."""
    rng = random.Random(3)
    kinds = [[f"{k}{i}" for i in range(30)] for k in "abcd"]
    asked = docs(spark, [" ".join(rng.choice(kinds[(i + j) % 4]) for j in range(60)) for i in range(120)])
    per_token = lambda states: hmm.score(asked, F.col("doc_id") % 7 == 2, states=states).filter("held_out").agg(F.sum("score") / F.sum("n_tokens")).first()[0]
    assert per_token(4) > per_token(1) + 0.2  # log10; one state is the class unigram


def test_hmm_rounds_end_when_likelihood_does(spark):
    rng = np.random.default_rng(5)
    seqs = [np.concatenate([rng.integers(3 * (j % 2), 3 * (j % 2) + 3, 1) for j in range(40)]) for _ in range(60)]
    model, likely = hmm.baum_welch(hmm.start_model(2, np.full(6, 400.0)), lambda m: hmm.table_of(seqs, m), 2400, hmm.START_ROUNDS)
    assert len(likely) > hmm.START_ROUNDS and likely[-1] - likely[-2] < hmm.LEAST_RISE and all(b - a > -1e-3 for a, b in zip(likely, likely[1:]))


def test_url_filter(spark):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/")]
    urls = [None, "", "x", "http://A.Example.NET/en/1?x=/de/", "http://example.net/eng", "http://example.net", "ftp://example.com/de/#a", "http://myexample.com/de/", "https://net/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string").withColumn("host", F.lit("x"))
    got = [(r.host, r.path, r.rule, r.verdict) for r in url_filter.with_rules(df, rules).orderBy("page_id").collect()]
    assert got == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("a.example.net", "/en/1", "example.net/en/", "allow"), ("example.net", "/eng", "net/", "block"),
        ("example.net", "", None, "allow"), ("example.com", "/de/", "example.com/de/", "block"), ("myexample.com", "/de/", None, "allow"), ("net", "/", "net/", "block"),
    ]


def test_url_filter_on_odd_tables(spark):
    rules = [("block", "net", "/")]
    odd = spark.createDataFrame([(1, "http://a.net/" + "x" * 50_000), (1, "http://a.net/" + "x" * 50_000), (2, "http://" + "a." * 300 + "net/")], "page_id int, url string").withColumn("key", F.lit("k"))
    got = url_filter.with_rules(odd, rules)
    assert [(r.rule, r.verdict, r.key) for r in got.collect()] == [("net/", "block", "k")] * 3
    assert url_filter.with_rules(odd.limit(0), rules).count() == 0


def test_cascade_is_exact(spark):
    keys = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.filter("key like '%7'")
    cascade = url_filter.build_cascade(listed, keys, bits_per_key=3)
    wrong = keys.filter(cascade.has(F.col("key")) != F.col("key").like("%7")).count()
    assert wrong == 0 and len(cascade.levels) > 2
