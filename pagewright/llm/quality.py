"""Quality rules: a threshold table compiled into one projection of length, symbol, stop-word and line ratios.

Defined results: null or empty text has no words and fails; texts of any length are judged whole;
repeated rows are judged one by one; a ratio that equals its threshold passes; an empty table gives an
empty table. Extra columns pass through; judge() replaces those that have the name of a column it adds,
keep_good() none. The verdict of a row depends on that row alone, so there is no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pagewright.llm.common import NOT_WORD, WORD, bind, words

#: Function words of the four languages of the corpus, matched after lower-casing.
STOP_WORDS = (
    "the of and to in is that with for on as by it was be this are at from or an "
    "der die das und den von zu mit im ein eine ist des dem auf für sich nicht "
    "le la les de des du et un une en est que dans pour sur par au qui "
    "el los las del y se con por para su lo al como"
).split()


@dataclass(frozen=True)
class Rule:
    """A row is rejected where metric / base is outside [least, most]; rows with base 0 count as ratio 0."""

    name: str
    metric: str
    base: str
    least: float | None = None
    most: float | None = None


#: The table that decides. Counts are compared in integers scaled by 1000, so that any SQL engine agrees.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", least=2.5, most=15.0),
    Rule("symbols_per_word", "n_symbols", "n_words", most=0.3),
    Rule("stop_words_per_word", "n_stop_words", "n_words", least=0.02),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=0.3),
)


def repeated_window_words(ws: Column, width: int = 5) -> Column:
    """How many words stand in a window of `width` words that occurs twice or more in the text.

    Windows are compared by 64-bit hashes; sorted once, so the cost is n log n for the longest text.
    """

    def covered(starts: Column) -> Column:
        zero = F.struct(F.lit(-1).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(
            starts,
            zero,
            lambda acc, s: F.struct((s + width).alias("end"), (acc.n + s + width - F.greatest(acc.end, s)).alias("n")),
            lambda acc: acc.n,
        )

    def repeats(hs: Column) -> Column:
        def over(found: Column) -> Column:
            twice = lambda x, i: ((i > 0) & (F.get(found, i - 1).h == x.h)) | (F.get(found, i + 1).h == x.h)
            starts = F.array_sort(F.transform(F.filter(found, twice), lambda x: x.i))
            return covered(starts)

        pairs = F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(bind(F.array_sort(pairs), over))

    hashes = F.transform(F.sequence(F.lit(1), F.size(ws) - (width - 1)), lambda i: F.xxhash64(F.slice(ws, i, width)))
    return F.when(F.size(ws) < width + 1, F.lit(0)).otherwise(bind(hashes, repeats)).cast("long")


def counted(text: Column) -> Column:
    """struct of the counts of a text. One bound expression, so that its words are split once wherever the optimiser puts it."""

    def over(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
        return bind(words(t), lambda ws: bind(lines, lambda ls: counts(t, ws, ls)))

    def counts(t: Column, ws: Column, ls: Column) -> Column:
        found = {
            "n_words": F.size(ws),
            "word_chars": F.length(F.regexp_replace(t, NOT_WORD, "")),
            "n_symbols": F.length(t) - F.length(F.translate(t, "#*$%&|<>", "")),
            "n_lines": F.size(ls),
            "n_dup_lines": F.size(ls) - F.size(F.array_distinct(ls)),
            "n_stop_words": F.size(F.filter(ws, lambda w: F.lower(w).isin(*dict.fromkeys(STOP_WORDS)))),
            "n_repeat_words": repeated_window_words(ws),
        }
        return F.struct(*[x.cast("long").alias(name) for name, x in found.items()])

    return bind(F.coalesce(text, F.lit("")), over)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_repeat_words")


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def passes(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one boolean column over the struct of counts."""
    ok = ~base_failed(m)
    for r in rules:
        scaled = m[r.metric] * 1000
        if r.least is not None:
            ok = ok & (scaled >= m[r.base] * round(1000 * r.least))
        if r.most is not None:
            ok = ok & (scaled <= m[r.base] * round(1000 * r.most))
    return ok


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with the counts, base_failed and kept added. Own columns of docs with those names are replaced."""
    verdict = bind(counted(F.col(f"`{text}`")), lambda m: F.struct(*[m[c].alias(c) for c in COUNTS], base_failed(m).alias("base_failed"), passes(m, rules).alias("kept")))
    added = [*COUNTS, "base_failed", "kept"]
    own = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    got = docs.select(F.struct(*own).alias("__row"), verdict.alias("__verdict"))
    return got.select("__row.*", *[F.col(f"__verdict.{c}").alias(c) for c in added])


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of docs that judge() keeps, with the columns of docs, whatever their names."""
    return docs.filter(bind(counted(F.col(f"`{text}`")), lambda m: passes(m, rules)))
