"""URL filters: a cascade of Bloom filters gives exact membership of a URL's keys without joining the URLs.

Level 0 encodes the listed keys. Level 1 encodes those keys of the corpus (all keys of all rows,
the universe) that level 0 accepts although they are not listed, level 2 the listed keys that
level 1 accepts, and so on until a level accepts nothing wrongly. A key's verdict is the parity of
the first level that refuses it, exact for every key of the universe it was built over.

A key is host suffix + path prefix, for the path lengths that occur among the rules. The levels are
bit arrays of `bits_per_key` bits per encoded key, at most `max_bits` bits (checked), and enter the
plan as literals.

Defined results: null URLs and URLs without `://` have empty host and path and fit no rule; repeated
rows are judged each; of rules that fit the longest wins, and two cannot be equally long; URLs of any
length are judged whole; an empty table gives an empty result; other columns pass through, but those
named host, path, rule or verdict are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagewright.llm.common import lower_ascii, materialise

SEP = "\u0001"


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def keys_of(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys of one URL: each domain suffix of its host with each path prefix of a listed length, longest host first."""
    parts = F.split(host, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))
    prefixes = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths])
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, F.lit(SEP), p))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_compact(keys))


@dataclass(frozen=True)
class Bloom:
    """One level: `words` 64-bit words, `hashes` probes, salted by its level."""

    level: int
    hashes: int
    words: list[int]

    def has(self, key: Column) -> Column:
        table = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")  # once in the plan, folded to an array
        probes = F.array(*positions(key, self.level, self.hashes, len(self.words)))
        return F.forall(probes, lambda at: F.call_function("getbit", F.get(table, F.shiftright(at, 6).cast("int")), (at % 64).cast("int")) == 1)


def positions(key: Column, level: int, hashes: int, n_words: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(1000 * level + i)), F.lit(64 * n_words)) for i in range(hashes)]


def build_level(keys: DataFrame, level: int, bits_per_key: int, max_bits: int) -> Bloom | None:
    """A level over the distinct keys (column `key`); None if there are none. Set bits are OR-ed on the executors; the driver gets words only."""
    n = keys.count()
    if not n:
        return None
    n_words = max(1, -(-n * bits_per_key // 64))
    if 64 * n_words > max_bits:
        raise ValueError(f"level {level} needs {64 * n_words} bits; max_bits is {max_bits}")
    hashes = max(1, round(0.69 * bits_per_key))
    spots = keys.select(F.explode(F.array(*positions(F.col("key"), level, hashes, n_words))).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
    got = spots.groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(bit).alias("bits"))
    table = [0] * n_words
    for r in got.collect():
        table[r.w] = r.bits
    return Bloom(level, hashes, table)


@dataclass(frozen=True)
class Cascade:
    levels: list[Bloom]

    def has(self, key: Column) -> Column:
        """Whether key is listed: the parity of the first level that refuses it."""
        out = F.lit(len(self.levels) % 2 == 1)
        for lv in reversed(self.levels):
            out = F.when(~lv.has(key), F.lit(lv.level % 2 == 1)).otherwise(out)
        return out


def build_cascade(listed: DataFrame, universe: DataFrame, bits_per_key: int = 10, max_bits: int = 1 << 24, max_levels: int = 40) -> Cascade:
    """listed, universe: column `key`. The universe may repeat keys; only keys that a level accepts are made distinct.

    Only the candidates of level 0 are ever compared with the list, on the executors.
    """
    listed = listed.select("key").distinct()
    levels: list[Bloom] = []
    encode, other = listed, None
    while len(levels) < max_levels:
        lv = build_level(encode, len(levels), bits_per_key, max_bits)
        if lv is None:
            return Cascade(levels)
        levels.append(lv)
        if other is None:
            other = materialise(universe.select("key").filter(lv.has(F.col("key"))).distinct().join(listed, "key", "left_anti"), "wrong")
            wrong = other
        else:
            wrong = other.filter(lv.has(F.col("key")))
        encode, other = wrong, encode
    raise ValueError("the cascade does not end: raise bits_per_key")


def with_rules(pages: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict. rules: (verdict, host, path), a bounded driver-side list.

    The longest fitting rule (host + path) wins; a URL that fits none gets `default`. Its keys that
    the cascade accepts are listed keys; among them the longest decides.
    """
    spark: SparkSession = pages.sparkSession
    host, path = host_of(F.col(url)), path_of(F.col(url))
    out = pages.withColumn("host", host).withColumn("path", path)
    if not rules:
        return out.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    lengths = sorted({len(p) for _, _, p in rules})
    listed = spark.createDataFrame([(h.lower() + SEP + p,) for _, h, p in rules], "key string")
    universe = pages.select(F.explode(keys_of(host, path, lengths)).alias("key"))
    cascade = build_cascade(listed, universe)
    named = {h.lower() + SEP + p: (h.lower() + p, verdict) for verdict, h, p in rules}
    names = F.create_map(*[F.lit(x) for k, (name, _) in named.items() for x in (k, name)])
    verdicts = F.create_map(*[F.lit(x) for name, verdict in named.values() for x in (name, verdict)])
    hits = F.filter(keys_of(F.col("host"), F.col("path"), lengths), cascade.has)
    best = F.array_max(F.transform(hits, lambda k: F.struct(F.length(k).alias("n"), k.alias("k")))).k
    out = out.withColumn("rule", F.try_element_at(names, best))
    return out.withColumn("verdict", F.coalesce(F.try_element_at(verdicts, F.col("rule")), F.lit(default)))
