"""Byte-level BPE encoding and decoding by ranked merges over a rank map.

A text is split by the pattern. A word that is a token is looked up; any other word is encoded by
folding ranked merges over its bytes: always the leftmost pair of least rank. Decoding concatenates
the tokens' binary pieces. Ids are ranks. All of it happens within a row, so there is no shuffle.

Two forms give the same ids. `Vocabulary` is made of Spark's higher-order functions over literal
tables: pairs are found with one probe (the entries of left id a start at `start[a]`, that of right
id b is at start[a] + b and holds a * SHIFT + rank, so that a foreign entry shows). They are
evaluated one object at a time and fold a word wherever it occurs, which takes several times the
allowed CPU seconds on whole tables (README). `round_trip` therefore folds each distinct word once
per worker, in Arrow batches, and is what the query runs.

Defined results: null and empty texts give no ids; repeated rows are encoded each; an empty table
gives an empty table; very long words take n log n steps in `round_trip`, n^2 in `Vocabulary`; extra
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pagewright.functions.ship import ship
from pagewright.llm.common import bind

NONE = 1 << 40
SHIFT = 1 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def literal(numbers) -> Column:
    """array<bigint> literal; the optimiser folds it once per plan."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")


@dataclass(frozen=True)
class Pairs:
    """One-probe table of all mergeable pairs: start[a] + b holds a * SHIFT + rank."""

    start: list[int]
    table: list[int]


def build_pairs(ranks: dict[bytes, int]) -> Pairs:
    """Rows of right ids by left id, the longest rows first, each at the first place where its entries are free."""
    rows: dict[int, list[tuple[int, int]]] = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                rows.setdefault(a, []).append((b, rank))
    size = max(ranks.values()) + 1
    table, start, end, hint = np.full(4 * size, -1, np.int64), [0] * size, 0, (0, 0)
    for a, row in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
        bs = np.array([b for b, _ in row])
        if len(row) == 1:
            break
        at = hint[1] if hint[0] == len(row) else 0  # rows of one length go on where the last one went
        while True:
            if at + 2048 + size > len(table):
                table = np.concatenate([table, np.full(len(table), -1, np.int64)])
            free = (table[np.arange(at, at + 2048)[:, None] + bs[None, :]] < 0).all(axis=1)
            if free.any():
                at += int(np.flatnonzero(free)[0])
                break
            at += 2048
        table[at + bs] = a * SHIFT + np.array([r for _, r in row])
        start[a], end, hint = at, max(end, at + int(bs.max())), (len(row), at)
    single = [(a, row[0]) for a, row in rows.items() if len(row) == 1]
    spots = [i for i in np.flatnonzero(table[size:] < 0)[: len(single)] + size]
    for (a, (b, rank)), at in zip(single, spots, strict=True):
        table[at], start[a], end = a * SHIFT + rank, int(at) - b, max(end, int(at))
    return Pairs(start, table[: end + size + 1].tolist())


@dataclass(frozen=True)
class Words:
    """Perfect hash of the tokens that are whole strings: slot (h2 + shift[bucket] * step) mod size holds token and id."""

    shift: list[int]
    tokens: list[str]
    ids: list[int]


def build_words(ranks: dict[bytes, int], per_bucket: int = 2) -> Words:
    import xxhash

    known = {}
    for token, i in ranks.items():
        try:
            known[token.decode("utf-8")] = i
        except UnicodeDecodeError:
            pass
    n, size = max(1, len(known) // per_bucket), max(7, 2 * len(known)) | 1
    buckets: list[list[tuple[int, str]]] = [[] for _ in range(n)]
    for w in known:
        h = xxhash.xxh64_intdigest(w.encode(), seed=42)
        buckets[h % (1 << 63) % n if h < 1 << 63 else (h - (1 << 64)) % n].append((h, w))
    shift, tokens, ids = [0] * n, [""] * size, [0] * size
    used = [False] * size
    for b in sorted(range(n), key=lambda b: -len(buckets[b])):
        for s in range(1 << 20):
            slots = [((h >> 24) + s * (1 + (h >> 44))) % size for h, _ in buckets[b]]
            if len(set(slots)) == len(slots) and not any(used[x] for x in slots):
                break
        shift[b] = s
        for x, (_, w) in zip(slots, buckets[b], strict=True):
            used[x], tokens[x], ids[x] = True, w, known[w]
    return Words(shift, tokens, ids)


def strings(items: list[str]) -> Column:
    """array<string> literal of items that hold no U+0000."""
    return F.split(F.lit("\x00".join(items)), "\x00", -1)


#: White space beyond ASCII, which Java's \\s leaves out.
MORE_SPACE = r"\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def for_java(pattern: str) -> str:
    """pattern with \\s and \\S as all of Unicode's white space."""
    out = pattern.replace(r"[^\s", r"[^\s" + MORE_SPACE)
    out = re.sub(r"(?<!\[\^)\\s", lambda _: r"[\s" + MORE_SPACE + "]", out)
    return out.replace(r"\S", r"[^\s" + MORE_SPACE + "]")


class Vocabulary:
    """Encoding and decoding of one vocabulary as column expressions."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.pattern = for_java(pattern)
        pairs, whole = build_pairs(ranks), build_words({t: i for t, i in ranks.items() if b"\x00" not in t})
        size = max(ranks.values()) + 1
        self.n_shift, self.n_slots = len(whole.shift), len(whole.tokens)
        self.byte_ids = literal([ranks[bytes([i])] for i in range(256)])
        self.start, self.table = literal(pairs.start), literal(pairs.table)
        self.shift, self.tokens, self.ids = literal(whole.shift), strings(whole.tokens), literal(whole.ids)
        pieces, packed = ["00"] * size, ["00"] * size
        for token, i in ranks.items():
            pieces[i] = token.hex()
        packed = [i.to_bytes(4, "little").hex() for i in range(size)]
        self.pieces, self.packed = strings(pieces), strings(packed)

    def whole(self, word: Column) -> Column:
        """Id of a word that is a token, else null."""

        def found(h: Column) -> Column:
            s = F.get(self.shift, F.pmod(h, F.lit(self.n_shift)).cast("int"))
            step = F.call_function("shiftrightunsigned", h, F.lit(44)) + 1
            slot = F.pmod(F.call_function("shiftrightunsigned", h, F.lit(24)) + s * step, F.lit(self.n_slots)).cast("int")
            return bind(slot, lambda x: F.when(F.get(self.tokens, x) == word, F.get(self.ids, x)))

        return bind(F.xxhash64(word), found)

    def rank(self, a: Column, b: Column) -> Column:
        """Rank of a pair's merge, NONE if it has none."""
        entry = F.get(self.table, (F.get(self.start, a.cast("int")) + b).cast("int"))
        return bind(entry, lambda e: F.when(F.shiftright(e, 20) == a, e.bitwiseAND(F.lit(SHIFT - 1))).otherwise(F.lit(NONE)))

    def least(self, ids: Column) -> Column:
        """Rank * SHIFT + position of the leftmost pair of least rank."""
        rest = F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(0)))
        ranks = F.zip_with(F.slice(ids, F.lit(1), F.greatest(F.size(ids) - 1, F.lit(0))), rest, self.rank)
        return F.array_min(F.transform(ranks, lambda r, i: r * SHIFT + i))

    def merge_one(self, ids: Column, m: Column) -> Column:
        i = (m % SHIFT).cast("int")
        return F.concat(F.slice(ids, F.lit(1), i), F.array(F.shiftright(m, 20)), F.slice(ids, i + 3, F.size(ids)))

    def encode_word(self, word: Column) -> Column:
        """Ids of one word by ranked merges, folded over its bytes; a step without a merge ends the work."""
        chars = F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), "")
        first = F.transform(chars, lambda c: F.get(self.byte_ids, F.ascii(c)))

        def step(acc: Column, _: Column) -> Column:
            def go(m: Column) -> Column:
                return F.when(m < NONE * SHIFT, F.struct(self.merge_one(acc["ids"], m).alias("ids"), F.lit(False).alias("done"))).otherwise(
                    F.struct(acc["ids"].alias("ids"), F.lit(True).alias("done"))
                )

            return F.when(acc["done"] | (F.size(acc["ids"]) < 2), acc).otherwise(bind(self.least(acc["ids"]), go))

        turns = F.sequence(F.lit(1), F.octet_length(word))
        return F.aggregate(turns, F.struct(first.alias("ids"), F.lit(False).alias("done")), step, lambda acc: acc["ids"])

    def encode(self, text: Column) -> Column:
        """array<bigint>: the ids of a whole text, each match of the pattern on its own."""
        ws = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({self.pattern})"), F.lit(1))
        return F.flatten(F.transform(ws, lambda w: bind(self.whole(w), lambda i: F.when(i.isNotNull(), F.array(i)).otherwise(self.encode_word(w)))))

    def decode(self, ids: Column) -> Column:
        """The bytes of ids: their pieces, one after another."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self.pieces, i.cast("int"))), ""))

    def as_bytes(self, ids: Column) -> Column:
        """ids as little-endian unsigned 32-bit integers."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self.packed, i.cast("int"))), ""))


#: Distinct words kept per worker with their ids; emptied when full.
STORE = 500_000


def merge_ranked(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Folds ranked merges over the bytes of a word: always the leftmost pair of least rank. n log n for long words."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    if len(word) < 64:
        parts = [word[i : i + 1] for i in range(len(word))]
        while True:
            found = [ranks.get(a + b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
            if not found or (least := min(found)) == NONE:
                return [ranks[p] for p in parts]
            i = found.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
    parts, after, before = [word[i : i + 1] for i in range(len(word))], [*range(1, len(word)), -1], [*range(-1, len(word) - 1)]
    heap = [(r, i, i + 1) for i in range(len(word) - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        r, i, j = heapq.heappop(heap)
        if after[i] != j or not parts[i] or ranks.get(parts[i] + parts[j]) != r:
            continue
        parts[i], parts[j], after[i] = parts[i] + parts[j], b"", after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b >= 0 and (x := ranks.get(parts[a] + parts[b])) is not None:
                heapq.heappush(heap, (x, a, b))
    return [ranks[p] for p in parts if p]


class Distinct(dict):
    """word -> its ids as bytes; each distinct word is folded once."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks

    def __missing__(self, word: str) -> bytes:
        if len(self) >= STORE:
            self.clear()
        self[word] = found = b"".join(i.to_bytes(4, "little") for i in merge_ranked(word.encode(), self.ranks))
        return found


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of docs (doc_id, text): encoded, then decoded from the ids."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(ranks)  # the size of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        ranks = shared.value
        find, store, pieces = regex.compile(pattern).findall, Distinct(ranks), {i: t for t, i in ranks.items()}
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for part in (batch.slice(at, 500) for batch in batches for at in range(0, batch.num_rows, 500)):
            n, packed, decoded = [], [], []
            for text in part.column(1).to_pylist():
                ids = b"".join(map(store.__getitem__, find(text or "")))
                n.append(len(ids) // 4)
                packed.append(sha(ids))
                decoded.append(sha(b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(packed, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
