"""Best-fit packing of tokenised documents into fixed-length sequences, with swap-based local search.

Documents are tokenised and closed with an end id; only those longer than a sequence are cut, into
full pieces, the first of which may be shorter. Full pieces are sequences already. The others are
dealt evenly into blocks of `block_rows` pieces; each block is packed best fit first, largest first,
and then improved: between underfull bins pieces are moved, exchanged one for one or two for one, each
step only if it raises the sum of squared fills, until no step is left; bins that empty go. A step fills
one bin: for every size the piece in the emptiest other bin is tried, for two-for-one every first size
with the largest second that gains.

Defined results: null and empty texts are one end id; texts of any length are cut and packed whole;
repeated rows are packed each; pieces of equal size are interchangeable, and which goes where is not
defined; null doc_ids stay; an empty table gives an empty result; extra columns, whatever their names,
are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pagewright.functions.ship import ship
from pagewright.llm.common import materialise

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"
#: Words kept per worker with their ids; the store is emptied when it is full, so its memory is bounded.
STORE = 400_000


class Ids(dict):
    """word -> its ids as little-endian unsigned 32-bit integers; a missing word is encoded once."""

    def __init__(self, encode_word) -> None:
        self.encode_word = encode_word

    def __missing__(self, word: str) -> bytes:
        if len(self) >= STORE:
            self.clear()
        self[word] = found = np.array(self.encode_word(word), "<u4").tobytes()
        return found


def by_ranks(spec: str, pattern: str):
    """word -> ids by merge ranks, several times faster than a tokenizer's call per word; None unless ids follow the order of the merges."""
    import tiktoken

    model = json.loads(spec)["model"]
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in keep} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in keep)}
    merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    made = [model["vocab"][m.replace(" ", "", 1)] for m in merges]
    if made != sorted(made) or model.get("ignore_merges") or len(set(made)) != len(made):
        return None
    known = {t: i for t, i in model["vocab"].items() if all(c in byte_of for c in t)}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in known.items() if i <= made[-1]}
    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@lru_cache(maxsize=2)
def encoder(spec: str, pattern: str):
    """text -> ids as bytes, like the tokenizer itself over the whole text."""
    import regex
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    plain = lambda word: tokenizer.encode(word, add_special_tokens=False).ids
    find, store = regex.compile(pattern).findall, Ids(by_ranks(spec, pattern) or plain)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def encode(text: str) -> bytes:
        if any(a in text for a in added):  # found before the text is split
            return b"".join(i.to_bytes(4, "little") for i in tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(store.__getitem__, find(text)))

    return encode


def pieces(docs: DataFrame, spec: str, pattern: str, size: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece of each document: doc_id, piece, start, length, ids_crc32."""
    ship(docs.sparkSession)
    end = end_id.to_bytes(4, "little")
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(spec, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                out = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = encode(text or "") + end
                    n = len(ids) // 4
                    starts = [0] if n <= size else [0, *range(n % size or size, n, size)]
                    for i, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                        out.append((doc_id, i, a, b - a, zlib.crc32(memoryview(ids)[4 * a : 4 * b])))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: largest first, each into the fullest bin with room."""
    by_room: dict[int, list[int]] = defaultdict(list)
    open_, bins = 0, []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        s = sizes[i]
        fits = open_ >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                open_ &= ~(1 << room)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if left := room - s:
            by_room[left].append(b)
            open_ |= 1 << left
    return bins


class Bins:
    """Underfull bins: where each item lies, and for each size the item in the emptiest bin."""

    def __init__(self, bins: list[list[int]], sizes: list[int], capacity: int) -> None:
        self.items, self.sizes, self.capacity = bins, sizes, capacity
        self.fill = [sum(sizes[i] for i in items) for items in bins]
        self.at = {i: b for b, items in enumerate(bins) for i in items}
        self.by_size: dict[int, list[tuple[int, int]]] = defaultdict(list)  # heaps of (fill when put there, item)
        self.there = 0  # bit s: items of size s may lie in underfull bins
        for b in range(len(bins)):
            self.tell(b)

    def tell(self, b: int) -> None:
        """Puts the items of b in the heaps with its present fill; a full bin is left alone from then on."""
        if self.fill[b] < self.capacity:
            for i in self.items[b]:
                heappush(self.by_size[self.sizes[i]], (self.fill[b], i))
                self.there |= 1 << self.sizes[i]

    def emptiest(self, s: int, *but: int, bin_: int) -> int | None:
        """The item of size s in the emptiest bin other than bin_, and none of `but`."""
        heap, aside, found = self.by_size[s], [], None
        while heap:
            fill, i = heap[0]
            if self.fill[self.at[i]] != fill or fill == self.capacity:
                heappop(heap)
            elif self.at[i] == bin_ or i in but:
                aside.append(heappop(heap))
            else:
                found = i
                break
        for x in aside:
            heappush(heap, x)
        if not heap:
            self.there &= ~(1 << s)
        return found

    def largest(self, most: int, above: int, *but: int, bin_: int, gains) -> int | None:
        """An item over `above` and of at most `most`, the largest of those for which gains(item) holds; of a size the one in the emptiest bin."""
        found = self.there & ((1 << (most + 1)) - 1) if most > 0 else 0
        while found:
            s = found.bit_length() - 1
            if s <= above:
                return None
            i = self.emptiest(s, *but, bin_=bin_)
            if i is not None and gains(i):
                return i
            found ^= 1 << s
        return None

    def gain(self, moves: list[tuple[int, int]]) -> int:
        """By how much moves (item, new bin) raise the sum of squared fills; -1 if a bin overflows."""
        change: dict[int, int] = defaultdict(int)
        for i, b in moves:
            change[self.at[i]] -= self.sizes[i]
            change[b] += self.sizes[i]
        if any(self.fill[b] + d > self.capacity for b, d in change.items()):
            return -1
        return sum(d * (2 * self.fill[b] + d) for b, d in change.items())

    def move(self, moves: list[tuple[int, int]]) -> None:
        touched = {b for _, b in moves} | {self.at[i] for i, _ in moves}
        for i, b in moves:
            self.items[self.at[i]].remove(i)
            self.fill[self.at[i]] -= self.sizes[i]
            self.items[b].append(i)
            self.fill[b] += self.sizes[i]
            self.at[i] = b
        for b in touched:
            self.tell(b)

    def step(self, b: int) -> list[tuple[int, int]] | None:
        """The first step found that fills b and raises the sum: a move into it, an exchange of one or of two for one."""
        gap = self.capacity - self.fill[b]
        better = lambda moves: self.gain(moves) > 0
        if (i := self.largest(gap, 0, bin_=b, gains=lambda i: better([(i, b)]))) is not None:
            return [(i, b)]
        for a in {self.sizes[i]: i for i in self.items[b]}.values():
            s = self.sizes[a]
            if (i := self.largest(s + gap, s, bin_=b, gains=lambda i: better([(i, b), (a, self.at[i])]))) is not None:
                return [(i, b), (a, self.at[i])]
            firsts = self.there & ((1 << (s + gap)) - 1)
            while firsts:
                first = firsts.bit_length() - 1
                firsts ^= 1 << first
                x = self.emptiest(first, bin_=b)
                if x is None:
                    continue
                y = self.largest(min(first, s + gap - first), max(0, s - first), x, bin_=b, gains=lambda y: better([(x, b), (y, b), (a, self.at[y])]) or better([(x, b), (y, b), (a, self.at[x])]))
                if y is not None:
                    home = self.at[y] if better([(x, b), (y, b), (a, self.at[y])]) else self.at[x]
                    return [(x, b), (y, b), (a, home)]
        return None


def improve(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Local search between underfull bins until no step is left; every step raises the sum of squared fills, so it ends."""
    full = [b for b in bins if sum(sizes[i] for i in b) == capacity]
    part = Bins([b for b in bins if sum(sizes[i] for i in b) < capacity], sizes, capacity)
    moved = True
    while moved:
        moved = False
        for b in sorted(range(len(part.items)), key=lambda b: -part.fill[b]):
            while part.items[b] and part.fill[b] < capacity and (moves := part.step(b)):
                part.move(moves)
                moved = True
    return full + [b for b in part.items if b]


def pack_block(size: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["length"].tolist()
        bins = improve(best_fit(sizes, size), sizes, size)
        first, seq, offset = int(pdf["block"].iloc[0]) << 32, [0] * len(sizes), [0] * len(sizes)
        for n, items in enumerate(bins):
            at = 0
            for i in items:
                seq[i], offset[i] = first + n, at
                at += sizes[i]
        return pdf.drop(columns="block").assign(sequence_id=seq, offset=offset)

    return run


def pack(docs: DataFrame, spec: str, pattern: str, size: int = 1024, end_id: int = 2, block_rows: int = 20_000) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of docs (doc_id, text)."""
    cut = materialise(pieces(docs, spec, pattern, size, end_id), "pieces").withColumn("row", F.monotonically_increasing_id())
    whole = cut.filter(F.col("length") == size).withColumn("sequence_id", -F.col("row") - 1).withColumn("offset", F.lit(0).cast("long")).drop("row")
    short = cut.filter(F.col("length") < size)
    blocks = max(1, -(-short.count() // block_rows))
    dealt = short.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).drop("row")
    return dealt.groupBy("block").applyInPandas(pack_block(size), PLACED).unionByName(whole)
