"""Near-duplicate detection: a chosen-path set similarity join on word shingles.

Documents with the same shingle set form a class, known by a 128-bit fingerprint; only classes are
joined. Each class has `3 * trees` minwise values. Every tree sends it to the node that three of
them select; nodes with more than `small` classes branch, each class into `branches` children by
three values chosen by the node's path among minwise values that are fresh at each level; smaller
nodes are compared exhaustively, within one task each and so in bounded memory. Independent trees
bring the recall of a pair at similarity s to 1 - (1 - s^3)^trees where its nodes are small. Where
they branch, a pair stays together in a branching with branches * s^3 expected children a level, over
1.5 at s = 0.8, so that it rarely dies out. Nodes still large after the last level are compared in
blocks, every two of which meet.

Only the connection that links make is looked for: before a large node branches its classes meet
two pivots, and it is done if they are one component then; in a small node two classes that links
connect already are not confirmed again. So a node gives fewer links than it has classes, however
many pairs of copies it holds. Links are always confirmed on the full sets (of 64-bit shingle hashes,
exact but for collisions), never on the minwise values; pairs whose minwise values agree 4 standard
deviations less than at the threshold are taken to be none.

Nothing but a Bloom filter of bounded size reaches the driver; labels, links and sets stay in tables.

Defined results: words are runs of non-space, A-Z lower-cased; texts with fewer words than a shingle
are one shingle; null texts and texts without words have no set and link with nothing; texts of any
length are taken whole; repeated rows link; rows are documents even where doc_ids repeat; a null
doc_id links as any other and is never the smallest of a component with other ids; an empty table
gives an empty result; other columns, whatever their names, are ignored by near_duplicates() and pass
through keep_one().
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pagewright.functions.ship import ship
from pagewright.llm.common import materialise, release

WORDS_KEPT = 400_000
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Hashes(dict):
    """word -> 64-bit hash; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def mix(z: np.ndarray, by: np.uint64 = M2) -> np.ndarray:
    z = (z ^ (z >> np.uint64(31))) * by
    return z ^ (z >> np.uint64(29))


def shingle_set(text: str | None, width: int, hashes: Hashes) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    ws = (text or "").encode().lower().split()
    h = np.fromiter(map(hashes.__getitem__, ws), np.uint64, len(ws))
    k = min(width, len(h))
    if not k:
        return h
    s = mix(h[: len(h) - k + 1] + np.uint64(k))
    for j in range(1, k):
        s = mix(s * M1 + h[j : len(h) - k + 1 + j])
    return np.unique(s)


def fingerprint(s: np.ndarray) -> bytes | None:
    import xxhash

    return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


def minwise(s: np.ndarray, seeds: np.ndarray) -> bytes:
    """The least of each seeded permutation (of hashes, so that a product with an odd seed permutes well enough), 32 bits each."""
    least = np.full(len(seeds), ~np.uint64(0))
    for at in range(0, len(s), 8192):
        np.minimum(least, (s[None, at : at + 8192] * seeds[:, None]).min(axis=1), out=least)
    return mix(least).astype(np.uint32).tobytes()


def sketches(docs: DataFrame, width: int, values: int) -> DataFrame:
    """doc_id, h (hash of the text), n, fp, sig of each row; fp and sig are null where there is no set."""
    seeds = np.random.default_rng(11).integers(1, 1 << 63, values, dtype=np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, n, fp, sig = batch.slice(at, 500), [], [], []
                for t in part.column(2).to_pylist():
                    s = shingle_set(t, width, hashes)
                    n.append(len(s))
                    fp.append(fingerprint(s))
                    sig.append(minwise(s, seeds) if len(s) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(sig, pa.binary())], names=["doc_id", "h", "n", "fp", "sig"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), "text").mapInArrow(run, "doc_id long, h long, n long, fp binary, sig binary")


def seen_bits(ids: DataFrame, most_bits: int) -> np.ndarray | None:
    """A Bloom filter of the ids (column of longs), its bits OR-ed on the executors; None where `most_bits` are under 8 an id."""
    n = ids.count()
    if 8 * n > most_bits:
        return None
    n_words = max(1, -(-12 * n // 64))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(n_words, np.uint64)
        for batch in batches:
            for at in spots(batch.column(0).to_numpy(), 64 * n_words):
                np.bitwise_or.at(words, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(words[at].view(np.int64))], names=["w", "bits"])

    words = np.zeros(n_words, np.uint64)
    got = ids.mapInArrow(mark, "w int, bits long").groupBy("w").agg(F.bit_or("bits").alias("bits")).toArrow()
    words[got.column("w").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return words


def spots(ids: np.ndarray, n_bits: int) -> list[np.ndarray]:
    x = ids.astype(np.int64).view(np.uint64)
    return [mix((x + np.uint64(k + 1)) * M1) % np.uint64(n_bits) for k in range(4)]


def sets_of(docs: DataFrame, reps: DataFrame, width: int, most_bits: int = 1 << 24) -> DataFrame:
    """c, s (sorted 64-bit shingle hashes as bytes) of the classes reps (c, fp, doc_id of one row).

    The texts are read again. Rows that cannot be one of reps are left out before their sets are made:
    by a Bloom filter of the doc_ids while it fits in most_bits, beyond that by a join on the doc_id.
    """
    ids = reps.filter("doc_id is not null").select("doc_id").distinct()
    words = seen_bits(ids, most_bits)
    if words is None:
        docs = docs.join(ids, "doc_id", "left_semi").unionByName(docs.filter("doc_id is null"))
    shared = None if words is None else docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            if shared is not None:
                ids, maybe = batch.column(0), np.ones(batch.num_rows, bool)
                for at in spots(ids.fill_null(0).to_numpy(zero_copy_only=False), 64 * len(shared.value)):
                    maybe &= (shared.value[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
                batch = batch.filter(pa.array(maybe | ids.is_null().to_numpy(zero_copy_only=False)))
            for at in range(0, batch.num_rows, 200):
                sets = [s for t in batch.slice(at, 200).column(1).to_pylist() if len(s := shingle_set(t, width, hashes))]
                yield pa.RecordBatch.from_arrays([pa.array([fingerprint(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["fp", "s"])

    made = docs.select("doc_id", "text").mapInArrow(run, "fp binary, s binary")
    return made.join(reps.select("c", "fp"), "fp").select("c", "s").dropDuplicates(["c"])


def measured(nodes: DataFrame) -> DataFrame:
    """nodes (node, tree, c, n) with their number of classes, of shingles and two pivots; nodes of one class are left out."""
    pivot = lambda k: F.min(F.col("c").bitwiseXOR(F.lit(k))).bitwiseXOR(F.lit(k))  # noqa: E731  an order of its own
    sizes = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"), pivot(0x2A5F3C9966D1E8B7).alias("p0"), pivot(0x55A0C3663E2D1748).alias("p1"))
    return nodes.join(materialise(sizes.filter("size > 1"), "sizes"), "node")  # written, so that the join of a node with many rows can be split


def roots(classes: DataFrame, trees: int) -> DataFrame:
    """node, tree, c, n, ...: each tree's first node of each class (c, n, sig), where it has two classes or more."""
    nodes = F.array(*[F.xxhash64(F.lit(t), F.substr("sig", F.lit(12 * t + 1), F.lit(12))) for t in range(trees)])
    return measured(classes.select("c", "n", F.posexplode(nodes).alias("tree", "node")))


def fresh_values(sets: DataFrame, level: int, values: int) -> DataFrame:
    """c, fresh: minwise values of the sets (c, s) that no other level has."""
    seeds = np.random.default_rng([11, level]).integers(1, 1 << 63, values, dtype=np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fresh = [minwise(np.frombuffer(s, np.uint64), seeds) for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fresh, pa.binary())], names=["c", "fresh"])

    return sets.select("c", "s").mapInArrow(run, "c long, fresh binary")


def branched(nodes: DataFrame, branches: int, values: int) -> DataFrame:
    """The children of nodes (with fresh), each chosen by three fresh values that follow from the node's path."""
    child = F.explode(F.sequence(F.lit(0), F.lit(branches - 1)))
    chosen = [F.pmod(F.xxhash64("node", "child", F.lit(k)), F.lit(values)).cast("int") for k in range(3)]
    key = F.xxhash64(*[F.substr("fresh", w * 4 + 1, F.lit(4)) for w in chosen])
    return measured(nodes.withColumn("child", child).select(F.xxhash64("node", "child", key).alias("node"), F.lit(-1).alias("tree"), "c", "n"))


def in_blocks(nodes: DataFrame, small: int, heavy: int) -> DataFrame:
    """node, tree, c: every two classes of a large node in one small node or more; a class is in as many as its node has blocks."""
    parts = F.greatest(F.ceil(2 * F.col("size") / small), F.ceil(2 * F.col("weight") / heavy)).cast("long")
    own = F.pmod(F.xxhash64("c"), F.col("parts"))
    dealt = nodes.withColumn("parts", parts).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    return dealt.select(F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("node"), F.lit(-1).alias("tree"), "c")


def by_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches sorted by their first column, cut where it changes, each with the bounds of its groups."""
    left: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if left is not None:
            batch = pa.concat_batches([left, batch])
        key = batch.column(0).to_numpy()
        bounds = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        left = batch.slice(int(bounds[-1]))
        if len(bounds) > 1:
            yield batch.slice(0, int(bounds[-1])), bounds
    if left is not None:
        yield left, np.array([0, left.num_rows])


def close_pairs(batch: pa.RecordBatch, bounds: np.ndarray, per_cent: int, trees: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Numbers of two rows, and how many minwise values agree, of the pairs within a group (node, c, tree, n, sig, mask, ...) that may be links.

    A pair that meets in several trees counts in the first one whose node is small, which `mask` tells.
    """
    values = 3 * trees
    sig = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint32).reshape(-1, values)
    tree, n, mask = batch.column(2).to_numpy(), batch.column(3).to_numpy(), batch.column(5).to_numpy()
    least, bits = least_agreeing(values, per_cent), np.arange(trees)

    def close(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sized = 100 * np.minimum(n[a], n[b]) >= per_cent * np.maximum(n[a], n[b])
        a, b = a[sized], b[sized]
        same = sig[a] == sig[b]
        like = same.sum(axis=1)
        near = like >= least
        a, b, like, same = a[near], b[near], like[near], same[near]
        met = same.reshape(len(a), trees, 3).all(axis=2) & ((mask[a][:, None] >> bits) & 1 == 1)
        own = np.where(met.any(axis=1), met.argmax(axis=1), -1) == tree[a]
        return a[own], b[own], like[own]

    starts, sizes = bounds[:-1], np.diff(bounds)
    for m in np.unique(sizes):
        if m < 2:
            continue
        if m <= 24:
            i, j = np.triu_indices(m, 1)
            first = starts[sizes == m]
            for at in range(0, len(first), step := max(1, 40_000 // len(i))):
                part = first[at : at + step, None]
                yield close((part + i).ravel(), (part + j).ravel())
        else:
            for at in starts[sizes == m]:
                got, found = [], 0
                for i in range(m - 1):
                    got.append(close(np.full(m - 1 - i, at + i), np.arange(at + i + 1, at + m)))
                    found += len(got[-1][0])
                    if found > 200_000 or i == m - 2:
                        yield tuple(np.concatenate(x) for x in zip(*got, strict=True))
                        got, found = [], 0


def least_agreeing(values: int, per_cent: int) -> int:
    """Pairs at the threshold agree in fewer minwise values with a probability of 3 in 100,000 (4 standard deviations)."""
    p = per_cent / 100
    return int(values * p - 4 * (values * p * (1 - p)) ** 0.5)


def common(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum())


def linked(x: np.ndarray, y: np.ndarray, per_cent: int) -> bool:
    c = common(x, y)
    return 100 * c >= per_cent * (len(x) + len(y) - c)


def root_of(parent: dict[int, int], x: int) -> int:
    while (up := parent.setdefault(x, x)) != x:
        parent[x] = parent[up]
        x = up
    return x


NODE = "node long, c long, tree int, n long, sig binary, mask long"


def compared(leaves: DataFrame, classes: DataFrame, sets: DataFrame, per_cent: int, trees: int) -> DataFrame:
    """Links (a, b) that connect what is linked in the small nodes leaves (node, tree, c): all pairs of a node are compared.

    First the sketches are, and only classes that may have a link in a node bring their sets there.
    Within a node a pair that earlier links connect already needs no confirmation, so a node gives
    fewer links than it has classes.
    """
    mask = leaves.groupBy("c").agg(F.bit_or(F.when(F.col("tree") >= 0, F.call_function("shiftleft", F.lit(1).cast("long"), F.col("tree"))).otherwise(F.lit(0).cast("long"))).alias("mask"))
    rows = leaves.join(classes.select("c", "n", "sig").join(mask, "c"), "c").select("node", "c", "tree", "n", "sig", "mask")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in by_groups(batches):
            keep = np.zeros(batch.num_rows, bool)
            for a, b, _ in close_pairs(batch, bounds, per_cent, trees):
                keep[a] = keep[b] = True
            yield batch.filter(pa.array(keep))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in by_groups(batches):
            ids, sets, found, parent = batch.column(1).to_pylist(), batch.column(6), [], {}
            for a, b, like in close_pairs(batch, bounds, per_cent, trees):
                for i in np.argsort(-like, kind="stable"):
                    x, y = int(a[i]), int(b[i])
                    if root_of(parent, x) != root_of(parent, y) and linked(*(np.frombuffer(sets[k].as_buffer(), np.uint64) for k in (x, y)), per_cent):
                        parent[root_of(parent, x)] = root_of(parent, y)
                        found.append((ids[x], ids[y]))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    maybe = rows.repartition("node").sortWithinPartitions("node").mapInArrow(near, NODE)
    return maybe.join(sets, "c").select("node", "c", "tree", "n", "sig", "mask", "s").repartition("node").sortWithinPartitions("node").mapInArrow(exact, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Of the pairs (a, b), those that are links on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            yield batch.select(["a", "b"]).filter(pa.array([linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), per_cent) for x, y in both], pa.bool_()))

    left = pairs.join(sets.select(F.col("c").alias("a"), F.col("s").alias("sa")), "a")
    both = left.join(sets.select(F.col("c").alias("b"), F.col("s").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def to_pivots(nodes: DataFrame, classes: DataFrame, per_cent: int, trees: int) -> DataFrame:
    """Pairs (a, b) of each class with the likeliest pivot of its nodes."""
    values = 3 * trees
    agreeing = F.aggregate(F.sequence(F.lit(0), F.lit(values - 1)), F.lit(0), lambda acc, i: acc + (F.substr("sig", i * 4 + 1, F.lit(4)) == F.substr("sig_p", i * 4 + 1, F.lit(4))).cast("int"))
    met = nodes.select("c", F.explode(F.array("p0", "p1")).alias("p")).filter("c <> p").distinct()
    own = classes.select("c", "n", "sig")
    both = met.join(own, "c").join(met.select("p").distinct().join(own.toDF("p", "n_p", "sig_p"), "p"), "p")
    near = both.filter(100 * F.least("n", "n_p") >= per_cent * F.greatest("n", "n_p")).withColumn("like", agreeing).filter(F.col("like") >= least_agreeing(values, per_cent))
    return near.groupBy("c").agg(F.max_by("p", F.struct("like", "p")).alias("b")).select(F.col("c").alias("a"), "b")


def forest(edges: DataFrame) -> DataFrame:
    """The edges (a, b) of each partition as stars around the smallest id of what they connect there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = root_of(parent, x), root_of(parent, y)
                parent[max(x, y)] = min(x, y)
        stars = [(x, r) for x in parent if (r := root_of(parent, x)) != x]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in stars], pa.int64()), pa.array([r for _, r in stars], pa.int64())], names=["a", "b"])

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """id, comp (the smallest id reachable) of the ids in edges (a, b): alternating large and small stars until nothing changes."""
    e = e_now = materialise(forest(edges.filter("a <> b")).distinct(), "edges")
    before = None
    while True:
        two = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = two.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e = two.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))  # large star
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        hung = e.join(least, "a")
        e = hung.select("a", F.col("m").alias("b")).unionByName(hung.select(F.col("b").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct()  # small star
        e, last = materialise(e, "edges"), e_now
        release(last)
        e_now = e
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    out = e.select(F.col("a").alias("id"), F.col("b").alias("comp")).unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct())
    out._pagewright_path = e._pagewright_path
    return out


def link(classes: DataFrame, docs: DataFrame, width: int, per_cent: int, trees: int = 16, small: int = 4096, heavy: int = 4_000_000, branches: int = 3, depth: int = 8) -> DataFrame | None:
    """id, comp of every class that is linked with another; None if none is. classes: c, fp, n, sig, doc_id of one row.

    Nodes of at most `small` classes and `heavy` shingles are leaves. In larger ones each class first
    meets the pivots of its nodes; nodes that are one component then are done, the others branch. After
    `depth` levels what is still large is compared in blocks.
    """
    values = 3 * trees
    nodes = materialise(roots(classes, trees), "nodes")
    if nodes.isEmpty():
        release(nodes)
        return None
    inside = nodes.select("c").distinct()
    sets = materialise(sets_of(docs, classes.join(inside, "c", "left_semi").select("c", "fp", "doc_id"), width), "sets")
    is_leaf = (F.col("size") <= small) & (F.col("weight") <= heavy)
    leaves, tables, links = [nodes.filter(is_leaf).select("node", "tree", "c")], [nodes, sets], []
    large = nodes.filter(~is_leaf)
    for level in range(depth + 1):
        if large.isEmpty():
            break
        links.append(materialise(confirmed(to_pivots(large, classes, per_cent, trees), sets, per_cent), "links"))
        labels = components(one(links))
        known = large.join(labels.select(F.col("id").alias("c"), "comp"), "c", "left").withColumn("comp", F.coalesce("comp", "c"))
        mixed = known.groupBy("node").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("node")
        large = materialise(large.join(mixed, "node"), "mixed")
        release(labels)
        tables.append(large)
        if level == depth:
            leaves.append(in_blocks(large, small, heavy))
            break
        fresh = fresh_values(sets.join(large.select("c").distinct(), "c", "left_semi"), level, values)
        nodes = materialise(branched(large.join(fresh, "c"), branches, values), "nodes")
        tables.append(nodes)
        leaves.append(nodes.filter(is_leaf).select("node", "tree", "c"))
        large = nodes.filter(~is_leaf)
    links.append(materialise(compared(one(leaves), classes, sets, per_cent, trees), "links"))
    release(*tables)
    every = one(links)
    labels = None if every.isEmpty() else components(every)
    release(*links)
    return labels


def one(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def assigned(docs: DataFrame, width: int, per_cent: int, **how) -> DataFrame:
    """doc_id, h, n, component_id, comp of each row of docs (doc_id, text); comp tells components apart and is null where there is no set."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = materialise(sketches(docs, width, 3 * how.get("trees", 16)), "sketches")
    one_row = rows.filter("fp is not null").groupBy("fp").agg(F.first("n").alias("n"), F.first("sig").alias("sig"), F.min("doc_id").alias("doc_id"))
    classes = materialise(one_row.withColumn("c", F.monotonically_increasing_id()), "classes")
    labels = link(classes, docs, width, per_cent, **how)
    named = classes.select("fp", "doc_id", "c")
    named = named.withColumn("comp", F.col("c")) if labels is None else named.join(labels.withColumnRenamed("id", "c"), "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    least = materialise(named.groupBy("comp").agg(F.min("doc_id").alias("component_id")), "least")
    of = materialise(named.join(least, "comp").select("fp", "component_id", "comp"), "of")
    release(classes, least, *([labels] if labels is not None else []))
    # rows without a set never meet a join
    got = rows.filter("fp is not null").select("doc_id", "h", "n", "fp").join(of, "fp").select("doc_id", "h", "n", "component_id", "comp")
    none = rows.filter("fp is null").select("doc_id", "h", "n", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("comp"))
    return got.unionByName(none)


def near_duplicates(docs: DataFrame, width: int = 5, per_cent: int = 80, **how) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of docs (doc_id, text)."""
    out = assigned(docs, width, per_cent, **how)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id").eqNullSafe(F.col("component_id")), F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, per_cent: int = 80, **how) -> DataFrame:
    """docs with one row of each component: of its smallest doc_id (null ids last), among several of that id the smallest text hash; rows without a set all stay.

    Rows are told apart by doc_id and text hash; of rows that are equal in both one stays.
    """
    rows = assigned(docs, width, per_cent, **how).filter("comp is not null").withColumn("id", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h"))
    best = rows.groupBy("comp").agg(F.min("id").alias("best"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    best = materialise(best, "best")  # written, so that the join of a component with many rows can be split
    # of the rows of components of several: the key, whether it is the one that stays, how many rows have it
    found = rows.join(best, "comp").groupBy("doc_id", "h").agg(F.max((F.col("id") == F.col("best")).cast("int")).alias("stays"), F.count(F.lit(1)).alias("times"))
    found = materialise(found.withColumnsRenamed({"doc_id": "__id", "h": "__h"}), "found")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    on = F.col("__row.doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("__row.text") == F.col("__h"))
    stay = whole.join(found.filter("stays = 0 or times > 1").select("__id", "__h"), on, "left_anti").select("__row.*")
    twins = whole.join(found.filter("stays = 1 and times > 1").select("__id", "__h"), on).dropDuplicates(["__id", "__h"]).select("__row.*")
    return stay.unionByName(twins)
