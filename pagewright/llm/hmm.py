"""Language-model scoring with a hidden Markov model.

Latent states emit token classes: each of the most frequent training tokens is a class of its own,
any other token belongs to one of a fixed number of classes by its last two characters, and the end
is a class. Within its class a token has a smoothed relative frequency. Baum-Welch counts are summed
over all training rows across partitions, round by round until the likelihood of the training rows
stops rising; the driver gets states x classes numbers a round. The first of these rounds starts from
states that rounds over a sample of bounded size, the best of several starts, have set apart. The scaled forward recursion then
computes the exact probability of each text's token sequence.

The frequencies of all training tokens stay in a table: frequent ones, a fixed number, go to the
workers; the others are looked up by a join on the token, so nothing that grows is broadcast.

Tokens are words, A-Z lower-cased, then one end. Defined results: null and empty texts are the end
alone; repeated rows are scored each; which of equally frequent tokens count as
frequent follows from their hash; texts of any length are scored whole; without training rows N and V are 0, every token
is unknown; an empty table gives an empty result; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from pagewright.functions.ship import ship
from pagewright.llm.common import materialise, release

END = b"\n"  # no word can be it
FLUSH = 200_000
STORE = 200_000  # tokens a task keeps with their classes
LEAST_RISE = 1e-4  # nats a token; a round that gains less ends the training
START_ROUNDS = 30  # at least; from the symmetric start the likelihood hardly rises at first
START_TOKENS = 200_000
STARTS = (7, 8, 9)  # seeds; the likeliest after its rounds is kept


@dataclass(frozen=True)
class Classes:
    """own: frequent token -> class; others: `rest` classes by suffix."""

    own: dict[bytes, int]
    rest: int

    @property
    def n(self) -> int:
        return len(self.own) + self.rest

    def of(self, token: bytes) -> int:
        found = self.own.get(token)
        return len(self.own) + zlib.crc32(token.decode()[-2:].encode()) % self.rest if found is None else found


class Known(dict):
    """token -> class, worked out once per token and task; emptied when full."""

    def __init__(self, classes: Classes) -> None:
        self.classes = classes

    def __missing__(self, token: bytes) -> int:
        if len(self) >= STORE:
            self.clear()
        self[token] = found = self.classes.of(token)
        return found


class Codes(dict):
    """token -> its number among the n frequent ones, or n + its class; other tokens are dropped when there are too many."""

    def __init__(self, classes: Classes, frequent: dict[bytes, int]) -> None:
        self.classes, self.frequent, self.n = classes, frequent, len(frequent)
        self.update(zip(frequent, range(self.n)))

    def __missing__(self, token: bytes) -> int:
        if len(self) >= STORE + self.n:
            self.clear()
            self.update(zip(self.frequent, range(self.n)))
            if token in self:
                return self[token]
        self[token] = found = self.n + self.classes.of(token)
        return found


def tokens(text: str | None) -> list[bytes]:
    """bytes.split cuts at exactly the six ASCII spaces, bytes.lower changes A-Z only."""
    return [*(text or "").encode().lower().split(), END]


def batches_of(seqs: list[np.ndarray], cells: int = 600_000) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Row numbers, lengths and padded classes of sequences of like length, longest first, so that rows end in order."""
    order = sorted(range(len(seqs)), key=lambda i: -len(seqs[i]))
    at = 0
    while at < len(order):
        longest = len(seqs[order[at]])
        part = order[at : at + max(1, cells // longest)]
        obs = np.zeros((longest, len(part)), np.int32)
        for j, i in enumerate(part):
            obs[: len(seqs[i]), j] = seqs[i]
        yield part, np.array([len(seqs[i]) for i in part]), obs
        at += len(part)


@dataclass
class Model:
    first: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # classes x states

    def forward(self, lengths: np.ndarray, obs: np.ndarray, keep: bool = False):
        """Natural log likelihoods; with keep also the scaled alphas (states x rows), the scales and the rows still running at each step."""
        running = (lengths[None, :] > np.arange(len(obs))[:, None]).sum(axis=1)
        total, product, alphas, scales = np.zeros(len(lengths)), np.ones(len(lengths)), [], []
        emit, move = np.ascontiguousarray(self.emit.T), np.ascontiguousarray(self.move.T)
        a = None
        for t, n in enumerate(running):
            e = emit.take(obs[t, :n], axis=1)
            a = (self.first[:, None] * e) if a is None else (move @ a[:, :n]) * e
            c = a.sum(axis=0)
            a /= c
            product[:n] *= c
            if t % 8 == 7 or t == len(running) - 1:  # far from the end of a double's range
                total += np.log(product)
                product[:] = 1
            if keep:
                alphas.append(a)
                scales.append(c)
        return (total, alphas, scales, running) if keep else total

    def counts(self, lengths: np.ndarray, obs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected first states, moves and emissions (Baum-Welch) of one batch."""
        return self.expected(lengths, obs)[1:]

    def expected(self, lengths: np.ndarray, obs: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """The log likelihood of one batch and its counts."""
        total, alphas, scales, running = self.forward(lengths, obs, keep=True)
        k, emit = len(self.first), np.ascontiguousarray(self.emit.T)
        moves, emits = np.zeros((k, k)), np.zeros_like(self.emit)
        b = np.zeros((k, 0))
        for t in range(len(running) - 1, -1, -1):
            n = running[t]
            if b.shape[1] < n:
                b = np.concatenate([b, np.ones((k, n - b.shape[1]))], axis=1)
            if t:
                x = emit.take(obs[t, :n], axis=1)
                x *= b
                x /= scales[t]
                moves += self.move * (alphas[t - 1][:, :n] @ x.T)
            alphas[t] *= b  # now the states' probabilities given the whole row
            if t:
                b = self.move @ x
        flat, seen = np.concatenate(alphas, axis=1), np.concatenate([obs[t, :n] for t, n in enumerate(running)])
        for s in range(k):
            emits[:, s] = np.bincount(seen, flat[s], len(self.emit))
        return total.sum(), alphas[0].sum(axis=1), moves, emits


def token_counts(rows: DataFrame) -> DataFrame:
    """token, c over all rows (text), the end included as a line feed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], names=["token", "c"])
            seen.clear()
            return got

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for text in batch.column(0).slice(at, 500).to_pylist():
                    seen.update(tokens(text))
                if len(seen) > FLUSH:
                    yield out()
        yield out()

    return rows.select("text").mapInArrow(count, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, most: int) -> dict[bytes, int]:
    """At most `most` tokens with their counts, the most frequent first.

    All above a cut between powers of 2^(1/8), and of the band below it those of the first of 4096 hash
    buckets, as many as fit. Both cuts come from a bounded number of sums, so that neither they nor the
    tokens that reach the driver grow with the data.
    """

    def cut(df: DataFrame, key: Column, room: int) -> tuple[int | None, int]:
        """The last key up to which, in order, all rows have room, and the room left."""
        last = None
        for r in sorted(df.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r.k):
            if r.n > room:
                break
            last, room = r.k, room - r.n
        return last, room

    band, bucket = -F.floor(8 * F.log2("c")).cast("int"), F.pmod(F.xxhash64("token"), F.lit(4096)).cast("int")
    first, room = cut(counts, band, most)
    above = F.lit(False) if first is None else band <= first
    below = counts.filter(~above)
    edge = below.agg(F.min(band)).first()[0]
    last = None if edge is None else cut(below.filter(band == edge), bucket, room)[0]
    rows = counts.filter(above if last is None else above | ((band == edge) & (bucket <= last))).collect()
    return {r.token.encode(): r.c for r in sorted(rows, key=lambda r: (-r.c, r.token))}


def start_model(states: int, mass: np.ndarray, seed: int = 7) -> Model:
    """Class frequencies, each state with its own seeded perturbation."""
    rng = np.random.default_rng(seed)
    emit = (mass[:, None] + 1) * rng.uniform(0.5, 1.5, (len(mass), states))
    move = rng.uniform(0.5, 1.5, (states, states)) + np.eye(states)
    return Model(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def sequences(batch: pa.RecordBatch, column: int, known: Known) -> list[np.ndarray]:
    return [np.fromiter(map(known.__getitem__, ws), np.int32, len(ws)) for ws in map(tokens, batch.column(column).to_pylist())]


def encoded(rows: DataFrame, classes: Classes) -> DataFrame:
    """classes: the class numbers of each row (text), in the bytes of kind_of()."""
    kind = kind_of(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(classes)
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                seqs = sequences(batch.slice(at, 4000), 0, known)
                yield pa.RecordBatch.from_arrays([pa.array([s.astype(kind).tobytes() for s in seqs], pa.binary())], names=["classes"])

    return rows.select("text").mapInArrow(run, "classes binary")


def kind_of(classes: Classes) -> np.dtype:
    return np.dtype("<u2" if classes.n <= 1 << 16 else "<u4")


def table_of(seqs: list[np.ndarray], model: Model) -> np.ndarray:
    """Rows of first states, moves and emissions, and a last one that begins with the log likelihood."""
    likely, table = 0.0, np.zeros((1 + len(model.first) + len(model.emit), len(model.first)))
    for _, lengths, obs in batches_of(seqs, cells=1_200_000):
        total, first, moves, emits = model.expected(lengths, obs)
        likely, table = likely + total, table + np.concatenate([first[None], moves, emits])
    return np.concatenate([table, [[likely] + [0.0] * (len(model.first) - 1)]])


def estimated(table: np.ndarray, states: int, smoothing: float = 0.01) -> Model:
    table = table[:-1] + smoothing
    first, move, emit = table[0], table[1 : 1 + states], table[1 + states :]
    return Model(first / first.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def over_all(coded: DataFrame, model: Model, classes: Classes) -> np.ndarray:
    """table_of() all rows (classes)."""
    kind = kind_of(classes)

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of([], model)
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                table += table_of([np.frombuffer(x, kind) for x in batch.column(0).slice(at, 4000).to_pylist()], model)
        at, k = np.nonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(k, pa.int32()), pa.array(table[at, k])], names=["row", "state", "n"])

    table = table_of([], model)
    for r in coded.mapInArrow(expect, "row int, state int, n double").groupBy("row", "state").agg(F.sum("n").alias("n")).collect():
        table[r.row, r.state] += r.n
    return table


def baum_welch(model: Model, expect: Callable[[Model], np.ndarray], n: float, at_least: int = 1) -> tuple[Model, list[float]]:
    """Rounds over n tokens until their log likelihood a token stops rising, after at_least rounds; expect gives a model's table_of(). Also that likelihood at each round."""
    likely: list[float] = []
    while True:
        table = expect(model)
        likely.append(table[-1, 0] / n)
        if len(likely) > at_least and likely[-1] - likely[-2] < LEAST_RISE:
            return model, likely
        model = estimated(table, len(model.first))


def trained(train: DataFrame, states: int, mass: np.ndarray, classes: Classes, n: int) -> Model:
    """The model of Baum-Welch over all rows of train (text), which have n tokens."""
    coded = materialise(encoded(train, classes), "classes")
    some = coded
    if n > START_TOKENS:
        some = coded.filter(F.pmod(F.xxhash64("classes"), F.lit(1 << 30)) < int((1 << 30) * START_TOKENS / n))
    # distinct, so that a large group of copies can't all be in the sample
    seqs = [np.frombuffer(x, kind_of(classes)) for x in sorted(bytes(r.classes) for r in some.distinct().collect())]
    model = start_model(states, mass)
    if seqs:
        tried = [baum_welch(start_model(states, mass, seed), lambda m: table_of(seqs, m), sum(map(len, seqs)), START_ROUNDS) for seed in STARTS]
        model, _ = max(tried, key=lambda x: x[1][-1])
    model, _ = baum_welch(model, lambda m: over_all(coded, m, classes), n, 1 if seqs else START_ROUNDS)
    release(coded)
    return model


def score(docs: DataFrame, held_out: Column, states: int = 4, own: int = 2000, rest: int = 1024, frequent: int = 150_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of docs (doc_id, text); rows not held out train."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = docs.filter(~F.col("held_out"))
    counts = materialise(token_counts(train), "counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    counted = most_frequent(counts, frequent)
    classes = Classes({w: i for i, w in enumerate(list(counted)[:own])} | ({END: min(own, len(counted))} if END not in list(counted)[:own] else {}), rest)
    # mass and number of the tokens of each class: frequent classes from their own counts, the others summed by suffix
    mass, kinds = np.zeros(classes.n), np.zeros(classes.n)
    for w, i in classes.own.items():
        mass[i], kinds[i] = counted.get(w, 0), w in counted
    suffix = F.crc32(F.right("token", F.lit(2)).cast("binary")) % rest
    for r in counts.groupBy(suffix.alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
        mass[len(classes.own) + r.k], kinds[len(classes.own) + r.k] = r.c, r.v
    for w in classes.own:
        if w in counted:
            i = len(classes.own) + zlib.crc32(w.decode()[-2:].encode()) % rest
            mass[i], kinds[i] = mass[i] - counted[w], kinds[i] - 1
    model = trained(train, states, mass, classes, n) if n else start_model(states, mass)
    log_mass, base = np.log10(mass + kinds + 1), math.log10(max(1, n + v + 1))
    shared = spark.sparkContext.broadcast(counted)  # `frequent` tokens at most

    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("log_c", pa.float64()), ("hmm", pa.float64()), ("rare", pa.list_(pa.struct([("token", pa.string()), ("tf", pa.int64())])))])

    class_of = np.array([*map(classes.of, counted), *range(classes.n)], np.int32)
    logs = np.log10(np.array([*counted.values(), *[0] * classes.n]) + 1.0)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, row = Codes(classes, shared.value), TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                lists = [tokens(t) for t in part.column(1).to_pylist()]
                coded = [np.fromiter(map(codes.__getitem__, ws), np.int32, len(ws)) for ws in lists]
                seqs, hmm = [class_of[c] for c in coded], np.zeros(len(coded))
                for numbers, lengths, obs in batches_of(seqs, cells=4_000_000):
                    hmm[numbers] = model.forward(lengths, obs) / math.log(10) - np.add.reduceat(np.concatenate([log_mass[seqs[i]] for i in numbers]), np.cumsum(lengths) - lengths)
                n_known, log_c, ends, rare, times = [], [], [0], [], []
                for ws, code in zip(lists, coded, strict=True):
                    unknown = np.flatnonzero(code >= codes.n)
                    n_known.append(len(ws) - len(unknown))
                    log_c.append(logs[code].sum())
                    for w, k in Counter([ws[i] for i in unknown]).items():
                        rare.append(w.decode())
                        times.append(k)
                    ends.append(len(rare))
                pairs = pa.StructArray.from_arrays([pa.array(rare, pa.string()), pa.array(times, pa.int64())], names=["token", "tf"])
                columns = [range(row, row + len(lists)), part.column(0), part.column(2), [len(ws) for ws in lists], n_known, log_c, hmm, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], names=schema.names)
                row += len(lists)

    spark_schema = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, log_c double, hmm double, rare array<struct<token:string,tf:bigint>>"
    walked = materialise(docs.select(F.col("doc_id").cast("long"), "text", "held_out").mapInArrow(walk, spark_schema), "walked")
    rare = walked.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.tf")
    found = rare.join(counts, "token").select("row", (F.col("tf")).alias("n_known"), (F.col("tf") * F.log10(F.col("c") + 1)).alias("log_c"))
    none = found.select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("boolean").alias("held_out"), F.lit(0).cast("long").alias("n_tokens"), "n_known", "log_c", F.lit(0.0).alias("hmm"))
    summed = walked.drop("rare").unionByName(none).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("log_c").alias("log_c"), F.sum("hmm").alias("hmm")
    )
    return summed.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("log_c") - F.col("n_tokens") * F.lit(base)).alias("base_score"), (F.col("hmm") + F.col("log_c")).alias("score"),
    )
