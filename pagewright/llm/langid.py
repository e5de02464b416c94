"""Language identification by segmentation-marginalised unigrams.

The pieces are a fixed public vocabulary. Each language has piece probabilities; the probability of
a word is the sum over all its segmentations into pieces (forward algorithm), that of a text the
product over its words, and the language of the highest one is predicted. The probabilities are
expected piece counts (forward-backward) under a prior of rank^-1, from all training rows: words are
counted by language first, so that each distinct word is segmented once; the driver gets languages x
pieces numbers.

Words are runs of letters, lower-cased, of any length; sums are kept as logarithms, so long words do
not underflow. A letter that is no piece counts as the unknown piece.

Defined results: null texts and texts without a letter are `und` with score 0, as is every text when
no row has a language to learn; rows with a null language or null text teach nothing; repeated rows
teach as often as they stand there and are each predicted; ties go to the language that sorts first;
an empty table gives an empty result; other columns pass through, but those with the name of an added
column are replaced; more than `max_languages` languages are an error.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pagewright.functions.ship import ship

LETTERS = re.compile(r"[^\W\d_]+")
#: Words kept per worker with their scores; emptied when full.
STORE = 500_000
#: Characters of the texts whose new words are scored together.
TOGETHER = 4_000_000
#: Numbers of a table in memory at a time.
CELLS = 1_500_000
MULT = np.uint64(0x9E3779B97F4A7C15)
START = "▁"
#: Words up to SHORT letters are summed as probabilities times SCALE a letter, which stay in the range of a double.
SHORT, SCALE = 24, 1000.0


def load_pieces(path: str) -> list[str]:
    """The distinct lower-cased pieces of a sentencepiece model, in its order, that are letters after an optional word start."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (sp.id_to_piece(i).lower() for i in range(sp.get_piece_size()))
    return [p for p in dict.fromkeys(plain) if LETTERS.fullmatch(p.removeprefix(START) or "a")]


class Lattice:
    """Finds the pieces in batches of words by rolling hashes, and runs the forward and backward sums over them."""

    def __init__(self, pieces: list[str]) -> None:
        self.n, self.longest = len(pieces), max(map(len, pieces), default=1)
        self.scale = SCALE ** np.array([*map(len, pieces), 1], float)
        self.tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            by_length.setdefault(len(p), []).append(i)
        for n in range(1, self.longest + 1):
            ids = np.array(by_length.get(n, []), np.int64)
            h = np.zeros(len(ids), np.uint64)
            if len(ids):
                codes = np.array([[ord(c) for c in pieces[i]] for i in ids], np.uint64)
                for j in range(n):
                    h = h * MULT + codes[:, j] + np.uint64(1)
            order = np.argsort(h)
            maybe = np.zeros(1 << 18, bool)  # by the top bits of the hash
            maybe[h >> np.uint64(46)] = True
            self.tables.append((maybe, h[order], ids[order]))

    def batches(self, words: list[str], width: int) -> Iterator[np.ndarray]:
        """Numbers of words of like length, so many that a table of `width` numbers a letter is bounded."""
        lengths = np.array([len(w) for w in words])
        order = np.argsort(lengths, kind="stable")
        while len(order):
            n = max(1, CELLS // (int(lengths[order[-1]] + 1) * max(width, self.longest)))
            yield order[-n:]
            order = order[:-n]

    def edges(self, words: list[str]) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray, np.ndarray]]]:
        """Lengths, and (end, start, word numbers, piece ids) of all pieces in the words, by end and start; the unknown piece is id n."""
        lengths = np.array([len(w) for w in words])
        width = int(lengths.max())
        codes = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), np.uint32).reshape(len(words), width).astype(np.uint64).T
        out, h = [], codes
        for n in range(1, min(self.longest, width) + 1):
            h = (h[: width - n + 1] * MULT + codes[n - 1 :] + np.uint64(1)) if n > 1 else codes + np.uint64(1)
            maybe, keys, ids = self.tables[n - 1]
            inside = np.arange(n, width + 1)[:, None] <= lengths
            start, w = np.nonzero(inside if n == 1 else inside & maybe[h >> np.uint64(46)])
            hash_, pid = h[start, w], np.full(len(w), self.n)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hash_), len(keys) - 1)
                hit = keys[at] == hash_
                pid[hit] = ids[at[hit]]
            if n > 1:
                known = pid < self.n
                start, w, pid = start[known], w[known], pid[known]
            cut = np.searchsorted(start, np.arange(width - n + 2))
            out += [(i + n, i, w[a:b], pid[a:b]) for i, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
        out.sort(key=lambda e: e[:2])
        return lengths, out

    def kind(self, lengths: np.ndarray, probs: np.ndarray):
        """How numbers are held and added, multiplied and written: short words as scaled probabilities, others as logarithms."""
        if lengths.max() <= SHORT:
            return 0.0, 1.0, np.add, np.multiply, probs * self.scale.reshape(-1, *[1] * (probs.ndim - 1))
        return -np.inf, 0.0, np.logaddexp, np.add, np.log(probs)

    def score(self, words: list[str], probs: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language; probs: (pieces + 1) x languages."""
        out = np.zeros((len(words), probs.shape[1]))
        for numbers in self.batches(words, probs.shape[1]):
            lengths, edges = self.edges([words[i] for i in numbers])
            none, sure, plus, times, p = self.kind(lengths, probs)
            f = np.full((int(lengths.max()) + 1, len(numbers), probs.shape[1]), none)
            f[0] = sure
            for end, start, w, pid in edges:
                f[end, w] = plus(f[end, w], times(f[start, w], p[pid]))
            got = f[lengths, np.arange(len(numbers))]
            out[numbers] = np.log(got) - lengths[:, None] * np.log(SCALE) if sure else got
        return out

    def expected(self, words: list[str], counts: np.ndarray, prior: np.ndarray) -> np.ndarray:
        """Expected piece counts per language ((pieces + 1) x languages) of words with counts (words x languages)."""
        out = np.zeros((self.n + 1, counts.shape[1]))
        for numbers in self.batches(words, 2):
            lengths, edges = self.edges([words[i] for i in numbers])
            none, sure, plus, times, p = self.kind(lengths, prior)
            top, every = int(lengths.max()), np.arange(len(numbers))
            f, b = np.full((top + 1, len(numbers)), none), np.full((top + 1, len(numbers)), none)
            f[0], b[lengths, every] = sure, sure
            for end, start, w, pid in edges:
                f[end, w] = plus(f[end, w], times(f[start, w], p[pid]))
            for end, start, w, pid in sorted(edges, key=lambda e: (-e[1], -e[0])):
                b[start, w] = plus(b[start, w], times(p[pid], b[end, w]))
            for end, start, w, pid in edges:
                both = times(times(f[start, w], p[pid]), b[end, w])
                share = both / b[0, w] if sure else np.exp(both - b[0, w])
                for k in range(counts.shape[1]):
                    np.add.at(out[:, k], pid, share * counts[numbers[w], k])
        return out


def split(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").lower())


def word_counts(rows: DataFrame) -> DataFrame:
    """word, lang, n over all rows (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def out() -> pa.RecordBatch:
            found = [(w, lang, n) for lang, c in seen.items() for w, n in c.items()]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int64()))], names=["word", "lang", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    seen.setdefault(lang, Counter()).update(split(text))
                if sum(map(len, seen.values())) > STORE:
                    yield out()
        yield out()

    return rows.select("text", "lang").mapInArrow(count, "word string, lang string, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))


def train(rows: DataFrame, pieces: list[str], max_languages: int = 200, smoothing: float = 0.05) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities ((pieces + 1) x languages) from rows (text, lang), every row used."""
    ship(rows.sparkSession)
    langs = [r.lang for r in rows.filter("lang is not null").select("lang").distinct().limit(max_languages + 1).collect()]
    if len(langs) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    langs.sort()
    number = {x: i for i, x in enumerate(langs)}

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, prior = Lattice(pieces), 1 / (np.arange(len(pieces) + 1) + 100.0)
        prior[-1] = 1e-7
        total = np.zeros((len(pieces) + 1, len(langs)))
        for batch in batches:
            words = {w: i for i, w in enumerate(dict.fromkeys(batch.column(0).to_pylist()))}
            counts = np.zeros((len(words), len(langs)))
            np.add.at(counts, ([words[w] for w in batch.column(0).to_pylist()], [number[x] for x in batch.column(1).to_pylist()]), batch.column(2).to_numpy())
            if words:
                total += lattice.expected([START + w for w in words], counts, prior / prior.sum())
        at, k = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(k, pa.int32()), pa.array(total[at, k])], names=["piece", "lang", "n"])

    known = word_counts(rows.filter("lang is not null and text is not null"))
    got = known.mapInArrow(expect, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
    table = np.full((len(pieces) + 1, len(langs)), smoothing)
    for r in got.collect():
        table[r.piece, r.lang] += r.n
    return langs, table / table.sum(axis=0)


class Scores(dict):
    """word -> row of `table`, its score in each language. Emptied when full."""

    def __init__(self, pieces: list[str], probs: np.ndarray) -> None:
        self.lattice, self.probs = Lattice(pieces), probs
        self.most = min(STORE, max(1000, 40_000_000 // max(1, probs.shape[1])))
        self.table = np.zeros((self.most, probs.shape[1]))

    def learn(self, words: set[str]) -> None:
        """Scores of new words, `most` of them at most."""
        if len(self) + len(words) > self.most:
            self.clear()
        if words:
            first, every = len(self), list(words)
            self.table[first : first + len(every)] = self.lattice.score([START + w for w in every], self.probs)
            self.update(zip(every, range(first, first + len(every)), strict=True))

    def total(self, words: list[str]) -> np.ndarray:
        """Score of a text in each language."""
        out = np.zeros(self.probs.shape[1])
        for at in range(0, len(words), self.most // 2):
            part = words[at : at + self.most // 2]
            try:
                rows = np.fromiter(map(self.__getitem__, part), np.int64, len(part))
            except KeyError:
                new = set(part).difference(self)
                self.learn(new if len(self) + len(new) <= self.most else set(part))
                rows = np.fromiter(map(self.__getitem__, part), np.int64, len(part))
            out += self.table[rows].sum(axis=0)
        return out


#: The scores of the last model in this worker, which outlives a task.
LAST: dict[str, Scores] = {}


def predict(docs: DataFrame, pieces: list[str], model: tuple[list[str], np.ndarray], text: str = "text", added: tuple[str, str] = ("lang_pred", "score"), keep: list[str] | None = None) -> DataFrame:
    """The columns keep (all, if None) of docs with two more: the language and its posterior under equal priors."""
    import uuid

    spark = docs.sparkSession
    ship(spark)
    langs, probs = model
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    asked = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").alias("__text"))
    schema = docs.select(*[F.col(f"`{c}`") for c in names]).withColumn(added[0], F.lit("")).withColumn(added[1], F.lit(0.0)).schema
    key, shared = uuid.uuid4().hex, spark.sparkContext.broadcast((pieces, probs))  # the size of the vocabulary x languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in LAST:
            LAST.clear()
            LAST[key] = Scores(*shared.value)
        scores = LAST[key]

        def judge(texts: list[list[str]]) -> list[tuple[str, float]]:
            """Of texts as words; what is new in them is learnt together if it fits."""
            if langs and len(new := set().union(*texts).difference(scores)) <= scores.most // 4:
                scores.learn(new)
            return [judged(words) for words in texts]

        def judged(words: list[str]) -> tuple[str, float]:
            if not words or not langs:
                return "und", 0.0
            total = scores.total(words)
            best = int(total.argmax())
            return langs[best], float(1 / np.exp(total - total[best]).sum())

        for batch in batches:
            held, chars, first = [], 0, 0
            for at in range(0, batch.num_rows, 200):
                texts = batch.column(len(names)).slice(at, 200).to_pylist()
                held += [split(t) for t in texts]
                chars += sum(len(t or "") for t in texts)
                if chars > TOGETHER or at + 200 >= batch.num_rows:
                    got = judge(held)
                    yield pa.RecordBatch.from_arrays([*batch.slice(first, len(held)).columns[:-1], pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())], names=[*names, *added])
                    held, chars, first = [], 0, at + 200

    return asked.mapInArrow(run, schema)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds
