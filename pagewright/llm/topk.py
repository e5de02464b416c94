"""Exact top-k by inner product over a vector-approximation file.

Every vector is turned into integers floor(scale * x). Blocks of vectors keep a quantised cell number
of 4 bits per component, two in a byte, beside the exact integers in the fewest bytes that hold them.
A task takes one block of queries and one block of vectors, scans the cells for an upper and a lower
bound of every score, and reads exact vectors in the order of the upper bound until no unread one can
reach the k-th result. The blocks' results are merged per query.

Blocks have a bounded number of rows and components, so a task's memory is bounded. Every block goes
to every group of queries: for components of two bytes that is 2.5 bytes a component and group,
some 160 bytes for each query and block at 64 components, about what the rows of its k results and
a join by id to their vectors would take, and far less time than the scan of the block.

Defined results: vectors that are null or empty or hold null or non-finite components take no part;
vectors meet vectors of their own length only; rows are told apart by themselves, so a row repeated
with its id and vector is a candidate twice, and each of several query rows with one id is a query of
its own, which has the others as candidates; ties go to the smaller id; null ids take no part; an
empty table gives an empty result; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pagewright.functions.ship import ship
from pagewright.llm.common import materialise

BLOCK = "block long, dim int, rows binary, ids binary, lo binary, width binary, cells binary, exact binary"
FOUND = "query_id long, query long, vec_id long, score long"


def integers(vector: Column, scale: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


LEVELS = 16  # cells a component; two cell numbers share a byte


def make_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row: the ids, the cells and the exact integers of a block."""
    exact = np.stack(pdf["v"].to_numpy()).astype(np.int64)
    lo, hi = exact.min(axis=0), exact.max(axis=0)
    width = np.maximum(1, -(-(hi - lo + 1) // LEVELS))
    cells = ((exact - lo) // width).astype(np.uint8)
    if cells.shape[1] % 2:
        cells = np.pad(cells, ((0, 0), (0, 1)))
    packed, kind = cells[:, ::2] << 4 | cells[:, 1::2], np.result_type(np.min_scalar_type(lo.min()), np.min_scalar_type(hi.max()), np.int8)
    row = (pdf["block"].iloc[0], exact.shape[1], *(pdf[c].to_numpy(np.int64).tobytes() for c in ("row", "vec_id")), lo.tobytes(), width.tobytes(), packed.tobytes(), exact.astype(kind).tobytes())
    return pd.DataFrame([row], columns=[c.split()[0] for c in BLOCK.split(", ")])


def exact_of(block: pd.Series) -> np.ndarray:
    d, n = int(block.dim), len(block["ids"]) // 8
    return np.frombuffer(block["exact"], np.dtype(f"i{len(block['exact']) // (n * d)}")).reshape(n, d)


def scan(block: pd.Series, queries: pd.Series, k: int) -> list[tuple[int, int, int, int]]:
    """The k best of one block for each query: bounds from the cells, then exact vectors in bound order."""
    d = int(block.dim)
    of = lambda row, name, kind=np.int64: np.frombuffer(row[name], kind)
    rows, ids, lo, width = of(block, "rows"), of(block, "ids"), of(block, "lo").astype(float), of(block, "width").astype(float)
    packed, exact = of(block, "cells", np.uint8).reshape(len(ids), -1), exact_of(block)
    cells = np.stack([packed >> 4, packed & 15], axis=2).reshape(len(ids), -1)[:, :d].astype(float)
    q_rows, q_ids, q_exact = of(queries, "rows"), of(queries, "ids"), exact_of(queries).astype(np.int64)
    out = []
    for first in range(0, len(q_ids), 64):
        q = q_exact[first : first + 64].astype(float)
        slack = 1 + 1e-9 * np.abs(q) @ (np.abs(lo) + LEVELS * width)
        upper = (q * width) @ cells.T + (q @ lo + np.maximum(q, 0) @ (width - 1) + slack)[:, None]
        spread = np.abs(q) @ (width - 1) + 2 * slack
        for j in range(len(q)):
            own, ub = rows == q_rows[first + j], upper[j]
            if len(ids) > 4 * k:  # the k-th lower bound, with room for the query's own row
                ub_kth = np.partition(ub, len(ub) - k - 1)[len(ub) - k - 1]
                at = np.flatnonzero((ub >= ub_kth - spread[j]) & ~own)
            else:
                at = np.flatnonzero(~own)
            at = at[np.argsort(-ub[at], kind="stable")]
            best_s, best_i, pos, step = np.empty(0, np.int64), np.empty(0, np.int64), 0, 4 * k
            while pos < len(at) and (len(best_s) < k or ub[at[pos]] >= best_s[-1]):
                part = at[pos : pos + step]
                s = np.concatenate([best_s, exact[part].astype(np.int64) @ q_exact[first + j]])
                i = np.concatenate([best_i, ids[part]])
                order = np.lexsort((i, -s))[:k]
                best_s, best_i, pos, step = s[order], i[order], pos + step, step * 2
            out += [(int(q_ids[first + j]), int(q_rows[first + j]), int(i), int(s)) for s, i in zip(best_s, best_i, strict=True)]
    return out


def search(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256, block_rows: int = 8192, block_components: int = 2_000_000) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best rows for each row for which is_query (over column vec_id) holds."""
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v")).filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = materialise(rows.select("vec_id", integers(F.col("v"), scale).alias("v"), F.monotonically_increasing_id().alias("row")), "vectors")
    asked = rows.filter(is_query)

    def parts(df: DataFrame) -> int:
        n, components = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("v")), F.lit(0))).first()
        return max(1, -(-n // block_rows), -(-components // block_components))

    blocks, groups = parts(rows), parts(asked)

    def pack(df: DataFrame, parts: int) -> DataFrame:
        dealt = df.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(parts).cast("long"))).withColumn("dim", F.size("v"))
        return dealt.groupBy("block", "dim").applyInPandas(make_block, BLOCK)

    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))  # noqa: E731  keys of one type on both sides
    data = pack(rows, blocks).withColumn("q", numbers(groups))
    ask = pack(asked, groups).withColumnRenamed("block", "q").withColumn("block", numbers(blocks))

    def pair(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [r for _, a in left.iterrows() for _, b in right.iterrows() for r in scan(a, b, k)]
        return pd.DataFrame(found, columns=["query_id", "query", "vec_id", "score"])

    found = data.groupBy("block", "q", "dim").cogroup(ask.groupBy("block", "q", "dim")).applyInPandas(pair, FOUND)
    rank = F.row_number().over(W.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
