"""Chat formatting: reply trees become one conversation each, natively.

Messages (conv, node, parent, role, text, score) form trees. Iterative self-joins enumerate the
root-to-leaf paths; branches are ranked by score and each chosen path is formatted as one
conversation. Chains without a branching are contracted first, so the number of joins follows the
branchings on a path and not its length, and it is the ids that are joined, not the texts.

Template, per turn: `<turn:ROLE>TEXT</turn>` and a line feed. Inside roles and texts `\\`, `<` and `>`
become `\\b`, `\\l` and `\\g`, so no control string can occur there; read_back() undoes it.

Defined results: null text and role are empty; null turns come first; rows that repeat are turns of
their own; rows of one turn number are ordered by role, then text; a null conv_id is one conversation;
a node whose parent is not in its conversation is a root; nodes that answer each other in a circle
hang from no root and are on no path; texts of any length are taken whole; an empty table gives an
empty result; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pagewright.llm.common import materialise

OPEN, CLOSE = "<turn:", "</turn>\n"


def escape(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for raw, safe in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def unescape(text: Column) -> Column:
    for raw, safe in (("<", "\\l"), (">", "\\g"), ("\\", "\\b")):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def as_tree(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows by turn as a tree in which each row answers the one before: conv, node, parent, role, text, score.

    A conversation becomes one output row anyway, so ordering its rows in one task adds no bound.
    """
    w = W.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    flat = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    got = flat.withColumn("node", F.row_number().over(w).cast("long"))
    return got.select("conv", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def runs_of(tree: DataFrame) -> DataFrame:
    """tree with `head`: the first node of its run. A run goes on while a node is its parent's only child and follows it directly."""
    kids = tree.withColumn("__kids", F.count(F.lit(1)).over(W.partitionBy("conv", "parent")))
    by_node = W.partitionBy("conv").orderBy("node")
    goes_on = F.coalesce((F.col("__kids") == 1) & (F.lag("node").over(by_node) == F.col("parent")), F.lit(False))
    head = F.last(F.when(~F.col("__on"), F.col("node")), ignorenulls=True).over(by_node)
    return kids.withColumn("__on", goes_on).withColumn("head", head).drop("__kids", "__on")


def paths(tree: DataFrame, top: int = 1) -> DataFrame:
    """The `top` best root-to-leaf paths of each conversation: conv, rank, at (place on the path), head (run id).

    A path scores the sum of its nodes; ties go to the smaller leaf id. Each round joins the open
    paths to their child runs; the rounds end when no run has children.
    """
    runs = tree.groupBy("conv", "head").agg(F.max("node").alias("tail"), F.sum("score").alias("score"), F.min_by("parent", "node").alias("parent"))
    runs = materialise(runs, "runs")
    ends = runs.select(F.col("conv").alias("c"), F.col("tail").alias("end"))
    below = runs.filter("parent is not null").join(ends, F.col("conv").eqNullSafe(F.col("c")) & (F.col("parent") == F.col("end")), "left").drop("c")
    top_runs = runs.filter("parent is null").unionByName(below.filter("end is null").drop("end"))
    inner = below.filter("end is not null").select(F.col("conv").alias("c"), F.col("head").alias("kid"), F.col("tail").alias("kid_tail"), F.col("score").alias("kid_score"), F.col("end").alias("parent"))
    open_ = top_runs.select("conv", F.array("head").alias("heads"), "tail", "score")
    done = []
    if inner.isEmpty():
        done, open_ = [open_], None
    while open_ is not None:
        joined = materialise(open_.join(inner, open_["conv"].eqNullSafe(inner["c"]) & (open_["tail"] == inner["parent"]), "left"), "paths")
        done.append(joined.filter("kid is null").select("conv", "heads", "tail", "score"))
        grown = joined.filter("kid is not null").select("conv", F.concat("heads", F.array("kid")).alias("heads"), F.col("kid_tail").alias("tail"), (F.col("score") + F.col("kid_score")).alias("score"))
        open_ = None if grown.isEmpty() else grown
    rank = F.row_number().over(W.partitionBy("conv").orderBy(F.col("score").desc(), "tail"))
    best = reduce(DataFrame.unionByName, done).withColumn("rank", rank).filter(F.col("rank") <= top)
    return best.select("conv", "rank", F.posexplode("heads").alias("at", "head"))


def format_paths(tree: DataFrame, top: int = 1) -> DataFrame:
    """One row per chosen path: conv, rank, formatted."""
    tree = runs_of(tree.select("conv", "node", "parent", "role", "text", "score"))
    chosen = paths(tree, top).withColumnRenamed("conv", "c").withColumnRenamed("head", "h")
    on = tree["conv"].eqNullSafe(chosen["c"]) & (tree["head"] == chosen["h"])
    turns = tree.join(chosen, on).select("conv", "rank", F.struct("at", "node", "role", "text").alias("t"))
    got = turns.groupBy("conv", "rank").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    say = lambda x: F.concat(F.lit(OPEN), escape(x.role), F.lit(">"), escape(x.text), F.lit(CLOSE))
    return got.select("conv", "rank", F.array_join(F.transform("ts", say), "").alias("formatted"))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> that `formatted` says, unescaped."""
    pieces = F.slice(F.split(formatted, CLOSE, -1), 1, F.size(F.split(formatted, CLOSE, -1)) - 1)

    def turn(p: Column) -> Column:
        role = F.substring_index(p, ">", 1)
        return F.struct(unescape(F.substr(role, F.lit(len(OPEN) + 1))).alias("role"), unescape(F.substr(p, F.length(role) + 2)).alias("text"))

    return F.transform(pieces, turn)


def loss_mask(formatted: Column, role: str = "assistant") -> Column:
    """array<struct<start, end>> of the code points of `formatted` that carry loss: the escaped texts of `role`."""
    pieces = F.slice(F.split(formatted, CLOSE, -1), 1, F.size(F.split(formatted, CLOSE, -1)) - 1)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    lead = OPEN + role + ">"

    def step(acc: Column, p: Column) -> Column:
        end = acc["at"] + F.length(p)
        span = F.struct((acc["at"] + len(lead)).alias("start"), end.alias("end"))
        return F.struct((end + len(CLOSE)).alias("at"), F.when(F.startswith(p, F.lit(lead)), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(pieces, zero, step, lambda acc: acc["spans"])


def digest(formatted: DataFrame) -> DataFrame:
    """Read back from the formatted text: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, beside conv."""
    got = formatted.withColumn("__turns", read_back(F.col("formatted"))).withColumn("__mask", loss_mask(F.col("formatted")))
    said = F.array_join(F.transform("__turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    masked = F.array_join(F.transform("__mask", lambda s: F.substr("formatted", s.start + 1, s.end - s.start)), "")
    got = got.withColumn("__loss", unescape(masked))
    return got.select(
        "conv",
        F.size("__turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length("__loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("__loss", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
