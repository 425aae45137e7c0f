"""Reply trees as conversations.

A tree is a set of nodes with a parent each. Self-joins double the reach of every node's ancestor pointer, so a path of n
nodes takes log2(n) rounds; on the way the scores along the path are summed. Leaves are ranked in their tree by the score
of their path (highest first, then the longer path, then the smaller node). The paths of the chosen leaves are then
enumerated with the pointers of all rounds, and each is formatted as one conversation.

A turn is written ``### role: text </turn>`` and a line feed. Inside roles and texts ``\\`` becomes ``\\\\``, ``###``
becomes ``\\h`` and ``</turn>`` becomes ``\\t`` (in roles also ``:`` becomes ``\\c``), so marks never occur inside a text
and reading back gives the very texts. ``loss`` lists the places of the assistant's texts, in code points.

Defined results: NULL roles and texts are empty; a node whose parent is NULL or missing is a root; nodes on or below a
cycle have no root and belong to no path; repeated nodes of one name are for the caller to tell apart (``turns_as_nodes``
chains equal turns in the order of role and text); NULL tree ids form a tree; a tree of any depth is read whole. Other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from demandgrid.llm.common import held, table

OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
# What is escaped, in this order.
ESCAPES = (("\\", "\\\\"), ("###", "\\h"), ("</turn>", "\\t"))
ROLE_ESCAPE = (":", "\\c")
UNESCAPE = {"\\\\": "\\", "\\h": "###", "\\t": "</turn>", "\\c": ":"}
ESCAPED = re.compile(r"\\[\\htc]")
LEARNED = "assistant"


def escaped(value: Column, *more: tuple[str, str]) -> Column:
    for plain, mark in (*ESCAPES, *more):
        value = F.replace(value, F.lit(plain), F.lit(mark))
    return value


def unescaped(value: str) -> str:
    return ESCAPED.sub(lambda m: UNESCAPE[m[0]], value)


def paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """Rows (tree, branch, position, node) of the best ``branches`` paths of every tree of (tree, node, parent, score).

    ``tree`` and ``node`` are not NULL and name a node uniquely.
    """
    nodes = held(nodes.select("tree", "node", "parent", "score"), "nodes")
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    pointer = F.when(F.col("known"), F.col("parent"))
    state = held(nodes.join(known, ["tree", "parent"], "left").select(
        "tree", "node", pointer.alias("up"), F.col("score").cast("double").alias("total"), F.lit(1).cast("long").alias("depth")), "reach")
    rounds, rows = [], nodes.count()
    while 1 << len(rounds) <= rows and not state.filter("up IS NOT NULL").isEmpty():
        rounds.append(state.filter("up IS NOT NULL").select("tree", "node", "up"))
        above = state.select("tree", F.col("node").alias("up"), F.col("up").alias("beyond"), F.col("total").alias("more"), F.col("depth").alias("deeper"))
        state = held(state.join(above, ["tree", "up"], "left").select(
            "tree", "node", F.col("beyond").alias("up"), (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"),
            (F.col("depth") + F.coalesce("deeper", F.lit(0))).alias("depth")), "reach")
    rooted = state.filter("up IS NULL")
    parents = nodes.select("tree", F.col("parent").alias("node")).distinct()
    best = W.partitionBy("tree").orderBy(F.desc("total"), F.desc("depth"), "node")
    chosen = (rooted.join(parents, ["tree", "node"], "left_anti").withColumn("branch", F.row_number().over(best))
              .filter(F.col("branch") <= branches).select("tree", "branch", "node", (F.col("depth") - 1).alias("position")))
    path = chosen
    for k in reversed(range(len(rounds))):
        step = path.join(rounds[k], ["tree", "node"]).select("tree", "branch", F.col("up").alias("node"), (F.col("position") - (1 << k)).alias("position"))
        path = held(path.unionByName(step), "paths")
    return path


def formatted(path: DataFrame, turns: DataFrame) -> DataFrame:
    """One conversation per (tree, branch): ``text``, ``loss`` (start, end) and ``n_turns``; turns is (tree, node, role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(OPEN), escaped(role, ROLE_ESCAPE), F.lit(MIDDLE))
    before = W.partitionBy("tree", "branch").orderBy("position").rowsBetween(W.unboundedPreceding, -1)
    pieces = (path.join(turns, ["tree", "node"])
              .select("tree", "branch", "position", head.alias("head"), escaped(text).alias("body"), (role == LEARNED).alias("learned"))
              .withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
              .withColumn("from", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.length("head"))
              .select("tree", "branch", "position", "piece", F.when(F.col("learned"), F.struct(
                  F.col("from").alias("start"), (F.col("from") + F.length("body")).alias("end"))).alias("loss")))
    gathered = pieces.groupBy("tree", "branch").agg(F.sort_array(F.collect_list(F.struct("position", "piece", "loss"))).alias("all"))
    return gathered.select("tree", "branch", F.array_join("all.piece", "").alias("text"),
                           F.filter("all.loss", lambda x: x.isNotNull()).alias("loss"), F.size("all").cast("long").alias("n_turns"))


@F.pandas_udf(T.StructType().add("n_turns", "long").add("turns_sha256", "string").add("loss_chars", "long")
              .add("loss_sha256", "string").add("formatted_chars", "long"))
def read_back(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """What a reader of the formatted text and its mask finds."""
    for texts, masks in batches:
        rows = []
        for text, mask in zip(texts, masks):
            turns = []
            for turn in text.split(CLOSE)[:-1]:
                role, _, body = turn[len(OPEN):].partition(MIDDLE)
                turns.append(f"{unescaped(role)}\n{unescaped(body)}\n")
            learned = "".join(unescaped(text[m["start"]:m["end"]]) for m in mask)
            rows.append((len(turns), sha256("".join(turns).encode()).hexdigest(), len(learned), sha256(learned.encode()).hexdigest(), len(text)))
        yield pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def turns_as_nodes(conversations: DataFrame) -> DataFrame:
    """Linear conversations as trees without branches: each turn replies to the one before."""
    tree = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = W.partitionBy("tree").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    return (conversations.select(tree.alias("tree"), "conv_id", "turn", role.alias("role"), text.alias("text"))
            .withColumn("node", F.row_number().over(order)).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
            .withColumn("score", F.lit(0.0)))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    nodes = held(turns_as_nodes(rows), "turns")
    made = formatted(paths(nodes), nodes.select("tree", "node", "role", "text"))
    conv_id = F.when(F.col("tree") != "", F.substring("tree", 2, 40).cast("long"))
    return made.select(conv_id.alias("conv_id"), read_back("text", "loss").alias("_read")).select("conv_id", "_read.*")


OP4_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), ':', '\c') AS mark,
         replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t') AS body FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(length('### ' || mark || ': ' || body || ' </turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""
