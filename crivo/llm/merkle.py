"""Merkle manifest of a dataset: digests of every document, one root for all, and a proof for each document.

Time-forward processing. Every node of the trees has a label (level, place); a child sends its digest to its parent
through a priority queue ordered by label, so a node is computed when all its children have spoken. A task does this for
one span of 8^4 neighbouring nodes; between spans the queue is Spark's shuffle, one round for every four levels, so a
round holds no more than a span in memory and the number of rounds grows with the logarithm of the documents. The
reversed sweep goes through the same rounds from the root and delivers to each span what the proofs of its nodes end
with.

* Leaf: H of the fields, each `-` if null, else its UTF-8 byte count, `:`, its value. H is the lowercase hex sha256 of
  the inputs joined, digests as hex text.
* One tree for each value of `tree`, leaves in ascending order of id (null first), rows that repeat an id by leaf. While
  a tree has several nodes, every eight consecutive ones become their H, the last run even when it is one alone. The
  trees' roots, in order of `tree` (null first), likewise give the root.
* A proof lists for each level the siblings to the left and to the right. Rows equal in all fields have equal leaves and
  stand side by side; each has its own proof. An empty table gives an empty manifest. Very long texts are hashed by
  Spark, row by row; texts don't move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crivo.llm.base import col, cut, ship
from crivo.operators.order import positions

ARITY = 8
LEVELS = 4  # of one span
SPAN = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

Path = list[tuple[str, str]]


def digest(*inputs: str) -> str:
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def encoded(field: Column) -> Column:
    value = field.cast("string")
    return F.when(field.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_of(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]), 256)


def height(nodes: int) -> int:
    """Levels above the leaves of a tree with so many leaves."""
    levels, room = 0, 1
    while room < nodes:
        levels, room = levels + 1, room * ARITY
    return levels


def runs_of(nodes: Sequence[str], levels: int) -> tuple[list[list[list[str]]], str]:
    """(children of every node by level, digest at the top) of a span. Messages wait in a queue ordered by the label of
    the node that they are for; the node with the smallest label is next."""
    queue = [(1, place // ARITY, place, node) for place, node in enumerate(nodes)]
    heapify(queue)
    children: list[list[list[str]]] = [[] for _ in range(levels)]
    while queue[0][0] <= levels:
        level, node = queue[0][:2]
        inbox = []
        while queue and queue[0][:2] == (level, node):
            inbox.append(heappop(queue)[3])
        children[level - 1].append(inbox)
        heappush(queue, (level + 1, node // ARITY, node, digest(*inbox)))
    return children, queue[0][3]


def paths_of(nodes: Sequence[str], levels: int, end: Path) -> list[Path]:
    """The siblings (left, right) of every node of a span, level by level: the reversed sweep, from the top, whose own
    path is `end`."""
    children, _ = runs_of(nodes, levels)
    above: list[Path] = [end]
    for runs in reversed(children):
        above = [
            [("".join(run[:i]), "".join(run[i + 1 :])), *above[node]] for node, run in enumerate(runs) for i in range(len(run))
        ]
    return above


def write_path(path: Path) -> str:
    return "|".join(f"{left}.{right}" for left, right in path)


def read_path(text: str) -> Path:
    return [tuple(level.split(".")) for level in text.split("|")] if text else []


def fold(leaf: str, path: Path) -> str:
    """The root that a leaf and its path lead to."""
    for left, right in path:
        leaf = digest(left, leaf, right)
    return leaf


def _up(span: pd.DataFrame) -> pd.DataFrame:
    span = span.sort_values("place")
    top = runs_of(span["node"].tolist(), min(LEVELS, height(int(span["size"].iloc[0]))))[1]
    return pd.DataFrame({"tree": [span["tree"].iloc[0]], "place": [span["span"].iloc[0]], "node": [top]})


def _spans(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("span", F.expr(f"place div {SPAN}"))


def rise(nodes: DataFrame) -> list[DataFrame]:
    """The rounds from the leaves (tree, place, node, size), `size` being the nodes of the tree, to a table of roots."""
    rounds = [nodes]
    most = nodes.agg(F.max("size")).first()[0] or 0
    while most > 1:
        below = _spans(rounds[-1].select("tree", "place", "node", "size"))  # neighbours meet in the task of their span
        tops = below.groupBy("tree", "span").applyInPandas(_up, "tree bigint, place bigint, node string")
        sizes = below.groupBy("tree").agg(F.first("size").alias("size")).select("tree", F.ceil(F.col("size") / SPAN).alias("size"))
        rounds.append(cut(tops.join(sizes, "tree").select("tree", "place", "node", "size")))
        most = -(-most // SPAN)
    return rounds


def _paths(span: pd.DataFrame, end: pd.DataFrame) -> list[Path]:
    return paths_of(span["node"].tolist(), min(LEVELS, height(int(span["size"].iloc[0]))), read_path(end["path"].iloc[0]))


def _down(key: tuple, span: pd.DataFrame, end: pd.DataFrame) -> pd.DataFrame:
    span = span.sort_values("place")
    return span[["tree", "place"]].assign(path=[write_path(p) for p in _paths(span, end)])


def _folded(key: tuple, span: pd.DataFrame, end: pd.DataFrame) -> pd.DataFrame:
    span = span.sort_values("place")
    paths = _paths(span, end)
    return span[["tree", "place"]].assign(
        proof_sha256=[digest(*[side for level in path for side in level]) for path in paths],
        folded_root=[fold(seen, path) for seen, path in zip(span["seen"], paths)],
    )


PATHS = "tree bigint, place bigint, path string"
FOLDED = "tree bigint, place bigint, proof_sha256 string, folded_root string"


def fall(rounds: Sequence[DataFrame], ends: DataFrame, last=_down, schema: str = PATHS) -> DataFrame:
    """(tree, place, path) of the nodes of the lowest round, from the paths `ends` (tree, path) of the trees' roots. `last`
    may return something else than paths for the lowest round."""
    paths = ends.select("tree", F.lit(0).cast("bigint").alias("place"), "path")
    for i in range(len(rounds) - 1, -1, -1):
        spans = _spans(rounds[i]).groupBy("tree", "span")
        tops = paths.withColumnRenamed("place", "span").groupBy("tree", "span")
        told = spans.cogroup(tops)
        paths = cut(told.applyInPandas(_down, PATHS)) if i else told.applyInPandas(last, schema)
    return paths


def _trees(docs: DataFrame, id: str, tree: str, fields: Sequence[str], now: dict[str, Column]) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """(leaves with tree and place, rounds of the trees, rounds of the tree of roots)."""
    ship(docs.sparkSession)
    leaves = cut(
        docs.select(
            col(id).alias("id"), col(tree).alias("value"), leaf_of([col(f) for f in fields]).alias("node"),
            leaf_of([now.get(f, col(f)) for f in fields]).alias("seen"),
        )
    )
    numbered = positions(leaves, ["id", "node"], ["value"], "place", size="size")
    trees = cut(positions(leaves.select("value").distinct(), ["value"], name="tree", size="trees"))
    named = trees.withColumnRenamed("value", "_value")
    nodes = cut(numbered.join(named, F.col("value").eqNullSafe(F.col("_value"))).select("id", "tree", "place", "size", "node", "seen"))
    rounds = rise(nodes)
    roots = rounds[-1].join(trees, "tree").select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("place"), F.col("trees").alias("size"), "node"
    )
    return nodes, rounds, rise(cut(roots))


def proofs(docs: DataFrame, id: str = "doc_id", tree: str = "lang", fields: Sequence[str] = FIELDS) -> DataFrame:
    """One row per document: id, leaf, path: for each level the digests of the siblings to the left and to the right as
    `left.right`, levels joined by `|`. `fold(leaf, read_path(path))` is the root of the manifest."""
    nodes, rounds, top = _trees(docs, id, tree, fields, {})
    ends = fall(top, top[-1].select("tree", F.lit("").alias("path"))).select(F.col("place").alias("tree"), "path")
    leaves = nodes.select(F.col("id").alias(id), "tree", "place", F.col("node").alias("leaf"))
    return leaves.join(fall(rounds, ends), ["tree", "place"]).drop("tree", "place")


def manifest(
    docs: DataFrame, now: dict[str, Column] | None = None, id: str = "doc_id", tree: str = "lang", fields: Sequence[str] = FIELDS
) -> DataFrame:
    """One row per document: id, leaf, subroot (of its tree), root, proof_sha256 (H of all siblings of its proof), folded_root
    (from what the document holds `now`, column expressions by field, and its siblings) and whether that is the root."""
    nodes, rounds, top = _trees(docs, id, tree, fields, now or {})
    ends = fall(top, top[-1].select("tree", F.lit("").alias("path"))).select(F.col("place").alias("tree"), "path")
    # The lowest round carries what each leaf is now.
    told = fall([nodes.select("tree", "place", "node", "size", "seen"), *rounds[1:]], ends, _folded, FOLDED)
    subroots = rounds[-1].select("tree", F.col("node").alias("subroot"))
    root = top[-1].agg(F.max("node")).first()[0]
    return (
        nodes.select(F.col("id").alias(id), F.col("node").alias("leaf"), "tree", "place")
        .join(subroots, "tree")
        .join(told, ["tree", "place"])
        .select(
            id, "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256", "folded_root",
            (F.col("folded_root") == F.lit(root)).alias("verified"),
        )
    )
