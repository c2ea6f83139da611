"""From buckets of likely partners to groups: verification without all pairs, and union-find.

Members of a bucket are compared with one hub first, the member whose buckets are the fullest: around it a group of near
copies is densest. Every member keeps its best hub, the one it shares most buckets with. Verified links merge components,
and the next round, with other hubs, looks only at buckets and members that are still apart. What the rounds leave over
goes to an exact last step that must name every pair of different components that may be a link; so no link is lost
that could join two components, and large groups of near copies cost a few comparisons per member.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crivo.llm.base import cut, ship

ROUNDS = 3
#: Buckets that two texts must share to be compared in a round.
LEAST = 2

Verify = Callable[[DataFrame], DataFrame]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one partition: every node that is not its group's smallest, with the smallest."""
    parent: dict = {}
    names: list[str] = []
    kind = None

    def root(node):
        top = node
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(node, node) != top:
            parent[node], node = top, parent[node]
        return top

    for batch in batches:
        names, kind = batch.schema.names, batch.schema.field(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
            parent.setdefault(low, low)
    nodes = [n for n in parent if root(n) != n]
    for i in range(0, len(nodes), 50_000):
        part = nodes[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, kind), pa.array([root(n) for n in part], kind)], names)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of `edges` (columns a, b) that is not the smallest of its component.

    Each task first reduces its own edges to a forest. Then stars are alternated (every node hands its larger
    neighbours, then all its smaller ones, to the smallest), which ends in one star per component.
    """
    ship(edges.sparkSession)
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, before = cut(pairs.mapInArrow(_forest, pairs.schema).distinct()), None
    while True:
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(low.select("a", F.col("m").alias("b")).union(small).distinct())


def _placed(keyed: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Adds each node's component and whether it stands alone; keeps buckets that hold more than one component."""
    if roots is None:
        named = keyed.withColumns({"root": F.col("node"), "alone": F.lit(True)})
    else:
        found = cut(roots.select("node", "root").union(roots.select("root", "root")).distinct()).withColumnRenamed("root", "_root")
        named = keyed.join(found, "node", "left").withColumns(
            {"root": F.coalesce("_root", "node"), "alone": F.col("_root").isNull()}
        ).drop("_root")
    several = named.groupBy("key").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low <> _high")
    return cut(named.join(several.select("key"), "key"))


def _hub_pairs(placed: DataFrame, first: bool, near: Column) -> DataFrame:
    """(a, b): each node with the hub of another component that it shares most buckets with. After the first round hubs
    are nodes that no link has reached yet, where a bucket has any."""
    rank = F.struct(F.lit(first) | F.col("alone"), F.col("fullness"), F.xxhash64("node"))
    hubs = placed.groupBy("key").agg(F.max(F.struct(rank.alias("rank"), "node", "size", "root")).alias("hub"))
    tried = placed.join(hubs, "key").where((F.col("root") != F.col("hub.root")) & near)
    shared = tried.groupBy("node", F.col("hub.node").alias("hub")).agg(F.count(F.lit(1)).alias("times")).where(F.col("times") >= LEAST)
    best = shared.groupBy("node").agg(F.max(F.struct("times", "hub")).alias("best"))
    return best.select(F.greatest("node", "best.hub").alias("a"), F.least("node", "best.hub").alias("b")).distinct()


def apart(left: Column, right: Column, sizes: tuple[Column, Column], ratio: tuple[int, int] | None) -> Column:
    """True for two members of different components whose sizes don't rule a link out, in one order."""
    found = left > right
    if ratio:
        (a, b), (num, den) = sizes, ratio
        found = found & (a * den >= b * num) & (b * den >= a * num)
    return found


def bucket_pairs(placed: DataFrame) -> DataFrame:
    """(a, b): all pairs of different components that share enough buckets. The plain exact last step."""
    left = placed.select("key", F.col("node").alias("a"), F.col("root").alias("ra"))
    right = placed.select("key", F.col("node").alias("b"), F.col("root").alias("rb"))
    met = left.join(right, (left["key"] == right["key"]) & (F.col("ra") > F.col("rb")))
    return met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") >= LEAST).select("a", "b")


def linked(
    keyed: DataFrame,
    verify: Verify,
    rest: Callable[[DataFrame], DataFrame] = bucket_pairs,
    ratio: tuple[int, int] | None = None,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(node, root) of all nodes that are not the smallest of their group.

    `keyed` has a row (key, node, size, fullness) for each bucket of each node, `fullness` being the members of all its
    buckets; `verify` returns those of the pairs (a, b) that are links; `rest` names the pairs of the last step, from
    (key, node, size, root). Sizes further apart than `ratio` (numerator, denominator) can't be links.
    """
    near = F.lit(True)
    if ratio:
        num, den = ratio
        near = (F.col("size") * den >= F.col("hub.size") * num) & (F.col("hub.size") * den >= F.col("size") * num)
    roots = links = None
    placed = _placed(keyed, None)
    for turn in range(rounds + 1):
        if turn:
            placed = _placed(placed.drop("root", "alone"), roots)
        if placed.isEmpty():
            break
        pairs = rest(placed) if turn == rounds else _hub_pairs(placed, not turn, near)
        found = cut(verify(cut(pairs)).select("a", "b"))
        links = found if links is None else links.union(found)
        roots = cut(components(links))
    return roots if roots is not None else keyed.select("node", F.col("node").alias("root")).limit(0)


def crowded(keyed: DataFrame) -> DataFrame:
    """(key, node, size, fullness) of the rows (key, node, size) whose bucket has several members."""
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = cut(keyed.join(counts, "key"))
    full = shared.groupBy("node").agg(F.sum("members").alias("fullness"))
    return cut(shared.drop("members").join(full, "node"))
