"""Near-duplicate groups: SuperMinHash signatures, banding, verification on full sets, union-find.

A text's set holds its distinct shingles of `WIDTH` words (A-Z lowered). SuperMinHash gives each shingle a random
permutation of the signature's places and, at its j-th place, a value between j and j + 1; each place keeps the
smallest. Values of one shingle are thus spread evenly over the places, which lowers the variance, and once every place
is below j + 1 no later value can matter: long sets stop after one or two steps of 128 (`signatures` works on many
texts a step).

128 places make 32 bands of 4. Two sets that are 80 % alike share a band with probability 0.41; sharing fewer
than two of 32 has a probability of one in a million, so that is what a comparison asks for. Every link is confirmed on the
full sets. Texts with equal sets are one class from the start, however many they are; see `groups` for how large
groups do without all pairs.

Texts that share a band but no link (a passage that thousands quote) would leave all their pairs to the last step. It
is exact and yet spares them: two sets of that similarity must share a shingle among the rarest fifth of each (prefix
filter), and from the first one they share on enough must follow in both (positional filter). Texts with a tenth of
their own, which nobody else has, fail that.

Null and empty texts have the empty set and link with nothing; a text of fewer words than a shingle is one shingle of
all its words. A row with a null id links with nothing and has no component. What links are sets: where rows repeat an id with
different texts, each goes with the group of its own text, so one of them can be a near copy of a smaller id and the other stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crivo.llm.base import col, cut, held, ship
from crivo.llm.exact import filter_words, member_filter, possibly_repeated
from crivo.llm.groups import apart, crowded, linked

WIDTH = 4
PLACES, ROWS = 128, 4
#: Similarity as a fraction: intersection / union >= 80 / 100.
LIKE = (80, 100)
#: Shingles of texts that are worked on together, and words that a worker remembers.
TOGETHER, REMEMBERED = 1 << 16, 1 << 17

_GOLDEN, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words without visible pattern (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a whole text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    if n < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=n)], np.uint64)
    each = np.fromiter(map(held("near", _Words).__getitem__, words), np.uint64, n)
    out = scramble(each[: n - width + 1])
    for i in range(1, width):
        out = scramble(out + _GOLDEN + each[i : n - width + 1 + i])
    return np.unique(out)


def signatures(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """One SuperMinHash signature (a row of `places` values) for each set; empty sets keep infinity throughout."""
    count = len(sets)
    values = np.full(count * places, np.inf)
    if not count:
        return values.reshape(0, places)
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(count), [len(s) for s in sets])
    order: np.ndarray | None = None
    for j in range(places):
        drawn = scramble(element + np.uint64(int(_GOLDEN) * (j + 1) % (1 << 64)))
        value = j + (drawn >> np.uint64(24)).astype(np.float64) / float(1 << 40)
        pick = j + ((drawn & np.uint64(0xFFFFFF)) * np.uint64(places - j) >> np.uint64(24)).astype(np.intp)
        if order is None:
            place = pick
        else:
            rows = np.arange(len(element))
            place = order[rows, pick]
            order[rows, pick] = order[rows, j]
            order[rows, j] = place
        np.minimum.at(values, owner * places + place, value)
        open_sets = values.reshape(count, places).max(axis=1) > j + 1
        going = open_sets[owner]
        if not going.any():
            break
        if order is None:
            element, owner, pick = element[going], owner[going], pick[going]
            order = np.tile(np.arange(places, dtype=np.uint8), (len(element), 1))
            rows = np.arange(len(element))
            order[rows, pick], order[rows, 0] = 0, pick
        elif not going.all():
            element, owner, order = element[going], owner[going], order[going]
    return values.reshape(count, places)


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band of each signature; the band's number is part of the key."""
    count, places = signature.shape
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(count, places // rows, rows)
    key = np.broadcast_to(np.arange(1, places // rows + 1, dtype=np.uint64) * _GOLDEN, bits.shape[:2])
    for i in range(rows):
        key = scramble(key + bits[:, :, i])
    return key.view(np.int64)


def _in_batches(sets: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for s in sets:
        held.append(s)
        size += len(s) + 16
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def sketches(docs: DataFrame, id: str, text: str, width: int = WIDTH) -> DataFrame:
    """(id, mark, n, class, keys): a hash of the text, which tells rows of one id apart, set size, a 128-bit name of the set
    (null if empty), and its band keys."""
    ship(docs.sparkSession)
    narrow = docs.select(col(id).alias("id"), col(text).alias("text"), F.xxhash64(col(text)).alias("mark"))
    shape = T.StructType(
        [
            T.StructField("id", narrow.schema["id"].dataType),
            T.StructField("mark", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("class", T.StringType()),
            T.StructField("keys", T.ArrayType(T.LongType())),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for sets in _in_batches(shingles(t.as_py(), width) for t in batch.column(1)):
                keys = bands(signatures(sets))
                full = [bool(len(s)) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(sets)),
                        batch.column(2).slice(at, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) if f else None for s, f in zip(sets, full)], pa.string()),
                        pa.array([k if f else None for k, f in zip(keys, full)], pa.list_(pa.int64())),
                    ],
                    shape.names,
                )
                at += len(sets)

    return narrow.mapInArrow(read, shape)


def wanted_texts(docs: DataFrame, wanted: DataFrame, id: str, text: str) -> DataFrame:
    """(id, mark, text) of all rows that `wanted` (id, mark) lists, and of few others: those that its Bloom filter can't tell
    apart. The filter's size is bounded (see `exact`), and rows that it rules out are not shuffled."""
    key = F.xxhash64("id", "mark").alias("_key")
    words = filter_words(wanted.count())
    bits = cut(member_filter(wanted.select(key), "_key", words))
    marked = docs.select(col(id).alias("id"), col(text).alias("text"), F.xxhash64(col(text)).alias("mark")).select("*", key)
    return possibly_repeated(marked, "_key", words, bits, "_maybe").where("_maybe").select("id", "mark", "text")


def full_sets(docs: DataFrame, wanted: DataFrame, id: str, text: str, width: int = WIDTH) -> DataFrame:
    """(node, shingles) of the rows that `wanted` (node, id, mark), a written table, lists; of rows that repeat one is read.
    Texts meet by id and mark in the one shuffle that they go through."""
    ship(docs.sparkSession)
    once = wanted_texts(docs, wanted, id, text).groupBy("id", "mark").agg(F.first("text").alias("text"))
    narrow = once.join(wanted, ["id", "mark"]).select("node", "text")
    shape = T.StructType([narrow.schema["node"], T.StructField("shingles", T.ArrayType(T.LongType()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(t.as_py(), width).view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], shape.names)

    return narrow.mapInArrow(read, shape)


def prefix_pairs(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): the pairs of different components that share a shingle among the rarest of each. Sets 80 % alike differ in
    a fifth at most, so of the n shingles of either, in any one order, the first n - ceil(0.8 n) + 1 hold a common one."""
    least, whole = LIKE
    nodes = cut(placed.select("node", "root").distinct())
    held = sets.join(nodes, "node").select("node", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    counts = cut(held.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).where("times > 1"))
    common = held.join(counts, "shingle").groupBy("node", "root", "n").agg(
        F.array_sort(F.collect_list(F.struct("times", "shingle"))).alias("common")  # as long as the text at most
    )
    # Shingles that only one set has come first in the order and can't be shared.
    own = F.col("n") - F.size("common")
    reach = F.col("n") - F.expr(f"({least} * n + {whole - 1}) div {whole}") + 1 - own
    first = common.where(reach > 0).select(
        "node", "root", "n", own.alias("own"), F.posexplode(F.slice("common", F.lit(1), reach.cast("int"))).alias("i", "c")
    )
    # `after`: this shingle and those behind it. From the first common one on, that many can be common at most.
    after = F.col("n") - F.col("own") - F.col("i")
    rare = cut(first.select(F.col("c.shingle").alias("shingle"), "node", "root", "n", after.alias("after")))
    left = rare.select("shingle", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("n").alias("na"), F.col("after").alias("aa"))
    right = rare.select("shingle", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("n").alias("nb"), F.col("after").alias("ab"))
    may = apart(F.col("ra"), F.col("rb"), (F.col("na"), F.col("nb")), LIKE)
    enough = F.least("aa", "ab") * (least + whole) >= (F.col("na") + F.col("nb")) * least
    return left.join(right, (left["shingle"] == right["shingle"]) & may & enough).select("a", "b").distinct()


def _grouped(docs: DataFrame, id: str, text: str, width: int) -> DataFrame:
    """(id, mark, n, component, kept) of every row."""
    rows = cut(sketches(docs, id, text, width))
    # Equal sets have equal keys, so any row speaks for its class. Nodes are the classes, numbered; ids may repeat among them.
    classes = cut(
        rows.where("class is not null and id is not null")
        .groupBy("class")
        .agg(F.min(F.struct("id", "mark")).alias("head"), F.first("n").alias("size"), F.first("keys").alias("keys"))
        .select("class", "head.*", "size", "keys", F.monotonically_increasing_id().alias("node"))
    )
    keyed = crowded(classes.select(F.explode("keys").alias("key"), "node", "size"))
    wanted = cut(classes.select("node", "id", "mark").join(keyed.select("node").distinct(), "node", "left_semi"))
    sets = cut(full_sets(docs, wanted, id, text, width))
    least, whole = LIKE

    def verify(pairs: DataFrame) -> DataFrame:
        a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
        b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
        common = F.size(F.array_intersect("sa", "sb"))
        counted = pairs.join(a, "a").join(b, "b").select("a", "b", (F.size("sa") + F.size("sb")).alias("both"), common.alias("common"))
        return counted.where(F.col("common") * whole >= (F.col("both") - F.col("common")) * least)

    roots = linked(keyed, verify, lambda placed: prefix_pairs(placed, sets), LIKE)
    grouped = roots.select("node", "root").union(roots.select("root", "root")).distinct()
    inside = cut(classes.select("node", "id").join(grouped, "node"))
    smallest = inside.groupBy("root").agg(F.min("id").alias("component"))
    found = inside.select("node", "root").join(smallest, "root").select("node", "component")
    named = cut(classes.select("class", "node", "id").join(found, "node", "left").select("class", F.coalesce("component", "id").alias("component")))
    group = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return (
        rows.select("id", "mark", "n", "class")
        .join(named, "class", "left")
        .select("id", "mark", "n", group.alias("component"), F.coalesce(F.col("id") == group, F.lit(False)).alias("kept"))
    )


def near_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id of its group), kept."""
    return _grouped(docs, id, text, width).select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept"
    )


def first_of_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """`docs` without the near copies: of each group the row with the smallest id stays, with the columns it has. Rows are
    dropped by id and text, so a row that shares its id with a near copy stays; rows without an id stay."""
    copies = _grouped(docs, id, text, width).where("not kept and id is not null")
    dropped = copies.select(F.col("id").alias("_dropped"), F.col("mark").alias("_text")).distinct()
    packed = docs.select(F.struct("*").alias("_row"), col(id).alias("_id"), F.xxhash64(col(text)).alias("_mark"))
    return packed.join(dropped, (F.col("_id") == F.col("_dropped")) & (F.col("_mark") == F.col("_text")), "left_anti").select("_row.*")
