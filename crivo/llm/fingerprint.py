"""Document fingerprints: a randomised edit embedding, sampled, banded and verified.

The embedding reads a text through a shared random walk: at step t it repeats the current character and moves on to the
next one if a random bit for (t, character) says so. Texts that differ by few edits fall back into step, so their edit
distance becomes a Hamming distance of the embedded strings (about twice as long as the text). Characters are code
points, hashed to 256 classes; the walk's bits repeat every `PERIOD` steps.

The fingerprint samples the embedded string: level k picks one position from each cell of 2^k steps, and each cell of level
k + 1 takes over the pick of one of its two halves, so a fingerprint can be thinned to any coarser level. The level is the
lowest with at most `SAMPLES` cells. Each pick becomes one hex digit, a hash of position and character. The whole text is
walked, whatever its length. Likeness is the share of equal digits at the coarser of two levels, with chance taken out.

Null texts count as empty; their fingerprint has no digits and is like another empty one alone. Ids are integers; a
null id stands last in descending order, rows that repeat an id stand together, ordered by text. A single document is
followed by itself. No rows: no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crivo.llm.base import col, ship, text_of
from crivo.llm.groups import crowded, linked
from crivo.llm.near import scramble

SAMPLES = 512
CLASSES, PERIOD = 256, 4096
#: Characters walked together, and texts below which each is walked by itself.
TOGETHER, FEW = 12_000_000, 40
#: Digits in a band.
BAND = 6
LIKE = 0.8

_SEED = np.uint64(0x2545F4914F6CDD1D)


def _walk_table() -> np.ndarray:
    """Steps that a character of class c takes from step t on until it is left, at c * PERIOD + t."""
    cells = np.arange(CLASSES * PERIOD, dtype=np.uint64).reshape(CLASSES, PERIOD)
    moves = (scramble(cells + _SEED) >> np.uint64(63)).astype(bool)
    steps = np.zeros((CLASSES, PERIOD), np.int64)
    ahead = np.zeros(CLASSES, np.int64)
    for t in [*range(PERIOD - 1, -1, -1)] * 2:  # twice, as the table is a ring
        ahead = np.where(moves[:, t], 1, ahead + 1)
        steps[:, t] = ahead
    return steps.ravel()


class _Tables:
    steps: np.ndarray | None = None
    rows: list[list[int]] = []


def _tables() -> type[_Tables]:
    if _Tables.steps is None:
        _Tables.steps = _walk_table()
        _Tables.rows = _Tables.steps.reshape(CLASSES, PERIOD).tolist()
    return _Tables


def classes_of(text: str) -> np.ndarray:
    """The class of each code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return (scramble(points.astype(np.uint64) + _SEED) & np.uint64(CLASSES - 1)).astype(np.uint8)


def walks(texts: list[np.ndarray], starts: list[int]) -> tuple[list[np.ndarray], list[int]]:
    """For each text the step at which each of its characters is entered, and the step at which the text ends."""
    tables = _tables()
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = np.concatenate([*texts, np.empty(0, np.uint8)]).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    entered = np.zeros(len(flat), np.int64)
    order = np.argsort(-sizes, kind="stable")
    at, step, ranked = begin[order], np.array(starts, np.int64)[order], -sizes[order]
    going, i = int(np.searchsorted(ranked, 0)), 0
    while going > FEW:
        where = at[:going] + i
        now = step[:going]
        entered[where] = now
        now += tables.steps[flat[where] * PERIOD + (now & (PERIOD - 1))]
        i += 1
        going = int(np.searchsorted(ranked[:going], -i))
    for n in range(going):
        low, high, t, rows = int(at[n]) + i, int(at[n]) - int(ranked[n]), int(step[n]), tables.rows
        visited = []
        for c in flat[low:high].tolist():
            visited.append(t)
            t += rows[c][t & (PERIOD - 1)]
        entered[low:high] = visited
        step[n] = t
    ends = np.empty(len(texts), np.int64)
    ends[order] = step
    return [entered[b : b + s] for b, s in zip(begin.tolist(), sizes.tolist(), strict=True)], ends.tolist()


def _turn(level: int, cells: np.ndarray) -> np.ndarray:
    """Which half of each cell of this level hands on its pick."""
    return (scramble(cells.astype(np.uint64) * np.uint64(64) + np.uint64(level) + _SEED) >> np.uint64(63)).astype(np.int64)


def picks(level: int, length: int) -> np.ndarray:
    """The positions below `length` that the level picks."""
    cells = np.arange(-(-length // (1 << level)), dtype=np.int64)
    for finer in range(level, 0, -1):
        cells = 2 * cells + _turn(finer, cells)
    return cells[cells < length]


def level_of(length: int) -> int:
    return max(0, (max(length, 1) - 1).bit_length() - SAMPLES.bit_length() + 1)


def fingerprint(classes: np.ndarray, entered: np.ndarray, end: int) -> str:
    """`level:digits` of an embedded text: characters `classes`, entered at these steps, ending at step `end`."""
    level = level_of(end)
    places = picks(level, end)
    held = classes[np.searchsorted(entered, places, side="right") - 1].astype(np.uint64) if len(places) else places
    digits = scramble(places.astype(np.uint64) * np.uint64(CLASSES) + held.astype(np.uint64)) >> np.uint64(60)
    return f"{level:x}:" + "".join(map("0123456789abcdef".__getitem__, digits.tolist()))


def _parsed(print_: str) -> tuple[int, np.ndarray]:
    level, digits = print_.split(":")
    return int(level, 16), np.frombuffer(digits.encode(), np.uint8)


def _thinned(level: int, digits: np.ndarray, to: int) -> np.ndarray:
    for coarser in range(level + 1, to + 1):
        cells = np.arange(-(-len(digits) // 2), dtype=np.int64)
        taken = 2 * cells + _turn(coarser, cells)
        digits = digits[taken[taken < len(digits)]]
    return digits


def likeness(a: str, b: str) -> float:
    """0 (no more alike than by chance) to 1 (equal digits throughout)."""
    (la, da), (lb, db) = _parsed(a), _parsed(b)
    level = max(la, lb)
    da, db = _thinned(la, da, level), _thinned(lb, db, level)
    longer, shorter = max(len(da), len(db)), min(len(da), len(db))
    if not longer:
        return 1.0
    equal = int((da[:shorter] == db[:shorter]).sum()) / longer
    return max(0.0, (equal - 1 / 16) / (15 / 16))


def prints(texts: list[str]) -> list[str]:
    """The fingerprints of whole texts."""
    classes = [classes_of(t) for t in texts]
    entered, ends = walks(classes, [0] * len(texts))
    return [fingerprint(c, w, e) for c, w, e in zip(classes, entered, ends, strict=True)]


def edited_prints(pairs: list[tuple[str, str]]) -> list[tuple[str, str, str, str]]:
    """(edited text, fingerprint, its fingerprint, the next text's) of each (text, next text): the second half of the
    text is replaced by the start of the next. The walk over the kept half is shared."""
    chain = [t for t, _ in pairs] + [n for _, n in pairs]
    where = {t: i for i, t in enumerate(dict.fromkeys(chain))}
    classes = [classes_of(t) for t in where]
    entered, ends = walks(classes, [0] * len(classes))
    whole = [fingerprint(c, w, e) for c, w, e in zip(classes, entered, ends, strict=True)]
    kept, tails, starts = [], [], []
    for text, following in pairs:
        i, half = where[text], len(text) // 2
        keep = len(text) - half
        kept.append(keep)
        tails.append(classes[where[following]][:half])
        starts.append(int(entered[i][keep]) if half else ends[i])
    walked, tail_ends = walks(tails, starts)
    out = []
    for (text, following), keep, tail, steps, end in zip(pairs, kept, tails, walked, tail_ends, strict=True):
        i = where[text]
        symbols, places = np.concatenate([classes[i][:keep], tail]), np.concatenate([entered[i][:keep], steps])
        edited = text[:keep] + following[: len(tail)]
        out.append((edited, whole[i], fingerprint(symbols, places, end), whole[where[following]]))
    return out


def in_line(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(place, ghost, id, text), in partitions that each hold runs of documents in descending order of id; behind each
    run stands, as a ghost, the first document of the next run, so every document meets its successor. Runs are cut at
    quantiles of the ids; what the driver sees is one row per partition."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select(col(id).cast("bigint").alias("id"), text_of(text).alias("text"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    cuts = narrow.agg(F.percentile_approx("id", F.array(*map(F.lit, shares)), F.lit(10_000))).first()[0] or []
    cuts = sorted(set(cuts))
    below = F.size(F.filter(F.array(*[F.lit(c).cast("bigint") for c in cuts]), lambda c: c < F.col("id"))) if cuts else F.lit(0)
    place = F.when(F.col("id").isNull(), F.lit(len(cuts) + 1)).otherwise(F.lit(len(cuts)) - below).cast("int")
    runs = narrow.select(place.alias("place"), "id").groupBy("place").agg(F.max("id").alias("first")).orderBy("place").collect()
    ahead = [(runs[i]["place"], runs[(i + 1) % len(runs)]["first"]) for i in range(len(runs))]
    ghosts = docs.sparkSession.createDataFrame(ahead, "_before int, _first bigint")
    doubled = narrow.withColumn("place", place).join(F.broadcast(ghosts), F.col("id").eqNullSafe(F.col("_first")), "left")
    both = F.array(
        F.struct(F.col("place").alias("place"), F.lit(False).alias("ghost")),
        F.struct(F.col("_before").alias("place"), F.lit(True).alias("ghost")),
    )
    rows = doubled.select(F.explode(F.filter(both, lambda x: x["place"].isNotNull())).alias("x"), "id", "text")
    rows = rows.select("x.place", "x.ghost", "id", "text")
    return rows.repartitionById(parts, F.pmod("place", F.lit(parts)).cast("int")).sortWithinPartitions(
        "place", "ghost", F.col("id").desc_nulls_last(), "text"
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows in pieces of bounded size; each piece starts with the last row of the one before."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for place, ghost, key, text in zip(*(batch.column(i) for i in range(4)), strict=True):
            held.append((place.as_py(), ghost.as_py(), key.as_py(), text.as_py()))
            size += len(held[-1][3])
            if size >= TOGETHER:
                yield held
                held, size = held[-1:], len(held[-1][3])
    if held:
        yield held


def edits(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    ship(docs.sparkSession)
    shape = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            met = [(a[2], a[3], b[3]) for a, b in zip(rows, rows[1:]) if not a[1]]
            out = []
            for (key, own, _), (edited, mine, other, following) in zip(met, edited_prints([m[1:] for m in met]), strict=True):
                digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                out.append((key, len(own), digest, mine, other, likeness(mine, other), likeness(mine, following)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], shape.names
            )

    return in_line(docs, id, text).mapInArrow(read, shape).withColumnRenamed("id", id)


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint) of every whole text."""
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def printed(texts: pd.Series) -> pd.Series:
        out: list[str] = []
        held: list[str] = []
        size = 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= TOGETHER:
                out += prints(held)
                held, size = [], 0
        return pd.Series(out + prints(held), dtype="object")

    return docs.select(col(id), printed(text_of(text)).alias("fingerprint"))


def near_texts(printed: DataFrame, id: str = "doc_id", least: float = LIKE) -> DataFrame:
    """(id, component_id) of texts whose fingerprints are alike, from (id, fingerprint). Bands of `BAND` sampled digits
    bring candidates together, at the fingerprint's level and at the next coarser one; links are verified on whole
    fingerprints. Equal fingerprints are one class. Empty texts link with nothing."""
    ship(printed.sparkSession)

    @F.pandas_udf("array<string>")
    def keys(values: pd.Series) -> pd.Series:
        out = []
        for value in values:
            level, digits = _parsed(value)
            found = []
            for to in (level, level + 1):
                raw = _thinned(level, digits, to).tobytes().decode()
                found += [f"{to:x}.{i:x}.{raw[i:i + BAND]}" for i in range(0, len(raw), BAND)]
            out.append(found)
        return pd.Series(out)

    @F.pandas_udf("double")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    classes = printed.groupBy("fingerprint").agg(F.min(col(id)).alias("node"))
    banded = classes.where("node is not null").select(F.explode(keys("fingerprint")).alias("key"), "node", F.lit(1).alias("size"))
    keyed = crowded(banded)

    def verify(pairs: DataFrame) -> DataFrame:
        a = classes.select(F.col("node").alias("a"), F.col("fingerprint").alias("fa"))
        b = classes.select(F.col("node").alias("b"), F.col("fingerprint").alias("fb"))
        return pairs.join(a, "a").join(b, "b").where(alike("fa", "fb") >= least)

    roots = linked(keyed, verify)
    named = classes.join(roots, "node", "left").select("fingerprint", F.coalesce("root", "node").alias("_root"))
    empty = F.substring_index("fingerprint", ":", -1) == ""
    grouped = printed.join(named, "fingerprint", "left")
    return grouped.select(col(id), F.when(empty, col(id)).otherwise(F.coalesce("_root", col(id))).alias("component_id"))
