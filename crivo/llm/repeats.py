"""Long strings that repeat: every byte of a text that a string of `length` bytes covers which also starts earlier.

Run-length index. Places that may repeat are brought together, and there a run-compressed Burrows-Wheeler transform of
their bytes tells exactly which strings repeat. It keeps one sample for each run: the text position of its head, the
position that precedes it in suffix order (the end of the run before), and how long both match. From one sample to the
next along the text, the preceding position moves on by one and the match shrinks by one, so the matching statistics of
the whole text stream out of the samples; matches of `length` link a string to an equal one, and the first of each chain
of links stays.

1. **Anchors.** Of every 64 neighbouring strings the smallest hash of their common part is the anchor; equal strings have
   equal anchors, wherever they stand. A row is an anchor with the strings that chose it, `c` <= 64 of them from byte `at`
   on, and a digest of the bytes they span. Hashing and minima run over whole batches in NumPy.
2. **Equal spans.** Of the rows with one anchor and digest, the first by (document, position) stays; all strings of the
   others repeat. Each batch decides among its own rows first, so a span that stands in a third of all texts moves once a
   batch. Anchors that are frequent within a batch are decided in two turns, over salted groups and then among their
   winners, so no anchor meets in one task.
3. **Spans that differ.** The first spans of an anchor that has several are compared string by string: their bytes go, by
   anchor, into buckets of bounded size, each with its index. Anchors with more than `WIDE` different spans (the edge of
   a passage that stands in very many texts) have their strings decided one by one, again in two turns.
4. Marks come back to their document, which loses the bytes they cover.

Digests are 64 bits within one anchor of 64 bits, and 128 bits for single strings. Documents are ordered by id, null first; of rows that
share an id, texts are ordered by hash, and rows equal in both are one document and get one result each. Null texts are
empty; texts shorter than `length` lose nothing; matches never cross documents. Very long texts are read in pieces. Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crivo.llm.base import col, cut, ship, text_of
from crivo.operators.order import positions

LENGTH = 100
WINDOW = 64  # strings that share an anchor; their marks are the bits of one number
PIECE = 1 << 19  # strings looked at together
FREQUENT, AT_LEAST = 500, 40  # an anchor is frequent in one of so many documents of a batch, and so many times
SALTS = 64
WIDE = 2048  # different spans of one anchor that an index takes
BUCKET = 4096  # spans in one index, about; a few anchors more if their hashes meet


# === anchors ============================================================================================


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A mixed 64-bit hash of the k bytes from each place on."""
    base = 0x9E3779B97F4A7C15 | 1
    block, size = data.astype(np.uint64) + np.uint64(1), 1
    whole, done = None, 0
    while size <= k:
        factor = np.uint64(pow(base, size, 1 << 64))
        if k & size:
            if whole is None:
                whole = block
            else:
                tail = block[done:]
                whole = whole[: len(tail)] * factor + tail
            done += size
        if 2 * size <= k:
            block = block[:-size] * factor + block[size:]
        size *= 2
    z = whole[: max(0, len(data) - k + 1)].copy()
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xD6E8FEB86659FD93)):
        z ^= z >> np.uint64(shift)
        z *= np.uint64(factor)
    return z ^ (z >> np.uint64(32))


def leftmost_minima(z: np.ndarray) -> np.ndarray:
    """For each place, how far ahead the leftmost smallest of the next WINDOW values is."""
    ahead, step = np.zeros(len(z), np.uint8), 1
    while step < WINDOW:
        later = z[step:] < z[:-step]
        ahead = np.where(later, ahead[step:] + np.uint8(step), ahead[:-step])
        z = np.where(later, z[step:], z[:-step])
        step *= 2
    return ahead


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a text column, without a copy."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return at, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def spans_of(offsets: np.ndarray, data: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, digest, document, first string, strings) of the texts that `offsets` cut out of `data`, piece by piece."""
    k = length - WINDOW + 1
    ends = offsets[1:]
    for begin in range(int(offsets[0]), max(int(offsets[0]), int(offsets[-1]) - length + 1), PIECE):
        count = min(PIECE, int(offsets[-1]) - length + 1 - begin)
        part = data[begin : begin + count + length - 1]
        z = gram_hashes(part, k)
        anchor = leftmost_minima(z) + np.arange(count)
        # Strings that start in the last length - 1 bytes of a text would leave it.
        lo, hi = np.searchsorted(ends, (begin, begin + count + length), "left")
        near = ends[lo:hi]
        crossing = np.zeros(count + 1, np.int64)
        np.add.at(crossing, np.clip(np.maximum(near - length + 1, offsets[lo:hi]) - begin, 0, count), 1)
        np.add.at(crossing, np.clip(near - begin, 0, count), -1)
        inside = np.cumsum(crossing[:-1]) == 0
        changes = np.ones(count, bool)
        changes[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
        starts = np.flatnonzero(changes)
        sizes = np.diff(starts, append=count)
        kept = inside[starts]
        starts, sizes = starts[kept], sizes[kept]
        view = memoryview(part)
        digest = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(starts.tolist(), (starts + sizes + length - 1).tolist())]
        document = np.searchsorted(ends, starts + begin, "right")
        yield (
            z[anchor[starts]].view(np.int64), np.array(digest, np.uint64).view(np.int64), document,
            starts + begin - offsets[document], sizes,
        )


ANCHORS = pa.schema(
    [("anchor", pa.int64()), ("digest", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("c", pa.int32()),
     ("lost", pa.bool_()), ("frequent", pa.bool_())]
)


def _anchored(length: int):
    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            # In order of documents, so that the first of equal spans is the first here.
            order = np.argsort(ids, kind="stable")
            sorted_text = batch.column(1).take(pa.array(order))
            pieces = list(spans_of(*buffers(sorted_text), length))
            if not pieces:
                continue
            anchor, digest, place, at, c = (np.concatenate(parts) for parts in zip(*pieces))
            by = np.lexsort((np.arange(len(anchor)), digest, anchor))
            same = np.zeros(len(by), bool)
            same[1:] = (anchor[by][1:] == anchor[by][:-1]) & (digest[by][1:] == digest[by][:-1])
            lost = np.empty(len(by), bool)
            lost[by] = same
            _, inverse, times = np.unique(anchor, return_inverse=True, return_counts=True)
            frequent = times[inverse] >= max(AT_LEAST, batch.num_rows / FREQUENT)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (anchor, digest, ids[order][place], at, c.astype(np.int32), lost, frequent)], schema=ANCHORS
            )

    return anchored


# === the index ==========================================================================================


def suffixes(symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """(suffix array, ranks of the first 7, 14, 28, ... symbols of every suffix)."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(7, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(7):
        key = key * 512 + padded[i : i + n]
    levels, size = [], 7
    while True:
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int32)
        ordered = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        del ordered
        levels.append((size, rank))
        if rank[order[-1]] == n - 1:
            return order, levels
        later = np.zeros(n, np.int64)
        later[: max(0, n - size)] = rank[size:] + 1
        later += rank * np.int64(n + 1)
        key, size = later, 2 * size


def common_lengths(symbols: np.ndarray, levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols the suffixes at `a` and at `b` share."""
    n, a, b = len(symbols), a.copy(), b.copy()
    done = np.zeros(len(a), np.int64)
    for size, rank in [*reversed(levels), *[(1, symbols)] * 6]:
        both = (a + size <= n) & (b + size <= n)
        both[both] = rank[a[both]] == rank[b[both]]
        step = np.where(both, size, 0)
        a, b, done = a + step, b + step, done + step
    return done


class RunIndex:
    """The run-compressed transform of a text, with the samples of its runs."""

    def __init__(self, symbols: np.ndarray):
        order, levels = suffixes(symbols)
        before = symbols[order - 1]
        before[order == 0] = -1  # nothing stands before the text
        heads = np.ones(len(order), bool)
        heads[1:] = before[1:] != before[:-1]
        self.size = len(symbols)
        self.symbols, self.lengths = before[heads], np.diff(np.flatnonzero(heads), append=len(order))
        head = np.flatnonzero(heads)
        # Position at the head of each run, the one that precedes it at the end of the run before, their common length.
        at, back = order[head], np.concatenate([[-1], order[head[1:] - 1]])
        common = np.zeros(len(head), np.int64)
        common[1:] = common_lengths(symbols, levels, at[1:], back[1:])
        along = np.argsort(at)
        self.at, self.back, self.common = at[along], back[along], common[along]

    def matching(self) -> tuple[np.ndarray, np.ndarray]:
        """For each position of the text: the position before it in suffix order, and how long both match."""
        places = np.arange(self.size)
        sample = np.searchsorted(self.at, places, "right") - 1
        moved = places - self.at[sample]
        return self.back[sample] + moved, self.common[sample] - moved


def repeated_strings(spans: list[bytes], counts: np.ndarray, length: int) -> np.ndarray:
    """A number for each span, bit i set if its i-th string also starts earlier: in a span before it, or in this one. Only
    the first `counts` strings of a span count."""
    sizes = np.array([len(s) for s in spans])
    symbols = np.frombuffer(b"".join(s + b"\0" for s in spans), np.uint8).astype(np.int64) + 1
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    symbols[starts + sizes] = 0
    back, common = RunIndex(symbols).matching()
    head = np.where(common >= length, back, np.arange(len(symbols)))
    while True:
        further = head[head]
        if (further == head).all():
            break
        head = further
    # The strings that count, in order.
    span = np.repeat(np.arange(len(spans)), counts)
    bit = np.arange(len(span)) - np.repeat(np.cumsum(counts) - counts, counts)
    chain = head[starts[span] + bit]
    first = np.zeros(len(chain), bool)
    first[np.unique(chain, return_index=True)[1]] = True
    marks = np.zeros((len(spans), WINDOW), np.uint8)
    marks[span[~first], bit[~first]] = 1
    return np.packbits(marks, axis=1, bitorder="little").view("<i8").reshape(-1)


def _indexed(length: int):
    def indexed(bucket: pd.DataFrame) -> pd.DataFrame:
        bucket = bucket.sort_values(["doc", "at"])
        mask = repeated_strings(bucket["span"].tolist(), bucket["c"].to_numpy(np.int64), length)
        return bucket[["doc", "at"]].assign(mask=mask)[mask != 0]

    return indexed


# === spans and marks ====================================================================================


def first_of(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(first row by document and position of each key, all others), in two turns: within salted groups, and among their
    winners. So the rows of one key never meet in one task."""
    order = [F.col("doc"), F.col("at")]
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc", "at"), F.lit(SALTS)))
    once = cut(salted.withColumn("_turn", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order))).drop("_salt"))
    twice = once.where("_turn = 1").withColumn("_turn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    both = cut(twice)
    rest = once.where("_turn > 1").unionByName(both.where("_turn > 1"))
    return both.where("_turn = 1").drop("_turn"), rest.drop("_turn")


def whole_mask() -> Column:
    """The marks of all strings of a span."""
    return F.expr(f"shiftrightunsigned(-1L, {WINDOW} - c)")


def _cut_out(length: int):
    schema = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("c", pa.int32()), ("span", pa.binary())])

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of the wanted spans; of wide anchors, a digest of each string, without anchor."""
        for batch in batches:
            rows: list[tuple] = []
            for doc, text, wanted in zip(*[batch.column(i) for i in range(3)]):
                data = text.as_py().encode()
                for w in wanted.as_py():
                    at, c = w["at"], w["c"]
                    if w["wide"]:
                        rows += [(None, doc.as_py(), i, 1, hashlib.blake2b(data[i : i + length], digest_size=16).digest()) for i in range(at, at + c)]
                    else:
                        rows.append((w["anchor"], doc.as_py(), at, c, data[at : at + c + length - 1]))
                if len(rows) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)

    return cut_out


def numbered(docs: DataFrame, id: str, text: str) -> tuple[DataFrame, DataFrame | None]:
    """((doc, text), (row's id as `_id`, doc)): documents under numbers that order them. Whole ids that are unique serve
    themselves; then there is no second table."""
    named = docs.select(col(id).alias("_id"), text_of(text).alias("text"))
    repeats = named.groupBy("_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or _id is null")
    if isinstance(docs.schema[id].dataType, T.IntegralType) and repeats.isEmpty():
        return named.select(F.col("_id").cast("bigint").alias("doc"), "text"), None
    hashed = named.withColumn("_hash", F.xxhash64("text"))
    order = positions(hashed.select("_id", "_hash").distinct(), ["_id", "_hash"], name="doc")
    known = order.select(F.col("_id").alias("_k"), F.col("_hash").alias("_h"), "doc")
    same = (F.col("_hash") == F.col("_h")) & F.col("_id").eqNullSafe(F.col("_k"))
    joined = cut(hashed.join(known, same).select("_id", "doc", "text"))
    return joined.groupBy("doc").agg(F.first("text").alias("text")), joined.select("_id", "doc")


def marks_of(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, at, mask): from byte `at` on, the strings of the set bits also start earlier. `texts`: unique doc, text."""
    ship(texts.sparkSession)
    rows = cut(texts.mapInArrow(_anchored(length), "anchor bigint, digest bigint, doc bigint, at bigint, c int, lost boolean, frequent boolean"))
    facts = rows.agg(F.count_if("frequent").alias("frequent"), F.count(F.lit(1)).alias("rows")).first()
    left = rows.where("not lost").drop("lost", "frequent")
    marks = [rows.where("lost").select("doc", "at", whole_mask().alias("mask"))]
    needs = []
    if facts["frequent"]:
        # At most as many anchors as fit into all rows so often: their number doesn't grow with the documents.
        often = rows.where("frequent").groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
        often = cut(often.where(F.col("n") >= max(AT_LEAST, facts["rows"] // 100_000)).select("anchor"))
        hot = F.broadcast(often)
        first, others = first_of(left.join(hot, "anchor"), ["anchor", "digest"])
        marks.append(others.select("doc", "at", whole_mask().alias("mask")))
        spans = first.groupBy("anchor").agg(F.count(F.lit(1)).alias("spans"))
        needs.append(first.join(F.broadcast(spans), "anchor").where("spans > 1").select("anchor", "doc", "at", "c", (F.col("spans") > WIDE).alias("wide")))
        left = left.join(hot, "anchor", "left_anti")
    same = Window.partitionBy("anchor", "digest")
    placed = left.repartition("anchor").withColumn("turn", F.row_number().over(same.orderBy("doc", "at")))
    spans = F.count_if(F.col("turn") == 1).over(Window.partitionBy("anchor"))
    told = cut(placed.withColumn("spans", spans).where("turn > 1 or spans > 1").drop("digest"))
    marks.append(told.where("turn > 1").select("doc", "at", whole_mask().alias("mask")))
    needs.append(told.where("turn = 1").select("anchor", "doc", "at", "c", (F.col("spans") > WIDE).alias("wide")))

    wanted = needs[0] if len(needs) == 1 else needs[0].unionByName(needs[1])
    listed = wanted.groupBy("doc").agg(F.collect_list(F.struct("anchor", "at", "c", "wide")).alias("wanted"))
    spelled = cut(
        texts.join(listed, "doc").select("doc", "text", "wanted").mapInArrow(_cut_out(length), "anchor bigint, doc bigint, at bigint, c int, span binary")
    )
    buckets = max(1, -(-spelled.where("anchor is not null").count() // BUCKET))
    narrow = spelled.where("anchor is not null").groupBy(F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket"))
    marks.append(narrow.applyInPandas(_indexed(length), "doc bigint, at bigint, mask bigint"))
    if facts["frequent"] or not told.where(F.col("spans") > WIDE).isEmpty():
        _, others = first_of(spelled.where("anchor is null").drop("anchor"), ["span"])
        marks.append(others.select("doc", "at", whole_mask().alias("mask")))
    together = marks[0]
    for part in marks[1:]:
        together = together.unionByName(part)
    return cut(together)


def covered(n: int, at: np.ndarray, mask: np.ndarray, length: int) -> np.ndarray:
    """(begin, end) of the bytes that the marked strings cover, as rows in order; overlapping and touching ones are one."""
    bits = np.unpackbits(mask.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(bits)
    starts = np.unique(at[row] + bit)
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    apart = np.flatnonzero(np.diff(starts) > length)
    begins = starts[np.concatenate([[0], apart + 1])]
    ends = starts[np.concatenate([apart, [len(starts) - 1]])] + length
    return np.stack([begins, ends], axis=1)


def _kept(length: int):
    schema = pa.schema(
        [("doc", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]
    )

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes, spans, left = [], [], []
            for text, at, mask in zip(*[batch.column(i) for i in (1, 2, 3)]):
                data, found = text.as_py().encode(), []
                if at.is_valid:
                    found = covered(len(data), at.values.to_numpy(), mask.values.to_numpy(), length).tolist()
                sizes.append(len(data))
                spans.append([{"begin": b, "end": e} for b, e in found])
                edges = [0, *[x for span in found for x in span], len(data)]
                left.append(b"".join(data[b:e] for b, e in zip(edges[::2], edges[1::2])) if found else data)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, schema.field(i + 1).type) for i, x in enumerate((sizes, spans, left))]], schema=schema
            )

    return kept


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: id, n_bytes, spans (begin, end) of the bytes that go, kept (the bytes that stay)."""
    if length < WINDOW + 15:
        raise ValueError(f"length must be {WINDOW + 15} at least")
    texts, named = numbered(docs, id, text)
    listed = marks_of(texts, length).groupBy("doc").agg(F.collect_list("at").alias("at"), F.collect_list("mask").alias("mask"))
    told = texts.join(listed, "doc", "left").select("doc", "text", "at", "mask").mapInArrow(
        _kept(length), "doc bigint, n_bytes bigint, spans array<struct<begin: bigint, end: bigint>>, kept binary"
    )
    if named is None:
        return told.select(F.col("doc").cast(docs.schema[id].dataType).alias(id), "n_bytes", "spans", "kept")
    return named.join(told, "doc").drop("doc").withColumnRenamed("_id", id)
