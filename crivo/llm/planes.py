"""Token files: ids in blocks of fixed size, transposed into bit or byte planes, each plane compressed by itself.

Documents are range-partitioned by id; partition k becomes segment k, so segments in order hold documents in ascending
id order. Each task streams its sorted documents, encodes them, appends the end id, and cuts the stream of ids into
blocks of `BLOCK`. A block is one row of the `chunks` table: its segment, number, first id and count, its planes (plane
j of a byte block holds byte j of every id, plane j of a bit block bit j; high planes are nearly constant and shrink to
nothing under zstandard), and the documents that it touches. Spark's writer stores the rows as Parquet, so files
appear only when their task commits, on any store that Spark writes to, and a lost executor costs its tasks only. The `index`
table names every chunk's segment, number, start in the whole corpus, ids and compressed bytes.

The reader needs no order: it decodes each chunk by itself, and joins only documents that cross chunk borders (at most
one per border). Segment offsets are one row per partition.

Null texts count as empty: they have the end id alone. A null id comes first; repeated ids stand together, ordered
by text. No rows: an empty file. Every id must fit 32 bits.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crivo.llm.base import col, cut, ship, text_of
from crivo.llm.words import encoded
from crivo.session import checkpoint_folder

#: Ids in a block.
BLOCK = 65_536
LEVEL = 3


def new_folder(spark: SparkSession) -> str:
    """A fresh folder for one token file, in the shared folder."""
    return f"{checkpoint_folder(spark)}/tokens-{uuid.uuid4().hex}"


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def byte_planes(ids: np.ndarray) -> list[bytes]:
    """Four planes: byte 0 of all ids, byte 1 of all ids, and so on."""
    return [p.tobytes() for p in np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)]


def from_byte_planes(planes: list[bytes], count: int) -> np.ndarray:
    stacked = np.stack([np.frombuffer(p, np.uint8) for p in planes]) if count else np.empty((4, 0), np.uint8)
    return np.ascontiguousarray(stacked.T).reshape(-1).view("<u4")


def bit_planes(ids: np.ndarray) -> list[bytes]:
    """Thirty-two planes: the lowest bit of all ids, the next bit of all ids, and so on."""
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return [np.packbits(p).tobytes() for p in bits.T]


def from_bit_planes(planes: list[bytes], count: int) -> np.ndarray:
    bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=count) for p in planes])
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").reshape(-1).view("<u4")


KINDS: dict[str, tuple[Callable, Callable]] = {
    "byte": (byte_planes, from_byte_planes),
    "bit": (bit_planes, from_bit_planes),
}


def _touched(kind: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField("id", kind), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )


def _chunk_schema(kind: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("segment", T.IntegerType()),
            T.StructField("chunk", T.LongType()),
            T.StructField("first", T.LongType()),
            T.StructField("n_ids", T.LongType()),
            T.StructField("planes", T.ArrayType(T.BinaryType())),
            T.StructField("documents", T.ArrayType(_touched(kind))),
        ]
    )


def blocks(documents: Iterator[tuple], size: int) -> Iterator[tuple[int, np.ndarray, list[tuple]]]:
    """(first id, ids, touched documents) of each block, from (id, array of ids) in order. Holds one block and one
    document at a time."""
    held, room, first, at = [], size, 0, 0
    touched: list[tuple] = []
    for key, ids in documents:
        entry, done = (key, at, len(ids)), 0
        at += len(ids)
        if not len(ids):
            touched.append(entry)
        while done < len(ids):
            part = ids[done : done + room]
            held.append(part)
            touched.append(entry)
            done, room = done + len(part), room - len(part)
            if not room:
                yield first, np.concatenate(held), touched
                held, room, first, touched = [], size, first + size, []
    if held or touched:
        yield first, np.concatenate(held) if held else np.zeros(0, "<u4"), touched


def write(
    docs: DataFrame,
    root: str,
    tokenizer: str,
    end: int | None = None,
    id: str = "doc_id",
    text: str = "text",
    planes: str = "byte",
    block: int = BLOCK,
) -> None:
    """Writes the token file of all documents: `root`/chunks and `root`/index."""
    spark = docs.sparkSession
    ship(spark)
    described = spark.sparkContext.broadcast(tokenizer)  # as large as the vocabulary
    apart = KINDS[planes][0]
    last = b"" if end is None else int(end).to_bytes(4, "little")
    key_type = docs.schema[id].dataType
    shape = _chunk_schema(key_type)
    named = docs.select(col(id).alias("id"), text_of(text).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = named.repartitionByRange(parts, "id").sortWithinPartitions("id", "text")
    touched_type = pa.list_(
        pa.struct([("id", named.limit(0).toArrow().schema.field("id").type), ("start", pa.int64()), ("n_tokens", pa.int64())])
    )

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId()
        packer = zstandard.ZstdCompressor(level=LEVEL)

        def documents() -> Iterator[tuple]:
            for batch in batches:
                texts = (t.as_py() for t in batch.column(1))
                for key, ids in zip(batch.column(0).to_pylist(), encoded(texts, described.value), strict=True):
                    yield key, np.frombuffer(ids + last, "<u4")

        for number, (first, ids, touched) in enumerate(blocks(documents(), block)):
            entries = [{"id": k, "start": s, "n_tokens": n} for k, s, n in touched]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([segment], pa.int32()),
                    pa.array([number], pa.int64()),
                    pa.array([first], pa.int64()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([[packer.compress(p) for p in apart(ids)]], pa.list_(pa.binary())),
                    pa.array([entries], touched_type),
                ],
                [f.name for f in shape.fields],
            )

    # Planes are compressed already.
    ordered.mapInArrow(chunked, shape).write.option("compression", "uncompressed").parquet(f"{root}/chunks")
    chunks = spark.read.schema(shape).parquet(f"{root}/chunks")
    sizes = F.transform("planes", lambda p: F.octet_length(p))
    index = chunks.select("segment", "chunk", "first", "n_ids", sizes.alias("plane_bytes"))
    index = index.join(F.broadcast(_offsets(chunks)), "segment")
    index.select("segment", "chunk", (F.col("offset") + F.col("first")).alias("start"), "n_ids", "plane_bytes").write.parquet(
        f"{root}/index"
    )


def _offsets(chunks: DataFrame) -> DataFrame:
    """(segment, offset): one row per partition of the writer, so one window may hold them all."""
    totals = chunks.groupBy("segment").agg(F.sum("n_ids").alias("_ids"))
    earlier = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("segment", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).cast("bigint").alias("offset"))


def pieces(spark: SparkSession, root: str, planes: str = "byte") -> DataFrame:
    """What each chunk holds of each document, as (segment, id, start, n_tokens, at, part): `part` is the piece's ids
    as little-endian unsigned 32-bit integers, from the document's id number `at` on."""
    ship(spark)
    chunks = spark.read.parquet(f"{root}/chunks")
    together = KINDS[planes][1]
    touched = chunks.schema["documents"].dataType.elementType
    shape = T.StructType(
        [T.StructField("segment", T.IntegerType()), *touched.fields, T.StructField("at", T.LongType()), T.StructField("part", T.BinaryType())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in range(batch.num_rows):
                segment, first, count, packed, entries = (batch.column(i)[row] for i in range(5))
                first, count = first.as_py(), count.as_py()
                raw = together([unpacker.decompress(p.as_py()) for p in packed], count).tobytes()
                inside = entries.values
                starts, sizes = inside.field("start").to_numpy(), inside.field("n_tokens").to_numpy()
                low = np.maximum(starts, first)
                high = np.minimum(starts + sizes, first + count)
                parts = [raw[4 * (a - first) : 4 * (b - first)] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                columns = [inside.field("id"), inside.field("start"), inside.field("n_tokens")]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([segment.as_py()] * len(inside), pa.int32()),
                        *columns,
                        pa.array(low - starts, pa.int64()),
                        pa.array(parts, pa.binary()),
                    ],
                    [f.name for f in shape.fields],
                )

    return chunks.select("segment", "first", "n_ids", "planes", "documents").mapInArrow(read, shape)


def digests(spark: SparkSession, root: str, planes: str = "byte", id: str = "doc_id") -> DataFrame:
    """One row per document of the file: id, start (ids of all documents before it), n_tokens, ids_crc32."""
    found = pieces(spark, root, planes)
    # A piece stays the few bytes of its checksum unless its document goes on in another chunk.
    whole = F.octet_length("part") == F.col("n_tokens") * 4
    narrow = found.select(
        "segment", "id", "start", "n_tokens", "at", F.when(whole, F.crc32("part")).alias("crc"), F.when(~whole, F.col("part")).alias("part")
    )
    stored = cut(narrow)
    alone = stored.where("crc is not null").select("segment", "id", "start", "n_tokens", F.col("crc").alias("ids_crc32"))
    split = stored.where("crc is null").groupBy("segment", "start").agg(
        F.first("id").alias("id"), F.first("n_tokens").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("at", "part"))).alias("parts")
    )
    joined = F.aggregate("parts", F.lit(b""), lambda out, p: F.concat(out, p["part"]))
    crossing = split.select("segment", "id", "start", "n_tokens", F.crc32(joined).alias("ids_crc32"))
    placed = alone.unionByName(crossing).join(F.broadcast(_offsets(spark.read.parquet(f"{root}/chunks"))), "segment")
    return placed.select(F.col("id").alias(id), (F.col("offset") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


