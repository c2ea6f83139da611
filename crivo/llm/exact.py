"""Exact dedup: a Bloom filter of repeated hashes decides which rows must meet; the others never move.

The first pass hashes every normalised text (A-Z lowered) with SHA-256 and counts hits per slot of a blocked Bloom
filter: a hash picks one 64-bit word and two bits of it. A slot hit twice sets its bit in the filter. The second
pass tests each row: only rows whose two bits are both set can share their text with another row, so only they are
shuffled and grouped by their full hash; all others are known to be unique and pass straight through. A false
positive costs a shuffled row, never a wrong answer.

The filter has 16 bits per row up to `max_words` 64-bit words, whatever the input: that bounds what is broadcast
(4 million words are 64 MB). Beyond 256 million rows the fixed filter fills up and more rows are shuffled; results stay
exact. Counting is pre-aggregated in each task, so a text that a third of all rows repeats moves one row a task.

Nulls and empties: a null text counts as empty. A null id takes part, stays only if no copy has an id, and sorts
below all ids. Rows that repeat both id and text are copies too: one of them stays. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crivo.llm.base import col, cut, normalised, power_of_two, text_of

BITS_PER_ROW = 16
MAX_WORDS = 1 << 22

_WORD, _MASK, _SET = "_filter_word", "_filter_mask", "_filter_set"


def text_hash(text: Column) -> Column:
    """Lowercase hex SHA-256 of the normalised text."""
    return F.sha2(normalised(text), 256)


def _first_bit(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 40).bitwiseAND(F.lit(63)).cast("int")


def _second_bit(hashed: Column) -> Column:
    """Never the first bit: 1 to 63 places further on."""
    step = F.shiftrightunsigned(hashed, 46).bitwiseAND(F.lit(0x3FFF)) % 63 + 1
    return ((_first_bit(hashed) + step) % 64).cast("int")


def _flag(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def _placed(hashes: DataFrame, key: str, words: int) -> DataFrame:
    """Adds the filter word and the two bits of each hash."""
    hashed = F.xxhash64(col(key))
    return hashes.withColumns(
        {
            _WORD: hashed.bitwiseAND(F.lit(words - 1)),
            "_first": _first_bit(hashed),
            "_second": _second_bit(hashed),
        }
    )


def repeated_filter(hashes: DataFrame, key: str, words: int) -> DataFrame:
    """Rows (word, bits): the filter's words with a bit for every slot that was hit more than once."""
    hits = _placed(hashes.select(col(key)), key, words).select(
        _WORD, F.explode(F.array("_first", "_second")).alias("_bit")
    )
    slots = hits.groupBy(_WORD, "_bit").agg(F.count(F.lit(1)).alias("_hits")).where("_hits > 1")
    return slots.groupBy(_WORD).agg(F.bit_or(_flag(F.col("_bit"))).alias(_SET))


def member_filter(hashes: DataFrame, key: str, words: int) -> DataFrame:
    """Rows (word, bits): the filter's words with both bits of every hash."""
    mask = _flag(F.col("_first")).bitwiseOR(_flag(F.col("_second")))
    return _placed(hashes.select(col(key)), key, words).groupBy(_WORD).agg(F.bit_or(mask).alias(_SET))


def filter_words(rows: int, max_words: int = MAX_WORDS) -> int:
    """How many 64-bit words a filter for so many rows has."""
    return min(power_of_two(max(64, rows * BITS_PER_ROW) // 64), max_words)


def possibly_repeated(rows: DataFrame, key: str, words: int, bits: DataFrame, out: str) -> DataFrame:
    """Adds the boolean `out`: false for rows whose hash is surely the only one of its kind; with the bits of a `member_filter`,
    for rows whose hash is surely no member."""
    mask = _flag(F.col("_first")).bitwiseOR(_flag(F.col("_second")))
    placed = _placed(rows, key, words).withColumn(_MASK, mask).drop("_first", "_second")
    tested = placed.join(F.broadcast(bits), _WORD, "left")  # at most `max_words` rows of two longs
    hit = F.col(_SET).bitwiseAND(F.col(_MASK)) == F.col(_MASK)
    return tested.withColumn(out, F.coalesce(hit, F.lit(False))).drop(_WORD, _MASK, _SET)


class Repeats:
    """The first pass over `docs`: hashes, filter, and the groups of equal texts."""

    def __init__(self, docs: DataFrame, id: str = "doc_id", text: str = "text", max_words: int = MAX_WORDS):
        self.id, self.text = id, text
        self.hashes = cut(docs.select(col(id).alias("_id"), text_hash(text_of(text)).alias("_sha")))
        self.words = filter_words(self.hashes.count(), max_words)
        self.bits = cut(repeated_filter(self.hashes, "_sha", self.words))
        marked = possibly_repeated(self.hashes, "_sha", self.words, self.bits, "_maybe")
        self.unique, self.candidates = marked.where("not _maybe"), marked.where("_maybe")
        self.groups = self.candidates.groupBy("_sha").agg(
            F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_size")
        )

    def decisions(self) -> DataFrame:
        """One row per document: id, keep_id, group_size, kept, text_sha256."""
        alone = self.unique.select(
            F.col("_id").alias(self.id),
            F.col("_id").alias("keep_id"),
            F.lit(1).cast("bigint").alias("group_size"),
            F.lit(True).alias("kept"),
            F.col("_sha").alias("text_sha256"),
        )
        # Rows that repeat an id with its text count once here, and come back numbered.
        rows = self.candidates.groupBy("_sha", "_id").agg(F.count(F.lit(1)).alias("_copies"))
        met = rows.join(self.groups, "_sha").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        met = met.select(
            F.col("_id").alias(self.id),
            F.col("_keep").alias("keep_id"),
            F.col("_size").alias("group_size"),
            (F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_copy") == 1)).alias("kept"),
            F.col("_sha").alias("text_sha256"),
        )
        return alone.unionByName(met)

    def kept(self, docs: DataFrame) -> DataFrame:
        """The rows of `docs` that stay, with the columns they have. The second pass over the texts."""
        packed = docs.select(
            F.struct("*").alias("_row"), col(self.id).alias("_id"), text_hash(text_of(self.text)).alias("_sha")
        )
        marked = possibly_repeated(packed, "_sha", self.words, self.bits, "_maybe")
        named = self.groups.select(F.col("_sha").alias("_group"), "_keep")
        same = (F.col("_sha") == F.col("_group")) & F.col("_id").eqNullSafe(F.col("_keep"))
        met = marked.where("_maybe").join(named, same).dropDuplicates(["_sha"])
        return marked.where("not _maybe").select("_row.*").unionByName(met.select("_row.*"))


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """The decision on every document; the row with the largest id of equal texts stays."""
    return Repeats(docs, id, text, max_words).decisions()


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """`docs` without the copies."""
    return Repeats(docs, id, text, max_words).kept(docs)
