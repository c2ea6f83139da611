"""Spelling variants: words that differ by one edit, and the commoner form that a rare word is a variant of.

Blocked Gram matrices. A word's letter counts are a vector; one replaced letter moves it by a squared distance of two,
one inserted or deleted letter by one. Words stand in blocks by length, and NumPy products of neighbouring blocks of
count vectors give all squared distances at once; pairs at most two apart are kept and their edit is verified.

So that blocks stay small however many words there are, letters are dealt into four classes: one edit touches two of them
at most, so two near words have equal counts in two classes at least. Words meet only where they share the letters of
two classes and are of the same or neighbouring length; larger blocks are cut into pieces that meet pairwise. Both rules
are exact: no pair is lost, and a pair that meets several times is kept once.

Handling: null and empty texts have no words; repeated rows count each; a row without id changes no letter; very long
texts are read run by run. Ties of the commonest form go to the smallest word in code-point order. Extra columns are
ignored. An empty table has no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crivo.llm.base import LOWER, UPPER, col, cut, ship, text_of

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_TIMES, RATIO = 5, 3, 2
DROPPED = 97  # one run in so many loses a letter
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
# Letter classes of about the same share of running text, and pairs of classes.
CLASSES = tuple("".join(c for c in LETTERS if c in part or (c > "z" and ord(c) % 4 == i))
                for i, part in enumerate(("ehdumzq", "tianb", "osrlvj", "cgfpwykx")))
PAIRS = tuple(combinations(range(len(CLASSES)), 2))
BLOCK = 2048  # words of one piece of a block
PIECE = 1_000_000  # characters of a text whose runs are listed at once
FLUSH = 200_000  # distinct words that a task counts before it passes them on
_LOWER = str.maketrans(UPPER, LOWER)
_CLASS_OF = {c: i for i, part in enumerate(CLASSES) for c in part}
_INDEX = np.full(0x100, -1, np.int64)
_INDEX[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))
_COLUMN_CLASSES = np.eye(len(CLASSES))[[_CLASS_OF[c] for c in LETTERS]]
_BITS = 1 << np.arange(len(CLASSES))
# The first pair of classes without a touched one, by the bits of the touched classes; two are touched at most.
_FIRST_PAIR = np.array([next((k for k, p in enumerate(PAIRS) if not any(t >> c & 1 for c in p)), -1) for t in range(1 << len(CLASSES))])


def _written(low: str, start: int) -> str:
    """A lowered run as it counts: one letter gone where the checksum of row and run says so. `start` is that of the row."""
    h = zlib.crc32(low.encode(), start)
    if h % DROPPED:
        return low
    at = h % len(low)
    return low[:at] + low[at + 1 :]


def _found(text: str) -> Counter[str]:
    return Counter(RUN.findall(text) if len(text) < PIECE else (m.group() for m in RUN.finditer(text)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def passed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())}, pa.schema([("word", pa.string()), ("n", pa.int64())]))
        counts.clear()
        return out

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            start = None if key is None else zlib.crc32(f"{key}:".encode())
            for run, n in _found(text).items():
                if len(run) >= LEAST_LENGTH:
                    word = run.lower() if run.isascii() else run.translate(_LOWER)
                    if start is not None:
                        word = _written(word, start)
                    if len(word) >= LEAST_LENGTH:
                        counts[word] += n
            if len(counts) > FLUSH:
                yield passed()
    yield passed()


def vocabulary(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words long and frequent enough. Tasks count before words are shuffled."""
    ship(docs.sparkSession)
    runs = docs.select(col(id).alias("id"), text_of(text).alias("text")).mapInArrow(_counted, "word string, n bigint")
    return runs.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TIMES)


def letters_of(word: str, pair: tuple[int, int]) -> str:
    """A word's letters of two classes, in order: equal for words with the same counts of them."""
    return "".join(sorted(c for c in word if _CLASS_OF[c] in pair))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word once for every pair of classes and for both lengths it may meet: its own and the next smaller one."""
    schema = pa.schema([("pair", pa.int32()), ("letters", pa.string()), ("length", pa.int64()), ("longer", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])
    for batch in batches:
        rows = []
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for i, pair in enumerate(PAIRS):
                letters = letters_of(word, pair)
                rows.append((i, letters, len(word), False, word, n))
                rows.append((i, letters, len(word) - 1, True, word, n))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema) if rows else pa.RecordBatch.from_pylist([], schema)


def counts_of(words: list[str]) -> np.ndarray:
    """A row of letter counts for each word."""
    out = np.zeros((len(words), len(LETTERS)))
    lengths = [len(w) for w in words]
    letters = _INDEX[np.frombuffer("".join(words).encode("latin-1"), np.uint8)]
    np.add.at(out, (np.repeat(np.arange(len(words)), lengths), letters), 1.0)
    return out


def _letters(words: list[str]) -> np.ndarray:
    """A row of code points for each of some words of one length."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row, whether one replaced letter makes `a` into `b` or, with longer rows in `b`, one inserted letter."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    front = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return front + back >= a.shape[1]


def near_pairs(low: list[str], high: list[str], pair: int, same: bool) -> Iterator[tuple[int, int]]:
    """Places (in `low`, in `high`) of near words, from the squared distances of their counts. `same`: both lists are one,
    and a pair counts once. Pairs that meet in several pairs of classes are kept in the first."""
    if not low or not high or (same and len(low) == 1):
        return
    a, b = counts_of(low), counts_of(high)
    letters_a, letters_b = _letters(low), _letters(high)
    norms = (b * b).sum(1)
    step = max(1, 8_000_000 // letters_b.shape[1])
    for start in range(0, len(low), BLOCK):
        part = a[start : start + BLOCK]
        apart = (part * part).sum(1)[:, None] + norms[None, :] - 2 * (part @ b.T)
        i, j = np.nonzero((apart <= 2) & (apart > 0))
        i += start
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), step):
            x, y = i[k : k + step], j[k : k + step]
            touched = ((a[x] != b[y]) @ _COLUMN_CLASSES) > 0
            mine = _FIRST_PAIR[touched @ _BITS] == pair
            x, y = x[mine], y[mine]
            edit = one_edit(letters_a[x], letters_b[y])
            yield from zip(x[edit].tolist(), y[edit].tolist())


UNIT = ["pair", "length", "letters", "left", "right"]


def _met(bucket: pd.DataFrame) -> pd.DataFrame:
    """Near words of all units of a bucket, in both directions. A unit holds one block, or two pieces of a large one."""
    rows: list[tuple] = []
    bucket = bucket.sort_values(UNIT)
    fresh = (bucket[UNIT] != bucket[UNIT].shift()).any(axis=1).to_numpy()
    starts = [*np.flatnonzero(fresh).tolist(), len(bucket)]
    words, times, longer, piece = (bucket[c].tolist() for c in ("word", "n", "longer", "piece"))
    pairs, lefts, rights = (bucket[c].tolist() for c in ("pair", "left", "right"))
    for begin, end in zip(starts, starts[1:]):
        if end - begin == 1:
            continue

        def part(wanted: int, long: bool) -> list[int]:
            return [p for p in range(begin, end) if longer[p] == long and piece[p] == wanted]

        left, right = lefts[begin], rights[begin]
        if left == right:
            meetings = [(part(left, False), part(left, False), True), (part(left, False), part(left, True), False)]
        else:
            meetings = [(part(left, False), part(right, long), False) for long in (False, True)]
            meetings.append((part(right, False), part(left, True), False))
        for low, high, same in meetings:
            for i, j in near_pairs([words[p] for p in low], [words[p] for p in high], pairs[begin], same):
                x, y = low[i], high[j]
                rows += [(words[x], words[y], times[y]), (words[y], words[x], times[x])]
    return pd.DataFrame(rows, columns=["word", "near", "near_n"])


def near_words(vocab: DataFrame, bucket: int = 100_000) -> DataFrame:
    """(word, near, near_n): all pairs of words one edit apart, in both directions. `bucket`: rows that a task works on."""
    ship(vocab.sparkSession)
    keyed = cut(vocab.select("word", "n").mapInArrow(_keyed, "pair int, letters string, length bigint, longer boolean, word string, n bigint"))
    item = ["pair", "letters", "length"]
    sizes = keyed.groupBy(*item).agg(F.count(F.lit(1)).alias("rows"))
    large = cut(sizes.where(F.col("rows") > BLOCK).withColumn("pieces", F.expr(f"rows div {BLOCK} + 1")).drop("rows"))
    pieces = F.coalesce("pieces", F.lit(1))
    dealt = keyed.join(large, item, "left").withColumns({"pieces": pieces, "piece": F.pmod(F.xxhash64("word"), pieces)})
    # Every piece meets every piece of its block once, itself included.
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)))
    units = other.withColumns({"left": F.least("piece", "other"), "right": F.greatest("piece", "other")}).drop("other", "pieces")
    buckets = max(1, -(-12 * vocab.count() // bucket))
    return units.groupBy(F.pmod(F.xxhash64(*UNIT), F.lit(buckets)).alias("bucket")).applyInPandas(_met, "word string, near string, near_n bigint")


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form (word, form): the end of the chain of forms. Every round doubles the steps
    made; a form is at least twice as frequent as its word, so there are few."""
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        stepped = cut(now.join(ahead, "root", "left"))
        if stepped.where(F.col("_next").isNotNull()).isEmpty():
            return now
        now = stepped.select("word", F.coalesce("_next", "root").alias("root"))


def variants(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word: word, n, n_near (words one edit apart), form (the most frequent of them, if at least twice as
    frequent as the word), form_n, root (the last form of the chain; the word itself without one)."""
    vocab = cut(vocabulary(docs, id, text))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    found = near_words(vocab).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    told = vocab.join(found, "word", "left").withColumn("taken", F.coalesce(form_n >= RATIO * F.col("n"), F.lit(False)))
    named = cut(
        told.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(F.col("taken"), F.col("best.near")).alias("form"), F.when(F.col("taken"), form_n).alias("form_n"),
        )
    )
    roots = roots_of(named.where(F.col("form").isNotNull()))
    return named.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
