"""Secret scans: patterns find candidates, a random forest removes the false ones.

A candidate is a run of at least `SHORTEST` key characters with a digit, or a value of six characters or more behind a key
that ends in a key word (`password=...`, `"db_password": "..."`). A word may hold several (compact JSON, URL queries, calls).
Only texts that hold one are cut into words; each candidate comes with its two words before and the word after. The forest sees its length, its character transitions (between lower case, upper case, digits and marks)
and character mix, how much of it dictionary words cover, whether it looks like a path or an address, and whether key
words or harmless words stand next to it. It learns from labelled findings: those alike in features and label are one,
weighted by their count, and each label has at most `LEARNED` of these (a documented bound; the ones with the smallest hashes,
so reruns agree; their weights stand for the whole label).

Without labels of one's own, `weak_labels` labels what is beyond doubt: known key formats and mixed hexadecimal values
behind a key word are secrets; plain numbers, addresses, dates, dotted numbers and values mostly made of dictionary words are
not. It abstains on the rest, which the forest then decides.

Null and empty texts have no findings. Without labels of both kinds every finding keeps the share of secrets among the labels
(1 without any), so nothing is hidden. Rows that repeat an id are scanned each by itself. Works in JVM
expressions and Spark's own forest throughout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crivo.llm.base import col, cut, text_of

SHORTEST = 12
LEARNED = 20_000
TREES, DEPTH, SEED = 40, 6, 17

# Words that announce a secret, words that announce a harmless value, words of plain language.
KEY_WORDS = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "auth", "credential", "bearer")
HARMLESS = ("example", "sample", "test", "dummy", "version", "isbn", "issn", "uuid", "commit", "checksum", "md5", "sha1", "sha256", "phone", "card")
DICTIONARY = (
    "the", "and", "ing", "tion", "that", "this", "with", "for", "from", "are", "was", "not", "you", "all", "have", "name", "file",
    "page", "data", "user", "mail", "http", "https", "www", "com", "org", "index", "image", "example", "test", "sample", "key",
    "value", "section", "chapter", "model", "number", "der", "die", "das", "und", "les", "des", "que", "los", "las", "del",
)

_KEYS = "|".join(KEY_WORDS)
_RUN = r"(?<![A-Za-z0-9_+/=.@-])(?=[A-Za-z_+/=.@-]*[0-9])[A-Za-z0-9_+/=.@-]{%d,}" % SHORTEST
_ASSIGNED = rf"(?i:{_KEYS})[\"']?\s*[=:]"
#: Texts without a match hold no candidate.
ANY = f"{_RUN}|{_ASSIGNED}"
_SIGN = r"[\"']?[=:]+>?"
# A key that ends in a key word, and its value: up to the closing quote, or to the next mark or pair.
_NAMED = rf"([A-Za-z0-9_.-]{{0,40}}(?i:{_KEYS})){_SIGN}[\"'(]*"
# The last repetition is possessive: Java runs any other repeated group by recursion, once a character.
_VALUE = r"((?<=\")[^\"\s]{6,}(?=\")|(?<=')[^'\s]{6,}(?=')|(?:[^\"'\s<>(){}\[\],;&]|&(?![A-Za-z0-9_.-]+=)){6,}+)"
_PAIR = _NAMED + _VALUE
# A run, perhaps behind a short key and a sign.
_LONG = r"(?:[A-Za-z_-]{2,24}[\"']?[=:][\"']?)?[A-Za-z0-9_+/=.@-]{%d,}" % SHORTEST
_LONG_PARTS = r"^(?:([A-Za-z_-]{2,24})[\"']?[=:][\"']?)?(.*)$"
# A run whose key has other characters, if what stands behind it is long enough.
_OTHER_PARTS = r"^([A-Za-z0-9_.-]{1,40})=(?=[^=])(?=[A-Za-z_+/=.@-]*[0-9])([A-Za-z0-9_+/=.@-]{%d,})$" % SHORTEST
# What is left of a pair when its value is another word.
_HEAD = rf"[A-Za-z0-9_.-]{{0,40}}(?i:{_KEYS})"

# Two characters that mark where a match begins and ends; words lose them beforehand.
_BEGIN, _END = "\u0001", "\u0002"
_PARTS = "array<struct<text: string, match: string, pair: boolean>>"
_FOUND = "array<struct<place:int,key:string,value:string,before2:string,before:string,after:string>>"

FEATURES = (
    "length", "switches", "digits", "upper", "lower", "marks", "variety", "hexadecimal", "covered", "slashes", "dots", "address",
    "keyed", "near_key", "near_harmless",
)


def findings(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per candidate: id, place (number of its word), key, value, and its neighbours before2, before, after."""
    held = docs.select(col(id).alias("_id"), text_of(text).alias("_text")).where(F.col("_text").rlike(ANY))

    def candidates(words: Column) -> Column:
        def at(i: Column) -> Column:
            return F.coalesce(F.get(words, i), F.lit(""))

        def once(value: Column, build: Callable[[Column], Column]) -> Column:
            return F.flatten(F.transform(F.array(value), build))

        def of_word(w: Column, i: Column) -> Column:
            """All candidates of a word; `head` is the key and sign that end right before it."""
            before, before2 = at(i - 1), at(i - 2)
            ending = F.regexp_extract(before, rf"({_HEAD}{_SIGN}[\"'(]*)$", 1)
            apart = F.regexp_extract(before2, rf"({_HEAD}[\"']?)$", 1)
            bare = F.regexp_extract(before, rf"({_HEAD}[\"']?)$", 1)
            head = (
                F.when(before.rlike(r"[=:]>?[\"'(]*$") & (ending != ""), ending)
                .when(before.rlike(r"^[=:]+>?[\"'(]*$") & (apart != ""), F.concat(apart, before))
                .when(w.rlike("^[=:]") & (bare != ""), bare)
                .otherwise("")
            )
            return once(F.concat(head, w), lambda whole: of_whole(whole, i))

        def of_whole(whole: Column, i: Column) -> Column:
            return once(parted(whole), lambda parts: of_parts(parts, i))

        def marked(text: Column, pattern: str, pair: bool) -> Column:
            """(text, match) of a text's matches, each with the text between it and the one before; the last has no match."""
            ends = F.split(F.regexp_replace(text, f"({pattern})", f"{_BEGIN}$1{_END}"), _END)
            return F.transform(
                ends,
                lambda e: F.struct(
                    F.substring_index(e, _BEGIN, 1).alias("text"),
                    F.when(F.contains(e, F.lit(_BEGIN)), F.substring_index(e, _BEGIN, -1)).alias("match"),
                    F.lit(pair).alias("pair"),
                ),
            )

        def parted(whole: Column) -> Column:
            """A word cut at its matches: pairs first, then runs in what lies between. Every character is in one part."""
            plain = F.translate(whole, _BEGIN + _END, "")

            def with_runs(p: Column) -> Column:
                tail = F.struct(F.lit("").alias("text"), p["match"].alias("match"), F.lit(True).alias("pair"))
                return F.concat(marked(p["text"], _LONG, False), F.when(p["match"].isNotNull(), F.array(tail)).otherwise(F.array().cast(_PARTS)))

            pairs = F.flatten(F.transform(marked(plain, _PAIR, True), with_runs))
            return F.when(plain.rlike(_ASSIGNED), pairs).otherwise(marked(plain, _LONG, False))

        def of_parts(parts: Column, i: Column) -> Column:
            def text_at(j: Column, name: str) -> Column:
                return F.coalesce(F.get(parts, j)[name], F.lit(""))

            def of_part(p: Column, j: Column) -> Column:
                m = p["match"]
                other = F.regexp_extract(m, _OTHER_PARTS, 2)
                named = F.regexp_extract(m, _LONG_PARTS, 1)
                general = (named == "") & (other != "")
                key = F.when(p["pair"], F.regexp_extract(m, _NAMED, 1)).when(general, F.regexp_extract(m, _OTHER_PARTS, 1)).otherwise(named)
                value = (
                    F.when(p["pair"], F.regexp_replace(m, f"^{_NAMED}", "")).when(general, other).otherwise(F.regexp_extract(m, _LONG_PARTS, 2))
                )
                # Neighbours stand in the parts next to this one, so each part is read a few times at most.
                left = tokens(F.concat(*[text_at(j - k, n) for k in (3, 2, 1) for n in ("text", "match")], p["text"]))
                right = tokens(F.concat(*[text_at(j + k, n) for k in (1, 2, 3) for n in ("text", "match")]))
                return F.struct(
                    i.alias("place"),
                    F.lower(key).alias("key"),
                    F.regexp_replace(value, r"[.]+$", "").alias("value"),
                    F.lower(F.coalesce(F.get(left, F.size(left) - 2), at(i - 2 + F.size(left)))).alias("before2"),
                    F.lower(F.coalesce(F.get(left, F.size(left) - 1), at(i - 1))).alias("before"),
                    F.lower(F.coalesce(F.get(right, F.lit(0)), at(i + 1))).alias("after"),
                    p["pair"].alias("pair"),
                )

            every = F.filter(F.transform(parts, lambda p, j: F.when(p["match"].isNotNull(), of_part(p, j))), lambda c: c.isNotNull())
            good = F.filter(every, lambda c: (F.length(c["value"]) >= 6) & (c["pair"] | (c["value"].rlike(run) & c["value"].rlike("[0-9]"))))
            # Pairs first, as they are found.
            both = F.concat(F.filter(good, lambda c: c["pair"]), F.filter(good, lambda c: ~c["pair"]))
            return F.transform(both, lambda c: F.struct(*[c[n].alias(n) for n in ("place", "key", "value", "before2", "before", "after")]))

        def tokens(part: Column) -> Column:
            return F.filter(F.split(part, r"[^A-Za-z0-9_.@+/-]+"), lambda t: t != "")

        run = r"^[A-Za-z0-9_+/=.@-]{%d,}$" % SHORTEST
        return F.flatten(F.transform(words, lambda w, i: F.when(F.length(w) >= 6, of_word(w, i)).otherwise(F.array().cast(_FOUND))))

    words = F.filter(F.split("_text", r"\s+"), lambda w: w != "")
    each = F.flatten(F.transform(F.array(words), candidates))
    return held.select(F.col("_id").alias(id), F.explode(each).alias("c")).select(col(id), "c.*")


def described(found: DataFrame) -> DataFrame:
    """Adds the forest's features."""
    value, size = F.col("value"), F.greatest(F.length("value"), F.lit(1)).cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / size

    switches = r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^a-zA-Z0-9])(?=[a-zA-Z0-9])"
    uncovered = F.length(F.regexp_replace(F.lower(value), "|".join(DICTIONARY), "")) / size
    around = F.concat_ws(" ", "before2", "before", "key")
    columns = {
        "length": F.log1p(F.length(value)).cast("double"),
        "switches": share(switches),
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "lower": share("[a-z]"),
        "marks": share("[^A-Za-z0-9]"),
        "variety": F.size(F.array_distinct(F.split(value, ""))) / F.sqrt(size),
        "hexadecimal": value.rlike("^[0-9a-f]+$|^[0-9A-F]+$").cast("double"),
        "covered": 1.0 - uncovered,
        "slashes": share("/"),
        "dots": share("[.]"),
        "address": value.rlike("@|://|^www[.]").cast("double"),
        "keyed": F.col("key").rlike(_KEYS).cast("double"),
        "near_key": around.rlike(_KEYS).cast("double"),
        "near_harmless": F.concat_ws(" ", around, "after").rlike("|".join(HARMLESS)).cast("double"),
    }
    return found.withColumns(columns)


def weak_labels(rows: DataFrame, out: str = "label") -> DataFrame:
    """Adds 1 (secret), 0 (none) or null (undecided) to described findings, from fixed rules."""
    value = F.col("value")
    known = value.rlike("^AKIA[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-|^sk-[A-Za-z0-9]{20,}$|^eyJ[A-Za-z0-9_-]{10,}[.]")
    mixed = (F.col("digits") > 0.1) & (F.col("digits") < 0.9) & (F.col("hexadecimal") == 1) & (F.length(value) >= 16)
    announced = (F.col("near_key") == 1) & (F.col("near_harmless") == 0)
    plain = value.rlike("^[0-9.:/+-]+$") | (F.col("address") == 1) | ((F.col("covered") > 0.5) & (F.col("near_key") == 0))
    return rows.withColumn(out, F.when(known | (mixed & announced), 1.0).when(plain, 0.0))


Scorer = Callable[[DataFrame], DataFrame]


def fit(labelled: DataFrame, label: str = "label") -> Scorer:
    """Learns from described findings with a label of 0 or 1; adds the column `probability` to others."""
    known = labelled.where(col(label).isin(0, 1)).select(*FEATURES, col(label).cast("double").alias("label"))
    distinct = cut(known.groupBy(*FEATURES, "label").agg(F.count(F.lit(1)).cast("double").alias("weight")))
    totals = {r["label"]: r["weight"] for r in distinct.groupBy("label").agg(F.sum("weight").alias("weight")).collect()}
    if len(totals) < 2:
        share = F.lit(max(totals, default=1.0))
        return lambda rows: rows.withColumn("probability", share)

    def smallest(label: float) -> DataFrame:
        return distinct.where(F.col("label") == label).orderBy(F.xxhash64(*FEATURES), *FEATURES).limit(LEARNED)

    drawn = cut(smallest(0.0).unionByName(smallest(1.0)))
    held = {r["label"]: r["weight"] for r in drawn.groupBy("label").agg(F.sum("weight").alias("weight")).collect()}
    # What the bound leaves out counts with the rest of its class.
    scale = F.when(F.col("label") == 1, totals[1.0] / held[1.0]).otherwise(totals[0.0] / held[0.0])
    sample = drawn.withColumn("weight", F.col("weight") * scale)
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="_vector")
    forest = RandomForestClassifier(
        featuresCol="_vector", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
        rawPredictionCol="_raw", probabilityCol="_both", predictionCol="_predicted",
    )
    # One partition, in order: the forest's bootstrap hangs on the placing of rows.
    model = forest.fit(vector.transform(sample.repartition(1).sortWithinPartitions(*FEATURES, "label")))

    def score(rows: DataFrame) -> DataFrame:
        scored = model.transform(vector.transform(rows))
        return scored.withColumn("probability", F.element_at(vector_to_array("_both"), 2)).drop("_vector", "_raw", "_both", "_predicted")

    return score


def scan(
    docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per candidate: id, place, key, shown (its first four characters), value_sha256, n_chars, probability, secret.

    `labelled` holds findings (the columns of `findings` and a label); without it the weak labels of this corpus serve.
    """
    rows = cut(described(findings(docs, id, text)))
    known = weak_labels(rows) if labelled is None else described(labelled)
    scored = fit(known)(rows)
    return scored.select(
        col(id),
        "place",
        "key",
        F.substring("value", 1, 4).alias("shown"),
        F.sha2("value", 256).alias("value_sha256"),
        F.length("value").cast("bigint").alias("n_chars"),
        F.round("probability", 9).alias("probability"),
        (F.col("probability") >= threshold).alias("secret"),
    )
