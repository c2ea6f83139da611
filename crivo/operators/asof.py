"""As-of joins as one sorted pass per entity.

Observations and questions are put in one sequence per entity and the last observation seen is carried
along, so the cost is a sort and no row is compared with every other. Observations hold one row per entity
and day (see `history.prepared`), so a sequence is as long as the calendar allows, however hot the entity.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crivo.columns import col

_FOUND = "_found"


def _carried(sequence: DataFrame, keys: Sequence[str], forward: bool) -> DataFrame:
    """`_found` of the nearest observation at or after (`forward`) or at or before `_at`."""
    at = F.col("_at").desc() if forward else F.col("_at").asc()
    window = (
        Window.partitionBy(*[col(k) for k in keys])
        .orderBy(at, F.col("_asks").asc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return sequence.withColumn(_FOUND, F.last(_FOUND, ignorenulls=True).over(window))


def asof(
    questions: DataFrame,
    observations: DataFrame,
    keys: Sequence[str],
    at: str,
    date: str,
    value: str,
    forward: bool = False,
    one_per_day: bool = False,
) -> DataFrame:
    """Each question with `found_date` and `found_value` of the observation of the same entity nearest to
    its `at` date: the last one not later or, with `forward`, the first one not earlier.

    Questions may repeat: the distinct (entity, date) pairs are answered and the answers joined back, so
    many questions about one entity on one day never meet in one sequence. `one_per_day` says that they do
    not repeat, which saves that join.
    """
    if not one_per_day:
        pairs = questions.select(*[col(k) for k in keys], col(at)).distinct()
        answers = asof(pairs, observations, keys, at, date, value, forward, one_per_day=True)
        return questions.join(answers, [*keys, at], "left")

    extra = [c for c in questions.columns if c not in keys]
    asked = questions.select(
        *[col(k) for k in keys],
        col(at).alias("_at"),
        F.lit(1).alias("_asks"),
        F.struct(*[col(c) for c in extra]).alias("_row"),
    )
    seen = observations.select(
        *[col(k) for k in keys],
        col(date).alias("_at"),
        F.lit(0).alias("_asks"),
        F.struct(col(date).alias("date"), col(value).alias("value")).alias(_FOUND),
    )
    sequence = asked.unionByName(seen, allowMissingColumns=True)
    answered = _carried(sequence, keys, forward).where(F.col("_asks") == 1)
    return answered.select(
        *[col(k) for k in keys],
        *[F.col("_row")[c].alias(c) for c in extra],
        # A question without a date has no answer, wherever nulls sort.
        F.when(F.col("_at").isNotNull(), F.col(_FOUND)["date"]).alias("found_date"),
        F.when(F.col("_at").isNotNull(), F.col(_FOUND)["value"]).alias("found_value"),
    )


def probes(
    questions: DataFrame,
    observations: DataFrame,
    keys: Sequence[str],
    asks: Mapping[str, tuple[str, bool]],
    date: str,
    value: str,
) -> DataFrame:
    """Each question with `<name>_date` and `<name>_value` for every entry `name: (column, forward)` of `asks`: the nearest
    observation of the same entity not earlier than the column's date (`forward`) or not later.

    All entries, of either direction, are asked in one sequence per entity: one shuffle, and one carry for each direction.
    On a day, questions that look ahead stand before the observation and those that look back stand after it. Questions
    hold one row per entity and dates of `asks`; a null date has no answer.
    """
    at = list(dict.fromkeys(column for column, _ in asks.values()))
    extra = [c for c in questions.columns if c not in keys and c not in at]
    found = F.struct(col(date).alias("date"), col(value).alias("value"))
    entity = [col(k) for k in keys]
    asked = questions.select(
        *entity,
        *[col(c).alias(f"_at{i}") for i, c in enumerate(at)],
        *[col(c).alias(f"_row{i}") for i, c in enumerate(extra)],
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("_name"), F.lit(-1 if ahead else 1).alias("_asks"), col(column).alias("_at"))
                    for i, (column, ahead) in enumerate(asks.values())
                ]
            )
        ).alias("_e"),
    ).select("*", "_e.*").drop("_e")
    seen = observations.select(*entity, F.lit(0).alias("_asks"), col(date).alias("_at"), found.alias(_FOUND))
    sequence = asked.unionByName(seen, allowMissingColumns=True)

    def carried(ahead: bool) -> Column:
        order = [F.col("_at").desc(), F.col("_asks").desc()] if ahead else [F.col("_at").asc(), F.col("_asks").asc()]
        window = Window.partitionBy(*entity).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.last(_FOUND, ignorenulls=True).over(window)

    # Folded column by column: numbers and dates are then added up in a hash table of one row for each question; structs
    # would be sorted once more, with every row of the sequence in memory.
    ways = {ahead for _, ahead in asks.values()}
    for ahead in ways:
        sequence = sequence.withColumn(f"_to{int(ahead)}", carried(ahead))
    folded = (
        sequence.where((F.col("_asks") != 0))
        .groupBy(*entity, *[f"_at{i}" for i in range(len(at))])
        .agg(
            *[F.first(f"_row{i}", ignorenulls=True).alias(f"_row{i}") for i in range(len(extra))],
            *[
                F.max(F.when((F.col("_name") == i) & F.col("_at").isNotNull(), F.col(f"_to{int(ahead)}")[part])).alias(f"_{part}{i}")
                for i, (_, ahead) in enumerate(asks.values())
                for part in ("date", "value")
            ],
        )
    )
    answers = [F.col(f"_{part}{i}").alias(f"{name}_{part}") for i, name in enumerate(asks) for part in ("date", "value")]
    named = {c: F.col(f"_at{i}") for i, c in enumerate(at)}
    return folded.select(
        *[
            (col(c) if c in keys else named[c] if c in named else F.col(f"_row{extra.index(c)}")).alias(c)
            for c in questions.columns
        ],
        *answers,
    )


def forward_returns(
    df: DataFrame, keys: Sequence[str], date: str, price: str, horizons: Sequence[int]
) -> DataFrame:
    """Adds price, date and return of the first observation at least `h` days later, for each horizon.

    All horizons share one shuffle: every row asks one question per horizon, next to its own observation,
    and the answers are folded back onto the row within the same partitioning. A later price of 0, or a
    price of 0 today, gives no return; the next date is not tried.
    """
    payload = [c for c in df.columns if c not in keys and c != date]
    found = F.struct(col(date).alias("date"), col(price).alias("price"))
    no_found = F.lit(None).cast(df.select(found).schema[0].dataType)
    row = F.struct(*[col(c) for c in payload])
    no_row = F.lit(None).cast(df.select(row).schema[0].dataType)
    entries = [
        F.struct(F.lit(0).alias("_asks"), col(date).alias("_at"), found.alias(_FOUND), row.alias("_row"))
    ] + [
        F.struct(
            F.lit(h).alias("_asks"),
            F.date_add(col(date), h).alias("_at"),
            no_found.alias(_FOUND),
            no_row.alias("_row"),
        )
        for h in horizons
    ]
    sequence = df.select(
        *[col(k) for k in keys], col(date), F.explode(F.array(*entries)).alias("_e")
    ).select(*[col(k) for k in keys], col(date), "_e.*")

    folded = (
        _carried(sequence, keys, forward=True)
        .groupBy(*[col(k) for k in keys], col(date))
        .agg(
            F.first("_row", ignorenulls=True).alias("_row"),
            *[F.max(F.when(F.col("_asks") == h, F.col(_FOUND))).alias(f"_f{h}") for h in horizons],
        )
    )
    today = F.col("_row")[price]
    answers: list[Column] = []
    for h in horizons:
        later = F.col(f"_f{h}")
        usable = (later["price"] != 0) & (today != 0)
        answers += [
            F.when(usable, later["price"]).alias(f"Preco_Futuro_{h}d"),
            F.when(usable, later["date"]).alias(f"Data_Futura_{h}d"),
            F.when(usable, F.try_divide(later["price"], today) - 1).alias(f"Retorno_Futuro_{h}d"),
        ]
    return folded.select(
        *[col(k) for k in keys], col(date), *[F.col("_row")[c].alias(c) for c in payload], *answers
    )
