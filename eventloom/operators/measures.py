"""Summaries and business measures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.numbers import safe_ratio
from eventloom.functions.text import WHITESPACE
from eventloom.operators.skew import attach_groups, attach_per_key
from eventloom.session import cut_lineage


def summarize(events: DataFrame, by: list[str], user: str = "user_id", time: str | None = None) -> DataFrame:
    """Events and distinct users per group, with first and last time when ``time`` is named."""
    aggregates = [F.count("*").alias("event_count"), F.count_distinct(user).alias("unique_users")]
    if time:
        aggregates += [F.min(time).alias("first_event_time"), F.max(time).alias("last_event_time")]
    return events.groupBy(*by).agg(*aggregates).orderBy(*by)


def count_by(events: DataFrame, by: list[str], name: str = "event_count") -> DataFrame:
    return events.groupBy(*by).agg(F.count("*").alias(name)).orderBy(*by)


def json_summary(events: DataFrame, by: str = "event_type") -> DataFrame:
    """One row of JSON: total events and events per type, types in order."""
    counts = events.groupBy(by).agg(F.count("*").alias("n"))
    pairs = F.map_from_entries(F.sort_array(F.collect_list(F.struct(by, "n"))))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_events"), pairs.alias("events_by_type")).select(
        F.to_json(F.struct("total_events", "events_by_type")).alias("value")
    )


def word_count(texts: DataFrame, text: str = "text") -> DataFrame:
    """Words and their counts, in word order; counted inside each task before the shuffle."""
    pieces = F.split(F.lower(text), f"{WHITESPACE}+")
    exploded = texts.select(F.explode(pieces).alias("word")).where("word <> ''")
    return exploded.groupBy("word").agg(F.count("*").alias("n")).orderBy("word")


def count_items(lists: DataFrame, items: str) -> DataFrame:
    """Items of an array column and their counts."""
    return lists.select(F.explode(items).alias("item")).groupBy("item").agg(F.count("*").alias("n"))


def values_per_key(rows: DataFrame, key: str, value: str, sequence: str, size: int = 1000) -> DataFrame:
    """All values of each key in ``sequence`` order: ``piece`` 0 .. ``n_pieces`` - 1, each of ``size`` values (the last: the rest).

    ``sequence`` is a unique whole number. A row's place in its key is the number of rows in earlier ranges of the
    sequence plus its place inside its own range, so no window ever holds more than one range of a heavy key.
    """
    span = 1000 * size
    ranged = rows.select(key, value, sequence, F.expr(f"{sequence} div {span}").alias("_range"))
    counts = ranged.groupBy(key, "_range").agg(F.count("*").alias("_n"))
    along = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(key).alias("_key"), F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(key)).alias("_all"),
    )
    inside = F.row_number().over(Window.partitionBy(key, "_range").orderBy(sequence)) - 1
    placed = ranged.withColumn("_inside", inside).join(offsets, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_r")))
    piece = F.expr(f"(_before + _inside) div {size}").alias("piece")
    n_pieces = F.expr(f"(_all + {size - 1}) div {size}").alias("n_pieces")
    pairs = F.sort_array(F.collect_list(F.struct(sequence, value)))
    return placed.groupBy(key, piece, n_pieces).agg(F.transform(pairs, lambda p: p[value]).alias("values"))


@dataclass(frozen=True)
class Step:
    """One step of ``sum_through``: rows meet ``lookup`` where ``key`` equals its ``match``, and ``attributes`` take the key's place."""

    key: str
    lookup: DataFrame
    match: str
    attributes: tuple[str, ...]
    how: str = "left"


def value_counts(rows: DataFrame, value: str, by: list[str], weight: str = "n") -> DataFrame:
    """by, value, weight: how often each value occurs in its group (nulls left out), stored once for several figures."""
    return cut_lineage(rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias(weight)))


def weighted_moments(counts: DataFrame, value: str, by: list[str], weight: str = "n") -> DataFrame:
    """by, mean, sd_pop, sd_samp of counted values. Squares are taken of the distance from the mean, so nothing cancels."""
    number, n = F.col(value).cast("double"), F.col(weight)
    means = counts.groupBy(*by).agg(F.sum(n).alias("_n"), (F.sum(number * n) / F.sum(n)).alias("mean"))
    apart = attach_groups(counts, means, by, "_n", ["_n", "mean"])
    squares = F.sum((number - F.col("mean")) ** 2 * n)
    return apart.groupBy(*by).agg(
        F.first("mean").alias("mean"), F.sqrt(squares / F.first("_n")).alias("sd_pop"),
        F.sqrt(F.try_divide(squares, F.first("_n") - 1)).alias("sd_samp"),
    )


def sum_through(fact: DataFrame, sums: dict[str, Column], steps: list[Step], by: tuple[str, ...] = ()) -> DataFrame:
    """Sums of a fact by attributes that lie behind foreign keys, grouped before and after each join.

    The fact itself is moved once, by the key of the first step; each later join meets one row for each combination of
    the keys and attributes still needed. A key may be an attribute of an earlier step. A lookup has one row for each key.
    """
    later = [{s.key for s in steps[i + 1 :]} for i in range(len(steps))]
    groups = [c for c in dict.fromkeys([*by, *[s.key for s in steps]]) if c in fact.columns]
    rows = fact.select(*groups, *[c.alias(n) for n, c in sums.items()])
    totals = [F.sum(n).alias(n) for n in sums]
    if groups == [steps[0].key]:
        rows = rows.groupBy(*groups).agg(*totals)
    for step, needed in zip(steps, later, strict=True):
        side = step.lookup.select(F.col(step.match).alias("_match"), *step.attributes)
        groups = [*[c for c in groups if c != step.key or c in needed], *step.attributes]
        rows = rows.join(side, rows[step.key] == side["_match"], step.how).groupBy(*groups).agg(*totals)
    return rows


def pct_of_total(aggregated: DataFrame, measure: str, kept: list[str], name: str = "pct") -> DataFrame:
    """Share of an aggregated measure in the total over all groups with the same ``kept`` keys."""
    total = F.sum(measure).over(Window.partitionBy(*kept))
    return aggregated.withColumn(name, F.round(safe_ratio(F.col(measure), total), 6))


def year_over_year(aggregated: DataFrame, measure: str, year: str, period: list[str]) -> DataFrame:
    """This year's measure beside last year's for the same period, with change and percent; reads the aggregate once."""
    before = F.lag(F.struct(year, measure)).over(Window.partitionBy(*period).orderBy(year))
    rows = aggregated.withColumn("_before", before).withColumn(
        "previous_year", F.when(F.col(f"_before.{year}") == F.col(year) - 1, F.col(f"_before.{measure}"))
    )
    change = F.col(measure) - F.col("previous_year")
    return rows.select(
        year, *period, measure, "previous_year", change.alias("yoy_change"),
        F.round(safe_ratio(change, F.col("previous_year")), 6).alias("yoy_pct"),
    )


def z_scores(rows: DataFrame, value: str, peers: list[str], threshold: float = 3.0) -> DataFrame:
    """Each row's distance from the mean of its peer group in standard deviations, flagged beyond the threshold."""
    stats = rows.groupBy(*peers).agg(
        F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd"), F.count("*").alias("_n")
    )
    joined = attach_groups(rows, stats, peers, "_n", ["_mean", "_sd"])
    z = safe_ratio(F.col(value) - F.col("_mean"), F.col("_sd"))
    return joined.withColumn("z", z).withColumn("is_outlier", F.abs("z") > threshold).drop("_mean", "_sd")


def funnel(events: DataFrame, steps: list[str], user: str, kind: str, time: str) -> DataFrame:
    """Users who did the steps in order: one row per step with users and conversion from the step before.

    A step counts when it happens at or after the user's first time at the step before. One stored row per user carries
    the first times from step to step, so the plan grows by the same amount with each step, and one aggregate counts.
    """
    state = cut_lineage(events.where(F.col(kind) == steps[0]).groupBy(user).agg(F.min(time).alias("_at_1")))
    for number, step in enumerate(steps[1:], start=2):
        now = events.where(F.col(kind) == step).select(user, F.col(time).alias("_t"))
        weight = now.groupBy(user).agg(F.count("*").alias("_n"))
        before = state.where(F.col(f"_at_{number - 1}").isNotNull()).select(user, F.col(f"_at_{number - 1}").alias("_before")).join(weight, user)
        reached = attach_per_key(now, before, [user], "_n", ["_before"]).where(F.col("_t") >= F.col("_before"))
        reached = reached.groupBy(user).agg(F.min("_t").alias(f"_at_{number}"))
        state = cut_lineage(state.join(reached, user, "left"))
    counts = state.agg(*[F.count(f"_at_{n}").alias(f"_{n}") for n in range(1, len(steps) + 1)])
    rows = [
        F.struct(
            F.lit(n).alias("step_no"), F.lit(step).alias("step"), F.col(f"_{n}").alias("users"),
            F.round(safe_ratio(F.col(f"_{n}"), F.col(f"_{n - 1}")), 6).alias("conversion") if n > 1 else F.lit(None).cast("double").alias("conversion"),
        )
        for n, step in enumerate(steps, start=1)
    ]
    return counts.select(F.inline(F.array(*rows)))


def retention(events: DataFrame, user: str, time: str, unit: str = "week") -> DataFrame:
    """Distinct active users by first period (cohort) and number of periods since."""
    days = {"day": 1, "week": 7}[unit]
    active = events.select(user, F.to_date(F.date_trunc(unit, time)).alias("_period")).distinct()
    first = active.groupBy(user).agg(F.min("_period").alias("cohort"))
    offset = F.expr(f"datediff(_period, cohort) div {days}").alias("period_offset")
    return (
        active.join(first, user)
        .groupBy("cohort", offset)
        .agg(F.count("*").alias("active_users"))
    )


def count_sources(rows: DataFrame, requested: list[str], allowed: set[str], source: str = "source") -> DataFrame:
    """Rows per chosen source and over all of them; a chosen source without rows counts 0.

    The request is a frame like any other: repeated names fall together, and a name without a partner in the
    allow-list stops the query with its name in the message.
    """
    spark = rows.sparkSession
    names = spark.createDataFrame([(s,) for s in requested], f"{source} string").distinct()
    listed = spark.createDataFrame([(s, True) for s in sorted(allowed)], f"{source} string, _listed boolean")
    refuse = F.raise_error(F.concat(F.lit("no such source in the allow-list: "), F.col(source)))
    wanted = names.join(listed, source, "left").select(F.when(F.col("_listed"), F.col(source)).otherwise(refuse).alias(source))
    counts = rows.join(F.broadcast(wanted), source).groupBy(source).agg(F.count("*").alias("event_count"))
    filled = wanted.join(counts, source, "left").select(source, F.coalesce("event_count", F.lit(0)).alias("event_count"))
    every = Window.partitionBy()  # one row for each requested name
    return filled.withColumn("total_events", F.sum("event_count").over(every)).withColumn("source_count", F.count("*").over(every).cast("int"))


def mastery(rows: DataFrame, topic: str, correct: Column) -> DataFrame:
    """Whole percent of correct attempts per topic, halves rounded up."""
    attempts = F.count("*")
    return rows.groupBy(topic).agg(
        attempts.alias("attempts"),
        F.count_if(correct).alias("correct"),
        F.floor(safe_ratio(F.count_if(correct) * 100, attempts) + 0.5).alias("pct"),
    )


def review_queue(
    progress: DataFrame, item: str, n: int = 8, min_confidence: float = 2.4
) -> DataFrame:
    """Items with a miss or low mean confidence, most missed first; needs attempts, wrong, confidence_total."""
    mean = F.col("confidence_total") / F.greatest("attempts", F.lit(1))
    return progress.where((F.col("wrong") > 0) | (mean < min_confidence)).orderBy(F.desc("wrong"), item).limit(n)


def kpis(fact: DataFrame, entity: str, kind: str, key_event: str, metric: Column) -> DataFrame:
    """Headline figures in one pass: totals, distinct entities, key events, their rates, and a payload metric."""
    key = F.count_if(F.col(kind) == key_event)
    total = F.count("*")
    return fact.agg(
        total.alias("total_events"),
        F.count_distinct(entity).alias("distinct_entities"),
        key.alias("key_event_count"),
        F.round(safe_ratio(key, total), 6).alias("event_rate"),
        F.round(safe_ratio(key, F.count_distinct(entity)), 6).alias("key_events_per_entity"),
        F.sum(metric).cast("double").alias("domain_metric"),
    )
