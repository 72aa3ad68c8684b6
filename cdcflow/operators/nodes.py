"""Dataflow nodes as functions from DataFrames to DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.functions.conditions import condition
from cdcflow.operators.joins import equi_join, lookup_join  # noqa: F401  (equi_join is the JOIN node)


def process(df: DataFrame, fn: Callable[[DataFrame], DataFrame], parallelism: int | None = None) -> DataFrame:
    """Apply a frame function; its result comes from at most a given number of tasks if one is set.

    Rows aren't shuffled for it: what the function does ahead of a shuffle of its own, such as partial aggregation, keeps
    all the input's tasks.
    """
    done = df.transform(fn)
    return done.coalesce(parallelism) if parallelism else done


def process_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Custom row code: ``fn`` takes and gives an iterator of pandas frames."""
    return df.mapInPandas(fn, schema)


def two_way_filter(df: DataFrame, test: Mapping | Column) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the test, and the others; null counts as not satisfied."""
    holds = condition(test) if isinstance(test, Mapping) else F.coalesce(test, F.lit(False))
    return df.where(holds), df.where(~holds)


def route_filter(df: DataFrame, test: Mapping | Column, targets: Iterable[Mapping]) -> dict[str, DataFrame]:
    """The frame for each target node, by its ``uuid`` and ``type`` ("true" or "false")."""
    passed, failed = two_way_filter(df, test)
    sides = {"true": passed, "false": failed}
    return {t["uuid"]: sides[t["type"]] for t in targets if t["type"] in sides}


def merge(*frames: DataFrame) -> DataFrame:
    """Union of all rows by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def flat_map(df: DataFrame, many: Column, out: str = "value", position: str | None = None) -> DataFrame:
    """One row per element of an array column."""
    if position:
        return df.select("*", F.posexplode(many).alias(position, out))
    return df.select("*", F.explode(many).alias(out))


def sort(df: DataFrame, keys: list[str], descending: Iterable[str] = (), tie_break: list[str] | None = None) -> DataFrame:
    """Total order by keys, nulls first.

    Ties follow the other columns, which also lets the range partitioning cut through a key that
    many rows share.
    """
    down = set(descending)
    rest = tie_break if tie_break is not None else [c for c in df.columns if c not in keys]
    by = [F.desc_nulls_last(k) if k in down else F.asc_nulls_first(k) for k in keys]
    return df.orderBy(*by, *[F.asc_nulls_first(c) for c in rest])


def aggregate(df: DataFrame, by: list[str], **aggs: Column) -> DataFrame:
    """Aggregates by keys, or over everything when there are none."""
    named = [c.alias(n) for n, c in aggs.items()]
    return df.groupBy(*by).agg(*named) if by else df.agg(*named)


def route(df: DataFrame, rules: list[tuple[Column, str]], default: str | None = None) -> DataFrame:
    """Label each row with the route of the first rule it meets."""
    first, *others = rules
    chain = reduce(lambda c, rule: c.when(*rule), others, F.when(*first))
    return df.withColumn("_route_path", chain.otherwise(F.lit(default)))


def flat_map_with(df: DataFrame, table_function: Callable, *columns: str) -> DataFrame:
    """Rows of a table function for each input row, for custom code; ``columns`` are its arguments."""
    return df.lateralJoin(table_function(*[F.col(c).outer() for c in columns]))


def dynamic_filter(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in another frame."""
    return lookup_join(df, keys.select(*on), on, "left_semi")


def dynamic_filter_stream(
    rows: DataFrame, keys: DataFrame, on: list[str], time: str, key_time: str, before: str = "0 seconds", after: str = "0 seconds", delay: str = "0 seconds"
) -> DataFrame:
    """The same for two streams: rows of one whose key the other has between ``before`` and ``after`` their own time.

    A row goes out once, as soon as a key meets it, whichever came first. Both sides are kept as state until the watermark
    (the slower stream's newest time less ``delay``) rules a match out; a row without one is then dropped without a trace, and
    rows and keys that come later than ``delay`` behind are ignored. Null keys and times meet nothing.
    """
    named = keys.select(*[F.col(k).alias(f"_key_{k}") for k in on], F.col(key_time).alias("_key_time")).withWatermark("_key_time", delay)
    equal = [F.col(k) == F.col(f"_key_{k}") for k in on]
    near = (F.col("_key_time") >= F.col(time) - F.expr(f"interval {before}")) & (F.col("_key_time") <= F.col(time) + F.expr(f"interval {after}"))
    return rows.withWatermark(time, delay).join(named, reduce(lambda a, b: a & b, [*equal, near]), "left_semi")


def data_quality(df: DataFrame, rules: Mapping[str, Column], by: list[str] | None = None) -> DataFrame:
    """Rows that pass and fail each rule, counted in one pass; null fails."""
    counts = []
    for name, rule in rules.items():
        passed = F.count_if(rule)
        counts += [passed.alias(f"{name}_pass"), (F.count(F.lit(1)) - passed).alias(f"{name}_fail")]
    wide = df.groupBy(*by).agg(*counts) if by else df.agg(*counts)
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("rule"), F.col(f"{n}_pass").alias("passed"), F.col(f"{n}_fail").alias("failed"))
                for n in rules
            ]
        )
    ).alias("_r")
    return wide.select(*(by or []), rows).select(*(by or []), "_r.*")


def observe_quality(df: DataFrame, name: str, rules: Mapping[str, Column]) -> DataFrame:
    """The same counts as metrics of a running query or stream, next to its rows."""
    return df.observe(
        name, F.count(F.lit(1)).alias("rows"), *[F.count_if(rule).alias(n) for n, rule in rules.items()]
    )
