"""Figures of a log's columns that slices can be told by, and that add up over slices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRECISION = 12  # of the distinct counts: a standard error of about 1.6 %
QUANTILE_K = 200  # of the quantiles: ranks are within about 1.7 %, at 99 % confidence


def measure(field: T.StructField) -> Column:
    """A value as a number: itself, seconds, 0 or 1, or a text's length."""
    column = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.length(column).cast("double")
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(column) / F.lit(1e6)
    if isinstance(field.dataType, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(field.dataType, T.BooleanType):
        return column.cast("int").cast("double")
    return column.cast("double")


def profile(log: DataFrame, columns: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """A row for each column, and each value of ``by`` if given: ``name``, ``n_rows``, ``n_nulls``, ``low``, ``high``,
    and the sketches ``values`` (for distinct counts) and ``ranks`` (for quantiles).

    One pass; tasks add up their rows before the shuffle, which moves a few KB a column. ``low``, ``high`` and the
    quantiles are of the values as numbers, of a text its length. ``united`` puts profiles of slices together.
    """
    by = by or []
    fields = [f for f in log.schema if f.name not in by and (columns is None or f.name in columns)]

    def figures(field: T.StructField) -> Column:
        number = measure(field)
        known = F.when(~F.isnan(number), number)
        return F.struct(
            F.lit(field.name).alias("name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(field.name).isNull()).alias("n_nulls"),
            F.min(known).alias("low"),
            F.max(known).alias("high"),
            F.hll_sketch_agg(F.col(field.name).cast("string"), PRECISION).alias("values"),
            F.kll_sketch_agg_double(known, QUANTILE_K).alias("ranks"),
        )

    made = log.groupBy(*by).agg(F.array(*map(figures, fields)).alias("each"))
    return made.select(*by, F.inline("each"))


def united(*profiles: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The profile of all slices together, out of their profiles; the slices are not read."""
    rows = reduce(DataFrame.unionByName, profiles)
    return rows.groupBy(*(by or []), "name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("values").alias("values"),
        F.kll_merge_agg_double("ranks").alias("ranks"),
    )


def figures(rows: DataFrame, quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """A profile's figures to read: ``n_distinct``, and ``quantiles`` as an array, null where nothing is known."""
    known = F.col("n_rows") > F.col("n_nulls")
    wanted = F.array(*(F.kll_sketch_get_quantile_double("ranks", F.lit(q)) for q in quantiles))
    return rows.withColumns(
        {"n_distinct": F.hll_sketch_estimate("values"), "quantiles": F.when(known & F.col("low").isNotNull(), wanted)}
    ).drop("values", "ranks")
