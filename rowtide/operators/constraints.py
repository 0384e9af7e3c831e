"""Rows that break the constraints a source table declares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.specs import TableSpec


def repeated_keys(table: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that stand more than once, with their counts. Nulls never collide."""
    return (
        table.dropna(subset=columns)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def pk_violations(table: DataFrame, spec: TableSpec) -> DataFrame:
    return repeated_keys(table, list(spec.key))


def unique_violations(table: DataFrame, spec: TableSpec) -> DataFrame:
    """Repeated values of every unique column beside the key.

    The table is read once; all unique columns share one shuffle.
    """
    columns = [f.name for f in spec.fields if f.unique and f.name not in spec.key]
    if not columns:
        raise ValueError(f"{spec.name!r} declares no unique column beside its key")
    pairs = F.explode(
        F.array(
            *(
                F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                for c in columns
            )
        )
    )
    values = table.select(pairs.alias("p")).select("p.column", "p.value")
    return (
        values.dropna(subset=["value"])
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def null_violations(table: DataFrame, spec: TableSpec) -> DataFrame:
    """Key and name of every column that is null but must not be. One scan, no shuffle."""
    required = [f.name for f in spec.fields if f.not_null]
    missing = F.filter(
        F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in required)),
        lambda name: name.isNotNull(),
    )
    return table.select(*spec.key, F.explode(missing).alias("column"))


def precision_violations(
    table: DataFrame, column: str, precision: int = 10, scale: int = 2
) -> DataFrame:
    """Rows whose value ``NUMERIC(precision, scale)`` would not take as it is, with
    ``violation``: ``overflow`` where the source refuses it, ``rounded`` where it rounds it."""
    fitted = F.col(column).try_cast(f"decimal({precision},{scale})")
    kind = table.schema[column].dataType
    violation = (
        F.when(F.col(column).isNull(), None)
        .when(fitted.isNull(), "overflow")
        .when(fitted.cast(kind) != F.col(column), "rounded")
    )
    return table.withColumn("violation", violation).filter(F.col("violation").isNotNull())
