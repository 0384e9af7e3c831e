"""A table's versions, kept and extended slice by slice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.operators.changelog import AFTER_OPS, DELETE_OP
from rowtide.operators.intervals import SLOT, at_position, at_time, dated, live, placed, versions
from rowtide.operators.state import TRUNCATE_OP
from rowtide.specs import TableSpec
from rowtide.streaming.maintained import NO_KEY, Numbered


class History:
    """The versions of a table (``versions``), kept below a folder by buckets of the key.

    ``apply`` takes the slice of the log that came since, under a number that rises from 0. It reads the
    versions of the slice's keys and writes those that are new or end otherwise than before; of a slice
    with a truncate it reads all. Slices may overlap and bring older changes, and may be applied again
    under their number. After ``fold`` the table at any time is a filter of one stored table.
    """

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec, *, buckets: int = 256, slot: int = SLOT) -> None:
        self.spark, self.spec, self.slot = spark, spec, slot
        empty = spark.createDataFrame([], spec.log_type().add("lsn", T.LongType()))
        fields = versions(empty, spec).schema
        keys = spec.key_columns
        self.rows = Numbered(spark, f"{path}/versions", fields, [*keys, "valid_from"], buckets, bucket_by=keys)

    def apply(self, number: int, log: DataFrame) -> None:
        """Takes in a slice of the log, with ``lsn``."""
        spec, before = self.spec, number - 1
        keys = [F.coalesce(F.col(f"pk_{k}"), F.col(k)) for k in spec.key]
        said = log.filter(F.col("op").isin(*AFTER_OPS, DELETE_OP, TRUNCATE_OP))
        buckets = None
        if said.filter(F.col("op") == TRUNCATE_OP).isEmpty():
            buckets = self.rows.touched(keys, said)
            # Truncates end what comes late, too.
            buckets = buckets and [*buckets, NO_KEY]
        # All forms of a version with the batch that wrote it: the last one counts, and has the ends that are
        # compared with. Versions of other keys in these buckets end as before and are not written.
        ends, cut = ["valid_to", "to_ts"], F.col(spec.key_columns[0]).isNull()
        earlier = self.rows.read(before, buckets).drop("bucket").withColumn("cut", cut)
        earlier = earlier.withColumnsRenamed({e: f"was_{e}" for e in ends})
        both = earlier.unionByName(placed(said, spec).withColumn("batch_id", F.lit(-1).cast("long")), allowMissingColumns=True)
        now = dated(both, spec.key_columns, slot=self.slot, prefer="batch_id")
        same = F.col("batch_id") >= 0
        for end in ends:
            same = same & F.col(end).eqNullSafe(F.col(f"was_{end}"))
        self.rows.write(now.filter(~same), number)

    def versions(self) -> DataFrame:
        """All versions, deletes and truncates included."""
        upto = max(self.rows.batches(), default=-1)
        folds = self.rows.folds()
        if folds and max(folds) >= upto:
            return self.rows.read(upto).drop("batch_id", "bucket")
        return self.rows.latest(upto).drop("batch_id")

    def live(self) -> DataFrame:
        return live(self.versions(), self.spec)

    def at_time(self, at: Column) -> DataFrame:
        return at_time(self.versions(), self.spec, at)

    def at_position(self, position: Column) -> DataFrame:
        return at_position(self.versions(), self.spec, position)

    def fold(self) -> None:
        """Writes the last form of each version as one table."""
        if (upto := max(self.rows.batches(), default=-1)) >= 0:
            self.rows.fold(upto)
