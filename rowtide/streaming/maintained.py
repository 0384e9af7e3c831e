"""Answers that are kept up to date slice by slice, and not computed anew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rowtide.operators.changelog import decode
from rowtide.operators.deltas import count_change, join_changes, net_changes, signed
from rowtide.operators.state import TRUNCATE_OP, last_changes
from rowtide.sources.records import of_table
from rowtide.specs import TableSpec
from rowtide.streaming.state import write_batches

NO_KEY = -1  # the bucket of truncates


class Numbered:
    """Rows kept by the number of their batch and a bucket of their key, a folder for each.

    A batch that is written again replaces its earlier attempt. The last row of a key is the one of the
    highest batch, and there of the highest ``sign``, if rows have one.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: list[str],
        buckets: int,
        bucket_by: list[str] | None = None,
    ) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path, keys, buckets
        self.bucket_by, self.columns = bucket_by or keys, schema.fieldNames()
        places = [T.StructField("batch_id", T.LongType()), T.StructField("bucket", T.IntegerType())]
        self.schema = T.StructType([*schema.fields, *places])

    def bucket(self, values: list[Column]) -> Column:
        key = F.struct(*values)
        nothing = F.concat(*(v.cast("string") for v in values)).isNull()
        return F.when(nothing, NO_KEY).otherwise(F.pmod(F.xxhash64(key), F.lit(self.buckets))).cast("int")

    def _numbers(self, path: str, prefix: str) -> list[int]:
        """The numbers of the folders that are written to their end."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        place = hadoop.Path(path)
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(place):
            return []
        names = [str(f.getPath().getName()) for f in files.listStatus(place)]
        done = [n for n in names if n.startswith(prefix) and files.exists(hadoop.Path(f"{path}/{n}/_SUCCESS"))]
        return sorted(int(n.removeprefix(prefix)) for n in done)

    def batches(self) -> list[int]:
        return self._numbers(self.path, "batch_id=")

    def folds(self) -> list[int]:
        return self._numbers(f"{self.path}-folded", "upto=")

    def _save(self, rows: DataFrame, path: str) -> None:
        """Spark gathers each bucket into few files, and splits one of very many rows."""
        bucket = self.bucket([F.col(k) for k in self.bucket_by])
        spread = rows.withColumn("bucket", bucket).hint("rebalance", "bucket")
        spread.write.mode("overwrite").partitionBy("bucket").parquet(path)

    def write(self, rows: DataFrame, number: int) -> None:
        self._save(rows.select(*self.columns), f"{self.path}/batch_id={number}")

    def fold(self, upto: int, passing: tuple[str, ...] = ()) -> None:
        """Reduces the batches up to one to the last row of each key; those are not read any more. Where
        rows have a sign, keys that are gone are dropped. Columns that are ``passing`` are of use in the
        batch that wrote them only, and kept for the last batch alone.

        One shuffle, by ranges of bucket and key, both gathers keys and deals buckets to few files.
        """
        rows = self.read(upto).withColumns({
            c: F.when(F.col("batch_id") == upto, F.col(c)) for c in passing
        }).repartitionByRange("bucket", *self.keys)
        last = self._last(rows, ["bucket", *self.keys], self.columns).select(*self.columns, "batch_id", "bucket")
        last.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}-folded/upto={upto}")

    def touched(self, values: list[Column], rows: DataFrame) -> list[int] | None:
        """The buckets of rows by their values of the bucket's columns; none if that is nearly all of
        them. No more than there are buckets come to the driver."""
        found = rows.select(self.bucket(values).alias("bucket")).distinct().collect()
        return None if len(found) > 0.9 * self.buckets else sorted(r.bucket for r in found)

    def read(self, upto: int, buckets: list[int] | None = None) -> DataFrame:
        """All rows up to a batch: of the newest fold and the batches after it, and of some buckets only if
        they are given."""
        upto_fold = max((n for n in self.folds() if n <= upto), default=-1)
        # The limit tells Spark that nothing is there, and joins with it are dropped from plans.
        found = self.spark.createDataFrame([], self.schema).limit(0)
        if upto_fold >= 0:
            found = self.spark.read.schema(self.schema).parquet(f"{self.path}-folded/upto={upto_fold}")
        parts = [f"{self.path}/batch_id={n}" for n in self.batches() if upto_fold < n <= upto]
        if parts:
            later = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*parts)
            found = found.unionByName(later) if upto_fold >= 0 else later
        return found if buckets is None else found.filter(F.col("bucket").isin(buckets))

    def latest(self, upto: int, buckets: list[int] | None = None, columns: list[str] | None = None) -> DataFrame:
        """The last row of each key, or some columns of it."""
        return self._last(self.read(upto, buckets), self.keys, columns or self.columns)

    def _last(self, rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
        others = [c for c in columns if c not in self.keys]
        place = F.struct("batch_id", "sign") if "sign" in self.columns else F.col("batch_id")
        last = F.max_by(F.struct(*others, "batch_id"), place)
        rows = rows.groupBy(*by).agg(last.alias("row")).select(*by, "row.*")
        return rows.filter("sign > 0") if "sign" in self.columns else rows


class MaintainedJoin:
    """Child rows with columns of their parent, and the counts of both tables, kept below a folder.

    ``apply`` takes the slices of both logs that came since, under a number that rises from 0. It reads
    the slices, the buckets of the states that hold their keys, and the children of changed
    parents, but neither the logs nor the result; it adds signed rows to the result. Applied again under
    its number, after a failure or not, a slice does the same again: every step reads what stands before its
    number and replaces what it wrote. Readers see the slices that are done.

    Slices have the columns of the log and its position (``lsn``, or ``position`` for a table with textual
    ones). They may overlap and bring older changes; a child may come before its parent. A slice with a
    truncate reads the table's whole state, whose rows it takes. The folder grows with the changes; ``fold``
    reduces it to a row a key.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        child: TableSpec,
        parent: TableSpec,
        foreign_key: str,
        columns: list[str],
        *,
        buckets: int = 256,
    ) -> None:
        if len(parent.key) != 1:
            raise ValueError("the parent needs a key of one column")
        self.spark, self.child, self.parent = spark, child, parent
        self.foreign_key, self.columns = foreign_key, list(columns)
        sign = T.StructField("sign", T.IntegerType())
        row = [T.StructField(f.name, f.log_type) for f in child.fields]
        added = [T.StructField(c, parent.field(c).log_type) for c in self.columns]
        counted = [T.StructField("name", T.StringType()), T.StructField("n_rows", T.LongType())]

        def numbered(name: str, fields: list, keys: list[str], **how) -> Numbered:
            return Numbered(spark, f"{path}/{name}", T.StructType(fields), keys, buckets, **how)

        self.states = {
            spec.name: numbered(f"state-{spec.name}", self._state_fields(spec), spec.key_columns) for spec in (child, parent)
        }
        links = dict.fromkeys([foreign_key, *child.key])
        self.by_parent = numbered("by-parent", [*row, sign], list(links), bucket_by=[foreign_key])
        self.result = numbered("result", [*row, *added, sign], list(child.key))
        self.counts = numbered("counts", counted, ["name"])

    def _slice(self, log: DataFrame, spec: TableSpec) -> DataFrame:
        return log.select(*spec.log_type().fieldNames(), "lsn" if spec.position == "number" else "position")

    def _state_fields(self, spec: TableSpec) -> list[T.StructField]:
        place = T.StructField("lsn", T.LongType()) if spec.position == "number" else T.StructField("position", T.StringType())
        empty = self.spark.createDataFrame([], T.StructType([*spec.log_type().fields, place]))
        row = T.StructType([T.StructField(f.name, f.log_type) for f in spec.fields])
        fields = last_changes(empty, spec, truncates=True).schema.fields
        return [*fields, T.StructField("before", row), T.StructField("after", row)]

    @property
    def done(self) -> int:
        """The number of the last slice that is applied, or -1."""
        return max(self.counts.batches(), default=-1)

    def apply(self, number: int, children: DataFrame, parents: DataFrame) -> None:
        """Takes in the slices of both logs; either may be empty."""
        self._take(self.child, self._slice(children, self.child), number)
        self._take(self.parent, self._slice(parents, self.parent), number)
        net = {
            name: state.read(number).filter(F.col("batch_id") == number) for name, state in self.states.items()
        }
        child_net, parent_net = net[self.child.name], net[self.parent.name]
        linked = signed(child_net, self.child).filter(F.col(self.foreign_key).isNotNull())
        self.by_parent.write(linked, number)

        parent_changes, key = signed(parent_net, self.parent), self.parent.key[0]
        state = self.states[self.parent.name]
        cut = state.read(number - 1, [NO_KEY]).agg(F.max("changed_at").alias("at")).scalar()
        wanted = state.touched([F.col(self.foreign_key)], linked)
        there = state.latest(number - 1, wanted, ["changed_at", "is_deleted", "truncates", key, *self.columns])
        there = there.filter(~F.col("is_deleted") & ~F.col("truncates") & (cut.isNull() | (F.col("changed_at") > cut)))
        now = self.by_parent.latest(number, self.by_parent.touched([F.col(key)], parent_changes))
        changed = join_changes(
            linked, now.drop("sign", "batch_id"), parent_changes, there, self.foreign_key, key, self.columns
        )
        self.result.write(changed, number)
        counts = [
            count_change(rows).select(F.lit(spec.name).alias("name"), "n_rows")
            for spec, rows in ((self.child, child_net), (self.parent, parent_net))
        ]
        # Written last: it says that the slice is done.
        self.counts.write(counts[0].unionByName(counts[1]), number)

    def _take(self, spec: TableSpec, slice_: DataFrame, number: int) -> None:
        state = self.states[spec.name]
        key = [F.coalesce(F.col(f"pk_{k}"), F.col(k)) for k in spec.key]
        cut = state.latest(number - 1, [NO_KEY], ["changed_at"])
        truncated = not slice_.filter(F.col("op") == TRUNCATE_OP).isEmpty()
        earlier = state.read(number - 1, None if truncated else state.touched(key, slice_))
        state.write(net_changes(earlier, slice_, spec, cut, all_keys=truncated), number)

    def read(self) -> DataFrame:
        """Child rows with the parent's columns, as of the last slice."""
        return self.result.latest(self.done).select(*self.child.columns, *self.columns)

    def count(self, spec: TableSpec) -> DataFrame:
        """Number of rows of a table, as of the last slice: one small row for each slice is read."""
        rows = self.counts.read(self.done).filter(F.col("name") == spec.name)
        return rows.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))

    def fold(self) -> None:
        """Reduces what the slices so far have left to a row a key."""
        if (done := self.done) >= 0:
            for state in self.states.values():
                state.fold(done, passing=("before", "after"))
            for part in (self.by_parent, self.result):
                part.fold(done)


def start_maintained_join(
    records: DataFrame, join: MaintainedJoin, checkpoint: str, *, trigger: dict | None = None
) -> StreamingQuery:
    """Start keeping a join up to date: each batch of records of both tables is a slice, under the batch's
    number. A batch that is handed over again after a failure is applied again."""

    def apply(batch: DataFrame, number: int) -> None:
        def log(spec: TableSpec) -> DataFrame:
            place = "lsn" if spec.position == "number" else "position"
            return decode(of_table(batch, spec), spec, extras=(place,))

        batch.persist()
        try:
            join.apply(number, log(join.child), log(join.parent))
        finally:
            batch.unpersist()

    return write_batches(records, apply, checkpoint, trigger=trigger)
