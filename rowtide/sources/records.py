"""Change records: a topic on a broker, or the same records kept as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed columns of a message read from a broker.
RECORD_TYPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


def kafka_options(
    servers: str,
    topics: list[str],
    *,
    starting_offsets: str = "earliest",
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options. ``min_partitions`` splits a topic of few partitions over more tasks."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
    }
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_topics(
    spark: SparkSession, servers: str, topics: list[str], *, streaming: bool = True, **options
) -> DataFrame:
    """Records of Kafka topics, from the beginning unless told otherwise.

    Needs the Kafka connector on the classpath. A checkpoint of the query, once written,
    wins over ``starting_offsets``.
    """
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**kafka_options(servers, topics, **options)).load()


def read_replay(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = True,
    topics: list[str] | None = None,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """Records written by ``write_replay``. Files are laid out by topic, so that asking for
    some topics reads only their folders."""
    if streaming:
        reader = spark.readStream.schema(RECORD_TYPE)
        if max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        if max_bytes_per_trigger is not None:
            reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    else:
        reader = spark.read.schema(RECORD_TYPE)
    records = reader.parquet(path).select(*RECORD_TYPE.fieldNames())
    if topics is not None:
        records = records.filter(F.col("topic").isin(*topics))
    return records


def write_replay(records: DataFrame, path: str, *, mode: str = "append") -> None:
    """Keep records as Parquet below one folder per topic.

    Records stay in the partitions they are in: each task writes its part of every topic,
    so one large topic is never gathered in one task.
    """
    records.select(*RECORD_TYPE.fieldNames()).write.mode(mode).partitionBy("topic").parquet(path)


def in_topic_order(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """Records range-partitioned and sorted by topic, partition and offset.

    Every topic partition is one contiguous run over any number of tasks.
    """
    position = ("topic", "partition", "offset")
    count = () if partitions is None else (partitions,)
    return records.repartitionByRange(*count, *position).sortWithinPartitions(*position)


def of_table(records: DataFrame, spec) -> DataFrame:
    """The records of one table out of a stream that carries several."""
    return records.filter(F.col("topic") == spec.topic)


def topics(records: DataFrame) -> DataFrame:
    """Topics that hold records. Keys and values are not needed for that."""
    return records.select("topic").distinct()


def kept_topics(spark: SparkSession, path: str) -> DataFrame:
    """Topics below a replay folder, by the names of their folders; no key or value is read."""
    return read_replay(spark, path, streaming=False).select("topic").distinct()


def peek(records: DataFrame, topic: str, n: int) -> DataFrame:
    """The first ``n`` messages of a topic, from its beginning, as text."""
    return (
        records.filter(F.col("topic") == topic)
        .orderBy("partition", "offset")
        .limit(n)
        .select(
            "topic",
            "partition",
            "offset",
            F.col("key").cast("string").alias("key_str"),
            F.col("value").cast("string").alias("json"),
        )
    )
