"""Landing files to bronze tables, exactly once, with Structured Streaming.

The checkpoint remembers which files were read. A run takes everything that is new and stops;
a run without new files adds nothing, and a run after a crash resumes where the log ends.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from liftlab.operators import quality
from liftlab.sources import drift, files, versions


@dataclass(frozen=True)
class Feed:
    """One landing folder and its bronze table.

    options go to the file source. ``maxFilesPerTrigger`` cuts a large backlog into several
    micro-batches, so that a lost run repeats one of them and not everything.
    """

    name: str
    fmt: str
    landing: str
    schema: str | StructType
    options: Mapping[str, object] = field(default_factory=dict)


def stamp(df: DataFrame) -> DataFrame:
    """Arrival time (one per micro-batch), and the file with its time, by which re-deliveries are
    ordered: inside one batch the later file wins, whatever its name."""
    return df.withColumns({
        "_ingested_at": F.current_timestamp(),
        "_file_time": F.col("_metadata.file_modification_time"),
        "_source_file": F.col("_metadata.file_path")})


def landing_schema(feed: Feed) -> StructType:
    """The feed's columns, and for text formats one that keeps lines which cannot be read."""
    schema = StructType.fromDDL(feed.schema) if isinstance(feed.schema, str) else feed.schema
    if feed.fmt == "parquet" or files.CORRUPT in schema.fieldNames():
        return schema
    return StructType([*schema.fields, StructField(files.CORRUPT, StringType())])


def bronze_schema(feed: Feed) -> StructType:
    return StructType([*landing_schema(feed).fields, StructField("_ingested_at", TimestampType()),
                       StructField("_file_time", TimestampType()), StructField("_source_file", StringType())])


def open_feed(spark: SparkSession, feed: Feed) -> DataFrame:
    readers: dict[str, Callable[..., DataFrame]] = {
        "csv": files.csv_stream, "json": files.json_stream, "parquet": files.parquet_stream}
    return readers[feed.fmt](spark, feed.landing, landing_schema(feed), **feed.options)


def open_rescued(spark: SparkSession, feed: Feed) -> DataFrame:
    """A stamped JSON feed whose columns may change: what its schema cannot hold is kept in ``_rescued``."""
    if feed.fmt != "json":
        raise ValueError("only JSON lines name their fields row by row")
    lines = stamp(spark.readStream.options(**feed.options).text(feed.landing))
    schema = StructType.fromDDL(feed.schema) if isinstance(feed.schema, str) else feed.schema
    return drift.fit_json(lines, schema, ["_ingested_at", "_file_time", "_source_file"])


def append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start an append of all available rows to a parquet table."""
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).option("path", path)
            .trigger(availableNow=True).start())


def to_bronze(spark: SparkSession, feed: Feed, base: str,
              rules: quality.Rules | None = None) -> StreamingQuery:
    """Ingest one feed. With rules, failed rows are dropped and counted in the query progress."""
    stream = stamp(open_feed(spark, feed))
    if rules:
        stream = quality.expect_or_drop(quality.observe(stream, f"{feed.name}_rules", rules), rules)
    return append(stream, bronze_path(base, feed.name), f"{base}/checkpoints/{feed.name}")


def bronze_path(base: str, name: str) -> str:
    return f"{base}/bronze/{name}"


def run_once(spark: SparkSession, feeds: list[Feed], base: str) -> Mapping[str, int]:
    """Ingest everything new of all feeds side by side; returns rows added per feed.

    Rows are counted in the tables (from file footers): a query remembers its last hundred
    micro-batches only.
    """
    before = {feed.name: _rows(spark, base, feed) for feed in feeds}
    for query in [to_bronze(spark, feed, base) for feed in feeds]:
        query.awaitTermination()
    return {feed.name: _rows(spark, base, feed) - before[feed.name] for feed in feeds}


def _rows(spark: SparkSession, base: str, feed: Feed) -> int:
    try:
        return bronze(spark, base, feed).count()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0  # the first run


def bronze(spark: SparkSession, base: str, feed: Feed) -> DataFrame:
    """The bronze table; empty, with all columns, as long as its feed brought nothing."""
    return spark.read.schema(bronze_schema(feed)).parquet(bronze_path(base, feed.name))


# ---------------------------------------------------------------- by micro-batch
BATCH = "_batch"
COUNTS = "feed STRING, rule STRING, passed BIGINT, failed BIGINT"


def to_batches(spark: SparkSession, feed: Feed, base: str, rules: quality.Rules) -> StreamingQuery:
    """Ingest one feed into one bronze folder per micro-batch, and count its rules in the same pass.

    All rows are stored, also those that fail. A batch that is run again after a crash overwrites its own two folders,
    so rows and counters are there exactly once, for as long as the table is.
    """
    def land(batch: DataFrame, number: int) -> None:
        seen = Observation()
        quality.observe(batch, seen, rules).write.mode("overwrite").parquet(f"{bronze_path(base, feed.name)}/{BATCH}={number}")
        counted = seen.get
        rows = counted.get("rows", 0)
        report = [{"feed": feed.name, "rule": rule, "passed": rows - (bad := counted.get(f"failed_{rule}", 0)), "failed": bad}
                  for rule in rules]
        versions.write_text(spark, f"{counts_path(base, feed.name)}/{BATCH}={number}/counts.json",
                            "".join(json.dumps(line) + "\n" for line in report), overwrite=True)

    return (stamp(open_feed(spark, feed)).writeStream.foreachBatch(land)
            .option("checkpointLocation", f"{base}/checkpoints/{feed.name}").trigger(availableNow=True).start())


def counts_path(base: str, name: str) -> str:
    return f"{base}/counts/_feed={name}"


def batch_numbers(spark: SparkSession, base: str, name: str, after: int = -1) -> list[int]:
    """The micro-batches of a feed later than ``after``. Counters are written last, so a batch with them is whole."""
    found = versions.names_in(spark, counts_path(base, name))
    return sorted(n for f in found if f.startswith(f"{BATCH}=") and (n := int(f.split("=")[1])) > after)


def batches(spark: SparkSession, base: str, feed: Feed, numbers: list[int]) -> DataFrame:
    """The bronze rows of some micro-batches; only their folders are listed and read."""
    schema = bronze_schema(feed)
    if not numbers:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{bronze_path(base, feed.name)}/{BATCH}={n}" for n in numbers])


def rule_counts(spark: SparkSession, base: str, feeds: list[Feed]) -> DataFrame:
    """(feed, rule, passed, failed) over all micro-batches that were ever ingested."""
    if any(batch_numbers(spark, base, f.name) for f in feeds):
        stored = spark.read.schema(COUNTS).json(f"{base}/counts").where(F.col("feed").isin([f.name for f in feeds]))
    else:
        stored = spark.createDataFrame([], COUNTS)
    return stored.groupBy("feed", "rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))
