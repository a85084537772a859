"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "liftlab", cores: int | str = "*", shuffle_partitions: int = 8,
                  **conf: str) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # keyed stream state on disk instead of in the heap
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        # a hot user's events are merged to sessions before the shuffle
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``; Spark then keeps one subfolder per
    application, which is used here. Only a local session may fall back to /tmp.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named:
            sc.setCheckpointDir(named)
        elif sc.master.startswith("local"):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="liftlab-", dir="/tmp"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return sc.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the scratch folder that nothing has used before."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Spark's own switch: a statement's shuffle files go when it ends, not when the driver collects its garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later passes see exactly the same rows, also after executors were lost, and read only
    the columns they need. What the write shuffled is not needed after it and goes at once.
    """
    return _written(df, fresh_path(df.sparkSession, label))


def _written(df: DataFrame, path: str, **options: str) -> DataFrame:
    spark = df.sparkSession
    with _without_shuffle_files(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables that go when a block ends, or before; what the block returns must not read them.
    ``options`` go to the writer.

    with Scratch(spark) as scratch:
        big = scratch.written(df, "big")
        return written(small_part_of(big), "small")
    """

    def __init__(self, spark: SparkSession, **options: str):
        self._spark, self._options, self._paths = spark, options, {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop(*self._paths)

    def written(self, df: DataFrame, label: str) -> DataFrame:
        path = fresh_path(self._spark, label)
        table = _written(df, path, **self._options)
        self._paths[table] = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete ``tables``, which this block wrote and no longer reads."""
        for table in tables:
            path = self._spark._jvm.org.apache.hadoop.fs.Path(self._paths.pop(table))
            path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)
