"""Export for key lookup, and the lookup itself."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liftlab.functions import numeric
from liftlab.operators import rank
from liftlab.sources import versions

COLUMNS = ("user_id", "tier", "region", "age_band", "risk_profile", "recommended_product",
           "propensity_score", "expected_annual_value_usd", "targeting_decile")
TEXT_COLUMNS = ("nudge_text", "nudge_source")


def columns(products: tuple[str, ...]) -> list[str]:
    return [*COLUMNS, *(f"prob_{p}" for p in products), *TEXT_COLUMNS]


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [c for c, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: numeric.no_nan(F.col(c)) for c in floats}) if floats else df


def export_clustered(df: DataFrame, table: str, path: str, key: str = "user_id",
                     buckets: int = 64) -> None:
    """A table bucketed and sorted by the unique key: a lookup reads one bucket, a join on the
    key needs no shuffle. One shuffle first, so that every bucket is one file."""
    (nan_to_null(df).repartition(buckets, key)
     .write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))


def jdbc_types(df: DataFrame, key: str, key_length: int = 64, text_length: int = 4000) -> str:
    """createTableColumnTypes for the text columns; a key must not become a CLOB."""
    return ", ".join(
        f"{c} VARCHAR({key_length if c == key else text_length})"
        for c, kind in df.dtypes if kind == "string")


def export_jdbc(df: DataFrame, url: str, table: str, key: str = "user_id", batch_size: int = 1000,
                connections: int = 8, properties: Mapping[str, str] | None = None) -> None:
    """Replace a relational table from the executors, in batches, over a bounded number of
    connections. Primary key and secondary index are DDL of the target database."""
    (nan_to_null(df).write.format("jdbc").mode("overwrite")
     .options(url=url, dbtable=table, batchsize=batch_size, numPartitions=connections,
              createTableColumnTypes=jdbc_types(df, key), **(properties or {}))
     .save())


def jdbc_lookup(spark: SparkSession, url: str, table: str, key: str, value: object,
                properties: Mapping[str, str] | None = None) -> DataFrame:
    """One key from the relational table; the equality is pushed into the database."""
    source = spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {})).load()
    return source.where(F.col(key) == F.lit(value))


def lookup(spark: SparkSession, table: str, key: str, value: object,
           fallback: DataFrame | None = None) -> DataFrame:
    """One key from the serving table, or from ``fallback`` if that table cannot be read.

    With a fallback the row is fetched here, as lost files show only when they are read; one key
    is one row. Without one the lookup stays lazy and any failure reaches the caller.
    """
    def found(source: DataFrame) -> DataFrame:
        return source.where(F.col(key) == F.lit(value))

    if fallback is None:
        return found(spark.table(table))
    try:
        served = found(spark.table(table))
        return spark.createDataFrame(served.collect(), served.schema)
    except PySparkException:
        return found(fallback)


# ---------------------------------------------------------------- the best rows of a group
def export_ranked(df: DataFrame, store: versions.Versions, table: str, group: str = "recommended_product",
                  score: str = "propensity_score", key: str = "user_id", rows_a_file: int = 1_000_000) -> versions.Snapshot:
    """A second layout beside the key buckets: files in the order of (group, score from the best, key), and their index.

    The index has one row per file and group it holds, with the number of rows and the best and least score; both
    become visible in one commit. Rows are range partitioned, so a hot group is many files. NaN scores become NULL, and NULL
    scores come last.
    """
    clean = nan_to_null(df)
    order = [F.col(group).asc_nulls_first(), *rank.best_first(clean, score, key)]
    placed = clean.repartitionByRange(*order).sortWithinPartitions(*order)
    folder = store.whole(table, placed, maxRecordsPerFile=rows_a_file)
    before = store.snapshot()
    written = before.apply({table: folder}).read(table)
    first = F.struct(F.isnull(score).alias("n"), (-F.col(score)).alias("s"), F.col(key).alias("k"))
    index = written.groupBy(F.col("_metadata.file_path").alias("file"), F.col(group).alias("group")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(first).alias("first"), F.max(score).alias("best_score"),
        F.min(score).alias("least_score"))
    return store.commit(before.apply({table: folder, f"{table}.index": store.whole(f"{table}.index", index.coalesce(1))}))


def files_of_top(snapshot: versions.Snapshot, table: str, group: str, k: int) -> list[str]:
    """The files that hold the k best rows of a group, as few as hold them; found in the index alone."""
    mine = snapshot.read(f"{table}.index").where(F.col("group").eqNullSafe(F.lit(group)))
    # files of one group in order of their first row: a file is needed while those before it hold fewer than k rows
    before = F.coalesce(F.sum("rows").over(Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return [r.file for r in mine.select("file", before.alias("before")).where(F.col("before") < k).collect()]


def top_of_group(snapshot: versions.Snapshot, table: str, group: str, k: int, by: str = "recommended_product",
                 score: str = "propensity_score", key: str = "user_id") -> DataFrame:
    """The k best rows of one group, best first; opens only the files that hold them."""
    found = files_of_top(snapshot, table, group, k) if k > 0 else []
    schema = snapshot.tables[table].schema
    if not found:
        return snapshot.spark.createDataFrame([], schema)
    rows = snapshot.spark.read.schema(schema).parquet(*found).where(F.col(by).eqNullSafe(F.lit(group)))
    return rows.orderBy(*rank.best_first(rows, score, key)).limit(k)


def query(spark: SparkSession, text: str, args: Mapping[str, object] | None = None,
          **tables: DataFrame) -> DataFrame:
    """Run SQL over DataFrames: ``{name}`` is a table, ``:name`` a bound value, never pasted text."""
    return spark.sql(text, args=dict(args or {}), **tables)
