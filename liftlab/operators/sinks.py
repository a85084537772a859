"""File and table sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlab.sources import versions

# Text files keep all six digits of a second; the defaults would cut them to three.
TEXT_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
              "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _files(df: DataFrame, files: int | None) -> DataFrame:
    return df if files is None else df.repartition(files)


def csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with header. Without ``files`` every task writes its own file and nothing moves."""
    _files(df, files).write.mode("overwrite").options(header=True, **TEXT_TIMES).csv(path)


def json(df: DataFrame, path: str, files: int | None = None) -> None:
    _files(df, files).write.mode("overwrite").options(**TEXT_TIMES).json(path)


def replace(df: DataFrame, path: str) -> DataFrame:
    """Replace data and schema of the table under ``path`` in one step; ``df`` may read that table.

    A write that fails leaves the old rows; readers keep the version they started with. The last two versions stay.
    """
    store = versions.Versions(df.sparkSession, path)
    replaced = store.replace("table", df)
    store.vacuum()
    return replaced


def replaced(spark: SparkSession, path: str) -> DataFrame:
    """The newest rows that ``replace`` has put under ``path``."""
    return versions.Versions(spark, path).snapshot().read("table")


def materialize(df: DataFrame, table: str, path: str, comment: str | None = None,
                columns: Mapping[str, str] | None = None,
                tags: Mapping[str, str] | None = None) -> DataFrame:
    """Overwrite a named table with its data, comments and tags."""
    described = df
    for name, text in (columns or {}).items():
        described = described.withMetadata(name, {"comment": text})
    described.write.mode("overwrite").option("path", path).saveAsTable(table)
    spark = df.sparkSession
    if comment:
        comment_table(spark, table, comment)
    if tags:
        tag(spark, table, tags)
    return spark.table(table)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def comment_table(spark: SparkSession, table: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {table} IS {_text(comment)}")


def comment_column(spark: SparkSession, table: str, column: str, comment: str) -> None:
    spark.sql(f"ALTER TABLE {table} ALTER COLUMN {column} COMMENT {_text(comment)}")


def tag(spark: SparkSession, table: str, tags: Mapping[str, str]) -> None:
    """Free-form tags as table properties; a column tag uses the key ``column.name``."""
    pairs = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in tags.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))
