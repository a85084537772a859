"""Landing files: schema inference, batch readers and incremental readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The landing schemas. Keys are text: a feed may number its rows or not.
USERS = ("user_id STRING, signup_date STRING, tier STRING, region STRING, age_band STRING, "
         "risk_profile STRING, kyc_status STRING, account_balance_usd STRING, email STRING, "
         "account_ref STRING")
EVENTS = ("event_id STRING, user_id STRING, event_ts STRING, event_type STRING, product STRING, "
          "amount_usd STRING, session_id STRING")
ASSIGNMENTS = ("experiment_id STRING, product STRING, user_id STRING, variant STRING, "
               "assigned_ts STRING")


#: Where a CSV or JSON line that does not fit its schema is kept as it came.
CORRUPT = "_corrupt_record"


def infer_schema(spark: SparkSession, path: str, fmt: str, share: float = 1.0) -> StructType:
    """Typed inference over existing files, done once; streams then get a fixed schema.

    share: part of the rows to look at; data itself is always read whole.
    """
    reader = spark.read.options(inferSchema=True, samplingRatio=share)
    if fmt == "csv":
        return reader.option("header", True).csv(path).schema
    return reader.format(fmt).load(path).schema


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_json(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def csv_stream(spark: SparkSession, path: str, schema: str | StructType, **options: object) -> DataFrame:
    return spark.readStream.schema(schema).option("header", True).options(**options).csv(path)


def json_stream(spark: SparkSession, path: str, schema: str | StructType, **options: object) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).json(path)


def parquet_stream(spark: SparkSession, path: str, schema: str | StructType, **options: object) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).parquet(path)


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A small dimension or fixture as a table; the schema is never guessed."""
    return spark.createDataFrame(list(rows), schema)
