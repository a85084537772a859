"""The given TPC-H-like tables read as users, events, assignments and catalog.

Only column derivations: every role covers its whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlab.operators import silver
from liftlab.settings import CATALOG, CATALOG_SCHEMA, Settings
from liftlab.sources import files

SETTINGS = Settings(launch="2024-01-21")

# Schemas of the given tables. A known schema saves one inference job per read.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}

EVENT_COLUMNS = ["event_id", "user_id", "event_ts", "event_type", "product", "amount_usd", "session_id"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer with its region. nation and region are sized by Catalyst, not hinted."""
    region = load(spark, sf_dir, "region")
    nation = load(spark, sf_dir, "nation").join(region, F.expr("n_regionkey = r_regionkey"))
    return load(spark, sf_dir, "customer").join(
        nation, F.expr("c_nationkey = n_nationkey"), "left").selectExpr(
        "c_custkey AS user_id",
        "date_add(DATE'2023-01-01', CAST(c_custkey * 37 % 360 AS INT)) AS signup_date",
        "CASE WHEN c_acctbal < 2000 THEN 'bronze' WHEN c_acctbal < 5000 THEN 'silver' "
        "WHEN c_acctbal < 8000 THEN 'gold' ELSE 'platinum' END AS tier",
        "r_name AS region",
        "elt(CAST(c_custkey % 5 AS INT) + 1, '18-25', '26-35', '36-50', '51-65', '65+') AS age_band",
        "elt(CAST(c_custkey % 3 AS INT) + 1, 'conservative', 'moderate', 'aggressive') AS risk_profile",
        "IF(c_custkey % 10 = 0, 'pending', 'verified') AS kyc_status",
        "c_acctbal AS account_balance_usd",
        "concat('user', c_custkey, '@example.com') AS email",
        "concat('ACCT-', 1000000000 + c_custkey) AS account_ref",
    )


def _events_with_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with the business names, and the number k that their props carry (one flat field,
    for which a pattern is several times cheaper than a JSON parser)."""
    return load(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "ts AS event_ts",
        "CASE event_type WHEN 'click' THEN 'login' WHEN 'view' THEN 'view_product' "
        "WHEN 'purchase' THEN 'trade' WHEN 'signup' THEN 'deposit' "
        "WHEN 'error' THEN 'feature_interaction' END AS event_type",
        "value", r"""CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INT) AS k""",
    ).selectExpr(
        "event_id", "user_id", "event_ts", "event_type",
        "CASE WHEN event_type IN ('view_product', 'trade', 'feature_interaction') THEN "
        "CASE WHEN k < 20 THEN 'crypto' WHEN k < 40 THEN 'options' WHEN k < 60 THEN 'agentic' "
        "WHEN k < 80 THEN 'equities' ELSE 'etf' END END AS product",
        "CASE WHEN event_type IN ('trade', 'deposit') THEN value END AS amount_usd",
        "concat('S', user_id, '-', k % 20) AS session_id", "k",
    )


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events, typed, without the launch flag."""
    return _events_with_k(spark, sf_dir).drop("k")


def events(spark: SparkSession, sf_dir: str, settings: Settings = SETTINGS) -> DataFrame:
    return silver.flag_launch(clean_events(spark, sf_dir), settings.launch)


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as landing text: seconds, and amounts with two decimals."""
    return clean_events(spark, sf_dir).selectExpr(
        "event_id", "user_id", "substring(CAST(event_ts AS STRING), 1, 19) AS event_ts", "event_type",
        "product", "CAST(CAST(amount_usd AS DECIMAL(18,2)) AS STRING) AS amount_usd", "session_id")


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A faulty delivery made of all events: missing ids, unreadable times and amounts; and a
    second delivery of all trades with a corrected amount."""
    faulty = _events_with_k(spark, sf_dir).selectExpr(
        "IF(k <> 1, event_id, NULL) AS event_id", "IF(k <> 0, user_id, NULL) AS user_id",
        "IF(k = 2, 'not-a-time', substring(CAST(event_ts AS STRING), 1, 19)) AS event_ts",
        "event_type", "product", "CAST(amount_usd AS DECIMAL(18,2)) AS amount", "session_id", "k")
    rest = ["event_id", "user_id", "event_ts", "event_type", "product"]
    first = faulty.selectExpr(
        *rest, "IF(k = 3, 'n/a', CAST(amount AS STRING)) AS amount_usd", "session_id", "0 AS ingest_seq")
    second = faulty.where("event_type = 'trade'").selectExpr(
        *rest, "CAST(amount + 1.00 AS STRING) AS amount_usd", "session_id", "1 AS ingest_seq")
    return first.unionByName(second)


def bronze_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All users once, and those of one market segment again with a higher balance."""
    segment = load(spark, sf_dir, "customer").selectExpr("c_custkey AS user_id", "c_mktsegment")
    again = users(spark, sf_dir).join(
        segment.where("c_mktsegment = 'MACHINERY'"), "user_id", "left_semi")
    return users(spark, sf_dir).withColumn("ingest_seq", F.lit(0)).unionByName(
        again.withColumns({"account_balance_usd": F.expr("account_balance_usd + 100"),
                           "ingest_seq": F.lit(1)}))


def _all_assignments(spark: SparkSession, sf_dir: str, settings: Settings) -> DataFrame:
    products = ", ".join(f"'{p}'" for p in settings.products)
    return load(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id", "c_mktsegment", f"explode(array({products})) AS product",
    ).selectExpr(
        "concat(product, '_launch') AS experiment_id", "product", "user_id",
        f"IF({_hash32('product', _quoted(':'), 'user_id')} % 2 = 0, 'control', 'treatment') AS variant",
        "TIMESTAMP_NTZ'2024-01-11' + make_dt_interval(CAST(user_id % 10 AS INT)) AS assigned_ts",
        "c_mktsegment")


def silver_assignments(spark: SparkSession, sf_dir: str, settings: Settings = SETTINGS) -> DataFrame:
    """Every customer in every experiment, variant by a hash; long form."""
    return _all_assignments(spark, sf_dir, settings).drop("c_mktsegment")


def bronze_assignments(spark: SparkSession, sf_dir: str, settings: Settings = SETTINGS) -> DataFrame:
    """All assignments, and those of one market segment again with the variant swapped."""
    first = _all_assignments(spark, sf_dir, settings)
    second = first.where("c_mktsegment = 'BUILDING'").withColumn(
        "variant", F.expr("IF(variant = 'control', 'treatment', 'control')"))
    return (first.withColumn("ingest_seq", F.lit(0))
            .unionByName(second.withColumn("ingest_seq", F.lit(1))).drop("c_mktsegment"))


def catalog(spark: SparkSession) -> DataFrame:
    return files.from_rows(spark, CATALOG, CATALOG_SCHEMA)


def _quoted(text: str) -> str:
    return f"'{text}'"


def _hash32(*parts: str) -> str:
    """The first 32 bits of an md5, a value that any SQL engine can reproduce."""
    return f"CAST(conv(substring(md5(concat({', '.join(parts)})), 1, 8), 16, 10) AS BIGINT)"


def closed_form_scores(features: DataFrame, settings: Settings = SETTINGS, salt: str = "prob",
                       keep: Sequence[str] = ("user_id",)) -> DataFrame:
    """prob_{p} without a model: a hash raised by affinity. One division, so exact anywhere."""
    return features.selectExpr(*keep, *[
        f"({_hash32(_quoted(f'{salt}:{p}:'), 'user_id')} % 1000 + 10 * pre_{p}_interactions)"
        f" / (1000 + 10 * events_total) AS prob_{p}"
        for p in settings.products])
