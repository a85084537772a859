"""Files, streams, tables and serving."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from liftlab import Settings, session
from liftlab.operators import dedup, serving, silver, sinks
from liftlab.plans import medallion
from liftlab.sources import files, roles
from liftlab.streaming import ingest
from tests.conftest import rows

SETTINGS = Settings(launch="2026-06-01")


def test_scratch_folder_comes_from_the_session(spark):
    assert session.scratch_root(spark) == spark.sparkContext.getCheckpointDir()
    assert session.fresh_path(spark, "a") != session.fresh_path(spark, "a")


def test_csv_inference_and_text_times(spark, tmp_path):
    df = spark.createDataFrame([("u1", dt.date(2024, 1, 2), dt.datetime(2026, 6, 1, 0, 0, 0, 123456), 1.5)],
                               "id string, d date, t timestamp_ntz, x double")
    sinks.csv(df, f"{tmp_path}/c", files=1)
    sinks.json(df, f"{tmp_path}/j", files=1)
    kinds = dict((f.name, f.dataType.simpleString()) for f in files.infer_schema(spark, f"{tmp_path}/c", "csv"))
    assert kinds["d"] == "date" and kinds["x"] == "double"
    assert rows(files.read_csv(spark, f"{tmp_path}/c", df.schema)) == rows(df)
    assert rows(files.read_json(spark, f"{tmp_path}/j", df.schema)) == rows(df)


def test_number_of_output_files(spark, tmp_path):
    sinks.json(spark.range(100), f"{tmp_path}/six", files=6)
    assert len(list((tmp_path / "six").glob("part-*"))) == 6


def _land(spark, feed, lines, schema):
    lines = [tuple(None if v is None else str(v) for v in line) for line in lines]
    writer = spark.createDataFrame(lines, schema).coalesce(1).write.mode("append")
    if feed.fmt == "csv":
        writer.option("header", True).csv(feed.landing)
    else:
        writer.json(feed.landing)


def _feeds(base):
    return medallion.Feeds(
        ingest.Feed("users", "csv", f"{base}/landing/users", files.USERS),
        ingest.Feed("events", "json", f"{base}/landing/events", files.EVENTS),
        ingest.Feed("assignments", "csv", f"{base}/landing/assignments", files.ASSIGNMENTS))


def test_refresh_restart_and_redelivery(spark, tmp_path):
    base, feeds = str(tmp_path), _feeds(str(tmp_path))
    user = (1, "2026-01-01", "gold", "W", "65+", "moderate", "verified", "10.5", "a@b.com", "ACCT-123456")
    _land(spark, feeds.users, [user], files.USERS)
    _land(spark, feeds.assignments, [("x", "crypto", 1, "control", "2026-06-01 00:00:00")], files.ASSIGNMENTS)
    _land(spark, feeds.events, [
        (1, 1, "2026-05-01 00:00:00", "deposit", None, "10.00", "s"),
        (2, 1, "2026-06-01 00:00:00", "trade", "crypto", "5.00", "s"),
        (None, 1, "2026-06-01 00:00:00", "trade", "options", "5.00", "s"),
        (4, 1, "zzz", "trade", "agentic", "5.00", "s")], files.EVENTS)
    first = rows(medallion.refresh(spark, feeds, base, SETTINGS).features)
    again = medallion.refresh(spark, feeds, base, SETTINGS)
    assert rows(again.features) == first
    got = again.features.first()
    assert (got.deposit_total_usd, got.adopted_crypto, got.adopted_options, got.adopted_agentic) == (10.0, 1, 0, 0)
    assert again.secure_users.first().email == "****@b.com"

    _land(spark, feeds.events, [(1, 1, "2026-05-01 00:00:00", "deposit", None, "12.00", "s")], files.EVENTS)
    later = medallion.refresh(spark, feeds, base, SETTINGS)
    assert later.features.first().deposit_total_usd == 12.0
    assert rows(later.results) == [("crypto_launch", "crypto", "control", 1, 1, 100.0)]
    assert ingest.run_once(spark, feeds.all(), base) == {"users": 0, "events": 0, "assignments": 0}


def test_refresh_without_files_and_with_broken_lines(spark, tmp_path):
    base, feeds = str(tmp_path), _feeds(str(tmp_path))
    for feed in feeds.all():
        sinks.json(spark.range(0), feed.landing)
    empty = medallion.refresh(spark, feeds, base, SETTINGS)
    assert empty.features.count() == 0 and empty.results.count() == 0
    assert {r.passed + r.failed for r in empty.rule_counts.collect()} == {0}
    spark.createDataFrame([("{broken",), ('{"event_id": "e1", "user_id": "u1", "amount_usd": "NaN"}',)], "value string") \
        .write.mode("append").text(feeds.events.landing)
    later = medallion.refresh(spark, feeds, base, SETTINGS)
    assert rows(later.quarantine["events"], "_corrupt_record", "failed_rules") == [
        ("{broken", "readable_line,valid_event_id,valid_user")]
    assert rows(later.events, "event_id", "amount_usd") == [("e1", None)]
    failed = {r.rule: r.failed for r in later.rule_counts.where("feed = 'events'").collect()}
    assert failed == {"readable_line": 1, "valid_event_id": 1, "valid_user": 1, "readable_time": 0, "finite_amount": 1}


def test_stream_drops_and_counts(spark, tmp_path):
    feed = _feeds(str(tmp_path)).events
    _land(spark, feed, [(1, 1, "t", "login", None, None, "s"), (2, None, "t", "login", None, None, "s")], files.EVENTS)
    query = ingest.to_bronze(spark, feed, str(tmp_path), silver.EVENT_RULES)
    query.awaitTermination()
    seen = [p["observedMetrics"]["events_rules"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(m["rows"] for m in seen) == 2 and sum(m["failed_valid_user"] for m in seen) == 1
    assert ingest.bronze(spark, str(tmp_path), feed).count() == 1


def test_stream_keeps_the_first_batch_the_latest(spark, tmp_path):
    feed = _feeds(str(tmp_path)).events

    def run():
        stream = ingest.open_feed(spark, feed).withColumn("at", F.col("event_ts").cast("timestamp"))
        ingest.append(dedup.stream_first(stream, ["event_id"], "at", "1 day"), f"{tmp_path}/o",
                      f"{tmp_path}/c").awaitTermination()

    for amount in ("1.00", "2.00"):
        _land(spark, feed, [(1, 1, "2026-05-01 00:00:00", "trade", "etf", amount, "s")], files.EVENTS)
        run()
    assert rows(spark.read.parquet(f"{tmp_path}/o"), "amount_usd") == [("1.00",)]


def test_table_comment_tags_and_replacement(spark, tmp_path):
    df = spark.createDataFrame([("u1", 1)], "user_id string, n int")
    sinks.materialize(df, "t_doc", f"{tmp_path}/t", "it's a table", {"user_id": "the key"},
                      {"layer": "gold", "n.kind": "count"})
    table = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED t_doc").collect()}
    assert table["Comment"] == "it's a table" and "layer=gold" in table["Table Properties"]
    assert spark.table("t_doc").schema["user_id"].metadata["comment"] == "the key"
    sinks.comment_column(spark, "t_doc", "n", "how many")
    assert spark.table("t_doc").schema["n"].metadata["comment"] == "how many"
    changed = sinks.materialize(df.select("n"), "t_doc", f"{tmp_path}/t")
    assert changed.columns == ["n"] and sinks.row_count(changed).first().rows == 1


def test_lookup_prunes_buckets_and_resists_injection(spark, tmp_path):
    df = spark.range(1000).selectExpr("concat('u', id) AS user_id", "CAST('NaN' AS DOUBLE) AS score")
    serving.export_clustered(df, "t_serving", f"{tmp_path}/s", buckets=8)
    found = serving.lookup(spark, "t_serving", "user_id", "u7")
    assert rows(found) == [("u7", None)]
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() < 250  # one bucket of eight was read
    assert serving.lookup(spark, "t_serving", "user_id", "x' OR '1'='1").count() == 0
    assert rows(serving.lookup(spark, "t_missing", "user_id", "u8", fallback=df), "user_id") == [("u8",)]
    bound = serving.query(spark, "SELECT user_id FROM {t} WHERE user_id = :id", {"id": "x' OR '1'='1"}, t=df)
    assert bound.count() == 0


def test_clustered_tables_join_without_shuffle(spark, tmp_path):
    df = spark.range(1000).selectExpr("id AS user_id", "id * 2 AS v")
    for name in ("t_left", "t_right"):
        serving.export_clustered(df, name, f"{tmp_path}/{name}", buckets=4)
    joined = spark.table("t_left").join(spark.table("t_right").hint("merge"), "user_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_jdbc_key_is_no_clob(spark):
    df = spark.createDataFrame([("u", "text", 1.0)], "user_id string, nudge_text string, s double")
    assert serving.jdbc_types(df, "user_id") == "user_id VARCHAR(64), nudge_text VARCHAR(4000)"


def test_order_then_limit(spark, sf):
    users = roles.users(spark, sf)
    assert [r.user_id for r in users.orderBy("user_id").limit(5).collect()] == [0, 1, 2, 3, 4]


def test_backlog_is_cut_into_batches(spark, tmp_path):
    feed = ingest.Feed("events", "json", f"{tmp_path}/landing", files.EVENTS, {"maxFilesPerTrigger": 1})
    for i in range(3):
        _land(spark, feed, [(i, 1, "2026-05-01 00:00:00", "login", None, None, "s")], files.EVENTS)
    query = ingest.to_bronze(spark, feed, str(tmp_path))
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1]
    assert ingest.bronze(spark, str(tmp_path), feed).count() == 3


def test_a_cluster_without_shared_folder_is_refused():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        session.scratch_root(Session())
