"""Versioned tables, incremental refresh and lasting counters."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from liftlab import Settings
from liftlab.operators import silver, sinks
from liftlab.plans import incremental, medallion
from liftlab.sources import files, versions
from liftlab.streaming import ingest
from tests.conftest import rows

SETTINGS = Settings(launch="2026-06-01")


def parquet_files(folder):
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


# ---------------------------------------------------------------- versions
def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    old = sinks.replace(spark.range(10).toDF("x"), f"{tmp_path}/t")
    broken = spark.range(100).repartition(4).select(
        F.when(F.col("id") == 77, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).cast("long").alias("x"))
    with pytest.raises(Exception, match="half-way"):
        sinks.replace(broken, f"{tmp_path}/t")
    assert sinks.replaced(spark, f"{tmp_path}/t").count() == old.count() == 10


def test_a_table_may_be_replaced_by_a_query_on_itself(spark, tmp_path):
    table = sinks.replace(spark.range(10).toDF("x"), f"{tmp_path}/t")
    doubled = sinks.replace(table.selectExpr("x * 2 AS y"), f"{tmp_path}/t")
    assert rows(doubled)[:2] == [(0,), (10,)] and table.count() == 10
    assert sinks.replaced(spark, f"{tmp_path}/t").columns == ["y"]


def test_two_writers_cannot_both_commit(spark, tmp_path):
    store = versions.Versions(spark, f"{tmp_path}/v")
    start = store.snapshot()
    one, two = (start.apply({"t": store.whole("t", spark.range(n))}) for n in (1, 2))
    store.commit(one)
    with pytest.raises(versions.Conflict):
        store.commit(two)
    assert store.snapshot().read("t").count() == 1 and store.history() == [1]


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    store = versions.Versions(spark, f"{tmp_path}/v")
    df = spark.range(1000).selectExpr("concat('u', id) AS user_id", "id AS x")
    none = store.snapshot()
    first = store.commit(none.apply({"a/t": store.bucketed("a/t", df, ["user_id"], 8, range(8), none)}))
    before = parquet_files(tmp_path)
    three = first.read("a/t", [3])
    assert 0 < three.count() < 400
    second = store.commit(first.apply({"a/t": store.bucketed("a/t", three.withColumn("x", F.lit(-1).cast("long")), ["user_id"], 8, [3], first)}))
    assert before.items() <= parquet_files(tmp_path).items()
    assert second.read("a/t").where("x = -1").count() == three.count() and second.read("a/t").count() == 1000
    assert first.read("a/t").where("x = -1").count() == 0
    emptied = store.commit(second.apply({"a/t": store.bucketed("a/t", second.read("a/t", []), ["user_id"], 8, [3], second)}))
    assert emptied.read("a/t").count() == 1000 - three.count()
    with pytest.raises(ValueError, match="buckets"):
        store.bucketed("a/t", df, ["user_id"], 4, range(4), emptied)
    with pytest.raises(ValueError, match="not said to be touched"):
        store.bucketed("a/t", df, ["user_id"], 8, [3], emptied)
    with pytest.raises(ValueError, match="other columns"):
        store.bucketed("a/t", df.select("user_id"), ["user_id"], 8, range(8), emptied)


def test_vacuum_removes_what_no_kept_version_uses(spark, tmp_path):
    store = versions.Versions(spark, f"{tmp_path}/v")
    for n in (5, 6, 7):
        store.replace("t", spark.range(n))
    pinned = store.snapshot(2)
    store.whole("t", spark.range(1))  # a write that is still running
    assert store.vacuum(keep=2) == 1 and store.history() == [2, 3]
    assert pinned.read("t").count() == 6 and store.snapshot().read("t").count() == 7
    assert len(store._writes()) == 3
    assert store.vacuum(keep=1, orphan_hours=-1) == 2 and len(store._writes()) == 1
    assert store.snapshot().read("t").count() == 7
    with pytest.raises(ValueError):
        store.vacuum(0)


def test_appended_parts(spark, tmp_path):
    store = versions.Versions(spark, f"{tmp_path}/v")
    for n in (2, 3):
        now = store.snapshot()
        now = store.commit(now.apply({"log": store.appended("log", spark.range(n), now)}, seen=n))
    assert now.read("log").count() == 5 and store.snapshot().notes == {"seen": 3}
    assert store.snapshot(1).read("log").count() == 2


def test_a_hot_bucket_is_written_by_many_tasks(spark, tmp_path):
    store = versions.Versions(spark, f"{tmp_path}/v")
    df = spark.range(0, 400_000, 1, 8).selectExpr("IF(id % 3 = 0, 'hot', concat('u', id)) AS user_id", "uuid() AS x")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        table = store.bucketed("t", df, ["user_id"], 4, range(4), store.snapshot())
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert all(len(list(Path(folder).glob("*.parquet"))) > 1 for folder in table.parts.values())


# ---------------------------------------------------------------- incremental refresh
def feeds_in(base):
    return medallion.Feeds(
        ingest.Feed("users", "csv", f"{base}/landing/users", files.USERS),
        ingest.Feed("events", "json", f"{base}/landing/events", files.EVENTS),
        ingest.Feed("assignments", "csv", f"{base}/landing/assignments", files.ASSIGNMENTS))


def land(spark, feed, lines):
    schema = feed.schema
    lines = [tuple(None if v is None else str(v) for v in line) for line in lines]
    writer = spark.createDataFrame(lines, schema).coalesce(1).write.mode("append")
    writer.option("header", True).csv(feed.landing) if feed.fmt == "csv" else writer.json(feed.landing)


def user(n, tier="gold"):
    return (f"u{n}", "2026-01-01", tier, "W", "65+", "moderate", "verified", "10.5", f"{n}@b.com", "ACCT-123456")


def event(rng, n, users):
    kind = rng.choice(["trade", "deposit", "login", "view_product"])
    return (f"e{n}", f"u{rng.randrange(users)}" if rng.random() > .05 else None,
            rng.choice(["2026-05-30 10:00:00", "2026-05-31 23:59:59", "2026-06-01 00:00:00", "2026-06-03 01:00:00", "bad"]),
            kind, rng.choice(["crypto", "options", "agentic", "etf"]), rng.choice(["1.50", "20.00", "n/a"]), f"s{rng.randrange(4)}")


def deliver(spark, rng, feeds, users, events, assignments):
    if users:
        land(spark, feeds.users, [user(n, rng.choice(["gold", "silver"])) for n in users])
    if events:
        land(spark, feeds.events, [event(rng, n, 30) for n in events] + [(None, "u1", "x", "login", None, None, "s")])
    if assignments:
        land(spark, feeds.assignments, [
            (f"{p}_launch", p, f"u{n}", rng.choice(["control", "treatment"]), "2026-06-01 00:00:00")
            for n in assignments for p in ("crypto", "options")])


SHOWN = {"users": "user_id tier account_balance_usd", "events": "event_id user_id event_ts event_type product amount_usd session_id is_post_launch",
         "assignments": "experiment_id product user_id variant assigned_ts", "features": "*", "results": "*",
         "secure_users": "user_id email", "rule_counts": "*"}


def shown(layers):
    found = {name: rows(getattr(layers, name), *columns.split()) for name, columns in SHOWN.items()}
    for name, bad in layers.quarantine.items():
        found[f"quarantine {name}"] = rows(bad.drop(*silver.ARRIVAL))
    return found


def test_incremental_refresh_equals_whole_rebuild(spark, tmp_path):
    """Corrections, events that move to another user, users without profile, and runs without new files."""
    rng, feeds = random.Random(5), feeds_in(tmp_path)
    for feed in feeds.all():
        sinks.json(spark.range(0), feed.landing)
    whole = f"{tmp_path}/whole"
    deliveries = [([], [], []), (range(25), range(120), range(20)), ([3, 26], range(100, 150), []), ([], [7, 8, 7, 9], [4, 26])]
    for n, (users, events, assignments) in enumerate(deliveries):
        deliver(spark, rng, feeds, users, events, assignments)
        got = incremental.refresh(spark, feeds, f"{tmp_path}/inc", SETTINGS, buckets=8)
        assert shown(got) == shown(medallion.refresh(spark, feeds, whole, SETTINGS)), n
    again = incremental.refresh(spark, feeds, f"{tmp_path}/inc", SETTINGS, buckets=8)
    assert shown(again) == shown(got)
    # the last run had no new files and made no version
    assert versions.Versions(spark, f"{tmp_path}/inc/tables").history() == [3, 4]


@pytest.mark.parametrize("few", [0, 500_000])
def test_merges_order_only_rows_that_meet(spark, tmp_path, monkeypatch, few):
    """A first run orders no table anew, a later one only the stored rows whose key comes again; an event that moves twice
    leaves both users. Shuffling everything, as for many new rows, gives the same tables."""
    monkeypatch.setattr(incremental, "FEW_ROWS", few)
    rng, feeds, ordered = random.Random(9), feeds_in(tmp_path), []
    latest = incremental.dedup.latest

    def counted(df, keys, newest_first):
        if keys == ["event_id"] and "is_post_launch" in df.columns:  # a merge of typed events
            ordered.append(df.count())
        return latest(df, keys, newest_first)

    monkeypatch.setattr(incremental.dedup, "latest", counted)
    deliver(spark, rng, feeds, range(30), range(100), range(30))
    incremental.refresh(spark, feeds, f"{tmp_path}/inc", SETTINGS, buckets=4)
    assert ordered == []
    for to in ("u3", "u4", "u3"):
        land(spark, feeds.events, [(f"m{n}", to, "2026-06-02 00:00:00", "trade", "crypto", "1.00", "s") for n in range(5)])
        got = shown(incremental.refresh(spark, feeds, f"{tmp_path}/inc", SETTINGS, buckets=4))
        assert got == shown(medallion.refresh(spark, feeds, f"{tmp_path}/whole", SETTINGS))
    assert ordered == [5, 10, 10] or few == 0 and min(ordered) > 10
    owners = versions.Versions(spark, f"{tmp_path}/inc/tables").snapshot().read("silver/event_users").where("event_id = 'm0'")
    assert rows(owners, "event_id", "user_id") == [("m0", "u3"), ("m0", "u4")]


def test_a_small_delivery_rewrites_few_files(spark, tmp_path):
    rng, feeds = random.Random(6), feeds_in(tmp_path)
    deliver(spark, rng, feeds, range(200), range(600), range(200))
    incremental.refresh(spark, feeds, f"{tmp_path}/inc", SETTINGS, buckets=16)
    store = versions.Versions(spark, f"{tmp_path}/inc/tables")
    first = store.snapshot()
    land(spark, feeds.events, [("new", "u7", "2026-06-02 00:00:00", "trade", "crypto", "1.00", "s")])
    incremental.refresh(spark, feeds, f"{tmp_path}/inc", SETTINGS, buckets=16)
    second = store.snapshot()
    for name, changed in (("silver/users", 0), ("silver/assignments", 0), ("silver/events", 1), ("silver/event_users", 1),
                          ("gold/user_features", 1), ("gold/users_secure", 0)):
        a, b = first.tables[name].parts, second.tables[name].parts
        assert sum(a.get(part) != folder for part, folder in b.items()) == changed, name
        for folder in set(a.values()) & set(b.values()):
            assert parquet_files(folder)
    adopted = [r.adopted_crypto for r in second.read("gold/user_features").where("user_id = 'u7'").collect()]
    assert adopted == [1]


def test_a_lost_run_is_made_up_for(spark, tmp_path, monkeypatch):
    """The run dies after it has ingested and written, before it commits."""
    rng, feeds = random.Random(7), feeds_in(tmp_path)
    deliver(spark, rng, feeds, range(10), range(40), range(10))
    before = shown(incremental.refresh(spark, feeds, f"{tmp_path}/inc", SETTINGS, buckets=4))
    deliver(spark, rng, feeds, [11], range(30, 60), [11])

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions.Versions, "commit", dies)
        with pytest.raises(RuntimeError, match="lost"):
            incremental.refresh(spark, feeds, f"{tmp_path}/inc", SETTINGS, buckets=4)
    assert shown(incremental.layers(versions.Versions(spark, f"{tmp_path}/inc/tables").snapshot(), feeds)) == {
        **before}
    deliver(spark, rng, feeds, [], range(60, 70), [])
    got = shown(incremental.refresh(spark, feeds, f"{tmp_path}/inc", SETTINGS, buckets=4))
    assert got == shown(medallion.refresh(spark, feeds, f"{tmp_path}/whole", SETTINGS))


def test_other_settings_rebuild_everything(spark, tmp_path):
    rng, feeds = random.Random(8), feeds_in(tmp_path)
    deliver(spark, rng, feeds, range(10), range(60), range(10))
    incremental.refresh(spark, feeds, f"{tmp_path}/inc", SETTINGS, buckets=4)
    later = Settings(launch="2026-06-02", products=("crypto", "etf"))
    got = shown(incremental.refresh(spark, feeds, f"{tmp_path}/inc", later, buckets=2))
    assert got == shown(medallion.refresh(spark, feeds, f"{tmp_path}/whole", later))


def test_counters_last_and_count_once(spark, tmp_path):
    """More micro-batches than a query remembers; a batch that is run again is not counted twice."""
    feed = ingest.Feed("events", "json", f"{tmp_path}/landing", files.EVENTS, {"maxFilesPerTrigger": 1})
    lines = [(f"e{i}", None if i % 7 == 0 else "u1", "2026-05-01 00:00:00", "login", None, None, "s") for i in range(1050)]
    spark.createDataFrame(lines, files.EVENTS).repartition(105).write.json(feed.landing)
    ingest.to_batches(spark, feed, str(tmp_path), silver.EVENT_RULES).awaitTermination()
    numbers = ingest.batch_numbers(spark, str(tmp_path), "events")
    assert len(numbers) > 100
    want = [("events", "valid_event_id", 1050, 0), ("events", "valid_user", 900, 150)]
    assert rows(ingest.rule_counts(spark, str(tmp_path), [feed])) == want
    commits = sorted((tmp_path / "checkpoints/events/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].with_name(f".{commits[-1].name}.crc").unlink()
    commits[-1].unlink()  # as if the driver had died before it could note the last batch
    ingest.to_batches(spark, feed, str(tmp_path), silver.EVENT_RULES).awaitTermination()
    assert rows(ingest.rule_counts(spark, str(tmp_path), [feed])) == want
    assert ingest.batches(spark, str(tmp_path), feed, numbers).count() == 1050
