"""Latest-wins streams, states that merge, as-of exposure, funnels and uplift, against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from liftlab.operators import dedup, experiments, features, mergeable, metrics, reports
from liftlab.sources import versions
from liftlab.streaming import latest
from tests.conftest import rows

START = dt.datetime(2024, 1, 1)


# ---------------------------------------------------------------- streams
def test_latest_wins_in_any_order_of_deliveries(spark, tmp_path):
    rng = random.Random(3)
    schema = "a int, b string, seq int, x string"
    deliveries = [[(rng.randrange(12) or None, rng.choice("pq"), rng.randrange(5), rng.choice("xyz")) for _ in range(25)] for _ in range(4)]
    deliveries.append(deliveries[1])  # delivered again
    store = versions.Versions(spark, f"{tmp_path}/v")
    table = latest.LatestTable(store, "t", ("a", "b"), ("seq",), buckets=4)
    for n, delivery in enumerate(deliveries):
        spark.createDataFrame(delivery, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        table.start(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/c").awaitTermination()
        if n == 1:
            table.merge(spark.createDataFrame(delivery, schema), 1)  # the same batch once more
            assert store.history() == [1, 2]
    everything = spark.createDataFrame([r for d in deliveries for r in d if r[0] is not None], schema)
    assert rows(table.read()) == rows(dedup.latest(everything, ["a", "b"], ["seq"]))
    # the log alone leads to the same table: every key's last entry, and each entry starts where the one before ended
    state, log = {}, sorted(table.changes().collect(), key=lambda r: r.batch)
    for entry in log:
        key = (entry.a, entry.b)
        assert entry.before == state.get(key) and entry.op == ("update" if key in state else "insert")
        assert entry.before != entry.after
        state[key] = entry.after
    assert sorted(map(repr, map(tuple, state.values()))) == sorted(map(repr, rows(table.read())))
    assert {e.batch for e in log} <= {0, 1, 2, 3} and table.changes(after=3).count() == 0


# ---------------------------------------------------------------- mergeable totals
def activity(spark, seed=4, n=300):
    rng = random.Random(seed)
    lines = [(i, f"u{rng.randrange(9)}", START + dt.timedelta(hours=rng.randrange(24 * 90)),
              rng.choice(["trade", "deposit", "login"]), rng.choice([None, 1.25, 7.5]), rng.choice([None, "s1", "s2", "s3"]),
              rng.choice([True, False, False, None])) for i in range(n)]
    return spark.createDataFrame(lines, "event_id int, user_id string, event_ts timestamp_ntz, event_type string, "
                                        "amount_usd double, session_id string, is_post_launch boolean")


def test_states_merge_in_any_grouping(spark):
    events = activity(spark)
    want = rows(features.behavior(events), *features.behavior(events).columns)
    a, b, c = (mergeable.state(events.where(F.col("event_id") % 3 == k)) for k in range(3))
    for merged in (mergeable.merge(a, b, c), mergeable.merge(c, mergeable.merge(b, a))):
        assert rows(mergeable.totals(merged), *features.behavior(events).columns) == want


def test_a_delivery_is_absorbed_once_into_few_buckets(spark, tmp_path):
    events, store = activity(spark), versions.Versions(spark, f"{tmp_path}/v")
    stored = mergeable.StoredTotals(store, buckets=8)
    assert stored.absorb(events.where("event_id < 200"), "one") and not stored.absorb(events, "one")
    assert stored.absorb(events.where("event_id >= 200 AND user_id = 'u3'"), "two")
    old, new = (store.snapshot(v).tables["months"].parts for v in (1, 2))
    assert sum(old.get(part) != folder for part, folder in new.items()) == 1
    seen = events.where("event_id < 200 OR user_id = 'u3'")
    assert rows(stored.totals()) == rows(features.behavior(seen).select(stored.totals().columns))


def test_state_is_small_before_it_is_shuffled(spark):
    plan = mergeable.state(activity(spark)).months._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and plan.count("Exchange") == 1


# ---------------------------------------------------------------- as-of exposure
def test_asof_exposure_equals_brute_force(spark):
    rng = random.Random(5)
    moment = lambda: START + dt.timedelta(hours=rng.randrange(24 * 12))
    given = [(rng.choice(["e1", "e2"]), rng.choice(["crypto", "etf", None]), rng.choice(["u1", "u2", "u3", None]),
              rng.choice(["control", "treatment"]), rng.choice([moment(), None])) for _ in range(60)]
    events = [(i, rng.choice(["u1", "u2", "u3", "u4", None]), rng.choice([moment(), None, given[i % 60][4]]), "trade",
               rng.choice(["crypto", "etf", None])) for i in range(300)]
    want = []
    for i, user, at, kind, product in events:
        if user and at and product:
            found = [(t, e, v) for e, p, u, v, t in given if u == user and p == product and t is not None and t <= at]
            if found and at < max(found)[0] + dt.timedelta(days=2):
                t, e, v = max(found)
                want.append((i, user, at, kind, product, e, v, t))
    got = experiments.asof_exposure(
        spark.createDataFrame(events, "event_id int, user_id string, event_ts timestamp_ntz, event_type string, product string"),
        spark.createDataFrame(given, "experiment_id string, product string, user_id string, variant string, assigned_ts timestamp_ntz"), 2)
    assert rows(got) == sorted(want, key=repr)


# ---------------------------------------------------------------- funnels
def paths():
    rng = random.Random(1)
    minutes = lambda u: rng.randrange(0, 600) if u < 40 else rng.randrange(0, 3) * 50
    return [(n, f"u{u}", START + dt.timedelta(minutes=minutes(u)), rng.choice("abc"))
            for u in range(60) for n in range(rng.randrange(0, 14 if u < 40 else 8))]


def furthest(events, steps, within):
    """The most steps that any choice of different events in time order does."""
    best = 0

    def go(done, at, used, began):
        nonlocal best
        best = max(best, done)
        if done < len(steps):
            for i, (_, _, when, kind) in enumerate(events):
                if i not in used and kind == steps[done] and (at is None or when >= at) \
                        and (within is None or began is None or when <= began + within):
                    go(done + 1, when, used | {i}, began or when)

    go(0, None, frozenset(), None)
    return best


@pytest.mark.parametrize("steps", ["abc", "aba", "bbba"])
@pytest.mark.parametrize("within, span", [(None, None), ("60 MINUTES", dt.timedelta(minutes=60)), ("3 HOURS", dt.timedelta(hours=3))])
def test_funnel_equals_brute_force(spark, steps, within, span):
    lines = paths()
    df = spark.createDataFrame(lines, "event_id int, user_id string, event_ts timestamp_ntz, event_type string")
    done = [furthest([r for r in lines if r[1] == u], steps, span) for u in {r[1] for r in lines}]
    got = reports.funnel(df, list(steps), within=within).orderBy("step_no").collect()
    assert [r.users for r in got] == [sum(d >= j for d in done) for j in range(1, len(steps) + 1)]


def test_one_event_is_one_step(spark):
    df = spark.createDataFrame([(1, "u", START, "view")], "event_id int, user_id string, event_ts timestamp_ntz, event_type string")
    assert [(r.users, r.pct_of_first) for r in reports.funnel(df, ["view", "view"]).orderBy("step_no").collect()] == [(1, 100.0), (0, 0.0)]
    assert [(r.users, r.pct_of_first) for r in reports.funnel(df.limit(0), ["view", "view"]).collect()] == [(0, None), (0, None)]


# ---------------------------------------------------------------- uplift
def test_uplift_equals_brute_force(spark):
    rng = random.Random(8)
    lines = [(g, rng.choice([rng.randrange(8) / 8, rng.random(), None, float("nan")]), rng.choice(["treatment", "control", None]),
              rng.choice([0, 1, 1, None])) for g in ("p", "q", None) for _ in range(90)]
    lines += [("only treated", 0.5, "treatment", 1)] * 3
    df = spark.createDataFrame(lines, "g string, s double, v string, y int")
    got = {(r.g, r.part): tuple(r)[2:] for r in metrics.uplift_curve(df, "s", "v", "y", ["g"], 5, 10.0, 2.0).collect()}
    areas = {r.g: r.qini for r in metrics.qini(df, "s", "v", "y", ["g"]).collect()}
    for group in ("p", "q", None, "only treated"):
        own = [r for r in lines if r[0] == group and r[1] is not None and r[1] == r[1] and r[2] and r[3] is not None]
        curve, area = [], 0.0
        for score in sorted({r[1] for r in own}, reverse=True):
            top = [r for r in own if r[1] >= score]
            t, c = ([r[3] for r in top if r[2] == arm] for arm in ("treatment", "control"))
            gain = sum(t) - sum(c) * len(t) / len(c) if t and c else 0.0
            before = curve[-1] if curve else (0, 0.0)
            area += (gain + before[1]) / 2 * (len(top) - before[0]) / len(own)
            curve.append((len(top), gain, t, c))
        for part in range(1, 6):
            n, gain, t, c = next(p for p in curve if p[0] * 5 >= part * len(own))
            treated, control, y_t, y_c, uplift, incremental, roi = got[group, part]
            assert (treated, control, y_t, y_c) == (len(t), len(c), sum(t), sum(c))
            assert incremental == pytest.approx(gain, abs=1e-4)
            if t and c:
                assert uplift == pytest.approx(100 * (sum(t) / len(t) - sum(c) / len(c)), abs=1e-4)
                assert roi == pytest.approx(100 * (gain * 10 - len(t) * 2) / (len(t) * 2), abs=1e-2)
            else:
                assert uplift is None and roi is None
        assert areas[group] == pytest.approx((area - curve[-1][1] / 2) / len(own), abs=1e-6)
    whole = metrics.uplift_curve(df, "s", "v", "y", groups=4)
    assert sorted(r.part for r in whole.collect()) == [1, 2, 3, 4]
