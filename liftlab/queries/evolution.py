"""Tables that change: versions, incremental refresh, latest-wins streams, states that merge; and questions over time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from liftlab import session
from liftlab.operators import experiments, mergeable, metrics, privacy, quality, reports, serving, silver, sinks
from liftlab.plans import incremental
from liftlab.queries import inputs, sql
from liftlab.queries.movement import DELIVERED, SETTINGS, event_feed, make_feeds
from liftlab.queries.registry import query
from liftlab.sources import drift, files, roles, versions
from liftlab.streaming import ingest, latest

PRODUCTS = inputs.PRODUCTS


# ---------------------------------------------------------------- versions
@query("table_versions", sql.select(sql.RESULTS, """
select 1 as version, product, variant, users, 0::bigint as adopters from results
union all select 2, product, variant, users, adopters from results"""))
def table_versions(spark, sf):
    """A table before and after it is replaced, read side by side; a third write is lost before it is committed."""
    path = session.fresh_path(spark, "versions")
    results = inputs.results(spark, sf).select("product", "variant", "users", "adopters")
    first = sinks.replace(results.drop("adopters"), path)
    sinks.replace(results, path)
    versions.Versions(spark, path).whole("table", results.where("product <> 'options'"))
    return first.withColumn("adopters", F.lit(0).cast("bigint")).select(F.lit(1).alias("version"), "*").unionByName(
        sinks.replaced(spark, path).select(F.lit(2).alias("version"), "*"))


# ---------------------------------------------------------------- incremental refresh
_MOVED = sql.EVENTS.replace("ev as (", "ev1 as (") + """,
ev as (
 select * replace (case when event_id % 97 = 5 then user_id + 1 else user_id end as user_id,
  cast(cast(amount_usd as decimal(18,2)) + case when event_type = 'deposit' then 1.00 else 0.00 end as double) as amount_usd)
 from ev1)"""
_LATEST_ASSIGN = sql.BRONZE_ASSIGN.replace("assign as (", "assign0 as (", 1).replace("from assign", "from assign0") + """,
assign as (
 select experiment_id, product, user_id, variant, assigned_ts from bronze_assign
 qualify row_number() over (partition by experiment_id, user_id order by ingest_seq desc) = 1)"""
_COLUMNS = ["user_id", "tier", "tenure_days", "events_total", "trades_total", "logins_total", "deposit_total_usd", "sessions_total",
            "active_days", *(f"{c}_{p}{s}" for p in PRODUCTS for c, s in (("pre", "_interactions"), ("adopted", ""), ("variant", "")))]
_CHANGED = sql.FEATURES.replace(sql.EVENTS, _MOVED).replace(sql.ASSIGN, _LATEST_ASSIGN)


def _three_runs(spark, sf):
    """All tables in three deliveries: most events, then the rest with corrected deposits and swapped variants, then
    events that belong to another user than was said first."""
    base = session.fresh_path(spark, "incremental")
    feeds = make_feeds(spark, base)
    events = roles.landed_events(spark, sf)
    swapped = roles.bronze_assignments(spark, sf).withColumn("assigned_ts", F.substring(F.col("assigned_ts").cast("string"), 1, 19))

    def land(frame, feed):
        writer = frame.write.mode("append")
        writer.json(feed.landing) if feed.fmt == "json" else writer.options(header=True, **sinks.TEXT_TIMES).csv(feed.landing)

    def assigned(seq):
        return swapped.where(F.col("ingest_seq") == seq).select("experiment_id", "product", "user_id", "variant", "assigned_ts")

    corrected = events.where("event_type = 'deposit'").withColumn(
        "amount_usd", F.expr("CAST(CAST(amount_usd AS DECIMAL(18,2)) + 1.00 AS STRING)"))
    paid = events.where("event_type <> 'deposit'").unionByName(corrected)
    moved = paid.where("event_id % 97 = 5").withColumn("user_id", F.col("user_id") + 1)
    for deliveries in (
            [(roles.users(spark, sf), feeds.users), (assigned(0), feeds.assignments), (roles.catalog(spark), feeds.catalog),
             (events.where("event_id % 4 <> 0"), feeds.events)],
            [(events.where("event_id % 4 = 0 AND event_type <> 'deposit'").unionByName(corrected), feeds.events),
             (assigned(1), feeds.assignments)],
            [(moved, feeds.events)]):
        for frame, feed in deliveries:
            land(frame, feed)
        layers = incremental.refresh(spark, feeds, base, SETTINGS, buckets=session.shuffle_partitions(spark))
    return layers


@query("incremental_refresh", sql.select(_CHANGED, f"select {', '.join(_COLUMNS)} from feats"))
def incremental_refresh(spark, sf):
    """Gold after three runs, each of which rebuilt only the users it touched."""
    return _three_runs(spark, sf).features.select(F.col("user_id").cast("bigint"), *_COLUMNS[1:])


_CHANGED_RESULTS = (sql.RESULTS.replace(sql.EVENTS, _MOVED).replace(sql.ASSIGN, _LATEST_ASSIGN))


@query("incremental_results", sql.select(_CHANGED_RESULTS, "select * from results"))
def incremental_results(spark, sf):
    """Experiment results kept up to date by the differences of the touched users."""
    return _three_runs(spark, sf).results


# ---------------------------------------------------------------- streams
@query("stream_rule_counts", sql.select(sql.BRONZE_EVENTS, """
select 'events' as feed, rule, count(*) filter (ok) as passed, count(*) filter (not ok) as failed from (
 select 'valid_event_id' as rule, event_id is not null as ok from bronze
 union all select 'valid_user', user_id is not null from bronze
 union all select 'readable_time', event_ts is null or try_cast(event_ts as timestamp) is not null from bronze
 union all select 'finite_amount', amount_usd is null or try_cast(amount_usd as double) is not null from bronze)
group by rule"""))
def stream_rule_counts(spark, sf):
    """Counters stored with each of several micro-batches; a test runs more of them than a query remembers."""
    base = session.fresh_path(spark, "lasting-counts")
    feed = event_feed(base, maxFilesPerTrigger=1)
    sinks.json(roles.bronze_events(spark, sf).drop("ingest_seq"), feed.landing, files=6)
    ingest.to_batches(spark, feed, base, {**silver.EVENT_RULES, **silver.EVENT_WARNINGS}).awaitTermination()
    return ingest.rule_counts(spark, base, [feed])


def _out_of_order(spark, sf) -> latest.LatestTable:
    """Half of the first deliveries, then all corrections, then the other half of the first deliveries."""
    base = session.fresh_path(spark, "stream-latest")
    table = latest.LatestTable(versions.Versions(spark, f"{base}/tables"), "events", ("event_id",), ("ingest_seq",),
                               session.shuffle_partitions(spark))
    bronze = quality.expect_or_drop(roles.bronze_events(spark, sf), silver.EVENT_RULES)
    for part in ("ingest_seq = 0 AND event_id % 2 = 0", "ingest_seq = 1", "ingest_seq = 0 AND event_id % 2 = 1"):
        bronze.where(part).write.mode("append").parquet(f"{base}/landing")
        table.start(spark.readStream.schema(bronze.schema).parquet(f"{base}/landing"), f"{base}/checkpoint").awaitTermination()
    return table


@query("stream_latest", sql.select(sql.BRONZE_EVENTS, f"""
select {DELIVERED}, ingest_seq from bronze where event_id is not null and user_id is not null
qualify row_number() over (partition by event_id order by ingest_seq desc) = 1"""))
def stream_latest(spark, sf):
    """The newest delivery per event, kept by a stream whose deliveries come out of order."""
    return _out_of_order(spark, sf).read()


@query("stream_change_log", sql.select(sql.BRONZE_EVENTS, """
select case when ingest_seq = 1 then 1 when event_id % 2 = 0 then 0 else 2 end::bigint as batch,
 case when ingest_seq = 1 and event_id % 2 = 0 then 'update' else 'insert' end as op, event_id,
 case when ingest_seq = 1 and event_id % 2 = 0 then first_amount end as amount_before, amount_usd as amount_after
from (select *, first_value(amount_usd) over (partition by event_id order by ingest_seq) as first_amount from bronze
 where event_id is not null and user_id is not null)
where ingest_seq = 1 or event_id % 2 = 0 or event_type <> 'trade'"""))
def stream_change_log(spark, sf):
    """What each micro-batch changed; an older delivery that comes late changes nothing."""
    return _out_of_order(spark, sf).changes().select(
        "batch", "op", "event_id", F.col("before.amount_usd").alias("amount_before"), F.col("after.amount_usd").alias("amount_after"))


@query("mergeable_totals", sql.select(f"{sql.EVENTS}, {sql.TOTALS}", "select * from totals"))
def mergeable_totals(spark, sf):
    """Behaviour totals from the states of three deliveries; one of them is delivered twice."""
    stored = mergeable.StoredTotals(
        versions.Versions(spark, session.fresh_path(spark, "totals")), session.shuffle_partitions(spark))
    events = roles.events(spark, sf)
    for part in (0, 1, 1, 2):
        stored.absorb(events.where(F.col("event_id") % 3 == part), f"part-{part}")
    return stored.totals()


# ---------------------------------------------------------------- experiments and reports
_TWO_WAVES = f"""{sql.ASSIGN},
waves as (
 select experiment_id, product, user_id, variant, assigned_ts from assign
 union all select 'second_' || experiment_id, product, user_id, case variant when 'control' then 'treatment' else 'control' end,
  assigned_ts + interval 60 hours from assign where user_id % 3 = 0)"""


def _two_waves(spark, sf) -> DataFrame:
    first = roles.silver_assignments(spark, sf)
    second = first.where("user_id % 3 = 0").withColumns({
        "experiment_id": F.concat(F.lit("second_"), "experiment_id"),
        "variant": F.expr("IF(variant = 'control', 'treatment', 'control')"),
        "assigned_ts": F.expr("assigned_ts + INTERVAL 60 HOURS")})
    return first.unionByName(second)


@query("asof_exposure", sql.select(f"{sql.EVENTS}, {_TWO_WAVES}", """
select * from (
 select event_id, ev.user_id, event_ts, event_type, ev.product, experiment_id, variant, assigned_ts
 from ev join waves on ev.user_id = waves.user_id and ev.product = waves.product and event_ts >= assigned_ts
 qualify row_number() over (partition by event_id order by assigned_ts desc, experiment_id desc, variant desc) = 1)
where event_ts < assigned_ts + interval 7 days"""))
def asof_exposure(spark, sf):
    """Events under the assignment in force, where a third of the users are assigned twice."""
    return experiments.asof_exposure(roles.events(spark, sf), _two_waves(spark, sf), 7)


_VIEWS = """, seen as (select * from ev where product = 'crypto' or product is null),
views as (select user_id, event_ts, row_number() over (partition by user_id order by event_ts) as n from seen
 where event_type = 'view_product')"""


@query("funnel_repeated", sql.select(sql.EVENTS, f"""{_VIEWS},
r as (select (select count(*) from views where n = 1) as n0, (select count(*) from views where n = 2) as n1,
 (select count(distinct seen.user_id) from seen join views on views.user_id = seen.user_id and n = 2
  where event_type = 'trade' and seen.event_ts >= views.event_ts) as n2)
select 1 as step_no, 'view_product' as step, n0 as users, {sql.pct('n0', 'n0')} as pct_of_first from r
union all select 2, 'view_product', n1, {sql.pct('n1', 'n0')} from r
union all select 3, 'trade', n2, {sql.pct('n2', 'n0')} from r"""))
def funnel_repeated(spark, sf):
    """A step that is asked for twice needs two events."""
    return reports.funnel(roles.events(spark, sf), ["view_product", "view_product", "trade"], "crypto")


@query("funnel_window", sql.select(sql.EVENTS, f"""
, seen as (select * from ev where product = 'crypto' or product is null),
a as (select user_id, event_ts as t from seen where event_type = 'login'),
b as (select distinct a.user_id, a.t, seen.event_ts as v from a join seen on seen.user_id = a.user_id
 and event_type = 'view_product' and event_ts >= t and event_ts <= t + interval 36 hours),
c as (select distinct b.user_id from b join seen on seen.user_id = b.user_id
 and event_type = 'trade' and event_ts >= v and event_ts <= t + interval 36 hours),
r as (select (select count(distinct user_id) from a) as n0, (select count(distinct user_id) from b) as n1, (select count(*) from c) as n2)
select 1 as step_no, 'login' as step, n0 as users, {sql.pct('n0', 'n0')} as pct_of_first from r
union all select 2, 'view_product', n1, {sql.pct('n1', 'n0')} from r
union all select 3, 'trade', n2, {sql.pct('n2', 'n0')} from r"""))
def funnel_window(spark, sf):
    """Users that convert within 36 hours of a login, whichever of their logins that is."""
    return reports.funnel(roles.events(spark, sf), ["login", "view_product", "trade"], "crypto", within="36 HOURS")


def _arms(spark, sf) -> DataFrame:
    """(product, user_id, score, variant, adopted); scores with three digits, so that many are equal."""
    wide = roles.closed_form_scores(inputs.user_features(spark, sf), keep=[
        "user_id", *(f"adopted_{p}" for p in PRODUCTS), *(f"variant_{p}" for p in PRODUCTS)])
    long = experiments.by_product(wide, PRODUCTS, ["user_id"], score="prob_{}", variant="variant_{}", adopted="adopted_{}")
    return long.withColumn("score", F.floor(F.col("score") * 1000) / 1000)


_ARMS = sql.SCORES + ",\narms as (" + " union all ".join(
    f"select '{p}' as product, floor(prob_{p} * 1000) / 1000 as score, variant_{p} = 'treatment' as t, adopted_{p} as y from scores"
    for p in PRODUCTS) + """),
per_score as (
 select product, score, count(*) filter (t) as n_t, count(*) filter (t and y = 1) as y_t, count(*) filter (not t) as n_c,
  count(*) filter (not t and y = 1) as y_c from arms group by product, score),
curve as (
 select product, score, n_t + n_c as width, sum(n_t) over w as n_t, sum(y_t) over w as y_t, sum(n_c) over w as n_c,
  sum(y_c) over w as y_c, sum(n_t + n_c) over w as upto, sum(n_t + n_c) over (partition by product) as n
 from per_score window w as (partition by product order by score desc)),
gained as (
 select *, case when n_t > 0 and n_c > 0 then y_t::double - y_c::double * n_t::double / n_c::double else 0 end as g from curve)"""


@query("uplift_curve", sql.select(_ARMS, f"""
, ends as (
 select g.*, cast(part as int) as part from gained g, unnest(range(1, 11)) as p(part)
 where 10 * upto >= part * n and 10 * (upto - width) < part * n)
select product, part, n_t::bigint as treated, n_c::bigint as control, y_t::bigint as adopters_treated, y_c::bigint as adopters_control,
 case when n_t > 0 and n_c > 0 then {sql.half_up("(y_t::double / n_t::double - y_c::double / n_c::double) * 100.0::double", 4)} end as uplift_pp,
 {sql.half_up("g", 4)} as incremental,
 case when n_t > 0 and n_c > 0 then {sql.half_up(
    "(g * 25.0::double - n_t::double * 2.0::double) * 100.0::double / (n_t::double * 2.0::double)", 2)} end as roi_pct
from ends"""))
def uplift_curve(spark, sf):
    """Incremental adopters and return of targeting the best tenths, treatment against control, per product."""
    return metrics.uplift_curve(_arms(spark, sf), "score", "variant", "adopted", ["product"], value_usd=25.0, cost_usd=2.0)


@query("qini", sql.select(_ARMS, f"""
, steps as (
 select *, coalesce(lag(g) over (partition by product order by score desc), 0) as g0 from gained)
select product, {sql.half_up(
    sql.exact_sum("(g + g0) * width::double / (n::double * n::double * 2.0::double)")
    + " - max(case when upto = n then g / (n::double * 2.0::double) end)", 6)} as qini
from steps group by product"""))
def qini(spark, sf):
    """One number per product: how much better than at random the score finds users whom treatment moves."""
    return metrics.qini(_arms(spark, sf), "score", "variant", "adopted", ["product"])


# ---------------------------------------------------------------- schema drift
def _feed() -> StructType:
    return StructType.fromDDL(
        "event_id BIGINT, user_id BIGINT, event_ts STRING, event_type STRING, amount_usd INT, session_id STRING")


def _drifting(spark, sf):
    """Half of the events in the feed's columns; in the other half amounts have a fraction, some ids are no numbers, a
    field is new and one is missing."""
    base = session.fresh_path(spark, "drift")
    landed = roles.landed_events(spark, sf).withColumn("amount", F.col("amount_usd").cast("double"))
    landed.where("event_id % 2 = 0").select(
        "event_id", "user_id", "event_ts", "event_type", F.floor("amount").cast("int").alias("amount_usd"), "session_id").write.json(f"{base}/one")
    landed.where("event_id % 2 = 1").select(
        F.when(F.col("event_id") % 10 == 1, F.concat(F.lit("E-"), "event_id")).otherwise(F.col("event_id").cast("string")).alias("event_id"),
        "user_id", "event_ts", "event_type", (F.floor("amount") + 0.5).alias("amount_usd"), F.lit("web").alias("channel")).write.json(f"{base}/two")
    return base, files.infer_schema(spark, f"{base}/two", "json")


@query("schema_drift_report", """
select * from (values ('event_id', 'wider', 'bigint', 'string'), ('amount_usd', 'wider', 'int', 'double'),
 ('session_id', 'missing', 'string', null), ('channel', 'added', null, 'string')) t("column", change, feed_type, delivered_type)
where (select count(*) from events) > 0""")
def schema_drift_report(spark, sf):
    """What the second delivery's fields, read from its files, change."""
    return drift.report(spark, drift.compare(_feed(), _drifting(spark, sf)[1]))


@query("schema_drift", sql.select(sql.EVENTS, """
select case when event_id % 10 <> 1 then event_id end as event_id, user_id, event_type,
 case when amount_usd is null then null when event_id % 2 = 0 then floor(cast(amount_usd as decimal(18,2)))::double
  else floor(cast(amount_usd as decimal(18,2)))::double + 0.5 end as amount_usd,
 case when event_id % 2 = 0 then session_id end as session_id,
 case when event_id % 10 = 1 then '{"channel":"web","event_id":"E-' || event_id || '"}'
  when event_id % 2 = 1 then '{"channel":"web"}' end as rescued from ev"""))
def schema_drift(spark, sf):
    """Both deliveries through one stream, under a schema with the wider amounts but the feed's own ids."""
    base, delivered = _drifting(spark, sf)
    wider = drift.evolve(_feed(), StructType([f for f in delivered.fields if f.name != "event_id"]))
    feed = ingest.Feed("events", "json", f"{base}/*", wider)
    ingest.append(ingest.open_rescued(spark, feed), f"{base}-out", f"{base}-checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}-out").select(
        "event_id", "user_id", "event_type", "amount_usd", "session_id", F.col(drift.RESCUED).alias("rescued"))


# ---------------------------------------------------------------- serving and catalog
@query("product_index", sql.select(sql.RECS, """
select recommended_product, rank::int as rank, user_id, propensity_score from (
 select *, row_number() over (partition by recommended_product order by propensity_score desc, user_id) as rank from recs)
where rank <= 5"""))
def product_index(spark, sf):
    """The five best prospects of each product, from the layout by product and score and its file index."""
    store = versions.Versions(spark, session.fresh_path(spark, "by-product"))
    recs = inputs.recommendations(spark, sf).select("recommended_product", "propensity_score", "user_id", "tier", "targeting_decile")
    ready = serving.export_ranked(recs, store, "prospects", rows_a_file=500)
    tops = [serving.top_of_group(ready, "prospects", p, 5).withColumn("rank", F.monotonically_increasing_id().cast("int") + 1) for p in PRODUCTS]
    return reduce(DataFrame.unionByName, tops).select("recommended_product", "rank", "user_id", "propensity_score")


@query("table_metadata", sql.select(sql.USERS, """
select * from (select 'table comment' as kind, '' as name, 'one row per user' as value union all
 select 'column comment', 'user_id', 'the key' union all select 'tag', 'layer', 'gold' union all select 'tag', 'email.pii', 'masked'
 union all select 'rows', '', cast(count(*) as varchar) from users)"""))
def table_metadata(spark, sf):
    """Comments and tags of a materialised table, read back from the catalog, and its rows."""
    path = session.fresh_path(spark, "materialised")
    table = f"users_{path.rsplit('-', 1)[1]}"
    stored = sinks.materialize(privacy.secure_view(roles.users(spark, sf)), table, path, "one row per user",
                               {"user_id": "the key"}, {"layer": "gold", "email.pii": "masked"})
    tags = spark.sql(f"SHOW TBLPROPERTIES {table}").where("key IN ('layer', 'email.pii')").selectExpr("'tag' AS kind", "key AS name", "value")
    described = spark.sql(f"DESCRIBE EXTENDED {table}")
    comment = described.where("col_name = 'Comment'").selectExpr("'table comment' AS kind", "'' AS name", "data_type AS value")
    columns = described.where("col_name = 'user_id'").selectExpr("'column comment' AS kind", "col_name AS name", "comment AS value")
    counted = sinks.row_count(stored).selectExpr("'rows' AS kind", "'' AS name", "CAST(rows AS STRING) AS value")
    return reduce(DataFrame.unionByName, [tags, comment, columns, counted])


@query("nan_export", sql.select(sql.SCORES, """
select user_id, case when user_id % 7 <> 0 then prob_crypto end as prob_crypto, prob_options from scores"""))
def nan_export(spark, sf):
    """Scores that are no numbers leave the export as NULL."""
    path = session.fresh_path(spark, "nan-export")
    table = f"scores_{path.rsplit('-', 1)[1]}"
    scores = inputs.scored(spark, sf).selectExpr(
        "user_id", "IF(user_id % 7 = 0, double('NaN'), prob_crypto) AS prob_crypto", "prob_options")
    serving.export_clustered(scores, table, path, buckets=session.shuffle_partitions(spark))
    return spark.table(table)


@query("ordered_results", sql.select(sql.RESULTS, """
select row_number() over (order by product, variant)::int as position, product, variant, adoption_rate_pct from results"""))
def ordered_results(spark, sf):
    """Results in the order of a report, with the place of each row."""
    return reports.in_order(inputs.results(spark, sf), ["product", "variant"]).select(
        "position", "product", "variant", "adoption_rate_pct")


@query("first_keys", sql.select(sql.NUDGED, f"select {sql.SERVING_COLUMNS} from nudged order by user_id limit 5"))
def first_keys(spark, sf):
    """The first exported rows by key."""
    return inputs.nudged(spark, sf).select(*serving.columns(PRODUCTS)).orderBy("user_id").limit(5)


@query("ingest_stamp", sql.select(sql.EVENTS, """
select count(*) as rows, count(*) as stamped, 2 as batches, 4 as files, true as in_order from ev"""))
def ingest_stamp(spark, sf):
    """Two runs: every row has the time of its batch, which is later in the second, and its file."""
    base = session.fresh_path(spark, "stamps")
    feed = event_feed(base)
    landed = roles.landed_events(spark, sf)
    for odd in (0, 1):
        landed.where(F.col("event_id") % 2 == odd).repartition(2).write.mode("append").json(feed.landing)
        ingest.run_once(spark, [feed], base)
    second = F.col("event_id").cast("long") % 2 == 1
    return ingest.bronze(spark, base, feed).agg(
        F.count("*").alias("rows"), F.count_if(F.col("_ingested_at").isNotNull() & F.col("_file_time").isNotNull()
                                               & F.col("_source_file").contains(feed.landing.removeprefix("file:"))).alias("stamped"),
        F.countDistinct("_ingested_at").cast("int").alias("batches"), F.countDistinct("_source_file").cast("int").alias("files"),
        (F.max(F.when(~second, F.col("_ingested_at"))) < F.min(F.when(second, F.col("_ingested_at")))).alias("in_order"))
