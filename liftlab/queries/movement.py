"""Streaming ingest, refresh, sinks, serving, models and the later extras."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from liftlab import session
from liftlab.operators import (dedup, experiments, features, metrics, ml, recommend, reports, serving,
                               sessions, silver, sinks, targeting)
from liftlab.plans import medallion, next_offer
from liftlab.queries import inputs, sql
from liftlab.queries.registry import query
from liftlab.settings import CATALOG_SCHEMA
from liftlab.sources import files, roles
from liftlab.streaming import ingest

PRODUCTS = inputs.PRODUCTS
SETTINGS = inputs.SETTINGS

_LANDED = ("event_id, user_id, substr(cast(event_ts as varchar), 1, 19) as event_ts, event_type, product, "
           "cast(cast(amount_usd as decimal(18,2)) as varchar) as amount_usd, session_id")


# ---------------------------------------------------------------- streaming
DELIVERED = "event_id, user_id, event_ts, event_type, product, amount_usd, session_id"


def event_feed(base: str, **options: object) -> ingest.Feed:
    return ingest.Feed("events", "json", f"{base}/landing/events", files.EVENTS, options)


def numbered(events):
    """Landed events with their keys, which are text in a landing table, as the numbers they were."""
    return events.select(*roles.EVENT_COLUMNS).withColumns({
        c: F.col(c).cast("bigint") for c in ("event_id", "user_id")})


@query("stream_ingest", sql.select(sql.EVENTS, f"select {_LANDED} from ev"))
def stream_ingest(spark, sf):
    """JSON files to bronze; the second run finds nothing new and must add nothing."""
    base = session.fresh_path(spark, "ingest")
    feed = event_feed(base)
    sinks.json(roles.landed_events(spark, sf), feed.landing)
    ingest.run_once(spark, [feed], base)
    ingest.run_once(spark, [feed], base)
    return numbered(ingest.bronze(spark, base, feed))


@query("stream_csv_ingest", sql.select(sql.USERS, f"select {sql.PROFILE}, email, account_ref from users"))
def stream_csv_ingest(spark, sf):
    """CSV with header to bronze, under a schema inferred once from the files."""
    base = session.fresh_path(spark, "csv-ingest")
    landing = f"{base}/landing/users"
    sinks.csv(roles.users(spark, sf), landing)
    feed = ingest.Feed("users", "csv", landing, files.infer_schema(spark, landing, "csv"))
    ingest.run_once(spark, [feed], base)
    return ingest.bronze(spark, base, feed).drop(*silver.ARRIVAL, files.CORRUPT)


_SWAPPED = sql.LONG.replace(
    sql.ASSIGN, sql.BRONZE_ASSIGN.replace("assign as (", "assign0 as (", 1).replace(
        "from assign", "from assign0") + """,
assign as (
 select experiment_id, product, user_id, variant, assigned_ts from bronze_assign
 qualify row_number() over (partition by experiment_id, user_id order by ingest_seq desc) = 1)""")
_REFRESHED = _SWAPPED + sql.RESULTS[len(sql.LONG):]


@query("stream_refresh", sql.select(_REFRESHED, "select * from results"))
def stream_refresh(spark, sf):
    """Three feeds to gold, then a second delivery with corrections and a second refresh."""
    base = session.fresh_path(spark, "refresh")
    feeds = medallion.Feeds(
        ingest.Feed("users", "csv", f"{base}/landing/users", files.USERS),
        event_feed(base),
        ingest.Feed("assignments", "csv", f"{base}/landing/assignments", files.ASSIGNMENTS))
    swapped = roles.bronze_assignments(spark, sf).withColumn(
        "assigned_ts", F.substring(F.col("assigned_ts").cast("string"), 1, 19))
    order = ["experiment_id", "product", "user_id", "variant", "assigned_ts"]
    sinks.csv(roles.users(spark, sf), feeds.users.landing)
    sinks.json(roles.landed_events(spark, sf), feeds.events.landing)
    sinks.csv(swapped.where("ingest_seq = 0").select(*order), feeds.assignments.landing)
    medallion.refresh(spark, feeds, base, SETTINGS)
    trades = roles.landed_events(spark, sf).where("event_type = 'trade'")
    trades.write.mode("append").json(feeds.events.landing)
    (swapped.where("ingest_seq = 1").select(*order)
     .write.mode("append").option("header", True).csv(feeds.assignments.landing))
    return medallion.refresh(spark, feeds, base, SETTINGS).results


def _prefixed(df, **keys):
    return df.withColumns({c: F.concat(F.lit(prefix), F.col(c).cast("string")) for c, prefix in keys.items()})


def make_feeds(spark, base) -> medallion.Feeds:
    """All four feeds; their landing folders exist, also where nothing is delivered."""
    feeds = medallion.Feeds(
        ingest.Feed("users", "csv", f"{base}/landing/users", files.USERS), event_feed(base),
        ingest.Feed("assignments", "csv", f"{base}/landing/assignments", files.ASSIGNMENTS),
        ingest.Feed("catalog", "json", f"{base}/landing/catalog", CATALOG_SCHEMA))
    for feed in feeds.all():
        sinks.json(spark.range(0), feed.landing)  # no rows, and so no line
    return feeds


def _land_users(spark, sf, feeds, **keys):
    users = _prefixed(roles.users(spark, sf), **keys)
    users.write.mode("append").options(header=True, **sinks.TEXT_TIMES).csv(feeds.users.landing)
    assigned = _prefixed(roles.silver_assignments(spark, sf), **keys).withColumn(
        "assigned_ts", F.substring(F.col("assigned_ts").cast("string"), 1, 19))
    (assigned.select("experiment_id", "product", "user_id", "variant", "assigned_ts")
     .write.mode("append").option("header", True).csv(feeds.assignments.landing))


@query("landing_string_keys", sql.select(sql.FEATURES, f"""
, paid as (select user_id, {sql.money("cast(amount_usd as decimal(18,2)) + 1.00::decimal(18,2)")} as paid from ev
  where event_type = 'deposit' and not is_post_launch group by user_id)
select 'U-' || feats.user_id as user_id, events_total, trades_total, sessions_total,
 coalesce(paid, 0) as deposit_total_usd, adopted_crypto, variant_options
from feats left join paid on paid.user_id = feats.user_id"""))
def landing_string_keys(spark, sf):
    """Keys that are no numbers, through a whole refresh; all deposits are then corrected by a
    second delivery."""
    base = session.fresh_path(spark, "string-keys")
    feeds = make_feeds(spark, base)
    _land_users(spark, sf, feeds, user_id="U-")
    roles.catalog(spark).write.mode("append").json(feeds.catalog.landing)
    events = _prefixed(roles.landed_events(spark, sf), event_id="E-", user_id="U-")
    events.write.mode("append").json(feeds.events.landing)
    medallion.refresh(spark, feeds, base, SETTINGS)
    corrected = events.where("event_type = 'deposit'").withColumn(
        "amount_usd", F.expr("CAST(CAST(amount_usd AS DECIMAL(18,2)) + 1.00 AS STRING)"))
    corrected.write.mode("append").json(feeds.events.landing)
    return medallion.refresh(spark, feeds, base, SETTINGS).features.select(
        "user_id", "events_total", "trades_total", "sessions_total", "deposit_total_usd",
        "adopted_crypto", "variant_options")


def _faulty_refresh(spark, sf, label) -> medallion.Layers:
    """Of 50 events one line is broken, one lacks its event_id and one its user_id; no catalog comes."""
    base = session.fresh_path(spark, label)
    feeds = make_feeds(spark, base)
    _land_users(spark, sf, feeds)
    nth = F.col("event_id") % 50
    landed = roles.landed_events(spark, sf)
    ids = {"event_id": F.when(nth != 1, F.col("event_id")), "user_id": F.when(nth != 2, F.col("user_id"))}
    line = F.to_json(F.struct(*[ids.get(c, F.col(c)).alias(c) for c in landed.columns]))
    broken = F.concat(F.lit("#"), F.substring(line, 1, 20))
    landed.select(F.when(nth == 0, broken).otherwise(line).alias("value")).write.mode("append").text(
        feeds.events.landing)
    return medallion.refresh(spark, feeds, base, SETTINGS)


@query("refresh_quarantine", sql.select(sql.EVENTS, """
select case when event_id % 50 = 2 then event_id end as event_id, case when event_id % 50 = 1 then user_id end as user_id,
 case when event_id % 50 > 0 then event_type end as event_type,
 case event_id % 50 when 0 then 'readable_line,valid_event_id,valid_user' when 1 then 'valid_event_id'
  else 'valid_user' end as failed_rules
from ev where event_id % 50 < 3"""))
def refresh_quarantine(spark, sf):
    """Rows that the refresh keeps out of silver, with their reasons."""
    bad = _faulty_refresh(spark, sf, "quarantine").quarantine["events"]
    return bad.select(F.col("event_id").cast("bigint"), F.col("user_id").cast("bigint"), "event_type", "failed_rules")


@query("refresh_rule_counts", sql.select(sql.EVENTS, """
, n as (select (select count(*) from customer) as u, count(*) as e, count(*) filter (event_id % 50 = 0) as b,
  count(*) filter (event_id % 50 < 2) as i, count(*) filter (event_id % 50 in (0, 2)) as w from ev)
select 'users' as feed, unnest(['readable_line', 'valid_user']) as rule, u as passed, 0::bigint as failed from n
union all select 'assignments', unnest(['readable_line', 'valid_assignment']), 3 * u, 0 from n
union all select 'catalog', unnest(['readable_line', 'valid_product']), 0, 0 from n
union all select 'events', 'readable_line', e - b, b from n
union all select 'events', 'valid_event_id', e - i, i from n
union all select 'events', 'valid_user', e - w, w from n
union all select 'events', unnest(['readable_time', 'finite_amount']), e, 0 from n"""))
def refresh_rule_counts(spark, sf):
    """Passed and failed rows per feed and rule; the catalog feed is empty."""
    return _faulty_refresh(spark, sf, "rule-counts").rule_counts


@query("ingest_row_count", sql.select(sql.USERS, "select count(*) as rows_reported, count(*) as rows_stored from users"))
def ingest_row_count(spark, sf):
    """More micro-batches than a query remembers; rows reported and rows stored."""
    base = session.fresh_path(spark, "row-count")
    feed = ingest.Feed("users", "csv", f"{base}/landing", files.USERS, {"maxFilesPerTrigger": 1})
    sinks.csv(roles.users(spark, sf), feed.landing, files=110)
    reported = ingest.run_once(spark, [feed], base)["users"]
    return ingest.bronze(spark, base, feed).agg(
        F.lit(reported).cast("bigint").alias("rows_reported"), F.count(F.lit(1)).alias("rows_stored"))


@query("same_batch_redelivery", sql.select(sql.EVENTS, """
select event_id, cast(cast(amount_usd as decimal(18,2)) + case when event_type = 'trade' then 1.00 else 0.00 end as double)
 as amount_usd from ev"""))
def same_batch_redelivery(spark, sf):
    """All events, then all trades with another amount; both wait when the ingest starts."""
    base = session.fresh_path(spark, "same-batch")
    feed = event_feed(base)
    landed = roles.landed_events(spark, sf)
    sinks.json(landed, feed.landing)
    corrected = landed.where("event_type = 'trade'").withColumn(
        "amount_usd", F.expr("CAST(CAST(amount_usd AS DECIMAL(18,2)) + 1.00 AS STRING)"))
    corrected.write.mode("append").json(feed.landing)
    ingest.run_once(spark, [feed], base)
    kept = silver.events(ingest.bronze(spark, base, feed), SETTINGS.launch)
    return kept.select(F.col("event_id").cast("bigint"), "amount_usd")


@query("stream_dedup_first", sql.select(sql.EVENTS, f"select {_LANDED} from ev"))
def stream_dedup_first(spark, sf):
    """Trades are delivered again with other amounts; the stream keeps the first delivery."""
    base = session.fresh_path(spark, "stream-dedup")
    feed = event_feed(base)
    landed = roles.landed_events(spark, sf)

    def run():
        stream = ingest.open_feed(spark, feed).withColumn("arrived", F.col("event_ts").cast("timestamp"))
        once = dedup.stream_first(stream, ["event_id"], "arrived", "40 days").drop("arrived")
        ingest.append(once, f"{base}/out", f"{base}/checkpoint").awaitTermination()

    sinks.json(landed, feed.landing)
    run()
    corrected = landed.where("event_type = 'trade'").withColumn("amount_usd", F.lit("0.00"))
    corrected.write.mode("append").json(feed.landing)
    run()
    return numbered(spark.read.parquet(f"{base}/out"))


@query("stream_expectations", sql.select(sql.BRONZE_EVENTS, """
select event_id, user_id, event_ts, event_type, product, amount_usd, session_id from bronze
where event_id is not null and user_id is not null and try_cast(event_ts as timestamp) is not null
 and (amount_usd is null or try_cast(amount_usd as double) is not null)"""))
def stream_expectations(spark, sf):
    """Rules on a stream: failed rows are counted in the progress and dropped."""
    base = session.fresh_path(spark, "stream-rules")
    feed = event_feed(base)
    sinks.json(roles.bronze_events(spark, sf).drop("ingest_seq"), feed.landing)
    rules = {**silver.EVENT_RULES,
             "readable_time": "try_cast(event_ts AS TIMESTAMP_NTZ) IS NOT NULL",
             "readable_amount": "amount_usd IS NULL OR try_cast(amount_usd AS DOUBLE) IS NOT NULL"}
    ingest.to_bronze(spark, feed, base, rules).awaitTermination()
    return numbered(ingest.bronze(spark, base, feed))


_SESSIONS = """marked as (
 select *, case when event_ts - lag(event_ts) over w >= interval 6 hours then 1 else 0 end as is_new
 from ev window w as (partition by user_id order by event_ts)),
numbered as (
 select *, 1 + sum(is_new) over (partition by user_id order by event_ts) as session_no from marked),
sess as (
 select user_id, cast(session_no as bigint) as session_no, min(event_ts) as session_start,
  max(event_ts) as session_end, count(*) as events from numbered group by user_id, session_no)"""


@query("stream_sessions", sql.select(f"{sql.EVENTS}, {_SESSIONS}", """
select user_id, session_start, session_end, events from sess"""))
def stream_sessions(spark, sf):
    """Sessions that the watermark has closed, and those still open, from the events after them."""
    base = session.fresh_path(spark, "stream-sessions")
    stream = files.parquet_stream(
        spark, sf, roles.load(spark, sf, "events").schema, pathGlobFilter="events.parquet")
    timed = stream.select("user_id", F.col("ts").cast("timestamp").alias("event_ts"))
    closed = sessions.stream_by_gap(timed, "6 hours", "1 hour")
    ingest.append(closed, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    done = spark.read.parquet(f"{base}/out").withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})
    return done.unionByName(sessions.open_tail(roles.events(spark, sf), done, 6 * 3600))


# ---------------------------------------------------------------- sinks and serving
@query("csv_roundtrip", sql.select(sql.USERS, f"select {sql.PROFILE}, email, account_ref from users"))
def csv_roundtrip(spark, sf):
    users = roles.users(spark, sf)
    path = session.fresh_path(spark, "csv")
    sinks.csv(users, path, files=2)
    return files.read_csv(spark, path, users.schema)


@query("json_roundtrip", sql.select(sql.EVENTS, """
select event_id, user_id, event_ts, event_type, product, amount_usd, session_id from ev"""))
def json_roundtrip(spark, sf):
    events = roles.clean_events(spark, sf)
    path = session.fresh_path(spark, "json")
    sinks.json(events, path, files=6)
    return files.read_json(spark, path, events.schema)


@query("table_replace", sql.select(sql.RESULTS, "select product, variant, users from results"))
def table_replace(spark, sf):
    """A table replaced by one with other columns and rows."""
    path = session.fresh_path(spark, "replace")
    sinks.replace(roles.users(spark, sf), path)
    return sinks.replace(inputs.results(spark, sf).select("product", "variant", "users"), path)


def _serving_table(spark, sf) -> str:
    path = session.fresh_path(spark, "serving")
    table = f"serving_{path.rsplit('-', 1)[1]}"
    recs = inputs.nudged(spark, sf).select(*serving.columns(PRODUCTS))
    serving.export_clustered(recs, table, path, buckets=session.shuffle_partitions(spark))
    return table


@query("clustered_export", sql.select(sql.NUDGED, f"select {sql.SERVING_COLUMNS} from nudged"))
def clustered_export(spark, sf):
    return spark.table(_serving_table(spark, sf))


@query("serving_lookup", sql.select(sql.NUDGED, f"""
select {sql.SERVING_COLUMNS}, s as served_by from nudged cross join (values ('serving'), ('fallback')) t(s)
where user_id = 7"""))
def serving_lookup(spark, sf):
    table = _serving_table(spark, sf)
    found = serving.lookup(spark, table, "user_id", 7).withColumn("served_by", F.lit("serving"))
    other = serving.lookup(spark, f"{table}_gone", "user_id", 7,
                           fallback=inputs.nudged(spark, sf).select(*serving.columns(PRODUCTS)))
    return found.unionByName(other.withColumn("served_by", F.lit("fallback")))


@query("sql_params", sql.select(sql.RECS, """
select user_id, propensity_score from recs where recommended_product = 'options' and targeting_decile <= 3"""))
def sql_params(spark, sf):
    return serving.query(
        spark, "SELECT user_id, propensity_score FROM {recs} "
               "WHERE recommended_product = :product AND targeting_decile <= :decile",
        {"product": "options", "decile": 3}, recs=inputs.recommendations(spark, sf))


@query("user_recommendations", sql.select(sql.NUDGED, f"select {sql.BASE_COLUMNS}, product_label, nudge_text, nudge_source from nudged"))
def user_recommendations(spark, sf):
    """Gold features to the final table, through the plan a scheduled job would run."""
    gold = session.written(inputs.user_features(spark, sf), "user_features")
    path = session.fresh_path(spark, "catalog")
    sinks.json(roles.catalog(spark), path, files=1)
    catalog = files.read_json(spark, path, CATALOG_SCHEMA)
    return next_offer.user_recommendations(
        roles.closed_form_scores(gold), gold, catalog, SETTINGS, inputs.write_text, inputs.TOP_K)


# ---------------------------------------------------------------- models
_AS_TEXT = "case when kyc_status = 'pending' then 'n/a' else cast(cast(account_balance_usd as decimal(18,2)) as varchar) end"


_NUMBERS = ml.number_columns(PRODUCTS)


@query("numeric_clean", sql.select(sql.FEATURES, "select user_id, " + ", ".join(
    f"coalesce(try_cast({_AS_TEXT} as double), 0) as {c}" if c == "account_balance_usd" else f"coalesce(cast({c} as double), 0) as {c}"
    for c in _NUMBERS) + " from feats"))
def numeric_clean(spark, sf):
    """All model inputs, one of which comes as text that cannot always be read."""
    balance = F.col("account_balance_usd").cast("decimal(18,2)").cast("string")
    text = inputs.user_features(spark, sf).select("user_id", *_NUMBERS, "kyc_status").withColumn(
        "account_balance_usd", F.when(F.col("kyc_status") == "pending", "n/a").otherwise(balance)).drop("kyc_status")
    return ml.clean_numeric(text, _NUMBERS)


@query("stratified_split", sql.select(sql.LONG, """
select user_id, product, adopted, ('0x' || substr(md5('42:' || adopted || ':' || user_id), 1, 8))::bigint < 858993459 as is_test from long"""))
def stratified_split(spark, sf):
    """The labels of all products, each split by itself."""
    long = experiments.by_product(inputs.user_features(spark, sf), PRODUCTS, ["user_id"], adopted="adopted_{}")
    return ml.stratified_split(long, "adopted", "user_id")


@query("exact_split", sql.select(sql.LONG, """
, placed as (
 select user_id, product, adopted, count(*) over (partition by product, adopted) as n, row_number() over (
  partition by product, adopted order by ('0x' || substr(md5('42:' || product || ':' || adopted || ':' || user_id), 1, 8))::bigint, user_id) as r
 from long)
select user_id, product, adopted, r <= floor(n * 0.2::double + 0.5::double) as is_test from placed"""))
def exact_split(spark, sf):
    """Exactly a fifth of the adopters and of the others, per product."""
    long = experiments.by_product(inputs.user_features(spark, sf), PRODUCTS, ["user_id"], adopted="adopted_{}")
    return ml.exact_split(session.written(long, "labels"), ["product", "adopted"], "user_id")


def _vector_sql() -> str:
    """Positions as the indexer orders them: by frequency, then by name; one block per column."""
    blocks, before = [], "0"
    for c in ml.CATEGORIES:
        blocks.append(
            f"select user_id, {before} + i as position, 1.0::double as value from feats join ("
            f"select {c} as v, row_number() over (order by count(*) desc, {c}) - 1 as i from feats group by {c}) on v = {c}")
        before += f" + (select count(distinct {c}) from feats)"
    for i, c in enumerate(ml.number_columns(PRODUCTS)):
        blocks.append(f"select user_id, {before} + {i}, cast({c} as double) from feats")
    return "select user_id, cast(position as int) as position, value from (" + " union all ".join(blocks) + ") where value <> 0"


@query("feature_vectors", sql.select(sql.FEATURES, _vector_sql()))
def feature_vectors(spark, sf):
    """The model inputs, one row per non-zero position."""
    gold = session.written(inputs.user_features(spark, sf), "user_features")
    _, assembled = ml.vectors(gold, PRODUCTS)
    return assembled.select("user_id", F.posexplode(ml.vector_to_array("features")).alias("position", "value")).where("value <> 0")


_BEST = "greatest(prob_crypto, prob_options, prob_agentic)"


@query("gbt_scores", sql.select(sql.FEATURES, """
select user_id, true as in_range, true as is_best from feats"""))
def gbt_scores(spark, sf):
    """All users scored by the fitted models, with what must hold for any model: scores are
    probabilities, and the recommendation is the first product with the best one."""
    gold = session.written(inputs.user_features(spark, sf), "user_features")
    _, scores = next_offer.train_and_score(gold, SETTINGS, ml.TrainConfig())
    return recommend.assemble(scores, PRODUCTS).selectExpr(
        "user_id", " AND ".join(f"prob_{p} BETWEEN 0 AND 1" for p in PRODUCTS) + " AS in_range",
        f"propensity_score = {_BEST} AND recommended_product = CASE {_BEST} "
        + " ".join(f"WHEN prob_{p} THEN '{p}'" for p in PRODUCTS) + " END AS is_best")


_TRAINED = " union all ".join(f"""
select '{p}' as product, 1 as version, 200 as trees, 3 as depth, 0.1::double as rate, 42 as seed,
 count(*) filter (('0x' || substr(md5('42:' || adopted_{p} || ':' || user_id), 1, 8))::bigint >= 858993459) as n_train,
 {sql.half_up(f"sum(adopted_{p})::double / count(*)", 6)} as base_rate, true as measured from feats""" for p in PRODUCTS)


@query("gbt_metrics", sql.select(sql.FEATURES, _TRAINED))
def gbt_metrics(spark, sf):
    """Train, save, reload, measure on the holdout, log the run and read the log."""
    gold = session.written(inputs.user_features(spark, sf), "user_features")
    config = ml.TrainConfig()
    trained = ml.fit_all(gold, PRODUCTS, config)
    base = session.fresh_path(spark, "models")
    ml.save(trained, base, version=1)
    ml.record_run(f"{base}/runs", trained, config, version=1)
    return spark.read.schema(ml.RUN_SCHEMA).parquet(f"{base}/runs").selectExpr(
        "product", "version", "trees", "depth", "rate", "seed", "n_train", "base_rate",
        "roc_auc BETWEEN 0 AND 1 AND avg_precision BETWEEN 0 AND 1 AND accuracy BETWEEN 0 AND 1 AS measured")


@query("model_reload", "select unnest(['crypto', 'options', 'agentic']) as product, 1 as version, true as same_scores, "
       "true as beats_chance, 1 as runs_logged, count(*) as users from customer")
def model_reload(spark, sf):
    """Fit, save, load and score with the loaded models: their scores equal those of the fitted ones and rank the
    adopters of all users better than chance; the run log has one row per product."""
    gold = session.written(inputs.user_features(spark, sf), "user_features")
    config = ml.TrainConfig(trees=5)
    base = session.fresh_path(spark, "models")
    trained, fitted = next_offer.train_and_score(gold, SETTINGS, config)
    ml.save(trained, base, version=1)
    ml.record_run(f"{base}/runs", trained, config, version=1)
    loaded = ml.score(ml.load(base, 1, PRODUCTS), gold)
    labels = gold.select("user_id", *(f"adopted_{p}" for p in PRODUCTS))
    again = experiments.by_product(loaded.join(labels, "user_id"), PRODUCTS, ["user_id"], score="prob_{}", label="adopted_{}")
    both = session.written(again.join(ml.long_scores(fitted, PRODUCTS), ["user_id", "product"]), "both-scores")
    found = both.groupBy("product").agg(F.every(F.col("score") == F.col("prob")).alias("same_scores"), F.count("*").alias("users"))
    logged = ml.summary(spark, f"{base}/runs").groupBy("product", "version").agg(F.count("*").cast("int").alias("runs_logged"))
    return found.join(metrics.roc_auc(both, "score", "label", ["product"]), "product").join(logged, "product").select(
        "product", "version", "same_scores", (F.col("roc_auc") > 0.5).alias("beats_chance"), "runs_logged", "users")


# ---------------------------------------------------------------- documented extras
@query("sessions_by_gap", sql.select(f"{sql.EVENTS}, {_SESSIONS}", "select * from sess"))
def sessions_by_gap(spark, sf):
    return sessions.by_gap(roles.events(spark, sf), 6 * 3600)


@query("exposed_events", sql.select(f"{sql.EVENTS}, {sql.ASSIGN}", """
select event_id, ev.user_id, event_ts, event_type, ev.product, experiment_id, variant
from ev join assign on ev.user_id = assign.user_id and ev.product = assign.product
 and event_ts >= assigned_ts and event_ts < assigned_ts + interval 7 days"""))
def exposed_events(spark, sf):
    return experiments.exposed_events(roles.events(spark, sf), roles.silver_assignments(spark, sf), 7)


@query("trailing_features", sql.select(sql.EVENTS, f"""
select user_id, count(*) filter (event_type = 'trade') as trades_14d,
 {sql.half_up("coalesce(" + sql.money("case when event_type = 'deposit' then amount_usd end") + ", 0) / 14.0::double", 4)} as deposit_per_day_usd,
 {sql.half_up("count(*)::double / nullif(count(distinct session_id), 0)", 4)} as events_per_session,
 concat_ws(',', max('equities') filter (event_type = 'trade' and product = 'equities'),
  max('etf') filter (event_type = 'trade' and product = 'etf'),
  max('crypto') filter (event_type = 'trade' and product = 'crypto'),
  max('options') filter (event_type = 'trade' and product = 'options'),
  max('agentic') filter (event_type = 'trade' and product = 'agentic')) as product_holdings
from ev where event_ts < {sql.LAUNCH} and event_ts >= {sql.LAUNCH} - interval 14 days group by user_id"""))
def trailing_features(spark, sf):
    return features.trailing(roles.events(spark, sf), SETTINGS.launch, 14)


@query("open_holdings", sql.select(sql.EVENTS, f"""
select user_id, coalesce(string_agg(distinct p, ',' order by p) filter (event_type = 'trade'), '') as product_holdings
from (select *, product || '-' || k % 20 % 3 as p from ev)
where event_ts < {sql.LAUNCH} and event_ts >= {sql.LAUNCH} - interval 14 days group by user_id"""))
def open_holdings(spark, sf):
    """Products that no catalog lists."""
    ev = roles.events(spark, sf)
    k = F.regexp_extract("session_id", "-([0-9]+)$", 1).cast("int")  # k % 20
    return features.trailing(ev.withColumn("product", F.concat_ws("-", "product", (k % 3).cast("string"))),
                             SETTINGS.launch, 14).select("user_id", "product_holdings")


@query("post_window_labels", sql.select(sql.EVENTS, "select user_id, " + ", ".join(
    f"coalesce(max(1) filter (is_post_launch and event_ts < timestamp '2024-01-24' and event_type = 'trade' "
    f"and product = '{p}'), 0) as adopted_{p}" for p in PRODUCTS) + " from ev group by user_id"))
def post_window_labels(spark, sf):
    return features.labels(roles.events(spark, sf), replace(SETTINGS, post_window_days=3))


ELIGIBILITY = {
    "options": "risk_profile <> 'conservative' AND tier IN ('silver', 'gold', 'platinum')",
    "agentic": "age_band <> '65+'",
}


@query("eligible", sql.select(sql.SCORES, """
select user_id, 'crypto' as product, prob_crypto as prob from scores
union all select user_id, 'options', prob_options from scores where not (risk_profile = 'conservative' or tier = 'bronze')
union all select user_id, 'agentic', prob_agentic from scores where age_band not in ('65+')"""))
def eligible(spark, sf):
    long = ml.long_scores(inputs.scored(spark, sf), PRODUCTS, ["user_id", "tier", "risk_profile", "age_band"])
    return recommend.eligible(long, ELIGIBILITY).select("user_id", "product", "prob")


@query("funnel", sql.select(sql.EVENTS, f"""
, seen as (select * from ev where product = 'crypto' or product is null),
a as (select user_id, min(event_ts) as t from seen where event_type = 'login' group by user_id),
b as (select seen.user_id, min(event_ts) as t from seen join a on a.user_id = seen.user_id
 where event_type = 'view_product' and event_ts >= a.t group by seen.user_id),
c as (select seen.user_id, min(event_ts) as t from seen join b on b.user_id = seen.user_id
 where event_type = 'trade' and event_ts >= b.t group by seen.user_id),
r as (select (select count(*) from a) as n0, (select count(*) from b) as n1, (select count(*) from c) as n2)
select 1 as step_no, 'login' as step, n0 as users, {sql.pct('n0', 'n0')} as pct_of_first from r
union all select 2, 'view_product', n1, {sql.pct('n1', 'n0')} from r
union all select 3, 'trade', n2, {sql.pct('n2', 'n0')} from r"""))
def funnel(spark, sf):
    return reports.funnel(roles.events(spark, sf), ["login", "view_product", "trade"], "crypto")


@query("export_cohort", sql.select(sql.RECS, f"select {sql.BASE_COLUMNS} from recs where targeting_decile <= 3"))
def export_cohort(spark, sf):
    path = session.fresh_path(spark, "cohort")
    targeting.export_cohort(inputs.recommendations(spark, sf), 3, path)
    return spark.read.parquet(path)
