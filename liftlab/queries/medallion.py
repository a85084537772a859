"""Silver, features and experiments."""

from __future__ import annotations

from dataclasses import replace

from liftlab.operators import dedup, experiments, features, quality, reports, silver
from liftlab.queries import inputs, sql
from liftlab.queries.registry import query
from liftlab.sources import roles

PRODUCTS = inputs.PRODUCTS
SETTINGS = inputs.SETTINGS
EVENT_FIELDS = "event_id, user_id, event_ts, event_type, product, amount_usd, session_id"


# ---------------------------------------------------------------- silver
@query("dedup_users", sql.select(sql.USERS, """
select user_id, signup_date, tier, region, age_band, risk_profile, kyc_status,
 case when c_mktsegment = 'MACHINERY' then account_balance_usd + 100 else account_balance_usd end
  as account_balance_usd, email, account_ref,
 case when c_mktsegment = 'MACHINERY' then 1 else 0 end as ingest_seq from users"""))
def dedup_users(spark, sf):
    return dedup.latest(roles.bronze_users(spark, sf), ["user_id"], ["ingest_seq"])


@query("dedup_events", sql.select(sql.BRONZE_EVENTS, f"""
select {EVENT_FIELDS}, ingest_seq from bronze where event_id is not null and user_id is not null
qualify row_number() over (partition by event_id order by ingest_seq desc) = 1"""))
def dedup_events(spark, sf):
    rows = quality.expect_or_drop(roles.bronze_events(spark, sf), silver.EVENT_RULES)
    return dedup.latest(rows, ["event_id"], ["ingest_seq"])


@query("dedup_assignments", sql.select(sql.BRONZE_ASSIGN, """
select * from bronze_assign
qualify row_number() over (partition by experiment_id, user_id order by ingest_seq desc) = 1"""))
def dedup_assignments(spark, sf):
    return dedup.latest(roles.bronze_assignments(spark, sf), ["experiment_id", "user_id"], ["ingest_seq"])


@query("typed_events", sql.select(sql.BRONZE_EVENTS, f"""
select event_id, user_id, try_cast(event_ts as timestamp) as event_ts, event_type, product,
 try_cast(amount_usd as double) as amount_usd, session_id,
 try_cast(event_ts as timestamp) >= {sql.LAUNCH} as is_post_launch
from bronze where event_id is not null and user_id is not null
qualify row_number() over (partition by event_id order by ingest_seq desc) = 1"""))
def typed_events(spark, sf):
    return silver.events(roles.bronze_events(spark, sf), SETTINGS.launch, ["ingest_seq"]).drop("ingest_seq")


@query("expect_or_drop", sql.select(sql.BRONZE_EVENTS, f"""
select {EVENT_FIELDS}, ingest_seq from bronze where event_id is not null and user_id is not null"""))
def expect_or_drop(spark, sf):
    return quality.expect_or_drop(roles.bronze_events(spark, sf), silver.EVENT_RULES)


DELIVERY_RULES = {
    **silver.EVENT_RULES,
    "readable_time": "try_cast(event_ts AS TIMESTAMP_NTZ) IS NOT NULL",
    "readable_amount": "amount_usd IS NULL OR try_cast(amount_usd AS DOUBLE) IS NOT NULL",
}


@query("expectation_report", sql.select(sql.BRONZE_EVENTS, """
select rule, count(*) filter (ok) as passed, count(*) filter (not ok) as failed from (
 select 'valid_event_id' as rule, event_id is not null as ok from bronze
 union all select 'valid_user', user_id is not null from bronze
 union all select 'readable_time', try_cast(event_ts as timestamp) is not null from bronze
 union all select 'readable_amount', amount_usd is null or try_cast(amount_usd as double) is not null from bronze)
group by rule"""))
def expectation_report(spark, sf):
    return quality.expectation_report(roles.bronze_events(spark, sf), DELIVERY_RULES)


@query("quarantine", sql.select(sql.BRONZE_EVENTS, f"""
select * from (select {EVENT_FIELDS}, ingest_seq, concat_ws(',', case when event_id is null then 'valid_event_id' end,
  case when user_id is null then 'valid_user' end,
  case when try_cast(event_ts as timestamp) is null then 'readable_time' end,
  case when amount_usd is not null and try_cast(amount_usd as double) is null then 'readable_amount' end)
  as failed_rules from bronze) where failed_rules <> ''"""))
def quarantine(spark, sf):
    return quality.split(roles.bronze_events(spark, sf), DELIVERY_RULES)[1]


# ---------------------------------------------------------------- features
@query("behavior_totals", sql.select(f"{sql.EVENTS}, {sql.TOTALS}", "select * from totals"))
def behavior_totals(spark, sf):
    return features.behavior(roles.events(spark, sf))


@query("product_affinity", sql.select(f"{sql.EVENTS}, {sql.TOTALS}", """
select user_id, """ + ", ".join(
    f"count(*) filter (product = '{p}') as pre_{p}_interactions" for p in PRODUCTS)
    + " from pre group by user_id"))
def product_affinity(spark, sf):
    return features.affinity(roles.events(spark, sf), PRODUCTS)


_ADOPTED = ", ".join(
    f"coalesce(max(1) filter (is_post_launch and event_type = 'trade' and product = '{p}'), 0) as adopted_{p}"
    for p in PRODUCTS)


@query("adoption_labels", sql.select(sql.EVENTS, f"select user_id, {_ADOPTED} from ev group by user_id"))
def adoption_labels(spark, sf):
    return features.labels(roles.events(spark, sf), SETTINGS)


@query("labels_compat", sql.select(sql.EVENTS, """
select user_id, """ + ", ".join(
    "coalesce(max(1) filter (event_ts >= timestamp '2024-01-02' and event_type = 'trade' and "
    f"product = '{p}'), 0) * max(case when event_ts < timestamp '2024-01-02' then 1 else 0 end)"
    f" as adopted_{p}" for p in PRODUCTS) + " from ev group by user_id"))
def labels_compat(spark, sf):
    early = replace(SETTINGS, launch="2024-01-02", labels_require_pre_activity=True)
    return features.labels(roles.events(spark, sf, early), early)


@query("variant_matrix", sql.select(f"{sql.ASSIGN}, {sql.VARIANTS}", "select * from variants"))
def variant_matrix(spark, sf):
    return experiments.variant_matrix(roles.silver_assignments(spark, sf), PRODUCTS)


@query("assignment_conflicts", sql.select(sql.BRONZE_ASSIGN, """
select product, user_id, min(variant) as first_variant, max(variant) as last_variant
from bronze_assign group by product, user_id having count(distinct variant) > 1"""))
def assignment_conflicts(spark, sf):
    return experiments.conflicting_assignments(roles.bronze_assignments(spark, sf))


@query("tenure", sql.select(sql.USERS, """
select user_id, signup_date, cast(date '2024-01-21' - signup_date as int) as tenure_days from users"""))
def tenure(spark, sf):
    return features.tenure(roles.users(spark, sf).select("user_id", "signup_date"), SETTINGS.launch)


@query("user_features", sql.select(sql.FEATURES, "select * from feats"))
def user_features(spark, sf):
    return inputs.user_features(spark, sf)


# ---------------------------------------------------------------- experiments
@query("experiment_results", sql.select(sql.RESULTS, "select * from results"))
def experiment_results(spark, sf):
    return inputs.results(spark, sf)


@query("experiment_lift", sql.select(sql.LIFTS, "select product, lift_pp from lifts order by lift_pp desc, product"))
def experiment_lift(spark, sf):
    return experiments.lift(inputs.results(spark, sf))


@query("lift_table", sql.select(sql.LIFTS, "select * from lifts"))
def lift_table(spark, sf):
    return experiments.lift_table(inputs.results(spark, sf))


@query("avg_lift", sql.select(sql.LIFTS, f"select {sql.mean('lift_pp', 4)} as avg_lift_pp from lifts"))
def avg_lift(spark, sf):
    return experiments.average_lift(experiments.lift(inputs.results(spark, sf)))


@query("best_variant", sql.select(sql.RESULTS, """
select product, variant as best_variant, adoption_rate_pct from results
qualify row_number() over (partition by product order by adoption_rate_pct desc, variant desc) = 1"""))
def best_variant(spark, sf):
    return experiments.best_variant(inputs.results(spark, sf))


@query("adopter_check", sql.select(sql.LONG, f"""
select l.product, coalesce(d.n, 0) as adopters, l.feature_adopters, {sql.pct('coalesce(d.n, 0)', 'l.users')} as pct_of_users
from (select product, count(*) as users, cast(sum(adopted) as bigint) as feature_adopters from long group by product) l
left join (select product, count(distinct user_id) as n from ev where is_post_launch and event_type = 'trade'
           group by product) d on d.product = l.product"""))
def adopter_check(spark, sf):
    return experiments.adopter_check(roles.events(spark, sf), inputs.user_features(spark, sf), PRODUCTS)


@query("base_rates", sql.select(sql.LONG, f"""
select product, {sql.half_up('sum(adopted)::double / count(*)', 6)} as base_rate from long group by product"""))
def base_rates(spark, sf):
    return experiments.base_rates(inputs.user_features(spark, sf), PRODUCTS)


@query("event_distribution", sql.select(sql.EVENTS, """
select product, event_type, count(*) as events from ev group by product, event_type"""))
def event_distribution(spark, sf):
    return reports.event_distribution(roles.events(spark, sf))


@query("layer_counts", sql.select(sql.BRONZE_EVENTS, """
select 'bronze_events' as layer, count(*) as rows from bronze
union all select 'silver_events', count(distinct event_id) from bronze where user_id is not null
union all select 'user_features', count(*) from customer"""))
def layer_counts(spark, sf):
    bronze = roles.bronze_events(spark, sf)
    return reports.layer_counts({
        "bronze_events": bronze,
        "silver_events": silver.events(bronze, SETTINGS.launch, ["ingest_seq"]),
        "user_features": inputs.user_features(spark, sf),
    })
