"""Ranking, recommendations, reports, metrics, outreach and privacy."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftlab import session
from liftlab.functions import numeric
from liftlab.operators import (experiments, metrics, ml, nudges, privacy, rank, recommend,
                               reports, serving, targeting)
from liftlab.queries import inputs, sql
from liftlab.queries.registry import query
from liftlab.sources import roles

PRODUCTS = inputs.PRODUCTS


# ---------------------------------------------------------------- ranking
@query("global_rank", sql.select(sql.PICKED, """
select user_id, propensity_score, row_number() over (order by propensity_score desc, user_id) as overall_rank
from picked"""))
def global_rank(spark, sf):
    scores = inputs.picked(spark, sf).select("user_id", "propensity_score")
    return rank.global_rank(scores, "propensity_score", "user_id")


@query("first_come_rank", sql.select(sql.FEATURES, """
select user_id, events_total, row_number() over (order by events_total, user_id) as first_come_rank from feats"""))
def first_come_rank(spark, sf):
    # most users have no event: one score holds almost all rows
    counts = inputs.user_features(spark, sf).select("user_id", "events_total")
    return rank.global_rank(counts, "events_total", "user_id", ascending=True, name="first_come_rank")


@query("targeting_decile", sql.select(sql.EVENTS, """
select event_id, amount_usd, cast(10 - greatest((10 * (r - 1) + n - 2) // (n - 1) - 1, 0) as int) as amount_decile
from (select event_id, amount_usd, row_number() over (order by amount_usd, event_id) as r, count(*) over () as n
      from ev where amount_usd is not null)"""))
def targeting_decile(spark, sf):
    # all amounts, with many ties; their number is no multiple of ten, where ntile() would differ
    amounts = roles.events(spark, sf).where("amount_usd IS NOT NULL").select("event_id", "amount_usd")
    return rank.quantile_cut(amounts, "amount_usd", "event_id", name="amount_decile")


@query("top_users", sql.select(sql.PICKED, """
select user_id, propensity_score from picked order by propensity_score desc, user_id limit 200"""))
def top_users(spark, sf):
    return targeting.top_users(inputs.picked(spark, sf), 200).select("user_id", "propensity_score")


@query("top_users_product", sql.select(sql.PICKED, """
select user_id, propensity_score from picked where recommended_product = 'crypto'
order by propensity_score desc, user_id limit 5"""))
def top_users_product(spark, sf):
    return targeting.top_users(inputs.picked(spark, sf), 5, "crypto").select("user_id", "propensity_score")


@query("flag_top_k", sql.select(sql.PICKED, """
select user_id, propensity_score, row_number() over (order by propensity_score desc, user_id) <= 750 as is_top_k
from picked"""))
def flag_top_k(spark, sf):
    # read twice (cut-off and comparison), so the scores are written once first
    scores = session.written(inputs.picked(spark, sf).select("user_id", "propensity_score"), "scores")
    return targeting.flag_top_k(scores, inputs.TOP_K)


@query("top_k_large", sql.select(sql.EVENTS, """
select event_id, row_number() over (order by amount_usd desc nulls last, event_id) <= 1001 as in_top, true as in_all from ev"""))
def top_k_large(spark, sf):
    """The same method for a large k, and for a k above the number of rows; NULL amounts come last."""
    amounts = roles.events(spark, sf).select("event_id", "amount_usd")
    top = targeting.flag_top_k(amounts, 1_001, "amount_usd", "event_id", "in_top")
    return targeting.flag_top_k(top, 1 << 40, "amount_usd", "event_id", "in_all").drop("amount_usd")


@query("large_amount_sums", sql.select(sql.USERS, f"""
select region, {sql.half_up('cast(sum(user_id) as double) * 1000000000.0::double / count(*)', 2)} as mean_usd,
 cast(sum(user_id) * 10 as bigint) as sum_in_1e15 from users group by region"""))
def large_amount_sums(spark, sf):
    """Amounts whose steps or cents no long can count."""
    return roles.users(spark, sf).groupBy("region").agg(
        numeric.mean(F.col("user_id") * F.lit(1e9), 2).alias("mean_usd"),
        F.round(numeric.money_sum(F.col("user_id") * F.lit(1e16)) / F.lit(1e15)).cast("long").alias("sum_in_1e15"))


@query("top_products_per_user", sql.select(sql.SCORES, """
select user_id, row_number() over (partition by user_id order by prob desc, pos) as place, product, prob
from (select user_id, 0 as pos, 'crypto' as product, prob_crypto as prob from scores
 union all select user_id, 1, 'options', prob_options from scores
 union all select user_id, 2, 'agentic', prob_agentic from scores)
qualify place <= 2"""))
def top_products_per_user(spark, sf):
    scores = roles.closed_form_scores(inputs.user_features(spark, sf))
    return recommend.top_products(scores, PRODUCTS, 2)


# ---------------------------------------------------------------- recommend
@query("recommend_assemble", sql.select(sql.PICKED, """
select user_id, prob_crypto, prob_options, prob_agentic, recommended_product, propensity_score from picked"""))
def recommend_assemble(spark, sf):
    return inputs.picked(spark, sf)


@query("expected_value", sql.select(sql.VALUED, """
select user_id, recommended_product, propensity_score, expected_annual_value_usd from valued"""))
def expected_value(spark, sf):
    return inputs.valued(spark, sf).select(
        "user_id", "recommended_product", "propensity_score", "expected_annual_value_usd")


@query("recommendations", sql.select(sql.RECS, f"select {sql.BASE_COLUMNS} from recs"))
def recommendations(spark, sf):
    # scores arrive as a table of their own here, so the context is joined to them
    gold = session.written(inputs.user_features(spark, sf), "user_features")
    scored = recommend.with_context(roles.closed_form_scores(gold), gold, PRODUCTS)
    return recommend.recommendations(scored, roles.catalog(spark), inputs.SETTINGS)


WEIGHTS = {"pre_crypto_interactions": 0.05, "active_days": 0.1, "trades_total": -0.02,
           "CASE tier WHEN 'platinum' THEN 3 WHEN 'gold' THEN 2 WHEN 'silver' THEN 1 ELSE 0 END": 0.3}


@query("scorecard", sql.select(sql.FEATURES, f"""
select user_id, {sql.half_up('''1.0::double / (1.0::double + exp(-(-2.3::double + 0.05::double * pre_crypto_interactions
 + 0.1::double * active_days - 0.02::double * trades_total
 + 0.3::double * case tier when 'platinum' then 3 when 'gold' then 2 when 'silver' then 1 else 0 end)))''', 6)} as score
from feats"""))
def scorecard(spark, sf):
    return recommend.scorecard(inputs.user_features(spark, sf), WEIGHTS, -2.3).select("user_id", "score")


# ---------------------------------------------------------------- reports
_MIX = f"""mix as (select recommended_product, count(*) as users, {sql.mean('propensity_score', 3)} as avg_score,
 floor({sql.money('expected_annual_value_usd')} + 0.5::double) as exp_value from valued group by recommended_product)"""


@query("mix", sql.select(f"{sql.VALUED}, {_MIX}", "select * from mix"))
def mix(spark, sf):
    return reports.mix(inputs.valued(spark, sf))


@query("totals", sql.select(sql.VALUED, f"""
select count(*) as users, {sql.money('expected_annual_value_usd')} as exp_value from valued"""))
def totals(spark, sf):
    return reports.totals(inputs.valued(spark, sf))


@query("top_product", sql.select(f"{sql.VALUED}, {_MIX}", "select * from mix order by exp_value desc, recommended_product limit 1"))
def top_product(spark, sf):
    return reports.top_product(reports.mix(inputs.valued(spark, sf)))


@query("concentration", sql.select(sql.RECS, f"""
select case when targeting_decile <= 3 then 'targeted' else 'remaining' end as segment, count(*) as users,
 {sql.money('expected_annual_value_usd')} as exp_value,
 {sql.pct(sql.money('expected_annual_value_usd'), f"select {sql.money('expected_annual_value_usd')} from recs")} as share_pct
from recs group by 1"""))
def concentration(spark, sf):
    return reports.concentration(inputs.recommendations(spark, sf))


@query("top_decile_value", sql.select(sql.RECS, f"""
select count(*) as users, {sql.money('expected_annual_value_usd')} as exp_value from recs where targeting_decile <= 3"""))
def top_decile_value(spark, sf):
    return reports.top_decile_value(inputs.recommendations(spark, sf), 3)


@query("nudge_split", sql.select(sql.NUDGED, """
select nudge_source, count(*) as users from nudged group by nudge_source"""))
def nudge_split(spark, sf):
    return reports.nudge_split(inputs.nudged(spark, sf))


@query("cohort_propensity", sql.select(sql.SCORES, f"""
select tier, age_band, count(*) as users, {sql.mean('prob_crypto', 4)} as avg_propensity
from scores group by tier, age_band"""))
def cohort_propensity(spark, sf):
    return reports.cohort_propensity(inputs.scored(spark, sf), ["tier", "age_band"], "crypto")


# VALUED and LIFTS share the feature CTEs; only the part after them is added
_LIFTS_ONLY = sql.LIFTS[len(sql.FEATURES):]


@query("formatted_kpis", sql.select(f"{sql.VALUED}{_LIFTS_ONLY}, {_MIX}", f"""
select 'Users scored' as kpi, format('{{:,}}', cast(sum(users) as bigint)) as value from mix
union all select 'Average lift', printf('%+.1f pp', {sql.mean('lift_pp', 1)}) from lifts
union all select 'Expected annual value', '$' || format('{{:,}}',
 cast(floor(sum(exp_value) / 1000.0::double + 0.5::double) as bigint)) || 'K' from mix
union all (select 'Top product', upper(recommended_product[1]) || recommended_product[2:] from mix
 order by exp_value desc, recommended_product limit 1)"""))
def formatted_kpis(spark, sf):
    gold = session.written(inputs.user_features(spark, sf), "user_features")
    scored = recommend.assemble(roles.closed_form_scores(gold), PRODUCTS)
    valued = recommend.expected_value(scored, roles.catalog(spark), inputs.SETTINGS)
    return reports.kpis(reports.mix(valued), experiments.lift(experiments.results(gold, inputs.SETTINGS)))


# ---------------------------------------------------------------- metrics
_METRICS = sql.select(f"{sql.SCORED_LABELS}, {sql.ranking('sl', 'product')}", "")


@query("roc_auc", _METRICS + "select product, roc_auc from metrics")
def roc_auc(spark, sf):
    return metrics.roc_auc(inputs.scored_labels(spark, sf), "score", "label", ["product"])


@query("avg_precision", _METRICS + "select product, avg_precision from metrics")
def avg_precision(spark, sf):
    return metrics.avg_precision(inputs.scored_labels(spark, sf), "score", "label", ["product"])


@query("accuracy", sql.select(sql.SCORED_LABELS, f"""
select product, {sql.half_up('count(*) filter ((score >= 0.5) = (label = 1))::double / count(*)', 6)} as accuracy
from sl group by product"""))
def accuracy(spark, sf):
    return metrics.accuracy(inputs.scored_labels(spark, sf), "score", "label", 0.5, ["product"])


# heavy ties and a second label: text length as a score for the quality and toxicity flags
_TEXT = """tl as (
 select 'quality' as product, n_chars::double as score, quality as label from labels join documents using (doc_id)
 union all select 'toxic', n_chars::double, toxic from labels join documents using (doc_id))"""


@query("text_label_metrics", sql.select(f"{_TEXT}, {sql.ranking('tl', 'product')}", """
select product as flag, roc_auc, avg_precision from metrics"""))
def text_label_metrics(spark, sf):
    joined = roles.load(spark, sf, "labels").join(
        roles.load(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    long = joined.select("n_chars", F.inline(F.array(
        F.struct(F.lit("quality").alias("flag"), F.col("quality").alias("label")),
        F.struct(F.lit("toxic").alias("flag"), F.col("toxic").alias("label")))))
    return metrics.ranking_metrics(long, "n_chars", "label", ["flag"])


@query("metrics_with_missing", sql.select(f"{sql.SCORED_LABELS}, "
    "gaps as (select case when product <> 'crypto' then product end as product, "
    "case when user_id % 7 > 0 then score end as score, label from sl), "
    + sql.ranking("gaps", "product"), "select product, roc_auc, avg_precision from metrics"))
def metrics_with_missing(spark, sf):
    """A NULL group is a group; NaN scores are left out."""
    long = inputs.scored_labels(spark, sf).withColumns({
        "product": F.when(F.col("product") != "crypto", F.col("product")),
        "score": F.when(F.col("user_id") % 7 > 0, F.col("score")).otherwise(F.lit(float("nan")))})
    return metrics.ranking_metrics(long, "score", "label", ["product"])


@query("cumulative_gains", sql.select(sql.RECS, f"""
, d as (select targeting_decile, count(*) as users, {sql.money('expected_annual_value_usd')} as value_usd,
  cast(sum(case recommended_product when 'crypto' then adopted_crypto when 'options' then adopted_options
       else adopted_agentic end) as bigint) as adopters from recs group by targeting_decile)
select targeting_decile, users, value_usd, adopters,
 {sql.pct('round(sum(value_usd) over (order by targeting_decile), 2)', 'round(sum(value_usd) over (), 2)')} as cum_value_pct,
 {sql.pct('sum(adopters) over (order by targeting_decile)', 'sum(adopters) over ()')} as cum_adopters_pct from d"""))
def cumulative_gains(spark, sf):
    labels = [f"adopted_{p}" for p in PRODUCTS]
    scored = roles.closed_form_scores(inputs.user_features(spark, sf), keep=["user_id", *labels])
    recs = recommend.recommendations(scored, roles.catalog(spark), inputs.SETTINGS)
    bought = F.coalesce(*[
        F.when(F.col("recommended_product") == p, F.col(f"adopted_{p}")) for p in PRODUCTS])
    return metrics.cumulative_gains(recs.withColumn("adopted", bought))


@query("champion", sql.select(f"{sql.SCORES}, versions as (" + " union all ".join(
    f"select '{p}' as product, {v} as version, '{p}-{v}' as run, {sql.prob(p, salt)} as score, adopted_{p} as label"
    f" from feats" for p in PRODUCTS for v, salt in ((1, "prob"), (2, "second"))) + "), "
    + sql.ranking("versions", "product, version"), """
select product, version, roc_auc from metrics
qualify row_number() over (partition by product order by roc_auc desc, version desc) = 1"""))
def champion(spark, sf):
    gold = session.written(inputs.user_features(spark, sf), "user_features")  # read once per version
    runs = None
    for version, salt in ((1, "prob"), (2, "second")):
        rows = inputs.labelled(gold, salt).withColumn("version", F.lit(version))
        runs = rows if runs is None else runs.unionByName(rows)
    return ml.champion(metrics.roc_auc(runs, "score", "label", ["product", "version"]))


# ---------------------------------------------------------------- outreach
@query("nudge_template", sql.select(sql.PICKED, f"""
select user_id, {sql.LABEL} as product_label, {sql.TEMPLATE} as nudge_text from picked"""))
def nudge_template(spark, sf):
    return nudges.template(nudges.with_label(inputs.picked(spark, sf))).select(
        "user_id", "product_label", "nudge_text")


@query("nudge_prompt", sql.select(sql.PICKED, f"select user_id, {sql.PROMPT} as prompt from picked"))
def nudge_prompt(spark, sf):
    return nudges.prompt(recommend.assemble(inputs.scored(spark, sf), PRODUCTS)).select("user_id", "prompt")


@query("nudge_generate", sql.select(sql.PICKED, f"""
select user_id, 'You could try something new today. [' || length({sql.PROMPT}) || ']' as nudge_text from picked"""))
def nudge_generate(spark, sf):
    prompts = nudges.prompt(recommend.assemble(inputs.scored(spark, sf), PRODUCTS))
    return nudges.generate(prompts, inputs.write_text)


@query("nudge_assemble", sql.select(sql.NUDGED, f"select {sql.BASE_COLUMNS}, product_label, nudge_text, nudge_source from nudged"))
def nudge_assemble(spark, sf):
    return inputs.nudged(spark, sf)


@query("nudge_guardrails", sql.select(sql.NUDGED, r"""
select rule, count(*) filter (ok) as passed, count(*) filter (not ok) as failed from (
 select 'at_most_45_words' as rule, len(regexp_split_to_array(trim(nudge_text), '[ \t\n]+')) <= 45 as ok from nudged
 union all select 'no_emoji', not regexp_matches(nudge_text, '[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]') from nudged
 union all select 'no_promise', not regexp_matches(lower(nudge_text), 'guarantee|risk-free|promise') from nudged
 union all select 'speaks_to_you', contains(lower(nudge_text), 'you') from nudged) group by rule"""))
def nudge_guardrails(spark, sf):
    return nudges.guardrail_report(inputs.nudged(spark, sf))


# ---------------------------------------------------------------- privacy
@query("mask_users", sql.select(sql.USERS, """
select user_id, regexp_replace(email, '^[^@]+', '****') as email,
 'ACCT-****' || substr(account_ref, -4) as account_ref from users"""))
def mask_users(spark, sf):
    return privacy.secure_view(roles.users(spark, sf).select("user_id", "email", "account_ref"))


@query("secure_view", sql.select(sql.USERS, f"""
select {sql.PROFILE}, '****@example.com' as email, 'ACCT-****' || right(account_ref, 4) as account_ref from users"""))
def secure_view(spark, sf):
    return privacy.secure_view(roles.users(spark, sf))


_RAW = {"email": r"[^@\s]@[^@\s]", "account_ref": "(?i)ACCT-[0-9]{5,}"}
_MASK = r"""(^|[\s(<\[,;:"''])\*{4}@"""
_PROFILE_TEXT = ["tier", "region", "age_band", "risk_profile", "kyc_status"]
_PUBLISHED = {
    "silver_users": ("users", [*_PROFILE_TEXT, "email", "account_ref"]),
    "users_secure": ("secured", [*_PROFILE_TEXT, "email", "account_ref"]),
    "user_features": ("feats", [*_PROFILE_TEXT, *(f"variant_{p}" for p in PRODUCTS)]),
    "serving": ("nudged", ["tier", "region", "age_band", "risk_profile", "recommended_product",
                           "nudge_text", "nudge_source"]),
}


def _audit_sql(name: str, source: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select '{name}' as table_name, '{c}' as column_name, '{kind}' as kind,"
        f" count(*) filter (regexp_matches(regexp_replace({c}, '{_MASK}', '\\1', 'g'), '{pattern}')) as violations from {source}"
        for c in columns for kind, pattern in _RAW.items())


@query("pii_audit", sql.select(f"""{sql.NUDGED}, secured as (
 select * replace (regexp_replace(email, '^[^@]+', '****') as email,
  'ACCT-****' || right(account_ref, 4) as account_ref) from users)""",
    " union all ".join(_audit_sql(name, *what) for name, what in _PUBLISHED.items())))
def pii_audit(spark, sf):
    """Every published table, its texts to users included."""
    users = roles.users(spark, sf)
    return privacy.audit({
        "silver_users": users, "users_secure": privacy.secure_view(users),
        "user_features": inputs.user_features(spark, sf),
        "serving": inputs.nudged(spark, sf).select(*serving.columns(PRODUCTS))})


@query("pii_in_text", _audit_sql("documents", "documents", ["text", "lang", "source"]))
def pii_in_text(spark, sf):
    """Personal data inside running text."""
    return privacy.audit_table(roles.load(spark, sf, "documents"), "documents")
