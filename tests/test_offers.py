import pandas as pd
import pytest

from liftlab import Settings
from liftlab.operators import nudges, privacy, recommend, reports, serving
from liftlab.settings import CATALOG, CATALOG_SCHEMA
from liftlab.sources import files
from tests.conftest import rows

SETTINGS = Settings(launch="2026-06-01")
P = SETTINGS.products
NAN = float("nan")


def _scores(spark, *data):
    return spark.createDataFrame(
        [(f"u{i}", *probs) for i, probs in enumerate(data)],
        "user_id string, prob_crypto double, prob_options double, prob_agentic double")


def test_first_product_wins_ties_and_missing_scores_lose(spark):
    df = _scores(spark, (0.4, 0.4, 0.4), (NAN, 0.3, None), (0.1, 0.2, 0.2), (None, None, None))
    assert rows(recommend.assemble(df, P), "user_id", "recommended_product", "propensity_score") == [
        ("u0", "crypto", 0.4), ("u1", "options", 0.3), ("u2", "options", 0.2), ("u3", None, None)]


def test_expected_value_reads_the_fee_from_the_catalog(spark):
    catalog = files.from_rows(spark, CATALOG, CATALOG_SCHEMA)
    df = recommend.assemble(_scores(spark, (0.1, 0.957, 0.2), (None, None, None)), P)
    got = recommend.expected_value(df, catalog.unionAll(catalog), SETTINGS)  # a repeated entry adds no rows
    assert rows(got, "user_id", "expected_annual_value_usd") == [("u0", 71.78), ("u1", None)]


def test_top_products_are_ordered_per_user(spark):
    df = _scores(spark, (0.4, 0.4, 0.5), (NAN, 0.3, None))
    assert rows(recommend.top_products(df, P, 2), "user_id", "place", "product") == [
        ("u0", 1, "agentic"), ("u0", 2, "crypto"), ("u1", 1, "options")]


def test_undecided_rule_excludes(spark):
    df = spark.createDataFrame([("crypto", None), ("options", None), ("options", "aggressive")],
                               "product string, risk_profile string")
    assert rows(recommend.eligible(df, {"options": "risk_profile = 'aggressive'"})) == [
        ("crypto", None), ("options", "aggressive")]


def _recs(spark):
    return spark.createDataFrame(
        [(f"u{i}", "gold", "moderate", "18-25", "crypto", 1 - i / 10, 3, None) for i in range(5)],
        "user_id string, tier string, risk_profile string, age_band string, recommended_product string, "
        "propensity_score double, trades_total long, active_days long")


def test_missing_profile_value_does_not_empty_the_prompt(spark):
    text = nudges.prompt(_recs(spark)).first().prompt
    assert "active_days=unknown" in text and "crypto trading" in text


def test_generated_for_the_top_templated_for_the_rest(spark):
    def write(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda p: "you, try it" if p else None)

    got = nudges.assemble(_recs(spark), write, k=2)
    assert got.count() == 5
    assert rows(reports.nudge_split(got)) == [("llm_personalized", 2), ("templated", 3)]
    assert rows(got.where("nudge_source = 'llm_personalized'"), "user_id") == [("u0",), ("u1",)]


def test_each_prompt_is_sent_once(spark):
    sent = spark.sparkContext.accumulator(0)

    def write(prompts: pd.Series) -> pd.Series:
        sent.add(len(prompts))
        return prompts.map(lambda _: "you")

    got = nudges.assemble(_recs(spark), write, k=2)
    got.count(), got.collect()
    assert sent.value == 2


def test_audit_finds_data_inside_a_sentence(spark):
    df = spark.createDataFrame([("Your account ACCT-1945446949 is ready",), ("** mail joe@x.com",),
                                ("a@b.c and d@e.f",), ("****@x.com ACCT-****1234",), (None,)], "t string")
    got = {r.kind: r.violations for r in privacy.audit_table(df, "x").collect()}
    assert got == {"email": 2, "account_ref": 1}


def test_silent_generator_falls_back_to_the_template(spark):
    got = nudges.assemble(_recs(spark), lambda prompts: prompts.map(lambda _: None), k=3)
    assert rows(reports.nudge_split(got)) == [("templated", 5)]


def test_guardrails_see_long_and_promising_texts(spark):
    df = spark.createDataFrame([("you " * 46,), ("You get a GUARANTEED return \U0001F680",), ("fine for you",)],
                               "nudge_text string")
    assert rows(nudges.guardrail_report(df)) == [
        ("at_most_45_words", 2, 1), ("no_emoji", 2, 1), ("no_promise", 2, 1), ("speaks_to_you", 3, 0)]


def test_masks(spark):
    df = spark.createDataFrame([("user100000@shop-example.com", "ACCT-1945446949"), (None, None)],
                               "email string, account_ref string")
    assert rows(privacy.secure_view(df)) == [("****@shop-example.com", "ACCT-****6949"), (None, None)]
    assert rows(privacy.secure_view(df, privileged=True)) == rows(df)


def test_audit_finds_a_renamed_column(spark):
    df = spark.createDataFrame([("a@b.com", 1), ("****@b.com", 2)], "contact string, n int")
    assert rows(privacy.audit({"t": df}).where("violations > 0")) == [("t", "contact", "email", 1)]


def test_concentration_and_gains_cover_everything(spark):
    df = spark.createDataFrame([(1, 60.0), (3, 20.0), (4, 10.0), (10, 10.0)],
                               "targeting_decile int, expected_annual_value_usd double")
    assert rows(reports.concentration(df)) == [("remaining", 2, 20.0, 20.0), ("targeted", 2, 80.0, 80.0)]


def test_mix_is_ordered_by_value(spark):
    df = spark.createDataFrame([("options", 0.5, 10.0), ("crypto", 0.4, 30.0)],
                               "recommended_product string, propensity_score double, expected_annual_value_usd double")
    assert [r.recommended_product for r in reports.mix(df).collect()] == ["crypto", "options"]


def test_unknown_product_codes_are_refused():
    with pytest.raises(ValueError):
        Settings(launch="2026-06-01", products=("a b",))
    with pytest.raises(ValueError):
        Settings(launch="June 1")


def test_nan_becomes_null_before_export(spark):
    df = spark.createDataFrame([(NAN, "x"), (1.0, "y")], "a double, b string")
    assert rows(serving.nan_to_null(df)) == [(1.0, "y"), (None, "x")]
