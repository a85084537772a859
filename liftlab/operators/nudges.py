"""Outreach texts: generated for a budgeted top cohort, templated for everyone else."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlab import session
from liftlab.operators import quality, targeting
from liftlab.settings import PRODUCT_LABELS

Generator = Callable[[pd.Series], pd.Series]

# The templated message and the two source names.
TEMPLATE = ("Based on your recent activity, {label} on {brand} may be a good fit. "
            "Explore it in the app when you are ready.")
GENERATED = "llm_personalized"
TEMPLATED = "templated"
# Rules that a finished text has to keep, as SQL predicates on nudge_text.
GUARDRAILS = {
    "at_most_45_words": "size(split(trim(nudge_text), '[ \\t\\n]+')) <= 45",
    "no_emoji": "NOT nudge_text RLIKE '[\\\\x{1F300}-\\\\x{1FAFF}\\\\x{2600}-\\\\x{27BF}]'",
    "no_promise": "NOT lower(nudge_text) RLIKE 'guarantee|risk-free|promise'",
    "speaks_to_you": "lower(nudge_text) RLIKE 'you'",
}


# Columns of a user that a prompt lists unless the caller names others.
PROFILE = ("tier", "risk_profile", "age_band", "trades_total", "active_days")


def prompt_text(profile: Sequence[str] = PROFILE, rules: Sequence[str] = tuple(GUARDRAILS)) -> str:
    """Offer, brand, the given columns and the names of the rules that the answer is checked by."""
    facts = "; ".join(f"{c}={{{c}}}" for c in profile)
    return f"offer={{label}}; brand={{brand}}; {facts}; rules={','.join(rules)}"


def product_label(product: str = "recommended_product",
                  labels: Mapping[str, str] = PRODUCT_LABELS) -> Column:
    """The spoken name of a product; NULL for an unknown one."""
    result = F.lit(None).cast("string")
    for code, label in labels.items():
        result = F.when(F.col(product) == code, F.lit(label)).otherwise(result)
    return result


def _fill(text: str, values: Mapping[str, Column]) -> Column:
    """``text`` with its {names} replaced by columns; a missing value reads "unknown"."""
    parts: list[Column] = []
    rest = text
    while "{" in rest:
        before, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        parts += [F.lit(before), F.coalesce(values[name].cast("string"), F.lit("unknown"))]
    return F.concat(*parts, F.lit(rest))


def with_label(recs: DataFrame) -> DataFrame:
    return recs.withColumn("product_label", product_label())


def template(recs: DataFrame, brand: str = "our platform", name: str = "nudge_text") -> DataFrame:
    values = {"label": product_label(), "brand": F.lit(brand)}
    return recs.withColumn(name, _fill(TEMPLATE, values))


def prompt(recs: DataFrame, brand: str = "our platform", text: str | None = None,
           name: str = "prompt") -> DataFrame:
    """``text`` (by default ``prompt_text()``) with its {names} filled from the row."""
    values = {c: F.col(c) for c in recs.columns}
    return recs.withColumn(name, _fill(text or prompt_text(), {**values, "label": product_label(), "brand": F.lit(brand)}))


def generate(prompts: DataFrame, generator: Generator, key: str = "user_id") -> DataFrame:
    """(key, nudge_text) from (key, prompt): batches of prompts go to the caller's function."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "nudge_text": generator(batch["prompt"])})

    wanted = prompts.select(key, "prompt")
    key_type = wanted.schema[key].dataType.simpleString()
    return wanted.mapInPandas(run, schema=f"{key} {key_type}, nudge_text string")


def assemble(recs: DataFrame, generator: Generator, k: int = 750, brand: str = "our platform",
             parallel_calls: int = 8, key: str = "user_id") -> DataFrame:
    """Recommendations with label, text and source of the text.

    Only the k best users reach the generator, spread over ``parallel_calls`` tasks. Its texts
    are written before they are used, so that each prompt is sent once however often the result is
    read, and joined back by the unique key as Catalyst decides from their size. A user for whom
    the generator returned nothing gets the template, and the source says so.
    """
    best = targeting.top_users(recs, k, key=key)
    texts = generate(prompt(best, brand).select(key, "prompt").repartition(parallel_calls), generator, key)
    texts = session.written(texts, "texts").withColumnRenamed("nudge_text", "_generated")
    joined = template(with_label(recs), brand, "_template").join(texts, key, "left")
    return joined.withColumns({
        "nudge_text": F.coalesce("_generated", "_template"),
        "nudge_source": F.when(F.col("_generated").isNotNull(), F.lit(GENERATED)).otherwise(F.lit(TEMPLATED)),
    }).drop("_generated", "_template")


def guardrail_report(nudged: DataFrame, rules: Mapping[str, str] = GUARDRAILS) -> DataFrame:
    return quality.expectation_report(nudged, rules)
