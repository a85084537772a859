"""Files to gold: incremental bronze, then silver and gold rebuilt from it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlab.operators import dedup, experiments, features, privacy, quality, silver
from liftlab.settings import Settings
from liftlab.sources import files, versions
from liftlab.streaming import ingest


CATALOG_RULES = {"valid_product": "product IS NOT NULL"}
# A line that could not be read has no columns to judge by.
READABLE = {"readable_line": f"{files.CORRUPT} IS NULL"}


@dataclass(frozen=True)
class Feeds:
    users: ingest.Feed
    events: ingest.Feed
    assignments: ingest.Feed
    catalog: ingest.Feed | None = None

    def all(self) -> list[ingest.Feed]:
        feeds = [self.users, self.events, self.assignments]
        return feeds if self.catalog is None else [*feeds, self.catalog]


@dataclass
class Layers:
    users: DataFrame
    events: DataFrame
    assignments: DataFrame
    features: DataFrame
    results: DataFrame
    secure_users: DataFrame
    #: feed, rule, passed, failed; over all deliveries, before the newest one per key is chosen
    rule_counts: DataFrame
    #: per feed the rows that a rule kept out of silver, with the names of these rules
    quarantine: Mapping[str, DataFrame]
    catalog: DataFrame | None = None


def refresh(spark: SparkSession, feeds: Feeds, base: str, settings: Settings, keep: int = 2) -> Layers:
    """One full refresh. Each layer is written before the next one reads it, so no layer is
    computed twice; running it again without new files gives the same tables.

    All tables are written beside those of the last refresh and become visible in one commit, so a refresh that is lost
    leaves them as they were. The tables returned are pinned to their version; ``keep`` versions stay readable.

    No delivered row is lost silently: it is in silver, superseded by a newer row of its key, or
    in quarantine. A feed without files gives empty tables.
    """
    ingest.run_once(spark, feeds.all(), base)
    rules = {
        feeds.users.name: silver.USER_RULES, feeds.events.name: silver.EVENT_RULES,
        feeds.assignments.name: silver.ASSIGNMENT_RULES}
    if feeds.catalog is not None:
        rules[feeds.catalog.name] = CATALOG_RULES
    bronze = {feed.name: ingest.bronze(spark, base, feed) for feed in feeds.all()}
    strict = {name: {**(READABLE if files.CORRUPT in bronze[name].columns else {}), **own}
              for name, own in rules.items()}
    split = {name: quality.split(bronze[name], strict[name]) for name in bronze}

    def good(feed: ingest.Feed) -> DataFrame:
        return split[feed.name][0].drop(files.CORRUPT)

    def counts(name: str) -> DataFrame:
        warnings = silver.EVENT_WARNINGS if name == feeds.events.name else {}
        report = quality.expectation_report(bronze[name], {**strict[name], **warnings})
        return report.select(F.lit(name).alias("feed"), "*")

    store = versions.Versions(spark, f"{base}/tables")
    now = store.snapshot()

    def side_by_side(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
        """Write independent tables at the same time: one's stragglers leave cores to the others."""
        nonlocal now

        @inheritable_thread_target(spark)
        def write(item: tuple[str, DataFrame]) -> versions.Table:
            return store.whole(*item)

        with ThreadPool(len(tables)) as pool:
            now = now.apply(dict(zip(tables, pool.map(write, tables.items()))))
        return [now.read(name) for name in tables]

    tables = {
        "silver/users": silver.users(good(feeds.users)),
        "silver/events": silver.events(good(feeds.events), settings.launch),
        "silver/assignments": silver.assignments(good(feeds.assignments)),
        "quality/rule_counts": reduce(DataFrame.unionByName, [counts(name) for name in bronze]),
        **{f"quarantine/{name}": bad for name, (_, bad) in split.items()},
    }
    if feeds.catalog is not None:
        tables["silver/catalog"] = dedup.latest(good(feeds.catalog), ["product"], silver.ARRIVAL)
    written = dict(zip(tables, side_by_side(tables)))
    users, events, assignments = (written[f"silver/{name}"] for name in ("users", "events", "assignments"))
    gold, secure = side_by_side({
        "gold/user_features": features.user_features(users, events, assignments, settings),
        "gold/users_secure": privacy.secure_view(users),
    })
    results, = side_by_side({"gold/experiment_results": experiments.results(gold, settings)})
    store.commit(now)
    store.vacuum(keep)
    return Layers(users, events, assignments, gold, results, secure, written["quality/rule_counts"],
                  {name: written[f"quarantine/{name}"] for name in bronze}, written.get("silver/catalog"))
