"""Schema drift, the layout by product, the exact split and masks in text."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from liftlab import session
from liftlab.operators import ml, privacy, serving, targeting
from liftlab.sources import drift, versions
from liftlab.streaming import ingest
from tests.conftest import rows


pytestmark = pytest.mark.usefixtures("spark")


def schema(ddl):
    return StructType.fromDDL(ddl)


# ---------------------------------------------------------------- drift
@pytest.mark.parametrize("a, b, both", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "double", "double"), ("smallint", "float", "float"),
    ("int", "float", "double"), ("bigint", "double", "decimal(38,18)"), ("int", "decimal(5,2)", "decimal(21,2)"),
    ("decimal(38,0)", "decimal(38,10)", "string"), ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "timestamp", "timestamp"),
    ("timestamp", "timestamp_ntz", "string"), ("boolean", "int", "string"), ("array<int>", "array<double>", "array<double>"),
    ("struct<x:int>", "struct<x:bigint,y:string>", "struct<x:bigint,y:string>"), ("array<int>", "int", "string")])
def test_types_widen(a, b, both):
    a, b = schema(f"c {a}")["c"].dataType, schema(f"c {b}")["c"].dataType
    assert drift.widened(a, b).simpleString() == drift.widened(b, a).simpleString() == both
    assert drift.widened(a, a) == a


def test_compare_and_evolve():
    feed, delivered = schema("id int, at date, name string, gone double"), schema("name int, at timestamp_ntz, id smallint, more array<int>")
    assert [(c.column, c.change) for c in drift.compare(feed, delivered)] == [
        ("id", "narrower"), ("at", "wider"), ("name", "narrower"), ("gone", "missing"), ("more", "added")]
    assert drift.evolve(feed, delivered).simpleString() == "struct<id:int,at:timestamp_ntz,name:string,gone:double>"
    assert drift.evolve(feed, delivered, add_columns=True).fieldNames()[-1] == "more"
    assert drift.compare(feed, feed) == []


LINES = ['{"id": 1, "amount": 5, "when": "2024-01-02", "who": {"a": 1}, "ok": true}', '{"id": "E-7", "amount": 2.5, "chan": "web", "tags": [1, 2]}',
         "{broken", '{"id": null, "amount": "x"}', "", '{"id": 99999999999, "when": "2024-01-02 03:04:05", "ok": "yes"}',
         '{"price": "1.255", "_raw": "own name"}']


def test_nothing_that_arrives_is_lost(spark, tmp_path):
    lines = spark.createDataFrame([(l,) for l in LINES], "value string")
    lines.coalesce(1).write.text(f"{tmp_path}/in")
    fit = schema("id int, amount double, when date, who struct<a:int>, ok boolean, price decimal(9,2)")
    got = [r.asDict(recursive=True) for r in drift.read_json(spark, f"{tmp_path}/in", fit).collect()]
    assert [g.pop("_corrupt_record") for g in got] == [None, None, "{broken", None, None, None]
    assert [json.loads(g.pop("_rescued") or "{}") for g in got] == [
        {}, {"id": "E-7", "chan": "web", "tags": "[1,2]"}, {}, {"amount": "x"},
        {"id": "99999999999", "when": "2024-01-02 03:04:05", "ok": "yes"}, {"price": "1.255", "_raw": "own name"}]
    assert got[0] == {"id": 1, "amount": 5.0, "when": got[0]["when"], "who": {"a": 1}, "ok": True, "price": None}
    assert str(got[0]["when"]) == "2024-01-02" and got[1]["amount"] == 2.5

    feed = ingest.Feed("f", "json", f"{tmp_path}/in", fit)
    ingest.append(ingest.open_rescued(spark, feed), f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
    landed = spark.read.parquet(f"{tmp_path}/out")
    assert landed.count() == 6 and landed.where("_ingested_at IS NULL OR _source_file IS NULL").count() == 0
    assert landed.where("_rescued IS NOT NULL").count() == 4
    with pytest.raises(ValueError):
        ingest.open_rescued(spark, ingest.Feed("f", "csv", "x", fit))


def test_delivery_with_columns_of_its_own(spark):
    df = spark.createDataFrame([("1", "x", [1]), ("q", None, [2])], "id string, zz string, arr array<int>")
    assert rows(drift.fit_columns(df, schema("id int, amount double"))) == [
        (1, None, '{"arr":"[1]","zz":"x"}'), (None, None, '{"arr":"[2]","id":"q"}')]
    assert rows(drift.fit_columns(df.select("zz"), schema("id string"), keep=["zz"])) == [(None, None, "x"), (None, None, None)]


# ---------------------------------------------------------------- layout by product
def prospects(spark, n=4000):
    return spark.range(n).selectExpr(
        "id AS user_id", "elt(CAST(id % 7 AS INT) + 1, 'a', 'a', 'a', 'a', 'b', 'c', NULL) AS recommended_product",
        "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN double('NaN') ELSE (id * 7919 % 1000) / 1000 END AS propensity_score")


def test_top_of_a_product_opens_few_files(spark, tmp_path):
    df, store = prospects(spark), versions.Versions(spark, f"{tmp_path}/v")
    ready = serving.export_ranked(df, store, "p", rows_a_file=200)
    assert len(ready.read("p").inputFiles()) >= 20
    for product, k, most in (("a", 5, 1), ("b", 5, 1), (None, 5, 1), ("a", 450, 4), ("c", 10_000, 6), ("zz", 5, 0), ("a", 0, 0)):
        files = serving.files_of_top(ready, "p", product, k) if k else []
        assert len(files) <= most
        own = df.where(F.col("recommended_product").eqNullSafe(F.lit(product)))
        want = targeting.top_users(serving.nan_to_null(own), k) if k else own.limit(0)
        got = serving.top_of_group(ready, "p", product, k)
        assert [r.user_id for r in got.collect()] == [r.user_id for r in want.collect()]
    assert ready.read("p.index").selectExpr("sum(rows)").first()[0] == 4000


# ---------------------------------------------------------------- exact split
@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 1.0])
def test_split_has_exact_sizes(spark, share):
    rng = random.Random(3)
    lines = [(i, rng.choice(["p", "q", None]), rng.choice([0, 0, 0, 1, None])) for i in range(700)] + [(900, "single", 1)]
    df = session.written(spark.createDataFrame(lines, "user_id int, product string, label int"), "split")
    split = ml.exact_split(df, ["product", "label"], "user_id", share)
    assert split.columns == ["user_id", "product", "label", "is_test"]
    got = {(r.product, r.label): (r.n, r.t) for r in split.groupBy("product", "label").agg(
        F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert sum(n for n, _ in got.values()) == 701
    assert all(t == int(n * share + 0.5) for n, t in got.values())
    again = ml.exact_split(df.repartition(7), ["product", "label"], "user_id", share)
    assert split.exceptAll(again).count() == 0


def test_split_decides_equal_hashes_by_key(spark):
    """Two keys with one text hash alike, so the border lies between them."""
    df = session.written(spark.createDataFrame([(("x, y", "z"), 1), (("x", "y, z"), 1)], "k struct<a:string,b:string>, label int"), "ties")
    assert [r.k.a for r in ml.exact_split(df, ["label"], "k", 0.5).where("is_test").collect()] == ["x"]


# ---------------------------------------------------------------- masks
def test_personal_data_beside_masks_is_found(spark):
    texts = ["joe*@x.com", "acct-1945446949", "****@b.com", "(****@b.com), ACCT-****1234", "x****@b.com", "mail ann@b.com", "ACCT-12345", "a @ b", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.kind: r.violations for r in privacy.audit_table(df, "x").collect()}
    assert found == {"email": 3, "account_ref": 2}
