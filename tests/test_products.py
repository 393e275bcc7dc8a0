from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from floe.operators import products as P
from floe.streaming.incremental import plan_work

COLUMNS = "product_id bigint, region string, first_time timestamp, second_time timestamp, created_time timestamp, synthetic boolean, status string"
DONE = "candidate_classification"


def table(spark, *rows):
    full = [(k, region, datetime(2021, 1, 1), second, datetime(2021, 12, 1), synthetic, status) for k, region, second, synthetic, status in rows]
    return spark.createDataFrame(full, COLUMNS)


@pytest.fixture(scope="module")
def products(spark):
    return table(
        spark,
        (1, "Davis", datetime(2021, 10, 22), False, DONE),
        (2, "Davis", datetime(2021, 10, 29, 23, 59, 59), False, DONE),
        (3, "Davis", datetime(2021, 10, 29, 23, 59, 59), True, DONE),
        (4, "Davis", datetime(2021, 11, 9, 23, 59, 59, 500000), False, DONE),
        (5, "Casey", datetime(2021, 12, 30), False, "segmentation_only"),
    )


def test_as_of_includes_the_day(products):
    latest = lambda day: {r.region: r.product_id for r in P.latest_product(products, day).collect()}
    assert latest("2021-10-21") == {}
    assert latest("2021-10-22") == {"Davis": 1}
    assert latest("2021-10-29") == {"Davis": 3}
    assert latest("2021-11-09") == {"Davis": 3}
    assert latest("2021-11-10") == {"Davis": 4}


def test_weekly_series_equals_single_dates(products):
    series = P.latest_per_week(products, 2021, 10, 1, columns=["product_id"])
    got = {(r.issue_date, r.region): r.product_id for r in series.collect()}
    dates = [r.issue_date for r in P.season_dates(products.sparkSession, 2021, 10, 1).collect()]
    assert dates[0] == date(2021, 10, 1) and dates[-1] <= date(2022, 1, 31) and len(dates) == 18
    expected = {(d, r.region): r.product_id for d in dates for r in P.latest_product(products, d.isoformat()).collect()}
    assert got == expected


def test_previous_is_strictly_earlier_and_alike(products):
    got = {r.product_id: r.prev_product_id for r in P.previous_product(products, ["product_id"], "month").collect()}
    assert got == {1: None, 2: 1, 3: None, 4: 2, 5: None}


def test_reuse_conflict_and_new(spark):
    wanted = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "pair_id string, fingerprint string")
    known = spark.createDataFrame([("a", "1"), ("b", "9")], "pair_id string, fingerprint string")
    assert {r.pair_id: r.action for r in plan_work(wanted, known).collect()} == {"a": "reuse", "b": "conflict", "c": "process"}
    assert [r.pair_id for r in P.new_pairs(wanted, known).collect()] == ["c"]
    assert [r.pair_id for r in P.reused_pairs(wanted, known).collect()] == ["a"]
    assert [r.existing for r in P.conflicting_pairs(wanted, known).collect()] == ["9"]


def test_null_equals_null_in_comparison(spark):
    df = spark.sql(
        "select 'p' a, cast(null as string) c, 'm' m, map('x', '1', 'y', '2') h, map('y', '2', 'x', '1') h2, 'code' i, struct(1 as w) g"
    )
    side = lambda h: {"processing": F.col("a"), "segmentation": F.col("a"), "classifier": F.col("c"), "coastline": F.col("m"), "resource_hashes": F.col(h), "implementation_hash": F.col("i"), "grid": F.col("g")}
    assert df.select(P.comparable(side("h"), side("h2")).alias("ok")).first().ok
    other = {**side("h2"), "classifier": F.lit("model")}
    assert not df.select(P.comparable(side("h"), other).alias("ok")).first().ok


def test_wording(spark):
    df = spark.createDataFrame([(datetime(2021, 10, 10), datetime(2021, 10, 22), date(2021, 10, 10))], "a timestamp, b timestamp, since date")
    text = lambda status, *rest: df.select(P.summary_text(F.lit(False), F.lit(status), F.col("a"), F.col("b"), F.lit(12.0), F.lit(3.14), *rest).alias("t")).first().t
    assert text(DONE).startswith("Observations 2021-10-10 to 2021-10-22 (12.0-day baseline). Candidate fast-ice coverage: 3.1 km²")
    assert "no current-conditions" in text(DONE, F.lit(15)) and "no current-conditions" not in text(DONE, F.lit(14))
    changed = (F.lit(1), F.lit(1.26), F.lit(0.0), F.lit(5.0), F.col("since"))
    assert text(DONE, *changed).endswith("gain 1.3 km², loss 0.0 km² since 2021-10-10.")
    without = (F.lit(1), F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(None).cast("double"))
    assert text(DONE, *without, F.col("since")).endswith("No comparable prior classification is available for change assessment.")
    assert "comparable" not in text(DONE, *without, F.lit(None).cast("date"))


def test_transfer_review(spark):
    models = spark.createDataFrame(
        [("m", "Davis", False, "mean_RGB_uint8", "HH", "c", False), ("x", None, False, "mean_RGB_uint8", "HV", None, True), ("s", "Davis", True, "mean_RGB_uint8", None, "c", False)],
        "model_id string, region string, synthetic boolean, features string, polarization string, contract string, requires_review boolean",
    )
    products = spark.createDataFrame(
        [(1, "Davis", False, "HH", "c", False), (2, "Casey", False, "HH", "c", False), (3, "Casey", False, "HH", "c", True)],
        "product_id bigint, region string, synthetic boolean, polarization string, contract string, allow_transfer boolean",
    )
    requests = spark.createDataFrame([("m", 1), ("m", 2), ("m", 3), ("x", 1), ("s", 1)], "model_id string, product_id bigint")
    got = {(r.model_id, r.product_id): r.review for r in P.review_transfer(requests, models, products).collect()}
    assert got == {("m", 1): "accepted", ("m", 2): "needs_permission", ("m", 3): "accepted_transfer", ("x", 1): "refused", ("s", 1): "refused"}


def test_reference_names(spark):
    refs = spark.createDataFrame(
        [("ok", "ref_20211010_20211022", "x"), ("file", "ref_20211010_20211023", "x"), ("folder", "plain", "20211011_20211022"), ("none", "plain", "x")], "k string, file_name string, folder_name string"
    ).withColumns({"first_date": F.lit("2021-10-10").cast("date"), "second_date": F.lit("2021-10-22").cast("date")})
    assert {r.k for r in P.conflicting_names(refs).collect()} == {"file", "folder"}
