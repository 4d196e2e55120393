import oracle
import pytest

from tidemark.plans import catalogue

SQL = catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    oracle.check(spark, sf_dir, catalogue.queries()[name], SQL[name])


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(SQL)


#: Known results: (window end) to upserts, deletes, target rows, sum of positions.
GOLDEN = {
    "upsert": [(243, 63, 239, 43493), (251, 64, 443, 165858), (229, 54, 591, 327938)],
    "op_gated": [(243, 63, 239, 43493), (251, 64, 443, 162918), (229, 54, 591, 324214)],
}


@pytest.mark.parametrize("profile", sorted(GOLDEN))
@pytest.mark.parametrize("fused", [False, True])
def test_golden_windows(spark, sf_dir, profile, fused):
    for n, (_, _, rows, positions) in enumerate(GOLDEN[profile], 1):
        got = catalogue.replay(spark, sf_dir, profile, n, fused).agg({"pos": "sum", "*": "count"}).first()
        assert (got["count(1)"], got["sum(pos)"]) == (rows, positions)


def test_golden_stage(spark, sf_dir):
    got = catalogue.staged(spark, sf_dir)
    assert (got.upserts.count(), got.deletes.count()) == GOLDEN["upsert"][0][:2]


def test_session_zone_does_not_matter(spark, sf_dir):
    from tidemark.functions import coerce as co
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("1704067200000", "2024-01-01T05:30:00+05:30", "2024-01-01T00:00:00")], "ms string, iso string, bare string")
    for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            r = df.select(co.epoch_millis(F.col("ms")).alias("a"), co.iso_to_utc(F.col("iso")).alias("b"), co.iso_to_utc(F.col("bare")).alias("c")).first()
            assert str(r.a) == str(r.b) == str(r.c) == "2024-01-01 00:00:00"
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_log_scan_pushes_the_window_down(spark, tmp_path):
    from tidemark.operators import window
    from tidemark.plans.catalogue import ENDS
    from tidemark.sources import feeds

    feeds.events(spark, "/root/testdata/sf0.001").write.partitionBy("load_date").parquet(str(tmp_path / "log"))
    plan = window.in_window(spark.read.parquet(str(tmp_path / "log")), ENDS[0], ENDS[1]).select("data")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(load_ts)" in plan and "PartitionFilters: [isnotnull(load_date" in plan
