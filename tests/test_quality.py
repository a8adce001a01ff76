"""Profiling equals pandas describe."""

import pandas as pd
import pytest

from pricelake.operators import quality
from pricelake.operators.quality import (duplicate_audit, profile_describe,
                                         profile_nulls, repeat_candidates)


def test_describe_matches_pandas(spark):
    a = [5.0, 1.0, 3.0, 3.0, None, 10.0, 7.5, 2.0]
    b = [1, 2, 3, 4, 5, 6, 7, 8]
    pdf = pd.DataFrame({"a": a, "b": b})
    df = spark.createDataFrame(
        [(x, y) for x, y in zip(a, b)], "a double, b bigint")
    got = {r.column_name: r for r in profile_describe(df).collect()}
    want = pdf.describe()
    for c in ["a", "b"]:
        for stat, key in [("count", "count"), ("mean", "mean"), ("std", "std"),
                          ("min", "min"), ("25%", "p25"), ("50%", "p50"),
                          ("75%", "p75"), ("max", "max")]:
            assert got[c][key] == pytest.approx(want[c][stat]), (c, stat)


@pytest.mark.parametrize("digits,cells", [(1024, 4096), (1, 8), (1, 1), (64, 1)])
def test_describe_is_exact_at_every_size(spark, monkeypatch, digits, cells):
    """Digits and cells give what ranking all values gives."""
    from pricelake.operators import quality
    monkeypatch.setattr(quality, "DIGITS", digits)
    monkeypatch.setattr(quality, "CELLS", cells)
    n = 20_011
    df = spark.range(n).selectExpr(
        "cast((id * 7919) % 20011 as double) as spread",
        "cast(id % 8 as int) as hot",
        "case when id % 3 = 0 then 5 else pow(1.001, id % 9000) end as skewed",
        "case when id % 2 = 0 then null when id % 5 = 0 then double('nan') "
        "else -id / 7 end as holes",
        "cast(null as double) as none",
        "case id % 7 when 0 then double('1e300') when 1 then double('-4.9e-324') "
        "when 2 then 0.0D when 3 then -0.0D else -id * 1e-5D end as wide")
    want = df.toPandas().describe()
    got = {r.column_name: r for r in profile_describe(df).collect()}
    for c in df.columns:
        for stat, key in [("count", "count"), ("25%", "p25"), ("50%", "p50"),
                          ("75%", "p75"), ("max", "max"), ("min", "min")]:
            if c == "none":
                assert got[c].count in (0, 0.0) or got[c]["count"] == 0
                assert got[c][key] is None or key == "count"
            else:
                assert got[c][key] == pytest.approx(want[c][stat]), (c, stat)


def test_describe_infinite_and_no_columns(spark):
    from pyspark.sql import functions as F
    inf = float("inf")
    df = spark.createDataFrame([(v, "s") for v in (-inf, -1.0, 2.0, inf, inf)],
                               "x double, s string")
    got = profile_describe(df).first()
    assert (got["count"], got.min, got.p25, got.p50, got.p75, got.max) == \
        (5.0, -inf, -1.0, 2.0, inf, inf)
    assert profile_describe(df.select("s")).count() == 0
    empty = profile_describe(df.where(F.lit(False))).first()
    assert empty["count"] == 0 and empty.p50 is None


def test_describe_combines_in_the_map_tasks(spark):
    """The second scan counts per distinct value before the shuffle, after a
    join with the few brackets."""
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = profile_describe(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "BroadcastHashJoin [i" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_profile_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "x int, y string")
    got = {r.column_name: r.null_count for r in profile_nulls(df).collect()}
    assert got == {"x": 1, "y": 2}


@pytest.mark.parametrize("buckets", [1, 7, 1 << 16])
@pytest.mark.parametrize("case", ["hot", "ties", "few", "none", "empty"])
def test_duplicate_audit_is_exact(spark, monkeypatch, buckets, case):
    """However many keys share a bucket, the answer is that of counting all."""
    monkeypatch.setattr(quality, "BUCKETS", buckets)
    key = {"hot": "case when id % 3 = 0 then 1 else id div 2 end",
           "ties": "id div 2", "few": "case when id < 9 then id div 3 else id end",
           "none": "id", "empty": "id"}[case]
    n = 0 if case == "empty" else 3000
    df = spark.range(n).selectExpr(
        f"cast({key} as string) as k",
        "case when id % 3 = 0 then null else 1 end as j", "id as x")
    want = (df.groupBy("k", "j").count().where("count > 1")
            .selectExpr("k", "j", "count as occurrences")
            .orderBy("occurrences", "k", "j", ascending=[False, True, True])
            .limit(10).collect())
    assert duplicate_audit(df, ("k", "j")).collect() == want


def test_duplicate_audit_rules_out_unique_keys(spark):
    """Beside frequent keys, hardly a unique one is counted by key."""
    df = spark.range(200_000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id < 900 then 'warm' "
        "|| cast(id % 12 as string) else cast(id as string) end as k")
    left = repeat_candidates(df, ["k"], 9)
    single = left.where("k <> 'hot' and k not like 'warm%'").count()
    assert 0 <= single < 200
    assert left.where("k = 'hot'").count() == 66_667
    got = duplicate_audit(df, ["k"], 9).collect()
    assert (got[0]["k"], got[0]["occurrences"]) == ("hot", 66_667)
    assert [r["occurrences"] for r in got[1:]] == [75] * 8
