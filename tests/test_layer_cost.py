"""What the steps shared by the larger base queries may cost."""

import datetime as dt

from pyspark.sql import functions as F

from pricelake.functions.text import PY_WHITESPACE, py_strip
from pricelake.operators import marts
from pricelake.operators import silver as sv
from pricelake.session import LAYER_PARTITIONS, layer_settings


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_visible_ends_are_not_trimmed(spark):
    texts = [None, "", " ", "a", "~", "\x7f", "\x7fa", "a\x7f", "a b", " a", "a ",
             "!x!", "é", "é a", "a é", "퟿", *PY_WHITESPACE,
             *[f"{c}a" for c in PY_WHITESPACE], *[f"a{c}" for c in PY_WHITESPACE],
             *[f"é{c}" for c in PY_WHITESPACE], "​a", "a​", "\x00a\x00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(py_strip("t").alias("t")).collect()]
    assert got == [None if t is None else t.strip() for t in texts]
    assert "CASE WHEN" in _plan(df.select(py_strip("t")))


def test_ticker_history_is_sorted_once(spark):
    days = [dt.date(2001, 1, 1) + dt.timedelta(i) for i in range(20)]
    rows = [(t, d, float(i), None, f"fund {t} {i}", "s", "mutual_fund")
            for t in (None, "A", "B") for i, d in enumerate(days)]
    star = spark.createDataFrame(
        rows, "ticker_symbol string, trade_date date, close_price double, "
        "daily_return_pct double, fund_name string, sector string, "
        "instrument_type string").repartition(5)
    out = marts.ticker_history(star)
    plan = _plan(out).split("Initial Plan")[-1]
    assert "hashpartitioning(ticker_symbol" not in plan
    assert plan.count("rangepartitioning") == 1 and plan.count("Sort ") == 1
    got = out.collect()
    assert [(r[0], r[1]) for r in got] == [(r[0], r[1]) for r in rows]
    assert {(r["ticker_symbol"], r["fund_name"], r["type_label"]) for r in got} \
        == {(t, f"fund {t} 0", "Mutual Fund") for t in (None, "A", "B")}


def test_no_bucket_is_looked_up_where_none_is_heavy(spark):
    df = spark.createDataFrame(
        [("A", 1, 2), ("A", 1, 1), ("B", 1, 3), (None, 1, 4)], "t string, d int, o int")
    out = sv.dedup_first(df, ["t", "d"], ["o"])
    assert "size(" in _plan(out)
    for heavy_rows in (0, 1, 10):
        assert {tuple(r) for r in sv.dedup_first(
            df, ["t", "d"], ["o"], heavy_rows=heavy_rows).collect()} \
            == {("A", 1, 1), ("B", 1, 3), (None, 1, 4)}


def test_layers_begin_with_many_partitions(spark):
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(first, None)
    try:
        with layer_settings(spark):
            plan = _plan(spark.range(9).groupBy(F.col("id") % 3).count())
            assert f", {LAYER_PARTITIONS})" in plan
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(first, None) == before
