"""Physical-plan checks: pushdown, broadcasts, no single-task window on rows."""

import re

import pytest

from pricelake.plans import binding as b

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_pushes_date_rule_to_scan(spark):
    p = plan(b.silver(spark, SF))
    scans = [l for l in p.splitlines() if "FileScan parquet" in l]
    assert any("PushedFilters: [" in s and "Date" in s.split("PushedFilters")[1]
               for s in scans), scans
    # the dedup is an aggregate, not a window over all rows
    assert "Window" not in p
    assert "partial_min" in p


def test_fact_plan_shape(spark):
    p = plan(b.fact(spark, SF))
    # three dimension lookups are broadcast hash joins per branch
    assert p.count("BroadcastHashJoin") >= 3
    # every SinglePartition exchange sits above an aggregate of totals,
    # never directly above the fact rows
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            below = "\n".join(lines[i + 1:i + 3])
            assert "HashAggregate" in below, below
    # one exchange on stock_key feeds both lag and first
    assert len(re.findall(r"Exchange hashpartitioning\(stock_key", p)) == 1
    assert re.search(r"Window \[lag\(close_price.*nth_value\(close_price", p)


def test_marts_read_only_needed_columns(spark):
    from pricelake.operators import marts
    p = plan(marts.portfolio_by_date(b.star(spark, SF)))
    fact_scans = [l for l in p.splitlines()
                  if "FileScan parquet" in l and "/fact-" in l]
    assert fact_scans
    for s in fact_scans:
        schema = s.split("ReadSchema: ")[1]
        assert "close_price" not in schema and "ingested_at" not in schema


def scans(df, table):
    return [line for line in plan(df).splitlines()
            if "FileScan parquet" in line and f"/{table}-" in line]


@pytest.mark.parametrize("name", ["analyst_filter", "date_window", "star_sample"])
def test_date_range_prunes_the_fact(spark, name):
    from pricelake.plans.catalog import QUERIES
    for s in scans(QUERIES[name](spark, SF), "fact"):
        assert "month_key" in s.split("PartitionFilters: [")[1].split("]")[0], s
        assert "date_key" in s.split("PushedFilters: [")[1], s


@pytest.mark.parametrize("name", ["filter_domains", "return_histogram",
                                  "portfolio_by_date", "kpi_instruments"])
def test_marts_scan_the_fact_once(spark, name):
    from pricelake.plans.catalog import QUERIES
    assert len(scans(QUERIES[name](spark, SF), "fact")) == 1


@pytest.mark.parametrize("name", ["latest_slice", "sector_allocation",
                                  "sector_share"])
def test_latest_marts_read_one_more_column(spark, name):
    """The fact's rows once; the newest date comes from its date_key alone
    (one subquery, which a plan may mention several times)."""
    from pricelake.plans.catalog import QUERIES
    got = [s.split("ReadSchema: ")[1] for s in scans(QUERIES[name](spark, SF),
                                                     "fact")]
    assert sum("portfolio_value" in s for s in got) == 1
    assert all(s.startswith("struct<date_key:int>") for s in got
               if "portfolio_value" not in s), got


def test_scd2_merge_joins_once_per_use(spark):
    """Rows and their count per cell for the numbering: two uses, one join
    each."""
    p = plan(b.dim_stock(spark, SF))
    assert len(re.findall(r"(?:SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin)"
                          r".*FullOuter", p)) <= 2


def test_describe_has_no_window_over_a_whole_column(spark):
    from pricelake.plans.catalog import QUERIES
    p = plan(QUERIES["profile_describe"](spark, SF))
    for line in p.splitlines():
        if "Window [" in line:
            # cells of a bracket, or values inside one cell
            assert "cell#" in line, line


def test_building_queries_takes_no_action(spark, monkeypatch):
    """Once the layers are stored, a query is only a plan (but for the reads
    of drops, of the incremental mark and of quartile brackets, and the
    stream)."""
    from pyspark.sql.classic.dataframe import DataFrame

    from pricelake.plans.catalog import QUERIES
    lazy = [n for n in QUERIES if n not in (
        "landing_read", "incremental_load", "incremental_stream",
        "profile_describe")]
    for name in lazy:
        QUERIES[name](spark, SF)
    for action in ("count", "collect", "first", "head", "take", "isEmpty",
                   "toPandas", "toLocalIterator"):
        def refuse(self, *a, _name=action, **kw):
            raise AssertionError(f"{_name} while a query is built")
        monkeypatch.setattr(DataFrame, action, refuse)
    for name in lazy:
        if name not in ("bronze_append", "silver_write", "dim_snapshot_read",
                        "gold_write", "run_all", "watermark_commit"):
            QUERIES[name](spark, SF)


@pytest.mark.parametrize("name", ["fund_ranking", "ticker_total_return",
                                  "ticker_avg_return", "ticker_summary",
                                  "kpi_instruments"])
def test_joins_see_one_row_per_stock(spark, name):
    """The fact is aggregated by stock_key below every join."""
    from pricelake.plans.catalog import QUERIES
    fact_path = plan(QUERIES[name](spark, SF)).splitlines()
    at = next(i for i, line in enumerate(fact_path)
              if "FileScan parquet" in line and "/fact-" in line)
    depth = len(re.match(r"[ :+-]*", fact_path[at]).group())
    above = []
    for line in reversed(fact_path[:at]):
        d = len(re.match(r"[ :+-]*", line).group())
        if d < depth:
            depth = d
            above.append(line)
    joins = [i for i, line in enumerate(above) if "Join" in line]
    aggs = [i for i, line in enumerate(above)
            if "Aggregate(keys=[stock_key" in line]
    assert joins and aggs and max(aggs[:2]) < joins[0], above


def test_totals_per_date_meet_the_calendar_once_per_date(spark):
    from pricelake.plans.catalog import QUERIES
    p = plan(QUERIES["portfolio_by_date"](spark, SF))
    assert "LeftSemi" in p
    top = p.index("Join")
    assert "keys=[date_key" in p[top:] and p.count("Aggregate(keys=[date_key") == 2


@pytest.mark.parametrize("name", ["daily_summary", "kpi_day_change",
                                  "latest_slice", "sector_share"])
def test_newest_dates_prune_months(spark, name):
    """Of the fact's rows only the newest months' files are read."""
    from pricelake.plans.catalog import QUERIES
    df = QUERIES[name](spark, SF)
    rows = [s for s in scans(df, "fact") if "portfolio_value" in
            s.split("ReadSchema: ")[1]]
    assert rows
    for s in rows:
        assert "month_key" in s.split("PartitionFilters: [")[1].split("]")[0], s
    jdf = df._jdf.queryExecution()
    df.collect()
    nodes = jdf.executedPlan().toString()
    assert nodes
    months = b.fact_table(spark, SF, months=True).select("month_key") \
        .distinct().count()
    from pricelake.operators import marts
    newest = marts.newest_fact(b.fact_table(spark, SF, months=True), 10)
    assert newest.select("month_key").distinct().count() <= 2 < months
    assert newest.select("date_key").distinct().count() == 10


def test_freshness_joins_one_row(spark):
    from pricelake.plans.catalog import QUERIES
    p = plan(QUERIES["freshness"](spark, SF))
    join = next(i for i, line in enumerate(p.splitlines()) if "Join" in line)
    below = "\n".join(p.splitlines()[join:])
    assert "max(date_key" in below and "FileScan" in below
