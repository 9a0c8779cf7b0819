"""Relations that must hold between results, whatever the data, and the shape of plans."""

import re

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as registry
from support import SF_DIR, rows
from orelode.operators import gold, quality, silver
from orelode.plans import analytics
from orelode.plans.lake import SalesLake


def one(frame):
    return frame.collect()[0].asDict()


def test_forecast_equals_the_clean_layer(lake):
    forecast = one(quality.quality_silver_forecast(lake.orders_raw()))
    totals = one(silver.silver_totals(lake.orders_clean()))
    assert (forecast["silver"], forecast["revenue"]) == (totals["rows"], totals["revenue"])


def test_rejected_rows_account_for_the_difference(lake):
    removed = sum(r["rows"] for r in silver.rejected_by_rule(lake.orders_raw()).collect())
    assert lake.orders_raw().count() - removed == lake.orders_clean().count()


def test_monthly_and_country_figures_add_up(lake):
    fact = lake.fact_sales()
    total = one(fact.agg(F.round(F.sum("line_amount"), 2).alias("r"), F.count("*").alias("n")))
    monthly = analytics.q3_monthly(fact, lake.dim_date()).collect()
    assert sum(r.lines for r in monthly) == total["n"]
    assert round(sum(r.revenue for r in monthly), 2) == total["r"]
    baskets = analytics.q4_basket_by_country(fact).collect()
    assert round(sum(r.revenue for r in baskets), 2) == total["r"]
    orders = one(analytics.q3_additivity_check(fact, lake.dim_date()))
    assert orders["monthly_orders_sum"] == orders["true_orders"]


def test_orphan_impact_equals_the_orphan_populations(lake):
    found = analytics.q6_orphan_population(lake.fact_sales())
    orphans = found.filter(F.col("population") != analytics.COMPLETE_KEYS)
    sums = one(orphans.agg(F.sum("lines").alias("n"), F.round(F.sum("revenue"), 2).alias("r")))
    # Customer 0 is known but not counted among customers with a positive id.
    fact = lake.fact_sales().filter("customer_id <> 0")
    impact = one(analytics.q6_orphan_impact(fact, lake.dim_product(), lake.dim_customer()))
    assert (impact["lines_lost"], impact["revenue_lost"]) == (sums["n"], sums["r"])


def test_another_delivery_of_the_same_rows_changes_only_its_date(spark, lake, tmp_path):
    orders = lake.orders_raw()
    again = orders.withColumn("ingestion_date", F.lit("2026-01-09"))
    later = SalesLake(
        spark, str(tmp_path), orders.unionByName(again), lake.products, lake.users, lake.spellings
    )
    columns = [c for c in lake.orders_clean().columns if c != "source_ingestion_date"]
    before, after = lake.orders_clean(), later.orders_clean()
    assert before.count() == after.count()
    assert before.select(columns).exceptAll(after.select(columns)).count() == 0
    assert {r[0] for r in after.select("source_ingestion_date").distinct().collect()} == {
        "2026-01-09"
    }


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted([*registry.OPERATORS, "bronze_row_counts"]))
def test_plans_have_no_python_and_no_cross_joins(spark, name):
    text = plan(registry.queries()[name](spark, SF_DIR))
    assert not re.search(r"EvalPython|MapInPandas|FlatMapGroups|CartesianProduct", text)
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", list(registry.QUESTIONS))
def test_no_single_task_sees_the_fact(spark, name):
    """One-partition exchanges only come after an aggregate or a top-k has reduced rows."""
    lines = plan(registry.queries()[name](spark, SF_DIR)).splitlines()
    for place, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = [x for x in lines[place + 1 :] if not re.match(r"[\s:+|-]*(\*\(\d+\) )?(Project|Filter)", x)]
            assert re.search(r"Aggregate|TakeOrdered|LocalLimit", below[0]), below[0]


def test_the_window_prunes_months_and_columns(lake):
    text = plan(analytics.q1_total(lake.fact_sales(), lake.dim_date()))
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert any(re.search(r"PartitionFilters: \[.*(year|month).*[Ss]ubquery", line) for line in scans)
    assert not any("unit_price" in line for line in scans)


def test_questions_broadcast_dimensions_by_their_size(spark, lake):
    text = plan(analytics.q2_top_revenue(lake.fact_sales(), lake.dim_product()))
    assert "BroadcastHashJoin" in text
    assert "TakeOrderedAndProject" in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(analytics.q2_top_revenue(lake.fact_sales(), lake.dim_product()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["q2_top_revenue", "q2_top_quantity", "q5_top_customers"])
def test_wide_columns_only_meet_the_top(spark, name):
    """Names and addresses come after a limit: they are joined to a few rows."""
    frame = registry.queries()[name](spark, SF_DIR)
    text = frame._jdf.queryExecution().optimizedPlan().toString()
    wide = "title" if "q2" in name else "email"
    joins = [line for line in text.splitlines() if "Join Inner" in line]
    assert joins and all("rightHint" in line or "leftHint" in line for line in joins if wide in text)
    top = text.split("Join Inner")[-1]
    assert "GlobalLimit" in top and top.index("GlobalLimit") < top.index(wide)


def test_baskets_read_the_fact_once_and_start_no_job(spark, lake):
    tracker = spark.sparkContext.statusTracker()
    lake.fact_sales()
    before = len(tracker.getJobIdsForGroup(None))
    frame = analytics.q4_basket_by_country(lake.fact_sales())
    assert len(tracker.getJobIdsForGroup(None)) == before
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # one exchange of order rows is made, the other readers use it again
    assert text.count("ReusedExchange") >= 1


def test_dedup_is_hash_aggregated(lake):
    text = plan(silver.silver_dedup(lake.orders_raw()))
    assert "SortAggregate" not in text
    assert text.count("Exchange hashpartitioning(invoiceno") == 1


@pytest.mark.parametrize(
    "ask",
    [silver.silver_dedup, silver.rejected_by_rule, quality.quality_exact_duplicates, quality.quality_silver_forecast],
)
def test_duplicates_are_read_without_a_shuffle(lake, ask):
    text = plan(ask(lake.orders_tuples()))
    assert "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text
    # one row of totals at most passes through an exchange
    assert text.count("Exchange") <= 1
    assert rows(ask(lake.orders_tuples())) == rows(ask(lake.orders_raw()))


def test_derived_columns_do_not_travel_to_their_month(lake):
    text = plan(silver.silver_orders(lake.orders_tuples(), lake.spelling_list(), by_month=True))
    travels = text[text.index("Exchange hashpartitioning(_month") :]
    assert "line_amount" in text and "line_amount" not in travels and "is_return" not in travels
    plain = silver.silver_orders(lake.orders_tuples(), lake.spelling_list())
    assert rows(plain) == rows(lake.orders_clean().select(*plain.columns))


def test_derived_columns_are_not_staged_for_numbering(spark, lake, tmp_path):
    staging = str(tmp_path / "numbers")
    fact = gold.fact_sales(lake.orders_clean(), lake.dim_product(), lake.dim_customer(), staging)
    assert not {"invoice_date", "year", "month"} & set(spark.read.parquet(staging).columns)
    same = ["sale_id", "product_id", "customer_id", "date_id", "year", "month", "line_amount"]
    assert rows(fact.select(*same)) == rows(lake.fact_sales().select(*same))
    resolved = registry.resolved(lake).select("invoice_timestamp", "product_id", "customer_id", "year", "month")
    assert rows(resolved) == rows(fact.select(*resolved.columns))


def test_a_zone_that_lies_by_month_is_rebuilt_without_a_shuffle(lake, monkeypatch):
    asked = []
    real = registry.sinks.rebuild_zone
    monkeypatch.setattr(
        registry.sinks, "rebuild_zone", lambda *a, **k: asked.append(k.get("clustered")) or real(*a, **k)
    )
    assert rows(registry.rebuild_zone(lake)) == rows(lake.orders_clean())
    assert asked == [True, True]
