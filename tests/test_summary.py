"""The questions from the summary of the fact against the questions from the fact."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from orelode.plans import analytics
from orelode.plans import summary as module
from orelode.sources import sinks
from support import rows


@pytest.fixture(scope="module")
def summary(lake, tmp_path_factory):
    return module.sales_summary(lake.fact_sales(), lake.dim_product(), str(tmp_path_factory.mktemp("s") / "t"))


@pytest.fixture(scope="module")
def answers(lake, summary):
    return module.answers(summary, lake.dim_date(), lake.dim_product(), lake.dim_customer())


@pytest.mark.parametrize("name", list(registry.QUESTIONS))
def test_answers_are_those_of_the_fact(lake, answers, name):
    live = registry.QUESTIONS[name](lake)
    assert answers[name].columns == live.columns and answers[name].dtypes == live.dtypes
    assert rows(answers[name]) == rows(live)


def test_the_fact_is_scanned_once(lake, answers):
    frame = module.summary_plan(lake.fact_sales(), lake.dim_product())
    lines = frame._jdf.queryExecution().executedPlan().toString().splitlines()
    scans = [line for line in lines if "FileScan parquet" in line]
    assert sum("line_amount" in line for line in scans) == 1 and len(scans) == 2
    assert sum("Exchange hashpartitioning(invoiceno" in line for line in lines) == 1
    for frame in answers.values():
        assert not any("fact_sales" in file for file in frame.inputFiles())


def test_a_grain_skips_the_other(summary):
    for frame, grain in ((summary.orders, 0), (summary.products, 1)):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"PartitionFilters: \[.*grain.* = {grain}", text)


def test_odd_facts_give_the_same(spark, lake, tmp_path):
    """Nulls in every column, repeated dimension rows, no facts at all."""
    dates, products, customers = lake.dim_date(), lake.dim_product(), lake.dim_customer()
    fact = lake.fact_sales().filter("sale_id <= 600")
    holes = fact
    for place, name in enumerate(["invoiceno", "country", "quantity", "line_amount", "unit_price", "is_return"]):
        holes = holes.withColumn(name, F.when(F.col("sale_id") % 11 != place, F.col(name)))
    twice = products.unionByName(products.filter("product_id % 7 = 1"))
    again = customers.unionByName(customers.filter("customer_id % 5 = 1"))
    for number, (some, p, c) in enumerate([(holes, twice, again), (fact.limit(0), products, customers)]):
        made = module.sales_summary(some, p, str(tmp_path / f"s{number}"))
        found = module.answers(made, dates, p, c)
        tables = Tables(some, dates, p, c)
        for name, question in registry.QUESTIONS.items():
            assert rows(found[name]) == rows(question(tables)), name


class Tables:
    def __init__(self, fact, dates, products, customers):
        self.fact_sales, self.dim_date = (lambda: fact), (lambda: dates)
        self.dim_product, self.dim_customer = (lambda: products), (lambda: customers)


def test_the_summary_is_the_same_without_any_broadcast(lake, summary, tmp_path):
    other = module.sales_summary(lake.fact_sales(), lake.dim_product(), str(tmp_path / "s"), broadcast_rows=0)
    assert rows(other.orders) == rows(summary.orders)
    assert rows(other.products) == rows(summary.products)


def test_distinct_counts_of_any_months_come_from_their_sketches(lake, tmp_path):
    fact, dates = lake.fact_sales(), lake.dim_date()
    sketches = sinks.write_parquet(analytics.monthly_sketches(fact, dates), str(tmp_path / "sketches"))
    bound = 4 * 0.8326 / 2 ** (analytics.LOG_REGISTERS / 2)
    dated = fact.join(dates.select("date_id", F.col("year").alias("y"), F.col("month").alias("m")), "date_id")
    for low, high in ((199503, 199505), (199601, 199712), (199501, 200112)):
        span = F.col("year") * 100 + F.col("month")
        found = analytics.distinct_of_months(sketches.filter(span.between(low, high))).first()
        lines = dated.filter((F.col("y") * 100 + F.col("m")).between(low, high))
        exact = lines.agg(F.count_distinct("invoiceno", "date_id"), F.count_distinct("invoiceno")).first()
        for estimate, true in zip(found, exact):
            assert abs(estimate - true) <= max(true * bound, 1)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_lines_that_are_added_up_hold_few_sums_and_the_others_do_not_travel(lake):
    """The map side holds a row for nearly each line and grain: wide rows would not fit a task."""
    fact, products = lake.fact_sales(), lake.dim_product()
    text = plan(module.summary_plan(fact, products))
    partial = [line for line in text.splitlines() if "partial_" in line and "invoiceno" in line]
    assert len(partial) == 1 and partial[0].count("partial_sum") == 3 and "customer_id" not in partial[0]
    assert "Exchange hashpartitioning" not in plan(module.narrow_lines(fact, products)).split("BroadcastExchange")[0]
    assert module.narrow_lines(fact, products).count() == fact.count()


def test_answers_move_no_rows_that_a_grain_holds(answers):
    """Orders and countries are read where they lie, months from one table, customers by revenue alone."""
    assert "Exchange hashpartitioning(invoiceno" not in plan(answers["q4_basket_by_country"])
    for name in ("q3_monthly", "q3_additivity_check"):
        assert "date_id" not in plan(answers[name])
    ranked = [line for line in plan(answers["q5_top_customers"]).splitlines() if "Exchange hashpartitioning" in line]
    best = [line for line in ranked if "hashpartitioning(customer_id" in line and "invoiceno" not in line]
    assert best


def test_products_meet_their_dimension_once_for_all_that_is_written(lake, tmp_path, monkeypatch):
    """Where the dimension is too large to broadcast, the distinct keys of the fact are matched first."""
    from orelode.operators import lookup

    labels, real = [], lookup.staged
    monkeypatch.setattr(lookup, "staged", lambda rows, label: labels.append(label) or real(rows, label))
    made = module.sales_summary(lake.fact_sales(), lake.dim_product(), str(tmp_path / "once"), broadcast_rows=0)
    assert labels == ["matches"]
    plain = module.sales_summary(lake.fact_sales(), lake.dim_product(), str(tmp_path / "plain"))
    for name in ("orders", "products", "lines"):
        assert rows(getattr(made, name)) == rows(getattr(plain, name))


def test_lines_are_added_up_once_by_day_and_once_by_customer(answers):
    """The answers read these sums; of the lines themselves only the best customers' are looked at again."""
    for name in ("q6_orphan_population", "q6_orphan_impact", "q6_orphan_trend", "q1_by_country"):
        assert "line_amount" not in plan(answers[name]), name


def test_answers_of_no_lines_are_those_of_an_empty_fact(spark, lake, tmp_path):
    fact, dates = lake.fact_sales().filter("false"), lake.dim_date()
    made = module.sales_summary(fact, lake.dim_product(), str(tmp_path / "none"))
    found = module.answers(made, dates, lake.dim_product(), lake.dim_customer())
    tables = Tables(fact, dates, lake.dim_product(), lake.dim_customer())
    for name, question in registry.QUESTIONS.items():
        assert rows(found[name]) == rows(question(tables)), name
        assert found[name].dtypes == question(tables).dtypes, name
