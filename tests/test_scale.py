"""Operators for big or lopsided inputs, against their plain forms."""

import os
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from support import rows
from orelode.functions.measures import exact_sum, money
from orelode.operators.lookup import hot_keys, lookup, with_matches
from orelode.operators.median import lower_median
from orelode.operators.numbering import number_in_files, number_rows, ranks
from orelode.operators import gold, ranking, silver
from orelode.operators.ranking import in_any_top, range_bounds, range_of
from orelode.plans import analytics
from orelode.sources import sinks


@pytest.fixture(scope="module")
def lopsided(spark):
    """A third of the rows on one known key, a sixth on an unknown one, a sixth on NULL."""
    return spark.range(30_000).select(
        "id",
        F.expr(
            """CASE WHEN id % 6 < 2 THEN 7 WHEN id % 6 = 2 THEN 100007
                    WHEN id % 6 = 3 THEN NULL ELSE id % 5000 END"""
        ).alias("key"),
    )


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.range(4_000).selectExpr("id AS right_key", "concat('n', id) AS name", "id * 2 AS two")


def test_lookup_by_shuffle_equals_broadcast(lopsided, keyed):
    plain = lopsided.join(keyed, lopsided["key"] == keyed["right_key"], "left").drop("right_key")
    small = lookup(lopsided, keyed, "key", "right_key")
    big = lookup(lopsided, keyed, "key", "right_key", broadcast_rows=0)
    assert small.columns == big.columns == plain.columns
    assert rows(small) == rows(plain) == rows(big)


def test_lookup_by_binary_keys(spark, lopsided, keyed):
    left = lopsided.withColumn("key", F.col("key").cast("string").cast("binary"))
    right = keyed.withColumn("right_key", F.col("right_key").cast("string").cast("binary"))
    assert rows(lookup(left, right, "key", "right_key")) == rows(lookup(left, right, "key", "right_key", broadcast_rows=0))


def test_lookup_by_shuffle_spreads_hot_and_null_keys(spark, lopsided, keyed):
    settings_ = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name) for name in settings_}
    for name, value in settings_.items():
        spark.conf.set(name, value)
    try:
        big = lookup(lopsided, keyed, "key", "right_key", broadcast_rows=0)
        sizes = big.groupBy(F.spark_partition_id()).count().select("count").collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(sizes) == 8
    assert max(size[0] for size in sizes) < 30_000 / 8 * 1.5


@pytest.mark.parametrize("kind", ["bigint", "string", "binary", "decimal(20,0)", "date"])
def test_hot_keys_of_any_type_are_found_without_a_shuffle(spark, kind):
    """Hot keys among very many others; the sketch takes no more than the stated share."""
    number = F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 400 = 1 THEN 8 WHEN id % 50 = 2 THEN NULL ELSE id END")
    key = F.date_from_unix_date(number.cast("int")) if kind == "date" else number.cast("string").cast(kind)
    frame = spark.range(300_000).select(key.alias("key"))
    found = hot_keys(frame, "key")
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    keys = [r[0] for r in found.collect()]
    expected = frame.groupBy("key").count().filter("key is not null and count > 300").select("key").collect()
    assert len(expected) == 2 and {r[0] for r in expected} <= set(keys) and len(keys) < 1000


@pytest.mark.parametrize("broadcast_rows", [0, 1_000_000])
def test_matches_say_what_joins_would_do(spark, lopsided, broadcast_rows):
    right = spark.createDataFrame([(7,), (7,), (8,), (None,)], "k long")
    counted = with_matches(lopsided, right, "key", "k", "n", broadcast_rows)
    assert counted.count() == lopsided.count()
    inner = lopsided.join(right, lopsided["key"] == right["k"]).count()
    left = lopsided.join(right, lopsided["key"] == right["k"], "left").count()
    found = counted.agg(F.sum("n"), F.sum(F.greatest("n", F.lit(1)))).collect()[0]
    assert tuple(found) == (inner, left)


def test_rows_stay_where_they_are_when_few_keys_do_not_match_once(spark, lopsided, keyed):
    """More keys than may be broadcast, of which one is unknown, one repeated and one NULL."""
    right = keyed.select("right_key").unionByName(spark.range(4_000, 5_000).select(F.col("id").alias("right_key")))
    right = right.unionByName(spark.createDataFrame([(9,)], "right_key long"))
    counted = with_matches(lopsided, right, "key", "right_key", "n", broadcast_rows=100)
    assert rows(counted) == rows(with_matches(lopsided, right, "key", "right_key", "n"))
    assert counted.schema["n"].dataType.typeName() == "long"
    assert "Exchange hashpartitioning" not in counted._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3) | st.none(), st.integers(0, 50)), min_size=1, max_size=60))
def test_numbers_equal_a_global_window(spark, tmp_path_factory, pairs):
    frame = spark.createDataFrame(pairs, "a int, b int").withColumn("c", F.expr("a + b"))
    order = [F.col("a").asc_nulls_last(), F.col("b").desc()]
    numbered = number_rows(frame, order, "no", str(tmp_path_factory.mktemp("n")))
    plain = frame.withColumn("no", F.row_number().over(Window.orderBy(*order)))
    assert rows(numbered) == rows(plain)


def test_numbers_split_a_hot_first_key(spark, tmp_path):
    frame = spark.range(20_000).select(F.lit("2026-01-01").alias("day"), "id")
    order = [F.col("day").asc(), F.col("id").asc()]
    # Small ranges would be merged again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_rows(frame, order, "no", str(tmp_path / "n"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert numbered.filter("no <> id + 1").count() == 0
    sizes = spark.read.parquet(str(tmp_path / "n")).selectExpr("_place >> 33 AS r").groupBy("r").count()
    assert sizes.agg(F.max("count")).collect()[0][0] < 10_000


def test_ranks_with_ties(spark, tmp_path):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate([9, 9, 5, 7, 7, 7])], "id int, v int")
    numbered = number_rows(frame, [F.col("v").desc(), F.col("id")], "no", str(tmp_path / "n"))
    assert rows(ranks(numbered, "v", "no", "r")) == [(5, 6), (7, 3), (9, 1)]


def test_median_of_lopsided_groups(spark):
    random.seed(5)
    data = [("a", round(random.random() * 100, 2)) for _ in range(3001)]
    data += [("b", 1.0), ("b", 2.0), (None, 4.0), (None, 6.0), (None, 8.0), ("c", 3.0)]
    data += [("d", float(i % 2)) for i in range(1000)] + [("e", None)]
    frame = spark.createDataFrame(data, "k string, v double")
    expected = []
    for key in {k for k, v in data if v is not None}:
        values = sorted(v for k, v in data if k == key and v is not None)
        expected.append((key, values[(len(values) + 1) // 2 - 1]))
    for limit in ("-1", "10MB"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            found = lower_median(frame, "k", "v", "m")
            assert rows(found) == sorted(expected, key=repr)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_median_outside_its_bounds_is_an_error(spark, monkeypatch):
    from orelode.operators import median

    # bounds that lie above the middle: MARGIN is what keeps them apart from it
    monkeypatch.setattr(median, "MARGIN", -4_000)
    frame = spark.createDataFrame([("a", float(i)) for i in range(100)], "k string, v double")
    with pytest.raises(Exception, match="do not enclose"):
        lower_median(frame, "k", "v", "m").collect()


def test_rank_comparison_equals_windows(lake):
    fact, dim = lake.fact_sales(), lake.dim_product()
    measures = analytics.product_measures(fact, dim)
    window = {v: F.rank().over(Window.orderBy(F.desc(v))) for v in ("revenue", "quantity")}
    ranked = measures.select("product_id", *[w.alias(f"{v}_rank") for v, w in window.items()])
    expected = ranked.filter("revenue_rank <= 10 or quantity_rank <= 10")
    found = analytics.q2_rank_comparison(fact, dim).select(*expected.columns)
    assert rows(found) == rows(expected)


def test_money_is_exact_at_any_size_and_order(spark):
    amount = F.round(F.lit(25_000_000_000.0) + (F.col("id") * 37 % 1_000_003) / 100, 2)
    frame = spark.range(4_000_000).select(amount.alias("line_amount"))
    whole = sum(2_500_000_000_000 + i * 37 % 1_000_003 for i in range(4_000_000))
    expected = float(Decimal(whole) / 100)
    for parts in (1, 7):
        total = frame.repartition(parts).agg(money(exact_sum("line_amount")).alias("t")).first().t
        assert total == expected > 9e16


def test_a_side_with_long_texts_is_not_broadcast(spark, monkeypatch):
    from orelode.operators import lookup as module

    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "x" * 500)], "j int, v string")
    assert "Broadcast" in lookup(left, right, "k", "j")._jdf.queryExecution().toString()
    monkeypatch.setattr(module, "BROADCAST_TEXT", 100)
    found = lookup(left, right, "k", "j")
    assert rows(found) == [(1, "x" * 500), (2, None)]
    assert "_slot" in found._jdf.queryExecution().toString()


def test_no_staging_is_left_behind(spark, lake):
    lake.fact_sales()
    assert not os.path.exists(f"{lake.root}/staging/fact_numbering")
    for source in ("orders", "products", "users"):
        assert os.path.isdir(f"{lake.root}/landed/{source}")
        assert not os.path.exists(f"{lake.root}/staging/{source}")


def test_exact_and_sketched_medians_agree_on_small_groups(lake):
    exact = analytics.q4_basket_by_country(lake.fact_sales())
    sketched = analytics.q4_basket_by_country(lake.fact_sales(), exact=False)
    assert rows(exact) == rows(sketched)


def test_fact_is_the_same_without_any_broadcast(spark, lake, tmp_path):
    from orelode.operators import gold, invariants, silver

    parts = (lake.orders_clean(), lake.dim_product(), lake.dim_customer())
    fact = gold.fact_sales(*parts, str(tmp_path / "staging"), broadcast_rows=0)
    assert rows(fact) == rows(lake.fact_sales())
    star = (lake.fact_sales(), lake.dim_date(), lake.dim_product(), lake.dim_customer())
    assert rows(invariants.inv_no_fanout(*star)) == rows(
        invariants.inv_no_fanout(*star, broadcast_rows=0)
    )
    clean = (lake.orders_clean(), lake.products_clean(), lake.users_clean())
    assert rows(silver.silver_orphans_kept(*clean)) == rows(
        silver.silver_orphans_kept(*clean, broadcast_rows=0)
    )


@pytest.mark.parametrize("latest_only", [True, False])
def test_orphan_profiles_are_the_same_without_any_broadcast(lake, latest_only):
    from orelode.operators import quality

    raw = (lake.orders_raw(), lake.products_raw(), lake.users_raw(), latest_only)
    for profile in (quality.quality_orphan_keys, quality.quality_inner_join_loss):
        assert rows(profile(*raw)) == rows(profile(*raw, broadcast_rows=0))


def test_ranks_of_many_ties_need_no_list_of_values(spark, monkeypatch):
    """100,000 products share the tenth quantity; the plan collects nothing and has no global sort."""
    quantity = F.when(F.col("id") < 9, 1000 - F.col("id")).when(F.col("id") < 100_009, 5).otherwise(1)
    measures = spark.range(120_000).select(
        F.col("id").alias("product_id"), (F.col("id") * 37 % 1009).cast("decimal(38,2)").alias("revenue"),
        quantity.cast("long").alias("quantity"),
    )
    path = sinks.staged(measures, "ties")
    monkeypatch.setattr(ranking, "RANGE_VALUES", 10_000)
    found = in_any_top(path, ["revenue", "quantity"], 10)
    text = found._jdf.queryExecution().toString()
    assert "collect_set" not in text and "collect_list" not in text
    window = {v: F.rank().over(Window.orderBy(F.desc(v))) for v in ("revenue", "quantity")}
    expected = measures.select("*", *[w.alias(f"{v}_rank") for v, w in window.items()])
    expected = expected.filter("revenue_rank <= 10 or quantity_rank <= 10")
    assert expected.count() > 100_000
    assert found.exceptAll(expected.select(*found.columns)).isEmpty() and found.count() == expected.count()
    assert rows(in_any_top(path, ["revenue", "quantity"], 10, broadcast_rows=0).limit(5).select("product_id"))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-3, 3) | st.none(), st.integers(0, 4)), min_size=1, max_size=40), st.integers(1, 4))
def test_tops_equal_windows(spark, pairs, top):
    # a range for every few values
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ranking, "RANGE_VALUES", 3)
        check_tops(spark, pairs, top)


def check_tops(spark, pairs, top):
    frame = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "id int, a int, b long")
    expected = []
    for i, (a, b) in enumerate(pairs):
        rank_a = None if a is None else 1 + sum(x is not None and x > a for x, _ in pairs)
        rank_b = 1 + sum(y > b for _, y in pairs)
        if rank_a is not None and rank_a <= top or rank_b <= top:
            expected.append((i, a, b, rank_a, rank_b))
    found = in_any_top(frame, ["a", "b"], top).select("id", "a", "b", "a_rank", "b_rank")
    assert rows(found) == sorted(expected, key=repr)


def test_ranges_split_the_distinct_values(spark):
    frame = spark.range(50_000).selectExpr("if(id < 40000, 7, id) AS v")
    bounds = range_bounds(frame, ["v"], ranges=16)["v"]
    sizes = frame.distinct().groupBy(F.expr(range_of("double(v)", bounds)).alias("r")).count()
    assert sizes.count() >= 15 and sizes.agg(F.max("count")).first()[0] < 2 * 10_001 / 16
    assert range_bounds(frame.limit(0), ["v"], ranges=16) == {}


def test_files_in_order_are_numbered_where_they_lie(spark, tmp_path):
    """Nulls, ties within and between files: the numbers are those of ``number_rows``."""
    keys = ["a", "b"]
    order = [F.col(name).asc_nulls_last() for name in keys]
    frame = spark.range(0, 4000, 1, 3).select(
        F.when(F.col("id") % 5 != 0, F.col("id") % 7).alias("a"),
        F.when(F.col("id") % 3 != 0, (F.col("id") % 4).cast("string")).alias("b"),
    )
    frame.repartition(1).sort(*order).write.option("maxRecordsPerFile", 37).parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    numbered = number_in_files(table, keys, "no")
    assert rows(numbered) == rows(number_rows(frame, order, "no", str(tmp_path / "n")))
    assert number_in_files(table.filter("false"), keys, "no").count() == 0
    text = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Exchange rangepartitioning" not in text and "SortMergeJoin" not in text


def test_the_fact_is_numbered_without_a_shuffle_of_its_rows(spark, lake, tmp_path):
    clean = lake.orders_clean()
    fact = gold.fact_sales(clean, lake.dim_product(), lake.dim_customer(), "none", in_order=True)
    text = fact._jdf.queryExecution().executedPlan().toString()
    assert "Exchange rangepartitioning" not in text and "Exchange hashpartitioning(invoice" not in text
    # each file of the clean orders is in order, whatever wrote it
    for file in clean.inputFiles()[::9]:
        found = [tuple(r) for r in spark.read.parquet(file).select(*silver.LINE_ORDER).collect()]
        assert found == sorted(found, key=lambda row: [(v is None, v) for v in row])
    numbered = gold.fact_sales(clean, lake.dim_product(), lake.dim_customer(), str(tmp_path / "s"))
    assert rows(numbered) == rows(fact) == rows(lake.fact_sales())


def test_clean_orders_read_each_text_once(lake):
    """Not once for the reject rules and once more for the columns."""
    clean = silver.silver_orders(lake.orders_tuples(), lake.spelling_list(), in_order=True)
    plan = clean._jdf.queryExecution().optimizedPlan().toString()
    for text in ("invoicedate", "quantity"):
        assert plan.count(f"RLIKE({text}#") == 1
