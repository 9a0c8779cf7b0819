"""The rules of each layer on a few hand-written rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from support import rows
from orelode import schemas
from orelode.operators import bronze, gold, invariants, quality, silver
from orelode.plans import analytics
from orelode.plans.lake import SalesLake

ORDERS = [
    # invoice, product, quantity, date, price, customer, country, ingestion date
    ("1", "10", "2", "2026-04-10 10:00:00", "5.0", "7", "France", "2026-01-01"),
    ("1", "10", "2", "2026-04-10 10:00:00", "5.0", "7", "France", "2026-01-02"),
    ("1", "11", "1", "2026-04-10 10:00:00", "2.5", "7", " FRNACE ", "2026-01-01"),
    ("C2", "10", "3", "2026-05-02 09:00:00", "5.0", "8", "u.k.", "2026-01-01"),
    ("1", "10", "1", "2026-05-31 23:59:59", "5.0", "", "\tUSA", "2026-01-01"),
    ("3", "9002", "4", "2026-06-01 00:00:00", "1.25", "7", "Suisse", "2026-01-01"),
    ("4", "", "4", "2026-06-01 00:00:00", "1.25", "", "Suisse", "2026-01-01"),
    ("5", "-1", "1", "2026-06-02 00:00:00", "1.0", "999", "Atlantis", "2026-01-01"),
    # rejected
    ("6", "10", "1", "", "5.0", "7", "France", "2026-01-01"),
    ("6", "10", "1", "31/02/2026", "5.0", "7", "France", "2026-01-01"),
    ("6", "10", "1", "2026-4-10 10:00:00", "5.0", "7", "France", "2026-01-01"),
    ("7", "10", "1", "2026-04-10 10:00:00", "0", "7", "France", "2026-01-01"),
    ("7", "10", "1", "2026-04-10 10:00:00", "-5.5", "7", "France", "2026-01-01"),
    ("7", "10", "1", "2026-04-10 10:00:00", "n/a", "7", "France", "2026-01-01"),
    ("7", "10", "1", "2026-04-10 10:00:00", "NaN", "7", "France", "2026-01-01"),
    ("8", "10", "", "2026-04-10 10:00:00", "5.0", "7", "France", "2026-01-01"),
]


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(ORDERS, schemas.orders_schema())


@pytest.fixture(scope="module")
def products(spark):
    schema = schemas.products_schema().add("ingestion_date", "string")
    blank = dict.fromkeys(schema.names)
    return spark.createDataFrame(
        [
            {**blank, "id": 10, "title": "Pen", "price": 10.0, "discountpercentage": 10.0,
             "tags": ["a", "b"], "rating": 4.0, "ingestion_date": "2026-01-01"},
            {**blank, "id": 10, "title": "Pen 2", "price": 20.0, "discountpercentage": 10.0,
             "tags": ["a"], "rating": 4.5, "ingestion_date": "2026-01-02"},
            {**blank, "id": 11, "title": "Cup", "price": 3.0, "brand": "B", "rating": 3.0,
             "dimensions": {"width": 1.5, "height": 2.0, "depth": 0.5},
             "ingestion_date": "2026-01-01"},
        ],
        schema,
    )


@pytest.fixture(scope="module")
def users(spark):
    schema = schemas.users_schema().add("ingestion_date", "string")
    blank = dict.fromkeys(schema.names)
    return spark.createDataFrame(
        [
            {**blank, "id": 7, "firstname": "Ann", "lastname": "Lee", "age": 30,
             "ingestion_date": "2026-01-01"},
            {**blank, "id": 8, "firstname": "Bo", "lastname": None, "age": 40,
             "ingestion_date": "2026-01-01"},
        ],
        schema,
    )


def small_lake(spark, root, orders, products, users, **options):
    spellings = silver.spelling_frame(spark, schemas.COUNTRY_SPELLINGS)
    return SalesLake(spark, str(root), orders, products, users, spellings, **options)


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory, orders, products, users):
    return small_lake(spark, tmp_path_factory.mktemp("star"), orders, products, users)


def one(frame):
    return frame.collect()[0].asDict()


def test_spelling_list_has_21_forms_of_10_names():
    assert len(schemas.COUNTRY_SPELLINGS) == 21
    assert len(set(schemas.COUNTRY_SPELLINGS.values())) == 10


def test_dedup_keeps_the_latest_date(orders):
    kept = silver.silver_dedup(orders)
    assert kept.count() == len(ORDERS) - 1
    dates = kept.filter("invoiceno = '1' AND productid = '10' AND quantity = '2'")
    assert [r.source_ingestion_date for r in dates.collect()] == ["2026-01-02"]


def test_dedup_keeps_the_greatest_text_whatever_it_looks_like(spark):
    columns = ["invoiceno", "productid", "quantity", "invoicedate", "unitprice", "customerid", "country"]

    def latest(*dates):
        data = [tuple("1" for _ in columns) + (d,) for d in dates]
        schema = ", ".join(f"{c} string" for c in [*columns, "ingestion_date"])
        found = silver.silver_dedup(spark.createDataFrame(data, schema), columns).collect()
        assert len(found) == 1
        return found[0].source_ingestion_date

    assert latest("20260101", "20251231") == "20260101"
    assert latest("2026-01-01T09", "2026-01-01T17", "2026-01-01") == "2026-01-01T17"
    assert latest("2026-01-01", "2026-02-30", "2026-01-31") == "2026-02-30"
    assert latest("2026-03-01", "2026-02-30") == "2026-03-01"
    assert latest(None, "2026-01-01") == "2026-01-01"
    assert latest(None) is None


def test_prices_that_are_no_numbers_are_rejected(spark):
    data = [(str(i), "1", "2", "2026-01-05 10:00:00", p, "1", "x", "2026-01-01")
            for i, p in enumerate(["Infinity", "5d", "NaN", "1.5"])]
    names = "invoiceno productid quantity invoicedate unitprice customerid country ingestion_date"
    frame = spark.createDataFrame(data, ", ".join(f"{n} string" for n in names.split()))
    kept = silver.silver_reject_rules(silver.silver_typed(silver.silver_dedup(frame)))
    assert [r.unit_price for r in kept.collect()] == [1.5]
    rejected = {r.rule: r.rows for r in silver.rejected_by_rule(frame).collect()}
    assert rejected["R4 price not positive"] == 3


def test_clean_orders(star):
    clean = star.orders_clean()
    assert clean.columns == [
        "invoiceno", "product_id", "quantity", "unit_price", "line_amount", "customer_id",
        "country", "is_return", "invoice_date", "invoice_timestamp", "source_ingestion_date",
        "year", "month",
    ]
    picked = clean.select(
        "invoiceno", "product_id", "quantity", "line_amount", "customer_id", "country",
        "is_return", "year", "month",
    )
    assert rows(picked) == sorted([
        ("1", 10, 2, 10.0, 7, "France", False, "2026", "04"),
        ("1", 11, 1, 2.5, 7, "France", False, "2026", "04"),
        ("C2", 10, 3, 15.0, 8, "United Kingdom", True, "2026", "05"),
        ("1", 10, 1, 5.0, None, "United States", False, "2026", "05"),
        ("3", 9002, 4, 5.0, 7, "Switzerland", False, "2026", "06"),
        ("4", None, 4, 5.0, None, "Switzerland", False, "2026", "06"),
        ("5", -1, 1, 1.0, 999, None, False, "2026", "06"),
    ], key=repr)


def test_rejects_carry_their_first_failing_rule(orders):
    typed = silver.silver_typed(silver.silver_dedup(orders))
    found = silver.silver_rejects(typed).groupBy("rule").count()
    assert rows(found) == [
        ("R3 unreadable date", 3), ("R4 price not positive", 4), ("R5 quantity missing", 1),
    ]
    assert rows(silver.rejected_by_rule(orders)) == [
        ("R1 exact duplicate", 1), ("R3 unreadable date", 3), ("R4 price not positive", 4),
        ("R5 quantity missing", 1),
    ]
    kept = silver.silver_reject_rules(typed).count()
    assert kept + silver.silver_rejects(typed).count() == typed.count()


def test_catalogs_are_flat_and_latest(star):
    found = star.products_clean().select(
        "product_id", "title", "discounted_price", "tag_count", "width", "source_ingestion_date"
    )
    assert rows(found) == sorted([
        (10, "Pen 2", 18.0, 1, None, "2026-01-02"), (11, "Cup", None, None, 1.5, "2026-01-01"),
    ], key=repr)
    assert dict(star.products_clean().dtypes)["tag_count"] == "bigint"
    assert len(star.products_clean().columns) == 22
    assert len(star.users_clean().columns) == 30


def test_no_raw_column_is_lost(star):
    """Every raw column reaches its clean table under its own name or a known new one."""
    renamed = {
        "id": "product_id", "price": "catalog_price",
        "discountpercentage": "discount_percentage", "dimensions": "width",
        "warrantyinformation": "warranty_information",
        "shippinginformation": "shipping_information",
        "availabilitystatus": "availability_status",
        "minimumorderquantity": "minimum_order_quantity",
        "ingestion_date": "source_ingestion_date",
    }
    raw = star.products_raw().columns
    assert {renamed.get(name, name) for name in raw} <= set(star.products_clean().columns)
    assert set(star.products_clean().columns) <= set(star.dim_product().columns)
    assert set(star.users_clean().columns) <= set(star.dim_customer().columns)


def test_convention_rows(star):
    product = star.dim_product()
    assert product.columns[-1] == "is_unknown"
    unknown = one(product.filter("is_unknown"))
    assert (unknown["product_id"], unknown["title"], unknown["category"]) == (
        -1, "Unknown product", "Unknown",
    )
    assert {k for k, v in unknown.items() if v is not None} == {
        "product_id", "title", "category", "is_unknown",
    }
    customers = star.dim_customer().select("customer_id", "firstname", "lastname", "customer_type")
    assert rows(customers.filter("customer_id < 0")) == [
        (-1, "Unknown", "customer", "Orphan"), (-2, "Not", "recorded", "Not recorded"),
    ]


def test_calendar(star):
    days = star.dim_date()
    assert [r[0] for r in days.agg(F.count("*")).collect()] == [54]
    sunday = one(days.filter("date_id = 20260531"))
    assert sunday == {
        "date_id": 20260531, "full_date": datetime.date(2026, 5, 31), "year": 2026, "month": 5,
        "month_name": "May", "day": 31, "quarter": 2, "day_of_week": 7, "day_name": "Sunday",
        "is_weekend": True,
    }
    assert one(days.filter("date_id = 20260601"))["day_of_week"] == 1


def test_calendar_of_no_orders_is_empty(star):
    assert gold.dim_date(star.orders_clean().filter("false")).count() == 0


def test_fact_resolves_every_key(star):
    fact = star.fact_sales()
    assert len(fact.columns) == 15
    found = fact.select("invoiceno", "source_product_id", "product_id", "customer_id", "date_id")
    assert rows(found) == sorted([
        ("1", 10, 10, 7, 20260410), ("1", 11, 11, 7, 20260410), ("C2", 10, 10, 8, 20260502),
        ("1", 10, 10, -2, 20260531), ("3", 9002, -1, 7, 20260601), ("4", None, -1, -2, 20260601),
        ("5", -1, -1, -1, 20260602),
    ], key=repr)
    numbered = fact.orderBy("sale_id").select("sale_id", "invoiceno", "source_product_id")
    assert [tuple(r) for r in numbered.collect()] == [
        (1, "1", 10), (2, "1", 11), (3, "C2", 10), (4, "1", 10), (5, "3", 9002),
        (6, "4", None), (7, "5", -1),
    ]


def test_numbering_puts_null_products_last(spark, star, tmp_path):
    same = star.orders_clean().filter("invoiceno = '1' AND month = '04'")
    nulls = same.withColumn("product_id", F.lit(None).cast("bigint"))
    fact = gold.fact_sales(
        same.unionByName(nulls.limit(1)), star.dim_product(), star.dim_customer(), str(tmp_path / "s")
    )
    order = [r.source_product_id for r in fact.orderBy("sale_id").collect()]
    assert order == [10, 11, None]


def test_invariants_hold(star):
    fact, dates = star.fact_sales(), star.dim_date()
    products, customers = star.dim_product(), star.dim_customer()
    checks = [
        invariants.inv_volume_preserved(star.orders_clean(), fact),
        invariants.inv_grain_unique(fact),
        invariants.inv_no_fanout(fact, dates, products, customers),
        invariants.inv_pk_unique({"d": (dates, "date_id"), "p": (products, "product_id")}),
        invariants.inv_no_unhandled_orphan(fact, dates, products, customers),
        invariants.inv_calendar_continuous(dates),
    ]
    assert all(row["passed"] for check in checks for row in check.collect())


def test_invariants_report_what_is_broken(star):
    fact, dates = star.fact_sales(), star.dim_date()
    products, customers = star.dim_product(), star.dim_customer()
    twice = products.unionByName(products.filter("product_id = 10"))
    fanned = one(invariants.inv_no_fanout(fact, dates, twice, customers))
    plain = fact.join(twice, "product_id").join(customers, "customer_id").join(dates, "date_id")
    assert fanned["after_join"] == plain.count() > fanned["before_join"]
    assert not fanned["passed"]
    assert one(invariants.inv_pk_unique({"p": (twice, "product_id")}))["duplicates"] == 1
    gap = dates.filter("day <> 15")
    assert not one(invariants.inv_calendar_continuous(gap))["passed"]
    lost = one(
        invariants.inv_no_unhandled_orphan(
            fact, dates, products.filter("product_id <> -1"), customers
        )
    )
    assert (lost["facts_without_product"], lost["passed"]) == (3, False)
    collided = one(invariants.inv_grain_unique(fact.unionByName(fact.limit(2))))
    assert collided["collisions"] == 2


def test_all_snapshots_show_up_as_repeated_keys(spark, tmp_path, orders, products, users):
    strict = small_lake(spark, tmp_path, orders, products, users, latest_only=False)
    keys = rows(silver.silver_key_uniqueness(strict.products_clean(), strict.users_clean()))
    assert keys == [("products_clean", 3, 2), ("users_clean", 2, 2)]
    fanned = one(
        invariants.inv_no_fanout(
            strict.fact_sales(), strict.dim_date(), strict.dim_product(), strict.dim_customer()
        )
    )
    assert fanned["after_join"] > fanned["before_join"]


def test_orphan_key_profile_follows_plain_joins(orders, products, users):
    typed = orders.select(
        F.col("productid").try_cast("bigint").alias("p"),
        F.col("customerid").try_cast("bigint").alias("c"),
    )
    joined = typed.join(products.select("id"), typed["p"] == products["id"], "left").withColumnRenamed(
        "id", "product"
    )
    found = one(quality.quality_orphan_keys(orders, products, users, latest_only=False))
    orphans = joined.filter("product IS NULL AND p IS NOT NULL").count()
    assert found["orphan_product_rows"] == orphans == 2
    assert found["unresolved_product_rows"] == 3
    assert found["orphan_customer_rows"] == 1
    latest = one(quality.quality_orphan_keys(orders, products, users))
    assert latest["missing_customer_rows"] == 2
    assert latest["total_revenue"] < found["total_revenue"]


def test_profiles_of_dirty_values(orders):
    numbers = one(quality.quality_numeric_profile(orders))
    assert numbers == {
        "non_numeric": 1, "zero": 1, "negative": 1, "extreme": 0, "max_price": 5.0,
    }
    stamps = one(quality.quality_timestamp_profile(orders))
    assert (stamps["blank"], stamps["unreadable"]) == (1, 2)
    assert rows(quality.quality_unreadable_values(orders)) == [
        ("2026-4-10 10:00:00", 1), ("31/02/2026", 1),
    ]
    counts = one(bronze.bronze_anomaly_counts(orders))
    assert (counts["date_wrong_format"], counts["price_zero_or_negative"]) == (1, 2)


def test_near_duplicates(spark):
    schema = schemas.orders_schema()
    base = ("1", "10", "2", "d1", "5", "7", "France", "2026-01-01")
    other_date = ("1", "10", "2", "d2", "5", "7", "France", "2026-01-01")
    other_both = ("2", "10", "3", "d1", "6", "7", "France", "2026-01-01")
    copies = ("3", "10", "2", "d1", "5", "7", "France", "2026-01-01")
    data = [base, base, other_date, ("2", *base[1:]), other_both, copies, copies]
    found = one(quality.quality_near_duplicates(spark.createDataFrame(data, schema)))
    assert found == {
        "groups": 2, "rows": 5, "dates_differ": 1, "prices_differ": 1, "quantities_differ": 1,
    }


def test_bronze_counts_compare_per_date(spark, orders):
    expected = spark.createDataFrame(
        [("orders_raw", "2026-01-01", 15), ("orders_raw", "2026-01-03", 4)],
        "source string, ingestion_date string, expected long",
    )
    found = bronze.bronze_row_counts({"orders_raw": orders}, expected)
    assert [tuple(r) for r in found.collect()] == [
        ("orders_raw", "2026-01-01", 15, 15, True),
        ("orders_raw", "2026-01-02", 1, 0, False),
        ("orders_raw", "2026-01-03", 0, 4, False),
    ]


def test_last_three_months_start_after_the_clamped_day(spark, star):
    """From 31 May back three months is 28 February, which is not in the window."""
    calendar = spark.sql(
        "SELECT explode(sequence(DATE'2026-02-01', DATE'2026-06-30', INTERVAL 1 DAY)) AS full_date"
    ).withColumn("date_id", gold.date_key(F.col("full_date")))
    days = ["2026-02-28", "2026-03-01", "2026-05-31"]
    fact = spark.createDataFrame(
        [(d.replace("-", "")[:4], d[5:7], int(d.replace("-", "")), "1", 10.0, d[5:7] == "03")
         for d in days],
        "year string, month string, date_id int, invoiceno string, line_amount double, "
        "is_return boolean",
    )
    assert one(analytics.q1_total(fact, calendar)) == {
        "net_revenue": 20.0, "lines": 2, "orders": 2, "gross_revenue": 10.0,
        "returns_impact": 10.0,
    }


def test_ties_share_a_rank(spark, star):
    fact = spark.createDataFrame(
        [(i, 5.0 if i < 3 else 1.0, 1, 1.0) for i in range(1, 15)],
        "product_id long, line_amount double, quantity int, unit_price double",
    )
    dim = spark.range(15).selectExpr("id AS product_id", "'t' AS title", "'c' AS category")
    found = analytics.q2_rank_comparison(fact, dim)
    ranks = [(r.product_id, r.revenue_rank, r.quantity_rank) for r in found.collect()]
    # every product ties on quantity, and all but two tie on revenue
    assert ranks == [(1, 1, 1), (2, 1, 1)] + [(i, 3, 1) for i in range(3, 15)]
    top = analytics.q2_top_quantity(fact, dim, top=3)
    assert [r.product_id for r in top.collect()] == [1, 2, 3]


def test_orders_add_up_over_months_and_invoice_numbers_do_not(star):
    found = one(analytics.q3_additivity_check(star.fact_sales(), star.dim_date()))
    assert found == {
        "monthly_orders_sum": 6, "true_orders": 6, "monthly_invoices_sum": 6, "true_invoices": 5,
    }


def test_an_unmapped_country_stays_as_a_group(star):
    baskets = analytics.q4_basket_by_country(star.fact_sales())
    assert [r.median_basket for r in baskets.collect() if r.country is None] == [1.0]
    by_country = analytics.q1_by_country(star.fact_sales(), star.dim_date())
    assert [r.lines for r in by_country.collect() if r.country is None] == [1]


def test_a_customer_without_a_last_name_has_no_full_name(star):
    found = analytics.q5_top_customers(star.fact_sales(), star.dim_customer())
    assert [(r.customer_id, r.customer) for r in found.collect()] == [(7, "Ann Lee"), (8, None)]


def test_populations_are_exclusive(star):
    found = analytics.q6_orphan_population(star.fact_sales()).select("population", "lines")
    assert rows(found) == sorted([
        (analytics.COMPLETE_KEYS, 3), (analytics.NO_KEYS, 2), (analytics.NO_PRODUCT, 1),
        (analytics.NO_CUSTOMER, 1),
    ], key=repr)


def test_changes_only_between_consecutive_full_months(spark):
    monthly = spark.createDataFrame(
        [(2026, 4, 10.0, 1.0, 1), (2026, 5, 100.0, 10.0, 10), (2026, 6, 103.0, 11.0, 9),
         (2026, 8, 50.0, 5.0, 10), (2026, 9, 1.0, 1.0, 1)],
        "year int, month int, revenue double, avg_basket double, orders long",
    )
    found = analytics.month_over_month(
        monthly, F.lit("2026-04-02").cast("date"), F.lit("2026-09-29").cast("date")
    )
    changes = [(r.month, r.revenue_change_pct, r.orders_change_pct) for r in found.collect()]
    assert changes == [(5, None, None), (6, 3.0, -10.0), (8, None, None)]


def test_a_build_starts_no_job_only_to_count(spark, tmp_path, orders, products, users, monkeypatch):
    """Sizes that decide about joins are those observed while the other tables were written."""
    lake = small_lake(spark, tmp_path, orders, products, users)

    def asked(self, *args):
        raise AssertionError("a build asked for rows")

    kind = type(orders)
    for name in ("count", "first", "collect", "head", "take", "toArrow", "toPandas"):
        monkeypatch.setattr(kind, name, asked)
    fact = lake.fact_sales()
    monkeypatch.undo()
    assert fact.count() == lake.size("fact_sales")[0] == 7
    assert lake.size("spellings") == (21, sum(len(k) + len(v) for k, v in schemas.COUNTRY_SPELLINGS.items()))
    assert all(r.passed for r in lake.recorded_rows().collect())
