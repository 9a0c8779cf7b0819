
from __future__ import annotations

import hashlib
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle
from orelode.operators import bronze, gold, invariants, quality, silver, tuples
from orelode.plans import analytics, delivery, report, summary
from orelode.plans.lake import SalesLake
from orelode.schemas import INGESTION, ORDERS_COLUMNS
from orelode.session import application_folder
from orelode.sources import landing, scan, sinks, versions

try:  # the only place that may run without the operators for training text
    import corpus_pipeline
    from orelode.llm import queries as llm
except ImportError:
    llm = None

ENTRY_DIR = "/root/testdata/sf0.001"

_lakes: dict[tuple, SalesLake] = {}


def lake(spark: SparkSession, sf_dir: str) -> SalesLake:
    """The lake over the tables of ``sf_dir``, built once per application and state of them."""
    key = (spark.sparkContext.applicationId, sf_dir, *table_states(sf_dir))
    if key not in _lakes:
        folder = hashlib.sha256(repr(key).encode()).hexdigest()[:16]
        root = f"{application_folder(spark)}/{folder}"
        _lakes[key] = SalesLake(
            spark,
            root,
            scan.scan_orders_csv(spark, landed(spark, sf_dir, root, "orders")),
            scan.scan_products_json(spark, landed(spark, sf_dir, root, "products")),
            scan.scan_users_json(spark, landed(spark, sf_dir, root, "users")),
            delivery.delivered_spellings(spark, sf_dir),
        )
    return _lakes[key]


DELIVERIES = {
    "orders": delivery.orders_delivery,
    "products": delivery.products_delivery,
    "users": delivery.users_delivery,
}


def landed(spark: SparkSession, sf_dir: str, root: str, source: str) -> str:
    """Text files of a source, landed date by date; the second date arrives twice."""
    path, staging = f"{root}/landed/{source}", f"{root}/staging/{source}"
    rows = sinks.write_plain(DELIVERIES[source](spark, sf_dir), staging)
    for date in (delivery.FIRST_DATE, delivery.SECOND_DATE, delivery.SECOND_DATE):
        one = rows.filter(F.col(INGESTION) == date)
        landing.land_snapshot(one, path, date, "csv" if source == "orders" else "json")
    sinks.remove_folder(spark, staging)
    return path


def table_states(sf_dir: str) -> list[tuple[str, int, int]]:
    """Size and time of the tables where they are local files; elsewhere they stay as they
    are for as long as an application runs."""
    paths = [f"{sf_dir}/{table}.parquet" for table in delivery.TABLES]
    states = [(path, os.stat(path)) for path in paths if os.path.exists(path)]
    return [(path, state.st_size, state.st_mtime_ns) for path, state in states]


def plain(rows: DataFrame) -> DataFrame:
    """Dates, timestamps and arrays as text, which every engine hands over alike."""
    columns = []
    for name, kind in rows.dtypes:
        value = F.col(name)
        if kind in ("date", "timestamp", "timestamp_ntz"):
            value = value.cast("string")
        elif kind.startswith("array"):
            value = F.array_join(value, "|")
        columns.append(value.alias(name))
    return rows.select(*columns)


def dims(tables: SalesLake) -> dict[str, tuple[DataFrame, str]]:
    return {
        "dim_date": (tables.dim_date(), "date_id"),
        "dim_product": (tables.dim_product(), "product_id"),
        "dim_customer": (tables.dim_customer(), "customer_id"),
    }


# --- sources and sinks ------------------------------------------------------------------


def land_snapshot(t: SalesLake) -> DataFrame:
    return scan.scan_orders_csv(t.spark, f"{t.root}/landed/orders")


def landed_dates(t: SalesLake) -> DataFrame:
    """What lies under each date when a wrong delivery of the second one was landed before it."""
    path, raw = t.scratch("landed_dates"), t.orders_raw()
    second = raw.filter(F.col(INGESTION) == delivery.SECOND_DATE)
    landing.land_snapshot(second.unionByName(raw), path, delivery.SECOND_DATE)
    landing.land_snapshot(raw.filter(F.col(INGESTION) == delivery.FIRST_DATE), path, delivery.FIRST_DATE)
    landing.land_snapshot(second, path, delivery.SECOND_DATE)
    return scan.scan_orders_csv(t.spark, path).groupBy(INGESTION).agg(
        F.count("*").alias("rows"),
        F.count_distinct("invoiceno").alias("invoices"),
        F.sum(F.length("country")).alias("country_signs"),
        F.sum(F.col("quantity").try_cast("int")).alias("quantity"),
    )


def scan_orders_csv(t: SalesLake) -> DataFrame:
    return scan.scan_orders_csv(t.spark, f"{t.root}/landed/orders")


def scan_products_json(t: SalesLake) -> DataFrame:
    rows = scan.scan_products_json(t.spark, f"{t.root}/landed/products")
    return rows.select("*", "dimensions.*").drop("dimensions")


def scan_users_json(t: SalesLake) -> DataFrame:
    return silver.silver_users(scan.scan_users_json(t.spark, f"{t.root}/landed/users"))


def discover_partitions(t: SalesLake) -> DataFrame:
    t.orders_raw()
    application = t.spark.sparkContext.applicationId.replace("-", "_")
    table = f"orders_raw_{application}_{os.path.basename(t.root)}"
    columns = ", ".join(f"{name} STRING" for name in ORDERS_COLUMNS)
    folder = versions.version_folder(t.spark, f"{t.root}/bronze/orders_raw")
    rows = landing.discover_partitions(t.spark, table, folder, columns)
    rows = sinks.write_plain(rows, t.scratch("discover_partitions"))
    t.spark.sql(f"DROP TABLE {table}")
    return rows


def write_partitioned_parquet(t: SalesLake) -> DataFrame:
    path = t.scratch("write_partitioned_parquet")
    sinks.write_partitioned_parquet(t.orders_clean(), path)
    return sinks.write_partitioned_parquet(t.orders_clean(), path, refresh_only=True)


def write_parquet(t: SalesLake) -> DataFrame:
    return sinks.write_parquet(t.products_clean(), t.scratch("write_parquet"))


def rebuild_zone(t: SalesLake) -> DataFrame:
    path, rows = t.scratch("rebuild_zone"), t.orders_clean()
    for _ in range(2):  # the rows lie by month in their files
        found = sinks.rebuild_zone(rows, path, ("year", "month"), clustered=True, ordered=False)
    return found


def merged_tuples(t: SalesLake) -> DataFrame:
    """The table of the first date's tuples, with the second date added as a later delivery."""
    path, raw = t.scratch("merged_tuples"), t.orders_raw()
    buckets = tuples.bucket_count(t.size("orders_raw")[0], 8)
    tuples.write_tuples(raw.filter(F.col(INGESTION) == delivery.FIRST_DATE), path, buckets)
    later = raw.filter(F.col(INGESTION) == delivery.SECOND_DATE)
    return tuples.add_delivery(path, later).drop(tuples.HASH)


def distinct_by_year(t: SalesLake) -> DataFrame:
    sketches = analytics.monthly_sketches(t.fact_sales(), t.dim_date())
    sketches = sinks.write_parquet(sketches, t.scratch("monthly_sketches"))
    return analytics.distinct_by_year(t.fact_sales(), t.dim_date(), sketches)


def line_balance(t: SalesLake) -> DataFrame:
    """What became of the lines of both catalogs, by date."""
    parts = [
        scan.line_balance(t.spark, f"{t.root}/landed/{source}").withColumn("source", F.lit(source))
        for source in ("products", "users")
    ]
    counts = parts[0].unionByName(parts[1]).groupBy("source", INGESTION)
    sums = [F.sum(name).alias(name) for name in ("lines", "blank", "unreadable", "readable")]
    return counts.agg(*sums, F.bool_and("passed").alias("passed"))


def unreadable_lines(t: SalesLake) -> DataFrame:
    """The catalog landed again with the last sign of every 97th line lost."""
    raw = t.products_raw()
    line = F.to_json(F.struct(*[name for name in raw.columns if name != INGESTION]))
    line = F.when(F.col("id") % 97 == 0, F.substr(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    path = t.scratch("broken_products")
    for date in (delivery.FIRST_DATE, delivery.SECOND_DATE):
        some = raw.filter(F.col(INGESTION) == date).select(line.alias("value"))
        landing.land_snapshot(some, path, date, "text")
    found = scan.unreadable_lines(t.spark, path)
    number = F.regexp_extract("text", '"id":([0-9]+)', 1).cast("bigint").alias("id")
    return found.select(INGESTION, number, (F.col("offset") >= 0).alias("placed"))


def publish_results(t: SalesLake) -> DataFrame:
    published_results(t)
    return report.read_report(t.spark, f"{t.root}/published/latest/report")


def published_by_question(t: SalesLake) -> DataFrame:
    published_results(t)
    return report.read_by_question(t.spark, f"{t.root}/published/latest/by_question")


# --- composed operators -----------------------------------------------------------------


def silver_typed(t: SalesLake) -> DataFrame:
    return silver.silver_typed(silver.silver_dedup(t.orders_tuples()))


def silver_standardise(t: SalesLake) -> DataFrame:
    """One nation is left off the list, so that its spellings stay without a name."""
    spellings = t.spellings.filter(F.col("standard") != "NATION_7")
    rows = silver.silver_standardise(t.orders_raw(), spellings)
    return rows.groupBy("country").agg(F.count("*").alias("rows"))


def resolved(t: SalesLake) -> DataFrame:
    rows = gold.fact_resolve_product(t.orders_clean(), t.dim_product())
    return gold.fact_resolve_customer(rows, t.dim_customer())


def fact_resolve_product(t: SalesLake) -> DataFrame:
    return gold.fact_resolve_product(t.orders_clean(), t.dim_product())


def fact_resolve_customer(t: SalesLake) -> DataFrame:
    return gold.fact_resolve_customer(t.orders_clean(), t.dim_customer())


def fact_surrogate_id(t: SalesLake) -> DataFrame:
    rows = gold.fact_surrogate_id(resolved(t), t.scratch("fact_surrogate_id"))
    return rows.select("sale_id", "invoice_timestamp", "invoiceno", "source_product_id")


def fact_persistent_id(t: SalesLake) -> DataFrame:
    """Lines of the first date, then all lines: the ids of the first build stay."""
    path, rows = t.scratch("sale_ids"), resolved(t)
    first = rows.filter(F.col("source_ingestion_date") == delivery.FIRST_DATE)
    buckets = tuples.bucket_count(t.size("orders_clean")[0], 8)
    for number, some in enumerate((first, rows)):
        found = gold.fact_persistent_id(some, path, f"{t.scratch('sale_numbers')}{number}", buckets)
    return found.select("sale_id", *gold.LINE_KEY)


def null_only_on_convention(t: SalesLake) -> DataFrame:
    return invariants.check_dim_null_only_on_convention(
        {
            "dim_product": (t.dim_product(), F.col("is_unknown"), ["rating", "tags", "sku"]),
            "dim_customer": (
                t.dim_customer(),
                F.col("customer_id") < 0,
                ["age", "latitude", "city"],
            ),
        }
    )


def published_results(t: SalesLake) -> dict[str, DataFrame]:
    """The twelve results from one summary of the fact, published once; the report is made from the
    published files."""
    if t.root not in _published:
        path = t.scratch("summary")
        made = summary.sales_summary(t.fact_sales(), t.dim_product(), path)
        found = summary.answers(made, t.dim_date(), t.dim_product(), t.dim_customer())
        live = {name: found[name] for name in report.QUERY_INDEX}
        _published[t.root] = report.publish_results(live, f"{t.root}/published", "run-1")
        sinks.remove_folder(t.spark, path)
    return _published[t.root]


_published: dict[str, dict[str, DataFrame]] = {}

QUESTIONS: dict[str, Callable[[SalesLake], DataFrame]] = {
    "q1_total": lambda t: analytics.q1_total(t.fact_sales(), t.dim_date()),
    "q1_by_country": lambda t: analytics.q1_by_country(t.fact_sales(), t.dim_date()),
    "q2_top_revenue": lambda t: analytics.q2_top_revenue(t.fact_sales(), t.dim_product()),
    "q2_top_quantity": lambda t: analytics.q2_top_quantity(t.fact_sales(), t.dim_product()),
    "q2_rank_comparison": lambda t: analytics.q2_rank_comparison(
        t.fact_sales(), t.dim_product()
    ),
    "q3_monthly": lambda t: analytics.q3_monthly(t.fact_sales(), t.dim_date()),
    "q3_additivity_check": lambda t: analytics.q3_additivity_check(t.fact_sales(), t.dim_date()),
    "q4_basket_by_country": lambda t: analytics.q4_basket_by_country(t.fact_sales()),
    "q5_top_customers": lambda t: analytics.q5_top_customers(t.fact_sales(), t.dim_customer()),
    "q6_orphan_population": lambda t: analytics.q6_orphan_population(t.fact_sales()),
    "q6_orphan_impact": lambda t: analytics.q6_orphan_impact(
        t.fact_sales(), t.dim_product(), t.dim_customer()
    ),
    "q6_orphan_trend": lambda t: analytics.q6_orphan_trend(t.fact_sales(), t.dim_date()),
}

OPERATORS: dict[str, Callable[[SalesLake], DataFrame]] = {
    # sources and sinks
    "land_snapshot": land_snapshot,
    "landed_dates": landed_dates,
    "scan_orders_csv": scan_orders_csv,
    "scan_products_json": scan_products_json,
    "scan_users_json": scan_users_json,
    "discover_partitions": discover_partitions,
    "write_partitioned_parquet": write_partitioned_parquet,
    "write_parquet": write_parquet,
    "rebuild_zone": rebuild_zone,
    "publish_results": publish_results,
    "recorded_rows": lambda t: t.recorded_rows(),
    "line_balance": line_balance,
    "unreadable_lines": unreadable_lines,
    "orders_tuples": lambda t: t.orders_tuples().drop(tuples.HASH),
    "merged_tuples": merged_tuples,
    # raw layer
    "bronze_header_leak": lambda t: bronze.bronze_header_leak(t.orders_raw()),
    "bronze_anomaly_counts": lambda t: bronze.bronze_anomaly_counts(t.orders_raw()),
    "nested_projection": lambda t: bronze.products_sample(t.products_raw()),
    "nested_projection_users": lambda t: bronze.users_sample(t.users_raw()),
    "source_anomaly_profile": lambda t: bronze.source_anomaly_profile(t.orders_raw()),
    "multi_date_ratio": lambda t: bronze.multi_date_ratio(t.orders_raw()),
    # profiles
    "quality_completeness": lambda t: quality.quality_completeness(t.orders_raw()),
    "quality_exact_duplicates": lambda t: quality.quality_exact_duplicates(t.orders_tuples()),
    "quality_near_duplicates": lambda t: quality.quality_near_duplicates(t.orders_raw()),
    "quality_timestamp_profile": lambda t: quality.quality_timestamp_profile(t.orders_raw()),
    "quality_unreadable_values": lambda t: quality.quality_unreadable_values(t.orders_raw()),
    "quality_numeric_profile": lambda t: quality.quality_numeric_profile(t.orders_raw()),
    "quality_return_price_crosstab": lambda t: quality.quality_return_price_crosstab(
        t.orders_raw()
    ),
    "quality_spelling_counts": lambda t: quality.quality_spelling_counts(
        t.orders_raw(), t.spellings
    ),
    "quality_mapping_coverage": lambda t: quality.quality_mapping_coverage(
        t.orders_raw(), t.spellings.filter(F.col("standard") != "NATION_7")
    ),
    "quality_orphan_keys": lambda t: quality.quality_orphan_keys(
        t.orders_raw(), t.products_raw(), t.users_raw()
    ),
    "quality_orphan_keys_all_snapshots": lambda t: quality.quality_orphan_keys(
        t.orders_raw(), t.products_raw(), t.users_raw(), latest_only=False
    ),
    "quality_inner_join_loss": lambda t: quality.quality_inner_join_loss(
        t.orders_raw(), t.products_raw(), t.users_raw()
    ),
    "quality_multi_dated_keys": lambda t: quality.quality_multi_dated_keys(t.orders_raw()),
    "quality_null_rate": lambda t: quality.quality_null_rate(t.products_raw()),
    "quality_nested_histogram": lambda t: quality.quality_nested_histogram(t.users_raw()),
    "quality_silver_forecast": lambda t: quality.quality_silver_forecast(t.orders_tuples()),
    # clean layer
    "silver_dedup": lambda t: silver.silver_dedup(t.orders_tuples()),
    "silver_typed": silver_typed,
    "silver_standardise": silver_standardise,
    "silver_reject_rules": lambda t: silver.silver_rejects(silver_typed(t)),
    "rejected_by_rule": lambda t: silver.rejected_by_rule(t.orders_tuples()),
    "silver_orders": lambda t: t.orders_clean(),
    "silver_products": lambda t: t.products_clean(),
    "silver_users": lambda t: t.users_clean(),
    "silver_totals": lambda t: silver.silver_totals(t.orders_clean()),
    "silver_null_assertions": lambda t: silver.silver_null_assertions(t.orders_clean()),
    "silver_distinct_count": lambda t: silver.silver_distinct_count(t.orders_clean()),
    "silver_partition_counts": lambda t: silver.silver_partition_counts(t.orders_clean()),
    "silver_return_split": lambda t: silver.silver_return_split(t.orders_clean()),
    "silver_orphans_kept": lambda t: silver.silver_orphans_kept(
        t.orders_clean(), t.products_clean(), t.users_clean()
    ),
    "silver_key_uniqueness": lambda t: silver.silver_key_uniqueness(
        t.products_clean(), t.users_clean()
    ),
    "silver_bronze_intact": lambda t: silver.silver_bronze_intact(t.orders_raw()),
    # star schema
    "dim_date": lambda t: t.dim_date(),
    "dim_product": lambda t: t.dim_product(),
    "dim_customer": lambda t: t.dim_customer(),
    "fact_surrogate_id": fact_surrogate_id,
    "fact_persistent_id": fact_persistent_id,
    "fact_resolve_product": fact_resolve_product,
    "fact_resolve_customer": fact_resolve_customer,
    "fact_sales": lambda t: t.fact_sales(),
    # invariants
    "inv_volume_preserved": lambda t: invariants.inv_volume_preserved(
        t.orders_clean(), t.fact_sales()
    ),
    "inv_grain_unique": lambda t: invariants.inv_grain_unique(t.fact_sales()),
    "inv_no_fanout": lambda t: invariants.inv_no_fanout(
        t.fact_sales(), t.dim_date(), t.dim_product(), t.dim_customer()
    ),
    "inv_pk_unique": lambda t: invariants.inv_pk_unique(dims(t)),
    "inv_no_unhandled_orphan": lambda t: invariants.inv_no_unhandled_orphan(
        t.fact_sales(), t.dim_date(), t.dim_product(), t.dim_customer()
    ),
    "inv_convention_usage": lambda t: invariants.inv_convention_usage(t.fact_sales()),
    "inv_calendar_continuous": lambda t: invariants.inv_calendar_continuous(t.dim_date()),
    "demo_inner_join_cost": lambda t: invariants.demo_inner_join_cost(
        t.fact_sales(), t.dim_product(), t.dim_customer()
    ),
    "check_dim_null_only_on_convention": null_only_on_convention,
    # business questions
    **QUESTIONS,
    "distinct_by_year": distinct_by_year,
    "month_over_month": lambda t: analytics.full_months(t.fact_sales(), t.dim_date()),
    "global_basket": lambda t: analytics.global_basket(t.fact_sales()),
    "identified_share": lambda t: analytics.identified_share(t.fact_sales()),
    # report
    "published_by_question": lambda t: published_by_question(t),
    "report_long_format": lambda t: report.report_long_format(published_results(t)),
    "report_by_question": lambda t: report.report_by_question(
        report.report_long_format(published_results(t))
    ),
    "report_summary": lambda t: report.report_summary(published_results(t)),
    "report_additivity_verdict": lambda t: report.report_additivity_verdict(
        published_results(t)["q3_additivity_check"]
    ),
    "report_status_groups": lambda t: report.report_status_groups(
        published_results(t)["q2_rank_comparison"]
    ),
    "report_orphan_share": lambda t: report.report_orphan_share(
        published_results(t)["q6_orphan_population"]
    ),
    "report_share_spread": lambda t: report.report_share_spread(
        published_results(t)["q1_by_country"]
    ),
    "report_mean_vs_median": lambda t: report.report_mean_vs_median(
        published_results(t)["q4_basket_by_country"]
    ),
}


def _registered(operator: Callable[[SalesLake], DataFrame]):
    return lambda spark, sf_dir: plain(operator(lake(spark, sf_dir)))


def bronze_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lake(spark, sf_dir)
    tables = {
        "orders_raw": t.orders_raw(),
        "products_raw": t.products_raw(),
        "users_raw": t.users_raw(),
    }
    return bronze.bronze_row_counts(tables, delivery.expected_counts(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: what is missing on the order lines, and the revenue that hangs on it."""
    return queries()["q6_orphan_population"](spark, ENTRY_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = {name: _registered(operator) for name, operator in OPERATORS.items()}
    registered["bronze_row_counts"] = bronze_row_counts
    if llm is not None:
        registered |= {**llm.QUERIES, "pipeline": corpus_pipeline.run}
    return registered


def oracle_sql() -> dict[str, str]:
    """The same results in SQL over the given tables alone."""
    statements = oracle.statements()
    if llm is not None:
        statements |= llm.ORACLES
        if corpus_pipeline.ORACLE_SQL is not None:
            statements["pipeline"] = corpus_pipeline.ORACLE_SQL
    return statements
