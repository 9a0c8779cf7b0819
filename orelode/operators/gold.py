"""Star schema: calendar, dimensions with convention rows, and the sales fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode import schemas
from orelode.operators.keymap import persistent_ids
from orelode.operators.lookup import BROADCAST_ROWS, with_matches
from orelode.operators.numbering import number_in_files, number_rows
from orelode.operators.silver import LINE_ORDER, month_columns


def dim_date(orders_clean: DataFrame, date: str = "invoice_date") -> DataFrame:
    """One row per day from the first to the last order, without gaps."""
    bounds = orders_clean.agg(F.min(date).alias("first_day"), F.max(date).alias("last_day"))
    day = F.col("full_date")
    calendar = bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("full_date")
    )
    return calendar.select(
        date_key(day).alias("date_id"),
        "full_date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def date_key(day: Column) -> Column:
    """yyyymmdd as a number."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def with_conventions(rows: DataFrame, conventions: Sequence[Mapping[str, object]]) -> DataFrame:
    """Add rows that stand for unresolved keys; columns they do not name are NULL."""
    single = rows.sparkSession.range(1)
    extra = [
        single.select(
            *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in rows.schema]
        )
        for values in conventions
    ]
    return reduce(DataFrame.unionByName, extra, rows)


def dim_product(products_clean: DataFrame) -> DataFrame:
    flag = [{**row, "is_unknown": True} for row in schemas.PRODUCT_CONVENTIONS]
    return with_conventions(products_clean.withColumn("is_unknown", F.lit(False)), flag)


def dim_customer(users_clean: DataFrame) -> DataFrame:
    known = users_clean.withColumn("customer_type", F.lit("Known"))
    return with_conventions(known, schemas.CUSTOMER_CONVENTIONS)


def fact_resolve_product(
    rows: DataFrame,
    products: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    products_rows: int | None = None,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """Put the convention key where the product id is NULL or not in the dimension.

    Only natural rows of the dimension resolve a key, so a raw id equal to the convention
    key is an unknown id like any other. The delivered id stays as ``source_product_id``.
    """
    natural = products.filter(~F.col("is_unknown")).select(F.col("product_id").alias("known_id"))
    found = with_matches(rows, natural, "product_id", "known_id", "_found", broadcast_rows, products_rows, key_source)
    known = F.when(F.col("_found") > 0, F.col("product_id"))
    return found.withColumns(
        {
            "source_product_id": F.col("product_id"),
            "product_id": F.coalesce(known, F.lit(schemas.UNKNOWN_PRODUCT).cast("bigint")),
        }
    ).drop("_found")


def fact_resolve_customer(
    rows: DataFrame,
    customers: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    key_source: DataFrame | None = None,
    customers_rows: int | None = None,
) -> DataFrame:
    """NULL id: not recorded. Id not in the dimension: orphan. Otherwise the id itself."""
    natural = customers.filter(F.col("customer_type") == "Known").select(
        F.col("customer_id").alias("known_id")
    )
    found = with_matches(
        rows,
        natural,
        "customer_id",
        "known_id",
        "_found",
        broadcast_rows,
        customers_rows,
        key_source,
    )
    key = (
        F.when(F.col("customer_id").isNull(), F.lit(schemas.UNRECORDED_CUSTOMER).cast("bigint"))
        .when(F.col("_found") == 0, F.lit(schemas.ORPHAN_CUSTOMER).cast("bigint"))
        .otherwise(F.col("customer_id"))
    )
    return found.withColumns(
        {"source_customer_id": F.col("customer_id"), "customer_id": key}
    ).drop("_found")


def fact_surrogate_id(rows: DataFrame, staging: str) -> DataFrame:
    """Number the lines by timestamp, invoice and delivered product id.

    The columns after these three only settle ties.
    """
    order = [
        "invoice_timestamp",
        "invoiceno",
        "source_product_id",
        "source_customer_id",
        "quantity",
        "unit_price",
        "country",
        "source_ingestion_date",
    ]
    keys = [F.col(name).asc_nulls_last() for name in order]
    return number_rows(rows, keys, "sale_id", staging)


LINE_KEY = [
    "invoice_timestamp",
    "invoiceno",
    "source_product_id",
    "source_customer_id",
    "quantity",
    "unit_price",
    "country",
]


def fact_persistent_id(rows: DataFrame, path: str, staging: str, buckets: int) -> DataFrame:
    """Ids that later deliveries leave as they are: what a line says is its key, the date of its
    delivery is not. Lines that say the same are told apart by number, the earlier delivered first."""
    order = [F.col(name).asc_nulls_last() for name in LINE_KEY]
    return persistent_ids(
        rows, LINE_KEY, order, path, staging, buckets, "sale_id", ["source_ingestion_date"]
    )


def fact_sales(
    orders_clean: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    staging: str,
    broadcast_rows: int = BROADCAST_ROWS,
    products_rows: int | None = None,
    customers_rows: int | None = None,
    in_order: bool = False,
) -> DataFrame:
    """The fact: every clean order line once, with resolved keys and a surrogate id.

    Its rows lie in time order, so they can be written by year and month as they are. The sizes of
    the dimensions are counted unless bounds are given. While rows are put in order, keys stand beside
    the delivered ones only where they differ, and parts of the timestamp not at all. ``in_order`` is for
    clean orders whose files were written in that order: they are numbered where they lie.
    """
    if in_order:
        numbered = number_in_files(orders_clean, LINE_ORDER, "sale_id")
        numbered = fact_resolve_product(numbered, products, broadcast_rows, products_rows, orders_clean)
        numbered = fact_resolve_customer(numbered, customers, broadcast_rows, orders_clean, customers_rows)
        return _fact_columns(numbered)
    resolved = fact_resolve_product(orders_clean, products, broadcast_rows, products_rows)
    resolved = fact_resolve_customer(
        resolved, customers, broadcast_rows, orders_clean, customers_rows
    )
    keys = {"product_id": "source_product_id", "customer_id": "source_customer_id"}
    other = {key: F.when(~F.col(key).eqNullSafe(F.col(source)), F.col(key)) for key, source in keys.items()}
    narrow = resolved.withColumns(other).drop("invoice_date", "year", "month")
    numbered = fact_surrogate_id(narrow, staging)
    return _fact_columns(numbered.withColumns({key: F.coalesce(key, source) for key, source in keys.items()}))


def _fact_columns(numbered: DataFrame) -> DataFrame:
    year, month = month_columns(F.col("invoice_timestamp"))
    return numbered.select(
        "sale_id",
        "invoiceno",
        date_key(F.col("invoice_timestamp")).alias("date_id"),
        "product_id",
        "customer_id",
        "country",
        "is_return",
        "quantity",
        "unit_price",
        "line_amount",
        "invoice_timestamp",
        "source_ingestion_date",
        "source_product_id",
        year,
        month,
    )
