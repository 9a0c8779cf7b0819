"""Checks of the raw layer, and counts of the defects it holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.functions.parsing import is_return, safe_double
from orelode.schemas import INGESTION


def bronze_row_counts(tables: Mapping[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Rows per source and ingestion date, next to the expected number.

    ``expected`` has the columns source, ingestion_date and expected. A source or a date
    that is missing on either side shows as a row that did not pass.
    """
    counts = [
        table.groupBy(F.lit(name).alias("source"), INGESTION).agg(F.count("*").alias("rows"))
        for name, table in tables.items()
    ]
    found = reduce(DataFrame.unionByName, counts)
    return (
        found.join(expected, ["source", INGESTION], "full")
        .select(
            "source",
            INGESTION,
            F.coalesce("rows", F.lit(0)).alias("rows"),
            F.coalesce("expected", F.lit(0)).alias("expected"),
        )
        .withColumn("passed", F.col("rows") == F.col("expected"))
        .orderBy("source", INGESTION)
    )


def bronze_header_leak(orders: DataFrame, column: str = "invoiceno", header: str = "InvoiceNo") -> DataFrame:
    return orders.agg(F.count_if(F.col(column) == header).alias("header_leaked"))


def bronze_anomaly_counts(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("quantity") == "").alias("quantity_blank"),
        F.count_if(F.col("customerid") == "").alias("customer_blank"),
        F.count_if(F.col("invoicedate") == "").alias("date_blank"),
        F.count_if(F.col("invoicedate").contains("/")).alias("date_wrong_format"),
        F.count_if(safe_double(F.col("unitprice")) <= 0).alias("price_zero_or_negative"),
        F.count_if(is_return(F.col("invoiceno"))).alias("returns"),
    )


def nested_projection(
    rows: DataFrame, key: str, fields: Mapping[str, str | Column], limit: int = 3
) -> DataFrame:
    """First rows by key, then by ingestion date, with fields picked out of nested columns by
    path."""
    picked = [
        (F.col(path) if isinstance(path, str) else path).alias(name)
        for name, path in fields.items()
    ]
    order = [key, *[name for name in (INGESTION,) if name in rows.columns]]
    return rows.orderBy(*order).limit(limit).select(key, *picked)


def products_sample(products: DataFrame, limit: int = 3) -> DataFrame:
    fields = {
        "title": "title",
        "brand": "brand",
        "width": "dimensions.width",
        "tag_count": F.size("tags").cast("bigint"),
    }
    return nested_projection(products, "id", fields, limit)


def users_sample(users: DataFrame, limit: int = 3) -> DataFrame:
    fields = {
        "city": "address.city",
        "lat": "address.coordinates.lat",
        "company_country": "company.address.country",
    }
    return nested_projection(users, "id", fields, limit)


def source_anomaly_profile(orders: DataFrame) -> DataFrame:
    """Defects counted after trimming, with the number of distinct trimmed countries.

    Rows are reduced to one per trimmed country on the map side before they are shuffled.
    """
    blank = {
        "blank_dates": "invoicedate",
        "blank_quantities": "quantity",
        "blank_customers": "customerid",
    }
    flags: Sequence[Column] = [
        *[F.count_if(F.trim(column) == "").alias(name) for name, column in blank.items()],
        F.count_if(F.col("invoicedate").contains("/")).alias("slash_dates"),
        F.count_if(is_return(F.col("invoiceno"))).alias("returns"),
    ]
    names = [*blank, "slash_dates", "returns"]
    per_country = orders.groupBy(F.trim("country").alias("country")).agg(
        F.count("*").alias("rows"), *flags
    )
    return per_country.agg(
        F.sum("rows").alias("rows"),
        *[F.sum(name).alias(name) for name in names],
        F.count("country").alias("country_spellings"),
    )


def multi_date_ratio(orders: DataFrame) -> DataFrame:
    """Share of invoice numbers that occur on more than one day."""
    stamp = F.trim("invoicedate")
    per_invoice = (
        orders.filter(stamp != "")
        .groupBy("invoiceno")
        .agg(F.count_distinct(F.substring(stamp, 1, 10)).alias("days"))
    )
    return per_invoice.agg(
        F.count("*").alias("invoices"),
        F.count_if(F.col("days") > 1).alias("multi_dated"),
        F.round(F.try_divide(F.count_if(F.col("days") > 1), F.count("*")), 4).alias("ratio"),
    )
