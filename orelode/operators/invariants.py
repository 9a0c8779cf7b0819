"""Checks that the star schema lost nothing, repeats nothing and resolves everything."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode import schemas
from orelode.functions.measures import CENTS, exact_sum, money, percent
from orelode.operators.lookup import BROADCAST_ROWS, with_matches

GRAIN = ("invoiceno", "product_id", "invoice_timestamp")


def no_product() -> Column:
    return F.col("product_id") == schemas.UNKNOWN_PRODUCT


def no_customer() -> Column:
    return F.col("customer_id") < 0


def inv_volume_preserved(orders_clean: DataFrame, fact: DataFrame) -> DataFrame:
    """I1: as many facts as clean order lines."""
    silver = orders_clean.agg(F.count("*")).scalar()
    counts = fact.agg(F.count("*").alias("gold")).select(silver.alias("silver"), "gold")
    return counts.withColumn("passed", F.col("silver") == F.col("gold"))


def inv_grain_unique(fact: DataFrame, grain: Sequence[str] = GRAIN) -> DataFrame:
    """I1b: the declared grain identifies a row. Rows with a NULL in it are not counted."""
    complete = [F.col(name).isNotNull() for name in grain]
    per_grain = fact.groupBy(*grain).agg(F.count("*").alias("n"))
    whole = reduce(lambda a, b: a & b, complete)
    return (
        per_grain.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(whole).alias("grains"))
        .withColumn("collisions", F.col("rows") - F.col("grains"))
        .withColumn("passed", F.col("collisions") == 0)
    )


def _with_dimensions(
    fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]], broadcast_rows: int
) -> DataFrame:
    """Per fact the number of matching rows in each dimension, in a column of its name."""
    found = fact
    for name, (dim, key) in dims.items():
        rows = dim.select(F.col(key).alias("_dim_key"))
        found = with_matches(found, rows, key, "_dim_key", name, broadcast_rows, key_source=fact)
    return found


def inv_no_fanout(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """I2: inner joins to all dimensions neither drop nor repeat a fact.

    A joined fact would occur as often as the product of its matches says; summing that
    product gives the joined totals without building the joined rows.
    """
    lines = _with_dimensions(
        fact.select("date_id", "product_id", "customer_id", "line_amount"),
        {
            "dates": (dim_date, "date_id"),
            "products": (dim_product, "product_id"),
            "customers": (dim_customer, "customer_id"),
        },
        broadcast_rows,
    )
    times = F.col("dates") * F.col("products") * F.col("customers")
    joined = lines.agg(
        F.count("*").alias("before_join"),
        F.coalesce(F.sum(times), F.lit(0)).alias("after_join"),
        money(joined_revenue(times)).alias("revenue_after_join"),
    )
    return joined.withColumn("passed", F.col("before_join") == F.col("after_join"))


def joined_revenue(times: Column) -> Column:
    """Exact revenue of lines that a join would repeat so many times."""
    return F.sum(F.when(times > 0, F.col("line_amount").cast(CENTS) * times))


def inv_pk_unique(dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """I3: no dimension repeats its key."""
    checks = [
        dim.agg((F.count("*") - F.count_distinct(key)).alias("duplicates")).select(
            F.lit(name).alias("dim"), "duplicates"
        )
        for name, (dim, key) in dims.items()
    ]
    found = reduce(DataFrame.unionByName, checks)
    return found.withColumn("passed", F.col("duplicates") == 0)


def inv_no_unhandled_orphan(
    fact: DataFrame, dim_date: DataFrame, dim_product: DataFrame, dim_customer: DataFrame
) -> DataFrame:
    """I4: every key of every fact exists in its dimension.

    Facts are reduced to one row per key on the map side before the anti join, so each
    check reads one column and a frequent key costs no more than a rare one.
    """

    def unmatched(dim: DataFrame, key: str) -> Column:
        keys = fact.groupBy(key).agg(F.count("*").alias("n"))
        missing = keys.join(dim.select(key), key, "left_anti")
        return missing.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()

    found = fact.sparkSession.range(1).select(
        unmatched(dim_date, "date_id").alias("facts_without_date"),
        unmatched(dim_product, "product_id").alias("facts_without_product"),
        unmatched(dim_customer, "customer_id").alias("facts_without_customer"),
    )
    total = reduce(lambda a, b: a + b, [F.col(name) for name in found.columns])
    return found.withColumn("passed", total == 0)


def inv_convention_usage(fact: DataFrame) -> DataFrame:
    """I5: how much of the fact hangs on convention rows."""
    orphan = no_product() | no_customer()
    amount = F.col("line_amount")
    return fact.agg(
        F.count_if(no_product()).alias("unknown_product"),
        F.count_if(F.col("customer_id") == schemas.ORPHAN_CUSTOMER).alias("orphan_customer"),
        F.count_if(F.col("customer_id") == schemas.UNRECORDED_CUSTOMER).alias(
            "unrecorded_customer"
        ),
        F.count_if(orphan).alias("orphan_rows"),
        money(exact_sum(F.when(orphan, amount))).alias("orphan_revenue"),
        percent(exact_sum(F.when(orphan, amount).otherwise(0.0)), exact_sum(amount)).alias(
            "orphan_pct"
        ),
    )


def inv_calendar_continuous(dim_date: DataFrame) -> DataFrame:
    """I6: as many days as lie between the first and the last one."""
    days = dim_date.agg(
        F.count("*").alias("days"),
        (F.date_diff(F.max("full_date"), F.min("full_date")) + 1).cast("bigint").alias("expected"),
    )
    return days.withColumn("passed", F.col("days") == F.col("expected"))


def demo_inner_join_cost(
    fact: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """What a report would lose by inner joins to the real products and customers only."""
    dims = {
        "products": (dim_product.filter(~no_product()), "product_id"),
        "customers": (dim_customer.filter(F.col("customer_id") > 0), "customer_id"),
    }
    lines = fact.select("product_id", "customer_id", "line_amount")
    lines = _with_dimensions(lines, dims, broadcast_rows)
    times = F.col("products") * F.col("customers")
    kept = F.coalesce(joined_revenue(times), F.lit(0).cast(CENTS))
    return lines.agg(
        (F.count("*") - F.coalesce(F.sum(times), F.lit(0))).alias("lines_lost"),
        money(exact_sum("line_amount") - kept).alias("revenue_lost"),
    )


def check_dim_null_only_on_convention(
    dims: Mapping[str, tuple[DataFrame, Column, Sequence[str]]],
) -> DataFrame:
    """NULLs of attributes every natural row has, counted apart for convention rows.

    ``dims`` gives per dimension its rows, the test for a convention row and attributes.
    """

    def counts(name: str, rows: DataFrame, convention: Column, attributes: Sequence[str]):
        def nulls(where: Column, suffix: str) -> list[Column]:
            return [
                F.count_if(F.col(a).isNull() & where).alias(f"{a}_{suffix}") for a in attributes
            ]

        wide = rows.agg(*nulls(~convention, "natural"), *nulls(convention, "convention"))
        return reduce(
            DataFrame.unionByName,
            [
                wide.select(
                    F.lit(name).alias("dim"),
                    F.lit(a).alias("attribute"),
                    F.col(f"{a}_natural").alias("natural_nulls"),
                    F.col(f"{a}_convention").alias("convention_nulls"),
                )
                for a in attributes
            ],
        )

    found = reduce(
        DataFrame.unionByName, [counts(name, *parts) for name, parts in dims.items()]
    )
    return found.withColumn("passed", F.col("natural_nulls") == 0)
