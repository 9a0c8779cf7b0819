"""Read-only profiles of the raw layer: what is wrong, and how much of it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.functions.measures import FINE, exact_sum, money, percent
from orelode.functions.parsing import (
    is_return,
    safe_double,
    safe_integer,
    safe_timestamp,
    spelling_key,
)
from orelode.operators.lookup import BROADCAST_ROWS, lookup, with_matches
from orelode.operators.silver import business_tuples
from orelode.schemas import ORDERS_COLUMNS


def price() -> Column:
    return safe_double(F.col("unitprice"))


def stamp() -> Column:
    return safe_timestamp(F.col("invoicedate"))


def quality_completeness(orders: DataFrame, columns: Sequence[str] = ORDERS_COLUMNS) -> DataFrame:
    blanks = [F.count_if(F.col(name) == "").alias(f"{name}_blank") for name in columns]
    return orders.agg(F.count("*").alias("total"), *blanks)


def quality_exact_duplicates(orders: DataFrame) -> DataFrame:
    groups = business_tuples(orders).filter("copies > 1")
    return groups.agg(
        F.count("*").alias("duplicate_groups"),
        F.sum("copies").alias("rows_involved"),
        (F.sum("copies") - F.count("*")).alias("rows_to_remove"),
        F.max("copies").alias("largest_group"),
    )


def quality_near_duplicates(orders: DataFrame) -> DataFrame:
    """Same invoice and product on several rows that differ in date, price or quantity.

    One pass and one shuffle, all of it on numbers: texts are compared by two independent hashes of
    64 bits, whose least and greatest values within a key tell whether there are several. A NULL is
    no value to differ in, and a row with one is no combination.
    """
    key = ["invoiceno", "productid"]
    parts = {"dates": ["invoicedate"], "prices": ["unitprice"], "quantities": ["quantity"]}
    parts["combinations"] = [name for names in parts.values() for name in names]

    def several(names: Sequence[str]) -> Column:
        """Whether the rows of a key hold more than one value of these columns."""
        known = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in names])
        hashes = [F.when(known, F.xxhash64(*names, F.lit(seed))) for seed in (0, 1)]
        return reduce(lambda a, b: a | b, [F.min(h) != F.max(h) for h in hashes])

    near = (
        orders.groupBy(*key)
        .agg(F.count("*").alias("n"), *[several(names).alias(name) for name, names in parts.items()])
        .filter("n > 1 AND combinations")
    )
    return near.agg(
        F.count("*").alias("groups"),
        F.sum("n").alias("rows"),
        *[F.count_if(name).alias(f"{name}_differ") for name in list(parts)[:3]],
    )


def quality_timestamp_profile(orders: DataFrame) -> DataFrame:
    text = F.col("invoicedate")
    return orders.agg(
        F.count("*").alias("total"),
        F.count_if(text == "").alias("blank"),
        F.count_if((text != "") & stamp().isNull()).alias("unreadable"),
        F.min(stamp()).alias("min_date"),
        F.max(stamp()).alias("max_date"),
    )


def quality_unreadable_values(orders: DataFrame) -> DataFrame:
    text = F.col("invoicedate")
    unreadable = orders.filter((text != "") & stamp().isNull())
    return unreadable.groupBy("invoicedate").agg(F.count("*").alias("n"))


def quality_numeric_profile(orders: DataFrame, extreme: float = 1000.0) -> DataFrame:
    not_a_number = F.isnan(F.col("unitprice").try_cast("double"))
    return orders.agg(
        # NaN is a number as far as the cast goes, though no price.
        F.count_if(price().isNull() & ~F.coalesce(not_a_number, F.lit(False))).alias("non_numeric"),
        F.count_if(price() == 0).alias("zero"),
        F.count_if(price() < 0).alias("negative"),
        F.count_if(price() > extreme).alias("extreme"),
        money(F.max(price())).alias("max_price"),
    )


def quality_return_price_crosstab(orders: DataFrame) -> DataFrame:
    return orders.groupBy(is_return(F.col("invoiceno")).alias("is_return")).agg(
        F.count_if(price() < 0).alias("price_negative"),
        F.count_if(price() == 0).alias("price_zero"),
        F.count_if(price() > 0).alias("price_positive"),
    )


def quality_spelling_counts(orders: DataFrame, spellings: DataFrame) -> DataFrame:
    """Spellings as delivered, spellings in lower case, and the names they should become."""
    raw = orders.groupBy("country").agg(F.count("*").alias("rows"))
    names = spellings.agg(F.count_distinct("standard")).scalar()
    return raw.agg(
        F.count("country").alias("raw_spellings"),
        F.count_distinct(F.lower("country")).alias("after_lower"),
    ).select("raw_spellings", "after_lower", names.alias("real_countries"))


def quality_mapping_coverage(orders: DataFrame, spellings: DataFrame) -> DataFrame:
    """What the spelling list covers. The list is applied to spellings, not to rows."""
    forms = orders.groupBy(spelling_key(F.col("country")).alias("form")).agg(
        F.count("*").alias("rows")
    )
    mapped = lookup(forms, spellings, "form", "spelling")
    unmapped = F.when(F.col("standard").isNull(), F.col("rows")).otherwise(0)
    return mapped.agg(
        F.sum("rows").alias("total"),
        F.sum(unmapped).alias("non_mapped"),
        F.count_distinct("standard").alias("countries"),
    )


def _matched_amounts(
    orders: DataFrame,
    products: DataFrame,
    users: DataFrame,
    latest_only: bool,
    broadcast_rows: int,
) -> DataFrame:
    """Amounts with the number of catalog rows their keys join, as (rows, amount, ...).

    ``latest_only`` counts the snapshots of a catalog row as the one row they describe.
    Pairs of keys are nearly as many as rows, so rows are not added up by them: that would fill the
    memory of the tasks and spare nothing. Rows stay where they are, see ``with_matches``.
    """
    bounds = {"products": products.count(), "users": users.count()}
    amount = (safe_integer(F.col("quantity")) * price()).cast(FINE)
    keyed = orders.select(
        safe_integer(F.col("productid")).alias("product_id"),
        safe_integer(F.col("customerid")).alias("customer_id"),
        (F.col("customerid") == "").alias("customer_absent"),
        F.lit(1).cast("bigint").alias("rows"),
        amount.alias("amount"),
    )
    lines = keyed
    for catalog, key, out in ((products, "product_id", "products"), (users, "customer_id", "users")):
        ids = catalog.select("id")
        keyed = with_matches(keyed, ids, key, "id", out, broadcast_rows, bounds[out], lines)
        if latest_only:
            keyed = keyed.withColumn(out, F.least(F.col(out), F.lit(1)))
    return keyed


def quality_orphan_keys(
    orders: DataFrame,
    products: DataFrame,
    users: DataFrame,
    latest_only: bool = True,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows and revenue whose keys are in no catalog, by left joins to both catalogs.

    Rows without a readable product id count in ``unresolved_product_rows`` and in
    ``orphan_product_revenue``; the other two product figures leave them out.
    """
    pairs = _matched_amounts(orders, products, users, latest_only, broadcast_rows)
    repeats = F.greatest("products", F.lit(1)) * F.greatest("users", F.lit(1))
    rows = F.col("rows") * repeats
    amount = F.col("amount") * repeats
    no_product = F.col("products") == 0
    orphan_product = no_product & F.col("product_id").isNotNull()
    orphan_customer = (F.col("users") == 0) & F.col("customer_id").isNotNull()

    def count(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0))

    return pairs.agg(
        count(orphan_product).alias("orphan_product_rows"),
        count(no_product).alias("unresolved_product_rows"),
        money(F.sum(F.when(no_product, amount))).alias("orphan_product_revenue"),
        money(F.sum(F.when(orphan_product, amount))).alias("orphan_product_id_revenue"),
        count(orphan_customer).alias("orphan_customer_rows"),
        count(F.col("customer_absent")).alias("missing_customer_rows"),
        money(F.sum(amount)).alias("total_revenue"),
    )


def quality_inner_join_loss(
    orders: DataFrame,
    products: DataFrame,
    users: DataFrame,
    latest_only: bool = True,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows and revenue that inner joins to both catalogs would lose."""
    pairs = _matched_amounts(orders, products, users, latest_only, broadcast_rows)
    repeats = F.col("products") * F.col("users")
    kept = F.when(repeats > 0, F.col("amount") * repeats)
    return pairs.agg(
        (F.sum("rows") - F.sum(F.col("rows") * repeats)).alias("rows_lost"),
        money(F.sum("amount") - F.sum(kept)).alias("revenue_lost"),
    )


def quality_multi_dated_keys(orders: DataFrame) -> DataFrame:
    per_invoice = (
        orders.filter(F.col("invoicedate") != "")
        .groupBy("invoiceno")
        .agg(F.count_distinct("invoicedate").alias("dates"))
    )
    multi = F.count_if(F.col("dates") > 1)
    return per_invoice.agg(
        F.count("*").alias("invoices"),
        multi.alias("multi_dated"),
        percent(multi, F.count("*"), 1).alias("pct"),
    )


def quality_null_rate(products: DataFrame, column: str = "brand") -> DataFrame:
    return products.agg(
        F.count("*").alias("products"),
        F.count_if(F.col(column).isNull()).alias(f"without_{column}"),
    )


def quality_nested_histogram(users: DataFrame, path: str = "address.country") -> DataFrame:
    return users.groupBy(F.col(path).alias("customer_country")).agg(
        F.count("*").alias("customers")
    )


def quality_silver_forecast(orders: DataFrame) -> DataFrame:
    """The row funnel the cleaning rules will produce, and the revenue left at its end.

    One pass: the copies of each tuple give the raw count, the tuples the rest. Amounts
    are rounded per line, as the clean table will hold them.
    """
    quantity = safe_integer(F.col("quantity"), "int")
    dated = stamp().isNotNull()
    priced = dated & (price() > 0)
    kept = priced & quantity.isNotNull()
    return business_tuples(orders).agg(
        F.sum("copies").alias("bronze"),
        F.count("*").alias("after_r1"),
        F.count_if(dated).alias("after_r3"),
        F.count_if(priced).alias("after_r4"),
        F.count_if(kept).alias("silver"),
        money(exact_sum(F.when(kept, F.round(quantity * price(), 2)))).alias("revenue"),
    )
