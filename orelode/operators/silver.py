"""Clean layer: deduplicate, type, standardise, reject, flatten - and its checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.functions.measures import CENTS, exact_sum, money
from orelode.functions.parsing import (
    is_return,
    safe_double,
    safe_integer,
    safe_timestamp,
    spelling_key,
)
from orelode.operators.lookup import BROADCAST_ROWS, lookup, with_matches
from orelode.operators.tuples import tuples_of
from orelode.schemas import INGESTION, ORDERS_COLUMNS

# Reject rules in the order they are tried: label and the condition a row has to meet.
KEEP_RULES = {
    "R3 unreadable date": "invoice_timestamp IS NOT NULL",
    "R4 price not positive": "unit_price > 0",
    "R5 quantity missing": "quantity IS NOT NULL",
}
DUPLICATE_RULE = "R1 exact duplicate"
# The order in which sales are numbered, nulls last; the columns after the first three settle ties.
LINE_ORDER = [
    "invoice_timestamp",
    "invoiceno",
    "product_id",
    "customer_id",
    "quantity",
    "unit_price",
    "country",
    "source_ingestion_date",
]


def spelling_frame(spark: SparkSession, spellings: Mapping[str, str]) -> DataFrame:
    """The spelling list as a table (spelling, standard)."""
    return spark.createDataFrame(list(spellings.items()), "spelling string, standard string")


def business_tuples(orders: DataFrame, columns: Sequence[str] = ORDERS_COLUMNS) -> DataFrame:
    """Distinct business rows with the number of copies; the ingestion date is left out.

    A table of tuples is taken as it is.
    """
    if "copies" in orders.columns:
        return orders.select(*columns, "copies")
    return orders.groupBy(*columns).agg(F.count("*").alias("copies"))


def silver_dedup(orders: DataFrame, columns: Sequence[str] = ORDERS_COLUMNS) -> DataFrame:
    """One row per business tuple, with its latest ingestion date, which is the greatest text."""
    if "copies" not in orders.columns:
        orders = tuples_of(orders, columns)
    return orders.select(*columns, "source_ingestion_date")


def typed_columns(date_formats: Sequence[str] = ()) -> list[Column]:
    """Safe casts of every text column; what cannot be read is NULL."""
    return [
        F.col("invoiceno"),
        safe_integer(F.col("productid")).alias("product_id"),
        safe_integer(F.col("quantity"), "int").alias("quantity"),
        safe_double(F.col("unitprice")).alias("unit_price"),
        safe_integer(F.col("customerid")).alias("customer_id"),
        safe_timestamp(F.col("invoicedate"), date_formats).alias("invoice_timestamp"),
        is_return(F.col("invoiceno")).alias("is_return"),
        F.col("country"),
    ]


def silver_typed(deduplicated: DataFrame, date_formats: Sequence[str] = ()) -> DataFrame:
    return deduplicated.select(*typed_columns(date_formats), "source_ingestion_date")


def silver_standardise(
    rows: DataFrame,
    spellings: DataFrame,
    column: str = "country",
    broadcast_rows: int = BROADCAST_ROWS // 10,
    size: tuple[int | None, int | None] = (None, None),
) -> DataFrame:
    """Replace a column by its standard name; a spelling not on the list gives NULL.

    ``size`` gives rows and text bytes of the list, where they are known without counting.
    """
    names = spellings.groupBy("spelling").agg(F.min("standard").alias("standard"))
    keyed = rows.withColumn("_form", spelling_key(F.col(column)))
    bound, texts = size
    bound = spellings.count() if bound is None else bound
    found = lookup(keyed, names, "_form", "spelling", bound, broadcast_rows, right_bytes=texts)
    return found.withColumn(column, F.col("standard")).drop("_form", "standard")


def read_once(rows: DataFrame, column: str) -> DataFrame:
    """The same rows, whose columns are made before the filters that follow are tried. Spark would move
    these below and read every text they ask about twice; it moves none below a value that names its
    partition, which changes nothing here."""
    return rows.withColumn(column, F.when(F.spark_partition_id() >= 0, F.col(column)))


def silver_reject_rules(typed: DataFrame) -> DataFrame:
    """The rows that meet every rule."""
    for condition in KEEP_RULES.values():
        typed = typed.filter(condition)
    return typed


def silver_rejects(typed: DataFrame) -> DataFrame:
    """The rows that fail a rule, labelled with the first one they fail."""
    return typed.withColumn("rule", first_failed_rule()).filter(F.col("rule").isNotNull())


def first_failed_rule() -> Column:
    failed = [
        F.when(~F.coalesce(F.expr(condition), F.lit(False)), F.lit(rule))
        for rule, condition in KEEP_RULES.items()
    ]
    return F.coalesce(*failed)


def rejected_by_rule(orders: DataFrame) -> DataFrame:
    """Rows removed on the way to the clean table, per rule, in one pass."""
    typed = business_tuples(orders).select("copies", *typed_columns())
    labelled = typed.select("copies", first_failed_rule().alias("failed"))
    rules = [F.count_if(F.col("failed") == rule).alias(rule) for rule in KEEP_RULES]
    duplicates = (F.sum("copies") - F.count("*")).alias(DUPLICATE_RULE)
    totals = labelled.agg(duplicates, *rules)
    return totals.unpivot([], [DUPLICATE_RULE, *KEEP_RULES], "rule", "rows")


def silver_orders(
    orders: DataFrame,
    spellings: DataFrame,
    date_formats: Sequence[str] = (),
    spellings_size: tuple[int | None, int | None] = (None, None),
    by_month: bool = False,
    in_order: bool = False,
) -> DataFrame:
    """The clean orders: one row per business tuple that meets every rule.

    ``by_month`` brings the rows of a month together, to be written by month as they come; what
    follows from other columns is made after that, so that it does not travel. ``in_order`` does the
    same with rows in LINE_ORDER, within files and between them, so that numbering them later moves none.
    Its rows need years of four digits, whose texts rise as they do.
    """
    typed = read_once(silver_typed(silver_dedup(orders), date_formats), "invoice_timestamp")
    kept = silver_reject_rules(typed)
    stamp = F.col("invoice_timestamp")
    rows = silver_standardise(kept, spellings, size=spellings_size)
    if in_order:
        rows = rows.drop("is_return").repartitionByRange(*[F.col(name).asc_nulls_last() for name in LINE_ORDER])
    elif by_month:
        rows = rows.drop("is_return").withColumn("_month", F.year(stamp) * 100 + F.month(stamp))
        rows = rows.hint("rebalance", "_month")
    year, month = month_columns(stamp)
    clean = rows.select(
        "invoiceno",
        "product_id",
        "quantity",
        "unit_price",
        F.round(F.col("quantity") * F.col("unit_price"), 2).alias("line_amount"),
        "customer_id",
        "country",
        is_return(F.col("invoiceno")).alias("is_return"),
        stamp.cast("date").alias("invoice_date"),
        "invoice_timestamp",
        "source_ingestion_date",
        year,
        month,
    )
    if not in_order:
        return clean
    # The rules leave no row without a timestamp. Partition columns that may be null would be sorted again.
    clean = clean.withColumns({name: F.coalesce(name, F.lit("")) for name in ("year", "month")})
    return clean.sortWithinPartitions("year", "month", *[F.col(name).asc_nulls_last() for name in LINE_ORDER])


def month_columns(stamp: Column) -> tuple[Column, Column]:
    """``year`` and ``month`` as texts of fixed width, which name the partitions."""
    year, month = F.year(stamp).cast("string"), F.month(stamp).cast("string")
    return F.lpad(year, 4, "0").alias("year"), F.lpad(month, 2, "0").alias("month")


def silver_products(products: DataFrame) -> DataFrame:
    """Flat catalog with the discounted price and the number of tags."""
    factor = F.lit(1.0) - F.col("discountpercentage") / F.lit(100.0)
    return products.select(
        F.col("id").alias("product_id"),
        "title",
        "category",
        "brand",
        F.col("price").alias("catalog_price"),
        F.col("discountpercentage").alias("discount_percentage"),
        F.round(F.col("price") * factor, 2).alias("discounted_price"),
        "stock",
        F.col("dimensions.width").alias("width"),
        F.col("dimensions.height").alias("height"),
        F.col("dimensions.depth").alias("depth"),
        "sku",
        "rating",
        F.size("tags").cast("bigint").alias("tag_count"),
        "tags",
        "description",
        "weight",
        F.col("warrantyinformation").alias("warranty_information"),
        F.col("shippinginformation").alias("shipping_information"),
        F.col("availabilitystatus").alias("availability_status"),
        F.col("minimumorderquantity").alias("minimum_order_quantity"),
        F.col(INGESTION).alias("source_ingestion_date"),
    )


def silver_users(users: DataFrame) -> DataFrame:
    """Flat customers: home address, company and company address side by side."""
    paths = {
        "customer_id": "id",
        "firstname": "firstname",
        "lastname": "lastname",
        "email": "email",
        "phone": "phone",
        "username": "username",
        "age": "age",
        "gender": "gender",
        "address_street": "address.address",
        "city": "address.city",
        "state": "address.state",
        "state_code": "address.statecode",
        "postal_code": "address.postalcode",
        "country": "address.country",
        "latitude": "address.coordinates.lat",
        "longitude": "address.coordinates.lng",
        "university": "university",
        "company_name": "company.name",
        "company_department": "company.department",
        "company_title": "company.title",
    }
    company = {
        "street": "address",
        "city": "city",
        "state": "state",
        "state_code": "statecode",
        "postal_code": "postalcode",
        "country": "country",
        "lat": "coordinates.lat",
        "lng": "coordinates.lng",
    }
    paths |= {f"company_address_{name}": f"company.address.{p}" for name, p in company.items()}
    paths |= {"role": "role", "source_ingestion_date": INGESTION}
    return users.select(*[F.col(path).alias(name) for name, path in paths.items()])


def silver_totals(orders_clean: DataFrame) -> DataFrame:
    return orders_clean.agg(
        F.count("*").alias("rows"),
        money(exact_sum("line_amount")).alias("revenue"),
        F.min("invoice_date").alias("first_day"),
        F.max("invoice_date").alias("last_day"),
    )


def silver_null_assertions(orders_clean: DataFrame) -> DataFrame:
    """What the rules should have left at zero; product NULLs are only reported."""

    def nulls(name: str) -> Column:
        return F.count_if(F.col(name).isNull())

    return orders_clean.agg(
        nulls("invoice_date").alias("null_date"),
        nulls("unit_price").alias("null_price"),
        F.count_if(F.col("unit_price") <= 0).alias("bad_price"),
        nulls("quantity").alias("null_quantity"),
        nulls("country").alias("unmapped_country"),
        nulls("product_id").alias("null_product"),
    )


def silver_distinct_count(orders_clean: DataFrame, column: str = "country") -> DataFrame:
    return orders_clean.agg(F.count_distinct(column).alias("countries"))


def silver_partition_counts(orders_clean: DataFrame) -> DataFrame:
    counts = orders_clean.groupBy("year", "month").agg(F.count("*").alias("rows"))
    return counts.orderBy("year", "month")


def silver_return_split(orders_clean: DataFrame) -> DataFrame:
    return orders_clean.groupBy("is_return").agg(
        F.count("*").alias("rows"), money(exact_sum("line_amount")).alias("revenue")
    )


def silver_orphans_kept(
    orders_clean: DataFrame,
    products_clean: DataFrame,
    users_clean: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows and revenue with an unresolved key; cleaning must not have dropped them."""
    lines = orders_clean.select("product_id", "customer_id", "line_amount")
    catalogs = {
        "products": (products_clean, "product_id"),
        "users": (users_clean, "customer_id"),
    }
    for name, (catalog, key) in catalogs.items():
        ids = catalog.select(F.col(key).alias("_id"))
        lines = with_matches(
            lines, ids, key, "_id", name, broadcast_rows, key_source=orders_clean
        )
    orphan = (F.col("products") == 0) | F.col("customer_id").isNull() | (F.col("users") == 0)
    repeats = F.greatest("products", F.lit(1)) * F.greatest("users", F.lit(1))
    return lines.agg(
        F.coalesce(F.sum(F.when(orphan, repeats)), F.lit(0)).alias("orphan_rows"),
        money(F.sum(F.when(orphan, F.col("line_amount").cast(CENTS) * repeats))).alias(
            "orphan_revenue"
        ),
    )


def silver_key_uniqueness(products_clean: DataFrame, users_clean: DataFrame) -> DataFrame:
    def counts(name: str, table: DataFrame, key: str) -> DataFrame:
        return table.agg(F.count("*").alias("rows"), F.count_distinct(key).alias("keys")).select(
            F.lit(name).alias("tbl"), "rows", "keys"
        )

    return counts("products_clean", products_clean, "product_id").unionByName(
        counts("users_clean", users_clean, "customer_id")
    )


def silver_bronze_intact(orders: DataFrame) -> DataFrame:
    return orders.agg(F.count("*").alias("bronze_still_intact"))
