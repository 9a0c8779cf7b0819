"""Raw deliveries derived from order-processing tables, with defects at fixed places.

The tables are clean. Blank, unreadable, unknown and repeated values are put in by
arithmetic on the keys, so that the same input can be stated in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.operators.lookup import lookup
from orelode.schemas import INGESTION

TABLES = ["lineitem", "orders", "part", "customer", "nation"]
FIRST_DATE = "2026-01-01"
SECOND_DATE = "2026-01-02"
# Added to a key to make one that is in no catalog at any size of the tables.
UNKNOWN_KEY_OFFSET = 9_000_000_000


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def redelivered(rows: DataFrame, condition: str, **changed: str) -> DataFrame:
    """All rows on the first date, and those that meet the condition on a second one too."""
    dates = F.when(
        F.expr(condition), F.array(F.lit(FIRST_DATE), F.lit(SECOND_DATE))
    ).otherwise(F.array(F.lit(FIRST_DATE)))
    rows = rows.withColumn(INGESTION, F.explode(dates))
    second = F.col(INGESTION) == SECOND_DATE
    return rows.withColumns(
        {name: F.when(second, F.expr(e)).otherwise(F.col(name)) for name, e in changed.items()}
    )


def orders_delivery(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as text; one product in forty is delivered again a day later.

    Prices and countries are looked up before the lines meet their orders: a product or a
    customer may hold a large share of the rows, an order is only as long as its lines.
    """
    customer = read(spark, folder, "customer")
    nations = read(spark, folder, "nation").select("n_nationkey", "n_name")
    countries = lookup(customer, nations, "c_nationkey", "n_nationkey").select(
        "c_custkey", "n_name"
    )
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey")
    orders = lookup(orders, countries, "o_custkey", "c_custkey", customer.count())
    lines = read(spark, folder, "lineitem")
    # what the lines carry through the joins is as narrow as the texts made of it allow
    lines = lines.selectExpr(
        "l_orderkey",
        "l_partkey",
        "l_quantity",
        "l_shipdate",
        "(l_orderkey + l_linenumber) % 67 = 0 AS blank",
        "l_returnflag = 'R' AS returned",
    )
    prices = read(spark, folder, "part").select("p_partkey", "p_retailprice")
    lines = lookup(lines, prices, "l_partkey", "p_partkey").filter("p_retailprice IS NOT NULL")
    lines = lines.join(orders.filter("n_name IS NOT NULL"), F.expr("l_orderkey = o_orderkey"))
    rows = lines.selectExpr(
        "concat(if(returned, 'C', ''), l_orderkey % 5000) AS invoiceno",
        f"""cast(if(l_partkey % 53 = 0, l_partkey + {UNKNOWN_KEY_OFFSET}, l_partkey) AS string)
            AS productid""",
        "if(blank, '', cast(cast(l_quantity AS int) AS string)) AS quantity",
        """CASE WHEN l_orderkey % 101 = 0 THEN ''
                WHEN l_orderkey % 103 = 0 THEN '31/02/2026'
                ELSE cast(l_shipdate AS string) END AS invoicedate""",
        """CASE WHEN l_partkey % 71 = 0 THEN '0'
                WHEN l_partkey % 73 = 0 THEN '-5.5'
                WHEN l_partkey % 79 = 0 THEN 'n/a'
                ELSE cast(p_retailprice AS string) END AS unitprice""",
        f"""CASE WHEN o_custkey % 61 = 0 THEN ''
                WHEN o_custkey % 59 = 0 THEN cast(o_custkey + {UNKNOWN_KEY_OFFSET} AS string)
                ELSE cast(o_custkey AS string) END AS customerid""",
        """CASE o_custkey % 5 WHEN 0 THEN concat(' ', upper(n_name), ' ')
                WHEN 1 THEN lower(n_name) ELSE n_name END AS country""",
    )
    return redelivered(rows, "cast(productid AS bigint) % 40 = 0")


def products_delivery(spark: SparkSession, folder: str) -> DataFrame:
    """The catalog, nested; one product in fifty comes again with a higher price."""
    rows = read(spark, folder, "part").selectExpr(
        "p_partkey AS id",
        "p_name AS title",
        "concat(p_name, ' by ', p_brand) AS description",
        "p_type AS category",
        "p_retailprice AS price",
        "cast(p_partkey % 4 * 10 AS double) AS discountpercentage",
        "cast(p_partkey % 50 AS double) / 10 AS rating",
        "p_size AS stock",
        "if(p_partkey % 3 = 0, array(p_type), array(p_type, p_brand)) AS tags",
        "if(p_partkey % 21 = 0, NULL, p_brand) AS brand",
        "concat('SKU-', p_partkey) AS sku",
        "cast(p_size AS double) / 2 AS weight",
        """named_struct('width', p_size + 0.5D, 'height', p_size + 1.25D,
                        'depth', cast(p_size AS double) / 4) AS dimensions""",
        "concat(p_size % 4, ' year warranty') AS warrantyinformation",
        "concat('Ships in ', p_size % 5 + 1, ' days') AS shippinginformation",
        "if(p_size % 10 = 0, 'Out of Stock', 'In Stock') AS availabilitystatus",
        "cast(p_size % 7 + 1 AS int) AS minimumorderquantity",
    )
    return redelivered(rows, "id % 50 = 0", price="price + 1")


def users_delivery(spark: SparkSession, folder: str) -> DataFrame:
    """The customers, nested; one in fifty comes again a year older."""
    nations = read(spark, folder, "nation").select("n_nationkey", "n_name")
    people = lookup(read(spark, folder, "customer"), nations, "c_nationkey", "n_nationkey")
    people = people.filter("n_name IS NOT NULL")
    address = """named_struct(
        'address', concat(c_custkey % 900, ' {street}'), 'city', concat('City ', c_custkey % {cities}),
        'state', c_mktsegment, 'statecode', substr(c_mktsegment, 1, 2),
        'postalcode', lpad(cast(c_custkey % 100000 AS string), 5, '0'),
        'coordinates', named_struct('lat', cast(c_custkey % 180 - 90 AS double) + 0.5D,
                                    'lng', cast(c_custkey % 360 - 180 AS double) + 0.25D),
        'country', n_name)"""
    rows = people.selectExpr(
        "c_custkey AS id",
        "substring_index(c_name, '#', 1) AS firstname",
        "substring_index(c_name, '#', -1) AS lastname",
        "cast(18 + c_custkey % 60 AS int) AS age",
        "if(c_custkey % 2 = 0, 'female', 'male') AS gender",
        "concat('user', c_custkey, '@example.com') AS email",
        "concat('+00 ', c_custkey) AS phone",
        "concat('u', c_custkey) AS username",
        address.format(street="Main Street", cities=100) + " AS address",
        "concat('University ', c_custkey % 30) AS university",
        f"""named_struct('department', c_mktsegment, 'name', concat('Company ', c_custkey % 50),
            'title', concat('Title ', c_custkey % 7),
            'address', {address.format(street="Office Road", cities=20)}) AS company""",
        "'user' AS role",
    )
    return redelivered(rows, "id % 50 = 0", age="age + 1")


def delivered_spellings(spark: SparkSession, folder: str, leave_out: str | None = None) -> DataFrame:
    """Spelling list for the delivery's countries: lower case form and standard name."""
    names = read(spark, folder, "nation").selectExpr(
        "lower(n_name) AS spelling", "n_name AS standard"
    )
    return names.filter(F.col("standard") != leave_out) if leave_out else names


def expected_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows each source should have per ingestion date, counted on the tables themselves."""
    lineitem = read(spark, folder, "lineitem")
    again = f"if(l_partkey % 53 = 0, l_partkey + {UNKNOWN_KEY_OFFSET}, l_partkey) % 40 = 0"
    sources = {
        "orders_raw": (lineitem, again),
        "products_raw": (read(spark, folder, "part"), "p_partkey % 50 = 0"),
        "users_raw": (read(spark, folder, "customer"), "c_custkey % 50 = 0"),
    }
    parts = [
        rows.agg(
            F.count("*").alias(FIRST_DATE), F.count_if(F.expr(condition)).alias(SECOND_DATE)
        )
        .unpivot([], [FIRST_DATE, SECOND_DATE], INGESTION, "expected")
        .withColumn("source", F.lit(name))
        for name, (rows, condition) in sources.items()
    ]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
