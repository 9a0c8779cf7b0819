"""Read schemas, the spelling list and the convention rows."""

from __future__ import annotations

from pyspark.sql import types as T

INGESTION = "ingestion_date"

# Names and types of the delivered files. Orders are text throughout,
# because one value that does not fit a stricter type must not fail the whole read.
# Ids are bigint, which also holds every int id.
ORDERS_COLUMNS = [
    "invoiceno",
    "productid",
    "quantity",
    "invoicedate",
    "unitprice",
    "customerid",
    "country",
]
PRODUCTS_FIELDS = """
    id bigint, title string, description string, category string, price double,
    discountpercentage double, rating double, stock int, tags array<string>, brand string,
    sku string, weight double, dimensions struct<width:double,height:double,depth:double>,
    warrantyinformation string, shippinginformation string, availabilitystatus string,
    minimumorderquantity int
"""
ADDRESS_FIELDS = (
    "struct<address:string,city:string,state:string,statecode:string,postalcode:string,"
    "coordinates:struct<lat:double,lng:double>,country:string>"
)
USERS_FIELDS = f"""
    id bigint, firstname string, lastname string, age int, gender string, email string,
    phone string, username string, address {ADDRESS_FIELDS}, university string,
    company struct<department:string,name:string,title:string,address:{ADDRESS_FIELDS}>,
    role string
"""

# The spellings of each country, in lower case without outer white space.
COUNTRY_SPELLINGS = {
    "switzerland": "Switzerland",
    "suisse": "Switzerland",
    "spain": "Spain",
    "espagne": "Spain",
    "italy": "Italy",
    "italie": "Italy",
    "germany": "Germany",
    "allemagne": "Germany",
    "united states": "United States",
    "usa": "United States",
    "u.s.a": "United States",
    "france": "France",
    "frnace": "France",
    "netherlands": "Netherlands",
    "pays-bas": "Netherlands",
    "united kingdom": "United Kingdom",
    "uk": "United Kingdom",
    "u.k.": "United Kingdom",
    "portugal": "Portugal",
    "belgium": "Belgium",
    "belgique": "Belgium",
}

# Keys and texts of the rows that stand for an unresolved key.
UNKNOWN_PRODUCT = -1
ORPHAN_CUSTOMER = -1
UNRECORDED_CUSTOMER = -2
PRODUCT_CONVENTIONS = [
    {"product_id": UNKNOWN_PRODUCT, "title": "Unknown product", "category": "Unknown"},
]
CUSTOMER_CONVENTIONS = [
    {
        "customer_id": ORPHAN_CUSTOMER,
        "firstname": "Unknown",
        "lastname": "customer",
        "customer_type": "Orphan",
    },
    {
        "customer_id": UNRECORDED_CUSTOMER,
        "firstname": "Not",
        "lastname": "recorded",
        "customer_type": "Not recorded",
    },
]


def orders_schema() -> T.StructType:
    names = [*ORDERS_COLUMNS, INGESTION]
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def products_schema() -> T.StructType:
    return T.StructType.fromDDL(PRODUCTS_FIELDS)


def users_schema() -> T.StructType:
    return T.StructType.fromDDL(USERS_FIELDS)
