"""Scans of the landed files, as received."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orelode import schemas
from orelode.functions.parsing import WHITE_SPACE

# Keys a producer may also write with inner capitals.
CAMEL_KEYS = {
    "discountpercentage": "discountPercentage",
    "warrantyinformation": "warrantyInformation",
    "shippinginformation": "shippingInformation",
    "availabilitystatus": "availabilityStatus",
    "minimumorderquantity": "minimumOrderQuantity",
    "firstname": "firstName",
    "lastname": "lastName",
    "statecode": "stateCode",
    "postalcode": "postalCode",
}


def scan_orders_csv(spark: SparkSession, path: str) -> DataFrame:
    """Quoted CSV with a header in every file; all columns text, blanks kept as ''.

    Lines are records (no quoted line breaks), so big files split between tasks. The
    reader turns blank fields into NULL; they are put back to '' because the profiles
    count blanks. A short row's missing fields become '' too, surplus fields are dropped.
    """
    rows = (
        spark.read.schema(schemas.orders_schema())
        .option("header", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return rows.fillna("", subset=schemas.ORDERS_COLUMNS)


def scan_products_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON product per line, with nested dimensions and a list of tags."""
    return _scan_json(spark, path, schemas.products_schema())


def scan_users_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON customer per line, with nested address and company."""
    return _scan_json(spark, path, schemas.users_schema())


def _scan_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Lines parsed against ``schema``; keys match in lower case or in camel case.

    A missing key and a value of the wrong type give NULL, an unreadable line gives a row
    of NULLs, a blank line gives no row.
    """
    both = _with_camel_keys(schema)
    lines = spark.read.schema(f"value string, {schemas.INGESTION} string").text(path)
    lines = lines.filter(~_blank())
    # The cast is by position: it gives the two spellings of a key distinct names.
    parsed = F.from_json("value", both).cast(_distinct_names(both))
    return lines.select(parsed.alias("row"), schemas.INGESTION).select(
        *[_merged(F.col("row"), field).alias(field.name) for field in schema],
        schemas.INGESTION,
    )


def unreadable_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of landed JSON files that are no JSON object, with file, place and text.

    ``_scan_json`` turns such a line into a row of NULLs, which keeps the count of rows; here it
    can be seen and sent back. ``offset`` is the byte in its file at which a line begins, given
    lines that end in a line feed. Whether a line is readable is asked of the parser alone, so a
    value of the wrong type, which only makes its own field NULL, is no reason.
    """
    lines = numbered_lines(spark, path)
    return lines.filter(~_readable()).select("file", "offset", schemas.INGESTION, F.col("value").alias("text"))


def line_balance(spark: SparkSession, path: str) -> DataFrame:
    """Lines of each file by what became of them: blank, unreadable and readable ones add up."""
    lines = spark.read.schema(f"value string, {schemas.INGESTION} string").text(path)
    blank = _blank()
    counted = lines.groupBy(schemas.INGESTION, F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")).agg(
        F.count("*").alias("lines"),
        F.count_if(blank).alias("blank"),
        F.count_if(~blank & ~_readable()).alias("unreadable"),
        F.count_if(~blank & _readable()).alias("readable"),
    )
    balanced = F.col("blank") + F.col("unreadable") + F.col("readable") == F.col("lines")
    return counted.withColumn("passed", balanced)


def _blank() -> Column:
    """Whether a line holds white space alone; the first other sign settles it, however long the line."""
    return ~F.col("value").rlike(f"[^{WHITE_SPACE}]")


def _readable() -> Column:
    """Whether a line is a JSON object: the parser keeps what it cannot read as it is."""
    broken = F.from_json("value", "_broken string", {"columnNameOfCorruptRecord": "_broken", "mode": "PERMISSIVE"})
    return F.col("value").rlike(r"^\s*\{") & broken["_broken"].isNull()


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines but blank ones with their file and the byte at which each begins there.

    Files are cut into blocks of lines that one task reads; the bytes of the blocks before are added
    to the place inside a block, so a file may be of any size.
    """
    lines = spark.read.schema(f"value string, {schemas.INGESTION} string").text(path)
    start, length = F.col("_metadata.file_block_start"), F.octet_length("value") + 1
    placed = lines.select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_path").alias("_path"),
        start.alias("_start"), schemas.INGESTION, "value", length.alias("_length"),
        F.monotonically_increasing_id().alias("_place"),
    )
    before = Window.partitionBy("_path", "_start").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    within = placed.withColumn("_within", F.coalesce(F.sum("_length").over(before), F.lit(0)))
    blocks = placed.groupBy("_path", "_start").agg(F.sum("_length").alias("_bytes"))
    earlier = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("_path").alias("_p"), F.col("_start").alias("_s"),
        F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_before"),
    )
    found = within.join(blocks, (F.col("_path") == F.col("_p")) & (F.col("_start") == F.col("_s")))
    found = found.filter(~_blank())
    return found.select("file", (F.col("_before") + F.col("_within")).alias("offset"), schemas.INGESTION, "value")


def _with_camel_keys(schema: T.StructType) -> T.StructType:
    fields = []
    for field in schema:
        kind = field.dataType
        if isinstance(kind, T.StructType):
            kind = _with_camel_keys(kind)
        fields.append(T.StructField(field.name, kind))
        if field.name in CAMEL_KEYS:
            fields.append(T.StructField(CAMEL_KEYS[field.name], kind))
    return T.StructType(fields)


def _distinct_names(schema: T.StructType) -> T.StructType:
    fields = []
    for field in schema:
        kind = field.dataType
        if isinstance(kind, T.StructType):
            kind = _distinct_names(kind)
        name = field.name if field.name.islower() else f"{field.name.lower()}_camel"
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


def _merged(parent: Column, field: T.StructField) -> Column:
    value = parent[field.name]
    if isinstance(field.dataType, T.StructType):
        inner = F.struct(*[_merged(value, f).alias(f.name) for f in field.dataType])
        return F.when(value.isNotNull(), inner)
    if field.name in CAMEL_KEYS:
        return F.coalesce(value, parent[f"{field.name}_camel"])
    return value
