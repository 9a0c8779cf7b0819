"""Append-only landing of deliveries and their registration in the catalog."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from orelode.schemas import INGESTION

# Lines of a packed file.
LANDED_LINES = 200_000


def land_snapshot(
    delivery: DataFrame, path: str, ingestion_date: str | None = None, file_format: str = "csv"
) -> str:
    """Write a delivery under ``ingestion_date=<UTC date>`` and return the root path.

    Another date adds a partition; the same date again replaces its own, also by nothing when
    the delivery is empty. Text lines are packed, at the speed that costs least, in files of LANDED_LINES
    lines at most, as a packed file is read by one task.
    """
    date = ingestion_date or datetime.now(timezone.utc).strftime("%Y-%m-%d")
    writer = delivery.drop(INGESTION).write.mode("overwrite")
    if file_format == "csv":
        # The CSV writer trims by default, which would repair the spellings in passing.
        writer = (
            writer.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    if file_format in ("csv", "json"):
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", LANDED_LINES)
        writer = writer.option("zlib.compress.level", "BEST_SPEED")
    writer.format(file_format).save(f"{path}/{INGESTION}={date}")
    return path


def discover_partitions(
    spark: SparkSession, table: str, path: str, columns: str, file_format: str = "parquet"
) -> DataFrame:
    """Register the folder as a partitioned catalog table and pick up new partitions.

    Reads by path need no registration; this is for users who query by table name. A table of
    this name that lies in another folder is an error.
    """
    name = ".".join(quoted(part) for part in table.split("."))
    fields = StructType.fromDDL(columns).fields
    kinds = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({kinds}, {quoted(INGESTION)} STRING) "
        f"USING {file_format} PARTITIONED BY ({quoted(INGESTION)}) LOCATION '{place}'"
    )
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()[1]
    if location(found) != location(path):
        raise ValueError(f"{table} lies in {found}, not in {path}")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def location(path: str) -> str:
    """A folder as it compares: a path without a scheme is a local one."""
    scheme, _, rest = path.rpartition(":")
    return f"{scheme or 'file'}:/{rest.strip('/')}"


def latest_snapshot(rows: DataFrame, key: str, version: str = INGESTION) -> DataFrame:
    """One row per key: the one of its latest version. Rows without a key all stay.

    The first-row filter on the window runs on the map side too, so a key with very many
    versions sends one row per task. All columns break ties, which makes the choice fixed.
    """
    # NULLs last on both, like the version order itself.
    others = [name for name in rows.columns if name not in (key, version)]
    order = [F.col(version).desc_nulls_last(), *[F.col(n).desc_nulls_last() for n in others]]
    newest = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    known = rows.filter(F.col(key).isNotNull()).withColumn("_newest", newest)
    known = known.filter("_newest = 1").drop("_newest")
    return known.unionByName(rows.filter(F.col(key).isNull()))
