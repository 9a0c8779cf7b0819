"""The layered build: raw, clean and star-schema tables, each written once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.operators import gold, silver
from orelode.operators.lookup import BROADCAST_ROWS
from orelode.operators.tuples import distinct_tuples
from orelode.schemas import INGESTION
from orelode.sources.landing import latest_snapshot
from orelode.sources import versions
from orelode.sources.sinks import rebuild_zone, remove_folder

MONTHS = ("year", "month")


@dataclass
class SalesLake:
    """Tables of one delivery under one root folder.

    A table is built when it is first asked for, after the tables it derives from, and
    read from its files from then on: many profiles and questions share one build, plans
    stay short, and a lost executor costs no more than re-reading files.

    ``latest_only`` keeps the newest catalog row per key. Without it every snapshot of a
    catalog goes into its dimension, and the key and fan-out checks report the repeats.
    """

    spark: SparkSession
    root: str
    orders: DataFrame
    products: DataFrame
    users: DataFrame
    spellings: DataFrame
    date_formats: Sequence[str] = ()
    latest_only: bool = True
    broadcast_rows: int = BROADCAST_ROWS
    _tables: dict[str, DataFrame] = field(default_factory=dict)
    _commits: dict[str, versions.Commit] = field(default_factory=dict)

    def saved(
        self,
        zone: str,
        name: str,
        build: Callable[[], DataFrame],
        by: Sequence[str] = (),
        clustered: bool = False,
        ordered: bool = True,
    ) -> DataFrame:
        """The table of this name, written when it is first asked for."""
        if name not in self._tables:
            path = f"{self.root}/{zone}/{name}"
            self._tables[name] = rebuild_zone(build(), path, by, clustered, ordered)
            self._commits[name] = versions.last_commit(self.spark, path)
        return self._tables[name]

    def size(self, name: str) -> tuple[int | None, int | None]:
        """Rows and text bytes of a table that has been built, as observed while it was written:
        what others need to know of it costs no job."""
        commit = self._commits[name]
        return commit.rows, commit.wide_bytes

    def recorded_rows(self) -> DataFrame:
        """Rows of every table as recorded by its commit, next to a count of what is read."""
        for build in (self.orders_clean, self.products_clean, self.users_clean, self.fact_sales, self.dim_date):
            build()
        parts = [
            rows.agg(F.count("*").alias("rows")).select(
                F.lit(name).alias("table"), F.lit(self.size(name)[0]).cast("long").alias("recorded"), "rows"
            )
            for name, rows in self._tables.items()
        ]
        found = reduce(DataFrame.unionByName, parts)
        return found.withColumn("passed", F.col("recorded") == F.col("rows"))

    def _catalog(self, rows: DataFrame) -> DataFrame:
        return latest_snapshot(rows, "id") if self.latest_only else rows

    def orders_raw(self) -> DataFrame:
        # A delivery has few dates, so its tasks can write them as they come.
        return self.saved(
            "bronze", "orders_raw", lambda: self.orders, (INGESTION,), clustered=True, ordered=False
        )

    def orders_tuples(self) -> DataFrame:
        """Distinct order lines with their copies; all that is asked of duplicates, and the clean
        orders, are read from here without a shuffle."""
        return self.saved("bronze", "orders_tuples", lambda: distinct_tuples(self.orders_raw()))

    def products_raw(self) -> DataFrame:
        return self.saved("bronze", "products_raw", lambda: self.products)

    def users_raw(self) -> DataFrame:
        return self.saved("bronze", "users_raw", lambda: self.users)

    def spelling_list(self) -> DataFrame:
        return self.saved("silver", "spellings", lambda: self.spellings)

    def orders_clean(self) -> DataFrame:
        """Written in the order of the sale numbers, as far as their dates are texts of the main form."""
        return self.saved(
            "silver",
            "orders_clean",
            lambda: silver.silver_orders(
                self.orders_tuples(),
                self.spelling_list(),
                self.date_formats,
                self.size("spellings"),
                by_month=True,
                in_order=not self.date_formats,
            ),
            MONTHS,
            clustered=True,
        )

    def products_clean(self) -> DataFrame:
        return self.saved(
            "silver",
            "products_clean",
            lambda: silver.silver_products(self._catalog(self.products_raw())),
        )

    def users_clean(self) -> DataFrame:
        return self.saved(
            "silver",
            "users_clean",
            lambda: silver.silver_users(self._catalog(self.users_raw())),
        )

    def dim_date(self) -> DataFrame:
        return self.saved("gold", "dim_date", lambda: gold.dim_date(self.orders_clean()))

    def dim_product(self) -> DataFrame:
        return self.saved("gold", "dim_product", lambda: gold.dim_product(self.products_clean()))

    def dim_customer(self) -> DataFrame:
        return self.saved("gold", "dim_customer", lambda: gold.dim_customer(self.users_clean()))

    def fact_sales(self) -> DataFrame:
        built = "fact_sales" in self._tables
        fact = self.saved(
            "gold",
            "fact_sales",
            lambda: gold.fact_sales(
                self.orders_clean(),
                self.dim_product(),
                self.dim_customer(),
                self.scratch("fact_numbering"),
                self.broadcast_rows,
                self.size("dim_product")[0],
                self.size("dim_customer")[0],
                in_order=not self.date_formats,
            ),
            MONTHS,
            clustered=True,
            ordered=False,
        )
        if not built:
            remove_folder(self.spark, self.scratch("fact_numbering"))
        return fact

    def scratch(self, name: str) -> str:
        """Folder for an operator that has to fix intermediate rows in files."""
        return f"{self.root}/staging/{name}"
