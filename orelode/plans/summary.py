"""All questions from a summary of the fact: two grains, reduced in one scan, and its lines in few columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.functions.measures import CENTS, FINE, exact_sum, money
from orelode.operators.invariants import no_customer, no_product
from orelode.operators.lookup import BROADCAST_ROWS, matcher, with_matches
from orelode.plans import analytics
from orelode.sources.sinks import staged, write_plain

#: Grains of the summary: the part of an order that goes to a country, and products.
ORDER_KEYS = ["invoiceno", "date_id", "country"]
PRODUCT_KEYS = ["product_id"]


@dataclass
class SalesSummary:
    """What all questions need of the fact.

    ``orders`` has a row for each invoice number, day and country, ``products`` one for each product;
    one job writes both from one scan. Their sums are exact, so that any coarser total is the one of the
    fact. ``lines`` are all lines in the columns that neither grain holds, written as they lie: questions
    by customer, day and population are added up from there, without a shuffle of what they share.
    """

    orders: DataFrame
    products: DataFrame
    lines: DataFrame


def product_matcher(fact: DataFrame, dim_product: DataFrame, broadcast_rows: int) -> Callable[..., DataFrame]:
    """Adds to lines of the fact the number of rows of the product dimension that each meets."""
    natural = dim_product.filter(~no_product()).select(F.col("product_id").alias("_known"))
    return matcher(fact, natural, "product_id", "_known", "found", broadcast_rows)


def summary_plan(
    fact: DataFrame,
    dim_product: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    matched: Callable[..., DataFrame] | None = None,
) -> DataFrame:
    """Both grains in one frame, ``grain`` 0 for orders and 1 for products.

    Grouping sets give every line to both grains behind one scan and one shuffle, on whose map side
    lines are added up. A task holds a row there for nearly each of its lines and grains, so sums are as
    few as the questions need.
    """
    lines = fact.select(
        *ORDER_KEYS, *PRODUCT_KEYS, "quantity", "unit_price", F.col("line_amount").cast(CENTS).alias("line_amount")
    )
    matched = matched or product_matcher(fact, dim_product, broadcast_rows)
    return matched(lines, fact).groupingSets([ORDER_KEYS, PRODUCT_KEYS], *ORDER_KEYS, *PRODUCT_KEYS).agg(
        F.grouping("invoiceno").cast("int").alias("grain"),
        F.count("*").alias("lines"),
        F.sum("line_amount").alias("amount"),
        F.sum("quantity").alias("items"),
        exact_sum("unit_price", FINE).alias("prices"),
        F.count("unit_price").alias("priced"),
        F.max("found").alias("found"),
    )


def narrow_lines(
    fact: DataFrame,
    dim_product: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    matched: Callable[..., DataFrame] | None = None,
) -> DataFrame:
    """Every line of the fact, with whether its product is missing and how often it is in the dimension."""
    lines = fact.select(*ORDER_KEYS, *PRODUCT_KEYS, "customer_id", "is_return", "quantity", "line_amount")
    missing = F.coalesce(no_product(), F.lit(False)).alias("missing")
    matched = matched or product_matcher(fact, dim_product, broadcast_rows)
    return matched(lines, fact).select(
        *ORDER_KEYS, "customer_id", "is_return", missing, "found", F.col("quantity").alias("items"), "line_amount"
    )


def sales_summary(
    fact: DataFrame, dim_product: DataFrame, path: str, broadcast_rows: int = BROADCAST_ROWS
) -> SalesSummary:
    """The summary, written to ``path``; each grain is a partition that readers of the other skip. The
    products of the fact meet the dimension once for all that is written."""
    matched = product_matcher(fact, dim_product, broadcast_rows)
    plan = summary_plan(fact, dim_product, broadcast_rows, matched)
    cells = write_plain(plan, f"{path}/cells", ["grain"], clustered=True)
    lines = write_plain(narrow_lines(fact, dim_product, broadcast_rows, matched), f"{path}/lines")
    orders = cells.filter("grain = 0").select(*ORDER_KEYS, "lines", "amount", "items")
    products = cells.filter("grain = 1").select(
        *PRODUCT_KEYS, F.col("amount").alias("revenue"), F.col("items").alias("quantity"), "prices", "priced", "found"
    )
    amount = F.col("line_amount").cast(CENTS).alias("amount")
    return SalesSummary(orders, products, lines.select("*", amount).drop("line_amount"))


def answers(
    summary: SalesSummary, dim_date: DataFrame, dim_product: DataFrame, dim_customer: DataFrame
) -> dict[str, DataFrame]:
    """The twelve results, equal to those that ``analytics`` takes from the fact.

    Orders are added up by invoice number and month once, for all that is asked by month; so are
    lines by day and by customer, for all that is asked of those.
    """
    lines = summary.lines
    orders = summary.orders.groupBy("invoiceno", "date_id")
    orders = orders.agg(F.sum("lines").alias("lines"), F.sum("amount").alias("amount"))
    invoices = staged(analytics.invoice_months(orders, dim_date), "invoices")
    days, customers = staged(by_day(lines), "days"), staged(by_customer(lines), "customers")
    measures = analytics.mean_prices(summary.products.filter(~no_product() & (F.col("found") > 0)))
    return {
        "q1_total": total(recent(days, dim_date), recent(summary.orders, dim_date)),
        "q1_by_country": analytics.country_shares(
            recent(days, dim_date)
            .groupBy("country")
            .agg(F.sum("lines").alias("lines"), F.sum("amount").alias("revenue"))
        ),
        "q2_top_revenue": analytics.top_revenue(measures, dim_product),
        "q2_top_quantity": analytics.top_quantity(measures, dim_product),
        "q2_rank_comparison": analytics.rank_comparison(measures, dim_product),
        "q3_monthly": analytics.monthly_of_invoices(invoices),
        "q3_additivity_check": analytics.additivity_of_invoices(invoices),
        "q4_basket_by_country": analytics.baskets_of(summary.orders),
        "q5_top_customers": top_customers(lines, customers, dim_customer),
        "q6_orphan_population": populations(days),
        "q6_orphan_impact": impact(customers, dim_customer),
        "q6_orphan_trend": analytics.trend_of(daily(days), dim_date),
    }


def by_day(lines: DataFrame) -> DataFrame:
    """Lines added up by day, country, kind and what is missing. Lines of a day lie together, and these
    keys have few values, so that few rows travel."""
    population = analytics.population_of(F.col("missing")).alias("population")
    return lines.groupBy("date_id", "country", "is_return", population).agg(
        F.count("*").alias("lines"),
        F.sum("amount").alias("amount"),
        F.sum("items").alias("items"),
        F.count_if(F.col("missing") | no_customer()).alias("orphans"),
    )


def by_customer(lines: DataFrame) -> DataFrame:
    """Lines added up by customer; ``found`` and ``found_amount`` count a line as often as its product is
    in the dimension."""
    return lines.groupBy("customer_id").agg(
        F.count("*").alias("lines"),
        F.sum("amount").alias("amount"),
        F.sum("found").alias("found"),
        F.sum(F.col("amount") * F.col("found")).alias("found_amount"),
    )


def recent(cells: DataFrame, dim_date: DataFrame, months: int = 3) -> DataFrame:
    start = analytics.months_start(cells, dim_date, months)
    days = dim_date.filter(F.col("full_date") > start.scalar()).select("date_id")
    return cells.join(days, "date_id")


def total(days: DataFrame, orders: DataFrame) -> DataFrame:
    returned, amount = F.col("is_return"), F.col("amount")
    sums = days.agg(
        money(F.sum(amount)).alias("net_revenue"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"),
        money(F.sum(F.when(~returned, amount).otherwise(F.lit(0).cast(CENTS)))).alias("gross_revenue"),
        money(F.sum(F.when(returned, amount).otherwise(F.lit(0).cast(CENTS)))).alias("returns_impact"),
    )
    counted = orders.agg(F.count_distinct("invoiceno", "date_id").alias("orders"))
    both = sums.crossJoin(F.broadcast(counted))
    return both.select("net_revenue", "lines", "orders", "gross_revenue", "returns_impact")


def top_customers(lines: DataFrame, customers: DataFrame, dim_customer: DataFrame, top: int = 5) -> DataFrame:
    """Customers are ranked by revenue alone; only the orders of the best are told apart."""
    revenue = customers.filter(F.col("customer_id") > 0).select("customer_id", F.col("amount").alias("revenue"))
    revenue = revenue.join(dim_customer.select("customer_id"), "customer_id", "left_semi")
    best = revenue.orderBy(F.desc("revenue"), F.asc("customer_id")).limit(top).select("customer_id")
    theirs = lines.join(F.broadcast(best), "customer_id").groupBy("customer_id", "invoiceno", "date_id")
    theirs = theirs.agg(F.sum("amount").alias("amount"), F.count("*").alias("lines"))
    return analytics.top_customers(theirs, dim_customer, top)


def populations(days: DataFrame) -> DataFrame:
    found = days.groupBy("population").agg(
        F.sum("lines").alias("lines"), F.sum("items").alias("quantity"), F.sum("amount").alias("revenue")
    )
    return analytics.population_shares(found)


def daily(days: DataFrame) -> DataFrame:
    return days.groupBy("date_id").agg(F.sum("lines").alias("lines"), F.sum("orphans").alias("orphans"))


def impact(customers: DataFrame, dim_customer: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Lines and revenue that inner joins lose."""
    known = dim_customer.filter(F.col("customer_id") > 0).select(F.col("customer_id").alias("_known"))
    found = with_matches(customers, known, "customer_id", "_known", "_customers", broadcast_rows)
    kept = F.coalesce(F.sum(F.col("found") * F.col("_customers")), F.lit(0))
    kept_amount = F.coalesce(F.sum(F.col("found_amount") * F.col("_customers")), F.lit(0))
    return found.agg(
        (F.coalesce(F.sum("lines"), F.lit(0)) - kept).alias("lines_lost"),
        money(F.sum("amount") - kept_amount).alias("revenue_lost"),
    )
