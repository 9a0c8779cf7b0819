"""The business questions. Facts are reduced by key before they meet a dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orelode import schemas
from orelode.functions.measures import FINE, exact_sum, money, percent, ratio
from orelode.operators.invariants import demo_inner_join_cost, no_customer, no_product
from orelode.operators.lookup import BROADCAST_ROWS
from orelode.operators.median import ACCURACY, lower_median
from orelode.operators.ranking import in_any_top
from orelode.sources.sinks import staged

TOP = 10

# Labels of the results.
BOTH_TOP = "In both top 10"
REVENUE_TOP = "Revenue top 10 only"
QUANTITY_TOP = "Quantity top 10 only"
NO_KEYS = "Product and customer missing"
NO_PRODUCT = "Product not in catalog"
DELETED_CUSTOMER = "Customer deleted from catalog"
NO_CUSTOMER = "Customer not recorded"
COMPLETE_KEYS = "Complete keys"


def last_day(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The last calendar day that has a fact, as one row."""
    days = fact.select("date_id").distinct().join(dim_date.select("date_id", "full_date"), "date_id")
    return days.agg(F.max("full_date").alias("last_day"))


def months_start(fact: DataFrame, dim_date: DataFrame, months: int) -> DataFrame:
    """The last day moved back by ``months``, as one row."""
    return last_day(fact, dim_date).select(F.add_months("last_day", -months).alias("start"))


def _last_months(fact: DataFrame, dim_date: DataFrame, months: int) -> DataFrame:
    """Facts strictly after the last day moved back by ``months``.

    The bound is a scalar subquery, known before the scan starts: on the partition
    columns it skips whole months, on the calendar it selects the days.
    """
    start = months_start(fact, dim_date, months)
    first_month = start.select(F.date_format("start", "yyyyMM")).scalar()
    days = dim_date.filter(F.col("full_date") > start.scalar()).select("date_id")
    recent = fact.filter(F.concat("year", "month") >= first_month)
    return recent.join(days, "date_id")


def q1_total(fact: DataFrame, dim_date: DataFrame, months: int = 3) -> DataFrame:
    """Net and gross revenue, lines and orders of the last months."""
    returned = F.col("is_return")
    amount = F.col("line_amount")
    return _last_months(fact, dim_date, months).agg(
        money(exact_sum(amount)).alias("net_revenue"),
        F.count("*").alias("lines"),
        F.count_distinct("invoiceno", "date_id").alias("orders"),
        money(exact_sum(F.when(~returned, amount).otherwise(0.0))).alias("gross_revenue"),
        money(exact_sum(F.when(returned, amount).otherwise(0.0))).alias("returns_impact"),
    )


def q1_by_country(fact: DataFrame, dim_date: DataFrame, months: int = 3) -> DataFrame:
    """The same months by shipping country, with each country's share."""
    countries = (
        _last_months(fact, dim_date, months)
        .groupBy("country")
        .agg(F.count("*").alias("lines"), exact_sum("line_amount").alias("revenue"))
    )
    return country_shares(countries)


def country_shares(countries: DataFrame) -> DataFrame:
    """Lines and exact revenue by country, with each country's share of the whole."""
    everything = F.sum("revenue").over(Window.partitionBy())
    shares = countries.withColumn("revenue_share_pct", percent(F.col("revenue"), everything))
    ordered = shares.orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("country"))
    return ordered.withColumn("revenue", money("revenue"))


def product_measures(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Exact revenue, quantity and mean line price per real product, without its names."""
    sums = (
        fact.filter(~no_product())
        .groupBy("product_id")
        .agg(
            exact_sum("line_amount").alias("revenue"),
            F.sum("quantity").alias("quantity"),
            exact_sum("unit_price", FINE).alias("prices"),
            F.count("unit_price").alias("priced"),
        )
    )
    return mean_prices(sums).join(dim_product.select("product_id"), "product_id", "left_semi")


def mean_prices(sums: DataFrame) -> DataFrame:
    """Sums by product with the mean of its line prices."""
    mean = ratio(F.round("prices", 6), F.col("priced")).alias("avg_unit_price")
    return sums.select("product_id", "revenue", "quantity", mean)


def named(products: DataFrame, dim_product: DataFrame) -> DataFrame:
    """A few products with their title and category: only theirs meet the wide columns."""
    return F.broadcast(products).join(
        dim_product.select("product_id", "title", "category"), "product_id"
    )


def q2_top_revenue(fact: DataFrame, dim_product: DataFrame, top: int = TOP) -> DataFrame:
    return top_revenue(product_measures(fact, dim_product), dim_product, top)


def top_revenue(measures: DataFrame, dim_product: DataFrame, top: int = TOP) -> DataFrame:
    columns = ["product_id", "title", "category", "revenue", "quantity", "avg_unit_price"]
    order = [F.desc("revenue"), F.asc("product_id")]
    products = measures.orderBy(*order).limit(top)
    ordered = named(products, dim_product).orderBy(*order).limit(top)
    return ordered.select(*columns).withColumn("revenue", money("revenue"))


def q2_top_quantity(fact: DataFrame, dim_product: DataFrame, top: int = TOP) -> DataFrame:
    return top_quantity(product_measures(fact, dim_product), dim_product, top)


def top_quantity(measures: DataFrame, dim_product: DataFrame, top: int = TOP) -> DataFrame:
    columns = ["product_id", "title", "category", "quantity", "revenue"]
    order = [F.desc("quantity"), F.asc("product_id")]
    products = measures.orderBy(*order).limit(top)
    ordered = named(products, dim_product).orderBy(*order).limit(top)
    return ordered.select(*columns).withColumn("revenue", money("revenue"))


def q2_rank_comparison(fact: DataFrame, dim_product: DataFrame, top: int = TOP) -> DataFrame:
    """Products in the top by revenue or by quantity, with both ranks (ties share one).

    The measures, one row per product, are written once and ranked from there; however many
    products share a value, none of it passes through one task or row.
    """
    return rank_comparison(staged(product_measures(fact, dim_product), "measures"), dim_product, top)


def rank_comparison(measures: DataFrame, dim_product: DataFrame, top: int = TOP) -> DataFrame:
    """The same from a table of measures by product."""
    values = ["revenue", "quantity"]
    shown = in_any_top(measures.select("product_id", *values), values, top)
    by_revenue = F.col("revenue_rank") <= top
    by_quantity = F.col("quantity_rank") <= top
    ranked = shown.withColumn(
        "top10_status",
        F.when(by_revenue & by_quantity, BOTH_TOP)
        .when(by_revenue, REVENUE_TOP)
        .otherwise(QUANTITY_TOP),
    ).withColumn("_group", F.when(by_revenue & by_quantity, 1).when(by_revenue, 2).otherwise(3))
    names = dim_product.select("product_id", "title", "category")
    columns = ["product_id", "title", "category", "revenue", "quantity"]
    return (
        ranked.join(names, "product_id")
        .orderBy("_group", "revenue_rank", "quantity_rank", "product_id")
        .select(*columns, "revenue_rank", "quantity_rank", "top10_status")
        .withColumn("revenue", money("revenue"))
    )


def _orders(fact: DataFrame) -> DataFrame:
    """One row per order, which is an invoice number on a day."""
    return fact.groupBy("invoiceno", "date_id").agg(
        F.count("*").alias("lines"), exact_sum("line_amount").alias("amount")
    )


def q3_monthly(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue, lines, orders, invoice numbers and mean basket by month.

    Order, then invoice within the month, then month: each step aggregates the one before
    on the map side, so no distinct count has to multiply the fact's rows.
    """
    return monthly_of(_orders(fact), dim_date)


def monthly_of(orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The same from one row per order."""
    return monthly_of_invoices(invoice_months(orders, dim_date, "inner"))


MONTH = ["year", "month", "month_name"]


def invoice_months(orders: DataFrame, dim_date: DataFrame, how: str = "left") -> DataFrame:
    """One row per invoice number and month from one row per order; a day that is not in the
    calendar has no month."""
    return (
        orders.join(dim_date.select("date_id", *MONTH), "date_id", how)
        .groupBy(*MONTH, "invoiceno")
        .agg(
            F.sum("amount").alias("amount"),
            F.sum("lines").alias("lines"),
            F.count("invoiceno").alias("orders"),
            F.count("date_id").alias("days"),
        )
    )


def monthly_of_invoices(invoices: DataFrame) -> DataFrame:
    """The same from one row per invoice number and month."""
    monthly = invoices.filter(F.col("year").isNotNull()).groupBy(*MONTH).agg(
        F.sum("amount").alias("revenue"),
        F.sum("lines").alias("lines"),
        F.sum("orders").alias("orders"),
        F.count("invoiceno").alias("raw_invoices"),
    )
    basket = ratio(F.col("revenue"), F.col("orders"))
    monthly = monthly.withColumns({"avg_basket": basket, "revenue": money("revenue")})
    return monthly.orderBy("year", "month")


def q3_additivity_check(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Monthly distinct counts added up, against the distinct counts of the whole."""
    return additivity_of(fact.select("invoiceno", "date_id"), dim_date)


def additivity_of(keys: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The same from invoice numbers and days, in any number of copies."""
    orders = keys.filter(F.col("invoiceno").isNotNull()).distinct()
    calendar = dim_date.select("date_id", "year", "month")
    per_month = (
        orders.join(calendar, "date_id", "left")
        .groupBy("invoiceno", "year", "month")
        .agg(F.count("date_id").alias("days"))
    )
    return additivity_of_invoices(per_month)


def additivity_of_invoices(invoices: DataFrame) -> DataFrame:
    """The same from one row per invoice number and month."""
    dated = F.col("year").isNotNull()
    per_invoice = invoices.filter(F.col("invoiceno").isNotNull()).groupBy("invoiceno").agg(
        F.sum(F.when(dated, F.col("days")).otherwise(0)).alias("monthly_orders"),
        F.sum("days").alias("orders"),
        F.count_if(dated).alias("months"),
    )
    return per_invoice.agg(
        F.sum("monthly_orders").alias("monthly_orders_sum"),
        F.sum("orders").alias("true_orders"),
        F.sum("months").alias("monthly_invoices_sum"),
        F.count("*").alias("true_invoices"),
    )


#: Registers of a distinct sketch are 2^LOG_REGISTERS; its standard error is 0.83 over the root of that.
LOG_REGISTERS = 12


def monthly_sketches(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Sketches of the distinct orders and invoice numbers of each month, to be stored: the distinct
    counts of any span of months come from them, where counts of months would not add up."""
    calendar = dim_date.select("date_id", "year", "month")
    dated = fact.filter(F.col("invoiceno").isNotNull()).select("invoiceno", "date_id").join(calendar, "date_id")
    order = F.concat_ws("@", "invoiceno", "date_id")
    return dated.groupBy("year", "month").agg(
        F.hll_sketch_agg(order, LOG_REGISTERS).alias("orders_sketch"),
        F.hll_sketch_agg("invoiceno", LOG_REGISTERS).alias("invoices_sketch"),
    )


def distinct_of_months(sketches: DataFrame) -> DataFrame:
    """About how many distinct orders and invoice numbers the given months hold together."""
    return sketches.agg(
        F.hll_sketch_estimate(F.hll_union_agg("orders_sketch")).alias("orders"),
        F.hll_sketch_estimate(F.hll_union_agg("invoices_sketch")).alias("invoices"),
    )


def distinct_by_year(fact: DataFrame, dim_date: DataFrame, sketches: DataFrame) -> DataFrame:
    """Exact distinct counts of each year beside those from its months' sketches, and whether these
    lie within four standard errors, which all but one in ten thousand do."""
    calendar = dim_date.select("date_id", "year")
    orders = fact.filter(F.col("invoiceno").isNotNull()).select("invoiceno", "date_id").distinct()
    invoices = orders.join(calendar, "date_id").groupBy("year", "invoiceno").agg(F.count("*").alias("n"))
    exact = invoices.groupBy("year").agg(F.sum("n").alias("orders"), F.count("*").alias("invoices"))
    sketched = sketches.groupBy(F.col("year").alias("_year")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("orders_sketch")).alias("_orders"),
        F.hll_sketch_estimate(F.hll_union_agg("invoices_sketch")).alias("_invoices"),
    )
    bound = 4 * 0.8326 / 2 ** (LOG_REGISTERS / 2)

    def near(name: str) -> Column:
        return F.abs(F.col(f"_{name}") - F.col(name)) <= F.greatest(F.col(name) * bound, F.lit(1.0))

    both = exact.join(sketched, F.col("year") == F.col("_year"), "left")
    within = F.coalesce(near("orders") & near("invoices"), F.lit(False)).alias("within_bound")
    return both.select("year", "orders", "invoices", within).orderBy("year")


def q4_basket_by_country(fact: DataFrame, exact: bool = True) -> DataFrame:
    """Mean and median order value and mean items per order, by country.

    An order seen in two countries counts once in each. The median is the lower one; with
    ``exact`` off it comes from a sketch alone, within one ten-thousandth of the ranks, which
    saves the second look at the orders.
    """
    orders = fact.groupBy("invoiceno", "date_id", "country").agg(
        exact_sum("line_amount").alias("amount"), F.sum("quantity").alias("items")
    )
    return baskets_of(orders, exact)


def baskets_of(orders: DataFrame, exact: bool = True) -> DataFrame:
    """The same from one row per order and country."""
    sketch = F.percentile_approx("amount", 0.5, ACCURACY).alias("median_basket")
    baskets = orders.groupBy("country").agg(
        F.count("*").alias("orders"),
        F.sum("amount").alias("revenue"),
        ratio(F.sum("amount"), F.count("amount")).alias("avg_basket"),
        *([] if exact else [sketch]),
        ratio(F.sum("items"), F.count("items")).alias("avg_items"),
    )
    if exact:
        # the median reads the same order rows, so that their shuffle is used again
        medians = lower_median(orders, "country", "amount", "median_basket")
        medians = medians.withColumnRenamed("country", "_country")
        same = F.col("country").eqNullSafe(F.col("_country"))
        baskets = baskets.join(medians, same, "left").drop("_country")
    baskets = baskets.withColumns(
        {"revenue": money("revenue"), "median_basket": money("median_basket")}
    )
    return baskets.select(
        "country", "orders", "revenue", "avg_basket", "median_basket", "avg_items"
    ).orderBy(F.desc_nulls_last("avg_basket"), F.asc_nulls_last("country"))


def q5_top_customers(fact: DataFrame, dim_customer: DataFrame, top: int = 5) -> DataFrame:
    """Known customers with the most revenue; only theirs meet names and addresses."""
    orders = (
        fact.filter(F.col("customer_id") > 0)
        .groupBy("customer_id", "invoiceno", "date_id")
        .agg(exact_sum("line_amount").alias("amount"), F.count("*").alias("lines"))
    )
    return top_customers(orders, dim_customer, top)


def top_customers(orders: DataFrame, dim_customer: DataFrame, top: int = 5) -> DataFrame:
    """The same from one row per customer and order."""
    measures = orders.groupBy("customer_id").agg(
        F.sum("amount").alias("revenue"),
        F.sum("lines").alias("lines"),
        F.count("invoiceno").alias("orders"),
    )
    order = [F.desc("revenue"), F.asc("customer_id")]
    known = measures.join(dim_customer.select("customer_id"), "customer_id", "left_semi")
    best = known.orderBy(*order).limit(top)
    people = dim_customer.select(
        "customer_id",
        F.concat("firstname", F.lit(" "), "lastname").alias("customer"),
        "email",
        "city",
        F.col("company_name").alias("company"),
    )
    columns = [*people.columns, "revenue", "lines", "orders"]
    ranked = F.broadcast(best).join(people, "customer_id").orderBy(*order).limit(top)
    return ranked.select(*columns).withColumn("revenue", money("revenue"))


def population_of(without_product: Column) -> Column:
    """What is missing on a line; the first case that applies."""
    return (
        F.when(without_product & no_customer(), NO_KEYS)
        .when(without_product, NO_PRODUCT)
        .when(F.col("customer_id") == schemas.ORPHAN_CUSTOMER, DELETED_CUSTOMER)
        .when(F.col("customer_id") == schemas.UNRECORDED_CUSTOMER, NO_CUSTOMER)
        .otherwise(COMPLETE_KEYS)
    )


def q6_orphan_population(fact: DataFrame) -> DataFrame:
    """Lines, quantity and revenue by what is missing, with shares of the whole."""
    populations = fact.groupBy(population_of(no_product()).alias("population")).agg(
        F.count("*").alias("lines"),
        F.sum("quantity").alias("quantity"),
        exact_sum("line_amount").alias("revenue"),
    )
    return population_shares(populations)


def population_shares(populations: DataFrame) -> DataFrame:
    """Lines, quantity and exact revenue by population, with shares of the whole."""
    everything = Window.partitionBy()
    shares = populations.select(
        "population",
        "lines",
        percent(F.col("lines"), F.sum("lines").over(everything)).alias("lines_pct"),
        "quantity",
        "revenue",
        percent(F.col("revenue"), F.sum("revenue").over(everything)).alias("revenue_pct"),
    )
    ordered = shares.orderBy(F.desc("revenue"), "population")
    return ordered.withColumn("revenue", money("revenue"))


def q6_orphan_impact(
    fact: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Lines and revenue a report loses when it filters unresolved keys."""
    return demo_inner_join_cost(fact, dim_product, dim_customer, broadcast_rows)


def q6_orphan_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Unresolved lines by month."""
    daily = fact.groupBy("date_id").agg(
        F.count("*").alias("lines"), F.count_if(no_product() | no_customer()).alias("orphans")
    )
    return trend_of(daily, dim_date)


def trend_of(daily: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The same from lines and unresolved lines by day."""
    monthly = (
        daily.join(dim_date.select("date_id", "year", "month"), "date_id")
        .groupBy("year", "month")
        .agg(F.sum("lines").alias("lines"), F.sum("orphans").alias("orphan_lines"))
    )
    share = percent(F.col("orphan_lines"), F.col("lines")).alias("orphan_pct")
    return monthly.select("*", share).orderBy("year", "month")


def month_over_month(monthly: DataFrame, first_day: Column, last_day: Column) -> DataFrame:
    """Change in revenue, basket and orders between consecutive full months.

    ``monthly`` is the result of ``q3_monthly``, one row per month. A month is full when it
    lies wholly between the first and the last day.
    """
    start = F.make_date("year", "month", F.lit(1))
    full = monthly.filter((start >= first_day) & (F.last_day(start) <= last_day))
    order = Window.orderBy("year", "month")
    index = F.col("year") * 12 + F.col("month")
    consecutive = F.lag(index).over(order) == index - 1

    def change(name: str) -> Column:
        before = F.when(consecutive, F.lag(name).over(order))
        gap = F.round(F.col(name) - before, 2)
        return percent(gap, before).alias(f"{name}_change_pct")

    measures = ["revenue", "avg_basket", "orders"]
    return full.select("year", "month", *measures, *[change(name) for name in measures]).orderBy(
        "year", "month"
    )


def full_months(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Month-over-month changes of the fact."""
    bounds = dim_date.agg(F.min("full_date").alias("first"), F.max("full_date").alias("last"))
    return month_over_month(
        q3_monthly(fact, dim_date), bounds.select("first").scalar(), bounds.select("last").scalar()
    )


def global_basket(fact: DataFrame) -> DataFrame:
    """Mean order value next to the mean line value, which is something else."""
    return _orders(fact).agg(
        F.count("*").alias("orders"),
        ratio(F.sum("amount"), F.count("amount")).alias("avg_basket"),
        ratio(F.sum("amount"), F.sum("lines")).alias("avg_line"),
    )


def identified_share(fact: DataFrame) -> DataFrame:
    """Share of revenue that carries a known customer."""
    known = exact_sum(F.when(F.col("customer_id") > 0, F.col("line_amount")))
    everything = exact_sum("line_amount")
    return fact.agg(
        money(known).alias("identified_revenue"),
        money(everything).alias("revenue"),
        percent(known, everything).alias("identified_pct"),
    )
