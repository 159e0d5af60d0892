"""Business reports over the purchase history.

Distinct counts go through an aggregate on (group, value) first, so a group
with a large share of the lines is spread over many tasks. One-row results are
put side by side by a union and an aggregate, never by a cross join.
"""

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.functions.columns import first_match, lookup, ratio, round_even, title_case
from trolley.functions.histogram import histogram
from trolley.operators.explore import top_values
from trolley.operators.recommend import popular_products
from trolley.schema import (
    DAY_NAMES,
    DEPARTMENT_MIN_ROWS,
    HIGH_VALUE_ORDERS,
    OTHER_SEGMENT,
    PRODUCT_MIN_ROWS,
    SEGMENT_RULES,
)


def side_by_side(*one_row_frames):
    """One row with the columns of all the one-row frames."""
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_frames
    )
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])


def _by_order(lines):
    return lines.groupBy("user_id", "order_id").agg(
        F.count("*").alias("n"),
        F.count("product_id").alias("n_products"),
        F.sum("reordered").alias("reorders"),
        F.count("reordered").alias("n_known"),
    )


def _by_user(lines):
    """Orders, lines and reorders per user, through one row per order."""
    return (
        _by_order(lines)
        .groupBy("user_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("n").alias("n"),
            F.sum("n_products").alias("total_items"),
            F.sum("reorders").alias("reorders"),
            F.sum("n_known").alias("n_known"),
        )
    )


def _distinct(df, column, name):
    return df.select(column).distinct().agg(F.count(column).alias(name))


def _user_figures(prior, high_value=HIGH_VALUE_ORDERS):
    """All figures that follow from orders, lines and reorders per user, in one row."""
    is_user = F.col("user_id").isNotNull()
    return _by_user(prior).agg(
        F.sum("total_orders").alias("prior_orders"),
        F.sum("n").alias("prior_items"),
        F.count("user_id").alias("unique_users"),
        ratio(F.sum("reorders"), F.sum("n_known")).alias("avg_reorder_rate"),
        ratio(F.sum("n"), F.sum("total_orders")).alias("avg_basket_size"),
        F.avg(F.when(is_user, F.col("total_orders"))).alias("avg_lifetime_orders"),
        F.avg(F.when(is_user, F.col("total_items"))).alias("avg_lifetime_items"),
        F.count_if(is_user & (F.col("total_orders") >= high_value)).alias("high_value_customers"),
    )


def _order_and_product_counts(prior, train):
    train_totals = (
        train.groupBy("order_id")
        .agg(F.count("*").alias("n"))
        .agg(F.count("order_id").alias("train_orders"), F.sum("n").alias("train_items"))
    )
    return [train_totals, _distinct(prior, "product_id", "unique_products")]


def _executive_columns():
    return [
        (F.col("prior_orders") + F.col("train_orders")).alias("total_orders"),
        "unique_users",
        "unique_products",
        "avg_reorder_rate",
        "avg_basket_size",
        (F.col("prior_items") + F.coalesce("train_items", F.lit(0))).alias("total_items"),
    ]


LIFETIME_COLUMNS = ["avg_lifetime_orders", "avg_lifetime_items", "high_value_customers"]


def executive_kpis(prior, train):
    """Orders, users, products, reorder rate, basket size and items in one row."""
    row = side_by_side(_user_figures(prior), *_order_and_product_counts(prior, train))
    return row.select(*_executive_columns())


def hourly_pattern(prior):
    """Lines per hour of day."""
    return (
        prior.filter(F.col("order_hour_of_day").isNotNull())
        .groupBy("order_hour_of_day")
        .agg(F.count("*").alias("n"))
        .orderBy("order_hour_of_day")
    )


def peak_hour(prior):
    """The hour with most lines, the earliest on a tie."""
    return hourly_pattern(prior).orderBy(F.desc("n"), "order_hour_of_day").limit(1)


def daily_pattern(prior):
    """Lines per day of week, with the day's name."""
    return (
        prior.filter(F.col("order_dow").isNotNull())
        .groupBy("order_dow")
        .agg(F.count("*").alias("n"))
        .withColumn("day", lookup("order_dow", DAY_NAMES))
        .orderBy("order_dow")
    )


def busiest_day(prior):
    """The day with most lines, the earliest in the week on a tie."""
    return daily_pattern(prior).orderBy(F.desc("n"), "order_dow").limit(1)


def gap_histogram(prior, bins=30):
    """Histogram of day gaps, the first order's counted as 0."""
    gaps = prior.select(F.coalesce("days_since_prior_order", F.lit(0.0)).alias("gap"))
    return histogram(gaps, "gap", bins)


def mean_reorder_cycle(prior):
    """Mean of the day gaps above 0."""
    return prior.filter(F.col("days_since_prior_order") > 0).agg(
        F.avg("days_since_prior_order").alias("avg_days_between")
    )


def _basket_rows(prior):
    return prior.dropna(subset=["order_id"]).groupBy("order_id").agg(F.count("*").alias("basket_size"))


def basket_histogram(prior, bins=30):
    """Histogram of basket sizes over all orders."""
    return histogram(_basket_rows(prior), "basket_size", bins)


def most_common_basket_size(prior):
    """The most frequent basket size, the smallest on a tie."""
    return (
        _basket_rows(prior)
        .groupBy("basket_size")
        .agg(F.count("*").alias("n_orders"))
        .orderBy(F.desc("n_orders"), "basket_size")
        .limit(1)
    )


def department_performance(prior, k=10):
    """Lines, reorder rate and distinct products of the largest departments."""
    by_product = (
        prior.filter(F.col("department").isNotNull())
        .groupBy("department", "product_id")
        .agg(
            F.count("order_id").alias("n"),
            F.sum("reordered").alias("reorders"),
            F.count("reordered").alias("n_known"),
        )
    )
    return (
        by_product.groupBy("department")
        .agg(
            F.sum("n").alias("total_orders"),
            round_even(ratio(F.sum("reorders"), F.sum("n_known")), 3).alias("reorder_rate"),
            F.count("product_id").alias("unique_products"),
        )
        .withColumn("department_display", title_case("department"))
        .orderBy(F.desc("total_orders"), "department")
        .limit(k)
    )


def department_reorder_rank(prior, min_count=DEPARTMENT_MIN_ROWS, k=10):
    """Departments with enough lines, by reorder rate."""
    return (
        prior.filter(F.col("department").isNotNull())
        .groupBy("department")
        .agg(F.count("reordered").alias("n"), F.avg("reordered").alias("reorder_rate"))
        .filter(F.col("n") >= min_count)
        .withColumn("department_display", title_case("department"))
        .orderBy(F.desc("reorder_rate"), "department")
        .limit(k)
    )


def top_products(prior, k=15, shown=10):
    """The ``shown`` first of the ``k`` most bought names."""
    return popular_products(prior, min(k, shown))


def product_reorder_rank(prior, min_count=PRODUCT_MIN_ROWS, k=10):
    """Names with enough lines, by rate rounded to 3 digits, then lines."""
    return (
        prior.filter(F.col("product_name").isNotNull())
        .groupBy("product_name")
        .agg(
            F.count("reordered").alias("total_orders"),
            round_even(F.avg("reordered"), 3).alias("reorder_rate"),
        )
        .filter(F.col("total_orders") >= min_count)
        .orderBy(F.desc("reorder_rate"), F.desc("total_orders"), "product_name")
        .limit(k)
    )


def customer_stats(prior):
    """Orders, items, rounded reorder rate and basket size per user."""
    return _by_user(prior.filter(F.col("user_id").isNotNull())).select(
        "user_id",
        "total_orders",
        "total_items",
        round_even(ratio("reorders", "n_known"), 3).alias("avg_reorder_rate"),
        ratio("total_items", "total_orders").alias("avg_basket_size"),
    )


def customer_segments(stats, rules=None, otherwise=OTHER_SEGMENT):
    """Customer statistics with the first segment whose minimums all hold."""
    columns = {"orders": "total_orders", "basket": "avg_basket_size", "rate": "avg_reorder_rate"}
    conditions = [
        (
            reduce(lambda a, b: a & b, [F.col(columns[k]) >= v for k, v in minimums.items()]),
            name,
        )
        for name, minimums in (SEGMENT_RULES if rules is None else rules)
    ]
    return stats.withColumn("segment", first_match(conditions, otherwise))


def segment_sizes(segments):
    """Users and percent of all users per segment."""
    counts = segments.groupBy("segment").agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy())  # over one row per segment
    return counts.select(
        "segment", "n", (F.col("n") * 100.0 / total).alias("percentage")
    ).orderBy(F.desc("n"), "segment")


def cross_category_orders(prior):
    """Orders spanning several departments, and their percent of all orders."""
    lines = prior.dropna(subset=["order_id"])
    by_department = lines.groupBy("order_id", "department").agg(F.count("*").alias("n"))
    per_order = by_department.groupBy("order_id").agg(F.count("department").alias("n_departments"))
    return per_order.agg(
        F.count_if(F.col("n_departments") > 1).alias("multi_department_orders"),
        F.count("*").alias("orders"),
    ).withColumn(
        "percentage", F.try_divide(F.col("multi_department_orders") * 100.0, F.col("orders"))
    )


def department_pair_counts(prior):
    """Orders holding both departments, for every unordered pair.

    Orders are first counted per set of departments; pairs are formed per
    distinct set, weighted with that count, not per order.
    """
    sets = (
        prior.filter(F.col("department").isNotNull())
        .groupBy("order_id")
        .agg(F.array_sort(F.collect_set("department")).alias("departments"))
        .groupBy("departments")
        .agg(F.count("*").alias("n"))
        .filter(F.size("departments") > 1)
    )
    firsts = sets.select("departments", "n", F.posexplode("departments").alias("i", "first_department"))
    rest = F.slice("departments", F.col("i") + 2, F.size("departments"))
    return (
        firsts.select("n", "first_department", F.explode(rest).alias("second_department"))
        .groupBy("first_department", "second_department")
        .agg(F.sum("n").alias("n"))
    )


def department_pairs(prior, k=5):
    """The ``k`` most common department pairs."""
    return (
        department_pair_counts(prior)
        .orderBy(F.desc("n"), "first_department", "second_department")
        .limit(k)
    )


def customer_lifetime(prior, high_value=HIGH_VALUE_ORDERS):
    """Mean orders and items per user, and users with many orders."""
    return _user_figures(prior, high_value).select(*LIFETIME_COLUMNS)


def favourite_departments(prior):
    """Per user the department with most lines, the first by name on a tie."""
    counts = (
        prior.filter(F.col("user_id").isNotNull() & F.col("department").isNotNull())
        .groupBy("user_id", "department")
        .agg(F.count("*").alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), "department"))
    return counts.groupBy("user_id").agg(best["department"].alias("favourite_department"))


def user_profile(prior):
    """Orders, items, reorder rate, basket and favourite department per user."""
    totals = _by_user(prior.filter(F.col("user_id").isNotNull()))
    return totals.join(favourite_departments(prior), "user_id", "left").select(
        "user_id",
        "total_orders",
        F.col("n").alias("total_items"),
        ratio("reorders", "n_known").alias("reorder_rate"),
        ratio("n", "total_orders").alias("avg_basket"),
        "favourite_department",
    )


def recommendation_metrics(prior, hour_rates):
    """Reorders, their share of all lines, and the mean product-hour rate."""
    totals = prior.agg(
        F.sum("reordered").alias("total_reorders"),
        ratio(F.sum("reordered"), F.count("*")).alias("global_reorder_rate"),
    )
    hourly = hour_rates.agg(F.avg("hour_reorder_rate").alias("avg_hourly_reorder_rate"))
    return side_by_side(totals, hourly)


def _as_list(top, key, count, name):
    """A short ranked table as one array of (key, count), best first."""
    entry = F.struct((-F.col(count)).alias("minus_n"), F.col(key).alias("key"))
    ordered = F.array_sort(F.collect_list(entry))
    return top.agg(
        F.transform(ordered, lambda e: F.struct(e["key"].alias("name"), (-e["minus_n"]).alias("n"))).alias(name)
    )


def business_summary(prior, train, k=5):
    """All headline figures in one row, top lists as arrays."""
    mean_gap = prior.agg(
        F.avg(F.coalesce("days_since_prior_order", F.lit(0.0))).alias("avg_days_between_orders")
    )
    departments = _as_list(top_values(prior, "department", k), "department", "n", "top_departments")
    products = _as_list(popular_products(prior, k), "product_name", "count", "top_products")
    row = side_by_side(
        _user_figures(prior),
        *_order_and_product_counts(prior, train),
        mean_gap,
        peak_hour(prior).select(F.col("order_hour_of_day").alias("peak_hour")),
        busiest_day(prior).select(F.col("order_dow").alias("busiest_day")),
        departments,
        products,
    )
    return row.select(
        *_executive_columns(), *LIFETIME_COLUMNS, "avg_days_between_orders", "peak_hour",
        "busiest_day", "top_departments", "top_products",
    )
