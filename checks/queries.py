"""Every registered query: name -> function of (session, star-schema folder).

All queries read whole tables. Parameters replace defaults that do not fit the
derived baskets (ids, thresholds, the clock); see FIXTURES.md.
"""

import uuid

from pyspark.sql import functions as F

from trolley.functions.columns import title_case, week_day
from trolley.functions.histogram import histogram
from trolley.operators import (
    boosting, enrich, explore, models, pair, product, rates, recommend, reports, training, user,
)
from trolley.plans import refresh
from trolley.plans.baskets import open_baskets
from trolley.schema import MODEL_FEATURES, PRODUCTS
from trolley.sources import checked, tables
from trolley.sources.releases import Release

# Fixed values for the derived baskets.
AS_OF = "2001-08-02 14:00:00"
FLAGS = {
    "name_large": ("name_contains", "large"),
    "aisle_10": ("aisle_id", 10),
    "department_0": ("department_id", 0),
    "department_2": ("department_id", 2),
    "department_5": ("department_id", 5),
    "department_6": ("department_id", 6),
    "department_11": ("department_id", 11),
    "department_12": ("department_id", 12),
}
DEPARTMENT_MIN = 8700
PRODUCT_MIN = 3300
SEGMENTS = [
    ("VIP Customers", {"orders": 12, "basket": 4}),
    ("Loyal Customers", {"orders": 8, "rate": 0.2}),
    ("Regular Customers", {"orders": 5}),
]
AISLE = "ring"
REFRESH_DATE = "1997-06-01"


def _round(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- sources and sinks -----------------------------------------------------

def _new_folder(b, name):
    """A folder that no earlier result reads."""
    return f"{b.folder}/{name}-{uuid.uuid4().hex}"


def csv_tables(b):
    folder = _new_folder(b, "raw_csv")
    for name, (stem, _) in tables.RAW_TABLES.items():
        tables.write_table(b.raw_tables[name], f"{folder}/{stem}.csv", "csv")
    return tables.load_tables(b.spark, folder, "csv")


def load_tables(b):
    loaded = csv_tables(b)
    return loaded["order_products_prior"].unionByName(loaded["order_products_train"]).join(
        loaded["orders"], "order_id"
    )


def validate_tables(b):
    return tables.validate_tables(b.raw_tables)


def optional_table(b):
    found = {
        name: tables.load_optional(b.spark, f"{b.source}/{name}.parquet", "parquet")
        for name in ("customer", "reviews")
    }
    return tables.table_sizes({name: df for name, df in found.items() if df is not None})


def processed_table(b):
    path = _new_folder(b, "product_statistics")
    tables.write_table(product.product_statistics(b.prior, b.products_merged), path)
    return tables.read_table(b.spark, path)


def read_prefix(b):
    folder = _new_folder(b, "prefix")
    tables.write_table(b.products, f"{folder}/nested/deeper/products.csv", "csv")
    tables.write_table(b.aisles, f"{folder}/nested/aisles.parquet")
    return tables.read_prefix(b.spark, folder, schema=PRODUCTS)


def serving_tables(b):
    return {
        "slot_products": recommend.top_products_by_slot(b.prior),
        "user_last_purchase": _last_purchase(b),
        **b.rates,
        "user_product_snapshot": recommend.user_product_snapshot(b.pairs),
        "product_map": recommend.product_map(b.products),
    }


def publish_serving_tables(b):
    folders = tables.publish(serving_tables(b), _new_folder(b, "serving"))
    return tables.table_sizes(
        {name: tables.read_table(b.spark, path) for name, path in folders.items()}
    )


def released_table_rows(b):
    """Rows per table of the newest release, as counted while it was written."""
    return b.spark.createDataFrame(list(_release(b).rows().items()), "table_name string, n_rows long")


def checked_tables(b):
    """Counts of raw CSV tables that hold bad rows too: bare product names between their lines."""
    folder = _new_folder(b, "mixed_csv")
    for name, (stem, _) in tables.RAW_TABLES.items():
        tables.write_table(b.raw_tables[name], f"{folder}/{stem}.csv", "csv")
        stray = b.products.select(F.col("product_name").alias(b.raw_tables[name].columns[0]))
        stray.write.mode("append").csv(f"{folder}/{stem}.csv", header=True)
    return checked.check_report(b.spark, checked.check_tables(b.spark, folder, _new_folder(b, "checked")))


# --- daily refresh ----------------------------------------------------------

def refreshed_folder(b):
    """A feature folder fed with three batches that make up the prior lines.

    The base has the orders before a date, the second batch those from then on, and
    the third the evening orders of all dates, which arrive late.
    """
    if "refreshed" not in b.fitted:
        dated = b.prior.join(b.order_dates, "order_id")
        late, early = F.col("order_hour_of_day") >= 18, F.col("order_date") < F.lit(REFRESH_DATE)
        folder = _new_folder(b, "refreshed")
        for batch, chosen in (("base", early & ~late), ("day", ~early & ~late), ("late", late)):
            refresh.refresh(b.spark, folder, dated.filter(chosen), batch, n_buckets=8)
        b.fitted["refreshed"] = folder
    return b.fitted["refreshed"]


def _refreshed(name):
    return lambda b: refresh.refreshed(b.spark, refreshed_folder(b), name)


# --- scalar functions ------------------------------------------------------

def product_labels(b):
    return b.products_merged.select(
        "product_id",
        title_case("product_name").alias("product_label"),
        title_case("department").alias("department_label"),
    )


def order_clock(b):
    now = F.lit(AS_OF).cast("timestamp")
    return b.order_dates.select(
        "order_id",
        week_day("order_date").alias("dow"),
        F.hour(now).alias("hour_now"),
        week_day(now).alias("dow_now"),
        F.datediff(F.to_date(now), "order_date").alias("day_gap"),
    )


# --- helpers for training, scoring and models --------------------------------

def _last_purchase(b):
    return recommend.user_last_purchase(b.train, order_dates=b.order_dates)


def _contexts(b):
    return recommend.context_features(
        recommend.user_product_snapshot(b.pairs), b.rates, _last_purchase(b), AS_OF
    )


def _release(b):
    """The release of the serving tables, laid out by user bucket, committed once per application."""
    if "serving" not in b.fitted:
        folder = _new_folder(b, "serving")
        recommend.publish_serving(b.spark, serving_tables(b), folder, n_buckets=8)
        b.fitted["serving"] = Release(b.spark, folder)
    return b.fitted["serving"]


def _final(b):
    return training.final_features(
        b.pairs, user.user_features(b.prior), product.product_features(b.prior, b.products_merged, FLAGS)
    )


def _final_without_factors(b):
    return training.final_features(
        b.pairs, user.user_features(b.prior), product.product_statistics(b.prior, b.products_merged)
    )


def _fixed_scores(b):
    """Training rows with a score made from two of their features."""
    p = (F.col("u_p_reorder_rate") + F.col("hour_reorder_rate") + 0.1) / 2.2
    return b.training_set.select("user_id", "product_id", "reordered", p.alias("p"))


def _held_out_scores(b, fit):
    train, validation = b.parts
    return models.score(fit(train), validation).select(
        "user_id", "product_id", "reordered", "p"
    )


def logistic_regression(b):
    return _held_out_scores(b, lambda train: models.fit_logistic_regression(train, max_iter=100))


def decision_tree_search(b):
    grid = {"maxDepth": [5, 10], "minInstancesPerNode": [2, 5]}
    return _held_out_scores(
        b, lambda train: models.fit_decision_tree(train, grid, n_candidates=3, folds=3)[0]
    )


def calibrated_forest(b):
    return _held_out_scores(
        b, lambda train: models.fit_calibrated_forest(train, trees=25, max_depth=6, folds=3)
    )


def perceptron(b):
    return _held_out_scores(b, models.fit_perceptron)


def boosted_trees_early_stop(b):
    train, validation = b.parts
    model = models.fit_boosted_trees(
        train, validation, rounds=20, max_depth=5, step=0.3, feature_share="0.4", patience=5
    )
    return models.score(model, validation).select("user_id", "product_id", "reordered", "p")


def boosted_trees_rounds(b):
    """Whether trees with a share of the features each stopped where they should, and what they saw."""
    train, validation = b.parts
    model = boosting.fit_free_trees(train, validation, rounds=8, depth=4, step=0.3, patience=2, n_bins=32)
    losses = [held for _, held in model.history]
    best = losses.index(min(losses))
    stopped = len(losses) - 1 == min(best + 2, 8) and len(model.trees) == best and best > 0
    return b.training_set.agg(F.count("*").alias("n_rows")).withColumn("stopped_as_told", F.lit(stopped))


def _parts(b):
    return b.parts


def _family(b, name, full=False):
    """(name, parameters, model) of one of the six families, quick or full-size, fitted once per application."""
    key = f"{'full' if full else 'family'}_{name}"
    if key not in b.fitted:
        (b.fitted[key],) = models.fit_families(*_parts(b), {name: {} if full else models.QUICK[name]})
    return b.fitted[key]


def _family_scores(name, full=False):
    def query(b):
        scored = models.score(_family(b, name, full)[2], b.parts[1])
        return scored.select("user_id", "product_id", "reordered", "p")

    return query


def model_families(b):
    """All six at their full size."""
    return models.model_comparison(b.spark, [_family(b, name, full=True) for name in models.QUICK], *b.parts)


def permutation_importance(b):
    """Of the network, which has no importances of its own."""
    return models.permutation_importance(_family(b, "network")[2], b.parts[1], repeats=2)


def factors_per_pattern(b):
    """Products and different factor vectors of each flag pattern."""
    flagged = product.category_flags(b.products_merged, FLAGS)
    reduced = product.reduced_features(b.products_merged, FLAGS)
    vector = F.struct(*[c for c in reduced.columns if c != "product_id"])
    return flagged.join(reduced, "product_id").groupBy(*FLAGS).agg(
        F.count("*").alias("n_products"), F.countDistinct(vector).alias("n_vectors")
    )


def _served_model(b):
    """The boosted trees, fitted once per application."""
    if "served" not in b.fitted:
        train, _ = b.parts
        b.fitted["served"] = models.fit_boosted_trees(train, rounds=20, max_depth=3, step=0.3)
    return b.fitted["served"]


def boosted_trees(b):
    return models.score(_served_model(b), b.parts[1]).select(
        "user_id", "product_id", "reordered", "p"
    )


def feature_importance(b):
    return models.feature_importance(b.spark, _served_model(b))


def saved_model_scores(b):
    path = _new_folder(b, "boosted_trees")
    models.save_model(_served_model(b), path)
    return models.score(models.load_model(b.spark, path), b.parts[1]).select(
        "user_id", "product_id", "reordered", "p"
    )


def saved_model_agreement(b):
    """Held-out rows, and how many the reloaded model scores differently."""
    keys = ["user_id", "product_id"]
    reloaded = saved_model_scores(b).select(*keys, F.col("p").alias("reloaded"))
    both = boosted_trees(b).join(reloaded, keys)
    return both.agg(
        F.count("*").alias("n"), F.count_if(F.col("p") != F.col("reloaded")).alias("n_different")
    )


def model_comparison(b):
    train, validation = b.parts
    logistic = models.fit_logistic_regression(train, max_iter=100)
    boosted = _served_model(b)
    return models.model_comparison(
        b.spark,
        [
            ("logistic_regression", {"max_iter": 100, "penalty": 1.0}, logistic),
            ("boosted_trees", {"rounds": 20, "max_depth": 3, "step": 0.3}, boosted),
        ],
        train,
        validation,
    )


def _customers(b):
    path = f"{b.source}/customer.parquet"
    return tables.read_table(b.spark, path).select(F.col("c_custkey").alias("user_id"))


def _by_order_rate(b):
    """Top products by order rate, in place of a model's score."""
    known, _ = recommend.split_known(_customers(b), _last_purchase(b))
    candidates = b.pairs.join(known, "user_id", "left_semi")
    return recommend.top_scored(candidates, b.products, probability="u_p_order_rate")


def recommendations(b):
    known, _ = recommend.split_known(_customers(b), _last_purchase(b))
    return recommend.recommend(
        known, _served_model(b), recommend.user_product_snapshot(b.pairs), b.rates,
        _last_purchase(b), b.products, AS_OF,
    )


def recommendation_counts(b):
    """Recommendations, distinct products and highest rank per known user."""
    return recommendations(b).groupBy("user_id").agg(
        F.count("*").alias("n"),
        F.countDistinct("product_id").alias("n_products"),
        F.max("rank").alias("last_rank"),
    )


def known_users(b):
    known, unknown = recommend.split_known(_customers(b), _last_purchase(b))
    return known.withColumn("known", F.lit(True)).unionByName(
        unknown.withColumn("known", F.lit(False))
    )


def reduced_feature_norms(b):
    """Length of each product's factors: 1, or 0 for products without a flag."""
    reduced = product.reduced_features(b.products_merged, FLAGS)
    squares = sum(F.col(c) ** 2 for c in reduced.columns if c != "product_id")
    return reduced.select("product_id", F.round(F.sqrt(squares), 6).alias("norm"))


def routed_recommendations(b):
    return recommend.route(
        _customers(b), _last_purchase(b), _by_order_rate(b),
        recommend.top_products_by_slot(b.prior), AS_OF,
    )


def scaled_validation(b):
    train, validation = b.parts
    _, scaled = training.scale(train, validation)
    return _round(scaled.select("user_id", "product_id", *MODEL_FEATURES), *MODEL_FEATURES)


def business_summary(b):
    return reports.business_summary(b.prior, b.train).drop("top_departments", "top_products")


def business_top_lists(b):
    row = reports.business_summary(b.prior, b.train)
    lists = [
        row.select(F.lit(kind).alias("kind"), F.posexplode(column).alias("position", "entry"))
        for kind, column in (("department", "top_departments"), ("product", "top_products"))
    ]
    return lists[0].unionByName(lists[1]).select("kind", "position", "entry.name", "entry.n")


BASKET_QUERIES = {
    # sources and sinks
    "load_tables": load_tables,
    "validate_tables": validate_tables,
    "optional_table": optional_table,
    "processed_table": processed_table,
    "read_prefix": read_prefix,
    "publish_serving_tables": publish_serving_tables,
    "released_table_rows": released_table_rows,
    "checked_tables": checked_tables,
    # daily refresh
    **{f"refreshed_{name}": _refreshed(name) for name in refresh.FEATURE_KEYS},
    # scalar functions
    "product_labels": product_labels,
    "order_clock": order_clock,
    "sentinel_aisle": lambda b: enrich.products_in_aisle(b.products_merged, AISLE),
    "impute_first_gap": lambda b: enrich.impute_first_gap(b.prior).select(
        "order_id", "product_id", "days_since_prior_order"
    ),
    # joins
    "enrich_products": lambda b: b.products_merged,
    "prior_combined": lambda b: enrich.combine(b.order_products_prior, b.orders, b.products_merged),
    "train_combined": lambda b: enrich.combine(b.order_products_train, b.orders, b.products_merged),
    "train_products": lambda b: enrich.train_products(b.order_products_train, b.products_merged),
    "final_features": _final_without_factors,
    "final_features_with_factors": _final,
    "labelled_pairs": lambda b: training.with_labels(b.pairs.select("user_id", "product_id"), b.train),
    "train_contexts": lambda b: training.train_contexts(b.train),
    # product features
    "product_reorder_rate": lambda b: product.product_reorder_rate(b.prior),
    "average_cart_position": lambda b: product.average_cart_position(b.prior),
    "category_flags": lambda b: product.category_flags(b.products_merged, FLAGS),
    "reduced_features": lambda b: product.reduced_features(b.products_merged, FLAGS),
    "reduced_feature_norms": reduced_feature_norms,
    "factors_per_pattern": factors_per_pattern,
    "aisle_reorder_rate": lambda b: product.aisle_reorder_rate(b.prior),
    "department_reorder_rate": lambda b: product.department_reorder_rate(b.prior),
    "product_statistics": lambda b: product.product_statistics(b.prior, b.products_merged),
    "product_features": lambda b: product.product_features(b.prior, b.products_merged, FLAGS),
    # user features
    "user_reorder_rate": lambda b: user.user_reorder_rate(b.prior),
    "user_unique_products": lambda b: user.user_unique_products(b.prior),
    "user_total_products": lambda b: user.user_total_products(b.prior),
    "user_average_cart_size": lambda b: user.user_average_cart_size(b.prior),
    "user_average_days_between_orders": lambda b: user.user_average_days_between_orders(b.prior),
    "user_reordered_products_ratio": lambda b: user.user_reordered_products_ratio(b.prior),
    "user_features": lambda b: user.user_features(b.prior),
    # user-product features
    "interaction_counts": lambda b: pair.interaction_counts(b.prior),
    "pair_order_rate": lambda b: pair.pair_order_rate(b.prior),
    "pair_reorder_rate": lambda b: pair.pair_reorder_rate(b.prior),
    "pair_average_position": lambda b: pair.pair_average_position(b.prior),
    "pair_orders_since_last": lambda b: pair.pair_orders_since_last(b.prior),
    "pair_max_streak": lambda b: pair.pair_max_streak(b.prior),
    "user_product_features": lambda b: pair.user_product_features(b.prior),
    # rate tables
    **{name: (lambda b, name=name: rates.rate_table(b.prior, name)) for name in rates.RATE_KEYS},
    "hour_profile": lambda b: _round(rates.hour_profile(b.prior), "mean_hour_reorder_rate"),
    "day_profile": lambda b: _round(rates.day_profile(b.prior), "mean_day_reorder_rate"),
    "gap_profile": lambda b: _round(rates.gap_profile(b.prior), "mean_days_since_prior_reorder_rate"),
    "order_rate_histogram": lambda b: _round(
        histogram(b.pairs, "u_p_order_rate", 50), "bin_centre"
    ),
    # summary, training set, split, scaling
    "feature_summary": lambda b: training.feature_summary(_final_without_factors(b)),
    "last_train_orders": lambda b: training.last_train_orders(b.train),
    "order_details": lambda b: training.order_details(b.train),
    "training_set": lambda b: training.training_set(b.pairs, b.train, b.rates),
    "label_distribution": lambda b: training.label_distribution(b.training_set),
    "split_rows": lambda b: training.with_split(b.training_set).select(
        "user_id", "product_id", "split"
    ),
    "exact_split_rows": lambda b: training.with_exact_split(b.training_set).select(
        "user_id", "product_id", "split"
    ),
    "exact_split_report": lambda b: training.split_report(training.with_exact_split(b.training_set)),
    "scaled_validation": scaled_validation,
    "split_report": lambda b: training.split_report(training.with_split(b.training_set)),
    # models
    "logistic_regression": logistic_regression,
    "decision_tree_search": decision_tree_search,
    "calibrated_forest": calibrated_forest,
    "perceptron": perceptron,
    "boosted_trees_early_stop": boosted_trees_early_stop,
    "boosted_trees": boosted_trees,
    "boosted_trees_rounds": boosted_trees_rounds,
    "free_trees": _family_scores("free_trees"),
    "oblivious_trees": _family_scores("oblivious_trees"),
    "minibatch_network": _family_scores("network", full=True),
    "model_families": model_families,
    "permutation_importance": permutation_importance,
    "log_loss": lambda b: _round(models.log_loss(_fixed_scores(b)), "log_loss"),
    "accuracy": lambda b: models.accuracy(_fixed_scores(b)),
    "feature_importance": feature_importance,
    "model_comparison": model_comparison,
    "saved_model_scores": saved_model_scores,
    "saved_model_agreement": saved_model_agreement,
    # recommendation
    "slot_products": lambda b: recommend.top_products_by_slot(b.prior),
    "user_last_purchase": lambda b: recommend.user_last_purchase(b.train),
    "user_last_purchase_dates": _last_purchase,
    "product_map": lambda b: recommend.product_map(b.products),
    "user_product_snapshot": lambda b: recommend.user_product_snapshot(b.pairs),
    "context_features": _contexts,
    "served_context_features": lambda b: recommend.served_features(
        _release(b), _customers(b), AS_OF
    ),
    "recommendations": recommendations,
    "recommendation_counts": recommendation_counts,
    "known_users": known_users,
    "best_by_order_rate": _by_order_rate,
    "routed_recommendations": routed_recommendations,
    "recommend_new": lambda b: recommend.recommend_new(
        recommend.top_products_by_slot(b.prior), AS_OF
    ),
    "user_most_reordered": lambda b: recommend.user_most_reordered(b.prior),
    "popular_products": lambda b: recommend.popular_products(b.prior, 8),
    # exploration
    "products_per_department": lambda b: explore.count_by(b.products_merged, "department"),
    "products_per_aisle": lambda b: explore.count_by(b.products_merged, "aisle"),
    "orders_by_hour": lambda b: explore.count_by(b.orders, "order_hour_of_day"),
    "orders_by_day": lambda b: explore.count_by(b.orders, "order_dow"),
    "orders_by_gap": lambda b: explore.count_by(b.orders, "days_since_prior_order"),
    "train_favourites": lambda b: explore.top_values(
        enrich.train_products(b.order_products_train, b.products_merged), "product_name"
    ),
    "orders_per_user": lambda b: explore.orders_per_user(b.orders),
    "order_count_range": lambda b: explore.order_count_range(b.orders),
    "orders_per_user_histogram": lambda b: _round(
        histogram(explore.orders_per_user(b.orders), "n_orders", 30), "bin_centre"
    ),
    "train_reorder_rate_by_name": lambda b: explore.reorder_rate_by_name(
        enrich.train_products(b.order_products_train, b.products_merged)
    ),
    "prior_reorder_rate_by_name": lambda b: explore.reorder_rate_by_name(b.prior, 10),
    "basket_sizes": lambda b: explore.basket_sizes(b.prior),
    "average_basket_size": lambda b: explore.average_basket_size(b.order_products_prior),
    "cart_size_histogram": lambda b: _round(
        histogram(explore.basket_sizes(b.order_products_prior), "basket_size", 40), "bin_centre"
    ),
    "top_aisles": lambda b: explore.top_values(b.prior, "aisle"),
    "top_departments": lambda b: explore.top_values(b.prior, "department"),
    "missing_values": lambda b: explore.missing_values(b.prior),
    "missing_total": lambda b: explore.missing_total(b.training_set),
    "target_distribution": lambda b: explore.target_distribution(Prior=b.prior, Train=b.train),
    "distinct_users": lambda b: explore.distinct_users(b.orders),
    "dataset_profile": lambda b: explore.dataset_profile(
        {"prior_combined": b.prior, "train_combined": b.train, "user_product_features": b.pairs, **b.rates}
    ),
    "first_rows": lambda b: explore.first_rows(b.prior, ["order_id", "product_id"]),
    # business reports
    "executive_kpis": lambda b: reports.executive_kpis(b.prior, b.train),
    "hourly_pattern": lambda b: reports.hourly_pattern(b.prior),
    "peak_hour": lambda b: reports.peak_hour(b.prior),
    "daily_pattern": lambda b: reports.daily_pattern(b.prior),
    "busiest_day": lambda b: reports.busiest_day(b.prior),
    "gap_histogram": lambda b: _round(reports.gap_histogram(b.prior), "bin_centre"),
    "mean_reorder_cycle": lambda b: reports.mean_reorder_cycle(b.prior),
    "basket_histogram": lambda b: _round(reports.basket_histogram(b.prior), "bin_centre"),
    "most_common_basket_size": lambda b: reports.most_common_basket_size(b.prior),
    "department_performance": lambda b: reports.department_performance(b.prior),
    "department_reorder_rank": lambda b: reports.department_reorder_rank(b.prior, DEPARTMENT_MIN),
    "top_products": lambda b: reports.top_products(b.prior),
    "product_reorder_rank": lambda b: reports.product_reorder_rank(b.prior, PRODUCT_MIN),
    "customer_stats": lambda b: reports.customer_stats(b.prior),
    "customer_segments": lambda b: reports.customer_segments(
        reports.customer_stats(b.prior), SEGMENTS
    ).select("user_id", "segment"),
    "segment_sizes": lambda b: _round(
        reports.segment_sizes(reports.customer_segments(reports.customer_stats(b.prior), SEGMENTS)),
        "percentage",
    ),
    "cross_category_orders": lambda b: _round(reports.cross_category_orders(b.prior), "percentage"),
    "department_pairs": lambda b: reports.department_pairs(b.prior),
    "department_pair_counts": lambda b: reports.department_pair_counts(b.prior),
    "mean_reorder_gap": lambda b: rates.mean_reorder_gap(
        b.rates["u_days_since_prior_order_reorder_rate"]
    ),
    "customer_lifetime": lambda b: reports.customer_lifetime(b.prior),
    "user_profile": lambda b: reports.user_profile(b.prior),
    "recommendation_metrics": lambda b: _round(
        reports.recommendation_metrics(b.prior, b.rates["hour_reorder_rate"]), "avg_hourly_reorder_rate"
    ),
    "business_summary": business_summary,
    "business_top_lists": business_top_lists,
}


def _over_folder(build):
    return lambda spark, sf_dir: build(open_baskets(spark, sf_dir))


QUERIES = {name: _over_folder(build) for name, build in BASKET_QUERIES.items()}
