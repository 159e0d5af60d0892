"""Serving tables and batch recommendations for any number of users."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.functions.columns import week_day
from trolley.operators.models import score
from trolley.operators.rates import RATE_KEYS
from trolley.operators.training import assemble
from trolley.schema import LAST_PURCHASE_DATE, MODEL_FEATURES, PAIR_FEATURES
from trolley.sources.buckets import BUCKET, wanted_buckets
from trolley.sources.releases import NewRelease

# Serving tables with rows per user; a request for some users reads only their buckets.
USER_TABLES = ["user_product_snapshot", "user_last_purchase", *[n for n, k in RATE_KEYS.items() if k[0] == "user_id"]]


def _best(df, group, order, k, rank="rank"):
    """First ``k`` rows per group; Spark trims each map task's part to ``k`` first."""
    window = W.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def top_products_by_slot(prior, k=10):
    """The ``k`` most bought names per (day of week, hour), ties by name."""
    keys = ["order_dow", "order_hour_of_day"]
    counts = (
        prior.dropna(subset=[*keys, "product_name"])
        .groupBy(*keys, "product_name")
        .agg(F.count("*").alias("count"))
    )
    return _best(counts, keys, [F.desc("count"), "product_name"], k)


def user_last_purchase(train, date=LAST_PURCHASE_DATE, order_dates=None):
    """Distinct (user, train order) with a purchase date.

    Without ``order_dates`` (order_id, order_date) every row gets ``date``.
    """
    orders = train.select("user_id", "order_id").distinct()
    if order_dates is None:
        return orders.withColumn("date", F.lit(date).cast("date"))
    return orders.join(order_dates.withColumnRenamed("order_date", "date"), "order_id").select(
        "user_id", "order_id", "date"
    )


def product_map(products):
    """Product ids with their names."""
    return products.select("product_id", "product_name").distinct()


def user_product_snapshot(pairs):
    """Pair keys and pair features; context and rates are added when scoring."""
    return pairs.select("user_id", "product_id", *PAIR_FEATURES)


def scoring_contexts(last_purchase, as_of, max_gap=30):
    """Per user: day, hour and days since the last purchase at a given time.

    The data's gaps stop at ``max_gap``, which stands for it or more. Purchases
    after the given time and rows without a user are left out.
    """
    now = F.lit(as_of).cast("timestamp")
    gap = F.least(F.datediff(F.to_date(now), "date"), F.lit(max_gap))
    past = last_purchase.filter(F.col("user_id").isNotNull() & (F.col("date") <= F.to_date(now)))
    latest = past.groupBy("user_id").agg(F.max("date").alias("date"))
    return latest.select(
        "user_id",
        week_day(now).alias("order_dow"),
        F.hour(now).alias("order_hour_of_day"),
        gap.cast("double").alias("days_since_prior_order"),
    )


def context_features(snapshot, rates, last_purchase, as_of, max_gap=30):
    """The 13 model features of every candidate pair at a given time."""
    contexts = scoring_contexts(last_purchase, as_of, max_gap)
    return assemble(snapshot, contexts, rates).select("user_id", "product_id", *MODEL_FEATURES)


def top_scored(scored, products, k=10, probability="p"):
    """The ``k`` best products per user with rank and name, ties by product id."""
    best = _best(scored, ["user_id"], [F.desc(probability), "product_id"], k)
    return best.join(product_map(products), "product_id", "left").select(
        "user_id", "rank", "product_id", "product_name", F.col(probability).alias("score")
    )


def recommend(users, model, snapshot, rates, last_purchase, products, as_of, k=10, max_gap=30):
    """Best ``k`` products for each of the known users in one job.

    Only the users' own rows of the tables enter its joins.
    """
    wanted = last_purchase.join(users, "user_id", "left_semi")
    candidates = snapshot.join(users, "user_id", "left_semi")
    features = context_features(candidates, rates, wanted, as_of, max_gap)
    return top_scored(score(model, features), products, k)


def publish_serving(spark, tables, folder, n_buckets, models=(), save=None):
    """Commit a release of serving tables, those with rows per user by the user's bucket.

    ``models`` has (name, model) pairs that ``save`` (model, path) writes.
    """
    with NewRelease(spark, folder) as release:
        for name, df in tables.items():
            key = "user_id" if name in USER_TABLES else None
            release.write(name, df, key, n_buckets if key else None)
        for name, model in models:
            release.save(name, model, save)


def serving_table(release, name, users=None):
    """A published serving table; given ``users``, only the buckets that hold them are read.

    The buckets are a subquery over the users that runs before the scan opens a
    file, so the plan is the same for one user and for all.
    """
    rows = release.table(name)
    if name not in USER_TABLES:
        return rows
    if users is not None:
        wanted = wanted_buckets(users, "user_id", release.tables[name]["n_buckets"])
        rows = rows.filter(F.array_contains(wanted, F.col(BUCKET)))
    return rows.drop(BUCKET)


def served_features(release, users, as_of, max_gap=30):
    """The 13 features of the candidates of some users from a release, read by bucket.

    Users without a recorded purchase have none.
    """
    def table(name):
        rows = serving_table(release, name, users)
        return rows.join(users, "user_id", "left_semi") if name in USER_TABLES else rows

    rates = {name: table(name) for name in RATE_KEYS}
    return context_features(table("user_product_snapshot"), rates, table("user_last_purchase"), as_of, max_gap)


def serve(release, users, model, as_of, k=10, max_gap=30):
    """``recommend`` for some users from a release; only their buckets are read."""
    features = served_features(release, users.select("user_id").distinct(), as_of, max_gap)
    return top_scored(score(model, features), serving_table(release, "product_map"), k)


def slot_names(by_slot, as_of):
    """The slot's rows of ``top_products_by_slot`` for a given time."""
    now = F.lit(as_of).cast("timestamp")
    return by_slot.filter(
        (F.col("order_dow") == week_day(now)) & (F.col("order_hour_of_day") == F.hour(now))
    )


def recommend_new(by_slot, as_of):
    """The slot's popular names, numbered from 0."""
    return slot_names(by_slot, as_of).select((F.col("rank") - 1).alias("position"), "product_name")


def split_known(users, last_purchase):
    """(known, unknown) users: those with and without a recorded purchase."""
    ids = users.select("user_id").distinct()
    return (
        ids.join(last_purchase, "user_id", "left_semi"),
        ids.join(last_purchase, "user_id", "left_anti"),
    )


def cold_start(users, by_slot, as_of):
    """The slot's popular names for each user.

    The names, one short list bounded by the slot table's ``k``, are a scalar
    subquery, so the users are neither joined nor shuffled.
    """
    ranked = F.array_sort(F.collect_list(F.struct("rank", "product_name")))
    names = slot_names(by_slot, as_of).agg(ranked["product_name"].alias("names")).scalar()
    return users.select("user_id", F.posexplode(names).alias("position", "product_name")).select(
        "user_id", F.lit(True).alias("cold_start"), (F.col("position") + 1).alias("rank"), "product_name"
    )


def route(users, last_purchase, personal, by_slot, as_of):
    """Recommendations for all users: their own if known, else the slot's.

    ``personal`` is a ``recommend`` or ``top_scored`` result.
    """
    known, unknown = split_known(users, last_purchase)
    own = personal.join(known, "user_id", "left_semi").select(
        "user_id", F.lit(False).alias("cold_start"), "rank", "product_name"
    )
    return own.unionByName(cold_start(unknown, by_slot, as_of))


def user_most_reordered(prior, k=5):
    """Per user, the names reordered most often."""
    counts = (
        prior.filter(F.col("reordered") == 1).dropna(subset=["user_id", "product_name"])
        .groupBy("user_id", "product_name")
        .agg(F.count("*").alias("count"))
    )
    return _best(counts, ["user_id"], [F.desc("count"), "product_name"], k)


def popular_products(prior, k=10):
    """The ``k`` most bought names."""
    return (
        prior.filter(F.col("product_name").isNotNull())
        .groupBy("product_name")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "product_name")
        .limit(k)
    )
