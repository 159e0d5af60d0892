"""Feature assembly, the training set, its split and scaling."""

from dataclasses import dataclass

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.functions.columns import key_hash_below
from trolley.functions.joins import lookup_join, per_key
from trolley.operators.rates import attach_product_rates, attach_user_rate, pair_rates_at
from trolley.schema import LABEL, MODEL_FEATURES, SPLIT_SEED, SPLIT_SHARE

KEYS = ["user_id", "product_id"]


def final_features(pairs, users, products):
    """Pair features with the user's and the product's features."""
    with_users = lookup_join(
        pairs, users, ["user_id"], ["product_id"], weights=per_key(pairs, "user_id"), weight="n"
    )
    return lookup_join(
        with_users, products, ["product_id"], ["user_id"], weights=per_key(pairs, "product_id"), weight="n"
    )


def feature_summary(final):
    """One row: rows, features (columns but the two keys) and column names."""
    return final.agg(F.count("*").alias("total_rows")).select(
        "total_rows",
        F.lit(len(final.columns) - 2).alias("total_features"),
        F.lit(",".join(final.columns)).alias("columns"),
    )


def last_train_orders(train):
    """Highest train order id per user."""
    return train.dropna(subset=["user_id"]).groupBy("user_id").agg(F.max("order_id").alias("order_id"))


def order_details(train):
    """Distinct order context rows."""
    return train.select(
        "order_id", "order_dow", "order_hour_of_day", "days_since_prior_order"
    ).distinct()


def train_contexts(train):
    """Per user: last train order and its day, hour and gap."""
    return last_train_orders(train).join(order_details(train), "order_id")


def with_labels(pairs, train):
    """Pairs with the train basket's ``reordered``, 0.0 where not bought."""
    labels = train.select(*KEYS, F.col(LABEL).cast("double"))
    return pairs.join(labels, KEYS, "left").fillna(0.0, [LABEL])


def with_contexts(candidates, contexts):
    """Candidates of the users that have a context, with its columns.

    A user may hold many of the candidates.
    """
    return lookup_join(
        candidates, contexts, ["user_id"], ["product_id"],
        weights=per_key(candidates, "user_id"), weight="n", how="inner",
    )


def with_pair_rate(candidates, contexts, rates):
    """Candidates with the pair's rate at the context's day gap; 0 if none."""
    name = "days_since_prior_reorder_rate"
    return candidates.join(pair_rates_at(contexts, rates), KEYS, "left").fillna(0.0, [name])


def assemble(candidates, contexts, rates, train=None):
    """Candidates (keys and pair features) with context, rates and, given ``train``, labels.

    Joins are grouped by key, so candidates move once per key: by user, which
    also drops users without a context, by pair, and by product.
    """
    joined = with_contexts(candidates, attach_user_rate(contexts, rates))
    joined = with_pair_rate(joined, contexts, rates)
    if train is not None:
        joined = with_labels(joined, train)
    return attach_product_rates(joined, rates, weights=per_key(candidates, "product_id"))


def training_set(pairs, train, rates):
    """One row per pair of a user with a train order: keys, label, 13 features.

    Everything but the label and the order context comes from prior orders.
    Products first bought in the train order are not candidates.
    """
    assembled = assemble(pairs, train_contexts(train), rates, train)
    return assembled.select(*KEYS, "order_id", LABEL, *MODEL_FEATURES)


def label_distribution(df):
    """Rows and share per label value."""
    counts = df.groupBy(LABEL).agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy())  # over one row per label value
    return counts.select(LABEL, "n", (F.col("n").cast("double") / total).alias("share"))


def with_split(df, share=SPLIT_SHARE, seed=SPLIT_SEED):
    """Add ``split``: 'val' for about ``share`` of the pairs, else 'train'."""
    held_out = key_hash_below(share, seed, *KEYS)
    return df.withColumn("split", F.when(held_out, "val").otherwise("train"))


def split(df, share=SPLIT_SHARE, seed=SPLIT_SEED):
    """(train, validation) parts; a pair's part depends on its key only."""
    held_out = key_hash_below(share, seed, *KEYS)
    return df.filter(~held_out), df.filter(held_out)


BITS, STEP = 60, 10  # of the key hash, and those settled in a round


def _key_number(seed, *keys):
    """The first 60 bits of the MD5 hash of the keys."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def validation_limits(df, share=SPLIT_SHARE, seed=SPLIT_SEED, label=LABEL):
    """Per label, the number below which its keys' hashes make up round(share * n) of its rows.

    The limit is narrowed down ``STEP`` bits a round from counts of hashes by their
    next bits, so rows are counted and never sorted, and no task sees a whole label.
    What is broadcast has a row a label.
    Halves round up. Rows with equal keys share a side; only they can make a label
    exceed its share.
    """
    hashed = df.select(F.col(label).alias("label"), _key_number(seed, *KEYS).alias("h"))
    wanted = F.floor(F.count("*") * F.lit(share) + 0.5)
    limits = hashed.groupBy("label").agg(wanted.alias("wanted")).withColumn("low", F.lit(0).cast("long"))
    for shift in range(BITS - STEP, -1, -STEP):
        width = F.lit(1 << shift)
        inside = hashed.join(F.broadcast(limits.withColumnRenamed("label", "l")), F.col("label").eqNullSafe(F.col("l"))).filter(
            F.col("h").between(F.col("low"), F.col("low") + F.lit((1 << (shift + STEP)) - 1))
        )
        step = F.floor((F.col("h") - F.col("low")) / width)
        counts = inside.groupBy("label", "wanted", "low", step.alias("step")).agg(F.count("*").alias("n"))
        below = F.sum("n").over(W.partitionBy("label").orderBy("step").rowsBetween(W.unboundedPreceding, -1))
        placed = counts.withColumn("below", F.coalesce(below, F.lit(0)))  # at most 2^STEP rows a label
        last = F.max_by(F.struct("step", "below"), "step").alias("at")
        chosen = placed.filter(F.col("below") < F.col("wanted")).groupBy("label", "wanted", "low").agg(last)
        low = F.col("low") + (F.col("at.step") * width).cast("long")
        limits = chosen.select("label", (F.col("wanted") - F.col("at.below")).alias("wanted"), low.alias("low"))
    # The last row taken has this hash, so the limit lies one above; labels that want none have no limit.
    return limits.select("label", (F.col("low") + 1).alias("limit"))


def with_exact_split(df, share=SPLIT_SHARE, seed=SPLIT_SEED, label=LABEL):
    """Add ``split``: 'val' for exactly round(share * n) rows of each label, else 'train'."""
    limits = validation_limits(df, share, seed, label).select(F.col("label").alias("_label"), F.col("limit").alias("_limit"))
    held_out = _key_number(seed, *KEYS) < F.coalesce("_limit", F.lit(0))
    joined = df.join(F.broadcast(limits), F.col(label).eqNullSafe(F.col("_label")), "left")  # a row a label
    return joined.select(*df.columns, F.when(held_out, "val").otherwise("train").alias("split"))


def split_report(df):
    """Rows, positives and positive share per split of a ``with_split`` table."""
    return df.groupBy("split").agg(
        F.count("*").alias("n"),
        F.count_if(F.col(LABEL) == 1).alias("positives"),
        F.avg(LABEL).alias("positive_share"),
    )


@dataclass(frozen=True)
class Scaling:
    """Column means and population standard deviations."""

    means: dict
    deviations: dict

    def transform(self, df):
        """Standardise the columns; constant ones become 0."""
        return df.withColumns({
            name: (F.col(name) - F.lit(mean)) / F.lit(self.deviations[name] or 1.0)
            for name, mean in self.means.items()
        })


def fit_scaling(train, columns=MODEL_FEATURES):
    """Means and deviations of the train columns, gathered in one row."""
    row = train.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
    ).first()
    return Scaling(
        {c: row[f"mean_{c}"] for c in columns}, {c: row[f"std_{c}"] for c in columns}
    )


def scale(train, validation, columns=MODEL_FEATURES):
    """Both parts standardised with the train part's moments.

    A null feature stays null; a training set holds none but the gap of a
    user whose train order is the first one.
    """
    scaling = fit_scaling(train, columns)
    return scaling.transform(train), scaling.transform(validation)
