"""Refresh job: new order lines merged into bucketed feature tables.

    python -m trolley.plans.refresh FEATURE_DIR LINES_PARQUET BATCH [--buckets N]

``FEATURE_DIR`` holds the lines of all batches, the feature state, and the feature
and rate tables, each laid out by a bucket of its first key. A batch touches only
the buckets of its users and products: their state is merged with the state of the
new lines, and their features are made from it. Other buckets' files stay as they
are. A batch may hold any lines that were not in an earlier one, late ones too.

A batch is all or nothing. Its merged state is written beside the tables first;
only when that is complete are buckets replaced, from there, which can be done any
number of times. So a batch that broke off can be run again, and one that ended is
left alone. Batches are to be run one after the other.
"""

import argparse
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from trolley.operators import state
from trolley.operators.pair import PAIR
from trolley.operators.rates import RATE_KEYS
from trolley.session import build_session
from trolley.sources.buckets import (
    BUCKET, bucket_of, read_buckets, wanted_buckets, with_bucket, write_buckets,
)
from trolley.sources.tables import path_exists, read_table, remove_path, write_table

LINES = (
    "user_id long, product_id long, order_id long, product_name string, order_number int, reordered int, "
    "add_to_cart_order int, order_dow int, order_hour_of_day int, days_since_prior_order double"
)
SUM_STATES = {
    "user_state": state.USER_STATE, "name_state": state.NAME_STATE, "order_state": state.ORDER_STATE,
    **{f"{name}_state": sums for name, sums in state.RATE_STATES.items()},
}
# Tables that readers use -> their first key.
FEATURE_KEYS = {"user_product_features": "user_id", "user_features": "user_id", **{n: k[0] for n, k in RATE_KEYS.items()}}
N_BUCKETS = 64


def _names(schema):
    return [part.split()[0] for part in schema.split(", ")]


def _together(actions):
    """Run independent writes at the same time; the first error is raised."""
    with ThreadPoolExecutor(4) as pool:
        for done in [pool.submit(action) for action in actions]:
            done.result()


def bucket_count(spark, folder, n_buckets=N_BUCKETS):
    """The number of buckets of a feature folder, settled by its first batch."""
    path = f"{folder}/layout"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        write_table(spark.range(1).select(F.lit(n_buckets).alias("n_buckets")), path)
    return read_table(spark, path).first()["n_buckets"]


class Batch:
    """One batch of lines on its way into a feature folder."""

    def __init__(self, spark, folder, batch, n_buckets):
        self.spark, self.folder, self.batch = spark, folder, batch
        self.n_buckets = bucket_count(spark, folder, n_buckets)
        self.stage = f"{folder}/staged/{batch}"

    def table(self, name, schema, buckets=None):
        return read_buckets(self.spark, f"{self.folder}/{name}", f"{schema}, {BUCKET} int", buckets).drop(BUCKET)

    def staged(self, name):
        return read_table(self.spark, f"{self.stage}/{name}")

    def is_marked(self, kind):
        return path_exists(self.spark, f"{self.folder}/{kind}/{self.batch}/_SUCCESS")

    def mark(self, kind):
        write_table(self.spark.range(1), f"{self.folder}/{kind}/{self.batch}")

    def _put(self, name, df, key):
        write_table(with_bucket(df, key, self.n_buckets), f"{self.stage}/{name}")

    def _merged_sums(self, name, lines):
        sums = SUM_STATES[name]
        touched = wanted_buckets(lines.filter(F.col(sums.keys[0]).isNotNull()), sums.keys[0], self.n_buckets)
        old = self.table(name, sums.schema, touched)
        self._put(name, sums.merged(old, sums.per_line(lines)), sums.keys[0])

    def _merged_pairs(self, lines):
        touched = wanted_buckets(lines.dropna(subset=PAIR), "user_id", self.n_buckets)
        old = self.table("pair_state", state.PAIR_SCHEMA, touched)
        write_table(state.pair_state(lines), f"{self.stage}/new_pairs")
        new = self.staged("new_pairs")
        write_table(state.late_pairs(old, new), f"{self.stage}/late_pairs")
        late = self.staged("late_pairs")
        # The history of late pairs, from the lines of their users' buckets.
        at = wanted_buckets(late, "user_id", self.n_buckets)
        past = self.table("lines", f"{LINES}, batch string", at).filter(F.col("batch") != self.batch)
        theirs = past.select(_names(LINES)).unionByName(lines).join(late, PAIR, "left_semi")
        merged = state.merge_pairs(old.join(late, PAIR, "left_anti"), new.join(late, PAIR, "left_anti"))
        self._put("pair_state", merged.unionByName(state.pair_state(theirs)), "user_id")

    def prepare(self, lines):
        """Write the lines and the merged state of all touched buckets beside the tables."""
        self._put("lines", lines.select(_names(LINES)), "user_id")
        lines = self.staged("lines").drop(BUCKET)
        _together([
            lambda: self._merged_pairs(lines),
            *[lambda name=name: self._merged_sums(name, lines) for name in SUM_STATES],
        ])
        self.mark("ready")

    def replace(self):
        """Put the prepared state and the features that follow from it in place of the touched buckets."""
        pairs, users = self.staged("pair_state"), self.staged("user_state")
        names, orders = self.staged("name_state"), self.staged("order_state")
        made = {
            "user_product_features": state.pair_features(pairs, users), "user_features": state.user_features(names, orders),
            **{name: state.rate_from(self.staged(f"{name}_state"), name) for name in RATE_KEYS},
        }
        features = {name: with_bucket(df, FEATURE_KEYS[name], self.n_buckets) for name, df in made.items()}
        states = {name: self.staged(name) for name in ("pair_state", *SUM_STATES)}
        _together([
            *[lambda n=n, df=df: write_buckets(df, f"{self.folder}/{n}") for n, df in {**states, **features}.items()],
            lambda: write_buckets(self.staged("lines"), f"{self.folder}/lines", self.batch),
        ])
        self.mark("applied")
        remove_path(self.spark, self.stage)


def refresh(spark, folder, lines, batch, n_buckets=N_BUCKETS):
    """Merge a batch of combined prior lines into the tables below ``folder``.

    ``n_buckets`` counts for the first batch only. Returns False if the batch was
    already in.
    """
    work = Batch(spark, folder, batch, n_buckets)
    if work.is_marked("applied"):
        return False
    if not work.is_marked("ready"):
        work.prepare(lines)
    work.replace()
    return True


def refreshed(spark, folder, name, users=None):
    """A feature or rate table of a feature folder; with ``users``, only their buckets are read."""
    buckets = None
    if users is not None:
        buckets = wanted_buckets(users, FEATURE_KEYS[name], bucket_count(spark, folder))
    rows = read_table(spark, f"{folder}/{name}")
    return (rows if buckets is None else rows.filter(F.array_contains(buckets, F.col(BUCKET)))).drop(BUCKET)


def main(argv=None):
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("folder")
    parser.add_argument("lines", help="combined prior lines as Parquet")
    parser.add_argument("batch", help="name of the batch, such as its date")
    parser.add_argument("--buckets", type=int, default=N_BUCKETS)
    args = parser.parse_args(argv)
    spark = build_session("basket-refresh")
    done = refresh(spark, args.folder, read_table(spark, args.lines), args.batch, args.buckets)
    print("applied" if done else "was in already")


if __name__ == "__main__":
    main()
