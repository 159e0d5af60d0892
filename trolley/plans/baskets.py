"""Basket tables of a star-schema folder, written once per application.

The derived tables live below the shared folder as Parquet, which cuts their
lineage: a lost executor costs its own tasks, not the whole derivation.
"""

import hashlib
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from trolley.operators.enrich import combine, enrich_products
from trolley.operators.pair import user_product_features
from trolley.operators.rates import RATE_KEYS, rate_table
from trolley.operators.training import split, training_set
from trolley.session import shared_dir, widen
from trolley.sources import star
from trolley.sources.tables import read_table, write_table

ROW_GROUP = 4 << 20


@dataclass
class Baskets:
    """Lazily derived tables; each is written on first use and read from then on."""

    spark: SparkSession
    source: str
    folder: str
    fitted: dict = field(default_factory=dict)  # models kept for the application
    _done: dict = field(default_factory=dict)

    def stored(self, name, build) -> DataFrame:
        """The table ``name``, built and written if this is its first use."""
        if name not in self._done:
            path = f"{self.folder}/{name}"
            # Small row groups, so that a scan can be split by its rows.
            write_table(build(), path, **{"parquet.block.size": ROW_GROUP})
            self._done[name] = read_table(self.spark, path)
        return self._done[name]

    def _star(self, name):
        return read_table(self.spark, f"{self.source}/{name}.parquet")

    @cached_property
    def numbered_orders(self):
        return self.stored("numbered_orders", lambda: star.numbered_orders(self._star("orders")))

    @cached_property
    def lines(self):
        placed = self.stored(
            "placed_lines",
            lambda: star.placed_lines(self._star("lineitem"), self.numbered_orders, self._star("part")),
        )
        first = self.stored("first_orders", lambda: star.first_orders(placed))
        return self.stored("lines", lambda: star.with_reordered(placed, first))

    @property
    def orders(self):
        return star.orders_table(self.numbered_orders)

    @property
    def order_dates(self):
        return self.numbered_orders.select("order_id", "order_date")

    @property
    def order_products_prior(self):
        return star.split_lines(self.lines, "prior")

    @property
    def order_products_train(self):
        return star.split_lines(self.lines, "train")

    @cached_property
    def products(self):
        return self.stored("products", lambda: star.products(self._star("part")))

    @cached_property
    def aisles(self):
        return self.stored("aisles", lambda: star.aisles(self._star("part")))

    @cached_property
    def departments(self):
        return self.stored("departments", lambda: star.departments(self._star("part")))

    @property
    def raw_tables(self):
        return {
            "orders": self.orders,
            "order_products_prior": self.order_products_prior,
            "order_products_train": self.order_products_train,
            "products": self.products,
            "aisles": self.aisles,
            "departments": self.departments,
        }

    @property
    def products_merged(self):
        return enrich_products(self.products, self.aisles, self.departments)

    @cached_property
    def prior(self):
        return self.stored(
            "prior_combined",
            lambda: combine(self.order_products_prior, self.orders, self.products_merged),
        )

    @cached_property
    def train(self):
        return self.stored(
            "train_combined",
            lambda: combine(self.order_products_train, self.orders, self.products_merged),
        )

    @cached_property
    def pairs(self):
        return self.stored("user_product_features", lambda: user_product_features(self.prior))

    @cached_property
    def rates(self):
        return {
            name: self.stored(name, lambda name=name: rate_table(self.prior, name))
            for name in RATE_KEYS
        }

    @cached_property
    def training_set(self):
        return self.stored(
            "training_set", lambda: training_set(self.pairs, self.train, self.rates)
        )

    @cached_property
    def parts(self):
        """(train, validation) rows; stored, as fits pass over them many times."""
        train, validation = split(self.training_set)
        return self.stored("train_part", lambda: train), self.stored("validation_part", lambda: validation)


_opened = {}


def open_baskets(spark, source):
    """The basket tables of a star-schema folder, shared within the application."""
    key = (spark.sparkContext.applicationId, source)
    if key not in _opened:
        digest = hashlib.sha1(source.encode()).hexdigest()[:12]
        folder = f"{shared_dir(spark)}/trolley/{key[0]}/{digest}"
        widen(spark, read_table(spark, f"{source}/lineitem.parquet").count())
        _opened[key] = Baskets(spark, source, folder)
    return _opened[key]
