"""Daily feature job: raw tables in, combined and feature tables out.

    python -m trolley.plans.features RAW_DIR PROCESSED_DIR [--format csv|parquet]
"""

import argparse

from trolley.operators.enrich import combine, enrich_products
from trolley.operators.pair import user_product_features
from trolley.operators.product import product_features
from trolley.operators.rates import rate_tables
from trolley.operators.training import feature_summary, final_features
from trolley.operators.user import user_features
from trolley.session import build_session
from trolley.sources.tables import load_tables, read_table, validate_tables, write_table


def run(spark, raw, processed, fmt="csv", flags=None):
    """Write every derived table below ``processed``; return the feature summary.

    Each table is read back from storage before it is used again, so the later
    steps neither recompute it nor depend on the executors that built it.
    """

    def stored(name, df):
        path = f"{processed}/{name}"
        write_table(df, path)
        return read_table(spark, path)

    tables = load_tables(spark, raw, fmt)
    validate_tables(tables)
    catalog = stored(
        "products_merged",
        enrich_products(tables["products"], tables["aisles"], tables["departments"]),
    )
    prior = stored("prior_combined", combine(tables["order_products_prior"], tables["orders"], catalog))
    stored("train_combined", combine(tables["order_products_train"], tables["orders"], catalog))
    products = stored("product_features", product_features(prior, catalog, flags))
    users = stored("user_features", user_features(prior))
    pairs = stored("user_product_features", user_product_features(prior))
    for name, rates in rate_tables(prior).items():
        stored(name, rates)
    final = stored("final_features", final_features(pairs, users, products))
    return stored("feature_summary", feature_summary(final))


def main(argv=None):
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("raw")
    parser.add_argument("processed")
    parser.add_argument("--format", default="csv", choices=("csv", "parquet"))
    args = parser.parse_args(argv)
    run(build_session("basket-features"), args.raw, args.processed, args.format).show(truncate=False)


if __name__ == "__main__":
    main()
