"""Recommendation job: a table of user ids in, their top products out.

    python -m trolley.plans.serve TRAINING_OUTPUT_DIR USERS_PARQUET RESULT_DIR [--as-of TIMESTAMP] [-k N]
"""

import argparse
from datetime import datetime, timezone

from trolley.operators.models import load_model
from trolley.operators.recommend import route, serve, serving_table
from trolley.session import build_session
from trolley.sources.releases import Release
from trolley.sources.tables import read_table, write_table


def run(spark, trained, users, as_of, k=10, max_gap=30):
    """Recommendations for every user in ``users`` (user_id) at ``as_of``.

    Tables and model are those of the newest release. Of the tables with rows per
    user, only the buckets of these users are read.
    """
    release = Release(spark, f"{trained}/serving")
    personal = serve(release, users, load_model(spark, release.models["served"]), as_of, k, max_gap)
    last_purchase = serving_table(release, "user_last_purchase", users)
    return route(users, last_purchase, personal, serving_table(release, "slot_products"), as_of)


def main(argv=None):
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("trained")
    parser.add_argument("users")
    parser.add_argument("result")
    parser.add_argument("--as-of")
    parser.add_argument("-k", type=int, default=10)
    args = parser.parse_args(argv)
    spark = build_session("basket-recommendations")
    as_of = args.as_of or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    users = read_table(spark, args.users)
    write_table(run(spark, args.trained, users, as_of, args.k), args.result)


if __name__ == "__main__":
    main()
