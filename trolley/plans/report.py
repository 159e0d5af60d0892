"""Report job: processed tables in; exploration and business reports out.

    python -m trolley.plans.report PROCESSED_DIR REPORT_DIR
"""

import argparse

from trolley.operators import explore, rates, reports
from trolley.session import build_session
from trolley.sources.tables import read_table, write_table


def all_reports(prior, train, hour_rates, user_rates):
    """name -> DataFrame for every report over the combined lines.

    Reports that rest on per-user figures take them from one table.
    """
    stats = reports.customer_stats(prior)
    segments = reports.customer_segments(stats)
    return {
        "executive_kpis": reports.executive_kpis(prior, train),
        "hourly_pattern": reports.hourly_pattern(prior),
        "peak_hour": reports.peak_hour(prior),
        "daily_pattern": reports.daily_pattern(prior),
        "busiest_day": reports.busiest_day(prior),
        "gap_histogram": reports.gap_histogram(prior),
        "mean_reorder_cycle": reports.mean_reorder_cycle(prior),
        "basket_histogram": reports.basket_histogram(prior),
        "most_common_basket_size": reports.most_common_basket_size(prior),
        "department_performance": reports.department_performance(prior),
        "department_reorder_rank": reports.department_reorder_rank(prior),
        "top_products": reports.top_products(prior),
        "product_reorder_rank": reports.product_reorder_rank(prior),
        "customer_stats": stats,
        "customer_segments": segments,
        "segment_sizes": reports.segment_sizes(segments),
        "cross_category_orders": reports.cross_category_orders(prior),
        "department_pairs": reports.department_pairs(prior),
        "mean_reorder_gap": rates.mean_reorder_gap(user_rates),
        "customer_lifetime": reports.customer_lifetime(prior),
        "user_profile": reports.user_profile(prior),
        "recommendation_metrics": reports.recommendation_metrics(prior, hour_rates),
        "business_summary": reports.business_summary(prior, train),
        "top_aisles": explore.top_values(prior, "aisle"),
        "top_departments": explore.top_values(prior, "department"),
        "basket_sizes": explore.basket_sizes(prior),
        "prior_reorder_rate_by_name": explore.reorder_rate_by_name(prior),
        "train_reorder_rate_by_name": explore.reorder_rate_by_name(train),
        "train_favourites": explore.top_values(train, "product_name"),
        "missing_values": explore.missing_values(prior),
        "target_distribution": explore.target_distribution(Prior=prior, Train=train),
        "dataset_profile": explore.dataset_profile({"prior": prior, "train": train}),
    }


def run(spark, processed, output):
    """Write every report below ``output``; return the names written."""

    def table(name):
        return read_table(spark, f"{processed}/{name}")

    frames = all_reports(
        table("prior_combined"), table("train_combined"), table("hour_reorder_rate"),
        table("u_days_since_prior_order_reorder_rate"),
    )
    for name, df in frames.items():
        write_table(df, f"{output}/{name}")
    return list(frames)


def main(argv=None):
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("processed")
    parser.add_argument("output")
    args = parser.parse_args(argv)
    print("\n".join(run(build_session("basket-reports"), args.processed, args.output)))


if __name__ == "__main__":
    main()
