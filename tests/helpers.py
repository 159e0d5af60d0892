"""Small frames and brute-force answers for the tests."""

COMBINED = (
    "order_id long, product_id long, add_to_cart_order int, reordered int, user_id long, "
    "eval_set string, order_number int, order_dow int, order_hour_of_day int, "
    "days_since_prior_order double, product_name string, aisle_id int, department_id int, "
    "aisle string, department string"
)


def combined(spark, rows, eval_set="prior"):
    """Combined lines from dicts; missing columns get plain defaults."""
    defaults = {
        "add_to_cart_order": 1, "reordered": 0, "eval_set": eval_set, "order_number": 1, "order_dow": 0,
        "order_hour_of_day": 0, "days_since_prior_order": None, "aisle_id": 1, "department_id": 1,
        "aisle": "aisle", "department": "department",
    }
    names = [part.split()[0] for part in COMBINED.split(", ")]
    full = []
    for row in rows:
        row = {**defaults, "product_name": f"product {row.get('product_id')}", **row}
        full.append(tuple(row[name] for name in names))
    return spark.createDataFrame(full, COMBINED)


def rows_of(df, *columns):
    """Sorted tuples of the chosen columns."""
    return sorted(
        (tuple(row) for row in df.select(*(columns or df.columns)).collect()),
        key=lambda row: tuple((value is not None, value) for value in row),
    )


def longest_run(flags):
    best = current = 0
    for flag in flags:
        current = current + 1 if flag == 1 else 0
        best = max(best, current)
    return best
