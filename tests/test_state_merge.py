"""New lines go into old state by one aggregate."""

from trolley.operators import state


def test_lines_are_merged_into_state_at_once(spark):
    lines = spark.createDataFrame(
        [(1, "a", 1), (1, "a", None), (1, None, 0), (2, "b", None), (None, "c", 1)],
        "user_id long, product_name string, reordered int",
    )
    sums = state.NAME_STATE
    old = spark.createDataFrame([(1, "a", 5, 4, 2, 0), (3, "d", 1, 0, 0, None)], sums.schema)
    got = {(r["user_id"], r["product_name"]): tuple(r)[2:] for r in sums.merged(old, sums.per_line(lines)).collect()}
    assert got == {
        (1, "a"): (7, 5, 3, 1), (1, None): (1, 1, 0, 0), (2, "b"): (1, 0, 0, None), (3, "d"): (1, 0, 0, None),
    }
