"""SQL twins of the registered queries, written from their definitions."""

from checks.base_sql import BASE
from trolley.schema import MODEL_FEATURES

AS_OF = "TIMESTAMP '2001-08-02 14:00:00'"

PAIRS = """,
pair_rows AS (SELECT user_id, product_id, count(*) AS n, sum(reordered) AS r,
                     avg(add_to_cart_order) AS pos, max(order_number) AS last
              FROM pc GROUP BY 1, 2),
user_rows AS (SELECT user_id, count(*) AS n, max(order_number) AS last FROM pc GROUP BY 1),
sequence AS (SELECT user_id, product_id, reordered,
                    row_number() OVER (PARTITION BY user_id, product_id ORDER BY order_number, order_id) AS i
             FROM pc),
islands AS (SELECT user_id, product_id,
                   i - row_number() OVER (PARTITION BY user_id, product_id ORDER BY i) AS island
            FROM sequence WHERE reordered = 1),
streaks AS (SELECT user_id, product_id, max(n) AS max_streak
            FROM (SELECT user_id, product_id, island, count(*) AS n FROM islands GROUP BY 1, 2, 3)
            GROUP BY 1, 2),
up AS (SELECT p.user_id, p.product_id,
              CAST(p.n AS DOUBLE) / u.n AS u_p_order_rate,
              CAST(p.r AS DOUBLE) / p.n AS u_p_reorder_rate,
              p.pos AS u_p_avg_position,
              CAST(u.last - p.last AS INTEGER) AS u_p_orders_since_last,
              CAST(coalesce(s.max_streak, 0) AS INTEGER) AS max_streak
       FROM pair_rows p JOIN user_rows u USING (user_id) LEFT JOIN streaks s USING (user_id, product_id))
"""

RATES = """,
hr AS (SELECT product_id, order_hour_of_day, avg(reordered) AS hour_reorder_rate FROM pc GROUP BY 1, 2),
dr AS (SELECT product_id, order_dow, avg(reordered) AS day_reorder_rate FROM pc GROUP BY 1, 2),
pr AS (SELECT product_id, days_since_prior_order, avg(reordered) AS p_days_since_prior_order_reorder_rate
       FROM pc WHERE days_since_prior_order IS NOT NULL GROUP BY 1, 2),
ur AS (SELECT user_id, days_since_prior_order, avg(reordered) AS u_days_since_prior_order_reorder_rate
       FROM pc WHERE days_since_prior_order IS NOT NULL GROUP BY 1, 2),
upr AS (SELECT user_id, product_id, days_since_prior_order, avg(reordered) AS days_since_prior_reorder_rate
        FROM pc WHERE days_since_prior_order IS NOT NULL GROUP BY 1, 2, 3)
"""

TRAINING = PAIRS + RATES + """,
last_orders AS (SELECT user_id, max(order_id) AS order_id FROM tc GROUP BY 1),
details AS (SELECT DISTINCT order_id, order_dow, order_hour_of_day, days_since_prior_order FROM tc),
training AS (
  SELECT up.user_id, up.product_id, lo.order_id, CAST(coalesce(tc.reordered, 0) AS DOUBLE) AS reordered,
         u_p_order_rate, u_p_reorder_rate, u_p_avg_position, u_p_orders_since_last, max_streak,
         d.order_dow, d.order_hour_of_day, d.days_since_prior_order,
         coalesce(hour_reorder_rate, 0.0) AS hour_reorder_rate,
         coalesce(day_reorder_rate, 0.0) AS day_reorder_rate,
         coalesce(p_days_since_prior_order_reorder_rate, 0.0) AS p_days_since_prior_order_reorder_rate,
         coalesce(u_days_since_prior_order_reorder_rate, 0.0) AS u_days_since_prior_order_reorder_rate,
         coalesce(days_since_prior_reorder_rate, 0.0) AS days_since_prior_reorder_rate
  FROM up LEFT JOIN tc ON tc.user_id = up.user_id AND tc.product_id = up.product_id
  JOIN last_orders lo ON lo.user_id = up.user_id
  JOIN details d ON d.order_id = lo.order_id
  LEFT JOIN hr ON hr.product_id = up.product_id AND hr.order_hour_of_day = d.order_hour_of_day
  LEFT JOIN dr ON dr.product_id = up.product_id AND dr.order_dow = d.order_dow
  LEFT JOIN pr ON pr.product_id = up.product_id AND pr.days_since_prior_order = d.days_since_prior_order
  LEFT JOIN ur ON ur.user_id = up.user_id AND ur.days_since_prior_order = d.days_since_prior_order
  LEFT JOIN upr ON upr.user_id = up.user_id AND upr.product_id = up.product_id
                AND upr.days_since_prior_order = d.days_since_prior_order)
"""

USER_FEATURES = """,
uf AS (
  SELECT user_id, avg(reordered) AS user_reorder_rate,
         count(DISTINCT product_name) AS user_unique_products,
         count(*) AS user_total_products,
         CAST(count(*) AS DOUBLE) / count(DISTINCT order_id) AS user_avg_cart_size,
         max(mean_gap) AS user_avg_days_between_orders,
         CAST(count(DISTINCT CASE WHEN reordered = 1 THEN product_name END) AS DOUBLE)
           / count(DISTINCT product_name) AS user_reordered_products_ratio
  FROM pc JOIN (SELECT user_id, avg(gap) AS mean_gap
                FROM (SELECT user_id, order_id, max(days_since_prior_order) AS gap FROM pc GROUP BY 1, 2)
                GROUP BY 1) g USING (user_id)
  GROUP BY 1)
"""

PRODUCT_FEATURES = """,
pf AS (
  SELECT product_id, product_reorder_rate, avg_pos_incart, aisle_reorder_rate, department_reorder_rate
  FROM (SELECT product_id, avg(reordered) AS product_reorder_rate, avg(add_to_cart_order) AS avg_pos_incart
        FROM pc GROUP BY 1)
  JOIN products USING (product_id)
  JOIN (SELECT aisle_id, avg(reordered) AS aisle_reorder_rate FROM pc GROUP BY 1) USING (aisle_id)
  JOIN (SELECT department_id, avg(reordered) AS department_reorder_rate FROM pc GROUP BY 1)
    USING (department_id))
"""

SLOTS = """,
slots AS (
  SELECT * FROM (
    SELECT order_dow, order_hour_of_day, product_name, count(*) AS count,
           CAST(row_number() OVER (PARTITION BY order_dow, order_hour_of_day
                                   ORDER BY count(*) DESC, product_name) AS INTEGER) AS rank
    FROM pc GROUP BY 1, 2, 3) WHERE rank <= 10)
"""

LAST_PURCHASE = """,
last_purchase AS (
  SELECT DISTINCT tc.user_id, tc.order_id, CAST(o_orderdate AS DATE) AS date
  FROM tc JOIN orders ON o_orderkey = tc.order_id)
"""

SPLIT = "CASE WHEN substr(md5(concat_ws('|', user_id, product_id, '42')), 1, 8) < '33333333' THEN 'val' ELSE 'train' END"

CUSTOMERS = """,
cs AS (
  SELECT user_id, count(DISTINCT order_id) AS total_orders, count(*) AS total_items,
         round_even(avg(reordered), 3) AS avg_reorder_rate,
         CAST(count(*) AS DOUBLE) / count(DISTINCT order_id) AS avg_basket_size
  FROM pc GROUP BY 1),
sg AS (
  SELECT user_id, CASE WHEN total_orders >= 12 AND avg_basket_size >= 4 THEN 'VIP Customers'
                       WHEN total_orders >= 8 AND avg_reorder_rate >= 0.2 THEN 'Loyal Customers'
                       WHEN total_orders >= 5 THEN 'Regular Customers' ELSE 'New Customers' END AS segment
  FROM cs)
"""

TOP_BY_RATE = """,
ranked AS (
  SELECT user_id, product_id, u_p_order_rate AS score,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY u_p_order_rate DESC, product_id) AS INTEGER)
           AS rank
  FROM up WHERE user_id IN (SELECT user_id FROM last_purchase)),
best AS (SELECT user_id, rank, product_id, product_name, score
         FROM ranked JOIN products USING (product_id) WHERE rank <= 10)
"""


def _histogram(source, column, bins):
    """Equal-width bins by arithmetic, last one closed; empty bins count 0."""
    return f""",
source AS ({source}),
bounds AS (
  SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi
  FROM (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM source)),
binned AS (
  SELECT least(CAST(floor(({column} - lo) / ((hi - lo) / {bins})) AS INTEGER), {bins - 1}) AS bin, count(*) AS n
  FROM source, bounds WHERE {column} IS NOT NULL GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin,
       round(lo + (b.bin + 0.5) * ((hi - lo) / {bins}), 6) AS bin_centre,
       coalesce(n, 0) AS n
FROM (SELECT unnest(range({bins})) AS bin) b CROSS JOIN bounds LEFT JOIN binned ON binned.bin = b.bin
"""


def _value_counts(source, column, limit=None):
    tail = f" ORDER BY n DESC, {column} LIMIT {limit}" if limit else ""
    return f"SELECT {column}, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1{tail}"


def _title(column):
    words = f"string_split(lower({column}), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


_scaled = ", ".join(
    f"round((v.{c} - m.m_{c}) / CASE WHEN m.s_{c} = 0 THEN 1 ELSE m.s_{c} END, 6) AS {c}"
    for c in MODEL_FEATURES
)
_moments = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in MODEL_FEATURES)
_nulls = {c: f"count(*) - count({c})" for c in (
    "order_id", "product_id", "add_to_cart_order", "reordered", "user_id", "eval_set", "order_number",
    "order_dow", "order_hour_of_day", "days_since_prior_order", "product_name", "aisle_id",
    "department_id", "aisle", "department",
)}
_COMBINED = ", ".join(_nulls)


def _profile(name, table, columns):
    nulls = " + ".join(f"count(*) - count({c})" for c in columns)
    return (
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, {len(columns)} AS n_columns, "
        f"'{','.join(columns)}' AS column_names, {nulls} AS n_missing FROM {table}"
    )


_UP_COLUMNS = ["user_id", "product_id", *MODEL_FEATURES[:5]]
_SIZES = "SELECT '{0}' AS table_name, count(*) AS n_rows, {2} AS n_columns FROM {1}"

_fixed = "(u_p_reorder_rate + hour_reorder_rate + 0.1) / 2.2"

_KPIS = """
  (SELECT count(DISTINCT order_id) FROM pc) + (SELECT count(DISTINCT order_id) FROM tc) AS total_orders,
  (SELECT count(DISTINCT user_id) FROM pc) AS unique_users,
  (SELECT count(DISTINCT product_id) FROM pc) AS unique_products,
  (SELECT avg(reordered) FROM pc) AS avg_reorder_rate,
  (SELECT avg(n) FROM (SELECT count(*) AS n FROM pc GROUP BY order_id)) AS avg_basket_size,
  (SELECT count(*) FROM pc) + (SELECT count(*) FROM tc) AS total_items"""

_FINAL_COLUMNS = [
    *_UP_COLUMNS, "user_reorder_rate", "user_unique_products", "user_total_products",
    "user_avg_cart_size", "user_avg_days_between_orders", "user_reordered_products_ratio",
    "product_reorder_rate", "avg_pos_incart", "aisle_reorder_rate", "department_reorder_rate",
]

_BODIES = {
    "load_tables": """SELECT order_id, product_id, add_to_cart_order, reordered, user_id, eval_set,
        order_number, order_dow, order_hour_of_day, days_since_prior_order FROM combined""",
    "validate_tables": " UNION ALL ".join(
        _SIZES.format(*t) for t in (
            ("orders", "order_table", 7), ("order_products_prior", "pc", 4),
            ("order_products_train", "tc", 4), ("products", "products", 4),
            ("aisles", "(SELECT DISTINCT aisle FROM products_merged)", 2),
            ("departments", "(SELECT DISTINCT department FROM products_merged)", 2),
        )
    ),
    "optional_table": _SIZES.format("customer", "customer", 5),
    "processed_table": PRODUCT_FEATURES + "SELECT * FROM pf",
    "read_prefix": "SELECT * FROM products",
    "publish_serving_tables": PAIRS + RATES + SLOTS + LAST_PURCHASE + " UNION ALL ".join(
        _SIZES.format(*t) for t in (
            ("slot_products", "slots", 5), ("user_last_purchase", "last_purchase", 3),
            ("hour_reorder_rate", "hr", 3), ("day_reorder_rate", "dr", 3),
            ("p_days_since_prior_order_reorder_rate", "pr", 3),
            ("u_days_since_prior_order_reorder_rate", "ur", 3),
            ("days_since_prior_reorder_rate", "upr", 4),
            ("user_product_snapshot", "up", 7), ("product_map", "products", 2),
        )
    ),
    "product_labels": f"""SELECT product_id, {_title('product_name')} AS product_label,
        {_title('department')} AS department_label FROM products_merged""",
    "order_clock": f"""SELECT order_id, CAST(dayofweek(order_date) AS INTEGER) AS dow,
        CAST(hour({AS_OF}) AS INTEGER) AS hour_now, CAST(dayofweek({AS_OF}) AS INTEGER) AS dow_now,
        CAST(datediff('day', order_date, CAST({AS_OF} AS DATE)) AS INTEGER) AS day_gap
        FROM ranked_orders""",
    "sentinel_aisle": "SELECT * FROM products_merged WHERE aisle = 'ring'",
    "impute_first_gap": """SELECT order_id, product_id,
        coalesce(days_since_prior_order, 0.0) AS days_since_prior_order FROM pc""",
    "enrich_products": "SELECT * FROM products_merged",
    "prior_combined": "SELECT * FROM pc",
    "train_combined": "SELECT * FROM tc",
    "train_products": """SELECT order_id, product_id, add_to_cart_order, reordered, product_name,
        aisle_id, department_id, aisle, department FROM tc""",
    "final_features": PAIRS + USER_FEATURES + PRODUCT_FEATURES
        + "SELECT * FROM up JOIN uf USING (user_id) JOIN pf USING (product_id)",
    "labelled_pairs": """SELECT user_id, product_id, CAST(coalesce(reordered, 0) AS DOUBLE) AS reordered
        FROM (SELECT DISTINCT user_id, product_id FROM pc)
        LEFT JOIN (SELECT user_id, product_id, reordered FROM tc) USING (user_id, product_id)""",
    "train_contexts": """SELECT DISTINCT user_id, order_id, order_dow, order_hour_of_day,
        days_since_prior_order FROM tc
        WHERE order_id IN (SELECT max(order_id) FROM tc GROUP BY user_id)""",
    "product_reorder_rate": """SELECT product_id, CAST(sum(reordered) AS DOUBLE) / count(*)
        AS product_reorder_rate FROM pc GROUP BY 1""",
    "average_cart_position": "SELECT product_id, avg(add_to_cart_order) AS avg_pos_incart FROM pc GROUP BY 1",
    "category_flags": """SELECT product_id, CAST(product_name ILIKE '%large%' AS INTEGER) AS name_large,
        CAST(aisle_id = 10 AS INTEGER) AS aisle_10, """ + ", ".join(
        f"CAST(department_id = {i} AS INTEGER) AS department_{i}" for i in (0, 2, 5, 6, 11, 12)
    ) + " FROM products",
    "reduced_feature_norms": """SELECT product_id, CAST(CASE WHEN product_name ILIKE '%large%'
        OR aisle_id = 10 OR department_id IN (0, 2, 5, 6, 11, 12) THEN 1 ELSE 0 END AS DOUBLE) AS norm
        FROM products""",
    "aisle_reorder_rate": """SELECT aisle_id, count(*) AS total_orders, CAST(sum(reordered) AS BIGINT)
        AS reorders, avg(reordered) AS aisle_reorder_rate FROM pc GROUP BY 1""",
    "department_reorder_rate": """SELECT department_id, count(*) AS total_orders,
        CAST(sum(reordered) AS BIGINT) AS reorders, avg(reordered) AS department_reorder_rate
        FROM pc GROUP BY 1""",
    "product_statistics": PRODUCT_FEATURES + "SELECT * FROM pf",
    "user_reorder_rate": "SELECT user_id, avg(reordered) AS user_reorder_rate FROM pc GROUP BY 1",
    "user_unique_products": """SELECT user_id, count(DISTINCT product_name) AS user_unique_products
        FROM pc GROUP BY 1""",
    "user_total_products": "SELECT user_id, count(*) AS user_total_products FROM pc GROUP BY 1",
    "user_average_cart_size": USER_FEATURES + "SELECT user_id, user_avg_cart_size FROM uf",
    "user_average_days_between_orders": USER_FEATURES
        + "SELECT user_id, user_avg_days_between_orders FROM uf",
    "user_reordered_products_ratio": USER_FEATURES + "SELECT user_id, user_reordered_products_ratio FROM uf",
    "user_features": USER_FEATURES + "SELECT * FROM uf",
    "interaction_counts": "SELECT user_id, product_id, count(*) AS interaction_count FROM pc GROUP BY 1, 2",
    "pair_order_rate": PAIRS + "SELECT user_id, product_id, u_p_order_rate FROM up",
    "pair_reorder_rate": PAIRS + "SELECT user_id, product_id, u_p_reorder_rate FROM up",
    "pair_average_position": PAIRS + "SELECT user_id, product_id, u_p_avg_position FROM up",
    "pair_orders_since_last": PAIRS + "SELECT user_id, product_id, u_p_orders_since_last FROM up",
    "pair_max_streak": PAIRS + "SELECT user_id, product_id, max_streak FROM up",
    "user_product_features": PAIRS + "SELECT * FROM up",
    "hour_reorder_rate": RATES + "SELECT * FROM hr",
    "day_reorder_rate": RATES + "SELECT * FROM dr",
    "p_days_since_prior_order_reorder_rate": RATES + "SELECT * FROM pr",
    "u_days_since_prior_order_reorder_rate": RATES + "SELECT * FROM ur",
    "days_since_prior_reorder_rate": RATES + "SELECT * FROM upr",
    "hour_profile": RATES + """SELECT order_hour_of_day, round(avg(hour_reorder_rate), 6)
        AS mean_hour_reorder_rate FROM hr GROUP BY 1""",
    "day_profile": RATES + """SELECT order_dow, round(avg(day_reorder_rate), 6)
        AS mean_day_reorder_rate FROM dr GROUP BY 1""",
    "gap_profile": RATES + """SELECT days_since_prior_order, round(avg(days_since_prior_reorder_rate), 6)
        AS mean_days_since_prior_reorder_rate FROM upr GROUP BY 1 ORDER BY 1 LIMIT 30""",
    "order_rate_histogram": PAIRS + _histogram("SELECT u_p_order_rate FROM up", "u_p_order_rate", 50),
    "feature_summary": PAIRS + f"""SELECT count(*) AS total_rows, {len(_FINAL_COLUMNS) - 2}
        AS total_features, '{",".join(_FINAL_COLUMNS)}' AS columns FROM up""",
    "last_train_orders": "SELECT user_id, max(order_id) AS order_id FROM tc GROUP BY 1",
    "order_details": """SELECT DISTINCT order_id, order_dow, order_hour_of_day, days_since_prior_order
        FROM tc""",
    "training_set": TRAINING + "SELECT * FROM training",
    "label_distribution": TRAINING + """SELECT reordered, count(*) AS n,
        CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM training) AS share FROM training GROUP BY 1""",
    "split_rows": TRAINING + f"SELECT user_id, product_id, {SPLIT} AS split FROM training",
    "scaled_validation": TRAINING + f""",
        parts AS (SELECT *, {SPLIT} AS split FROM training),
        m AS (SELECT {_moments} FROM parts WHERE split = 'train')
        SELECT user_id, product_id, {_scaled} FROM parts v, m WHERE split = 'val'""",
    "split_report": TRAINING + f"""SELECT {SPLIT} AS split, count(*) AS n,
        CAST(sum(reordered) AS BIGINT) AS positives, avg(reordered) AS positive_share
        FROM training GROUP BY 1""",
    "log_loss": TRAINING + f"""SELECT round(-avg(reordered * ln({_fixed})
        + (1 - reordered) * ln(1 - {_fixed})), 6) AS log_loss FROM training""",
    "accuracy": TRAINING + f"""SELECT CAST(sum(CASE WHEN ({_fixed} >= 0.5) = (reordered = 1) THEN 1 ELSE 0 END)
        AS DOUBLE) / count(*) AS accuracy FROM training""",
    "saved_model_agreement": TRAINING + f"""SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_different
        FROM training WHERE {SPLIT} = 'val'""",
    "recommendation_counts": """SELECT user_id, least(10, count(DISTINCT product_id)) AS n,
        least(10, count(DISTINCT product_id)) AS n_products,
        CAST(least(10, count(DISTINCT product_id)) AS INTEGER) AS last_rank
        FROM pc WHERE user_id IN (SELECT user_id FROM tc) GROUP BY 1""",
    "known_users": """SELECT c_custkey AS user_id, c_custkey IN (SELECT user_id FROM tc) AS known
        FROM customer""",
    "slot_products": SLOTS + "SELECT * FROM slots",
    "user_last_purchase": "SELECT DISTINCT user_id, order_id, DATE '2021-03-21' AS date FROM tc",
    "user_last_purchase_dates": LAST_PURCHASE + "SELECT * FROM last_purchase",
    "product_map": "SELECT DISTINCT product_id, product_name FROM products",
    "user_product_snapshot": PAIRS + "SELECT * FROM up",
    "context_features": PAIRS + RATES + LAST_PURCHASE + f""",
        ctx AS (SELECT user_id, 4 AS order_dow, 14 AS order_hour_of_day,
                CAST(least(datediff('day', date, CAST({AS_OF} AS DATE)), 30) AS DOUBLE) AS days_since_prior_order
                FROM last_purchase)
        SELECT up.*, CAST(ctx.order_dow AS INTEGER) AS order_dow,
          CAST(ctx.order_hour_of_day AS INTEGER) AS order_hour_of_day, ctx.days_since_prior_order,
          coalesce(hour_reorder_rate, 0.0) AS hour_reorder_rate,
          coalesce(day_reorder_rate, 0.0) AS day_reorder_rate,
          coalesce(p_days_since_prior_order_reorder_rate, 0.0) AS p_days_since_prior_order_reorder_rate,
          coalesce(u_days_since_prior_order_reorder_rate, 0.0) AS u_days_since_prior_order_reorder_rate,
          coalesce(days_since_prior_reorder_rate, 0.0) AS days_since_prior_reorder_rate
        FROM up JOIN ctx ON ctx.user_id = up.user_id
        LEFT JOIN hr ON hr.product_id = up.product_id AND hr.order_hour_of_day = 14
        LEFT JOIN dr ON dr.product_id = up.product_id AND dr.order_dow = 4
        LEFT JOIN pr ON pr.product_id = up.product_id AND pr.days_since_prior_order = ctx.days_since_prior_order
        LEFT JOIN ur ON ur.user_id = up.user_id AND ur.days_since_prior_order = ctx.days_since_prior_order
        LEFT JOIN upr ON upr.user_id = up.user_id AND upr.product_id = up.product_id
                      AND upr.days_since_prior_order = ctx.days_since_prior_order""",
    "best_by_order_rate": PAIRS + LAST_PURCHASE + TOP_BY_RATE + "SELECT * FROM best",
    "routed_recommendations": PAIRS + LAST_PURCHASE + TOP_BY_RATE + SLOTS + """
        SELECT user_id, false AS cold_start, rank, product_name FROM best
        UNION ALL
        SELECT c_custkey, true, rank, product_name FROM customer, slots
        WHERE c_custkey NOT IN (SELECT user_id FROM last_purchase)
          AND order_dow = 4 AND order_hour_of_day = 14""",
    "recommend_new": SLOTS + """SELECT CAST(rank - 1 AS INTEGER) AS position, product_name FROM slots
        WHERE order_dow = 4 AND order_hour_of_day = 14""",
    "user_most_reordered": """SELECT * FROM (
          SELECT user_id, product_name, count(*) AS count,
                 CAST(row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, product_name)
                      AS INTEGER) AS rank
          FROM pc WHERE reordered = 1 GROUP BY 1, 2) WHERE rank <= 5""",
    "popular_products": """SELECT product_name, count(*) AS count FROM pc GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 8""",
    "products_per_department": _value_counts("products_merged", "department"),
    "products_per_aisle": _value_counts("products_merged", "aisle"),
    "orders_by_hour": _value_counts("order_table", "order_hour_of_day"),
    "orders_by_day": _value_counts("order_table", "order_dow"),
    "orders_by_gap": _value_counts("order_table", "days_since_prior_order"),
    "train_favourites": _value_counts("tc", "product_name", 10),
    "orders_per_user": "SELECT user_id, max(order_number) AS n_orders FROM order_table GROUP BY 1",
    "order_count_range": """SELECT min(n) AS min_orders, max(n) AS max_orders
        FROM (SELECT max(order_number) AS n FROM order_table GROUP BY user_id)""",
    "orders_per_user_histogram": _histogram(
        "SELECT max(order_number) AS n FROM order_table GROUP BY user_id", "source.n", 30
    ),
    "train_reorder_rate_by_name": "SELECT product_name, avg(reordered) AS reorder_rate FROM tc GROUP BY 1",
    "prior_reorder_rate_by_name": """SELECT product_name, avg(reordered) AS reorder_rate FROM pc GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 10""",
    "basket_sizes": "SELECT order_id, count(product_id) AS basket_size FROM pc GROUP BY 1",
    "average_basket_size": """SELECT CAST(count(*) AS DOUBLE) / count(DISTINCT order_id) AS avg_cart_size
        FROM pc""",
    "cart_size_histogram": _histogram("SELECT count(*) AS size FROM pc GROUP BY order_id", "size", 40),
    "top_aisles": _value_counts("pc", "aisle", 10),
    "top_departments": _value_counts("pc", "department", 10),
    "missing_values": "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {n} AS n_missing FROM pc" for c, n in _nulls.items()
    ) + ") WHERE n_missing > 0",
    "missing_total": TRAINING + "SELECT " + " + ".join(
        f"count(*) - count({c})" for c in ["user_id", "product_id", "order_id", "reordered", *MODEL_FEATURES]
    ) + " AS n_missing FROM training",
    "target_distribution": """SELECT 'Prior' AS dataset, reordered, CAST(count(*) AS DOUBLE)
        / (SELECT count(*) FROM pc) AS percentage FROM pc GROUP BY reordered
        UNION ALL SELECT 'Train', reordered, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM tc)
        FROM tc GROUP BY reordered""",
    "distinct_users": "SELECT count(DISTINCT o_custkey) AS total_users FROM orders",
    "dataset_profile": PAIRS + RATES + " UNION ALL ".join([
        _profile("prior_combined", "pc", list(_nulls)),
        _profile("train_combined", "tc", list(_nulls)),
        _profile("user_product_features", "up", _UP_COLUMNS),
        _profile("hour_reorder_rate", "hr", ["product_id", "order_hour_of_day", "hour_reorder_rate"]),
        _profile("day_reorder_rate", "dr", ["product_id", "order_dow", "day_reorder_rate"]),
        _profile(
            "p_days_since_prior_order_reorder_rate", "pr",
            ["product_id", "days_since_prior_order", "p_days_since_prior_order_reorder_rate"],
        ),
        _profile(
            "u_days_since_prior_order_reorder_rate", "ur",
            ["user_id", "days_since_prior_order", "u_days_since_prior_order_reorder_rate"],
        ),
        _profile(
            "days_since_prior_reorder_rate", "upr",
            ["user_id", "product_id", "days_since_prior_order", "days_since_prior_reorder_rate"],
        ),
    ]),
    "first_rows": "SELECT * FROM pc ORDER BY order_id, product_id LIMIT 3",
    "executive_kpis": f"SELECT {_KPIS}",
    "hourly_pattern": "SELECT order_hour_of_day, count(*) AS n FROM pc GROUP BY 1",
    "peak_hour": """SELECT order_hour_of_day, count(*) AS n FROM pc GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 1""",
    "daily_pattern": """SELECT order_dow, count(*) AS n,
        ['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][order_dow + 1] AS day
        FROM pc GROUP BY 1""",
    "busiest_day": """SELECT order_dow, count(*) AS n,
        ['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][order_dow + 1] AS day
        FROM pc GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    "gap_histogram": _histogram("SELECT coalesce(days_since_prior_order, 0.0) AS gap FROM pc", "gap", 30),
    "mean_reorder_cycle": """SELECT avg(days_since_prior_order) AS avg_days_between FROM pc
        WHERE days_since_prior_order > 0""",
    "basket_histogram": _histogram("SELECT count(*) AS size FROM pc GROUP BY order_id", "size", 30),
    "most_common_basket_size": """SELECT basket_size, count(*) AS n_orders
        FROM (SELECT count(*) AS basket_size FROM pc GROUP BY order_id) GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 1""",
    "department_performance": f"""SELECT department, count(order_id) AS total_orders,
        round_even(avg(reordered), 3) AS reorder_rate, count(DISTINCT product_id) AS unique_products,
        {_title('department')} AS department_display
        FROM pc GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "department_reorder_rank": f"""SELECT department, count(*) AS n, avg(reordered) AS reorder_rate,
        {_title('department')} AS department_display FROM pc GROUP BY 1 HAVING count(*) >= 8700
        ORDER BY 3 DESC, 1 LIMIT 10""",
    "top_products": """SELECT product_name, count(*) AS count FROM pc GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 10""",
    "product_reorder_rank": """SELECT product_name, count(*) AS total_orders,
        round_even(avg(reordered), 3) AS reorder_rate FROM pc GROUP BY 1 HAVING count(*) >= 3300
        ORDER BY 3 DESC, 2 DESC, 1 LIMIT 10""",
    "customer_stats": CUSTOMERS + "SELECT * FROM cs",
    "customer_segments": CUSTOMERS + "SELECT user_id, segment FROM sg",
    "segment_sizes": CUSTOMERS + """SELECT segment, count(*) AS n,
        round(count(*) * 100.0 / (SELECT count(*) FROM sg), 6) AS percentage FROM sg GROUP BY 1""",
    "cross_category_orders": """SELECT count(*) FILTER (n > 1) AS multi_department_orders,
        count(*) AS orders, round(count(*) FILTER (n > 1) * 100.0 / count(*), 6) AS percentage
        FROM (SELECT count(DISTINCT department) AS n FROM pc GROUP BY order_id)""",
    "department_pairs": """, od AS (SELECT DISTINCT order_id, department FROM pc)
        SELECT a.department AS first_department, b.department AS second_department, count(*) AS n
        FROM od a JOIN od b ON a.order_id = b.order_id AND a.department < b.department
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 5""",
    "department_pair_counts": """, od AS (SELECT DISTINCT order_id, department FROM pc)
        SELECT a.department AS first_department, b.department AS second_department, count(*) AS n
        FROM od a JOIN od b ON a.order_id = b.order_id AND a.department < b.department
        GROUP BY 1, 2""",
    "mean_reorder_gap": RATES + "SELECT avg(days_since_prior_order) AS mean_reorder_gap FROM ur",
    "customer_lifetime": CUSTOMERS + """SELECT avg(total_orders) AS avg_lifetime_orders,
        avg(total_items) AS avg_lifetime_items,
        count(*) FILTER (total_orders >= 15) AS high_value_customers FROM cs""",
    "user_profile": """, favourites AS (
        SELECT user_id, department AS favourite_department FROM (
          SELECT user_id, department, row_number() OVER (PARTITION BY user_id
                 ORDER BY count(*) DESC, department) AS i FROM pc GROUP BY 1, 2) WHERE i = 1)
        SELECT user_id, count(DISTINCT order_id) AS total_orders, count(*) AS total_items,
          avg(reordered) AS reorder_rate,
          CAST(count(*) AS DOUBLE) / count(DISTINCT order_id) AS avg_basket,
          any_value(favourite_department) AS favourite_department
        FROM pc JOIN favourites USING (user_id) GROUP BY 1""",
    "recommendation_metrics": RATES + """SELECT CAST(sum(reordered) AS BIGINT) AS total_reorders,
        CAST(sum(reordered) AS DOUBLE) / count(*) AS global_reorder_rate,
        (SELECT round(avg(hour_reorder_rate), 6) FROM hr) AS avg_hourly_reorder_rate FROM pc""",
    "business_summary": CUSTOMERS + f"""SELECT {_KPIS},
        (SELECT avg(total_orders) FROM cs) AS avg_lifetime_orders,
        (SELECT avg(total_items) FROM cs) AS avg_lifetime_items,
        (SELECT count(*) FROM cs WHERE total_orders >= 15) AS high_value_customers,
        (SELECT avg(coalesce(days_since_prior_order, 0)) FROM pc) AS avg_days_between_orders,
        (SELECT order_hour_of_day FROM pc GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS peak_hour,
        (SELECT order_dow FROM pc GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS busiest_day""",
    "business_top_lists": """SELECT kind, CAST(position AS INTEGER) AS position, name, n FROM (
          SELECT 'department' AS kind, department AS name, count(*) AS n,
                 row_number() OVER (ORDER BY count(*) DESC, department) - 1 AS position
          FROM pc GROUP BY department
          UNION ALL
          SELECT 'product', product_name, count(*),
                 row_number() OVER (ORDER BY count(*) DESC, product_name) - 1
          FROM pc GROUP BY product_name) WHERE position < 5""",
}

# What is merged batch by batch, or read by bucket, equals what is made at once.
_BODIES.update({
    f"refreshed_{name}": _BODIES[name]
    for name in (
        "user_product_features", "user_features", "hour_reorder_rate", "day_reorder_rate",
        "p_days_since_prior_order_reorder_rate", "u_days_since_prior_order_reorder_rate",
        "days_since_prior_reorder_rate",
    )
})
_BODIES["released_table_rows"] = "{} SELECT table_name, n_rows FROM ({}) t".format(*(
    lambda text: (text[: text.rindex("SELECT", 0, text.index(" UNION ALL "))], text[text.rindex("SELECT", 0, text.index(" UNION ALL ")) :])
)(_BODIES["publish_serving_tables"]))
_BODIES["checked_tables"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, (SELECT count(*) FROM {source}) AS n_rows,
        (SELECT count(*) FROM products) AS n_rejected, (SELECT count(*) FROM {missing}) AS n_missing"""
    for name, source, missing in (
        ("orders", "order_table", "order_table WHERE days_since_prior_order IS NULL"),
        *[(n, t, "pc WHERE false") for n, t in (
            ("order_products_prior", "pc"), ("order_products_train", "tc"), ("products", "products"),
            ("aisles", "(SELECT DISTINCT aisle FROM products_merged)"),
            ("departments", "(SELECT DISTINCT department FROM products_merged)"),
        )],
    )
)
EXACT = TRAINING + """, exact AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY reordered ORDER BY
      substr(md5(concat_ws('|', user_id, product_id, '42')), 1, 15))
    <= floor(0.2 * count(*) OVER (PARTITION BY reordered) + 0.5) THEN 'val' ELSE 'train' END AS split FROM training)
"""
_BODIES["exact_split_rows"] = EXACT + "SELECT user_id, product_id, split FROM exact"
_BODIES["exact_split_report"] = EXACT + """SELECT split, count(*) AS n, CAST(sum(reordered) AS BIGINT) AS positives,
    avg(reordered) AS positive_share FROM exact GROUP BY 1"""
_BODIES["factors_per_pattern"] = """SELECT flags.* EXCLUDE (product_id), count(*) AS n_products, CAST(1 AS BIGINT) AS n_vectors
    FROM ({}) flags GROUP BY ALL""".format(_BODIES["category_flags"])
_BODIES["served_context_features"] = _BODIES["context_features"]
_BODIES["boosted_trees_rounds"] = TRAINING + "SELECT count(*) AS n_rows, true AS stopped_as_told FROM training"

ORACLES = {name: f"{BASE}{body}" for name, body in _BODIES.items()}
