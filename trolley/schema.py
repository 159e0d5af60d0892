"""Table schemas and the fixed values of the basket domain."""

from pyspark.sql import types as T

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("eval_set", T.StringType(), False),
    T.StructField("order_number", T.IntegerType(), False),
    T.StructField("order_dow", T.IntegerType(), False),
    T.StructField("order_hour_of_day", T.IntegerType(), False),
    T.StructField("days_since_prior_order", T.DoubleType(), True),
])

ORDER_PRODUCTS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("add_to_cart_order", T.IntegerType(), False),
    T.StructField("reordered", T.IntegerType(), False),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("aisle_id", T.IntegerType(), False),
    T.StructField("department_id", T.IntegerType(), False),
])

AISLES = T.StructType([
    T.StructField("aisle_id", T.IntegerType(), False),
    T.StructField("aisle", T.StringType(), False),
])

DEPARTMENTS = T.StructType([
    T.StructField("department_id", T.IntegerType(), False),
    T.StructField("department", T.StringType(), False),
])

# Table name -> (file stem of the published data set, schema).
RAW_TABLES = {
    "orders": ("orders", ORDERS),
    "order_products_prior": ("order_products__prior", ORDER_PRODUCTS),
    "order_products_train": ("order_products__train", ORDER_PRODUCTS),
    "products": ("products", PRODUCTS),
    "aisles": ("aisles", AISLES),
    "departments": ("departments", DEPARTMENTS),
}

COMBINED_COLUMNS = [
    "order_id", "product_id", "add_to_cart_order", "reordered", "user_id",
    "eval_set", "order_number", "order_dow", "order_hour_of_day",
    "days_since_prior_order", "product_name", "aisle_id", "department_id",
    "aisle", "department",
]

PAIR_FEATURES = [
    "u_p_order_rate", "u_p_reorder_rate", "u_p_avg_position",
    "u_p_orders_since_last", "max_streak",
]
USER_FEATURES = [
    "user_reorder_rate", "user_unique_products", "user_total_products",
    "user_avg_cart_size", "user_avg_days_between_orders",
    "user_reordered_products_ratio",
]
PRODUCT_FEATURES = [
    "product_reorder_rate", "avg_pos_incart", "p_reduced_feat_1",
    "p_reduced_feat_2", "p_reduced_feat_3", "aisle_reorder_rate",
    "department_reorder_rate",
]
CONTEXT_FEATURES = ["order_dow", "order_hour_of_day", "days_since_prior_order"]
RATE_FEATURES = [
    "hour_reorder_rate", "day_reorder_rate",
    "p_days_since_prior_order_reorder_rate",
    "u_days_since_prior_order_reorder_rate",
    "days_since_prior_reorder_rate",
]
MODEL_FEATURES = PAIR_FEATURES + CONTEXT_FEATURES + RATE_FEATURES
LABEL = "reordered"

# ---------------------------------------------------------------------------
# Ids, thresholds and labels that results depend on.
# ---------------------------------------------------------------------------

# Flag name -> (kind of test, value).
CATEGORY_FLAGS = {
    "organic": ("name_contains", "organic"),
    "isYogurt": ("aisle_id", 120),
    "isProduce": ("department_id", 4),
    "isFrozen": ("department_id", 1),
    "isdairy": ("department_id", 16),
    "isbreakfast": ("department_id", 14),
    "issnack": ("department_id", 19),
    "isbeverage": ("department_id", 7),
}

DAY_NAMES = {
    0: "Sunday", 1: "Monday", 2: "Tuesday", 3: "Wednesday",
    4: "Thursday", 5: "Friday", 6: "Saturday",
}

# Segment name -> minimum orders, minimum basket, minimum reorder rate.
SEGMENT_RULES = [
    ("VIP Customers", {"orders": 15, "basket": 12}),
    ("Loyal Customers", {"orders": 8, "rate": 0.6}),
    ("Regular Customers", {"orders": 5}),
]
OTHER_SEGMENT = "New Customers"
HIGH_VALUE_ORDERS = 15

DEPARTMENT_MIN_ROWS = 1000
PRODUCT_MIN_ROWS = 50
MISSING_AISLE = "missing"
LAST_PURCHASE_DATE = "2021-03-21"
SPLIT_SEED = 42
SPLIT_SHARE = 0.2
