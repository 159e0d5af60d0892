"""Basket tables as SQL over the star schema, written with plain windows."""

BASE = """
WITH described AS (
  SELECT p_partkey, regexp_extract(p_name, '[^ ]*$') AS aisle, p_type AS department,
         CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END || ' ' || regexp_extract(p_name, '[^ ]*$')
           AS product_name
  FROM part),
part_groups AS (
  SELECT *, min(p_partkey) OVER (PARTITION BY product_name, department) AS product_id,
         min(p_partkey) OVER (PARTITION BY aisle) AS aisle_id,
         min(p_partkey) OVER (PARTITION BY department) AS department_id
  FROM described),
products_merged AS (
  SELECT product_id, product_name, CAST(aisle_id AS INTEGER) AS aisle_id,
         CAST(department_id AS INTEGER) AS department_id, aisle, department
  FROM part_groups WHERE p_partkey = product_id),
products AS (SELECT product_id, product_name, aisle_id, department_id FROM products_merged),
ranked_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth,
         count(*) OVER (PARTITION BY o_custkey) AS total,
         lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
           AS previous_date
  FROM orders),
order_table AS (
  SELECT order_id, user_id,
         CASE WHEN total > 1 AND nth = total THEN 'train' ELSE 'prior' END AS eval_set,
         CAST(nth AS INTEGER) AS order_number,
         CAST(dayofweek(order_date) AS INTEGER) AS order_dow,
         CAST(order_id % 24 AS INTEGER) AS order_hour_of_day,
         CAST(datediff('day', previous_date, order_date) % 31 AS DOUBLE) AS days_since_prior_order
  FROM ranked_orders),
distinct_lines AS (
  SELECT l_orderkey AS order_id, product_id, min(l_linenumber) AS line
  FROM lineitem JOIN part_groups ON l_partkey = p_partkey GROUP BY 1, 2),
line_table AS (
  SELECT d.order_id, d.product_id,
         CAST(row_number() OVER (PARTITION BY d.order_id ORDER BY line, d.product_id) AS INTEGER)
           AS add_to_cart_order,
         CASE WHEN row_number() OVER (PARTITION BY user_id, d.product_id ORDER BY order_number) > 1
              THEN 1 ELSE 0 END AS reordered
  FROM distinct_lines d JOIN order_table USING (order_id)),
combined AS (
  SELECT l.order_id, product_id, add_to_cart_order, reordered, user_id, eval_set, order_number,
         order_dow, order_hour_of_day, days_since_prior_order, product_name, aisle_id,
         department_id, aisle, department
  FROM line_table l JOIN order_table o ON o.order_id = l.order_id
       LEFT JOIN products_merged USING (product_id)),
pc AS (SELECT * FROM combined WHERE eval_set = 'prior'),
tc AS (SELECT * FROM combined WHERE eval_set = 'train')
"""
