"""ANSI SQL counterparts of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-30 23:57:12'"

_VIEWS = {
    "invoice_lines": """
        SELECT CAST(l_orderkey AS VARCHAR) AS invoice_no, CAST(l_partkey AS VARCHAR) AS stock_code,
               p_name AS description,
               CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS INTEGER)
                    ELSE CAST(l_quantity AS INTEGER) END AS quantity,
               o_orderdate AS invoice_date, l_extendedprice / l_quantity / 100 AS unit_price,
               CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey END AS customer_id,
               n_name AS country
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "cleaned": """
        SELECT invoice_no, stock_code, trim(description) AS description, quantity, invoice_date,
               CAST(round_even(unit_price * 1950 / 1000, 0) * 1000 AS INTEGER) AS unit_price,
               customer_id, country
        FROM invoice_lines
        WHERE invoice_date IS NOT NULL
          AND coalesce(upper(trim(stock_code)), 'NAN') NOT IN
              ('POST', 'D', 'C2', 'DOT', 'M', 'BANK CHARGES', 'PADS', 'CRUK', 'AMAZONFEE', 'S', 'B')
          AND unit_price > 0 AND description IS NOT NULL
          AND round_even(unit_price * 1950 / 1000, 0) > 0""",
    "members": """
        SELECT invoice_no, CAST(customer_id AS BIGINT) AS user_id, stock_code AS product_id,
               quantity, unit_price AS price, invoice_date AS "timestamp"
        FROM cleaned WHERE customer_id IS NOT NULL""",
    "purchases": "SELECT * FROM members WHERE quantity > 0",
    "refunds": "SELECT * FROM members WHERE quantity < 0",
    "usual_description": """
        SELECT stock_code, description FROM (
            SELECT stock_code, description, row_number() OVER (
                PARTITION BY stock_code ORDER BY count(*) DESC, description) AS place
            FROM cleaned GROUP BY stock_code, description) AS counted
        WHERE place = 1""",
    "products_built": """
        SELECT c.stock_code AS product_id, min(u.description) AS description,
               round_even(quantile_cont(CAST(c.unit_price AS DOUBLE), 0.5) / 1000, 0) * 1000 AS price,
               CAST(count(*) AS INTEGER) AS total_purchase_count
        FROM cleaned AS c JOIN usual_description AS u ON c.stock_code = u.stock_code
        GROUP BY c.stock_code""",
    "users_built": """
        SELECT a.user_id, b.country, a.first_purchase_at, a.last_purchase_at FROM (
            SELECT CAST(customer_id AS BIGINT) AS user_id, min(invoice_date) AS first_purchase_at,
                   max(invoice_date) AS last_purchase_at
            FROM cleaned WHERE customer_id IS NOT NULL GROUP BY 1) AS a
        JOIN (SELECT CAST(customer_id AS BIGINT) AS user_id, country, row_number() OVER (
                  PARTITION BY CAST(customer_id AS BIGINT) ORDER BY count(*) DESC, country) AS place
              FROM cleaned WHERE customer_id IS NOT NULL
              GROUP BY CAST(customer_id AS BIGINT), country) AS b
        ON a.user_id = b.user_id AND b.place = 1""",
    "shop_events": """
        SELECT CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id END AS user_id,
               CASE event_type WHEN 'click' THEN 'add_to_cart' ELSE event_type END AS event_type,
               CASE WHEN event_type <> 'signup' THEN json_extract_string(props, '$.k') END AS product_id,
               value AS price, ts AS event_time
        FROM events""",
    "raw_events": """
        SELECT user_id, event_type, product_id, price, event_time AS "timestamp" FROM shop_events
        WHERE event_type IN
              ('view', 'search', 'add_to_cart', 'purchase', 'refund', 'signup', 'login')""",
    "messages": """
        SELECT user_id, event_type, product_id, price, event_time,
               strftime(event_time, '%Y-%m-%dT%H:%M:%S')
               || CASE WHEN microsecond(event_time) % 1000000 <> 0
                       THEN strftime(event_time, '.%f') ELSE '' END AS iso
        FROM shop_events""",
    "stats": """
        SELECT product_id, count(*) FILTER (WHERE event_type = 'view') AS view_count,
               count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count,
               round(sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0.0 END), 2) AS revenue
        FROM raw_events WHERE product_id IS NOT NULL GROUP BY product_id""",
    "traffic": """
        SELECT date_trunc('minute', "timestamp") AS window_start,
               date_trunc('minute', "timestamp") + INTERVAL 1 MINUTE AS window_end,
               count(DISTINCT user_id) AS unique_users, count(*) AS event_count,
               round(sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0.0 END), 2) AS revenue
        FROM raw_events GROUP BY 1, 2""",
    "daily": """
        SELECT strftime("timestamp", '%Y-%m-%d') AS metric_date, count(DISTINCT user_id) AS dau,
               count(*) FILTER (WHERE event_type = 'view') AS view_count,
               count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count,
               CASE WHEN count(*) FILTER (WHERE event_type = 'view') > 0
                    THEN count(*) FILTER (WHERE event_type = 'purchase')
                         / CAST(count(*) FILTER (WHERE event_type = 'view') AS DOUBLE)
                    ELSE 0.0 END AS conversion_rate,
               round(coalesce(sum(price) FILTER (WHERE event_type = 'purchase'), 0), 2) AS revenue,
               count(*) AS event_count
        FROM raw_events GROUP BY 1""",
    "shop_products": """
        SELECT CASE WHEN p_size <= 5 THEN 'R' || CAST(p_partkey AS VARCHAR)
                    ELSE CAST(p_partkey AS VARCHAR) END AS product_id,
               p_name AS description, p_retailprice AS price,
               CAST(p_partkey * 37 % 1000 AS INTEGER) AS total_purchase_count,
               p_size * 30 AS stock
        FROM part""",
    "shop_users": """
        SELECT c_custkey AS user_id, n_name AS country
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "carts": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity, o_orderdate AS added_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "c": """
        SELECT order_id AS id, CASE WHEN order_id % 5 <> 2 THEN user_id END AS user_id, product_id,
               CASE WHEN order_id % 9 <> 4 THEN quantity END AS quantity FROM carts""",
    "merged": """
        SELECT order_id, min(user_id) AS user_id, product_id,
               CAST(sum(quantity) AS INTEGER) AS quantity, min(added_at) AS added_at
        FROM carts GROUP BY order_id, product_id""",
    "shortages": """
        SELECT m.*, p.stock FROM merged AS m LEFT JOIN shop_products AS p USING (product_id)
        WHERE p.stock IS NULL OR p.stock < m.quantity""",
    "admissible": """
        SELECT * FROM merged WHERE order_id NOT IN (SELECT order_id FROM shortages)""",
    "oversold": """
        SELECT product_id FROM admissible JOIN shop_products USING (product_id)
        GROUP BY product_id, stock HAVING sum(quantity) > stock""",
    "contested_orders": """
        SELECT DISTINCT order_id FROM admissible
        WHERE product_id IN (SELECT product_id FROM oversold)""",
    "sold": """
        SELECT * FROM admissible WHERE order_id NOT IN (SELECT order_id FROM contested_orders)""",
    "returned": """
        SELECT l_orderkey AS order_id,
               CASE WHEN l_linestatus = 'O' THEN 'X' || CAST(l_partkey AS VARCHAR)
                    ELSE CAST(l_partkey AS VARCHAR) END AS product_id
        FROM lineitem WHERE l_returnflag = 'R'""",
    "samples": """
        SELECT ts, 'http_requests_total' AS metric, '/' || event_type AS handler,
               CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status,
               CAST(user_id % 4 AS VARCHAR) AS instance, CAST(event_id % 997 AS DOUBLE) AS value
        FROM events""",
    "steps": """
        SELECT ts, handler, status, CASE WHEN prior IS NULL THEN 0.0
                                         WHEN value >= prior THEN value - prior
                                         ELSE value END AS step
        FROM (SELECT *, lag(value) OVER (PARTITION BY handler, status, instance
                                         ORDER BY ts, value) AS prior FROM samples) AS s""",
    "buckets": """
        SELECT date_trunc('day', ts) AS window_start, event_type AS handler, le, bound,
               count(*) FILTER (WHERE value <= bound) / CAST(86400 AS DOUBLE) AS rate
        FROM events, (VALUES ('1', 1.0), ('5', 5.0), ('10', 10.0), ('25', 25.0), ('50', 50.0),
                             ('+Inf', CAST('Infinity' AS DOUBLE))) AS b(le, bound)
        GROUP BY 1, 2, 3, 4""",
    "ladder": """
        SELECT *, coalesce(lag(rate) OVER up, 0.0) AS prior, lag(bound) OVER up AS floor_bound,
               max(rate) OVER (PARTITION BY window_start, handler) AS total
        FROM buckets WINDOW up AS (PARTITION BY window_start, handler ORDER BY bound)""",
}

# Which views each view reads.
_READS = {
    "cleaned": ["invoice_lines"], "members": ["cleaned"], "purchases": ["members"],
    "refunds": ["members"], "usual_description": ["cleaned"],
    "products_built": ["cleaned", "usual_description"], "users_built": ["cleaned"],
    "raw_events": ["shop_events"], "messages": ["shop_events"], "stats": ["raw_events"],
    "traffic": ["raw_events"], "daily": ["raw_events"], "merged": ["carts"], "c": ["carts"],
    "shortages": ["merged", "shop_products"], "admissible": ["merged", "shortages"],
    "oversold": ["admissible", "shop_products"], "contested_orders": ["admissible", "oversold"],
    "sold": ["admissible", "contested_orders"], "steps": ["samples"], "ladder": ["buckets"],
}


def _sql(body: str, *views: str) -> str:
    wanted: list[str] = []

    def need(view: str) -> None:
        for other in _READS.get(view, []):
            need(other)
        if view not in wanted:
            wanted.append(view)

    for view in views:
        need(view)
    if not wanted:
        return body
    return "WITH " + ",\n".join(f"{v} AS ({_VIEWS[v]})" for v in wanted) + "\n" + body


_ALL_DAILY = "metric_date, dau, view_count, purchase_count, conversion_rate, revenue, event_count"


def _quantile(q: float) -> str:
    return _sql(f"""
        SELECT window_start, handler, round(min_by(CASE
            WHEN le = '+Inf' THEN floor_bound
            ELSE coalesce(floor_bound, 0.0) + (bound - coalesce(floor_bound, 0.0))
                 * (total * {q} - prior) / (rate - prior) END, bound), 6) AS quantile
        FROM ladder WHERE rate >= total * {q} AND rate > prior
        GROUP BY window_start, handler""", "ladder")


_STREAM_TOTALS = _sql("""
        SELECT product_id, count(*) FILTER (WHERE event_type = 'view') AS view_count,
               count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count,
               round(sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0.0 END), 2) AS revenue
        FROM shop_events WHERE product_id IS NOT NULL AND event_type <> 'error'
        GROUP BY product_id""", "shop_events")

_UPSERTED = _sql("""
        SELECT coalesce(n.product_id, c.product_id) AS product_id,
               CASE WHEN n.product_id IS NOT NULL THEN n.description ELSE c.description END AS description,
               CASE WHEN n.product_id IS NOT NULL THEN n.price ELSE c.price END AS price,
               CASE WHEN n.product_id IS NOT NULL THEN n.total_purchase_count
                    ELSE c.total_purchase_count END AS total_purchase_count,
               CASE WHEN c.product_id IS NOT NULL THEN c.stock
                    ELSE n.total_purchase_count + 1 END AS stock
        FROM shop_products AS c FULL JOIN products_built AS n ON c.product_id = n.product_id""",
        "shop_products", "products_built")


ORACLES: dict[str, str] = {
    # -- sources
    "invoice_csv_source": _sql("""
        SELECT invoice_no, stock_code, description, quantity,
               strftime(invoice_date, '%-m/%-d/%Y %-H:%M') AS invoice_date, unit_price,
               CAST(customer_id AS DOUBLE) AS customer_id, country FROM invoice_lines""",
        "invoice_lines"),
    "sample_exact_size": _sql("""
        SELECT CAST(round_even(count(*) * 0.25, 0) AS BIGINT) AS line_count FROM invoice_lines""",
        "invoice_lines"),
    "sample_bernoulli": _sql("""
        SELECT count(*) AS line_count, true AS size_plausible FROM invoice_lines""",
        "invoice_lines"),
    "decoded_events": _sql("""
        SELECT user_id, event_type, product_id, price, iso AS "timestamp", event_time
        FROM messages""", "messages"),
    "product_csv_source": _sql("SELECT * FROM shop_products", "shop_products"),
    "event_log_source": _sql("""
        SELECT user_id, event_type, product_id, price,
               event_time AS "timestamp" FROM shop_events""",
        "shop_events"),
    "first_events_of_log": _sql("""
        SELECT user_id, event_type, product_id, price,
               event_time AS "timestamp" FROM shop_events
        ORDER BY event_time LIMIT 500""", "shop_events"),
    "parameterised_sql": _sql("""
        SELECT event_type, count(*) AS event_count FROM raw_events WHERE price >= 5.0
        GROUP BY event_type""", "raw_events"),
    "missing_table": _sql("SELECT count(*) AS product_count FROM stats", "stats"),

    # -- cleaning and dimensions
    "cleaned_lines": _sql("SELECT * FROM cleaned", "cleaned"),
    "cleaning_stage_counts": _sql("""
        SELECT 'read' AS stage, count(*) AS line_count FROM invoice_lines
        UNION ALL SELECT 'dated', count(*) FROM invoice_lines WHERE invoice_date IS NOT NULL
        UNION ALL SELECT 'product_code', count(*) FROM invoice_lines
        WHERE invoice_date IS NOT NULL AND coalesce(upper(trim(stock_code)), 'NAN') NOT IN
              ('POST', 'D', 'C2', 'DOT', 'M', 'BANK CHARGES', 'PADS', 'CRUK', 'AMAZONFEE', 'S', 'B')
        UNION ALL SELECT 'priced', count(*) FROM invoice_lines
        WHERE invoice_date IS NOT NULL AND coalesce(upper(trim(stock_code)), 'NAN') NOT IN
              ('POST', 'D', 'C2', 'DOT', 'M', 'BANK CHARGES', 'PADS', 'CRUK', 'AMAZONFEE', 'S', 'B')
          AND unit_price > 0
        UNION ALL SELECT 'described', count(*) FROM invoice_lines
        WHERE invoice_date IS NOT NULL AND coalesce(upper(trim(stock_code)), 'NAN') NOT IN
              ('POST', 'D', 'C2', 'DOT', 'M', 'BANK CHARGES', 'PADS', 'CRUK', 'AMAZONFEE', 'S', 'B')
          AND unit_price > 0 AND description IS NOT NULL
        UNION ALL SELECT 'priced_in_krw', count(*) FROM cleaned""", "invoice_lines", "cleaned"),
    "member_purchases": _sql("SELECT * FROM purchases", "purchases"),
    "member_refunds": _sql("SELECT * FROM refunds", "refunds"),
    "product_dimension": _sql("SELECT * FROM products_built", "products_built"),
    "user_dimension": _sql("SELECT * FROM users_built", "users_built"),
    "product_purchase_weights": _sql("""
        SELECT product_id, CAST(total_purchase_count AS DOUBLE)
               / (SELECT sum(total_purchase_count) FROM products_built) AS weight
        FROM products_built""", "products_built"),
    "product_stock_bounds": _sql("""
        SELECT product_id, total_purchase_count, true AS in_bounds FROM products_built""",
        "products_built"),
    "products_upserted": _UPSERTED,
    "products_upserted_by_slot": _UPSERTED,
    "users_upserted": _sql("""
        SELECT coalesce(n.user_id, c.user_id) AS user_id,
               CASE WHEN n.user_id IS NOT NULL THEN n.country ELSE 'unknown' END AS country,
               n.first_purchase_at, n.last_purchase_at
        FROM shop_users AS c FULL JOIN users_built AS n ON c.user_id = n.user_id""",
        "shop_users", "users_built"),
    "broken_constraints": _sql("""
        SELECT 'stock below 0' AS violation, count(*) AS row_count FROM (
            SELECT p.product_id, p.stock - coalesce(sum(c.quantity), 0) AS rest
            FROM shop_products AS p LEFT JOIN carts AS c ON p.product_id = c.product_id
            GROUP BY p.product_id, p.stock) AS after_sale
        WHERE rest < 0 HAVING count(*) > 0""", "shop_products", "carts"),
    "repeated_order_keys": _sql("""
        SELECT 'order_id not unique' AS violation, CAST(sum(n) AS BIGINT) AS row_count
        FROM (SELECT order_id, count(*) AS n FROM carts GROUP BY order_id) AS k
        WHERE n > 1 HAVING count(*) > 0""", "carts"),

    # -- events
    "valid_events": _sql("""
        SELECT user_id, event_type, product_id, price, "timestamp" AS event_time
        FROM raw_events""", "raw_events"),
    "rejected_events": _sql("""
        SELECT user_id, event_type, product_id, price, event_time AS "timestamp",
               'event_type unknown' AS reason, event_type AS rejected_value
        FROM messages WHERE event_type NOT IN
              ('view', 'search', 'add_to_cart', 'purchase', 'refund', 'signup', 'login')""",
        "messages"),
    "events_with_default_time": _sql(f"""
        SELECT user_id, event_type, product_id, price,
               CASE WHEN product_id IS NULL THEN {AS_OF} ELSE event_time END AS "timestamp"
        FROM shop_events""", "shop_events"),
    "events_with_identity": _sql("""
        SELECT coalesce(u.user_id, e.user_id) AS user_id, e.event_type, e.product_id, e.price,
               e.event_time
        FROM shop_events AS e LEFT JOIN shop_users AS u
          ON u.user_id = CASE WHEN e.user_id % 2 = 1 THEN e.user_id * 20 END""",
        "shop_events", "shop_users"),
    "events_repaired_for_sending": _sql("""
        SELECT user_id, event_type, product_id,
               CASE WHEN product_id IS NOT NULL THEN price END AS price, iso AS "timestamp"
        FROM messages""", "messages"),
    "events_with_product": _sql(
        "SELECT * FROM raw_events WHERE product_id IS NOT NULL", "raw_events"),
    "event_messages": _sql("""
        SELECT CAST(user_id AS VARCHAR) AS key,
               '{"user_id":' || coalesce(CAST(user_id AS VARCHAR), 'null')
               || ',"event_type":"' || event_type || '","product_id":'
               || coalesce('"' || product_id || '"', 'null')
               || ',"price":' || CAST(price AS VARCHAR) || ',"timestamp":"' || iso || '"}' AS value
        FROM messages""", "messages"),
    "time_ordered_events": _sql('SELECT * FROM raw_events ORDER BY "timestamp"', "raw_events"),

    # -- metrics
    "product_stats": _sql("SELECT * FROM stats", "stats"),
    "traffic_per_minute": _sql("SELECT * FROM traffic", "traffic"),
    "traffic_users_estimated": _sql("""
        SELECT window_start, window_end, event_count, true AS estimate_near FROM traffic""",
        "traffic"),
    "daily_metrics_all_days": _sql(f"SELECT {_ALL_DAILY} FROM daily", "daily"),
    "daily_metrics_one_day": _sql(
        f"SELECT {_ALL_DAILY} FROM daily WHERE metric_date = '2024-01-15'", "daily"),
    "daily_metrics_empty_day": _sql("""
        SELECT '2031-01-01' AS metric_date, count(DISTINCT user_id) AS dau, count(*) AS view_count,
               count(*) AS purchase_count, 0.0::DOUBLE AS conversion_rate,
               coalesce(sum(price), 0.0) AS revenue, count(*) AS event_count
        FROM raw_events WHERE "timestamp" >= TIMESTAMP '2031-01-01'
          AND "timestamp" < TIMESTAMP '2031-01-02'""", "raw_events"),
    "daily_metrics_stored": _sql(f"SELECT {_ALL_DAILY} FROM daily", "daily"),
    "daily_report_lines": _sql("""
        SELECT metric_date, 'date' AS measure, metric_date AS text FROM daily
        UNION ALL SELECT metric_date, 'dau', format('{:,}', dau) FROM daily
        UNION ALL SELECT metric_date, 'view_count', format('{:,}', view_count) FROM daily
        UNION ALL SELECT metric_date, 'purchase_count', format('{:,}', purchase_count) FROM daily
        UNION ALL SELECT metric_date, 'conversion_rate',
               printf('%.2f', round_even(conversion_rate, 4) * 100) || '%' FROM daily
        UNION ALL SELECT metric_date, 'revenue', format('{:,.2f}', revenue) FROM daily
        UNION ALL SELECT metric_date, 'event_count', format('{:,}', event_count) FROM daily""",
        "daily"),
    "current_visitors": _sql(f"""
        SELECT count(DISTINCT user_id) AS visitors FROM raw_events
        WHERE "timestamp" >= {AS_OF} - INTERVAL 5 MINUTE""", "raw_events"),
    "visitors_last_day": _sql(f"""
        SELECT count(DISTINCT user_id) AS visitors FROM raw_events
        WHERE "timestamp" >= {AS_OF} - INTERVAL 1440 MINUTE""", "raw_events"),
    "purchases_today": _sql("""
        SELECT * FROM raw_events WHERE event_type = 'purchase'
          AND CAST("timestamp" AS DATE) = DATE '2024-01-30'""", "raw_events"),
    "revenue_today": _sql("""
        SELECT round(coalesce(sum(price), 0), 2) AS revenue FROM raw_events
        WHERE event_type = 'purchase' AND CAST("timestamp" AS DATE) = DATE '2024-01-30'""",
        "raw_events"),
    "events_in_last_hour": _sql(f"""
        SELECT * FROM raw_events WHERE "timestamp" >= {AS_OF} - INTERVAL 60 MINUTE""",
        "raw_events"),
    "events_on_day": _sql("""
        SELECT * FROM raw_events WHERE CAST("timestamp" AS DATE) = DATE '2024-01-15'""",
        "raw_events"),
    "recent_event_total": _sql(f"""
        SELECT CAST(coalesce(sum(event_count), 0) AS BIGINT) AS recent_events FROM traffic
        WHERE window_start >= {AS_OF} - INTERVAL 60 MINUTE""", "traffic"),
    "event_type_counts": _sql("""
        SELECT event_type, count(*) AS event_count FROM shop_events GROUP BY event_type""",
        "shop_events"),
    "purchase_span": _sql("""
        SELECT min("timestamp") AS first_at, max("timestamp") AS last_at,
               datediff('minute', min("timestamp"), max("timestamp")) AS span_minutes
        FROM purchases""", "purchases"),
    "samples_within_retention": _sql(f"""
        SELECT ts, metric, handler, value FROM samples
        WHERE ts >= {AS_OF} - INTERVAL 168 HOUR""", "samples"),

    # -- serving
    "product_stats_named": _sql("""
        SELECT s.product_id, p.description, s.view_count, s.purchase_count, s.revenue
        FROM stats AS s LEFT JOIN shop_products AS p ON p.product_id = s.product_id""",
        "stats", "shop_products"),
    "top_products": _sql("""
        SELECT s.product_id, p.description, s.view_count, s.purchase_count, s.revenue
        FROM stats AS s LEFT JOIN shop_products AS p ON p.product_id = s.product_id
        ORDER BY s.purchase_count DESC, s.view_count DESC, s.product_id LIMIT 10""",
        "stats", "shop_products"),
    "recent_traffic": _sql(f"""
        SELECT window_start, unique_users, event_count, revenue,
               strftime(window_start, '%m-%d %H:%M') AS minute
        FROM traffic WHERE window_start >= {AS_OF} - INTERVAL 60 MINUTE""", "traffic"),
    "recent_traffic_fallback": _sql("""
        SELECT window_start, unique_users, event_count, revenue FROM traffic
        ORDER BY window_start DESC LIMIT 60""", "traffic"),
    "daily_trend": _sql(
        f"SELECT {_ALL_DAILY} FROM daily ORDER BY metric_date DESC LIMIT 7", "daily"),
    "latest_day": _sql(
        f"SELECT {_ALL_DAILY} FROM daily ORDER BY metric_date DESC LIMIT 1", "daily"),
    "daily_card_texts": _sql("""
        SELECT metric_date, CAST(dau AS VARCHAR) AS dau,
               printf('%.1f', conversion_rate * 100) || '%' AS conversion_rate,
               '₩' || format('{:,.0f}', revenue) AS revenue,
               format('{:,}', event_count) AS event_count
        FROM daily""", "daily"),
    "products_by_popularity": _sql("SELECT * FROM shop_products", "shop_products"),
    "product_search": _sql(
        "SELECT * FROM shop_products WHERE description ILIKE '%RED%'", "shop_products"),
    "product_search_wildcards": _sql(
        "SELECT * FROM shop_products WHERE description ILIKE '%r_d%g%'", "shop_products"),
    "product_page": _sql("""
        SELECT * FROM shop_products WHERE description ILIKE '%blue%'
        ORDER BY total_purchase_count DESC, product_id LIMIT 20 OFFSET 40""", "shop_products"),
    "product_lookup": _sql(
        "SELECT * FROM shop_products WHERE product_id = '17'", "shop_products"),

    # -- commerce
    "cart_lines_known": _sql("""
        SELECT * FROM carts WHERE product_id IN (SELECT product_id FROM shop_products)""",
        "carts", "shop_products"),
    "cart_lines_unknown": _sql("""
        SELECT * FROM carts WHERE product_id NOT IN (SELECT product_id FROM shop_products)""",
        "carts", "shop_products"),
    "cart_owners_unknown": _sql("""
        SELECT * FROM carts WHERE user_id NOT IN (SELECT user_id FROM users_built)""",
        "carts", "users_built"),
    "cart_of_user": _sql("SELECT * FROM carts WHERE user_id = 7", "carts"),
    "cart_merged": _sql("SELECT * FROM merged", "merged"),
    "cart_after_additions": _sql("""
        SELECT order_id, user_id, product_id, quantity + 1 AS quantity, added_at FROM merged""",
        "merged"),
    "cart_after_removals": _sql("""
        SELECT c.* FROM carts AS c WHERE NOT EXISTS (SELECT 1 FROM returned AS r
            WHERE r.order_id = c.order_id AND r.product_id = c.product_id)""", "carts", "returned"),
    "cart_removals_not_found": _sql("""
        SELECT r.* FROM returned AS r WHERE NOT EXISTS (SELECT 1 FROM carts AS c
            WHERE r.order_id = c.order_id AND r.product_id = c.product_id)""", "carts", "returned"),
    "cart_priced": _sql("""
        SELECT c.*, coalesce(p.price, 0.0) AS price,
               round(coalesce(p.price, 0.0) * c.quantity, 2) AS line_total
        FROM carts AS c LEFT JOIN shop_products AS p ON p.product_id = c.product_id""",
        "carts", "shop_products"),
    "cart_order_totals": _sql("""
        SELECT m.order_id, count(*) AS purchased_items,
               round(sum(coalesce(p.price, 0.0) * m.quantity), 2) AS total_price
        FROM merged AS m LEFT JOIN shop_products AS p ON p.product_id = m.product_id
        GROUP BY m.order_id""", "merged", "shop_products"),
    "stock_shortages": _sql("""
        SELECT c.*, p.stock FROM carts AS c LEFT JOIN shop_products AS p USING (product_id)
        WHERE p.stock IS NULL OR p.stock < c.quantity""", "carts", "shop_products"),
    "order_verdicts": _sql("""
        SELECT c.order_id, count(*) AS lines,
               count(*) FILTER (WHERE p.stock IS NULL OR p.stock < c.quantity) AS short_lines,
               count(*) FILTER (WHERE p.stock IS NULL OR p.stock < c.quantity) = 0 AS admissible
        FROM carts AS c LEFT JOIN shop_products AS p ON p.product_id = c.product_id
        GROUP BY c.order_id""", "carts", "shop_products"),
    "admissible_orders": _sql("""
        SELECT * FROM carts WHERE order_id NOT IN (
            SELECT c.order_id FROM carts AS c LEFT JOIN shop_products AS p
              ON p.product_id = c.product_id
            WHERE p.stock IS NULL OR p.stock < c.quantity)""", "carts", "shop_products"),
    "oversell_report": _sql("""
        SELECT product_id, CAST(sum(quantity) AS BIGINT) AS demand, count(*) AS lines, stock,
               CAST(sum(quantity) - stock AS BIGINT) AS excess
        FROM carts JOIN shop_products USING (product_id)
        GROUP BY product_id, stock HAVING sum(quantity) > stock""", "carts", "shop_products"),
    "running_demand": _sql("""
        SELECT order_id, product_id, quantity, added_at, stock, demand_so_far,
               demand_so_far > stock AS over_stock,
               demand_so_far > stock AND demand_so_far - quantity <= stock AS first_over
        FROM (SELECT m.order_id, m.product_id, m.quantity, m.added_at, p.stock,
                     CAST(sum(m.quantity) OVER (PARTITION BY m.product_id
                          ORDER BY m.added_at, m.order_id) AS BIGINT) AS demand_so_far,
                     sum(m.quantity) OVER (PARTITION BY m.product_id) AS demand
              FROM merged AS m JOIN shop_products AS p ON p.product_id = m.product_id) AS d
        WHERE demand > stock""", "merged", "shop_products"),
    "checkout_purchase_events": _sql(f"""
        SELECT s.user_id, 'purchase' AS event_type, s.product_id, p.price, {AS_OF} AS "timestamp"
        FROM (SELECT *, unnest(range(quantity)) AS unit FROM sold) AS s
        JOIN shop_products AS p ON p.product_id = s.product_id""", "sold", "shop_products"),
    "checkout_totals": _sql("""
        SELECT s.order_id, count(*) AS purchased_items,
               round(sum(p.price * s.quantity), 2) AS total_price
        FROM sold AS s JOIN shop_products AS p ON p.product_id = s.product_id
        GROUP BY s.order_id""", "sold", "shop_products"),
    "checkout_catalog_after": _sql("""
        SELECT p.product_id, p.description, p.price,
               CAST(p.total_purchase_count + coalesce(u.units, 0) AS INTEGER) AS total_purchase_count,
               CAST(p.stock - coalesce(u.units, 0) AS INTEGER) AS stock
        FROM shop_products AS p LEFT JOIN (
            SELECT product_id, sum(quantity) AS units FROM sold GROUP BY product_id) AS u
          ON u.product_id = p.product_id""", "sold", "shop_products"),
    "checkout_carts_after": _sql("""
        SELECT * FROM merged WHERE order_id NOT IN (SELECT order_id FROM sold)""", "sold"),
    "checkout_contested": _sql("""
        SELECT * FROM admissible WHERE order_id IN (SELECT order_id FROM contested_orders)""",
        "contested_orders"),

    # -- synthesis
    "conversion_path_bounds": _sql("""
        SELECT t.event_type, (SELECT count(*) FROM purchases) AS event_count,
               CAST(0 AS BIGINT) AS out_of_bounds
        FROM (VALUES ('view'), ('add_to_cart'), ('purchase')) AS t(event_type)""", "purchases"),
    "synthetic_event_counts": _sql("""
        SELECT 'view' AS event_type, 10 * count(*) AS event_count FROM purchases
        UNION ALL SELECT 'add_to_cart', 3 * count(*) FROM purchases
        UNION ALL SELECT 'purchase', count(*) FROM purchases
        UNION ALL SELECT 'refund', count(*) FROM refunds""", "purchases", "refunds"),
    "prepared_row_counts": _sql("""
        SELECT 'products' AS part, count(*) AS row_count FROM products_built
        UNION ALL SELECT 'users', count(*) FROM users_built
        UNION ALL SELECT 'purchases', count(*) FROM purchases
        UNION ALL SELECT 'refunds', count(*) FROM refunds
        UNION ALL SELECT 'events: view', 10 * count(*) FROM purchases
        UNION ALL SELECT 'events: add_to_cart', 3 * count(*) FROM purchases
        UNION ALL SELECT 'events: purchase', count(*) FROM purchases
        UNION ALL SELECT 'events: refund', count(*) FROM refunds""",
        "products_built", "users_built", "purchases", "refunds"),
    "synthetic_event_integrity": _sql("""
        SELECT event_type, CAST(0 AS BIGINT) AS incomplete, CAST(0 AS BIGINT) AS out_of_period FROM (
            SELECT 'view' AS event_type FROM purchases UNION SELECT 'add_to_cart' FROM purchases
            UNION SELECT 'purchase' FROM purchases UNION SELECT 'refund' FROM refunds) AS t""",
        "purchases", "refunds"),
    "popularity_weighted_draws": """
        SELECT count(*) AS draws, count(*) AS slots, CAST(0 AS BIGINT) AS impossible FROM events""",
    "random_event_mix": """
        SELECT count(*) AS event_count, CAST(0 AS BIGINT) AS wrong, CAST(4 AS BIGINT) AS event_types
        FROM events""",
    "replay_waits": _sql("""
        SELECT event_time AS "timestamp", events, CASE WHEN prior IS NULL THEN 0.0::DOUBLE
                   ELSE least((epoch_us(event_time) - epoch_us(prior)) / 1e6 / CAST(60 AS DOUBLE), 5.0)
               END AS wait_seconds
        FROM (SELECT event_time, count(*) AS events,
                     lag(event_time) OVER (ORDER BY event_time) AS prior
              FROM shop_events GROUP BY event_time) AS i""",
        "shop_events"),

    # -- telemetry
    "request_rate_by_handler": _sql("""
        SELECT date_trunc('hour', ts) AS window_start, handler, round(sum(step) / 3600, 6) AS rate
        FROM steps GROUP BY 1, 2""", "steps"),
    "latency_p95_by_handler": _quantile(0.95),
    "latency_median_by_handler": _quantile(0.5),
    "error_percentage": _sql("""
        SELECT date_trunc('day', ts) AS window_start,
               round(100.0 * sum(CASE WHEN status LIKE '5__' THEN step ELSE 0.0 END)
                     / nullif(sum(step), 0), 6) AS error_percent
        FROM steps GROUP BY 1""", "steps"),
    "gauge_by_state": """
        SELECT window_start, state, value FROM (
            SELECT date_trunc('hour', ts) AS window_start, event_type AS state, value,
                   row_number() OVER (PARTITION BY date_trunc('hour', ts), event_type
                                      ORDER BY ts DESC, value DESC) AS place FROM events) AS g
        WHERE place = 1""",
    "consumer_lag": """
        SELECT window_start, consumergroup, 'events' AS topic, sum(value) AS lag FROM (
            SELECT date_trunc('hour', ts) AS window_start, event_type AS consumergroup,
                   CAST(event_id % 50 AS DOUBLE) AS value,
                   row_number() OVER (PARTITION BY date_trunc('hour', ts), event_type, user_id % 3
                                      ORDER BY ts DESC, event_id % 50 DESC) AS place
            FROM events) AS g
        WHERE place = 1 GROUP BY 1, 2""",
    "container_logs": """
        SELECT make_timestamp((conv_id * 60 + turn) * 1000000) AS ts, 'chat-' || role AS container,
               CASE WHEN role = 'user' THEN 'stdout' ELSE 'stderr' END AS stream, text AS line
        FROM conversations WHERE role IN ('user', 'system')""",
    "load_test_summary": """
        SELECT *, failed_rate < 0.01 AS failed_ok, p95 < 500 AS p95_ok,
               failed_rate < 0.01 AND p95 < 500 AS passed
        FROM (SELECT count(*) AS requests,
                     round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 6) AS failed_rate,
                     round(quantile_cont(value * 10, 0.90), 6) AS p90,
                     round(quantile_cont(value * 10, 0.95), 6) AS p95 FROM events) AS s""",
    "load_test_checks": """
        SELECT event_type AS "check", count(*) AS runs,
               round(avg(CASE WHEN value < 50 THEN 1.0 ELSE 0.0 END), 6) AS success_rate
        FROM events GROUP BY event_type""",

    # -- streaming
    "stream_raw_events": _sql("SELECT * FROM raw_events", "raw_events"),
    "stream_rejected_events": _sql("""
        SELECT user_id, event_type, product_id, price, event_time, 'event_type unknown' AS reason
        FROM shop_events WHERE event_type = 'error'""", "shop_events"),
    "stream_product_totals": _STREAM_TOTALS,
    "stream_product_stats": _STREAM_TOTALS,
    "stream_traffic_windows": _sql("""
        SELECT * FROM (
            SELECT date_trunc('minute', event_time) AS window_start,
                   date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end,
                   count(*) AS event_count,
                   round(sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0.0 END), 2) AS revenue
            FROM shop_events WHERE event_type <> 'error' GROUP BY 1, 2) AS t
        WHERE window_end <= date_trunc('millisecond', (
            SELECT max(event_time) FROM shop_events WHERE event_type <> 'error')) - INTERVAL 10 MINUTE""",
        "shop_events"),
    "traffic_windows_merged": _sql("""
        SELECT * FROM (
            SELECT date_trunc('minute', event_time) AS window_start,
                   date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end,
                   count(*) AS event_count,
                   round(sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0.0 END), 2) AS revenue
            FROM shop_events WHERE event_type <> 'error' GROUP BY 1, 2) AS t
        WHERE window_end <= date_trunc('millisecond', (
            SELECT max(event_time) FROM shop_events WHERE event_type <> 'error')) - INTERVAL 10 MINUTE""",
        "shop_events"),
    "stream_replay": _sql("""
        SELECT product_id, count(*) FILTER (WHERE event_type = 'view') AS view_count,
               count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count,
               round(sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0.0 END), 2) AS revenue
        FROM shop_events WHERE product_id IS NOT NULL AND event_type <> 'error'
        GROUP BY product_id""", "shop_events"),
    "live_jobs_agree": _sql("""
        SELECT * FROM (WITH timed AS (
            SELECT CASE WHEN CAST(floor(epoch(event_time)) AS BIGINT) % 11 = 3 THEN event_time + INTERVAL 30 SECONDS
                        ELSE event_time END AS event_time FROM shop_events WHERE event_type <> 'error')
        SELECT window_start, count(*) AS event_count, count(*) AS stored_events FROM (
            SELECT date_trunc('minute', event_time) AS window_start FROM timed) AS t
        WHERE window_start + INTERVAL 1 MINUTE <= date_trunc('millisecond', (
            SELECT max(event_time) FROM timed)) - INTERVAL 10 MINUTE
        GROUP BY window_start) AS agreed""", "shop_events"),
    "contested_orders_decided": _sql("""
        SELECT order_id, admitted FROM (
          WITH RECURSIVE line AS (
            SELECT order_id, product_id, CAST(sum(quantity) AS BIGINT) AS quantity, min(added_at) AS added_at FROM carts GROUP BY 1, 2),
          demand AS (SELECT product_id, sum(quantity) AS wanted FROM line GROUP BY 1),
          short AS (
            SELECT product_id, CAST(stock AS BIGINT) AS stock, row_number() OVER (ORDER BY product_id) AS place
            FROM shop_products JOIN demand USING (product_id) WHERE wanted > stock),
          per_order AS (
            SELECT order_id, min(added_at) AS arrival, list(place) FILTER (place IS NOT NULL) AS places,
                   list(quantity) FILTER (place IS NOT NULL) AS amounts,
                   count(*) = count(p.stock) AND bool_and(quantity <= p.stock) AS possible
            FROM line LEFT JOIN shop_products AS p USING (product_id) LEFT JOIN short USING (product_id) GROUP BY order_id),
          queue AS (
            SELECT *, row_number() OVER (ORDER BY arrival, order_id) AS turn FROM per_order WHERE possible AND places IS NOT NULL),
          served AS (
            SELECT CAST(0 AS BIGINT) AS turn, (SELECT list(stock ORDER BY place) FROM short) AS remaining,
                   CAST(NULL AS BIGINT) AS order_id, false AS admitted
            UNION ALL
            SELECT q.turn, CASE WHEN q.fits THEN list_transform(q.remaining, lambda v, i: v - coalesce(q.amounts[list_position(q.places, i)], 0))
                                ELSE q.remaining END, q.order_id, q.fits
            FROM (SELECT o.turn, o.order_id, o.places, o.amounts, s.remaining,
                         list_min(list_transform(o.places, lambda p, k: s.remaining[p] - o.amounts[k])) >= 0 AS fits
                  FROM served AS s JOIN queue AS o ON o.turn = s.turn + 1) AS q)
          SELECT order_id, admitted FROM served WHERE turn > 0
          UNION ALL SELECT order_id, possible FROM per_order WHERE NOT possible OR places IS NULL) AS decided""", "carts", "shop_products"),
    "product_search_indexed": _sql(
        "SELECT * FROM shop_products WHERE description ILIKE '%ALL%_lt%'", "shop_products"),
    "product_search_short_text": _sql(
        "SELECT * FROM shop_products WHERE description ILIKE '%r_d%g%'", "shop_products"),
    "users_from_minute_sketches": _sql("""
        SELECT '1 hour' AS span, date_trunc('hour', event_time) AS window_start, count(DISTINCT user_id) AS users,
               count(*) AS events, true AS near FROM shop_events
        WHERE event_type <> 'error' AND event_time IS NOT NULL GROUP BY 2
        UNION ALL
        SELECT '1 day', date_trunc('day', event_time), count(DISTINCT user_id), count(*), true FROM shop_events
        WHERE event_type <> 'error' AND event_time IS NOT NULL GROUP BY 2""", "shop_events"),
    "quantiles_from_minute_sketches": """
        SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS "values", true AS all_counted, true AS p50_near,
               true AS p95_near FROM events WHERE value IS NOT NULL GROUP BY 1, 2""",
    "late_events_after_compaction": _sql("""
        SELECT stage, CAST("timestamp" AS DATE) AS event_date, count(*) AS event_count, round(sum(price), 2) AS price_sum
        FROM raw_events, (VALUES ('late'), ('merged')) AS s(stage) GROUP BY 1, 2""", "raw_events"),
    "dimension_csv_rejected": """
        SELECT outcome, count(*) AS row_count, CAST(sum(p_partkey) FILTER (p_partkey % 29 <> 4) AS BIGINT) AS key_sum,
               count(*) FILTER (p_partkey % 7 NOT IN (3, 5)) AS priced FROM (
            SELECT p_partkey, CASE WHEN p_partkey % 7 = 3 THEN 'price malformed'
                        WHEN p_partkey % 11 = 6 THEN 'total_purchase_count malformed'
                        WHEN p_partkey % 29 = 4 THEN 'product_id missing' ELSE 'read' END AS outcome FROM part) AS r
        GROUP BY outcome""",
    "live_malformed_rejected": """
        SELECT reason, count(*) AS messages, min(text) AS first_text, CAST(max(length(text)) AS INTEGER) AS longest FROM (
            SELECT CASE WHEN event_id % 19 = 6 THEN left(whole, 12) ELSE whole END AS text,
                   CASE WHEN event_id % 19 = 6 THEN 'message unreadable'
                        WHEN event_type IN ('click', 'error') THEN 'event_type unknown'
                        WHEN event_id % 13 = 4 THEN 'user_id malformed'
                        WHEN event_id % 17 = 5 THEN 'price malformed' END AS reason
            FROM (SELECT event_id, event_type, printf('{"user_id":%s,"event_type":"%s","price":%s}',
                      CASE WHEN event_id % 13 = 4 THEN '"u17"' ELSE CAST(user_id AS VARCHAR) END, event_type,
                      CASE WHEN event_id % 17 = 5 THEN '"cheap"' ELSE printf('%.2f', value) END) AS whole
                  FROM events) AS m) AS r
        WHERE reason IS NOT NULL GROUP BY reason""",
    "invoice_csv_rejected": """
        SELECT outcome, count(*) AS line_count, CAST(sum(units) AS BIGINT) AS units FROM (
            SELECT CASE WHEN l_partkey % 7 = 3 THEN 'quantity malformed'
                        WHEN l_partkey % 11 = 5 THEN 'customer_id malformed' ELSE 'read' END AS outcome,
                   CASE WHEN l_partkey % 7 <> 3 THEN CAST(l_quantity AS INTEGER) END AS units
            FROM lineitem) AS l GROUP BY outcome""",
    "csv_texts_come_back": """
        SELECT doc_id, CASE WHEN doc_id % 50 = 7 THEN ''
                            WHEN doc_id % 50 = 9 THEN '\\n' || chr(65535) || '\\' || text || '\\\\' || chr(65535) || '\\e'
                            WHEN doc_id % 50 <> 8 THEN text END AS text FROM documents""",
    "product_search_backslash": _sql(
        "SELECT * FROM shop_products WHERE lower(description) LIKE '%red%'", "shop_products"),
    "gauge_of_one_database": """
        SELECT window_start, state, round(sum(value), 6) AS value FROM (
            SELECT date_trunc('hour', ts) AS window_start, event_type AS state, value,
                   row_number() OVER (PARTITION BY date_trunc('hour', ts), event_type, event_id % 2
                                      ORDER BY ts DESC, value DESC) AS place
            FROM events WHERE user_id % 2 = 1) AS g
        WHERE place = 1 GROUP BY window_start, state""",
    "broken_cart_constraints": _sql("""
        SELECT violation, count(*) AS row_count FROM (
            SELECT 'user_id missing' AS violation FROM c WHERE user_id IS NULL
            UNION ALL SELECT 'quantity missing' FROM c WHERE quantity IS NULL
            UNION ALL SELECT 'user_id unknown' FROM c WHERE user_id NOT IN (SELECT c_custkey FROM customer)
            UNION ALL SELECT 'product_id unknown' FROM c WHERE product_id NOT IN (SELECT product_id FROM shop_products)
            UNION ALL SELECT 'id not unique' FROM c WHERE id IN (SELECT id FROM c GROUP BY id HAVING count(*) > 1)) AS v
        GROUP BY violation""", "c", "shop_products"),
    "raw_events_compacted": _sql("""
        SELECT CAST("timestamp" AS DATE) AS event_date, count(*) AS event_count, round(sum(price), 2) AS price_sum
        FROM raw_events GROUP BY 1""", "raw_events"),
    "tables_ensured": _sql("""
        SELECT * FROM raw_events WHERE CAST("timestamp" AS DATE) = DATE '2024-01-15'""", "raw_events"),
    "draws_follow_weights": """
        SELECT DISTINCT 'part' AS drawn, CAST(CASE WHEN p_partkey % 10 = 0 THEN 50 ELSE 1 END AS BIGINT) AS class,
               true AS plausible FROM part
        UNION ALL SELECT DISTINCT 'user', c_custkey % 4, true FROM customer""",
    "lag_from_reports": """
        SELECT window_start, consumergroup, 'clicks' AS topic, sum(value) AS lag FROM (
            SELECT date_trunc('hour', ts) AS window_start, event_type AS consumergroup,
                   CAST(event_id % 50 AS DOUBLE) AS value,
                   row_number() OVER (PARTITION BY date_trunc('hour', ts), event_type, user_id % 3
                                      ORDER BY date_trunc('millisecond', ts) DESC, event_id % 50 DESC) AS place
            FROM events) AS g
        WHERE place = 1 GROUP BY window_start, consumergroup""",
    "snapshot_published": _sql("SELECT * FROM shop_products", "shop_products"),
}
