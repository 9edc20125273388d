"""The SQL each registered query is checked against, in the dialect of the checking database."""

from __future__ import annotations

LINE_REVENUE = """
    SELECT o_custkey AS c_custkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_shipdate >= DATE '2001-08-01'
    GROUP BY o_custkey
"""

ADDRESSES = """
    SELECT n_nationkey, r_name || ' ' || coalesce(CASE WHEN r_name <> 'ASIA' THEN n_name END, ' ') AS full_address
    FROM nation JOIN region ON n_regionkey = r_regionkey
"""

IN_QUARTER = "l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1997-04-01'"

RETURN_YEARS = """
    SELECT DISTINCT o_custkey AS c_custkey, CAST(year(l_shipdate) AS INTEGER) AS y
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    WHERE l_returnflag = 'R'
"""

PICKED_PARTS = """
    part p JOIN lineitem l ON p.p_partkey = l.l_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
"""

PICKED = """
    p.p_size >= 5 AND p.p_size <= 45 AND p.p_retailprice > 1
    AND p.p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5')
"""

REQUESTS = """
    SELECT o_orderkey AS seq,
        CASE WHEN o_orderpriority = '5-LOW' THEN '  '
             WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
             ELSE 'New item ' || CAST(o_custkey AS VARCHAR) END AS title,
        CASE WHEN o_orderkey % 7 = 3 THEN NULL
             WHEN o_orderstatus = 'F' THEN 'nation_7'
             WHEN o_orderstatus = 'O' THEN 'Klingon'
             ELSE 'Lang ' || o_orderpriority END AS language
    FROM orders
"""

ACCEPTED = f"""
    SELECT * FROM (
        SELECT r.*, row_number() OVER (PARTITION BY upper(title) ORDER BY seq) AS turn
        FROM ({REQUESTS}) r
        WHERE trim(title) <> '' AND language IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM customer c WHERE upper(c.c_name) = upper(r.title))
    ) q WHERE turn = 1
"""

NEW_LANGUAGES = f"""
    SELECT name, 24 + row_number() OVER (ORDER BY first_seq) AS language_id
    FROM (
        SELECT arg_min(language, seq) AS name, min(seq) AS first_seq
        FROM ({ACCEPTED}) a
        WHERE NOT EXISTS (SELECT 1 FROM nation n WHERE upper(n.n_name) = upper(a.language))
        GROUP BY upper(language)
    ) f
"""

ALL_LANGUAGES = f"""
    SELECT CAST(n_nationkey AS INTEGER) AS language_id, n_name AS name FROM nation
    UNION ALL SELECT CAST(language_id AS INTEGER), name FROM ({NEW_LANGUAGES}) n
"""

BATCH = """
    SELECT o_orderkey, 'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS customer_name,
        CASE WHEN o_orderstatus = 'F' THEN 'asia' WHEN o_orderstatus = 'O' THEN 'Europe' ELSE 'Atlantis' END AS region_name
    FROM orders
"""

COMPANIES = """
    SELECT s_suppkey AS c_custkey, s_name AS c_name, s_acctbal AS c_acctbal FROM supplier
    UNION ALL SELECT c_custkey, lower(c_name), c_acctbal FROM customer
"""

ADDED_COMPANIES = f"""
    SELECT c_custkey, c_name, CAST(NULL AS INTEGER) AS c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment
    FROM ({COMPANIES}) b
    WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE upper(c.c_name) = upper(b.c_name))
"""

VIP = """
    c_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 15) AND c_mktsegment <> 'BUILDING'
"""

DEBTOR_ORDERS = "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"

RICHEST = "(SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 1)"

RENTED = f"""
    SELECT (SELECT max(l_orderkey) FROM lineitem) + row_number() OVER (ORDER BY p_partkey) AS rental_id,
        TIMESTAMP '2021-05-04' AS rental_date, p_partkey AS inventory_id, {RICHEST} AS customer_id,
        TIMESTAMP '2021-05-04' + p_size * INTERVAL 1 DAY AS return_date,
        (SELECT max(s_suppkey) FROM supplier) AS staff_id
    FROM part
    WHERE upper(p_name) IN ('RED WIDGET', 'HOT RING', 'SMALL WIDGET')
      AND NOT EXISTS (
        SELECT 1 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_partkey = p_partkey AND o_custkey = {RICHEST})
"""

# Rentals of the customer before and after the new ones, on the wanted parts.
ALL_RENTED = f"""
    SELECT rental_id, inventory_id, staff_id FROM ({RENTED}) n
    UNION ALL
    SELECT l_orderkey, l_partkey, CAST(NULL AS BIGINT)
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey = {RICHEST}
"""

RULES = """
    SELECT 'lineitem' AS table_name, rule, CAST(violations AS BIGINT) AS violations FROM (
        SELECT 'not null l_orderkey' AS rule, count(*) FILTER (WHERE l_orderkey IS NULL) AS violations FROM lineitem
        UNION ALL SELECT 'not null l_linenumber', count(*) FILTER (WHERE l_linenumber IS NULL) FROM lineitem
        UNION ALL SELECT 'not null l_partkey', count(*) FILTER (WHERE l_partkey IS NULL) FROM lineitem
        UNION ALL SELECT 'not null l_suppkey', count(*) FILTER (WHERE l_suppkey IS NULL) FROM lineitem
        UNION ALL SELECT 'length l_returnflag', count(*) FILTER (WHERE length(l_returnflag) > 1) FROM lineitem
        UNION ALL SELECT 'check flag', count(*) FILTER (WHERE NOT l_returnflag IN ('A', 'N')) FROM lineitem
        UNION ALL SELECT 'check shipped', count(*) FILTER (WHERE NOT l_shipdate > DATE '1996-01-01') FROM lineitem
        UNION ALL SELECT 'check keys differ', count(*) FILTER (WHERE l_partkey = l_suppkey) FROM lineitem
        UNION ALL SELECT 'primary key l_orderkey, l_linenumber',
            count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
        UNION ALL SELECT 'unique l_orderkey, l_partkey', count(*) - count(DISTINCT (l_orderkey, l_partkey)) FROM lineitem
        UNION ALL SELECT 'foreign key l_partkey', count(*) FROM lineitem
            WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 25)
        UNION ALL SELECT 'foreign key l_orderkey', count(*) FROM lineitem
            WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')
    ) r
"""


def _readable(size: str) -> str:
    """Nested CASE over the units: each holds until the next one's half-step bound."""
    text = f"CAST({size} AS VARCHAR) || ' bytes'"
    for power, unit in enumerate(("kB", "MB", "GB", "TB", "PB"), start=1):
        bound = 10240 if power == 1 else (20480 - 1) * 1024 ** (power - 1) // 2
        half = 2 ** (10 * power - 1)
        text = f"CASE WHEN {size} >= {bound} THEN CAST(({size} // {half} + 1) // 2 AS VARCHAR) || ' {unit}' ELSE {text} END"
    return text


SIZE = "CAST(floor(o_totalprice * o_custkey * o_custkey) AS BIGINT)"

REGION_REVENUE = f"""
    SELECT r_name AS category_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE {IN_QUARTER} GROUP BY r_name HAVING sum(CAST(l_extendedprice AS DECIMAL(18,2))) > 0
"""

LOADED = """
    SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY name) AS s_suppkey, name AS s_name,
        n_nationkey AS s_nationkey, CAST(0 AS DOUBLE) AS s_acctbal
    FROM (SELECT 'SUPPLIER#' || lpad(CAST(3 * c_custkey AS VARCHAR), 9, '0') AS name, n_nationkey
          FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9000) b
    WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE lower(s.s_name) = lower(b.name))
"""

ORACLE = {
    "category_filter": """
        SELECT c_name, c_custkey, c_acctbal
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE c_acctbal > 1 AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND upper(r_name) = 'ASIA'
    """,
    "supplied_parts": f"""
        SELECT p_name, p_size, p_retailprice FROM {PICKED_PARTS}
        WHERE {PICKED} AND upper(s_name) = 'SUPPLIER#000000007'
    """,
    "supplied_parts_semi": f"""
        SELECT p_name, p_size, p_retailprice FROM part p
        WHERE {PICKED} AND p_partkey IN (
            SELECT l_partkey FROM lineitem
            WHERE l_suppkey = (SELECT s_suppkey FROM supplier WHERE upper(s_name) = 'SUPPLIER#000000007'))
    """,
    "nested_semi": """
        SELECT c_custkey, c_name FROM customer
        WHERE c_acctbal > 1 AND c_nationkey IN (
            SELECT n_nationkey FROM nation
            WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE upper(r_name) = 'ASIA'))
    """,
    "pivot_by_year": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
            count(CASE WHEN upper(p_type) = 'PROMO' THEN 1 END) AS n_promo,
            count(CASE WHEN upper(p_type) = 'SMALL' THEN 1 END) AS n_small,
            count(CASE WHEN upper(p_type) = 'ECONOMY' THEN 1 END) AS n_economy
        FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey
        GROUP BY 1
    """,
    "pivot_priorities": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
            count(CASE WHEN upper(o_orderpriority) = '1-URGENT' THEN 1 END) AS n_urgent,
            count(CASE WHEN upper(o_orderpriority) = '5-LOW' THEN 1 END) AS n_low
        FROM orders GROUP BY 1
    """,
    "top_labelled": """
        SELECT p_name, n_lines, CASE p_type
            WHEN 'ECONOMY' THEN 'Budget line' WHEN 'SMALL' THEN 'Compact line' WHEN 'MEDIUM' THEN 'Middle line'
            WHEN 'LARGE' THEN 'Bulk line' WHEN 'PROMO' THEN 'On offer' END AS part_label
        FROM (
            SELECT p_partkey, p_name, p_type, count(l_orderkey) AS n_lines
            FROM part JOIN lineitem ON p_partkey = l_partkey
            GROUP BY p_partkey, p_name, p_type ORDER BY n_lines DESC, p_partkey LIMIT 5) q
    """,
    "revenue_by_label": f"""
        SELECT full_address, CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue
        FROM ({LINE_REVENUE}) r JOIN customer USING (c_custkey) JOIN ({ADDRESSES}) a ON c_nationkey = n_nationkey
        GROUP BY full_address
    """,
    "revenue_by_holder": f"""
        SELECT c_custkey, full_address, CAST(revenue AS DECIMAL(38,2)) AS revenue
        FROM ({LINE_REVENUE}) r JOIN customer USING (c_custkey) JOIN ({ADDRESSES}) a ON c_nationkey = n_nationkey
    """,
    "revenue_keep_empty": f"""
        SELECT c_custkey, full_address, CAST(revenue AS DECIMAL(38,2)) AS revenue
        FROM customer LEFT JOIN ({LINE_REVENUE}) r USING (c_custkey) JOIN ({ADDRESSES}) a ON c_nationkey = n_nationkey
    """,
    "last_location_revenue": """
        WITH source AS (
            SELECT l_orderkey, s_nationkey FROM (SELECT l_orderkey, min(l_suppkey) AS s FROM lineitem GROUP BY l_orderkey) l
            JOIN supplier ON s = s_suppkey),
        in_year AS (SELECT * FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'),
        last_order AS (SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM in_year GROUP BY o_custkey),
        last_nation AS (SELECT o_custkey, s_nationkey FROM last_order JOIN source ON o_orderkey = l_orderkey)
        SELECT c_name || ' ' || c_mktsegment AS full_name, n.s_nationkey,
            CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue_contributed
        FROM in_year o JOIN source s ON o.o_orderkey = s.l_orderkey
            JOIN last_nation n ON o.o_custkey = n.o_custkey AND s.s_nationkey = n.s_nationkey
            JOIN customer c ON o.o_custkey = c_custkey
        GROUP BY c_custkey, c_name, c_mktsegment, n.s_nationkey
        ORDER BY revenue_contributed DESC, c_custkey LIMIT 3
    """,
    "period_revenue": REGION_REVENUE,
    "period_revenue_function": REGION_REVENUE,
    "published_view": REGION_REVENUE,
    "current_quarter_revenue": """
        SELECT r_name AS category_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue
        FROM (SELECT *, CAST(l_shipdate AS DATE) + CAST(current_date - DATE '2001-09-01' AS INTEGER) AS moved FROM lineitem) l
            JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE date_trunc('quarter', moved) = date_trunc('quarter', current_date)
        GROUP BY r_name HAVING sum(CAST(l_extendedprice AS DECIMAL(18,2))) > 0
    """,
    "period_revenue_by_type": f"""
        SELECT p_type, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE {IN_QUARTER} GROUP BY p_type HAVING sum(CAST(l_extendedprice AS DECIMAL(18,2))) > 0
    """,
    "period_revenue_unknown": """
        SELECT r_name AS category_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE year(l_shipdate) = year(CAST(NULL AS DATE)) GROUP BY r_name
    """,
    "no_sales": f"""
        SELECT p_partkey, p_name FROM part
        WHERE p_partkey NOT IN (SELECT DISTINCT l_partkey FROM lineitem WHERE {IN_QUARTER})
    """,
    "categories_without_sales": f"""
        SELECT c_name FROM customer WHERE c_custkey NOT IN (
            SELECT DISTINCT o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {IN_QUARTER})
    """,
    "top_count": """
        SELECT s_suppkey, s_name, count(o_orderkey) AS n_lines
        FROM supplier JOIN lineitem ON s_suppkey = l_suppkey JOIN orders ON l_orderkey = o_orderkey
        WHERE o_orderdate >= DATE '1999-01-01'
        GROUP BY s_suppkey, s_name ORDER BY n_lines DESC, s_suppkey LIMIT 5
    """,
    "top_count_keep_zero": """
        SELECT c_custkey, c_name, c_mktsegment, (
            SELECT count(l_orderkey) FROM orders JOIN lineitem ON o_orderkey = l_orderkey
            WHERE o_custkey = c_custkey AND l_shipdate >= DATE '2001-04-01') AS n_lines
        FROM customer ORDER BY n_lines DESC, c_custkey LIMIT 5
    """,
    "count_keep_zero": """
        SELECT c_custkey, c_name, c_mktsegment, (
            SELECT count(l_orderkey) FROM orders JOIN lineitem ON o_orderkey = l_orderkey
            WHERE o_custkey = c_custkey AND l_shipdate >= DATE '2001-04-01') AS n_lines
        FROM customer
    """,
    "inactivity_today": """
        SELECT c_custkey, c_name || ' ' || c_mktsegment AS full_name,
            CAST(year(current_date) - max(year(l_shipdate)) AS INTEGER) AS inactivity_years
        FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
        GROUP BY c_custkey, c_name, c_mktsegment
    """,
    "inactivity": """
        SELECT c_custkey, c_name || ' ' || c_mktsegment AS full_name,
            CAST(2026 - max(year(l_shipdate)) AS INTEGER) AS inactivity_years
        FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
        GROUP BY c_custkey, c_name, c_mktsegment
    """,
    "inactivity_keep_empty": """
        SELECT c_custkey, c_name || ' ' || c_mktsegment AS full_name, CAST(2026 - (
            SELECT max(year(l_shipdate)) FROM orders JOIN lineitem ON o_orderkey = l_orderkey
            WHERE o_custkey = c_custkey AND l_returnflag = 'R' AND l_shipdate < DATE '1996-07-01') AS INTEGER) AS inactivity_years
        FROM customer
    """,
    "gap_years": f"""
        WITH years AS ({RETURN_YEARS}),
        pairs AS (
            SELECT a.c_custkey, a.y AS current_year, min(b.y) AS next_year
            FROM years a JOIN years b ON a.c_custkey = b.c_custkey AND b.y > a.y GROUP BY a.c_custkey, a.y)
        SELECT c_custkey, c_name || ' ' || c_mktsegment AS full_name,
            CAST(sum(next_year - current_year) AS BIGINT) AS total_inactivity_years
        FROM pairs JOIN customer USING (c_custkey) GROUP BY c_custkey, c_name, c_mktsegment
    """,
    "gap_list": f"""
        WITH years AS ({RETURN_YEARS})
        SELECT a.c_custkey, a.y AS current_year, min(b.y) AS next_year
        FROM years a JOIN years b ON a.c_custkey = b.c_custkey AND b.y > a.y GROUP BY a.c_custkey, a.y
    """,
    "most_popular": """
        WITH counts AS (
            SELECT n_name, p_name, p_brand, lower(p_type) AS type_name, p_size, 2000 AS release_year, count(l_orderkey) AS n
            FROM nation JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey
                JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
            WHERE n_name IN ('NATION_1', 'NATION_5', 'NATION_13', 'Atlantis')
            GROUP BY ALL),
        best AS (SELECT n_name, max(n) AS n FROM counts GROUP BY n_name)
        SELECT c.n_name, p_name, p_brand, type_name, p_size, release_year
        FROM counts c JOIN best b ON c.n_name = b.n_name AND c.n = b.n
    """,
    "most_popular_long_list": """
        WITH counts AS (
            SELECT n_name, p_name, p_brand, lower(p_type) AS type_name, p_size, 2000 AS release_year, count(l_orderkey) AS n
            FROM nation JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey
                JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
            WHERE n_name IN (SELECT 'NATION_' || k FROM range(1, 1400, 2) r(k))
            GROUP BY ALL),
        best AS (SELECT n_name, max(n) AS n FROM counts GROUP BY n_name)
        SELECT c.n_name, p_name, p_brand, type_name, p_size, release_year
        FROM counts c JOIN best b ON c.n_name = b.n_name AND c.n = b.n
    """,
    "in_stock": """
        WITH found AS (
            SELECT p_name, p_partkey, lower(p_brand) AS brand, c_name || ' ' || c_mktsegment AS customer_name,
                o_orderdate, o_orderkey, c_custkey
            FROM part JOIN lineitem i ON p_partkey = i.l_partkey JOIN orders r ON i.l_orderkey = r.o_orderkey
                JOIN customer ON r.o_custkey = c_custkey
            WHERE p_name ILIKE '%RED%'
              AND EXISTS (
                SELECT 1 FROM lineitem i2 LEFT JOIN orders r2 ON i2.l_orderkey = r2.o_orderkey AND r2.o_orderstatus = 'O'
                WHERE i2.l_partkey = p_partkey AND r2.o_orderkey IS NULL)
              AND o_orderdate = (
                SELECT max(r3.o_orderdate) FROM orders r3 JOIN lineitem i3 ON r3.o_orderkey = i3.l_orderkey
                WHERE i3.l_partkey = p_partkey))
        SELECT row_number() OVER (ORDER BY p_name, p_partkey, o_orderdate, o_orderkey, c_custkey) AS row_num,
            p_name, brand, customer_name, o_orderdate
        FROM found
    """,
    "register_items": f"""
        SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY a.seq) AS film_id, a.title,
            2026 AS release_year, l.language_id, 3 AS rental_duration,
            CAST(4.99 AS DECIMAL(4,2)) AS rental_rate, CAST(19.99 AS DECIMAL(5,2)) AS replacement_cost
        FROM ({ACCEPTED}) a JOIN ({ALL_LANGUAGES}) l ON upper(l.name) = upper(a.language)
    """,
    "register_languages": ALL_LANGUAGES,
    "register_rejected": f"""
        SELECT r.seq, r.title, CASE WHEN trim(r.title) = '' THEN 'Movie title cannot be NULL or empty'
            WHEN r.language IS NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE upper(c.c_name) = upper(r.title))
                AND NOT EXISTS (SELECT 1 FROM ({ACCEPTED}) b WHERE upper(b.title) = upper(r.title) AND b.seq < r.seq)
                THEN 'Language cannot be NULL'
            ELSE 'Movie with this title already exists' END AS reason
        FROM ({REQUESTS}) r WHERE r.seq NOT IN (SELECT seq FROM ({ACCEPTED}) a)
    """,
    "eligible_first": """
        SELECT c_custkey FROM customer
            JOIN (SELECT o_custkey, count(DISTINCT o_orderkey) AS n FROM orders GROUP BY o_custkey) o ON c_custkey = o.o_custkey
            JOIN (SELECT o_custkey, count(DISTINCT l_partkey) AS m FROM orders JOIN lineitem ON o_orderkey = l_orderkey
                  GROUP BY o_custkey) l ON c_custkey = l.o_custkey
        WHERE n >= 15 AND m >= 60 ORDER BY c_custkey LIMIT 1
    """,
    "any_with_both": """
        SELECT c_custkey, c_name, c_mktsegment FROM customer
        WHERE c_custkey IN (SELECT o_custkey FROM orders)
          AND c_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
        ORDER BY c_custkey LIMIT 1
    """,
    "thin_generated": """
        SELECT col FROM (SELECT 'row number ' || CAST(o_orderkey AS VARCHAR) AS col FROM orders) t
        WHERE NOT CAST(replace(col, 'row number ', '') AS BIGINT) % 3 = 0
    """,
    "insert_absent": ADDED_COMPANIES,
    "insert_absent_table": f"""
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer UNION ALL {ADDED_COMPANIES}
    """,
    "insert_absent_composite": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem b
        WHERE NOT EXISTS (
            SELECT 1 FROM lineitem t
            WHERE t.l_returnflag = 'R' AND t.l_orderkey = b.l_orderkey AND t.l_linenumber = b.l_linenumber)
    """,
    "anti_or": """
        SELECT c_custkey, c_name FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)
          AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_acctbal = c_acctbal)
    """,
    "resolve_keys": f"""
        SELECT o_orderkey, c_custkey AS customer_id, r_regionkey AS region_id
        FROM ({BATCH}) b LEFT JOIN customer ON lower(c_name) = lower(customer_name)
            LEFT JOIN region ON lower(r_name) = lower(region_name)
    """,
    "resolve_keys_join": f"""
        SELECT o_orderkey, c_custkey AS customer_id, r_regionkey AS region_id
        FROM ({BATCH}) b JOIN customer ON lower(c_name) = lower(customer_name)
            JOIN region ON lower(r_name) = lower(region_name)
    """,
    "update_where": f"""
        SELECT c_custkey, c_name, c_nationkey, CASE WHEN {VIP} THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
            CASE WHEN {VIP} THEN 'VIP' ELSE c_mktsegment END AS c_mktsegment
        FROM customer
    """,
    "update_where_rows": f"""
        SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, 'VIP' AS c_mktsegment FROM customer WHERE {VIP}
    """,
    "delete_where": """
        SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderkey % 3 = 0)
    """,
    "delete_where_rows": """
        SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 = 0
    """,
    "delete_children": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE l_orderkey NOT IN ({DEBTOR_ORDERS})
    """,
    "delete_parents": f"SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN ({DEBTOR_ORDERS})",
    "forget_customer": "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey <> 42",
    "load_rows": LOADED,
    "load_table": f"SELECT * FROM supplier UNION ALL SELECT * FROM ({LOADED}) l",
    "derive_rentals": RENTED,
    "derive_payments": f"""
        SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY rental_id) AS payment_id,
            {RICHEST} AS customer_id, staff_id, rental_id, CAST(p_retailprice AS DECIMAL(18,2)) AS amount,
            TIMESTAMP '2021-05-04' AS payment_date
        FROM ({ALL_RENTED}) r JOIN part ON inventory_id = p_partkey
        WHERE upper(p_name) IN ('RED WIDGET', 'HOT RING', 'SMALL WIDGET')
          AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = rental_id)
    """,
    "create_missing": """
        SELECT n_nationkey, n_name, n_regionkey FROM nation
        UNION ALL
        SELECT CAST((SELECT max(n_nationkey) FROM nation) + row_number() OVER (ORDER BY o_orderpriority) AS INTEGER),
            o_orderpriority, CAST(NULL AS INTEGER)
        FROM (SELECT DISTINCT o_orderpriority FROM orders) p
    """,
    "assign_keys": """
        SELECT s_name AS c_name, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_name) AS c_custkey
        FROM supplier
    """,
    "number_lines": """
        SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_num FROM orders
    """,
    "fill_defaults": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS note, DATE '2026-01-01' AS record_ts
        FROM orders
    """,
    "add_column": "SELECT o_orderkey, DATE '2026-01-01' AS record_ts FROM orders",
    "column_completeness": """
        SELECT count(*) AS total_rows, count(record_ts) AS non_null_rows
        FROM (SELECT l_orderkey, DATE '2026-01-01' AS record_ts FROM lineitem) t
    """,
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """,
    "null_violations": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
    "fk_orphans": """
        SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
        WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 25)
    """,
    "check_set": "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderstatus IN ('F', 'O'))",
    "check_interval": """
        SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE NOT (l_shipdate IS NULL OR l_shipdate > o_orderdate)
    """,
    "length_rule": "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 9",
    "rule_report": RULES,
    "row_policy": """
        SELECT o_orderkey, o_custkey AS customer_id FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """,
    "row_policy_unknown": "SELECT o_orderkey, o_custkey AS customer_id FROM orders WHERE FALSE",
    "storage_rows": """
        SELECT 'region' AS table_name, count(*) AS row_count FROM region
        UNION ALL SELECT 'customer', count(*) FROM customer
        UNION ALL SELECT 'supplier', count(*) FROM supplier
        UNION ALL SELECT 'orders', count(*) FROM orders
        UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    """,
    "readable_sizes": f"SELECT o_orderkey, size, {_readable('size')} AS readable FROM (SELECT o_orderkey, {SIZE} AS size FROM orders) s",
    "compact": """
        SELECT l_returnflag, l_linestatus, count(*) AS n,
            CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS price
        FROM lineitem WHERE l_returnflag <> 'R' OR l_linestatus = 'F' GROUP BY l_returnflag, l_linestatus
    """,
    "text_expressions": """
        SELECT c_custkey, split_part(lower(trim(c_name)) || '@' || lower(c_mktsegment) || '.example', '@', 2) AS mail_domain,
            c_name || ' ' || coalesce(CASE WHEN c_acctbal >= 0 THEN c_mktsegment END, ' ') AS full_address,
            CAST(replace(c_name, 'Customer#', '') AS INTEGER) AS number_part,
            CAST(replace(c_name, 'Customer#', '') AS INTEGER) % 3 AS remainder,
            CAST(pow(2, c_nationkey) AS BIGINT) AS power
        FROM customer
    """,
    "date_expressions": """
        SELECT o_orderkey, year(o_orderdate) AS order_year, quarter(o_orderdate) AS order_quarter,
            o_orderdate + INTERVAL 7 DAY AS due, CAST(o_orderdate AS DATE) AS order_day
        FROM orders
    """,
    "monthly_payments": """
        SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS n,
               CAST(sum(CASE WHEN month(l_shipdate) = 2
                             THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,2))
                             ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DECIMAL(38,2)) AS revenue
        FROM lineitem WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1997-04-01' GROUP BY 1
    """,
    "delete_cascade": """
        WITH n AS (SELECT *, n_name = 'NATION_5' AS gone FROM nation),
        c AS (SELECT customer.*, coalesce(n.gone, false) AS gone FROM customer LEFT JOIN n ON c_nationkey = n_nationkey),
        s AS (SELECT supplier.*, coalesce(n.gone, false) AS gone FROM supplier LEFT JOIN n ON s_nationkey = n_nationkey),
        o AS (SELECT orders.*, coalesce(c.gone, false) AS gone FROM orders LEFT JOIN c ON o_custkey = c_custkey),
        l AS (SELECT coalesce(o.gone, false) OR coalesce(s.gone, false) AS gone
              FROM lineitem LEFT JOIN o ON l_orderkey = o_orderkey LEFT JOIN s ON l_suppkey = s_suppkey),
        a AS (SELECT 'nation' AS table_name, gone FROM n UNION ALL SELECT 'customer', gone FROM c UNION ALL SELECT 'supplier', gone FROM s
              UNION ALL SELECT 'orders', gone FROM o UNION ALL SELECT 'lineitem', gone FROM l)
        SELECT table_name, 'kept' AS state, count(*) FILTER (NOT gone) AS n FROM a GROUP BY 1
        UNION ALL SELECT table_name, 'gone', count(*) FILTER (gone) FROM a GROUP BY 1
    """,
    "kept_up_orders": """
        SELECT o_custkey, count(*) AS n_rows,
               CAST(sum(CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 AND o_orderkey % 10 <> 0 THEN 2 ELSE 1 END
                        * CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sum_price,
               max(o_orderdate) AS max_day
        FROM orders WHERE o_orderkey % 10 = 0 OR o_orderstatus <> 'F' GROUP BY o_custkey
    """,
    "most_popular_lateral": """
        WITH counts AS (
            SELECT r_name, n_name, p_name, p_brand, lower(p_type) AS type_name, p_size, 2000 AS release_year, count(l_orderkey) AS n
            FROM nation JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey
                JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
                JOIN region ON n_regionkey = r_regionkey
            GROUP BY ALL),
        best AS (SELECT n_name, max(n) AS n FROM counts GROUP BY n_name)
        SELECT r_name, c.n_name, p_name, p_brand, type_name, p_size, release_year
        FROM counts c JOIN best b ON c.n_name = b.n_name AND c.n = b.n
    """,
    "most_popular_literal": """
        WITH counts AS (
            SELECT n_name, p_name, p_brand, lower(p_type) AS type_name, p_size, 2000 AS release_year, count(l_orderkey) AS n
            FROM nation JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey
                JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
            WHERE n_name IN ('NATION_1', 'NATION_5', 'NATION_13')
            GROUP BY ALL),
        best AS (SELECT n_name, max(n) AS n FROM counts GROUP BY n_name)
        SELECT c.n_name, p_name, p_brand, type_name, p_size, release_year
        FROM counts c JOIN best b ON c.n_name = b.n_name AND c.n = b.n
    """,
    "in_stock_function": """
        SELECT p_name, lower(p_brand) AS brand, c_name || ' ' || c_mktsegment AS customer_name, o_orderdate
        FROM part JOIN lineitem i ON p_partkey = i.l_partkey JOIN orders r ON i.l_orderkey = r.o_orderkey
            JOIN customer ON r.o_custkey = c_custkey
        WHERE p_name ILIKE '%RED%'
          AND EXISTS (
            SELECT 1 FROM lineitem i2 LEFT JOIN orders r2 ON i2.l_orderkey = r2.o_orderkey AND r2.o_orderstatus = 'O'
            WHERE i2.l_partkey = p_partkey AND r2.o_orderkey IS NULL)
          AND o_orderdate = (
            SELECT max(r3.o_orderdate) FROM orders r3 JOIN lineitem i3 ON r3.o_orderkey = i3.l_orderkey
            WHERE i3.l_partkey = p_partkey)
    """,
    "rows_by_role": """
        WITH policies AS (
            SELECT 'orders' AS table_name, 'agent_' || lower(c_mktsegment) AS role, c_custkey AS key FROM customer
            UNION SELECT 'customer', 'agent_' || lower(c_mktsegment), c_custkey FROM customer
            UNION SELECT 'customer', 'nation_' || c_nationkey, c_custkey FROM customer),
        roles AS (SELECT DISTINCT role FROM policies WHERE role IS NOT NULL UNION SELECT 'agent_nobody'),
        rows AS (SELECT 'orders' AS table_name, o_custkey AS key FROM orders UNION ALL SELECT 'customer', c_custkey FROM customer),
        seen AS (SELECT table_name, role, count(*) AS n FROM rows JOIN policies USING (table_name, key) GROUP BY 1, 2)
        SELECT t.table_name, roles.role, coalesce(seen.n, 0) AS n_rows
        FROM roles CROSS JOIN (SELECT unnest(['orders', 'customer']) AS table_name) t
            LEFT JOIN seen ON seen.table_name = t.table_name AND seen.role = roles.role
    """,
    "role_tags": """
        SELECT o_orderkey, concat_ws(',', 'agent_' || lower(c_mktsegment), CASE WHEN c_acctbal > 0 THEN 'auditor' END) AS roles
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    """,
    "changed_files": """
        SELECT l_returnflag, CASE WHEN o_orderkey < 200 THEN 'new' ELSE 'old' END AS source, count(*) AS n,
            CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) + CASE WHEN l_orderkey BETWEEN 100 AND 400 THEN 1 ELSE 0 END) AS DECIMAL(38,2)) AS price
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE l_suppkey IS DISTINCT FROM 3 GROUP BY 1, 2
    """,
    "load_by_index": """
        SELECT 1 AS load, o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS price
        FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F' GROUP BY o_orderstatus
    """,
    "title_search": r"""
        SELECT pattern, p_partkey, p_name
        FROM part, (SELECT unnest(['%RED%', '%lue%1_', '%Part%\_%', '%zzz%', '%9']) AS pattern) WHERE p_name ILIKE pattern ESCAPE '\'
    """,
}
