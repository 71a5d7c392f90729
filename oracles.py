"""The queries of ``__spark_entry__`` as plain SQL over the given tables.

Written independently of the DataFrame code: the same relations, as common table
expressions, in the order in which they build on each other.
"""

from __future__ import annotations

# What is declared about the tables, written down here a second time so that the
# oracle does not depend on the code it judges.
NOT_NULL = {
    "film": "film_id title language_id rental_duration rental_rate replacement_cost last_update",
    "actor": "actor_id first_name last_name last_update",
    "customer": "customer_id store_id first_name last_name address_id activebool create_date",
    "staff": "staff_id first_name last_name address_id store_id active username last_update",
    "store": "store_id manager_staff_id address_id last_update",
    "rental": "rental_id rental_date inventory_id customer_id staff_id last_update",
    "payment": "payment_id customer_id staff_id rental_id amount payment_date",
    "inventory": "inventory_id film_id store_id last_update",
    "category": "category_id name last_update",
    "language": "language_id name last_update",
    "address": "address_id address district city_id phone last_update",
    "city": "city_id city country_id last_update",
    "country": "country_id country last_update",
    "film_actor": "actor_id film_id last_update",
    "film_category": "film_id category_id last_update",
    "stg_customer": "customer_id email is_active",
    "stg_film": "film_id title rental_rate",
    "stg_rental": "rental_id rental_date customer_id inventory_id",
    "stg_payment": "payment_id amount customer_id",
    "stg_inventory": "inventory_id film_id",
    "dim_customer": "customer_id full_name email customer_location",
    "dim_film": "film_id title category_name film_length_category rental_rate_category",
    "dim_store": "store_id store_location",
    "dim_date": "date_day year month quarter",
    "fct_rental": "rental_id customer_id film_id store_id",
    "rental_analytics": "rental_id customer_name film_title return_status total_revenue rental_year rental_quarter",
}
UNIQUE = {
    "actor": "actor_id",
    "address": "address_id",
    "category": "category_id",
    "city": "city_id",
    "country": "country_id",
    "customer": "customer_id",
    "film": "film_id",
    "inventory": "inventory_id",
    "language": "language_id",
    "payment": "payment_id",
    "rental": "rental_id",
    "staff": "staff_id",
    "store": "store_id",
    "stg_customer": "customer_id",
    "stg_film": "film_id",
    "stg_rental": "rental_id",
    "stg_payment": "payment_id",
    "stg_inventory": "inventory_id",
    "dim_customer": "customer_id",
    "dim_film": "film_id",
    "dim_store": "store_id",
    "dim_date": "date_day",
    "fct_rental": "rental_id",
    "rental_analytics": "rental_id",
}
RANGES = [
    ("stg_film", "rental_rate", 0, None),
    ("stg_payment", "amount", 0, None),
    ("dim_date", "month", 1, 12),
    ("dim_date", "quarter", 1, 4),
    ("fct_rental", "payment_amount", 0, None),
    ("fct_rental", "rental_duration_days", 0, None),
    ("fct_rental", "days_overdue", 0, None),
    ("rental_analytics", "total_revenue", 0, None),
    ("rental_analytics", "rental_quarter", 1, 4),
]
ACCEPTED = [
    ("dim_film", "film_length_category", ("Short", "Medium", "Long")),
    ("dim_film", "rental_rate_category", ("Budget", "Standard", "Premium", "Luxury")),
    ("rental_analytics", "return_status", ("Not Returned", "Late Return", "On Time")),
    ("rental_analytics", "payment_status", ("Overpaid", "Underpaid", "Exact", "No Payment")),
]
REFERENCES = [
    ("stg_rental", "customer_id", "stg_customer", "customer_id"),
    ("stg_payment", "customer_id", "stg_customer", "customer_id"),
    ("stg_inventory", "film_id", "stg_film", "film_id"),
    ("fct_rental", "customer_id", "dim_customer", "customer_id"),
    ("fct_rental", "film_id", "dim_film", "film_id"),
    ("fct_rental", "store_id", "dim_store", "store_id"),
]
FOREIGN_KEYS = [
    ("address", "city_id", "city", "city_id"),
    ("city", "country_id", "country", "country_id"),
    ("customer", "address_id", "address", "address_id"),
    ("film", "language_id", "language", "language_id"),
    ("film_actor", "actor_id", "actor", "actor_id"),
    ("film_actor", "film_id", "film", "film_id"),
    ("film_category", "category_id", "category", "category_id"),
    ("film_category", "film_id", "film", "film_id"),
    ("inventory", "film_id", "film", "film_id"),
    ("payment", "customer_id", "customer", "customer_id"),
    ("payment", "rental_id", "rental", "rental_id"),
    ("payment", "staff_id", "staff", "staff_id"),
    ("rental", "customer_id", "customer", "customer_id"),
    ("rental", "inventory_id", "inventory", "inventory_id"),
    ("rental", "staff_id", "staff", "staff_id"),
    ("staff", "address_id", "address", "address_id"),
    ("store", "address_id", "address", "address_id"),
    ("store", "manager_staff_id", "staff", "staff_id"),
]
PRIMARY_KEYS = {
    "actor": "actor_id",
    "address": "address_id",
    "category": "category_id",
    "city": "city_id",
    "country": "country_id",
    "customer": "customer_id",
    "film": "film_id",
    "film_actor": "actor_id film_id",
    "film_category": "film_id category_id",
    "inventory": "inventory_id",
    "language": "language_id",
    "payment": "payment_id",
    "rental": "rental_id",
    "staff": "staff_id",
    "store": "store_id",
}
UNIQUE_INDEXES = {
    "store": "manager_staff_id",
    "rental": "rental_date inventory_id customer_id",
}
RATINGS = ("G", "PG", "PG-13", "R", "NC-17")
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his "
    "himself she her hers herself it its itself they them their theirs themselves what which "
    "who whom this that these those am is are was were be been being have has had having do "
    "does did doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in out on "
    "off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will "
    "just don should now "
).split()

LOADED = "TIMESTAMP '2006-02-15 10:00:00' AS last_update"

# Base tables, named t_<table> because some names are taken by the given tables.
BASE = {
    "t_rental": """
        SELECT o.o_orderkey AS rental_id, o.o_orderdate AS rental_date, x.inventory_id,
               o.o_custkey AS customer_id,
               CASE WHEN o.o_orderstatus <> 'O' THEN x.shipped END AS return_date,
               x.staff_id, o.o_orderdate AS last_update
        FROM orders o
        LEFT JOIN (SELECT l_orderkey, max(CAST(CAST(l_partkey AS HUGEINT) * 10000000000000000000 + l_suppkey AS DECIMAL(38,0))) AS inventory_id,
                          max(l_shipdate) AS shipped, max(l_suppkey) AS staff_id
                   FROM lineitem GROUP BY l_orderkey) x ON o.o_orderkey = x.l_orderkey""",
    "t_payment": """
        SELECT CAST(CAST(l_orderkey AS HUGEINT) * 1000000000000000000 + CAST(l_linenumber AS BIGINT) * 1000000000
                    + row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_suppkey)
                    AS DECIMAL(38,0)) AS payment_id,
               o_custkey AS customer_id, l_suppkey AS staff_id, l_orderkey AS rental_id,
               CAST(l_linenumber * 0.99 AS DECIMAL(5,2)) AS amount, l_shipdate AS payment_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "t_inventory": f"""
        SELECT DISTINCT CAST(CAST(l_partkey AS HUGEINT) * 10000000000000000000 + l_suppkey AS DECIMAL(38,0)) AS inventory_id,
               l_partkey AS film_id, l_suppkey AS store_id, {LOADED} FROM lineitem""",
    "t_film_actor": f"""
        SELECT DISTINCT l_suppkey AS actor_id, l_partkey AS film_id, {LOADED} FROM lineitem""",
    "t_film": f"""
        SELECT p_partkey AS film_id, p_name AS title,
               p_type || ' ' || p_brand || ' ' || p_name AS description,
               CAST(p_size + 1890 AS INTEGER) AS release_year, 1 AS language_id,
               CAST(p_size % 7 + 1 AS INTEGER) AS rental_duration,
               CAST((p_partkey % 7) * 0.99 AS DECIMAL(4,2)) AS rental_rate,
               CASE WHEN p_size <> 50 THEN CAST(p_size * 4 AS INTEGER) END AS length,
               CAST(CAST(floor(p_retailprice / 10) AS INTEGER) + 0.99 AS DECIMAL(5,2))
                   AS replacement_cost,
               CASE WHEN p_size = 13 THEN 'NR' WHEN p_partkey % 5 = 0 THEN 'G'
                    WHEN p_partkey % 5 = 1 THEN 'PG' WHEN p_partkey % 5 = 2 THEN 'PG-13'
                    WHEN p_partkey % 5 = 3 THEN 'R' ELSE 'NC-17' END AS rating,
               {LOADED}
        FROM part""",
    "t_category": f"""
        SELECT DISTINCT CAST('0x' || substr(md5(p_type), 1, 12) AS BIGINT) AS category_id,
               p_type AS name, {LOADED} FROM part""",
    "t_film_category": f"""
        SELECT p_partkey AS film_id,
               CAST('0x' || substr(md5(p_type), 1, 12) AS BIGINT) AS category_id, {LOADED}
        FROM part""",
    "t_customer": f"""
        SELECT c_custkey AS customer_id, c_custkey * 7 % 128 AS store_id,
               split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
               replace(lower(c_name), '#', '.') || '@example.org' AS email,
               c_custkey * 2 AS address_id, c_acctbal >= 0 AS activebool,
               DATE '2006-02-14' AS create_date, {LOADED},
               CAST(c_acctbal >= 0 AS INTEGER) AS active
        FROM customer""",
    "t_staff": f"""
        SELECT s_suppkey AS staff_id, split_part(s_name, '#', 1) AS first_name,
               split_part(s_name, '#', 2) AS last_name, s_suppkey * 2 + 1 AS address_id,
               replace(lower(s_name), '#', '.') || '@example.org' AS email,
               s_suppkey AS store_id, s_acctbal >= 0 AS active, lower(s_name) AS username, {LOADED}
        FROM supplier""",
    "t_store": f"""
        SELECT s_suppkey AS store_id, s_suppkey AS manager_staff_id,
               s_suppkey * 2 + 1 AS address_id, {LOADED} FROM supplier""",
    "t_actor": f"""
        SELECT s_suppkey AS actor_id, split_part(s_name, '#', 1) AS first_name,
               split_part(s_name, '#', 2) AS last_name, {LOADED} FROM supplier""",
    "t_address": f"""
        SELECT c_custkey * 2 AS address_id, c_custkey || ' Main Street' AS address,
               CAST(NULL AS VARCHAR) AS address2, c_mktsegment AS district, c_nationkey AS city_id,
               CASE WHEN c_custkey % 10 <> 0 THEN 'Z' || c_custkey END AS postal_code,
               '555-' || c_custkey AS phone, {LOADED} FROM customer
        UNION ALL
        SELECT s_suppkey * 2 + 1, s_suppkey || ' Main Street', NULL, 'SUPPLIER', s_nationkey,
               CASE WHEN s_suppkey % 10 <> 0 THEN 'Z' || s_suppkey END,
               '555-' || s_suppkey, TIMESTAMP '2006-02-15 10:00:00' FROM supplier""",
    "t_city": f"""
        SELECT n_nationkey AS city_id, n_name AS city, n_regionkey AS country_id, {LOADED}
        FROM nation""",
    "t_country": f"SELECT r_regionkey AS country_id, r_name AS country, {LOADED} FROM region",
    "t_language": f"SELECT 1 AS language_id, 'English' AS name, {LOADED}",
}

STAGING = {
    "stg_address": """
        SELECT address_id, address AS address_line1, address2 AS address_line2, district, city_id,
               postal_code, phone, last_update FROM t_address""",
    "stg_category": "SELECT category_id, name AS category_name, last_update FROM t_category",
    "stg_city": "SELECT city_id, city AS city_name, country_id, last_update FROM t_city",
    "stg_country": "SELECT country_id, country AS country_name, last_update FROM t_country",
    "stg_customer": """
        SELECT customer_id, store_id, first_name, last_name, email, address_id,
               activebool AS is_active, create_date, last_update FROM t_customer""",
    "stg_film": """
        SELECT film_id, title, description, release_year, language_id, rental_duration,
               rental_rate, length AS length_minutes, replacement_cost, rating, last_update
        FROM t_film""",
    "stg_film_category": "SELECT film_id, category_id, last_update FROM t_film_category",
    "stg_inventory": "SELECT inventory_id, film_id, store_id, last_update FROM t_inventory",
    "stg_payment": """
        SELECT payment_id, customer_id, staff_id, rental_id, amount, payment_date FROM t_payment""",
    "stg_rental": """
        SELECT rental_id, rental_date, inventory_id, customer_id, return_date, staff_id,
               last_update, date_sub('day', rental_date, return_date) AS rental_duration_days
        FROM t_rental""",
    "stg_store": "SELECT store_id, manager_staff_id, address_id, last_update FROM t_store",
}

PLACE = """
               a.address_line1, a.address_line2, a.district, a.postal_code, a.phone,
               ci.city_name, co.country_name"""
PLACE_JOINS = """
        LEFT JOIN stg_address a ON a.address_id = b.address_id
        LEFT JOIN stg_city ci ON ci.city_id = a.city_id
        LEFT JOIN stg_country co ON co.country_id = ci.country_id"""

MARTS = {
    "dim_customer": f"""
        SELECT b.customer_id, b.first_name, b.last_name,
               b.first_name || ' ' || b.last_name AS full_name, b.email, b.is_active,
               b.create_date, b.store_id, {PLACE},
               ci.city_name || ', ' || co.country_name AS customer_location,
               b.last_update AS customer_last_update
        FROM stg_customer b {PLACE_JOINS}""",
    "dim_film": """
        SELECT b.film_id, b.title, b.description, b.release_year, b.language_id,
               b.rental_duration, b.rental_rate, b.length_minutes, b.replacement_cost, b.rating,
               c.category_name,
               CASE WHEN length_minutes < 60 THEN 'Short'
                    WHEN length_minutes >= 60 AND length_minutes <= 120 THEN 'Medium'
                    ELSE 'Long' END AS film_length_category,
               CASE WHEN rental_rate < 1 THEN 'Budget'
                    WHEN rental_rate >= 1 AND rental_rate <= 2.99 THEN 'Standard'
                    WHEN rental_rate >= 3 AND rental_rate <= 4.99 THEN 'Premium'
                    ELSE 'Luxury' END AS rental_rate_category,
               b.last_update AS film_last_update
        FROM stg_film b
        LEFT JOIN stg_film_category m ON m.film_id = b.film_id
        LEFT JOIN stg_category c ON c.category_id = m.category_id""",
    "dim_store": f"""
        SELECT b.store_id, b.manager_staff_id, {PLACE},
               ci.city_name || ', ' || co.country_name AS store_location,
               b.last_update AS store_last_update
        FROM stg_store b {PLACE_JOINS}""",
    "dim_date": """
        SELECT d AS date_day, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
               CAST(day(d) AS INTEGER) AS day, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
               CAST(dayofyear(d) AS INTEGER) AS day_of_year,
               CAST(weekofyear(d) AS INTEGER) AS week_of_year,
               strftime(d, '%Y-%m') AS year_month,
               strftime(d, '%Y-Q') || quarter(d) AS year_quarter,
               strftime(d, '%A') AS day_name, strftime(d, '%B') AS month_name,
               coalesce(dayofweek(d) IN (0, 6), false) AS is_weekend,
               coalesce(dayofweek(d) NOT IN (0, 6), false) AS is_weekday,
               coalesce(day(d) = 1, false) AS is_month_start,
               coalesce(day(d) = day(last_day(d)), false) AS is_month_end
        FROM (SELECT CAST(rental_date AS DATE) AS d FROM stg_rental
              UNION SELECT CAST(payment_date AS DATE) FROM stg_payment)""",
    "fct_rental": """
        SELECT r.rental_id, r.customer_id, i.film_id, i.store_id, r.staff_id,
               CAST(r.rental_date AS DATE) AS rental_date_id,
               CAST(r.return_date AS DATE) AS return_date_id,
               CAST(p.payment_date AS DATE) AS payment_date_id,
               r.rental_date, r.return_date, p.payment_date, r.inventory_id, p.payment_id,
               CAST(p.amount AS DECIMAL(12,2)) AS payment_amount,
               CAST(f.rental_rate AS DECIMAL(12,2)) AS expected_amount,
               r.rental_duration_days, f.rental_duration AS expected_rental_duration,
               CAST(coalesce(p.amount, 0) AS DECIMAL(12,2)) AS actual_payment,
               CAST(coalesce(p.amount, 0) - f.rental_rate AS DECIMAL(12,2)) AS payment_variance,
               r.return_date IS NULL AS is_not_returned,
               coalesce(r.rental_duration_days > f.rental_duration, false) AS is_late_return,
               CASE WHEN r.rental_duration_days > f.rental_duration
                    THEN r.rental_duration_days - f.rental_duration ELSE 0 END AS days_overdue,
               CAST(CASE WHEN r.rental_duration_days > f.rental_duration
                    THEN r.rental_duration_days - f.rental_duration ELSE 0 END
                    AS DECIMAL(12,2)) AS calculated_late_fee,
               r.last_update AS rental_last_update
        FROM stg_rental r
        LEFT JOIN stg_payment p ON p.rental_id = r.rental_id
        LEFT JOIN stg_inventory i ON i.inventory_id = r.inventory_id
        LEFT JOIN stg_film f ON f.film_id = i.film_id""",
    "rental_analytics": """
        SELECT f.rental_id, f.payment_id, f.inventory_id, c.customer_id,
               c.full_name AS customer_name, c.first_name AS customer_first_name,
               c.last_name AS customer_last_name, c.email AS customer_email,
               c.is_active AS is_active_customer, c.customer_location,
               c.city_name AS customer_city, c.country_name AS customer_country,
               c.postal_code AS customer_postal_code, c.phone AS customer_phone,
               m.film_id, m.title AS film_title, m.description AS film_description,
               m.release_year, m.rating AS film_rating, m.category_name AS film_category,
               m.length_minutes AS film_length_minutes, m.film_length_category,
               m.rental_rate AS film_rental_rate, m.rental_rate_category,
               m.replacement_cost AS film_replacement_cost,
               s.store_id, s.store_location, s.city_name AS store_city,
               s.country_name AS store_country,
               d.date_day AS rental_date, d.year AS rental_year, d.month AS rental_month,
               d.quarter AS rental_quarter, d.day_name AS rental_day_name,
               d.month_name AS rental_month_name, d.is_weekend AS is_rental_weekend,
               d.is_weekday AS is_rental_weekday,
               f.return_date, f.payment_date, f.payment_amount, f.expected_amount,
               f.actual_payment, f.payment_variance,
               f.rental_duration_days AS actual_rental_days,
               f.expected_rental_duration AS expected_rental_days, f.days_overdue,
               f.calculated_late_fee, f.is_not_returned, f.is_late_return,
               CASE WHEN f.is_not_returned THEN 'Not Returned'
                    WHEN f.is_late_return THEN 'Late Return' ELSE 'On Time' END AS return_status,
               CASE WHEN f.payment_amount IS NULL OR f.expected_amount IS NULL THEN 'No Payment'
                    WHEN f.payment_amount > f.expected_amount THEN 'Overpaid'
                    WHEN f.payment_amount < f.expected_amount THEN 'Underpaid'
                    ELSE 'Exact' END AS payment_status,
               CAST(f.actual_payment + f.calculated_late_fee AS DECIMAL(12,2)) AS total_revenue,
               coalesce(f.actual_payment + f.calculated_late_fee >= f.expected_amount, false)
                   AS is_profitable_rental,
               1 AS rental_count, f.rental_last_update
        FROM fct_rental f
        LEFT JOIN dim_customer c ON c.customer_id = f.customer_id
        LEFT JOIN dim_film m ON m.film_id = f.film_id
        LEFT JOIN dim_store s ON s.store_id = f.store_id
        LEFT JOIN dim_date d ON d.date_day = f.rental_date_id""",
}


def _film_list(name: str) -> str:
    return f"""
        SELECT f.film_id AS fid, f.title, f.description, c.name AS category,
               f.rental_rate AS price, f.length, f.rating,
               string_agg({name}, ', ' ORDER BY {name}) AS actors
        FROM t_category c
        JOIN t_film_category m ON m.category_id = c.category_id
        JOIN t_film f ON f.film_id = m.film_id
        JOIN t_film_actor x ON x.film_id = f.film_id
        JOIN t_actor a ON a.actor_id = x.actor_id
        GROUP BY ALL"""


def _people(key: str, table: str, extra: str = "") -> str:
    return f"""
        SELECT p.{key} AS id, p.first_name || ' ' || p.last_name AS name, a.address,
               a.postal_code AS "zip code", a.phone, ci.city, co.country, {extra}
               p.store_id AS sid
        FROM {table} p JOIN t_address a ON a.address_id = p.address_id
        JOIN t_city ci ON ci.city_id = a.city_id
        JOIN t_country co ON co.country_id = ci.country_id"""


REPORTS = {
    "actor_info": """
        SELECT a.actor_id, a.first_name, a.last_name, x.film_info
        FROM t_actor a
        LEFT JOIN (SELECT actor_id, string_agg(DISTINCT line, ', ' ORDER BY line) AS film_info
                   FROM (SELECT actor_id,
                                c.name || ': ' || string_agg(f.title, ', ' ORDER BY f.title) AS line
                         FROM t_film_actor fa
                         JOIN t_film_category fc ON fc.film_id = fa.film_id
                         JOIN t_film f ON f.film_id = fa.film_id
                         JOIN t_category c ON c.category_id = fc.category_id
                         GROUP BY actor_id, c.category_id, c.name)
                   GROUP BY actor_id) x ON x.actor_id = a.actor_id""",
    "customer_list": _people(
        "customer_id", "t_customer", "CASE WHEN p.activebool THEN 'active' ELSE '' END AS notes,"
    ),
    "staff_list": _people("staff_id", "t_staff"),
    "film_list": _film_list("(a.first_name || ' ' || a.last_name)"),
    "nicer_film_list": _film_list(
        "(upper(substr(a.first_name, 1, 1)) || lower(substr(a.first_name, 2))"
        " || upper(substr(a.last_name, 1, 1)) || lower(substr(a.last_name, 2)))"
    ),
    "sales_by_film_category": """
        SELECT c.name AS category, CAST(sum(p.amount) AS DECIMAL(20,2)) AS total_sales
        FROM t_payment p JOIN t_rental r ON r.rental_id = p.rental_id
        JOIN t_inventory i ON i.inventory_id = r.inventory_id
        JOIN t_film f ON f.film_id = i.film_id
        JOIN t_film_category m ON m.film_id = f.film_id
        JOIN t_category c ON c.category_id = m.category_id
        GROUP BY c.name""",
    "sales_by_store": """
        SELECT ci.city || ',' || co.country AS store,
               m.first_name || ' ' || m.last_name AS manager,
               CAST(sum(p.amount) AS DECIMAL(20,2)) AS total_sales
        FROM t_payment p JOIN t_rental r ON r.rental_id = p.rental_id
        JOIN t_inventory i ON i.inventory_id = r.inventory_id
        JOIN t_store s ON s.store_id = i.store_id
        JOIN t_address a ON a.address_id = s.address_id
        JOIN t_city ci ON ci.city_id = a.city_id
        JOIN t_country co ON co.country_id = ci.country_id
        JOIN t_staff m ON m.staff_id = s.manager_staff_id
        GROUP BY co.country, ci.city, s.store_id, m.first_name, m.last_name""",
}

STOCK = {
    "inventory_in_stock": """
        SELECT inventory_id, film_id, store_id,
               NOT EXISTS (SELECT 1 FROM t_rental r WHERE r.inventory_id = i.inventory_id
                           AND r.return_date IS NULL) AS in_stock
        FROM t_inventory i""",
    "film_in_stock": """
        SELECT film_id, store_id, inventory_id FROM inventory_in_stock WHERE in_stock""",
    "film_not_in_stock": """
        SELECT film_id, store_id, inventory_id FROM inventory_in_stock WHERE NOT in_stock""",
    "inventory_holder": """
        SELECT i.inventory_id, min(r.customer_id) AS customer_id
        FROM t_inventory i LEFT JOIN t_rental r
          ON r.inventory_id = i.inventory_id AND r.return_date IS NULL
        GROUP BY i.inventory_id""",
}

RELATIONS = STAGING | MARTS | REPORTS | STOCK


def _table(name: str) -> str:
    return name if name in RELATIONS else f"t_{name}"


def _count(relation: str, check: str, count: str) -> str:
    return f"""SELECT '{relation}' AS relation, '{check}' AS "check", n AS failures, n = 0 AS passed
        FROM ({count})"""


def _repeats(relation: str, *key: str) -> str:
    keys = ", ".join(key)
    known = " AND ".join(f"{k} IS NOT NULL" for k in key)
    return f"""SELECT count(*) AS n FROM (SELECT {keys} FROM {_table(relation)} WHERE {known}
        GROUP BY {keys} HAVING count(*) > 1)"""


def _bad_keys(relation: str, *key: str) -> str:
    keys = ", ".join(key)
    unknown = " OR ".join(f"{k} IS NULL" for k in key)
    return f"""SELECT count(*) AS n FROM (SELECT {keys} FROM {_table(relation)}
        GROUP BY {keys} HAVING count(*) > 1 OR {unknown})"""


def _lost(child: str, column: str, parent: str, parent_column: str) -> str:
    return f"""SELECT count(*) AS n FROM {_table(child)} WHERE {column} IS NOT NULL AND {column}
        NOT IN (SELECT {parent_column} FROM {_table(parent)} WHERE {parent_column} IS NOT NULL)"""


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _where(relation: str, condition: str) -> str:
    return f"SELECT count(*) AS n FROM {_table(relation)} WHERE {condition}"


def _distinct_where(relation: str, column: str, condition: str) -> str:
    return f"SELECT count(DISTINCT {column}) AS n FROM {_table(relation)} WHERE {condition}"


def _primary_keys() -> list[str]:
    return [
        _count(r, f"primary_key_{k.replace(' ', '_')}", _bad_keys(r, *k.split()))
        for r, k in PRIMARY_KEYS.items()
    ]


def _foreign_keys() -> list[str]:
    return [_count(k[0], f"foreign_key_{k[1]}", _lost(*k)) for k in FOREIGN_KEYS]


def _unique_indexes() -> list[str]:
    return [
        _count(r, f"unique_{k.replace(' ', '_')}", _repeats(r, *k.split()))
        for r, k in UNIQUE_INDEXES.items()
    ]


def _summary() -> list[str]:
    parts = [
        _count(r, f"not_null_{c}", _where(r, f"{c} IS NULL"))
        for r, columns in NOT_NULL.items() for c in columns.split()
    ]
    for relation, column, low, high in RANGES:
        bounds = [f"{column} < {low}"] if low is not None else []
        bounds += [f"{column} > {high}"] if high is not None else []
        parts.append(_count(relation, f"accepted_range_{column}", _where(relation, " OR ".join(bounds))))
    parts += [_count(r, f"unique_{c}", _repeats(r, c)) for r, c in UNIQUE.items()]
    parts += [_count(r[0], f"relationships_{r[1]}", _lost(*r)) for r in REFERENCES]
    parts += [
        _count(r, f"accepted_values_{c}", _distinct_where(r, c, f"{c} NOT IN ({_quoted(values)})"))
        for r, c, values in ACCEPTED
    ]
    parts += [
        _count("fct_rental", "negative_payments", _where("fct_rental", "payment_amount < 0")),
        _count("fct_rental", "returned_before_rented",
               _where("fct_rental", "return_date < rental_date")),
        _count("rental_analytics", "revenue_mismatches",
               _where("rental_analytics",
                      "abs(total_revenue - actual_payment - calculated_late_fee) > 0.01")),
        _count("fct_rental", "orphan_rentals",
               "SELECT count(*) AS n FROM fct_rental f LEFT JOIN dim_customer c"
               " ON c.customer_id = f.customer_id WHERE c.customer_id IS NULL"),
    ]
    return parts


def _lost_values(child: str, column: str, parent: str, parent_column: str) -> str:
    return f"""SELECT '{child}' AS relation, '{column}' AS "column", CAST({column} AS VARCHAR) AS value,
        count(*) AS n_records FROM {_table(child)} WHERE {column} IS NOT NULL AND {column}
        NOT IN (SELECT {parent_column} FROM {_table(parent)}) GROUP BY {column}"""


def _odd_values(relation: str, column: str, accepted) -> str:
    return f"""SELECT '{relation}' AS relation, '{column}' AS "column", {column} AS value,
        count(*) AS n_records FROM {_table(relation)} WHERE {column} NOT IN ({_quoted(accepted)})
        GROUP BY {column}"""


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _base_changes() -> str:
    """Every base table against its earlier state, by what that state lacks or holds otherwise."""
    moment = "TIMESTAMP '1998-01-01'"
    found = {
        "rental": f"CASE WHEN rental_date >= {moment} THEN 'added' WHEN return_date >= {moment} THEN 'changed' ELSE 'unchanged' END",
        "payment": f"CASE WHEN payment_date < {moment} THEN 'unchanged' ELSE 'added' END",
        "inventory": "CASE WHEN film_id % 50 = 1 THEN 'added' ELSE 'unchanged' END",
        "film": "CASE WHEN film_id % 50 = 2 THEN 'changed' ELSE 'unchanged' END",
        "customer": "CASE customer_id % 50 WHEN 3 THEN 'changed' WHEN 4 THEN 'added' ELSE 'unchanged' END",
    }
    return _union(
        [
            f"SELECT '{name}' AS relation, change, count(*) AS n_rows FROM"
            f" (SELECT {found.get(name, chr(39) + 'unchanged' + chr(39))} AS change FROM t_{name}) GROUP BY change"
            for name in PRIMARY_KEYS
        ]
    )


EARLIER = """(SELECT rental_id, rental_date, inventory_id, customer_id,
        CASE WHEN return_date < TIMESTAMP '1998-01-01' THEN return_date END AS return_date,
        staff_id, last_update FROM t_rental WHERE rental_date < TIMESTAMP '1998-01-01')"""
OTHERS = {
    "customer_balance": """
        SELECT c.customer_id, coalesce(f.fees, 0)::DECIMAL(20,2) AS rental_fees,
               coalesce(f.late, 0)::DECIMAL(20,2) AS late_fees,
               coalesce(p.paid, 0)::DECIMAL(20,2) AS payments,
               (coalesce(f.fees, 0) + coalesce(f.late, 0) - coalesce(p.paid, 0))::DECIMAL(20,2)
                   AS balance
        FROM t_customer c
        LEFT JOIN (SELECT r.customer_id, sum(f.rental_rate) AS fees,
                          sum(CASE WHEN date_sub('day', rental_date, return_date) > rental_duration
                              THEN date_sub('day', rental_date, return_date) - rental_duration
                              ELSE 0 END) AS late
                   FROM t_rental r JOIN t_inventory i ON i.inventory_id = r.inventory_id
                   JOIN t_film f ON f.film_id = i.film_id
                   WHERE rental_date <= TIMESTAMP '1998-07-01' GROUP BY r.customer_id) f
          ON f.customer_id = c.customer_id
        LEFT JOIN (SELECT customer_id, sum(amount) AS paid FROM t_payment
                   WHERE payment_date <= TIMESTAMP '1998-07-01' GROUP BY customer_id) p
          ON p.customer_id = c.customer_id""",
    "rewards_report": """
        SELECT c.* FROM t_customer c JOIN (
            SELECT customer_id FROM t_payment
            WHERE CAST(payment_date AS DATE) BETWEEN DATE '1998-04-01' AND DATE '1998-04-30'
            GROUP BY customer_id HAVING sum(amount) > 5.00 AND count(customer_id) > 1) t
          ON t.customer_id = c.customer_id""",
    "last_day_of_month": """
        SELECT rental_id, rental_date, last_day(rental_date) AS month_end FROM t_rental""",
    "mart_row_counts": _union(
        [f"SELECT '{r}' AS relation, count(*) AS n_rows FROM {r}" for r in STAGING | MARTS]
    ),
    "copy_text_film": """
        SELECT film_id, title, description, release_year,
               CAST(language_id AS BIGINT) AS language_id,
               CAST(rental_duration AS SMALLINT) AS rental_duration, rental_rate,
               CAST(length AS SMALLINT) AS length, replacement_cost, rating, last_update
        FROM t_film""",
    "ingested_customer_list": 'SELECT * RENAME ("zip code" AS zip_code) FROM customer_list',
    "dq_unique": """
        SELECT rental_id, count(*) AS n_records FROM fct_rental GROUP BY rental_id
        HAVING count(*) > 1 AND rental_id IS NOT NULL""",
    "dq_not_null": "SELECT rental_id, customer_id FROM fct_rental WHERE film_id IS NULL",
    "dq_relationships": _union(
        [_lost_values(*r) for r in REFERENCES]
        + [_lost_values("stg_customer", "store_id", "stg_store", "store_id")]
    ),
    "dq_accepted_values": _union(
        [_odd_values(r, c, v) for r, c, v in ACCEPTED]
        + [_odd_values("rental_analytics", "film_rating", ("G", "PG", "PG-13"))]
    ),
    "dq_accepted_range": """
        SELECT rental_id, payment_id, rental_duration_days FROM fct_rental
        WHERE rental_duration_days < 0""",
    "dq_singular_orphans": """
        SELECT f.rental_id, f.customer_id FROM fct_rental f
        LEFT JOIN dim_customer c ON c.customer_id = f.customer_id WHERE c.customer_id IS NULL""",
    "dq_singular_negative_payment": """
        SELECT payment_id, customer_id, payment_amount FROM fct_rental WHERE payment_amount < 0""",
    "dq_singular_return_before_rental": """
        SELECT rental_id, rental_date, return_date FROM fct_rental
        WHERE return_date IS NOT NULL AND return_date < rental_date""",
    "dq_singular_revenue": """
        SELECT rental_id, actual_payment, calculated_late_fee, total_revenue,
               actual_payment + calculated_late_fee AS calculated_total
        FROM rental_analytics
        WHERE abs(total_revenue - (actual_payment + calculated_late_fee)) > 0.01""",
    "dq_primary_key": _union(_primary_keys()),
    "dq_foreign_key": _union(_foreign_keys()),
    "dq_unique_index": _union(_unique_indexes()),
    "dq_enum": f"""
        SELECT rating AS value, count(*) AS n_records FROM t_film
        WHERE rating NOT IN ({_quoted(RATINGS)}) GROUP BY rating""",
    "dq_domain": """
        SELECT film_id, release_year FROM t_film WHERE release_year NOT BETWEEN 1901 AND 2155""",
    "dq_summary": _union(_summary()),
    "refresh_diff": f"""
        SELECT change, count(*) AS n_rows FROM (
            SELECT CASE WHEN o.rental_id IS NULL THEN 'added'
                        WHEN o.return_date IS NOT DISTINCT FROM n.return_date THEN 'unchanged'
                        ELSE 'changed' END AS change
            FROM t_rental n LEFT JOIN {EARLIER} o ON n.rental_id = o.rental_id) GROUP BY change""",
    "upsert_stamped": f"""
        SELECT n.rental_id, n.rental_date, n.inventory_id, n.customer_id, n.return_date, n.staff_id,
               CASE WHEN o.rental_id IS NULL OR o.return_date IS NOT DISTINCT FROM n.return_date
                    THEN n.last_update ELSE TIMESTAMP '1999-01-01' END AS last_update
        FROM t_rental n LEFT JOIN {EARLIER} o ON n.rental_id = o.rental_id""",
    "dq_unique_wide": """
        SELECT rental_id, customer_id, payment_date, amount, count(*) AS n_records FROM t_payment
        GROUP BY ALL HAVING count(*) > 1 AND payment_date IS NOT NULL""",
    "dq_orphans_found": """
        SELECT f.rental_id, f.customer_id FROM fct_rental f
        LEFT JOIN (SELECT customer_id FROM dim_customer WHERE customer_id % 50 <> 7) c
          ON c.customer_id = f.customer_id WHERE c.customer_id IS NULL""",
    "dq_negatives_found": """
        SELECT payment_id, customer_id, (-payment_amount)::DECIMAL(12,2) AS payment_amount
        FROM fct_rental WHERE payment_id % 97 = 5 AND payment_amount > 0""",
    "dq_mismatches_found": """
        SELECT rental_id, actual_payment, calculated_late_fee, (total_revenue + 0.02)::DECIMAL(12,2) AS total_revenue,
               actual_payment + calculated_late_fee AS calculated_total
        FROM rental_analytics WHERE rental_id % 97 = 3""",
    "loaded_defaults": """
        SELECT film_id, rental_duration::SMALLINT AS rental_duration, 4.99::DECIMAL(4,2) AS rental_rate, replacement_cost,
               CASE WHEN rating = 'NR' THEN 'G' ELSE rating END AS rating, TIMESTAMP '2020-01-01' AS last_update
        FROM t_film""",
    "defaults_now": "SELECT film_id, true AS is_recent FROM t_film",
    "sql_group_concat": """
        SELECT category_id, string_agg(title, ', ' ORDER BY title) AS titles,
               string_agg(DISTINCT rating, ', ' ORDER BY rating) AS ratings
        FROM t_film JOIN t_film_category USING (film_id) GROUP BY category_id""",
    "base_changes": _base_changes(),
    "long_lists": """
        SELECT amount, day, n_texts,
               CAST(sum(n_texts) OVER (PARTITION BY amount ORDER BY day) - n_texts + 1 AS BIGINT) AS first_place
        FROM (SELECT amount, CAST(payment_date AS VARCHAR) AS day, count(*) AS n_texts
              FROM t_payment GROUP BY ALL)""",
    "category_titles": """
        SELECT category_id, string_agg(title, ', ' ORDER BY title) AS titles
        FROM t_film JOIN t_film_category USING (film_id) GROUP BY category_id""",
    "phrase_hits": """
        SELECT phrase, film_id, i::INTEGER AS position FROM (
            SELECT phrase, film_id, words, wanted, unnest(generate_series(1, len(words))) AS i
            FROM (SELECT film_id, list_filter(string_split_regex(lower(description || ' ' || title), '[^\\p{L}\\p{M}\\p{N}]+'),
                                              lambda w: w <> '') AS words FROM t_film),
                 (SELECT phrase, list_filter(string_split_regex(lower(phrase), '[^\\p{L}\\p{M}\\p{N}]+'), lambda w: w <> '') AS wanted
                  FROM (VALUES ('small ring'), ('Brand 2 red'), ('economy brand 17'), ('gear'), ('hot hot'), ('brand'),
                               ('ring small'), ('nowhere at all'), ('...')) AS p(phrase)))
        WHERE len(wanted) > 0 AND words[i:i + len(wanted) - 1] = wanted""",
    "changed_payments": """
        SELECT payment_id, CASE WHEN o <> 3 THEN amount + CASE WHEN o = 1 THEN 1 ELSE 0 END END::DECIMAL(6,2) AS old_amount,
               CASE WHEN o <> 2 THEN amount END::DECIMAL(6,2) AS new_amount
        FROM (SELECT *, rental_id % 1000 AS o FROM t_payment) WHERE o IN (1, 2, 3)""",
    "row_history": """
        SELECT rental_id, known AS return_date, min(seen) AS valid_from, nullif(max(till), TIMESTAMP '1999-01-01') AS valid_to
        FROM (SELECT rental_id, CASE WHEN return_date < seen THEN return_date END AS known, seen, seen + INTERVAL 1 YEAR AS till
              FROM t_rental, (VALUES (TIMESTAMP '1995-01-01'), (TIMESTAMP '1996-01-01'),
                                     (TIMESTAMP '1997-01-01'), (TIMESTAMP '1998-01-01')) AS m(seen)
              WHERE rental_date < seen) GROUP BY rental_id, known""",
    "row_history_as_of": """
        SELECT rental_id, rental_date, inventory_id, customer_id,
               CASE WHEN return_date < TIMESTAMP '1996-01-01' THEN return_date END AS return_date, staff_id, last_update
        FROM t_rental WHERE rental_date < TIMESTAMP '1996-01-01'""",
    "customer_balances": """
        SELECT c.customer_id, as_of, coalesce(fees, 0)::DECIMAL(20,2) AS rental_fees, coalesce(late, 0)::DECIMAL(20,2) AS late_fees,
               coalesce(paid, 0)::DECIMAL(20,2) AS payments,
               (coalesce(fees, 0) + coalesce(late, 0) - coalesce(paid, 0))::DECIMAL(20,2) AS balance
        FROM t_customer c CROSS JOIN (SELECT make_timestamp(y, m, 1, 0, 0, 0) AS as_of FROM range(1994, 1999) a(y), (VALUES (1), (7)) b(m)) d
        LEFT JOIN (SELECT r.customer_id, day, sum(f.rental_rate) AS fees,
                          sum(greatest(coalesce(date_sub('day', rental_date, return_date) - rental_duration, 0), 0)) AS late
                   FROM t_rental r JOIN t_inventory i ON i.inventory_id = r.inventory_id JOIN t_film f ON f.film_id = i.film_id
                   JOIN (SELECT make_timestamp(y, m, 1, 0, 0, 0) AS day FROM range(1994, 1999) a(y), (VALUES (1), (7)) b(m)) ON rental_date <= day
                   GROUP BY r.customer_id, day) e ON e.customer_id = c.customer_id AND e.day = as_of
        LEFT JOIN (SELECT customer_id, day, sum(amount) AS paid FROM t_payment
                   JOIN (SELECT make_timestamp(y, m, 1, 0, 0, 0) AS day FROM range(1994, 1999) a(y), (VALUES (1), (7)) b(m)) ON payment_date <= day
                   GROUP BY customer_id, day) p ON p.customer_id = c.customer_id AND p.day = as_of""",
    "maintained_fact": "SELECT * FROM fct_rental",
    "maintained_analytics": "SELECT * FROM rental_analytics",
    "dq_merged": f"""
        SELECT "check", failures FROM ({_union(_summary())})
        WHERE relation = 'fct_rental' AND "check" <> 'orphan_rentals'""",
    "staged_views": _union(
        [
            f"SELECT '{r}' AS relation, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys FROM {r}"
            for r, k in {
                "stg_address": "address_id", "stg_category": "category_id", "stg_city": "city_id",
                "stg_country": "country_id", "stg_customer": "customer_id", "stg_film": "film_id",
                "stg_film_category": "film_id", "stg_inventory": "inventory_id",
                "stg_payment": "payment_id", "stg_rental": "rental_id", "stg_store": "store_id",
            }.items()
        ]
    ),
    "stored_keys": """
        SELECT r.rental_id, r.customer_id, CAST(i.film_id AS BIGINT) AS film_id, i.store_id
        FROM t_rental r LEFT JOIN t_inventory i ON i.inventory_id = r.inventory_id""",
    "full_refresh": "SELECT * FROM t_rental",
    "column_defaults": """
        SELECT film_id, rental_duration, rental_rate, replacement_cost,
               CASE WHEN rating = 'NR' THEN 'G' ELSE rating END AS rating,
               TIMESTAMP '2020-01-01' AS last_update FROM t_film""",
    "title_token_index": f"""
        SELECT token, film_id, string_agg(position, ',' ORDER BY position) AS positions
        FROM (SELECT film_id, unnest(words) AS token,
                     unnest(range(1, len(words) + 1)) AS position
              FROM (SELECT film_id, list_filter(
                        string_split_regex(lower(title || ' ' || description), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+'),
                        lambda w: w <> '') AS words FROM t_film))
        WHERE token NOT IN ({_quoted(STOP_WORDS)})
        GROUP BY token, film_id""",
}


def oracle_sql() -> dict[str, str]:
    ctes = BASE | RELATIONS
    with_clause = "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    finals = {name: f"SELECT * FROM {name}" for name in RELATIONS} | OTHERS
    finals["refresh_tree_diff"] = OTHERS["refresh_diff"]
    return {name: f"{with_clause}\n{sql}" for name, sql in finals.items()}
