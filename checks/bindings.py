"""The retail tables over the test tables as SQL, for the DuckDB side of the checks."""

import re

SOLD = """
  SELECT l.*, o.o_custkey, date_diff('day', DATE '1970-01-01', CAST(o.o_orderdate AS DATE)) AS day,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) // CAST(l_quantity AS BIGINT)
              AS DECIMAL(12,0)) * 0.01 AS unit_price,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS discount,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.6 AS DECIMAL(12,2)) AS cost
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

PLACES = """
  SELECT n_nationkey, n_name, r_name, CAST(-5 - n_regionkey % 2 AS DECIMAL(5,2)) AS gmt_offset
  FROM nation JOIN region ON n_regionkey = r_regionkey"""

RETAIL = {
    "sold": SOLD,
    "places": PLACES,
    "store_sales": """
  SELECT day AS ss_sold_date_sk, l_partkey AS ss_item_sk, o_custkey AS ss_customer_sk,
         o_custkey AS ss_cdemo_sk, o_custkey AS ss_addr_sk, l_suppkey AS ss_store_sk,
         CAST(round(l_discount * 100) AS BIGINT) AS ss_promo_sk, l_orderkey AS ss_ticket_number,
         quantity AS ss_quantity, unit_price AS ss_sales_price, discount AS ss_ext_discount_amt,
         price AS ss_ext_sales_price, cost AS ss_ext_wholesale_cost,
         price + discount AS ss_ext_list_price, price - discount AS ss_net_paid,
         price - discount - cost AS ss_net_profit
  FROM sold WHERE l_linestatus = 'O'""",
    "web_sales": """
  SELECT day AS ws_sold_date_sk, (l_orderkey * 37 + l_partkey * 11) % 86400 AS ws_sold_time_sk,
         l_partkey AS ws_item_sk, o_custkey AS ws_bill_customer_sk, o_custkey AS ws_ship_hdemo_sk,
         l_partkey % 5 + 1 AS ws_web_page_sk, l_suppkey AS ws_warehouse_sk,
         l_orderkey AS ws_order_number, quantity AS ws_quantity, unit_price AS ws_sales_price,
         discount AS ws_ext_discount_amt, price AS ws_ext_sales_price, cost AS ws_ext_wholesale_cost,
         price + discount AS ws_ext_list_price, price - discount AS ws_net_paid
  FROM sold WHERE l_linestatus = 'F'""",
    "store_returns": """
  SELECT date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS sr_returned_date_sk,
         l_partkey AS sr_item_sk, o_custkey AS sr_customer_sk, l_orderkey AS sr_ticket_number,
         quantity AS sr_return_quantity, price AS sr_return_amt
  FROM sold WHERE l_linestatus = 'O' AND l_returnflag = 'R'""",
    "web_returns": """
  SELECT date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS wr_returned_date_sk,
         l_partkey AS wr_item_sk, l_orderkey AS wr_order_number, quantity AS wr_return_quantity,
         unit_price AS wr_refunded_cash
  FROM sold WHERE l_linestatus = 'F' AND l_returnflag = 'R'""",
    "inventory": """
  SELECT day AS inv_date_sk, l_partkey % 20 AS inv_item_sk, l_suppkey % 10 AS inv_warehouse_sk,
         quantity AS inv_quantity_on_hand
  FROM sold""",
    "item": """
  SELECT p_partkey AS i_item_sk, 'I' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS i_item_id,
         p_name AS i_item_desc, CAST(p_retailprice AS DECIMAL(7,2)) AS i_current_price,
         p_size % 15 + 1 AS i_class_id,
         CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                     WHEN 'SMALL' THEN 4 WHEN 'STANDARD' THEN 5 WHEN 'PROMO' THEN 8 END AS i_category_id,
         p_type AS i_category
  FROM part""",
    "item_marketprices": """
  SELECT p_partkey * 2 + n AS imp_sk, p_partkey AS imp_item_sk,
         CAST(CAST(p_retailprice AS DECIMAL(7,2))
              * (0.8 + CAST(p_partkey % 5 + n AS DECIMAL(2,0)) * 0.1) AS DECIMAL(7,2)) AS imp_competitor_price,
         9862 + p_partkey % 300 + n * 365 AS imp_start_date,
         9862 + p_partkey % 300 + n * 365 + 180 + p_partkey % 200 AS imp_end_date
  FROM part, (VALUES (0), (1)) AS twice(n)""",
    "date_dim": """
  SELECT sk AS d_date_sk, strftime(DATE '1970-01-01' + CAST(sk AS INTEGER), '%Y-%m-%d') AS d_date,
         (sk + 3) // 7 AS d_week_seq, year(DATE '1970-01-01' + CAST(sk AS INTEGER)) AS d_year,
         month(DATE '1970-01-01' + CAST(sk AS INTEGER)) AS d_moy
  FROM range(7305, 21915) AS days(sk)""",
    "time_dim": "SELECT s AS t_time_sk, s // 3600 AS t_hour FROM range(86400) AS seconds(s)",
    "retail_customer": """
  SELECT c_custkey AS c_customer_sk, c_custkey AS c_current_cdemo_sk, c_custkey AS c_current_addr_sk,
         substr(c_name, 1, 8) AS c_first_name, substr(c_name, 10, 9) AS c_last_name,
         CASE WHEN c_acctbal >= 0 THEN 'Y' ELSE 'N' END AS c_preferred_cust_flag,
         'NATION_' || c_nationkey AS c_birth_country, lower(c_name) AS c_login,
         lower(c_name) || '@example.com' AS c_email_address
  FROM customer""",
    "customer_address": """
  SELECT c_custkey AS ca_address_sk, n_name AS ca_state, r_name AS ca_country, gmt_offset AS ca_gmt_offset
  FROM customer JOIN places ON c_nationkey = n_nationkey""",
    "customer_demographics": """
  SELECT c_custkey AS cd_demo_sk, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS cd_gender,
         CASE c_nationkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'S' ELSE 'D' END AS cd_marital_status,
         c_mktsegment AS cd_education_status
  FROM customer""",
    "household_demographics": "SELECT c_custkey AS hd_demo_sk, c_custkey % 10 AS hd_dep_count FROM customer",
    "store": """
  SELECT s_suppkey AS s_store_sk, s_name AS s_store_id,
         CASE WHEN s_suppkey % 7 = 3 THEN 'Of ' ELSE '' END
         || ['Th', 'Er', 'On', 'An', 'Re', 'He', 'In', 'Ed', 'Nd', 'Ha'][s_suppkey % 10 + 1]
         || ['the', 'ing', 'ion', 'ent', 'ati', 'hat', 'ter', 'was', 'est', 'ers'][s_suppkey // 10 % 10 + 1]
         || CASE WHEN s_suppkey < 100 THEN '' ELSE
              ['th', 'er', 'on', 'an', 're', 'he', 'in', 'ed', 'nd', 'ha'][s_suppkey // 100 % 10 + 1] END AS s_store_name,
         gmt_offset AS s_gmt_offset
  FROM supplier JOIN places ON s_nationkey = n_nationkey""",
    "warehouse": """
  SELECT s_suppkey AS w_warehouse_sk, s_name AS w_warehouse_name, n_name AS w_state
  FROM supplier JOIN places ON s_nationkey = n_nationkey""",
    "promotion": """
  SELECT p AS p_promo_sk, CASE WHEN p >= 5 THEN 'Y' ELSE 'N' END AS p_channel_dmail,
         CASE WHEN p % 3 = 0 THEN 'Y' ELSE 'N' END AS p_channel_email,
         CASE WHEN p = 10 THEN 'Y' ELSE 'N' END AS p_channel_tv
  FROM range(11) AS promos(p)""",
    "web_page": """
  SELECT * FROM (VALUES (1, 'dynamic', 5000), (2, 'order', 5500), (3, 'review', 6000),
                        (4, 'purchase', 6500), (5, 'error', 7000))
           AS page(wp_web_page_sk, wp_type, wp_char_count)""",
    "web_clickstreams": """
  SELECT date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) - 9861 AS wcs_click_date_sk,
         hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS wcs_click_time_sk,
         CASE WHEN event_type = 'purchase' THEN event_id END AS wcs_sales_sk,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS wcs_item_sk,
         CASE event_type WHEN 'click' THEN 1 WHEN 'signup' THEN 2 WHEN 'view' THEN 3
                         WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 END AS wcs_web_page_sk,
         user_id AS wcs_user_sk
  FROM events""",
    "product_reviews": """
  SELECT doc_id AS pr_review_sk,
         strftime(DATE '1970-01-01' + CAST(9862 + doc_id % 365 AS INTEGER), '%Y-%m-%d') AS pr_review_date,
         CASE WHEN quality IS NULL THEN NULL WHEN quality = 0 THEN 1 WHEN toxic = 1 THEN 3
              ELSE 5 END AS pr_review_rating,
         n_chars % 100 AS pr_item_sk, text AS pr_review_content
  FROM documents LEFT JOIN labels USING (doc_id)""",
    # helpers over the retail tables
    "clicks": """
  SELECT *, wcs_click_date_sk * 86400 + wcs_click_time_sk AS ts
  FROM web_clickstreams JOIN web_page ON wcs_web_page_sk = wp_web_page_sk""",
    "sentence": r"""
  SELECT pr_review_sk, pr_review_date, pr_item_sk, pos,
         regexp_replace(raw, '^\s+|\s+$', '', 'g') AS review_sentence
  FROM (SELECT pr_review_sk, pr_review_date, pr_item_sk, generate_subscripts(parts, 1) AS pos, unnest(parts) AS raw
        FROM (SELECT *, regexp_split_to_array(regexp_replace(pr_review_content, '([.!?]+["'')\]]*)\s+', '\1' || chr(10), 'g'), '\n+') AS parts FROM product_reviews))""",
    "lexicon": "SELECT * FROM (VALUES ('er', 'NEG'), ('that', 'NEG'), ('den', 'NEG'), ('la', 'POS'), ('with', 'POS')) AS lex(word, polarity)",
    "sentiment": r"""
  SELECT pr_review_sk, pr_review_date, pr_item_sk, pos, review_sentence,
         polarity AS sentiment, word AS sentiment_word
  FROM (SELECT DISTINCT pr_review_sk, pr_review_date, pr_item_sk, pos, review_sentence,
               unnest(regexp_split_to_array(lower(review_sentence), '[^\p{L}\p{N}]+')) AS token
        FROM sentence WHERE review_sentence <> '')
  JOIN lexicon ON token = word""",
    "falling_store": """
  SELECT s_store_sk, s_store_name
  FROM (SELECT ss_store_sk, regr_slope(paid, day) AS slope
        FROM (SELECT ss_store_sk, ss_sold_date_sk AS day, CAST(sum(ss_net_paid) AS DOUBLE) AS paid
              FROM store_sales JOIN date_dim ON ss_sold_date_sk = d_date_sk
              WHERE d_date BETWEEN '1997-01-01' AND '1999-12-31' GROUP BY ALL)
        GROUP BY ss_store_sk)
  JOIN store ON s_store_sk = ss_store_sk WHERE slope <= 0""",
}


def with_tables(sql: str) -> str:
    """Put the tables a query reads, and those they read, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in RETAIL:
            if name not in needed and re.search(rf"(\b(FROM|JOIN)\s+|,\s*){name}\b", text):
                visit(RETAIL[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    tables = ",\n".join(f"{n} AS ({RETAIL[n].strip()})" for n in needed)
    body = sql.strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(start):
            return f"{start}{tables},\n{body.removeprefix(start)}"
    return f"WITH {tables}\n{body}"
