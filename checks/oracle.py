"""Each registered query as SQL for DuckDB. Written from the meaning of the query, by
other means than the Spark code where there are any: self-joins for pairs and earlier
clicks, row-by-row joins where Spark aggregates first."""

from checks.bindings import with_tables

SESSIONS = """
  SELECT *, 1 + sum(CASE WHEN ts - before > 21600 THEN 1 ELSE 0 END)
              OVER (PARTITION BY wcs_user_sk ORDER BY ts) AS session_no
  FROM (SELECT *, lag(ts) OVER (PARTITION BY wcs_user_sk ORDER BY ts) AS before FROM {clicks})"""


def _growth(store_amount: str, web_amount: str) -> str:
    """CTE growth(key, store_ratio, web_ratio) for 1996 and 1997."""

    def totals(table: str, sold: str, key: str, amount: str) -> str:
        return f"""
      SELECT {key} AS key, CAST(sum({amount}) FILTER (WHERE d_year = 1996) AS DOUBLE) AS first,
             coalesce(CAST(sum({amount}) FILTER (WHERE d_year = 1997) AS DOUBLE), 0) AS second
      FROM {table} JOIN date_dim ON {sold} = d_date_sk WHERE d_year IN (1996, 1997)
      GROUP BY {key} HAVING sum({amount}) FILTER (WHERE d_year = 1996) > 0"""

    return f"""
    growth AS (
      SELECT s.key, s.second / s.first AS store_ratio, w.second / w.first AS web_ratio
      FROM ({totals('store_sales', 'ss_sold_date_sk', 'ss_customer_sk', store_amount)}) s
      JOIN ({totals('web_sales', 'ws_sold_date_sk', 'ws_bill_customer_sk', web_amount)}) w ON s.key = w.key
      WHERE w.second / w.first > s.second / s.first)"""


def _margin(p: str) -> str:
    return f"{p}_ext_list_price - {p}_ext_wholesale_cost - {p}_ext_discount_amt + {p}_ext_sales_price"


def _fit(points: str, group: str) -> str:
    """slope and intercept over (day, cents), from integer sums."""
    return f"""
      SELECT {group},
             CAST(n * xy - x * y AS DOUBLE) / nullif(CAST(n * xx - x * x AS DOUBLE) * 100, 0) AS slope,
             CAST(y * xx - x * xy AS DOUBLE) / nullif(CAST(n * xx - x * x AS DOUBLE) * 100, 0) AS intercept
      FROM (SELECT {group}, CAST(count(*) AS HUGEINT) AS n, sum(CAST(day AS HUGEINT)) AS x, sum(cents) AS y,
                   sum(day * cents) AS xy, sum(CAST(day * day AS HUGEINT)) AS xx
            FROM ({points}) GROUP BY {group})"""


def _week_returns(table: str, p: str) -> str:
    return f"""
      SELECT {p}_item_sk AS item_sk, sum({p}_return_quantity) AS quantity
      FROM {table} JOIN date_dim d1 ON {p}_returned_date_sk = d1.d_date_sk
      JOIN date_dim d2 ON d1.d_week_seq = d2.d_week_seq
      JOIN listed ON d2.d_date = listed.date
      GROUP BY {p}_item_sk HAVING sum({p}_return_quantity) > 0"""


def _around_price(table: str, p: str, where: str) -> str:
    sold = f"{p}_sold_date_sk"
    return f"""
      SELECT imp_sk,
             coalesce(sum({p}_quantity) FILTER (WHERE {sold} BETWEEN imp_start_date AND imp_end_date - 1), 0) AS current,
             coalesce(sum({p}_quantity) FILTER (WHERE {sold} BETWEEN 2 * imp_start_date - imp_end_date
                                                               AND imp_start_date - 1), 0) AS previous
      FROM item_marketprices JOIN {table} ON {p}_item_sk = imp_item_sk WHERE {where} GROUP BY imp_sk"""


def _last_views(views: int, seconds: int) -> str:
    """Position of every click among its user's; a sale looks back by position."""
    return f"""
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY wcs_user_sk
                                   ORDER BY ts, wcs_sales_sk NULLS FIRST, wcs_item_sk) AS pos
      FROM clicks),
    seen AS (
      SELECT sale.wcs_item_sk AS purchased_item, view.wcs_item_sk AS lastviewed_item
      FROM placed sale JOIN placed view
        ON sale.wcs_user_sk = view.wcs_user_sk AND view.pos BETWEEN sale.pos - {views} AND sale.pos - 1
      WHERE sale.wcs_item_sk = 69 AND sale.wcs_sales_sk IS NOT NULL AND sale.ts - view.ts <= {seconds})"""


def _after_review(clicks: str, seconds: int) -> str:
    """Sales with a review page at most so long before, in click order."""
    return f"""
      SELECT DISTINCT sale.wcs_sales_sk FROM {clicks} sale JOIN {clicks} page
        ON sale.wcs_user_sk = page.wcs_user_sk AND page.wp_type = 'review' AND sale.wp_type <> 'review'
       AND sale.ts - page.ts BETWEEN 0 AND {seconds}
      WHERE sale.wcs_sales_sk IS NOT NULL AND (page.ts < sale.ts OR page.wcs_sales_sk IS NULL)"""


BANDS = """
  ((cd_marital_status = 'M' AND cd_education_status = 'BUILDING' AND ss_sales_price BETWEEN 900 AND 1500)
   OR (cd_marital_status = 'S' AND cd_education_status = 'MACHINERY' AND ss_sales_price BETWEEN 1000 AND 2200)
   OR (cd_marital_status = 'D' AND cd_education_status = 'FURNITURE' AND ss_sales_price BETWEEN 500 AND 3000))
  AND ((ca_country = 'AFRICA' AND ca_state IN ('NATION_0', 'NATION_5', 'NATION_10') AND ss_net_profit BETWEEN 0 AND 20000)
   OR (ca_country = 'MIDDLE EAST' AND ca_state IN ('NATION_4', 'NATION_9') AND ss_net_profit BETWEEN 1500 AND 80000)
   OR (ca_country = 'ASIA' AND ca_state IN ('NATION_2', 'NATION_7', 'NATION_12') AND ss_net_profit BETWEEN 50 AND 25000))"""

BOUGHT_AGAIN = """
  SELECT i_item_id AS item_id, i_item_desc AS item_desc, s_store_id AS store_id, s_store_name AS store_name,
         CAST(sum(ss_quantity) AS BIGINT) AS store_sales_quantity,
         CAST(sum(sr_return_quantity) AS BIGINT) AS store_returns_quantity,
         CAST(sum(ws_quantity) AS BIGINT) AS web_sales_quantity
  FROM store_sales
  JOIN store_returns ON ss_ticket_number = sr_ticket_number AND ss_item_sk = sr_item_sk
                    AND ss_customer_sk = sr_customer_sk
  JOIN web_sales ON ws_item_sk = sr_item_sk AND ws_bill_customer_sk = sr_customer_sk
  JOIN store ON s_store_sk = ss_store_sk
  JOIN item ON i_item_sk = ss_item_sk
  {where} GROUP BY ALL"""

NAMES = r"""
  SELECT DISTINCT pr_review_sk, pr_item_sk, pos, review_sentence,
         unnest(regexp_extract_all(review_sentence, '\p{Lu}[\p{L}\p{N}]*(?: \p{Lu}[\p{L}\p{N}]*)*')) AS company_name
  FROM sentence"""
FREE_NAME = "NOT (starts_with(review_sentence, company_name) AND NOT contains(company_name, ' '))"

#: Known names by longest match: hits are taken or left one after the other.
KNOWN = r"""
  WITH RECURSIVE name AS (
    SELECT string_split(n, ' ') AS ws FROM (VALUES ('the'), ('that'), ('orre orre'), ('ernt'), ('eaux'), ('of the'),
      ('the and'), ('and the of'), ('in'), ('of')) AS v(n)),
  toks AS (
    SELECT pr_review_sk AS k, row_number() OVER () AS s, review_sentence,
           list_filter(string_split_regex(review_sentence, '[^\p{L}\p{N}]+'), lambda w: w <> '') AS ts FROM sentence),
  hit AS (
    SELECT s, spot, len(ws) AS n, row_number() OVER (PARTITION BY s ORDER BY len(ws) DESC, spot) AS r
    FROM (SELECT s, ts, unnest(range(1, len(ts) + 1)) AS spot FROM toks), name
    WHERE lower(array_to_string(ts[spot : spot + len(ws) - 1], ' ')) = array_to_string(ws, ' ')),
  walk(s, r, taken) AS (
    SELECT DISTINCT s, CAST(0 AS BIGINT), CAST([] AS STRUCT(a BIGINT, z BIGINT)[]) FROM hit
    UNION ALL
    SELECT w.s, h.r, CASE WHEN len(list_filter(taken, lambda t: t.a < h.spot + h.n AND h.spot < t.z)) > 0 THEN taken
                     ELSE list_append(taken, {'a': h.spot, 'z': h.spot + h.n}) END
    FROM walk w JOIN hit h ON h.s = w.s AND h.r = w.r + 1),
  taken AS (SELECT s, unnest(max_by(taken, r)) AS t FROM walk GROUP BY s)
  SELECT DISTINCT ON (s, company_name) k AS pr_review_sk, company_name, review_sentence
  FROM (SELECT s, k, review_sentence, array_to_string(ts[t.a : t.z - 1], ' ') AS company_name FROM taken JOIN toks USING (s))"""

MENTIONED = """
  SELECT pr_review_sk, name
  FROM product_reviews JOIN (SELECT DISTINCT lower(s_store_name) AS name FROM store)
    ON contains(lower(pr_review_content), name)"""

RETURN_FEATURES = """
  SELECT o.cid AS user_sk,
         round(coalesce(back_orders / all_orders, 0), 7) AS "orderRatio",
         round(coalesce(back_items / all_items, 0), 7) AS "itemsRatio",
         round(coalesce(back_money / all_money, 0), 7) AS "monetaryRatio",
         CAST(coalesce(back_orders, 0) AS DOUBLE) AS frequency
  FROM (SELECT ss_customer_sk AS cid, count(DISTINCT ss_ticket_number) AS all_orders, count(*) AS all_items,
               CAST(sum(ss_net_paid) AS DOUBLE) AS all_money FROM store_sales GROUP BY 1) o
  LEFT JOIN (SELECT sr_customer_sk AS cid, count(DISTINCT sr_ticket_number) AS back_orders,
                    count(*) AS back_items, CAST(sum(sr_return_amt) AS DOUBLE) AS back_money
             FROM store_returns GROUP BY 1) r ON o.cid = r.cid"""

CUSTOMERS_WITH_GAPS = """
  (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
          CASE WHEN c_nationkey % 4 <> 0 THEN CAST(c_nationkey AS BIGINT) END AS c_nationkey FROM customer)"""

ABANDONED = f"""
  SELECT wcs_user_sk, session_no, count(*) AS pagecount
  FROM (SELECT *, row_number() OVER (PARTITION BY wcs_user_sk, session_no ORDER BY ts, wp_type) AS pos
        FROM ({SESSIONS.format(clicks="clicks")}))
  GROUP BY wcs_user_sk, session_no
  HAVING coalesce(max(pos) FILTER (WHERE wp_type = 'dynamic'), -1)
       > coalesce(max(pos) FILTER (WHERE wp_type = 'order'), -1)"""

SQL = {
    "q00_sales_by_category": """
  SELECT i_category, count(*) AS cnt FROM store_sales JOIN item ON i_item_sk = ss_item_sk
  WHERE i_category_id <= 3 AND ss_store_sk IN (10, 20, 33, 40, 50) GROUP BY i_category""",
    "q01_items_sold_together": """
  WITH basket AS (
    SELECT DISTINCT ss_ticket_number AS ticket, ss_item_sk AS item
    FROM store_sales JOIN item ON i_item_sk = ss_item_sk WHERE ss_store_sk < 100)
  SELECT a.item AS item_sk_1, b.item AS item_sk_2, count(*) AS cnt
  FROM basket a JOIN basket b ON a.ticket = b.ticket AND a.item < b.item
  GROUP BY ALL HAVING count(*) > 1 ORDER BY cnt DESC, item_sk_1, item_sk_2 LIMIT 100""",
    "q02_items_viewed_together": f"""
  WITH visit AS ({SESSIONS.format(clicks="clicks")}),
  viewed AS (SELECT DISTINCT wcs_user_sk, session_no, wcs_item_sk FROM visit)
  SELECT a.wcs_item_sk AS item_sk_1, CAST(69 AS BIGINT) AS item_sk_2, count(*) AS cnt
  FROM viewed a JOIN viewed b USING (wcs_user_sk, session_no)
  WHERE b.wcs_item_sk = 69 AND a.wcs_item_sk <> 69
  GROUP BY a.wcs_item_sk ORDER BY cnt DESC, item_sk_1 LIMIT 30""",
    "q03_views_before_purchase": f"""
  WITH {_last_views(5, 864000)}
  SELECT purchased_item, lastviewed_item, count(*) AS cnt
  FROM seen JOIN item ON lastviewed_item = i_item_sk WHERE i_category_id IN (1, 2, 3, 4)
  GROUP BY ALL ORDER BY cnt DESC, purchased_item, lastviewed_item LIMIT 100""",
    "q04_abandoned_carts": f"""
  WITH visit AS ({SESSIONS.format(clicks="(SELECT * FROM clicks WHERE wcs_sales_sk IS NULL)")}),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY wcs_user_sk, session_no ORDER BY ts, wp_type) AS pos
               FROM visit)
  SELECT CAST(CAST(avg(pages) AS DECIMAL(20,1)) AS DOUBLE) AS "averageNumberOfPages"
  FROM (SELECT count(*) AS pages FROM numbered GROUP BY wcs_user_sk, session_no
        HAVING coalesce(max(pos) FILTER (WHERE wp_type = 'dynamic'), -1)
             > coalesce(max(pos) FILTER (WHERE wp_type = 'order'), -1))""",
    "q05_interest_features": """
  SELECT count(*) FILTER (WHERE i_category = 'PROMO') AS clicks_in_category,
         CAST(any_value(cd_education_status) IN ('BUILDING', 'MACHINERY') AS BIGINT) AS college_education,
         CAST(any_value(cd_gender) = 'M' AS BIGINT) AS male,
         count(*) FILTER (WHERE i_category_id = 1) AS clicks_in_1,
         count(*) FILTER (WHERE i_category_id = 2) AS clicks_in_2,
         count(*) FILTER (WHERE i_category_id = 3) AS clicks_in_3,
         count(*) FILTER (WHERE i_category_id = 4) AS clicks_in_4,
         count(*) FILTER (WHERE i_category_id = 5) AS clicks_in_5,
         count(*) FILTER (WHERE i_category_id = 6) AS clicks_in_6,
         count(*) FILTER (WHERE i_category_id = 7) AS clicks_in_7
  FROM web_clickstreams JOIN item ON wcs_item_sk = i_item_sk
  JOIN retail_customer ON wcs_user_sk = c_customer_sk
  JOIN customer_demographics ON c_current_cdemo_sk = cd_demo_sk GROUP BY wcs_user_sk""",
    "q06_web_growth_by_margin": f"""
  WITH {_growth(_margin('ss'), _margin('ws'))}
  SELECT CAST(CAST(web_ratio AS DECIMAL(15,1)) AS DOUBLE) AS web_sales_increase_ratio, c_customer_sk,
         c_first_name, c_last_name, c_preferred_cust_flag, c_birth_country, c_login, c_email_address
  FROM growth JOIN retail_customer ON key = c_customer_sk ORDER BY web_ratio DESC, c_customer_sk LIMIT 100""",
    "q07_states_buying_dear_items": """
  SELECT ca_state, count(*) AS cnt
  FROM store_sales JOIN date_dim ON ss_sold_date_sk = d_date_sk AND d_year = 1998 AND d_moy = 7
  JOIN item ON ss_item_sk = i_item_sk
  JOIN retail_customer ON ss_customer_sk = c_customer_sk
  JOIN customer_address ON c_current_addr_sk = ca_address_sk
  WHERE i_current_price > 1.03 * (SELECT avg(k.i_current_price) FROM item k WHERE k.i_category = item.i_category)
  GROUP BY ca_state HAVING count(*) >= 3 ORDER BY cnt DESC, ca_state LIMIT 10""",
    "q08_sales_after_reviews": f"""
  WITH year_clicks AS (SELECT c.* FROM clicks c JOIN date_dim ON wcs_click_date_sk = d_date_sk
                       WHERE d_date BETWEEN '1997-01-01' AND '1997-12-31'),
  after_review AS ({_after_review('year_clicks', 259200)}),
  year_sales AS (SELECT w.* FROM web_sales w JOIN date_dim ON ws_sold_date_sk = d_date_sk
                 WHERE d_date BETWEEN '1997-01-01' AND '1997-12-31')
  SELECT CAST(trunc(s.with_review) AS BIGINT) AS q08_review_sales_amount,
         CAST(trunc(a.all_sales - s.with_review) AS BIGINT) AS no_q08_review_sales_amount
  FROM (SELECT sum(ws_net_paid) AS with_review FROM year_sales
        WHERE ws_order_number IN (SELECT wcs_sales_sk FROM after_review)) s,
       (SELECT sum(ws_net_paid) AS all_sales FROM year_sales) a""",
    "q09_quantity_in_bands": f"""
  SELECT CAST(sum(ss_quantity) AS DOUBLE) AS "totalSales"
  FROM store_sales JOIN date_dim ON ss_sold_date_sk = d_date_sk AND d_year = 1996
  JOIN store ON ss_store_sk = s_store_sk JOIN customer_demographics ON ss_cdemo_sk = cd_demo_sk
  JOIN customer_address ON ss_addr_sk = ca_address_sk WHERE {BANDS}""",
    "q10_review_sentiment": """
  SELECT pr_item_sk AS item_sk, review_sentence, sentiment, sentiment_word FROM sentiment""",
    "q11_reviews_and_ratings": """
  SELECT CAST(CAST(corr(n, mean) AS DECIMAL(15,7)) AS DOUBLE) AS correlation
  FROM (SELECT pr_item_sk, count(*) AS n, avg(pr_review_rating) AS mean FROM product_reviews GROUP BY 1)
  WHERE pr_item_sk IN (SELECT ws_item_sk FROM web_sales JOIN date_dim ON ws_sold_date_sk = d_date_sk
                       WHERE d_date BETWEEN '1997-01-01' AND '1997-06-30')""",
    "q12_viewed_then_bought": """
  SELECT DISTINCT wcs_user_sk AS u_id
  FROM web_clickstreams JOIN item v ON wcs_item_sk = v.i_item_sk
  JOIN store_sales ON wcs_user_sk = ss_customer_sk AND wcs_click_date_sk < ss_sold_date_sk
  JOIN item b ON ss_item_sk = b.i_item_sk
  WHERE wcs_sales_sk IS NULL AND v.i_category IN ('PROMO', 'SMALL') AND b.i_category IN ('PROMO', 'SMALL')
    AND wcs_click_date_sk BETWEEN 9862 AND 9892 AND ss_sold_date_sk BETWEEN 9862 AND 9952""",
    "q13_web_growth_by_payment": f"""
  WITH {_growth('ss_net_paid', 'ws_net_paid')}
  SELECT c_customer_sk AS customer_id, c_first_name AS customer_first_name, c_last_name AS customer_last_name,
         CAST(CAST(store_ratio AS DECIMAL(15,2)) AS DOUBLE) AS "storeSalesIncreaseRatio",
         CAST(CAST(web_ratio AS DECIMAL(15,2)) AS DOUBLE) AS "webSalesIncreaseRatio"
  FROM growth JOIN retail_customer ON key = c_customer_sk ORDER BY web_ratio DESC, c_customer_sk LIMIT 100""",
    "q14_morning_to_evening": """
  SELECT CAST(CAST(coalesce(count(*) FILTER (WHERE t_hour IN (7, 8))
                            / nullif(count(*) FILTER (WHERE t_hour IN (19, 20)), 0), -1) AS DECIMAL(15,4)) AS DOUBLE) AS am_pm_ratio
  FROM web_sales JOIN household_demographics ON ws_ship_hdemo_sk = hd_demo_sk AND hd_dep_count = 5
  JOIN web_page ON ws_web_page_sk = wp_web_page_sk AND wp_char_count BETWEEN 5000 AND 6000
  JOIN time_dim ON ws_sold_time_sk = t_time_sk""",
    "q15_falling_categories": f"""
  SELECT CAST(cat AS BIGINT) AS cat, CAST(CAST(slope AS DECIMAL(15,7)) AS DOUBLE) AS slope,
         CAST(CAST(intercept AS DECIMAL(15,7)) AS DOUBLE) AS intercept
  FROM ({_fit('''SELECT i_category_id AS cat, ss_sold_date_sk AS day, CAST(sum(ss_net_paid) * 100 AS HUGEINT) AS cents
                 FROM store_sales JOIN item ON ss_item_sk = i_item_sk JOIN date_dim ON ss_sold_date_sk = d_date_sk
                 WHERE ss_store_sk = 10 AND d_date BETWEEN '1995-01-01' AND '2001-12-31' GROUP BY ALL''', 'cat')})
  WHERE slope <= 0""",
    "q16_sales_around_date": """
  SELECT w_state, i_item_id,
         CAST(sum(CASE WHEN d_date < '1997-06-01' THEN ws_sales_price - coalesce(wr_refunded_cash, 0) ELSE 0 END) AS DOUBLE) AS sales_before,
         CAST(sum(CASE WHEN d_date >= '1997-06-01' THEN ws_sales_price - coalesce(wr_refunded_cash, 0) ELSE 0 END) AS DOUBLE) AS sales_after
  FROM web_sales LEFT JOIN web_returns ON ws_order_number = wr_order_number AND ws_item_sk = wr_item_sk
  JOIN item ON ws_item_sk = i_item_sk JOIN warehouse ON ws_warehouse_sk = w_warehouse_sk
  JOIN date_dim ON ws_sold_date_sk = d_date_sk AND d_date BETWEEN '1997-05-02' AND '1997-07-01'
  GROUP BY w_state, i_item_id ORDER BY w_state, i_item_id LIMIT 100""",
    "q17_promoted_share": """
  WITH month_sales AS (
    SELECT ss_ext_sales_price AS amount, 'Y' IN (p_channel_dmail, p_channel_email, p_channel_tv) AS promoted
    FROM store_sales JOIN promotion ON ss_promo_sk = p_promo_sk
    JOIN date_dim ON ss_sold_date_sk = d_date_sk AND d_year = 1996 AND d_moy = 12
    JOIN item ON ss_item_sk = i_item_sk AND i_category IN ('PROMO', 'SMALL')
    JOIN store ON ss_store_sk = s_store_sk AND s_gmt_offset = -5
    JOIN retail_customer ON ss_customer_sk = c_customer_sk
    JOIN customer_address ON c_current_addr_sk = ca_address_sk AND ca_gmt_offset = -5)
  SELECT CAST(sum(amount) FILTER (WHERE promoted) AS DOUBLE) AS promotional, CAST(sum(amount) AS DOUBLE) AS total,
         CAST(CAST(100 * CAST(sum(amount) FILTER (WHERE promoted) AS DOUBLE) / CAST(sum(amount) AS DOUBLE)
                   AS DECIMAL(15,2)) AS DOUBLE) AS promo_percent
  FROM month_sales""",
    "q18_bad_words_on_falling_stores": """
  SELECT s_store_sk || '_' || s_store_name AS s_name, pr_review_date AS r_date, review_sentence AS r_sentence,
         sentiment, sentiment_word
  FROM falling_store JOIN product_reviews ON contains(lower(pr_review_content), lower(s_store_name))
  JOIN (SELECT pr_review_sk, review_sentence, sentiment, sentiment_word FROM sentiment WHERE sentiment = 'NEG')
    USING (pr_review_sk)""",
    "q19_bad_words_on_returned_items": f"""
  WITH listed AS (
    SELECT strftime(make_date(y, m, d), '%Y-%m-%d') AS date
    FROM range(1995, 2002) AS years(y), range(1, 13) AS months(m), (VALUES (10), (24)) AS days(d)
    UNION ALL SELECT '1997-03-12')
  SELECT pr_item_sk AS item_sk, review_sentence, sentiment, sentiment_word FROM sentiment
  WHERE sentiment = 'NEG' AND pr_item_sk IN (
    SELECT s.item_sk FROM ({_week_returns('store_returns', 'sr')}) s
    JOIN ({_week_returns('web_returns', 'wr')}) w ON s.item_sk = w.item_sk
    WHERE abs((s.quantity - w.quantity) / ((s.quantity + w.quantity) / 2)) <= 0.1)""",
    "q20_return_features": RETURN_FEATURES,
    "q21_returned_and_rebought": BOUGHT_AGAIN.format(where="""
  JOIN date_dim d1 ON ss_sold_date_sk = d1.d_date_sk AND d1.d_year = 1996 AND d1.d_moy = 2
  JOIN date_dim d2 ON sr_returned_date_sk = d2.d_date_sk AND d2.d_year = 1996 AND d2.d_moy BETWEEN 2 AND 8
  JOIN date_dim d3 ON ws_sold_date_sk = d3.d_date_sk AND d3.d_year BETWEEN 1996 AND 1998""")
    + " ORDER BY ALL LIMIT 100",
    "q22_stock_around_date": """
  SELECT w_warehouse_name, i_item_id, CAST(before AS BIGINT) AS inv_before, CAST(after AS BIGINT) AS inv_after
  FROM (SELECT w_warehouse_name, i_item_id,
               coalesce(sum(inv_quantity_on_hand) FILTER (WHERE d_date < '1997-06-01'), 0) AS before,
               coalesce(sum(inv_quantity_on_hand) FILTER (WHERE d_date >= '1997-06-01'), 0) AS after
        FROM inventory JOIN item ON inv_item_sk = i_item_sk JOIN warehouse ON inv_warehouse_sk = w_warehouse_sk
        JOIN date_dim ON inv_date_sk = d_date_sk
        WHERE i_current_price BETWEEN 900 AND 901 AND d_date BETWEEN '1997-05-02' AND '1997-07-01'
        GROUP BY ALL)
  WHERE before > 0 AND CAST(after AS FLOAT) / CAST(before AS FLOAT) >= CAST(0.666667 AS FLOAT) AND 2 * after <= 3 * before
  ORDER BY w_warehouse_name, i_item_id LIMIT 100""",
    "q23_uneven_stock": """
  WITH spread AS (
    SELECT inv_warehouse_sk AS w, inv_item_sk AS i, d_moy,
           CAST(stddev_samp(inv_quantity_on_hand) AS DECIMAL(15,5)) AS stdev,
           CAST(avg(inv_quantity_on_hand) AS DECIMAL(15,5)) AS mean
    FROM inventory JOIN date_dim ON inv_date_sk = d_date_sk AND d_year = 1997 AND d_moy IN (1, 2) GROUP BY ALL),
  uneven AS (SELECT *, CAST(CAST(CAST(stdev AS DOUBLE) / CAST(mean AS DOUBLE) AS DECIMAL(15,5)) AS DOUBLE) AS cov
             FROM spread WHERE mean > 0 AND CAST(stdev AS DOUBLE) / CAST(mean AS DOUBLE) >= 0.5)
  SELECT a.w AS inv_warehouse_sk, a.i AS inv_item_sk, CAST(1 AS BIGINT) AS d_moy, a.cov,
         CAST(2 AS BIGINT) AS d_moy_consecutive, b.cov AS cov_consecutive
  FROM uneven a JOIN uneven b ON a.w = b.w AND a.i = b.i AND a.d_moy = 1 AND b.d_moy = 2""",
    "q24_price_elasticity": f"""
  WITH web AS ({_around_price('web_sales', 'ws', 'imp_item_sk = 558')}),
  shop AS ({_around_price('store_sales', 'ss', 'imp_item_sk = 558')})
  SELECT CAST(558 AS BIGINT) AS i_item_sk,
         CAST(CAST(avg((w.current + s.current - w.previous - s.previous)
                       / nullif((w.previous + s.previous) * CAST(imp_competitor_price - i_current_price AS DOUBLE)
                                / CAST(i_current_price AS DOUBLE), 0)) AS DECIMAL(15,7)) AS DOUBLE) AS cross_price_elasticity
  FROM web w JOIN shop s ON w.imp_sk = s.imp_sk JOIN item_marketprices m ON m.imp_sk = w.imp_sk
  JOIN item ON i_item_sk = imp_item_sk""",
    "q25_recency_features": """
  WITH sale AS (
    SELECT 's' AS channel, ss_customer_sk AS cid, ss_ticket_number AS order_no, ss_sold_date_sk AS day, ss_net_paid AS paid
    FROM store_sales
    UNION ALL SELECT 'w', ws_bill_customer_sk, ws_order_number, ws_sold_date_sk, ws_net_paid FROM web_sales)
  SELECT cid, CASE WHEN 11535 - max(day) < 60 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS recency,
         CAST(count(DISTINCT (channel, order_no)) AS DOUBLE) AS frequency, CAST(sum(paid) AS DOUBLE) AS totalspend
  FROM sale JOIN date_dim ON day = d_date_sk WHERE d_date > '1998-01-02' GROUP BY cid""",
    "q26_class_features": """
  SELECT ss_customer_sk AS cid, """
    + ", ".join(f"CAST(count(*) FILTER (WHERE i_class_id = {c}) AS DOUBLE) AS id{c}" for c in range(1, 16))
    + """
  FROM store_sales JOIN item ON ss_item_sk = i_item_sk WHERE i_category = 'PROMO'
  GROUP BY ss_customer_sk HAVING count(*) > 2""",
    "q27_company_names": f"""
  SELECT pr_review_sk AS review_sk, pr_item_sk AS item_sk, company_name, review_sentence
  FROM ({NAMES}) WHERE pr_item_sk = 69 AND {FREE_NAME}""",
    "q28_review_split": """
  SELECT pr_review_sk, CAST(pr_review_rating AS BIGINT) AS pr_review_rating, pr_review_content,
         CASE WHEN pr_review_sk % 10 = 0 THEN 'test' ELSE 'train' END AS part FROM product_reviews""",
    "q29_categories_bought_together": """
  WITH basket AS (SELECT DISTINCT ws_order_number AS o, i_category_id AS c FROM web_sales JOIN item ON ws_item_sk = i_item_sk)
  SELECT CAST(a.c AS BIGINT) AS category_id_1, CAST(b.c AS BIGINT) AS category_id_2, count(*) AS cnt
  FROM basket a JOIN basket b ON a.o = b.o AND a.c < b.c GROUP BY ALL
  ORDER BY cnt DESC, category_id_1, category_id_2 LIMIT 100""",
    "q30_categories_viewed_together": f"""
  WITH viewed AS (SELECT c.*, i_category_id FROM clicks c JOIN item ON wcs_item_sk = i_item_sk),
  visit AS ({SESSIONS.format(clicks="viewed")}),
  seen AS (SELECT DISTINCT wcs_user_sk AS u, session_no AS n, i_category_id AS c FROM visit)
  SELECT CAST(a.c AS BIGINT) AS category_id_1, CAST(b.c AS BIGINT) AS category_id_2, count(*) AS cnt
  FROM seen a JOIN seen b ON a.u = b.u AND a.n = b.n AND a.c < b.c GROUP BY ALL
  ORDER BY cnt DESC, category_id_1, category_id_2 LIMIT 100""",
    "sessionize": f"""
  SELECT wcs_user_sk, ts, wcs_item_sk, CAST(session_no AS BIGINT) AS session_no,
         wcs_user_sk || '_' || session_no AS session_id FROM ({SESSIONS.format(clicks="clicks")})""",
    "last_views_before_purchase": f"WITH {_last_views(7, 432000)} SELECT * FROM seen",
    "abandoned_sessions": f"SELECT wcs_user_sk || '_' || session_no AS session_id, pagecount FROM ({ABANDONED})",
    "abandoned_carts": f"SELECT wcs_user_sk, CAST(session_no AS BIGINT) AS session_no, pagecount FROM ({ABANDONED})",
    "sales_after_page": _after_review("clicks", 21600),
    "make_pairs": """
  WITH used AS (SELECT DISTINCT ws_order_number, ws_warehouse_sk AS w FROM web_sales)
  SELECT a.ws_order_number, a.w AS a, b.w AS b
  FROM used a JOIN used b ON a.ws_order_number = b.ws_order_number AND a.w < b.w""",
    "frequent_pairs": """
  WITH day AS (SELECT DISTINCT inv_date_sk AS d, inv_item_sk AS i FROM inventory)
  SELECT a.i AS "left", b.i AS "right", count(*) AS cnt FROM day a JOIN day b ON a.d = b.d AND a.i < b.i
  GROUP BY ALL HAVING count(*) > 20""",
    "extract_sentiment": "SELECT pr_review_sk, review_sentence, sentiment, sentiment_word FROM sentiment",
    "extract_negative_sentiment": """
  SELECT pr_review_sk, review_sentence, sentiment, sentiment_word FROM sentiment WHERE sentiment = 'NEG'""",
    "find_company": f"SELECT pr_review_sk, company_name, review_sentence FROM ({NAMES}) WHERE {FREE_NAME}",
    "find_known_company": KNOWN,
    "mentions": MENTIONED,
    "linear_fit": f"""
  SELECT ss_store_sk, round(slope, 5) AS slope, round(intercept, 3) AS intercept
  FROM ({_fit('''SELECT ss_store_sk, ss_sold_date_sk AS day, CAST(sum(ss_net_paid) * 100 AS HUGEINT) AS cents
                 FROM store_sales GROUP BY ALL''', 'ss_store_sk')})""",
    "declining_stores": "SELECT s_store_sk, s_store_name FROM falling_store",
    "correlation": """
  SELECT round(corr(CAST(ss_quantity AS DOUBLE), CAST(ss_net_paid AS DOUBLE)), 6) AS correlation FROM store_sales""",
    "variation": """
  SELECT inv_warehouse_sk, inv_item_sk, CAST(s AS DOUBLE) AS stdev, CAST(m AS DOUBLE) AS mean,
         round(CAST(s AS DOUBLE) / CAST(m AS DOUBLE), 6) AS cov
  FROM (SELECT inv_warehouse_sk, inv_item_sk, CAST(stddev_samp(inv_quantity_on_hand) AS DECIMAL(15,5)) AS s,
               CAST(avg(inv_quantity_on_hand) AS DECIMAL(15,5)) AS m FROM inventory GROUP BY ALL) WHERE m > 0""",
    "growth_of_two_channels": f"""
  WITH {_growth('ss_net_paid', 'ws_net_paid')}
  SELECT key, round(store_ratio, 6) AS store_ratio, round(web_ratio, 6) AS web_ratio FROM growth""",
    "before_and_after": """
  SELECT inv_warehouse_sk,
         CAST(sum(CASE WHEN d_date < '1997-06-01' THEN inv_quantity_on_hand ELSE 0 END) AS BIGINT) AS sum_before,
         CAST(sum(CASE WHEN d_date >= '1997-06-01' THEN inv_quantity_on_hand ELSE 0 END) AS BIGINT) AS sum_after
  FROM inventory JOIN date_dim ON inv_date_sk = d_date_sk
  WHERE d_date BETWEEN '1997-05-02' AND '1997-07-01' GROUP BY inv_warehouse_sk""",
    "quantity_around_price_change": f"""
  SELECT imp_sk, CAST(current AS BIGINT) AS current, CAST(previous AS BIGINT) AS previous
  FROM ({_around_price('web_sales', 'ws', 'true')})""",
    "rebought_quantities": BOUGHT_AGAIN.format(where=""),
    "dear_items": """
  SELECT i_item_sk FROM item
  WHERE i_current_price > 1.03 * (SELECT avg(k.i_current_price) FROM item k WHERE k.i_category = item.i_category)""",
    "class_counts": """
  SELECT ws_bill_customer_sk AS cid, """
    + ", ".join(f"CAST(count(*) FILTER (WHERE i_category_id = {c}) AS DOUBLE) AS id{c}" for c in range(1, 9))
    + """
  FROM web_sales JOIN item ON ws_item_sk = i_item_sk GROUP BY 1 HAVING count(*) > 5""",
    "dropna_any": f"SELECT * FROM {CUSTOMERS_WITH_GAPS} WHERE c_acctbal IS NOT NULL AND c_nationkey IS NOT NULL",
    "dropna_subset": f"SELECT * FROM {CUSTOMERS_WITH_GAPS} WHERE c_nationkey IS NOT NULL",
    "fillna": f"""
  SELECT c_custkey, coalesce(c_acctbal, 0) AS c_acctbal, coalesce(c_nationkey, 0) AS c_nationkey
  FROM {CUSTOMERS_WITH_GAPS}""",
    "describe": """
  SELECT summary, CAST(round(q, 4) AS DOUBLE) AS l_quantity, CAST(round(p, 2) AS DOUBLE) AS l_extendedprice
  FROM (SELECT 'count' AS summary, count(l_quantity) AS q, count(l_extendedprice) AS p FROM lineitem
        UNION ALL SELECT 'mean', avg(l_quantity), avg(l_extendedprice) FROM lineitem
        UNION ALL SELECT 'stddev', stddev_samp(l_quantity), stddev_samp(l_extendedprice) FROM lineitem
        UNION ALL SELECT 'min', min(l_quantity), min(l_extendedprice) FROM lineitem
        UNION ALL SELECT 'max', max(l_quantity), max(l_extendedprice) FROM lineitem)""",
    "customers_per_market": """
  SELECT c_mktsegment AS market, CAST(n_regionkey AS BIGINT) AS region, count(*) AS customers,
         min(c_acctbal) AS least, max(c_acctbal) AS most
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE c_acctbal >= 0 OR c_nationkey = 3 GROUP BY ALL""",
}


def _facts(features: str, key: str) -> str:
    """What holds for any converged clusters of these features."""
    return f"""
  SELECT count(*) AS n_rows, count(DISTINCT {key}) AS n_keys, count(*) AS n_sized,
         CAST(0 AS BIGINT) AS misplaced, CAST(0 AS BIGINT) AS off_center, true AS cost_agrees
  FROM ({features})"""


def _clusters(features: str, key: str, columns: list[str], result: str, k: int = 8, steps: int = 20) -> str:
    """Lloyd's steps one after the other; ``result`` reads put (key, j, far) and c{steps} (j, v)."""

    def put(step: int) -> str:
        far = " + ".join(f"(p{i} - v[{i}]) * (p{i} - v[{i}])" for i in range(1, len(columns) + 1))
        return f"""
  put{step} AS MATERIALIZED (
    SELECT * FROM (SELECT p.*, j, {far} AS far, row_number() OVER (PARTITION BY {key} ORDER BY {far}, j) AS place
                   FROM point p, c{step}) WHERE place = 1)"""

    units = ", ".join(f'CAST(round(coalesce("{c}", 0) * 1e7) AS HUGEINT) AS u{i}' for i, c in enumerate(columns, 1))
    names = [f"u{i}" for i in range(1, len(columns) + 1)]
    ctes = [f"""
  unit AS (SELECT {key}, {units} FROM ({features})),
  point AS MATERIALIZED (SELECT *, {", ".join(f"CAST({u} AS DOUBLE) / 1e7 AS p{u[1:]}" for u in names)} FROM unit),
  seed AS (SELECT {", ".join(names)}, min(((({key} % 1000003) * 7919 + 104729) % 1000003, {key})) AS turn FROM unit GROUP BY ALL),
  c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY turn) - 1 AS j, [{", ".join(f"CAST({u} AS DOUBLE) / 1e7" for u in names)}] AS v
                      FROM seed ORDER BY turn LIMIT {k})"""]
    for step in range(steps):
        means = ", ".join(f"CAST(sum({u}) AS DOUBLE) / (count(place) * 1e7)" for u in names)
        ctes += [put(step), f"""
  c{step + 1} AS MATERIALIZED (
    SELECT c.j, CASE WHEN count(place) = 0 THEN any_value(c.v) ELSE [{means}] END AS v
    FROM c{step} c LEFT JOIN put{step} USING (j) GROUP BY c.j)"""]
    ctes += [put(steps).replace(f"put{steps} AS", "put AS"), f"""
  last AS (SELECT * FROM c{steps})"""]
    return f"WITH {','.join(ctes)} {result}"


def _newton(features: str, count: str, columns: list[str], result: str, steps: int = 12) -> str:
    """Newton's steps for "count above the mean" one after the other; ``result`` reads
    scored (y, p) and w{steps} (b)."""
    size = len(columns) + 1
    x = ["1.0::DOUBLE", *(f'"{c}"::DOUBLE' for c in columns)]
    ctes = [f"""
  feature AS MATERIALIZED (SELECT * FROM ({features})),
  row AS MATERIALIZED (
    SELECT CAST({count} > (SELECT avg({count}) FROM feature) AS INT)::DOUBLE AS y,
           {", ".join(f"{c} AS x{i}" for i, c in enumerate(x))} FROM feature),
  w0 AS MATERIALIZED (SELECT [{", ".join(["0.0::DOUBLE"] * size)}] AS b)"""]
    margin = " + ".join(f"b[{i + 1}] * x{i}" for i in range(size))
    for step in range(steps):
        lines = ", ".join(
            "[" + ", ".join([*(f"sum(p * (1 - p) * x{i} * x{j})" for j in range(size)), f"sum((y - p) * x{i})"]) + "]"
            for i in range(size)
        )
        ctes.append(f"""
  p{step} AS (SELECT *, 1 / (1 + exp(-({margin}))) AS p FROM row, w{step}),
  e{step}_0 AS MATERIALIZED (SELECT m, m AS first FROM (SELECT [{lines}] AS m FROM p{step}))""")
        for c in range(1, size + 1):
            ctes.append(f"""
  e{step}_{c} AS MATERIALIZED (
    SELECT list_transform(range(1, {size + 1}), lambda i: list_transform(range(1, {size + 2}), lambda j:
             CASE WHEN m[{c}][{c}] > 1e-10 * first[{c}][{c}]
                  THEN CASE WHEN i = {c} THEN m[i][j] / m[{c}][{c}] ELSE m[i][j] - m[i][{c}] * m[{c}][j] / m[{c}][{c}] END
                  WHEN i = {c} THEN 0.0 ELSE m[i][j] END)) AS m, first FROM e{step}_{c - 1})""")
        ctes.append(f"""
  w{step + 1} AS MATERIALIZED (
    SELECT list_transform(range(1, {size + 1}), lambda i: b[i] + m[i][{size + 1}]) AS b FROM w{step}, e{step}_{size})""")
    ctes.append(f"""
  scored AS MATERIALIZED (SELECT y, round(1 / (1 + exp(-({margin}))), 10) AS p FROM row, w{steps})""")
    return f"WITH {','.join(ctes)} {result}"


def _per_class(what: str) -> str:
    return ", ".join(what.format(c=c) for c in ("NEG", "NEUT", "POS"))


#: Naive Bayes from word counts: classed(k, rating, actual, class) of the test reviews.
CLASSED = rf"""
  WITH rated AS (
    SELECT pr_review_sk AS k, pr_review_rating AS rating, pr_review_sk % 10 = 0 AS test,
           CASE WHEN pr_review_rating <= 2 THEN 'NEG' WHEN pr_review_rating = 3 THEN 'NEUT' ELSE 'POS' END AS actual,
           string_split_regex(lower(pr_review_content), '[^\p{{L}}\p{{N}}]+') AS words
    FROM product_reviews WHERE pr_review_rating IS NOT NULL),
  word_of AS (SELECT * EXCLUDE (words, word), word FROM (SELECT *, unnest(words) AS word FROM rated) WHERE word <> ''),
  model AS (SELECT word, {_per_class("count(*) FILTER (WHERE actual = '{c}') AS {c}")}
            FROM word_of WHERE NOT test GROUP BY word),
  sums AS (SELECT count(*) AS v, {_per_class("sum({c}) AS all_{c}")} FROM model),
  docs AS (SELECT count(*) AS n, count(DISTINCT actual) AS kinds,
                  {_per_class("count(*) FILTER (WHERE actual = '{c}') AS docs_{c}")} FROM rated WHERE NOT test),
  weighed AS (SELECT k, {_per_class("sum(ln({c} + 1) - ln(all_{c} + v)) AS w_{c}")}
              FROM word_of JOIN model USING (word), sums WHERE test GROUP BY k),
  scored AS (
    SELECT k, rating, actual, {_per_class("CASE WHEN docs_{c} > 0 THEN round(coalesce(w_{c}, 0) + ln(docs_{c} + 1) - ln(n + kinds), 9) ELSE -1e300 END AS s_{c}")}
    FROM rated LEFT JOIN weighed USING (k), docs WHERE test),
  classed AS (
    SELECT *, CASE WHEN s_NEG >= s_NEUT AND s_NEG >= s_POS THEN 'NEG' WHEN s_NEUT >= s_POS THEN 'NEUT' ELSE 'POS' END AS class
    FROM scored)"""

INTERESTS = ["college_education", "male", *(f"clicks_in_{c}" for c in range(1, 8))]

SQL |= {
    "q12_viewed_then_bought_by_day": SQL["q12_viewed_then_bought"],
    "q05_interest_classifier": _newton(SQL["q05_interest_features"], "clicks_in_category", INTERESTS, """,
  ranked AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS place FROM scored),
  area AS (SELECT (sum(place) FILTER (WHERE y = 1) - pos * (pos + 1) / 2.0) / (pos * neg) AS auc
           FROM ranked, (SELECT sum(y) AS pos, sum(1 - y) AS neg FROM scored) GROUP BY pos, neg)
  SELECT avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1.0::DOUBLE ELSE 0 END) AS accuracy, any_value(auc) AS auc,
         count(*) FILTER (WHERE y = 0 AND p <= 0.5) AS n_00, count(*) FILTER (WHERE y = 0 AND p > 0.5) AS n_01,
         count(*) FILTER (WHERE y = 1 AND p <= 0.5) AS n_10, count(*) FILTER (WHERE y = 1 AND p > 0.5) AS n_11,
         avg(p) AS mean_probability FROM scored, area"""),
    "q05_classifier_weights": _newton(SQL["q05_interest_features"], "clicks_in_category", INTERESTS, f"""
  SELECT unnest([NULL, {", ".join(f"'{c}'" for c in INTERESTS)}]) AS feature,
         unnest(list_transform(b, lambda v: round(v, 8))) AS weight FROM w12"""),
    "q05_classifier_facts": f"""
  WITH f AS ({SQL["q05_interest_features"]}), m AS (SELECT avg(clicks_in_category) AS mean FROM f)
  SELECT count(*) FILTER (WHERE clicks_in_category <= mean) AS negatives,
         count(*) FILTER (WHERE clicks_in_category > mean) AS positives,
         true AS accuracy_agrees, true AS better_than_chance, true AS calibrated FROM f, m""",
    "q20_return_clusters": _clusters(
        SQL["q20_return_features"], "user_sk", ["orderRatio", "itemsRatio", "monetaryRatio", "frequency"],
        "SELECT user_sk, j AS cluster FROM put"),
    "q20_return_cluster_centers": _clusters(
        SQL["q20_return_features"], "user_sk", ["orderRatio", "itemsRatio", "monetaryRatio", "frequency"], """,
  sized AS (SELECT j, count(*) AS n FROM put GROUP BY j),
  cost AS (SELECT CAST(sum(CAST(round(far * 1e6) AS HUGEINT)) AS DOUBLE) / 1e6 AS cost FROM put)
  SELECT j AS cluster, coalesce(n, 0) AS size, unnest([0, 1, 2, 3])::BIGINT AS feature, unnest(v) AS center, cost
  FROM last LEFT JOIN sized USING (j), cost"""),
    "q25_recency_clusters": _clusters(
        SQL["q25_recency_features"], "cid", ["recency", "frequency", "totalspend"], "SELECT cid, j AS cluster FROM put"),
    "q26_class_clusters": _clusters(
        SQL["q26_class_features"], "cid", [f"id{c}" for c in range(1, 16)], "SELECT cid, j AS cluster FROM put"),
    "q20_cluster_facts": _facts(SQL["q20_return_features"], "user_sk"),
    "q25_cluster_facts": _facts(SQL["q25_recency_features"], "cid"),
    "q26_cluster_facts": _facts(SQL["q26_class_features"], "cid"),
    "q28_review_classes": CLASSED + """
  SELECT k AS review_sk, CAST(rating AS BIGINT) AS rating, class FROM classed""",
    "q28_review_classifier_quality": CLASSED + f""",
  label(label) AS (VALUES ('NEG'), ('NEUT'), ('POS')),
  hit AS (
    SELECT label, {", ".join(f"count(*) FILTER (WHERE actual = label AND class = '{c}') AS as_{c.lower()}" for c in ("NEG", "NEUT", "POS"))},
           count(*) FILTER (WHERE actual = label AND class = label) AS h,
           count(*) FILTER (WHERE class = label) AS said, count(*) FILTER (WHERE actual = label) AS was,
           count(*) FILTER (WHERE actual = class) AS hits, count(*) AS n
    FROM label, classed GROUP BY label)
  SELECT label, as_neg, as_neut, as_pos, h / nullif(CAST(said AS DOUBLE), 0) AS precision,
         h / nullif(CAST(was AS DOUBLE), 0) AS recall,
         CASE WHEN h > 0 THEN 2.0 * h / (said + was) END AS f1, hits / nullif(CAST(n AS DOUBLE), 0) AS accuracy FROM hit""",
    "seen_with": """
  SELECT a.ws_item_sk, count(DISTINCT a.ws_bill_customer_sk) AS cnt
  FROM web_sales a JOIN web_sales b ON a.ws_bill_customer_sk = b.ws_bill_customer_sk
  WHERE b.ws_item_sk = 69 AND a.ws_item_sk <> 69 GROUP BY a.ws_item_sk""",
    "delimited_output": r"""
  SELECT concat_ws(',', ws_order_number, ws_item_sk, coalesce(CAST(ws_warehouse_sk AS VARCHAR), '\N'),
                   coalesce(CAST(ws_quantity AS VARCHAR), '\N'),
                   coalesce(regexp_replace(CAST(CAST(ws_sales_price AS DECIMAL(12,2)) AS VARCHAR), '\.?0+$', ''), '\N'),
                   coalesce(regexp_replace(CAST(CAST(ws_net_paid AS DECIMAL(12,2)) AS VARCHAR), '\.?0+$', ''), '\N')) AS line
  FROM web_sales""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(sql) for name, sql in SQL.items()}
