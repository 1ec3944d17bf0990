"""Columns the queries read from each retail table.

Fixed values: table and column names and types. Columns no query reads are not
listed; ``ParquetTables`` takes them from the files.
"""

SCHEMAS = {
    "store_sales": """
        ss_sold_date_sk bigint, ss_item_sk bigint not null, ss_customer_sk bigint,
        ss_cdemo_sk bigint, ss_addr_sk bigint, ss_store_sk bigint, ss_promo_sk bigint,
        ss_ticket_number bigint not null, ss_quantity int, ss_sales_price decimal(7,2),
        ss_ext_discount_amt decimal(7,2), ss_ext_sales_price decimal(7,2),
        ss_ext_wholesale_cost decimal(7,2), ss_ext_list_price decimal(7,2),
        ss_net_paid decimal(7,2), ss_net_profit decimal(7,2)""",
    "web_sales": """
        ws_sold_date_sk bigint, ws_sold_time_sk bigint, ws_item_sk bigint not null,
        ws_bill_customer_sk bigint, ws_ship_hdemo_sk bigint, ws_web_page_sk bigint,
        ws_warehouse_sk bigint, ws_order_number bigint not null, ws_quantity int,
        ws_sales_price decimal(7,2), ws_ext_discount_amt decimal(7,2),
        ws_ext_sales_price decimal(7,2), ws_ext_wholesale_cost decimal(7,2),
        ws_ext_list_price decimal(7,2), ws_net_paid decimal(7,2)""",
    "store_returns": """
        sr_returned_date_sk bigint, sr_item_sk bigint not null, sr_customer_sk bigint,
        sr_ticket_number bigint not null, sr_return_quantity int,
        sr_return_amt decimal(7,2)""",
    "web_returns": """
        wr_returned_date_sk bigint, wr_item_sk bigint not null,
        wr_order_number bigint not null, wr_return_quantity int,
        wr_refunded_cash decimal(7,2)""",
    "web_clickstreams": """
        wcs_click_date_sk bigint, wcs_click_time_sk bigint, wcs_sales_sk bigint,
        wcs_item_sk bigint, wcs_web_page_sk bigint, wcs_user_sk bigint""",
    "product_reviews": """
        pr_review_sk bigint not null, pr_review_date string, pr_review_rating int not null,
        pr_item_sk bigint not null, pr_review_content string not null""",
    "item": """
        i_item_sk bigint not null, i_item_id string not null, i_item_desc string,
        i_current_price decimal(7,2), i_class_id int, i_category_id int,
        i_category string""",
    "item_marketprices": """
        imp_sk bigint not null, imp_item_sk bigint not null,
        imp_competitor_price decimal(7,2), imp_start_date bigint, imp_end_date bigint""",
    "inventory": """
        inv_date_sk bigint not null, inv_item_sk bigint not null,
        inv_warehouse_sk bigint not null, inv_quantity_on_hand int""",
    "date_dim": """
        d_date_sk bigint not null, d_date string, d_week_seq int, d_year int, d_moy int""",
    "time_dim": "t_time_sk bigint not null, t_hour int",
    "customer": """
        c_customer_sk bigint not null, c_current_cdemo_sk bigint,
        c_current_addr_sk bigint, c_first_name string, c_last_name string,
        c_preferred_cust_flag string, c_birth_country string, c_login string,
        c_email_address string""",
    "customer_address": """
        ca_address_sk bigint not null, ca_state string, ca_country string,
        ca_gmt_offset decimal(5,2)""",
    "customer_demographics": """
        cd_demo_sk bigint, cd_gender string, cd_marital_status string,
        cd_education_status string""",
    "household_demographics": "hd_demo_sk bigint not null, hd_dep_count int",
    "store": """
        s_store_sk bigint, s_store_id string not null, s_store_name string,
        s_gmt_offset decimal(5,2)""",
    "warehouse": "w_warehouse_sk bigint not null, w_warehouse_name string, w_state string",
    "web_page": "wp_web_page_sk bigint not null, wp_type string, wp_char_count int",
    "promotion": """
        p_promo_sk bigint not null, p_channel_dmail string, p_channel_email string,
        p_channel_tv string""",
}
