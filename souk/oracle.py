"""The SQL each registered query must agree with, for an independent engine over the same Parquet tables."""

from __future__ import annotations

import re

# Means of DOUBLE columns whose sum is exact, whatever the order of adding.
MEANS = {
    "$mean_order_review": "cast(sum(cast(s.review_score as decimal(20,10))) as double) / count(s.review_score)",
    "$mean_review": "cast(sum(cast(review_score as decimal(20,10))) as double) / count(review_score)",
    "$mean_freight_ratio": "cast(sum(cast(freight_ratio as decimal(20,10))) as double) / count(freight_ratio)",
}

# Shared relations, each usable by those below it. They restate the stand-in mapping and the silver rules in SQL.
RELATIONS = {
    "line": """
        select l_orderkey order_id, l_linenumber line, l_partkey product_id, l_suppkey seller_id,
               l_shipdate shipped_at, cast(l_extendedprice as decimal(12,2)) price,
               cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)) freight_value,
               cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))
                   * (1 + cast(l_tax as decimal(4,2))) payment_value,
               l_returnflag || l_linestatus payment_type, cast(l_quantity as int) % 24 + 1 payment_installments,
               l_returnflag flag, case l_returnflag when 'R' then 1 when 'A' then 3 else 5 end review_score
        from lineitem""",
    "ship": "select order_id, max(shipped_at) last_ship from line group by order_id",
    "raw_orders": """
        select o_orderkey order_id, o_custkey customer_id,
               case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'canceled' end order_status,
               o_orderdate order_purchase_timestamp, o_orderdate order_approved_at,
               case when o_orderstatus in ('F', 'O') then cast(cast(o_orderdate as date) + 1 as timestamp) end
                   order_delivered_carrier_date,
               case when o_orderstatus = 'F' and last_ship is not null then
                   cast(cast(o_orderdate as date)
                        + cast(((date_diff('day', o_orderdate, last_ship) % 45) + 45) % 45 as integer) as timestamp) end
                   order_delivered_customer_date,
               cast(cast(o_orderdate as date) + 25 as timestamp) order_estimated_delivery_date
        from orders left join ship on o_orderkey = order_id""",
    "cust": """
        select c_custkey customer_id, c_custkey customer_unique_id,
               lpad(cast(c_nationkey as varchar), 5, '0') customer_zip_code_prefix,
               c_mktsegment customer_city, n_name customer_state
        from customer left join nation on c_nationkey = n_nationkey""",
    "trans": """
        select distinct p_brand product_category_name, lower(p_brand) product_category_name_english
        from part where p_brand <> 'Brand#13'""",
    "prod": """
        select p_partkey product_id, p_brand product_category_name, length(p_name) product_name_lenght,
               length(p_brand) product_description_lenght, p_size % 6 product_photos_qty,
               p_size * 100 product_weight_g, p_size product_length_cm, p_size % 20 + 1 product_height_cm,
               p_size % 30 + 1 product_width_cm
        from part""",
    "sell": """
        select s_suppkey seller_id, lpad(cast(s_nationkey as varchar), 5, '0') seller_zip_code_prefix,
               s_name seller_city, n_name seller_state
        from supplier left join nation on s_nationkey = n_nationkey""",
    "items": """
        select line.order_id, line.line order_item_id, line.product_id, line.seller_id,
               line.shipped_at shipping_limit_date, line.price, line.freight_value,
               prod.* exclude (product_id), trans.product_category_name_english,
               sell.* exclude (seller_id)
        from line left join prod on line.product_id = prod.product_id
             left join trans on prod.product_category_name = trans.product_category_name
             left join sell on line.seller_id = sell.seller_id""",
    "first_item": """
        select * from (select *, row_number() over (partition by order_id
            order by order_item_id, product_id, seller_id) rn from items) where rn = 1""",
    "item_sums": """
        select order_id, count(*) total_items, sum(price) total_price, sum(freight_value) total_freight_value,
               count(distinct product_id) unique_products, count(distinct seller_id) unique_sellers,
               cast(sum(product_weight_g) as double) / nullif(count(product_weight_g), 0) avg_product_weight_g,
               cast(sum(product_length_cm) as double) / nullif(count(product_length_cm), 0) avg_product_length_cm,
               cast(sum(product_height_cm) as double) / nullif(count(product_height_cm), 0) avg_product_height_cm,
               cast(sum(product_width_cm) as double) / nullif(count(product_width_cm), 0) avg_product_width_cm,
               cast(sum(product_photos_qty) as double) / nullif(count(product_photos_qty), 0) avg_product_photos_qty
        from items group by order_id""",
    "items_agg": """
        select s.order_id, total_items, total_price, total_freight_value, unique_products, unique_sellers,
               f.product_category_name_english main_category_english, f.product_category_name main_category,
               f.seller_city, f.seller_state, avg_product_weight_g, avg_product_length_cm, avg_product_height_cm,
               avg_product_width_cm, avg_product_photos_qty
        from item_sums s join first_item f on s.order_id = f.order_id""",
    "main_payment": """
        select order_id, payment_type from (select *, row_number() over (partition by order_id
            order by payment_value desc, payment_type desc) rn from line) where rn = 1""",
    "pay_agg": """
        select l.order_id, sum(l.payment_value) total_payment_value, max(l.payment_installments) max_installments,
               count(*) payment_count, any_value(m.payment_type) payment_type,
               string_agg(distinct l.payment_type, ',' order by l.payment_type) payment_types_used
        from line l join main_payment m on l.order_id = m.order_id group by l.order_id""",
    "first_review": """
        select order_id, 'flag ' || flag review_comment_title,
               'part ' || product_id || ' from ' || seller_id review_comment_message, shipped_at review_creation_date
        from (select *, row_number() over (partition by order_id order by shipped_at, order_id || '-' || line,
              'flag ' || flag, 'part ' || product_id || ' from ' || seller_id) rn from line) where rn = 1""",
    "review_sums": """
        select order_id, cast(sum(review_score) as double) / count(*) review_score, count(*) review_count
        from line group by order_id""",
    "rev_agg": """
        select s.order_id, review_score, review_comment_title, review_comment_message, review_creation_date,
               review_count
        from review_sums s join first_review f on s.order_id = f.order_id""",
    "merged": """
        select o.*, c.* exclude (customer_id), i.* exclude (order_id), p.* exclude (order_id), r.* exclude (order_id)
        from raw_orders o left join cust c on o.customer_id = c.customer_id
             left join items_agg i on o.order_id = i.order_id left join pay_agg p on o.order_id = p.order_id
             left join rev_agg r on o.order_id = r.order_id""",
    "cleaned": """
        select * replace (
            coalesce(total_price, 0) as total_price, coalesce(total_freight_value, 0) as total_freight_value,
            coalesce(total_payment_value, 0) as total_payment_value, coalesce(total_items, 0) as total_items,
            coalesce(unique_products, 0) as unique_products, coalesce(unique_sellers, 0) as unique_sellers,
            coalesce(review_score, 0) as review_score, coalesce(max_installments, 1) as max_installments,
            coalesce(payment_count, 0) as payment_count, coalesce(review_count, 0) as review_count,
            coalesce(avg_product_weight_g, 0) as avg_product_weight_g,
            coalesce(avg_product_length_cm, 0) as avg_product_length_cm,
            coalesce(avg_product_height_cm, 0) as avg_product_height_cm,
            coalesce(avg_product_width_cm, 0) as avg_product_width_cm,
            coalesce(avg_product_photos_qty, 0) as avg_product_photos_qty,
            coalesce(main_category_english, 'unknown') as main_category_english,
            coalesce(main_category, 'desconhecido') as main_category,
            coalesce(payment_type, 'unknown') as payment_type,
            coalesce(review_comment_title, '') as review_comment_title,
            coalesce(review_comment_message, '') as review_comment_message,
            coalesce(seller_city, 'unknown') as seller_city, coalesce(seller_state, 'unknown') as seller_state)
        from merged
        where order_purchase_timestamp is not null and (order_status <> 'canceled' or coalesce(total_price, 0) > 0)""",
    "silver": """
        select *, date_diff('day', order_purchase_timestamp, order_delivered_customer_date) delivery_days,
               date_diff('day', order_delivered_customer_date, order_estimated_delivery_date) estimated_vs_actual,
               case when total_price > 0
                    then round(cast(total_freight_value as double) / cast(total_price as double), 4)
                    else 0.0 end freight_ratio,
               total_price + total_freight_value order_value,
               hour(order_purchase_timestamp) purchase_hour, dayofweek(order_purchase_timestamp) + 1 purchase_dayofweek,
               month(order_purchase_timestamp) purchase_month, year(order_purchase_timestamp) purchase_year,
               quarter(order_purchase_timestamp) purchase_quarter,
               strftime(order_purchase_timestamp, '%Y-%m') purchase_year_month,
               case when order_delivered_customer_date is null then 'not_delivered'
                    when date_diff('day', order_delivered_customer_date, order_estimated_delivery_date) >= 0
                    then 'on_time' else 'late' end delivery_status,
               case when review_score >= 4 then 'satisfied' when review_score = 3 then 'neutral'
                    when review_score >= 1 then 'dissatisfied' else 'no_review' end satisfaction_level
        from cleaned""",
    "visits": """
        select event_id order_id, user_id customer_unique_id, ts, cast(value as decimal(12,2)) total_payment_value,
               hour(ts) purchase_hour, dayofweek(ts) + 1 purchase_dayofweek, month(ts) purchase_month,
               year(ts) purchase_year, quarter(ts) purchase_quarter, strftime(ts, '%Y-%m') purchase_year_month
        from events""",
    "arrived": "select * from silver where order_status = 'delivered' and delivery_days >= 0",
    "rfm": """
        select customer_unique_id,
               date_diff('day', max(order_purchase_timestamp), (select max(order_purchase_timestamp) from silver
                   where order_status = 'delivered')) recency,
               count(distinct order_id) frequency, sum(total_payment_value) monetary,
               $mean_review avg_review_score,
               cast(sum(delivery_days) as double) / nullif(count(delivery_days), 0) avg_delivery_days,
               cast(sum(total_items) as double) / count(total_items) avg_items_per_order,
               any_value(customer_state) customer_state, any_value(customer_city) customer_city,
               max(order_purchase_timestamp) last_purchase_date, min(order_purchase_timestamp) first_purchase_date,
               date_diff('day', min(order_purchase_timestamp), max(order_purchase_timestamp)) customer_tenure_days
        from silver where order_status = 'delivered' group by customer_unique_id""",
    "quartiles": """
        select *, ntile(4) over (order by recency, customer_unique_id) r_score,
               ntile(4) over (order by frequency desc, customer_unique_id) f_score,
               ntile(4) over (order by monetary desc, customer_unique_id) m_score from rfm""",
    "scored": "select *, r_score + f_score + m_score rfm_score from quartiles",
    "order_delivery": """
        select customer_unique_id, cast(sum(delivery_days) as double) / nullif(count(delivery_days), 0) mean_days
        from silver group by customer_unique_id""",
    "feats": """
        select s.customer_unique_id, coalesce(recency, 0) recency, coalesce(frequency, 1) frequency,
               coalesce(cast(monetary as double), 0) monetary, coalesce(avg_review_score, 4) avg_review,
               coalesce(mean_days, 10) avg_delivery_days
        from scored s join order_delivery d on s.customer_unique_id = d.customer_unique_id""",
    "risks": """
        select *, 0.3e0 * least(recency / 730e0, 1e0) + 0.15e0 * (1e0 - least((frequency - 1) / 19e0, 1e0))
               + 0.15e0 * (1e0 - least(monetary / 5000e0, 1e0)) + 0.2e0 * (1e0 - (avg_review - 1) / 4e0)
               + 0.2e0 * least(avg_delivery_days / 60e0, 1e0) risk
        from feats""",
    "labelled": "select *, case when risk > 0.5 then 1e0 else 0e0 end label from risks",
    "docs": """
        select s.customer_unique_id, customer_state, customer_city, s.recency, s.frequency, s.monetary, r_score,
               f_score, m_score, rfm_score, avg_review_score, s.avg_delivery_days, customer_tenure_days,
               last_purchase_date, first_purchase_date,
               case when rfm_score <= 5 then 0 when rfm_score <= 7 then 1 when rfm_score <= 9 then 2 else 3 end cluster,
               case when rfm_score <= 5 then 'Champions' when rfm_score <= 7 then 'Loyal'
                    when rfm_score <= 9 then 'At Risk' else 'Lost' end segment_name,
               label churn_prediction, round(risk, 6) churn_probability
        from scored s join labelled l on s.customer_unique_id = l.customer_unique_id""",
    "product_sales": """
        select product_id, count(*) total_orders, cast(round(sum(price), 2) as double) total_revenue,
               cast(sum(price) as double) / count(price) avg_price, cast(min(price) as double) min_price,
               cast(max(price) as double) max_price, cast(round(sum(freight_value), 2) as double) total_freight,
               cast(sum(freight_value) as double) / count(freight_value) avg_freight,
               count(distinct order_id) unique_orders, count(distinct seller_id) seller_count
        from line group by product_id""",
    "product_scores": """
        select line.product_id, $mean_order_review avg_review_score, count(s.review_score) review_count
        from silver s join line on s.order_id = line.order_id where s.review_score > 0 group by line.product_id""",
    "product_docs": """
        select p.product_id, p.product_category_name category_pt,
               coalesce(t.product_category_name_english, 'unknown') category_en, product_name_lenght,
               product_description_lenght, product_photos_qty, product_weight_g, product_length_cm,
               product_height_cm, product_width_cm, coalesce(total_orders, 0) total_orders,
               coalesce(total_revenue, 0) total_revenue, coalesce(avg_price, 0) avg_price, min_price, max_price,
               total_freight, avg_freight, unique_orders, seller_count,
               coalesce(avg_review_score, 0) avg_review_score, coalesce(review_count, 0) review_count
        from prod p left join trans t on p.product_category_name = t.product_category_name
             left join product_sales s on p.product_id = s.product_id
             left join product_scores r on p.product_id = r.product_id""",
    "seller_sales": """
        select seller_id, count(*) total_items_sold, count(distinct order_id) total_orders,
               cast(round(sum(price), 2) as double) total_revenue, cast(sum(price) as double) / count(price) avg_price,
               cast(round(sum(freight_value), 2) as double) total_freight,
               cast(sum(freight_value) as double) / count(freight_value) avg_freight,
               count(distinct product_id) unique_products
        from line group by seller_id""",
    "seller_facts": """
        select line.seller_id, $mean_order_review avg_review_score,
               cast(sum(delivery_days) as double) / nullif(count(delivery_days), 0) avg_delivery_days,
               count(distinct customer_unique_id) unique_customers, min(order_purchase_timestamp) first_sale_date,
               max(order_purchase_timestamp) last_sale_date
        from silver s join line on s.order_id = line.order_id where seller_state is not null
        group by line.seller_id""",
    "months": """
        select purchase_year_month, count(*) order_count, cast(round(sum(total_payment_value), 2) as double) revenue,
               cast(sum(total_payment_value) as double) / count(*) avg_order_value,
               count(distinct customer_unique_id) unique_customers, $mean_review avg_review_score,
               cast(sum(delivery_days) as double) / nullif(count(delivery_days), 0) avg_delivery_days
        from silver group by purchase_year_month""",
    "states": """
        select customer_state, count(*) order_count,
               cast(round(sum(total_payment_value), 2) as double) total_revenue,
               cast(sum(total_payment_value) as double) / count(*) mean_payment,
               cast(sum(order_value) as double) / count(*) mean_value,
               count(distinct customer_unique_id) unique_customers, $mean_review avg_review_score,
               cast(sum(delivery_days) as double) / nullif(count(delivery_days), 0) avg_delivery_days
        from silver group by customer_state""",
    "cats": """
        select main_category_english, count(*) order_count,
               cast(round(sum(total_payment_value), 2) as double) total_revenue,
               cast(sum(total_payment_value) as double) / count(*) avg_order_value,
               $mean_review avg_review_score,
               cast(sum(delivery_days) as double) / nullif(count(delivery_days), 0) avg_delivery_days,
               cast(sum(total_items) as bigint) total_items_sold, count(distinct customer_unique_id) unique_customers
        from silver where main_category_english <> 'unknown' group by main_category_english""",
    "top_cats": """
        select upper(main_category_english[1]) || main_category_english[2:] category, round(total_revenue, 2) revenue,
               order_count total_sold, round(avg_order_value, 2) avg_price, round(avg_review_score, 2) avg_review
        from (select * from cats order by total_revenue desc, main_category_english limit 20)""",
    "methods": """
        select payment_type, count(*) order_count, cast(round(sum(total_payment_value), 2) as double) total_revenue,
               cast(sum(total_payment_value) as double) / count(*) avg_payment_value,
               cast(sum(max_installments) as double) / count(*) avg_installments,
               $mean_review avg_review_score
        from silver group by payment_type""",
    "cells": """
        select purchase_dayofweek, purchase_hour, count(*) order_count,
               cast(round(sum(total_payment_value), 2) as double) total_revenue
        from visits group by purchase_dayofweek, purchase_hour""",
    "seg_stats": """
        select segment_name, count(*) customer_count, cast(sum(recency) as double) / count(*) avg_recency,
               cast(sum(frequency) as double) / count(*) avg_frequency,
               cast(sum(monetary) as double) / count(*) avg_monetary
        from docs group by segment_name""",
    "scaled": """
        select customer_unique_id, coalesce(cast(recency as double), 0) r, coalesce(cast(frequency as double), 0) f,
               coalesce(cast(monetary as double), 0) m, coalesce(avg_review_score, 0) v,
               coalesce(avg_delivery_days, 0) d from docs""",
    "minmax": """
        select customer_unique_id, risk, case when risk > 0.5 then 1 else 0 end label from (
            select customer_unique_id, round(
                0.3e0 * coalesce((r - min(r) over ()) / nullif(max(r) over () - min(r) over (), 0), 0)
                + 0.15e0 * (1 - coalesce((f - min(f) over ()) / nullif(max(f) over () - min(f) over (), 0), 0))
                + 0.15e0 * (1 - coalesce((m - min(m) over ()) / nullif(max(m) over () - min(m) over (), 0), 0))
                + 0.2e0 * (1 - coalesce((v - min(v) over ()) / nullif(max(v) over () - min(v) over (), 0), 0))
                + 0.2e0 * coalesce((d - min(d) over ()) / nullif(max(d) over () - min(d) over (), 0), 0), 6) risk
            from scaled)""",
    "guesses": """
        select case when recency > 90 then 1e0 else 0e0 end label, case when risk > 0.5 then 1e0 else 0e0 end guess,
               round(risk, 6) raw from risks""",
    "guess_cells": """
        select cast(count(*) as double) n,
               cast(count(*) filter (label = 1 and guess = 1) as double) tp,
               cast(count(*) filter (label = 0 and guess = 1) as double) fp,
               cast(count(*) filter (label = 1 and guess = 0) as double) fn,
               cast(count(*) filter (label = 0 and guess = 0) as double) tn from guesses""",
    "guess_scores": """
        select (tp + tn) / n accuracy, (tp + fn) / n share1, (tn + fp) / n share0,
               coalesce(tp / nullif(tp + fp, 0), 0) p1, coalesce(tp / nullif(tp + fn, 0), 0) r1,
               coalesce(tn / nullif(tn + fn, 0), 0) p0, coalesce(tn / nullif(tn + fp, 0), 0) r0 from guess_cells""",
    "guess_area": """
        select (sum(place) filter (label = 1) - ones * (ones + 1) / 2) / (ones * (total - ones)) area
        from (select label, rank() over (order by raw) + (count(*) over (partition by raw) - 1) / 2e0 place,
                     cast(sum(label) over () as double) ones, cast(count(*) over () as double) total from guesses)
        group by ones, total""",
    "category_guesses": """
        select review_score y, cast(sum(cast(review_score as decimal(20,10))) over c as double)
                   / count(*) over c p, avg(review_score) over () m
        from silver where review_score > 0 window c as (partition by main_category_english)""",
    "serving": """
        select customer_unique_id,
               round(least(0.99e0, greatest(0.01e0,
                   0.3e0 * greatest(0e0, least(1e0, recency / 730e0))
                   + 0.15e0 * (1e0 - greatest(0e0, least(1e0, (frequency - 1) / 19e0)))
                   + 0.15e0 * (1e0 - greatest(0e0, least(1e0, cast(monetary as double) / 14000e0)))
                   + 0.2e0 * (1e0 - greatest(0e0, least(1e0, (avg_review_score - 1) / 4e0)))
                   + 0.2e0 * greatest(0e0, least(1e0, coalesce(avg_delivery_days, 10) / 200e0)))), 3) probability
        from docs""",
    "served": """
        select *, probability >= 0.5 at_risk,
               case when probability >= 0.7 then 'very high' when probability >= 0.5 then 'high'
                    when probability >= 0.3 then 'medium' else 'low' end risk_level,
               case when probability >= 0.7 then 'high' when probability >= 0.4 then 'medium' else 'low' end risk_badge
        from serving""",
}

TABLES = {
    "orders": ("raw_orders", 8),
    "order_items": ("line", 7),
    "payments": ("line", 5),
    "reviews": ("line", 7),
    "customers": ("cust", 5),
    "products": ("prod", 9),
    "sellers": ("sell", 4),
    "category_translation": ("trans", 2),
}
KEYS = {
    "orders": "select order_id k from raw_orders",
    "reviews": "select order_id || '-' || line k from line",
    "customers": "select customer_id k from cust",
    "products": "select product_id k from prod",
    "sellers": "select seller_id k from sell",
    "category_translation": "select product_category_name k from trans",
}
REQUIRED = {
    "orders": ("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
    "order_items": ("order_id", "product_id", "seller_id", "price", "freight_value"),
    "payments": ("order_id", "payment_type", "payment_value"),
    "reviews": ("order_id", "review_score"),
    "customers": ("customer_id", "customer_unique_id", "customer_city", "customer_state"),
    "products": ("product_id", "product_category_name"),
    "sellers": ("seller_id", "seller_city", "seller_state"),
    "category_translation": ("product_category_name", "product_category_name_english"),
}
METRICS = (
    "total_price",
    "total_freight_value",
    "total_payment_value",
    "total_items",
    "delivery_days",
    "review_score",
    "freight_ratio",
    "order_value",
)
MERGED_COLUMNS = (
    "order_id customer_id order_status order_purchase_timestamp order_approved_at order_delivered_carrier_date "
    "order_delivered_customer_date order_estimated_delivery_date customer_unique_id customer_zip_code_prefix "
    "customer_city customer_state total_items total_price total_freight_value unique_products unique_sellers "
    "main_category_english main_category seller_city seller_state avg_product_weight_g avg_product_length_cm "
    "avg_product_height_cm avg_product_width_cm avg_product_photos_qty total_payment_value max_installments "
    "payment_count payment_type payment_types_used review_score review_comment_title review_comment_message "
    "review_creation_date review_count"
).split()


def iso(*columns: str) -> str:
    return ", ".join(f"strftime({c}, '%Y-%m-%dT%H:%M:%S') as {c}" for c in columns)


def dbl(*columns: str) -> str:
    return ", ".join(f"cast({c} as double) as {c}" for c in columns)


STAMPS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
AMOUNTS = ("total_price", "total_freight_value", "total_payment_value")
WIDE = f"select * replace ({iso(*STAMPS, 'review_creation_date')}, {dbl(*AMOUNTS)}) from"
SHARE = "round(cast({n} as double) / sum({n}) over () * 100, 2) percentage"
CUSTOMER_DATES = ("last_purchase_date", "first_purchase_date")

ORDER_DOCUMENT = f"""
    select order_id, order_status, {iso(*STAMPS)}, delivery_days, estimated_vs_actual, freight_ratio,
           cast(order_value as double) order_value, delivery_status, purchase_hour, purchase_dayofweek, purchase_month,
           purchase_year, purchase_year_month, customer_id customer__customer_id,
           customer_unique_id customer__customer_unique_id, customer_city customer__customer_city,
           customer_state customer__customer_state, customer_zip_code_prefix customer__customer_zip_code_prefix,
           total_items items__total_items, cast(total_price as double) items__total_price,
           cast(total_freight_value as double) items__total_freight_value, unique_products items__unique_products,
           unique_sellers items__unique_sellers, main_category_english items__category,
           seller_city items__seller_city, seller_state items__seller_state,
           cast(total_payment_value as double) payment__total_payment_value, payment_type payment__payment_type,
           max_installments payment__installments, payment_count payment__payment_count,
           review_score review__review_score, review_comment_title review__review_comment_title,
           review_comment_message review__review_comment_message, review_count review__review_count,
           satisfaction_level review__satisfaction_level
    from silver"""

SEGMENT_COUNT = "count(*) filter (segment_name = '{s}') \"{s}\""
CUSTOMER_ROW = (
    "customer_unique_id, segment_name segment, customer_city city, customer_state state, recency, "
    "cast(monetary as double) monetary"
)
RISK_ROW = (
    "customer_unique_id, segment_name segment, customer_city city, customer_state state, recency, "
    "round(cast(monetary as double), 2) monetary, round(churn_probability, 2) churn_probability"
)
CONTRACT_FIELDS = {
    "order_id": ("0", "count(*) filter (order_id is null)"),
    "order_status": ("0", "count(*) filter (order_status is null)"),
    "customer": ("0", "0"),
    "customer.customer_id": ("count(customer_id)", "0"),
    "customer.customer_unique_id": ("count(customer_unique_id)", "0"),
    "customer.customer_city": ("0", "0"),
    "customer.customer_state": ("0", "0"),
    "items": ("0", "0"),
    "payment": ("0", "0"),
    "review": ("0", "0"),
    "order_value": ("0", "0"),
    "delivery_days": ("0", "0"),
}


CUSTOMER_FIELDS = (
    "customer_state customer_city recency frequency monetary segment_name churn_prediction churn_probability"
)
PRODUCT_FIELDS = "category_en total_orders total_revenue avg_price avg_review_score"
SELLER_FIELDS = "seller_city seller_state total_items_sold total_revenue"


def _contract(table: str, key: str, fields: str) -> str:
    """The ids are numbers where the contract wants text; all else is as it should be."""
    checks = [f"select '{key}' field, count({key}) wrong_type, count(*) - count({key}) missing_required, count(*) documents from {table}"]
    checks += [f"select '{f}', 0, 0, count(*) from {table}" for f in fields.split()]
    return " union all ".join(checks)


def _key_counts(table: str) -> str:
    return f"""select '{table}' table_name, count(k) key_count, count(k) - count(distinct k) duplicate_keys
               from ({KEYS[table]})"""


def _nulls(table: str, column: str) -> str:
    return f"""select '{table}' table_name, '{column}' column_name,
               count(*) filter ({column} is null or trim(cast({column} as varchar)) = '') null_count
               from {TABLES[table][0]}"""


def _verdict(table: str) -> str:
    duplicates = f"(select count(k) - count(distinct k) from ({KEYS[table]}))" if table in KEYS else "0"
    key = {"reviews": "review_id", "category_translation": "product_category_name"}.get(table, f"{table[:-1]}_id")
    return f"""select '{table}' table_name, count(*) row_count, {duplicates} duplicate_keys,
               case when {duplicates} > 0 then {duplicates} || ' duplicate values in {key}' else '' end errors,
               {duplicates} = 0 and count(*) > 0 valid from {TABLES[table][0]}"""


# The figures of the composite risk as a classifier, in the order of a model record.
FIGURES = {
    "accuracy": "round(accuracy, 4)",
    "precision": "round(share1 * p1 + share0 * p0, 4)",
    "recall": "round(share1 * r1 + share0 * r0, 4)",
    "f1_score": "round(share1 * coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0)"
    " + share0 * coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0), 4)",
    "auc_roc": "round(area, 4)",
}


def json_figures() -> str:
    return " || ',' || ".join(f"""'"{name}":' || cast({figure} as varchar)""" for name, figure in FIGURES.items())


def _raw(relation_columns: str, moments: str = "", renamed: dict | None = None, **kinds: str) -> dict:
    """Columns of a raw table with the text that stands for them and their contract types, strings if not named."""
    out = {}
    for c in relation_columns.split():
        source = (renamed or {}).get(c, c)
        moment = c in moments.split()
        text = f"strftime({source}, '%Y-%m-%d %H:%M:%S')" if moment else f"cast({source} as varchar)"
        out[c] = (text, "timestamp" if moment else kinds.get(c, "string"))
    return out


ORDER_MOMENTS = (
    "order_purchase_timestamp order_approved_at order_delivered_carrier_date order_delivered_customer_date "
    "order_estimated_delivery_date"
)
MEASURED = {
    f"product_{m}": "int"
    for m in ("name_lenght", "description_lenght", "photos_qty", "weight_g", "length_cm", "height_cm", "width_cm")
}
MONEY = "decimal(12,2)"
RAW_COLUMNS = {
    "orders": _raw(f"order_id customer_id order_status {ORDER_MOMENTS}", ORDER_MOMENTS),
    "order_items": _raw(
        "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
        "shipping_limit_date",
        {"order_item_id": "line.line", "shipping_limit_date": "shipped_at"},
        order_item_id="int",
        price=MONEY,
        freight_value=MONEY,
    ),
    "payments": _raw(
        "order_id payment_sequential payment_type payment_installments payment_value",
        renamed={"payment_sequential": "line.line"},
        payment_sequential="int",
        payment_installments="int",
        payment_value=MONEY,
    ),
    "reviews": _raw(
        "review_id order_id review_score review_comment_title review_comment_message review_creation_date "
        "review_answer_timestamp",
        "review_creation_date review_answer_timestamp",
        {
            "review_id": "order_id || '-' || line.line",
            "review_comment_title": "'flag ' || flag",
            "review_comment_message": "'part ' || product_id || ' from ' || seller_id",
            "review_creation_date": "shipped_at",
            "review_answer_timestamp": "shipped_at",
        },
        review_score="int",
    ),
    "customers": _raw("customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state"),
    "products": _raw(f"product_id product_category_name {' '.join(MEASURED)}", **MEASURED),
    "sellers": _raw("seller_id seller_zip_code_prefix seller_city seller_state"),
    "category_translation": _raw("product_category_name product_category_name_english"),
}


def _inferred(table: str, column: str, text: str, contract: str) -> str:
    """One row of the inferred schema; the bits are those of whole, long, decimal, double, moment and text values."""
    parses = {"string": "true", "timestamp": "try_strptime(v, '%Y-%m-%d %H:%M:%S') is not null"}
    return f"""
        select '{table}' table_name, '{column}' column_name,
               case when kinds & 32 > 0 or (kinds & 16 > 0 and kinds & 15 > 0) then 'string' when kinds & 16 > 0 then 'timestamp'
                    when kinds & 8 > 0 then 'double'
                    when kinds & 4 > 0 then case when wide + deep > 38 then 'double'
                        else 'decimal(' || greatest(wide + deep, 1) || ',' || deep || ')' end
                    when kinds & 2 > 0 then 'bigint' when kinds & 1 > 0 then 'int' else 'void' end inferred_type,
               '{contract}' contract_type, row_count,
               coalesce(round(cast(empty as double) / nullif(row_count, 0) * 100, 2), 0) null_pct, broken_values
        from (select coalesce(bit_or(kind), 0) kinds, coalesce(max(wide) filter (kind in (1, 2, 4)), 0) wide,
                     coalesce(max(deep) filter (kind in (1, 2, 4)), 0) deep, count(*) row_count,
                     count(*) filter (coalesce(v, '') = '') empty,
                     count(*) filter (v <> '' and not ({parses.get(contract, f"try_cast(v as {contract}) is not null")}))
                         broken_values
              from (select *, case when coalesce(v, '') = '' then 0
                           when regexp_matches(v, '^[+-]?[0-9]+$') then case when try_cast(v as integer) is not null then 1
                               when try_cast(v as bigint) is not null then 2 when wide <= 38 then 4 else 8 end
                           when regexp_matches(v, '^[+-]?[0-9]*[.][0-9]+$') then case when wide + deep <= 38 then 4 else 8 end
                           when regexp_matches(v, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{{1,3}})?$') then 8
                           when coalesce(try_strptime(v, '%Y-%m-%d %H:%M:%S'), try_strptime(v, '%Y-%m-%d')) is not null then 16
                           else 32 end kind
                    from (select v, length(regexp_replace(v, '^[+-]?0*|[.].*$', '', 'g')) wide,
                                 length(regexp_extract(v, '[.]([0-9]+)$', 1)) deep
                          from (select trim({text}) v from {TABLES[table][0]}))))"""


def union(parts) -> str:
    return " union all ".join(parts)


def union_by_name(parts) -> str:
    return " union all by name ".join(parts)


ALL_NULLS = union(_nulls(t, c) for t, columns in REQUIRED.items() for c in columns)

AGGREGATES = union_by_name(
    (
        "select * rename (revenue as total_revenue), 'monthly_revenue' agg_type from months",
        "select *, 'category_stats' agg_type from cats",
        """select * exclude (mean_value) rename (mean_payment as avg_order_value), 'state_stats' agg_type
           from states""",
        """select purchase_dayofweek, purchase_hour, count(*) order_count,
                  cast(round(sum(total_payment_value), 2) as double) total_revenue, 'hourly_orders' agg_type
           from silver group by purchase_dayofweek, purchase_hour""",
        "select * exclude (avg_review_score), 'payment_methods' agg_type from methods",
        f"""select 'Churn_Prediction' model_name, 'RiskFormula' best_model,
                  '{{"best_model":"RiskFormula","models":{{"RiskFormula":{{' || {json_figures()} || '}}}}}}' metrics_json,
                  'model_performance' agg_type from guess_scores, guess_area""",
        "select *, 'segment_stats' agg_type from seg_stats",
    )
)

QUERIES = {
    "scan_orders": "select order_id, customer_id, order_status from raw_orders",
    "dq_table_profile": union(
        f"select '{t}' table_name, count(*) row_count, {n} column_count from {r}" for t, (r, n) in TABLES.items()
    ),
    "dq_null_counts": ALL_NULLS,
    "dq_null_profile": union(
        f"""select '{c}' column_name, count(*) filter ({c} is null) null_count,
            round(cast(count(*) filter ({c} is null) as double) / count(*) * 100, 2) null_pct from merged"""
        for c in MERGED_COLUMNS
    ),
    "dq_duplicate_keys": union(_key_counts(t) for t in KEYS),
    "dq_verdict": union(_verdict(t) for t in TABLES),
    "dq_contract_orders": union(
        f"select '{f}' field, {wrong} wrong_type, {absent} missing_required, count(*) documents from silver"
        for f, (wrong, absent) in CONTRACT_FIELDS.items()
    ),
    "dq_contract_variants": union(
        f"""select '{f}' field, {"count(*) filter (order_id % 1000 = 1)" if f == "order_value" else wrong} wrong_type,
            {absent} missing_required, count(*) documents from silver"""
        for f, (wrong, absent) in CONTRACT_FIELDS.items()
    ),
    "dq_document_types": """
        select 'order_id' field, 'STRING' "type", count(*) documents from silver
        union all select 'items', 'OBJECT', count(*) from silver
        union all select 'nowhere', 'missing', count(*) from silver
        union all select 'order_value', case when order_id % 1000 = 1 then 'STRING' else 'DECIMAL' end, count(*)
            from silver group by all
        union all select 'delivery_days', case when delivery_days is null then 'VOID' else 'BIGINT' end, count(*)
            from silver group by all""",
    "dq_manifest_summary": f"""
        select *, round(cast(total_nulls as double) / total_rows * 100, 2) null_pct from (
            select count(*) total_files, count(*) filter (valid) valid_files, cast(sum(row_count) as bigint) total_rows,
                   (select cast(sum(null_count) as bigint) from ({ALL_NULLS})) total_nulls
            from ({union(_verdict(t) for t in TABLES)}))""",
    "dq_rows_removed": """
        select (select count(*) + count(*) filter (order_status = 'shipped') from raw_orders) raw_rows,
               (select count(*) filter (order_status = 'shipped') from raw_orders) removed_as_duplicates,
               (select count(*) + count(*) filter (order_status = 'shipped') from raw_orders)
                   - (select count(*) from cleaned) removed_in_total,
               (select count(*) from cleaned) remaining_rows""",
    "describe_order_metrics": union(
        f"""select '{m}' measure, count({m}) row_count, round(avg(cast({m} as double)), 4) mean,
            round(stddev_samp(cast({m} as double)), 4) stddev, round(min(cast({m} as double)), 6) smallest,
            round(max(cast({m} as double)), 6) largest from silver"""
        for m in METRICS
    ),
    "churn_label_share": f"""
        select churn, row_count, {SHARE.format(n='row_count')} from (
            select case when recency > 90 then 1 else 0 end churn, count(*) row_count
            from silver s left join scored r on s.customer_unique_id = r.customer_unique_id group by churn)""",
    "payments_per_order": "select * replace (cast(total_payment_value as double) as total_payment_value) from pay_agg",
    "reviews_per_order": f"select * replace ({iso('review_creation_date')}) from rev_agg",
    "items_per_order": f"select * replace ({dbl('total_price', 'total_freight_value')}) from items_agg",
    "product_category_join": """
        select p.product_id, p.product_category_name, t.product_category_name_english
        from prod p left join trans t on p.product_category_name = t.product_category_name""",
    "items_enriched": f"select * replace ({iso('shipping_limit_date')}, {dbl('price', 'freight_value')}) from items",
    "dedup_orders": f"select order_id, customer_id, order_status, {iso('order_purchase_timestamp')} from raw_orders",
    "merged_orders": f"{WIDE} merged",
    "colocated_orders": f"{WIDE} merged",
    "clean_orders": f"{WIDE} cleaned",
    "order_features": """
        select order_id, delivery_days, estimated_vs_actual, freight_ratio, cast(order_value as double) order_value,
               delivery_status, satisfaction_level from silver""",
    "purchase_calendar": """
        select order_id, purchase_hour, purchase_dayofweek, purchase_month, purchase_year, purchase_quarter,
               purchase_year_month from visits""",
    "parse_timestamps": """
        select order_id, case when order_id % 10 <> 0
                   then strftime(order_purchase_timestamp, '%Y-%m-%dT%H:%M:%S') end order_approved_at,
               case when order_id % 10 <> 0 then year(order_purchase_timestamp) end parsed_year
        from raw_orders""",
    "project_order_summary": """
        select order_id, customer_unique_id, order_status status, main_category_english category, total_items,
               cast(order_value as double) order_value, max_installments installments from silver""",
    "rfm_customers": f"select * replace ({iso(*CUSTOMER_DATES)}, {dbl('monetary')}) from rfm",
    "rfm_scores": """
        select customer_unique_id, recency, frequency, cast(monetary as double) monetary, r_score, f_score, m_score,
               rfm_score from scored""",
    "rfm_scores_folded": f"select * replace ({iso(*CUSTOMER_DATES)}, {dbl('monetary')}) from scored",
    "orders_with_rfm": """
        select s.order_id, s.customer_unique_id, recency, frequency, cast(monetary as double) monetary, r_score,
               f_score, m_score, rfm_score, avg_review_score, avg_delivery_days, customer_tenure_days
        from silver s left join scored r on s.customer_unique_id = r.customer_unique_id""",
    "churn_flag": """
        select s.order_id, s.customer_unique_id, recency, case when recency > 90 then 1 else 0 end churn
        from silver s left join scored r on s.customer_unique_id = r.customer_unique_id""",
    "overview_summary": """
        select count(*) total_orders, count(distinct customer_unique_id) total_customers,
               cast(round(sum(total_payment_value), 2) as double) total_revenue,
               round(cast(sum(order_value) as double) / count(*), 2) avg_order_value,
               strftime(min(order_purchase_timestamp), '%Y-%m-%dT%H:%M:%S') date_range_start,
               strftime(max(order_purchase_timestamp), '%Y-%m-%dT%H:%M:%S') date_range_end from silver""",
    "order_percentiles_exact": union(
        f"""select '{m}' measure, round(quantile_cont(cast({m} as double), 0.25), 6) p25,
            round(quantile_cont(cast({m} as double), 0.5), 6) p50,
            round(quantile_cont(cast({m} as double), 0.75), 6) p75 from silver"""
        for m in METRICS
    ),
    "order_percentiles_approx_ranks": union(
        f"select '{m}' measure, '{p}' as point, count({m}) row_count, true in_bounds from silver"
        for m in METRICS
        for p in ("p25", "p50", "p75")
    ),
    "orders_by_status": f"""
        select order_status, order_count, total_revenue, avg_review_score, {SHARE.format(n='order_count')} from (
            select order_status, count(*) order_count,
                   cast(round(sum(total_payment_value), 2) as double) total_revenue,
                   $mean_review avg_review_score from silver group by order_status)""",
    "monthly_revenue": """
        select purchase_year_month, order_count, revenue monthly_revenue, unique_customers, avg_review_score,
               avg_delivery_days from months""",
    "monthly_revenue_growth": """
        select purchase_year_month, order_count, revenue monthly_revenue, unique_customers, avg_review_score,
               avg_delivery_days, case when previous > 0 then round((revenue - previous) / previous * 100, 2) end
               mom_growth_pct
        from (select *, lag(revenue) over (order by purchase_year_month) previous from months)""",
    "orders_by_state": f"""
        select customer_state, order_count, total_revenue, unique_customers, avg_review_score, avg_delivery_days,
               mean_value avg_order_value, {SHARE.format(n='order_count')} from states""",
    "review_distribution": f"""
        select review_score, review_count, avg_delivery_days, avg_order_value, avg_freight_ratio,
               {SHARE.format(n='review_count')}
        from (select cast(floor(review_score) as int) review_score, count(*) review_count,
                     cast(sum(delivery_days) as double) / nullif(count(delivery_days), 0) avg_delivery_days,
                     cast(sum(order_value) as double) / count(*) avg_order_value,
                     $mean_freight_ratio avg_freight_ratio
              from silver where review_score > 0 group by 1)""",
    "review_average": "select round(avg(review_score), 2) avg_score from silver where review_score > 0",
    "review_by_delivery_status": """
        select delivery_status, count(*) review_count, $mean_review avg_review_score,
               cast(sum(delivery_days) as double) / nullif(count(delivery_days), 0) avg_delivery_days
        from silver where review_score > 0 group by delivery_status""",
    "category_revenue": "select * from cats",
    "top_categories": "select * from cats order by total_revenue desc, main_category_english limit 10",
    "bottom_categories": "select * from cats order by total_revenue, main_category_english limit 10",
    "category_count": "select count(*) total_categories from cats",
    "category_mean_review": "select round(avg(avg_review_score), 2) avg_review from cats where avg_review_score > 0",
    "payment_methods": f"select *, {SHARE.format(n='order_count')} from methods",
    "installment_histogram": """
        select max_installments, count(*) order_count,
               cast(sum(total_payment_value) as double) / count(*) avg_payment_value
        from silver where payment_type = 'RO' group by max_installments""",
    "delivery_overall": """
        select round(cast(sum(delivery_days) as double) / count(*), 2) avg_delivery_days,
               round(stddev_samp(delivery_days), 2) std_delivery_days,
               round(quantile_cont(cast(delivery_days as double), 0.5), 2) median_delivery_days,
               round(quantile_cont(cast(delivery_days as double), 0.95), 2) p95_delivery_days,
               min(delivery_days) min_delivery_days, max(delivery_days) max_delivery_days,
               round(cast(count(*) filter (estimated_vs_actual >= 0) as double) / count(*) * 100, 2) on_time_rate_pct
        from arrived""",
    "delivery_buckets": f"""
        select delivery_bucket, order_count, avg_review_score, {SHARE.format(n='order_count')} from (
            select case when delivery_days <= 7 then '0-7 days' when delivery_days <= 14 then '8-14 days'
                        when delivery_days <= 21 then '15-21 days' when delivery_days <= 30 then '22-30 days'
                        else 'over 30 days' end delivery_bucket,
                   count(*) order_count, $mean_review avg_review_score from arrived group by 1)""",
    "slowest_states": """
        select customer_state, count(*) order_count, cast(sum(delivery_days) as double) / count(*) avg_delivery_days,
               quantile_cont(cast(delivery_days as double), 0.5) median_delivery_days,
               cast(sum(estimated_vs_actual) as double) / count(estimated_vs_actual) avg_estimated_vs_actual
        from arrived group by customer_state order by avg_delivery_days desc, customer_state limit 10""",
    "delivery_days_histogram": """
        select bin, low + bin * width bin_from, low + (bin + 1) * width bin_to, count(*) row_count
        from (select cast(least(floor((cast(delivery_days as double) - low) / width), 9) as int) bin, low, width
              from silver, (select cast(min(delivery_days) as double) low,
                                   (cast(max(delivery_days) as double) - cast(min(delivery_days) as double)) / 10 width
                            from silver)
              where delivery_days is not null)
        group by bin, low, width""",
    "orders_by_hour": """
        select purchase_hour, count(*) order_count, cast(round(sum(total_payment_value), 2) as double) total_revenue
        from visits group by purchase_hour""",
    "orders_by_weekday": """
        select purchase_dayofweek, count(*) order_count,
               cast(round(sum(total_payment_value), 2) as double) total_revenue
        from visits group by purchase_dayofweek""",
    "weekday_hour_heatmap": """
        select (purchase_dayofweek + 5) % 7 weekday, purchase_hour as hour, order_count from cells""",
    "rfm_frequency_distribution": "select frequency, count(*) customer_count from rfm group by frequency",
    "rfm_score_distribution": """
        select rfm_score, count(*) customer_count, cast(sum(monetary) as double) / count(*) avg_monetary
        from scored group by rfm_score""",
    "repeat_customer_rate": """
        select count(*) total_customers, count(*) filter (frequency > 1) repeat_customers,
               round(cast(count(*) filter (frequency > 1) as double) / count(*) * 100, 2) repeat_customer_rate_pct
        from rfm""",
    "order_documents": ORDER_DOCUMENT,
    "customer_documents": f"select * replace ({iso(*CUSTOMER_DATES)}, {dbl('monetary')}) from docs",
    "product_reviews": "select * from product_scores",
    "product_stats": "select * from product_docs",
    "seller_metrics": f"select * replace ({iso('first_sale_date', 'last_sale_date')}) from seller_facts",
    "seller_stats": f"""
        select s.seller_id, seller_city, seller_state, seller_zip_code_prefix,
               coalesce(total_items_sold, 0) total_items_sold, coalesce(total_orders, 0) total_orders,
               coalesce(total_revenue, 0) total_revenue, coalesce(avg_price, 0) avg_price, total_freight, avg_freight,
               unique_products, coalesce(avg_review_score, 0) avg_review_score,
               coalesce(avg_delivery_days, 0) avg_delivery_days, coalesce(unique_customers, 0) unique_customers,
               {iso('first_sale_date', 'last_sale_date')}
        from sell s left join seller_sales a on s.seller_id = a.seller_id
             left join seller_facts m on s.seller_id = m.seller_id""",
    "gold_monthly": "select * rename (revenue as total_revenue) from months",
    "gold_category": "select * from cats",
    "gold_state": "select * exclude (mean_value) rename (mean_payment as avg_order_value) from states",
    "gold_hourly": "select * from cells",
    "gold_payment": "select * exclude (avg_review_score) from methods",
    "segment_stats": "select * from seg_stats",
    "aggregations_union": AGGREGATES,
    "aggregation_documents": AGGREGATES,
    "kpi_overview": """
        select cast(round(sum(order_value), 2) as double) order_revenue, count(*) total_orders,
               round(avg(case when review_score > 0 then review_score end), 2) avg_review,
               (select count(*) from rfm) total_customers, (select count(*) from sell) total_sellers from silver""",
    "revenue_series_order_value": """
        select purchase_year_month as month, cast(round(sum(order_value), 2) as double) order_revenue, count(*) orders
        from silver group by purchase_year_month""",
    "revenue_converted": """
        select *, round(order_revenue * 5140e0, 2) converted_revenue from (
            select purchase_year_month as month, cast(round(sum(order_value), 2) as double) order_revenue,
                   count(*) orders from silver group by purchase_year_month)""",
    "category_display_name": """
        select product_category_name_english,
               upper(product_category_name_english[1]) || product_category_name_english[2:] display_name from trans""",
    "top20_categories": "select * from top_cats",
    "category_from_products": """
        select category_en, cast(sum(total_orders) as bigint) total_sold, round(sum(total_revenue), 2) revenue,
               round(avg(avg_price), 2) avg_price, round(avg(avg_review_score), 2) avg_review
        from product_docs group by category_en order by total_sold desc, category_en limit 20""",
    "category_radar": """
        select category, round(revenue / max(revenue) over () * 100, 4) revenue_axis,
               round(cast(total_sold as double) / max(total_sold) over () * 100, 4) sold_axis,
               round(avg_price / max(avg_price) over () * 100, 4) price_axis, round(avg_review * 20, 4) review_axis
        from (select * from top_cats order by revenue desc, category limit 5)""",
    "category_price_review": """
        select category, avg_price, avg_review from top_cats where avg_price <> 0 and avg_review <> 0""",
    "segment_distribution": "select segment_name segment, count(*) customer_count from docs group by segment_name",
    "rfm_sample": """
        select customer_unique_id, segment_name segment, recency, frequency, cast(monetary as double) monetary
        from docs order by md5(cast(customer_unique_id as varchar)), customer_unique_id limit 500""",
    "top_customers": f"""
        select {CUSTOMER_ROW}, frequency from docs order by docs.monetary desc, customer_unique_id limit 50""",
    "segment_cohort_trend": """
        select strftime(first_purchase_date, '%Y-%m') as month, segment_name segment, count(*) customer_count
        from docs group by 1, 2""",
    "segment_month_matrix": f"""
        select strftime(first_purchase_date, '%Y-%m') as month,
               {', '.join(SEGMENT_COUNT.format(s=s) for s in ('Champions', 'Loyal', 'At Risk', 'Lost'))}
        from docs group by 1""",
    "segment_revenue": """
        select segment_name segment, cast(round(sum(monetary), 2) as double) revenue from docs group by segment_name""",
    "segment_radar": """
        select segment_name segment,
               round(greatest(0.05e0, 1 - avg_recency / max(avg_recency) over ()), 6) recency_axis,
               round(greatest(0.05e0, avg_frequency / max(avg_frequency) over ()), 6) frequency_axis,
               round(greatest(0.05e0, avg_monetary / max(avg_monetary) over ()), 6) monetary_axis
        from seg_stats""",
    "churn_rate": """
        select count(*) total, count(*) filter (churn_prediction = 1) churned,
               round(cast(count(*) filter (churn_prediction = 1) as double) / count(*) * 100, 2) churn_rate from docs""",
    "churn_by_segment": """
        select segment_name segment, count(*) total, count(*) filter (churn_prediction = 1) churned,
               round(cast(count(*) filter (churn_prediction = 1) as double) / count(*) * 100, 2) churn_rate,
               round(avg(churn_probability), 2) avg_probability from docs group by segment_name""",
    "high_risk_customers": f"""
        select {RISK_ROW} from docs where docs.churn_probability > 0
        order by docs.churn_probability desc, customer_unique_id limit 10""",
    "churn_by_state": """
        select customer_state state, count(*) total, count(*) filter (churn_prediction = 1) churned
        from docs group by customer_state order by churned desc, state limit 5""",
    "review_histogram": """
        select cast(floor(review_score) as int) score, count(*) order_count
        from silver where review_score > 0 group by 1""",
    "top_states": """
        select customer_state state, total_revenue revenue, order_count orders
        from states order by total_revenue desc, customer_state limit 15""",
    "state_revenue_from_customers": """
        select customer_state state, count(*) customers, cast(round(sum(monetary), 2) as double) revenue
        from docs group by customer_state order by customers desc, state limit 15""",
    "payment_totals": "select payment_type as method, order_count, total_revenue total from methods",
    "logistics_kpis": """
        select round(cast(sum(delivery_days) as double) / count(*), 1) avg_delivery_days,
               round(avg(freight_ratio) * 100, 1) avg_freight_pct, count(*) total_delivered,
               count(*) filter (delivery_status = 'late') total_late,
               round(cast(count(*) filter (delivery_status = 'late') as double) / count(*) * 100, 1) late_rate
        from silver where order_status = 'delivered' and delivery_days is not null""",
    "delivery_status_counts": "select delivery_status, count(*) order_count from silver group by delivery_status",
    "satisfaction_counts": "select satisfaction_level, count(*) order_count from silver group by satisfaction_level",
    "state_delivery": """
        select customer_state state, count(*) order_count,
               round(cast(sum(delivery_days) as double) / count(*), 1) avg_delivery_days
        from silver where order_status = 'delivered' and delivery_days is not null
        group by customer_state order by order_count desc, state limit 10""",
    "review_impact": """
        select delivery_status, round(avg(review_score), 2) avg_score
        from silver where delivery_status in ('on_time', 'late') group by delivery_status""",
    "search_customers": f"""
        select {CUSTOMER_ROW}, frequency from docs where contains(cast(customer_unique_id as varchar), '12')""",
    "indexed_search": f"""
        select {CUSTOMER_ROW}, frequency from docs where contains(cast(customer_unique_id as varchar), '12')""",
    "customers_page": f"""
        select *, (select count(*) from docs where contains(cast(customer_unique_id as varchar), '12')) total_records,
               cast(ceil((select count(*) from docs where contains(cast(customer_unique_id as varchar), '12')) / 10.0)
                    as bigint) total_pages, 3 page
        from (select {CUSTOMER_ROW}, frequency from docs where contains(cast(customer_unique_id as varchar), '12')
              order by docs.monetary desc, customer_unique_id limit 10 offset 20)""",
    "churn_page": f"""
        select *, (select count(*) from docs where churn_probability > 0) total_records,
               cast(ceil((select count(*) from docs where churn_probability > 0) / 25.0) as bigint) total_pages, 2 page
        from (select {RISK_ROW} from docs where docs.churn_probability > 0
              order by docs.churn_probability desc, customer_unique_id limit 25 offset 25)""",
    "customer_lookup": """
        select customer_unique_id, recency, frequency, cast(monetary as double) monetary,
               avg_review_score review_score, avg_delivery_days delivery_days
        from docs where customer_unique_id = 42""",
    "latest_order_per_customer": f"""
        select customer_unique_id, {iso('order_purchase_timestamp')}, order_id, cast(total_price as double) price,
               cast(total_freight_value as double) freight_value, delivery_days, total_items item_count,
               max_installments installments
        from (select *, row_number() over (partition by customer_unique_id
                  order by order_purchase_timestamp desc, order_id desc) rn from silver) where rn = 1""",
    "churn_features": "select * from feats",
    "risk_score": "select customer_unique_id, round(risk, 6) risk, label from labelled",
    "minmax_risk": "select * from minmax",
    "risk_score_serving": "select * from served",
    "risk_levels": "select risk_level, risk_badge, count(*) customer_count from served group by 1, 2",
    "class_weights": """
        select label, count(*) customer_count,
               (select cast(count(*) as double) from labelled) / (2 * count(*)) weight from labelled group by label""",
    "train_test_split": """
        select customer_unique_id,
               case when cast('0x' || substr(md5(cast(customer_unique_id as varchar)), 1, 8) as bigint) % 100 < 80
                    then 'train' else 'test' end split from feats""",
    "stratified_split": """
        select customer_unique_id, label, case when rn <= floor(n * 0.8) then 'train' else 'test' end split
        from (select customer_unique_id, cast(label as double) label, count(*) over (partition by label) n,
                     row_number() over (partition by label
                         order by md5(cast(customer_unique_id as varchar)), customer_unique_id) rn from minmax)""",
    "formula_metrics": """
        select 'RiskFormula' model, 'auc_roc' metric, round(area, 4) as value from guess_area
        union all select 'RiskFormula', 'accuracy', round(accuracy, 4) from guess_scores
        union all select 'RiskFormula', 'precision', round(share1 * p1 + share0 * p0, 4) from guess_scores
        union all select 'RiskFormula', 'recall', round(share1 * r1 + share0 * r0, 4) from guess_scores
        union all select 'RiskFormula', 'f1_score', round(share1 * coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0)
            + share0 * coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0), 4) from guess_scores""",
    "category_mean_metrics": """
        select 'CategoryMean' model, 'rmse' metric, round(sqrt(avg((y - p) * (y - p))), 4) as value from category_guesses
        union all select 'CategoryMean', 'mae', round(avg(abs(y - p)), 4) from category_guesses
        union all select 'CategoryMean', 'r2', round(1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)), 4)
            from category_guesses""",
    "confusion_totals": """
        select label, count(*) row_count from labelled
        where cast('0x' || substr(md5(cast(customer_unique_id as varchar)), 1, 8) as bigint) % 100 >= 80
        group by label""",
    "sketched_customers": """
        select 'month' "level", purchase_year_month as name, count(distinct customer_unique_id) unique_customers,
               true within_bound from silver group by purchase_year_month
        union all select 'state', customer_state, count(distinct customer_unique_id), true from silver group by customer_state
        union all select 'all', 'all', count(distinct customer_unique_id), true from silver""",
    "sketched_returning": """
        select purchase_year_month, (select count(*) from (select distinct customer_unique_id from silver a
                   where a.purchase_year_month = m.purchase_year_month and a.customer_unique_id in
                       (select customer_unique_id from silver b where b.purchase_year_month = m.previous))) returning_customers,
               true within_bound
        from (select purchase_year_month, lag(purchase_year_month) over (order by purchase_year_month) previous
              from (select distinct purchase_year_month from silver)) m where previous is not null""",
    "sketched_percentiles": """
        select customer_state, point, count(*) orders, true within_bound
        from silver, (select unnest([0.25e0, 0.5e0, 0.75e0]) point) group by customer_state, point""",
    "formula_auc": """
        select (select count(*) from guesses) rows_scored, (select cast(sum(label) as bigint) from guesses) positives,
               round(area, 9) auc from guess_area""",
    "refreshed_silver": """
        select order_id, purchase_year_month, total_items, cast(total_payment_value as double) total_payment_value,
               review_score, cast(order_value as double) order_value from silver""",
    "model_table_formula": f"""
        select 'RiskFormula *' as name, false is_regression, {FIGURES['accuracy']} accuracy, {FIGURES['precision']} "precision",
               {FIGURES['recall']} recall, {FIGURES['f1_score']} f1, {FIGURES['auc_roc']} auc, cast(null as double) rmse
        from guess_scores, guess_area""",
    "inferred_schema": union(_inferred(t, c, x, k) for t, columns in RAW_COLUMNS.items() for c, (x, k) in columns.items()),
    "rfm_fraction_sample": f"""
        select * replace ({iso(*CUSTOMER_DATES)}, {dbl('monetary')}) from scored
        where cast('0x' || substr(md5(cast(customer_unique_id as varchar)), 1, 8) as bigint) % 1000000
              < floor(least(1e0, 500e0 / (select cast(count(*) as double) from scored)) * 1000000)""",
    "customers_after": f"""
        select {CUSTOMER_ROW}, frequency from docs
        where docs.monetary < 1000000 or (docs.monetary = 1000000 and customer_unique_id > 0)
        order by docs.monetary desc, customer_unique_id limit 10""",
    "delivery_by_state": """
        select customer_state, count(*) order_count, cast(sum(delivery_days) as double) / count(*) avg_delivery_days,
               quantile_cont(cast(delivery_days as double), 0.5) median_delivery_days,
               cast(sum(estimated_vs_actual) as double) / count(estimated_vs_actual) avg_estimated_vs_actual
        from arrived group by customer_state""",
    "describe_customer_scores": union(
        f"""select '{m}' measure, count({m}) row_count, round(avg(cast({m} as double)), 4) mean,
            round(stddev_samp(cast({m} as double)), 4) stddev, round(min(cast({m} as double)), 6) smallest,
            round(max(cast({m} as double)), 6) largest from scored"""
        for m in ("recency", "frequency", "monetary", "rfm_score")
    ),
    "dq_contract_customers": _contract("docs", "customer_unique_id", CUSTOMER_FIELDS),
    "dq_contract_products": _contract("product_docs", "product_id", PRODUCT_FIELDS),
    "dq_contract_sellers": _contract("sell", "seller_id", SELLER_FIELDS),
    "monetary_winsorised": """
        select customer_unique_id,
               round(least(cast(monetary as double),
                           (select quantile_cont(cast(monetary as double), 0.95) from rfm)), 6) monetary_capped
        from rfm""",
    "kmeans_checks": """
        select count(*) customers, true nearest, true centred, true silhouette_agrees
        from scored where recency is not null and frequency is not null and monetary is not null""",
    "kmeans_input": """
        select customer_unique_id, cast(recency as double) recency, cast(frequency as double) frequency,
               cast(monetary as double) monetary
        from scored where recency is not null and frequency is not null and monetary is not null""",
}


def _needed(sql: str) -> list[str]:
    """Names of the shared relations a statement uses, directly or through others, in definition order."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\b[a-z_]+\b", todo.pop()))
        fresh = (words & RELATIONS.keys()) - found
        found |= fresh
        todo += [RELATIONS[name] for name in fresh]
    return [name for name in RELATIONS if name in found]


def statement(name: str) -> str:
    sql = QUERIES[name]
    shared = ", ".join(f"{r} as ({RELATIONS[r]})" for r in _needed(sql))
    whole = f"with {shared} {sql}" if shared else sql
    for token, mean in MEANS.items():
        whole = whole.replace(token, mean)
    return whole


def statements() -> dict[str, str]:
    return {name: statement(name) for name in QUERIES}
