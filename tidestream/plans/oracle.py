"""Independent SQL for the registered queries, run by DuckDB on the same Parquet tables."""

from __future__ import annotations

from tidestream.sources.testdata import AS_OF, TEST_CATEGORIES
from tidestream.functions import category_column
from tidestream.operators.features import feature_columns

# Shared sub-queries in order of dependency; a statement carries those it needs.
_PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    # Number, defects and product lookup of every event.
    "clickstream": (
        (),
        """
        select
          event_number,
          'e_' || event_number as event_id,
          case when event_number % 61 <> 0 then kind end as event_type,
          case when event_number % 71 = 0 then ''
               when event_number % 73 <> 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') end as "timestamp",
          case when event_number % 97 <> 0 then 'user_' || uid end as user_id,
          case when event_number % 89 <> 0
               then 's_' || uid || '_' || cast(cast(ts as date) as varchar) end as session_id,
          case when kind not in ('search', 'error') and event_number % 41 <> 0
               then 'P' || p_partkey end as product_id,
          case when kind not in ('search', 'error') then p_name end as product_name,
          case when kind not in ('search', 'error') then p_type end as product_category,
          case when kind not in ('search', 'error') then p_retailprice end as product_price,
          case when kind not in ('search', 'error') then p_brand end as product_brand,
          case when k % 10 = 9 then null when k % 5 < 2 then 'desktop'
               when k % 5 < 4 then 'mobile' else 'tablet' end as device_type,
          'city_' || (k % 10) as city
        from (
          select event_id as event_number, ts, user_id as uid,
            cast(json_extract_string(props, '$.k') as integer) as k,
            case event_type when 'view' then 'page_view' when 'click' then 'add_to_cart'
                            when 'signup' then 'search' else event_type end as kind
          from events
          union all
          select event_id, ts, user_id, cast(json_extract_string(props, '$.k') as integer),
            case event_type when 'view' then 'page_view' when 'click' then 'add_to_cart'
                            when 'signup' then 'search' else event_type end
          from events where event_id % 50 = 0
        ) as deliveries
        left join part on p_partkey = k
        """,
    ),
    "flagged": (
        ("clickstream",),
        """
        select *, user_id is not null and session_id is not null and event_type is not null
          and coalesce("timestamp", '') <> ''
          and not (coalesce(event_type, '') in ('page_view', 'add_to_cart', 'purchase')
                   and product_id is null) as is_valid
        from clickstream
        """,
    ),
    "valid": (
        ("flagged",),
        """
        select * exclude (copy) from (
          select *, row_number() over (partition by event_id order by event_number) as copy
          from flagged where is_valid) as numbered
        where copy = 1
        """,
    ),
    "enriched": (
        ("valid",),
        """
        select *, cast(event_at as date) as day, strftime(event_at, '%Y-%m-%d') as event_date,
          cast(hour(event_at) as integer) as event_hour
        from (select *, try_cast("timestamp" as timestamp) as event_at from valid) as parsed
        """,
    ),
    "sessions": (
        ("enriched",),
        """
        select session_id, user_id, event_date, min(day) as day,
          count(*) as page_views,
          count(distinct product_id) as unique_products_viewed,
          count(*) filter (event_type = 'add_to_cart') as add_to_cart_events,
          count(*) filter (event_type = 'purchase') as purchase_events,
          count(*) filter (event_type = 'search') as search_events,
          min(event_at) as session_start, max(event_at) as session_end,
          cast(epoch(date_trunc('second', max(event_at)))
               - epoch(date_trunc('second', min(event_at))) as bigint) as seconds,
          arg_min(device_type, event_at) filter (device_type is not null) as first_device,
          count(distinct product_category) as n_categories
        from enriched group by session_id, user_id, event_date
        """,
    ),
    "category_lists": (
        ("enriched",),
        """
        select session_id, user_id, event_date,
          string_agg(product_category || ':' || n, ',' order by product_category) as category_counts,
          string_agg(product_category, ',' order by product_category) as categories_viewed
        from (select session_id, user_id, event_date, product_category, count(*) as n
              from enriched where product_category is not null group by all) as c
        group by session_id, user_id, event_date
        """,
    ),
    "device_lists": (
        ("enriched",),
        """
        select session_id, user_id, event_date,
          string_agg(device_type || ':' || n, ',' order by device_type) as device_counts,
          string_agg(device_type, ',' order by device_type) as devices_used
        from (select session_id, user_id, event_date, device_type, count(*) as n
              from enriched where device_type is not null group by all) as d
        group by session_id, user_id, event_date
        """,
    ),
    "inputs": (
        ("sessions", "category_lists", "device_lists"),
        """
        select session_id, user_id, event_date,
          cast(hour(session_start) as integer) as event_hour,
          cast(isodow(day) - 1 as integer) as day_of_week,
          page_views, unique_products_viewed, add_to_cart_events, search_events,
          cast(seconds as double) as session_duration_seconds,
          coalesce(first_device, 'unknown') as device_type,
          coalesce(devices_used, '') as devices_used,
          coalesce(categories_viewed, '') as categories_viewed,
          cast(n_categories as integer) as n_categories_viewed,
          cast(purchase_events > 0 as integer) as converted_to_purchase
        from sessions
        left join category_lists using (session_id, user_id, event_date)
        left join device_lists using (session_id, user_id, event_date)
        """,
    ),
    "scored": (
        ("inputs",),
        """
        select *, cast(probability_purchase >= 0.5e0 as integer) as prediction_label,
          cast(converted_to_purchase as double) as label,
          case when probability_purchase < 0.2e0 then '0-20%'
               when probability_purchase < 0.4e0 then '20-40%'
               when probability_purchase < 0.6e0 then '40-60%'
               when probability_purchase < 0.8e0 then '60-80%' else '80-100%' end
            as probability_bucket
        from (
          select *, round(greatest(least(
              (0.025e0 + 0.35e0 * add_to_cart_events + 0.018e0 * ln(1 + page_views)
               + 0.010e0 * ln(1 + session_duration_seconds) + 0.012e0 * search_events)
              * case device_type when 'mobile' then 0.75e0 when 'tablet' then 0.85e0 else 1e0 end,
              0.90e0), 0.01e0), 6) as probability_purchase
          from inputs) as ruled
        """,
    ),
    "lines": (
        ("enriched",),
        """
        select 'ORD_' || event_number as order_id, event_id, user_id, event_at, event_date,
          'P' || l_partkey as product_id, cast(l_quantity as integer) as quantity,
          l_extendedprice / l_quantity as product_price,
          l_extendedprice / l_quantity * cast(l_quantity as integer) as line_value
        from enriched join lineitem on l_orderkey = event_number
        where event_type = 'purchase'
        """,
    ),
    "features": (
        ("inputs",),
        "select *, "
        + """
          ln(1 + page_views) as log_page_views, ln(1 + session_duration_seconds) as log_duration,
          ln(1 + add_to_cart_events) as log_add_to_cart, ln(1 + search_events) as log_search,
          ln(1 + unique_products_viewed) as log_unique_products,
          cast(device_type = 'desktop' as integer) as device_desktop,
          cast(device_type = 'mobile' as integer) as device_mobile,
          cast(device_type = 'tablet' as integer) as device_tablet,
          cast(day_of_week in (5, 6) as integer) as is_weekend,
          cast(event_hour between 6 and 11 as integer) as hour_morning,
          cast(event_hour between 12 and 17 as integer) as hour_afternoon,
          cast(event_hour between 18 and 23 as integer) as hour_evening,
          cast(event_hour between 0 and 5 as integer) as hour_night,
        """
        + ", ".join(
            f"cast(list_contains(string_split(categories_viewed, ','), '{c}') as integer)"
            f" as {category_column(c)}"
            for c in TEST_CATEGORIES
        )
        + """,
          unique_products_viewed / (page_views + 1) as browse_to_product_ratio,
          case when cast('0x' || substr(md5(session_id), 1, 8) as bigint) % 100 < 80
               then 'train' else 'test' end as split
        from inputs
        """,
    ),
}

_STATEMENTS: dict[str, tuple[tuple[str, ...], str]] = {}


def _oracle(name: str, *needs: str, sql: str) -> None:
    _STATEMENTS[name] = (needs, sql)


# -- ingest -------------------------------------------------------------------
_TOPIC = """case when event_type = 'purchase' then 'retail_transactions'
                 when event_type = 'error' then 'retail_errors'
                 else 'retail_clickstream' end"""
_oracle(
    "decode_events",
    "clickstream",
    sql=f"""
    select event_id, event_type, "timestamp", user_id, session_id, product_id, device_type, city,
      {_TOPIC} as kafka_topic, cast(event_number % 6 as integer) as kafka_partition,
      event_number as kafka_offset, user_id as kafka_key,
      event_number * 1000 as kafka_timestamp
    from clickstream""",
)
_oracle(
    "route_topics",
    "clickstream",
    sql=f"""
    select topic, case topic when 'retail_clickstream' then 'clickstream-processing-job'
                             when 'retail_transactions' then 'transaction-processing-job'
                             when 'retail_inventory' then 'inventory-processing-job'
                             else 'default-processing-job' end as job, count(*) as messages
    from (select {_TOPIC} as topic from clickstream) as routed group by topic""",
)
_oracle(
    "parse_envelope",
    "clickstream",
    sql="""
    select event_id, event_type, product_id, product_category, 3 * count(*) as messages
    from clickstream where event_number % 101 <> 0 and event_number % 103 <> 0
    group by event_id, event_type, product_id, product_category""",
)
_oracle(
    "raw_partition_counts",
    "enriched",
    sql="""
    select cast(year(event_at) as integer) as "year", cast(month(event_at) as integer) as "month",
      cast(day(event_at) as integer) as "day", cast(hour(event_at) as integer) as "hour",
      count(*) as events
    from enriched group by 1, 2, 3, 4""",
)

# -- quality ------------------------------------------------------------------
_oracle(
    "valid_keys",
    "clickstream",
    sql="""
    select event_id, event_type, user_id, session_id from clickstream
    where user_id is not null and session_id is not null and event_type is not null""",
)
_oracle(
    "valid_timestamps",
    "clickstream",
    sql="""
    select event_id, "timestamp" from clickstream
    where "timestamp" is not null and length("timestamp") > 0""",
)
_oracle(
    "valid_products",
    "clickstream",
    sql="""
    select event_id, event_type, product_id from clickstream
    where not (event_type in ('page_view', 'add_to_cart', 'purchase') and product_id is null)""",
)
_oracle(
    "validated_events",
    "valid",
    sql="""
    select event_id, event_type, "timestamp", user_id, session_id, product_id, product_name,
      product_category, product_brand, device_type, city from valid""",
)
_oracle(
    "dedup_events",
    "clickstream",
    sql="""
    select distinct event_id, event_type, "timestamp", user_id, session_id from clickstream""",
)
_oracle(
    "data_quality",
    "flagged",
    sql="""
    select count(*) as total_events, count(distinct event_id) filter (is_valid) as valid_events,
      round(count(distinct event_id) filter (is_valid) * 100e0 / count(*), 6) as data_quality_rate
    from flagged""",
)
_oracle(
    "freshness",
    "enriched",
    sql=f"""
    select strftime(latest, '%Y-%m-%d %H:%M:%S.%f') as latest, age_seconds,
      case when latest is null then 'missing'
           when latest < timestamp '{AS_OF} 23:59:59' - interval 1 hour then 'stale'
           else 'fresh' end as status
    from (select max(event_at) as latest,
            cast(epoch(timestamp '{AS_OF} 23:59:59')
                 - epoch(date_trunc('second', max(event_at))) as bigint) as age_seconds
          from enriched where day = date '{AS_OF}') as newest""",
)

# -- enrichment and carts -----------------------------------------------------
_oracle(
    "enriched_events",
    "enriched",
    sql="""
    select event_id, strftime(event_at, '%Y-%m-%d %H:%M:%S.%f') as event_timestamp, event_date,
      event_hour, 0 as session_duration_seconds from enriched""",
)
_oracle(
    "device_flags",
    "valid",
    sql="""
    select event_id, cast(device_type = 'mobile' as varchar) as is_mobile,
      cast(device_type = 'tablet' as varchar) as is_tablet,
      cast(device_type = 'desktop' as varchar) as is_desktop from valid""",
)
_oracle(
    "purchase_lines",
    "lines",
    sql="""
    select order_id, event_id, user_id, product_id, quantity,
      product_price, line_value from lines""",
)
_oracle(
    "cart_lines",
    "enriched",
    sql="""
    select 'ORD_' || event_number as order_id, event_id,
      cast(row_number() over (partition by event_id
        order by l_linenumber, 'P' || l_partkey, l_extendedprice / l_quantity, l_quantity) - 1 as integer) as line_number,
      'P' || l_partkey as product_id, cast(l_quantity as integer) as quantity,
      l_extendedprice / l_quantity * cast(l_quantity as integer) as line_value
    from enriched join lineitem on l_orderkey = event_number where event_type = 'purchase'""",
)
_oracle(
    "order_values",
    "lines",
    sql="""
    select order_id, count(*) as line_count, round(sum(line_value), 2) as total_value
    from lines group by order_id""",
)

# -- sessions and metrics -----------------------------------------------------
_oracle(
    "session_metrics",
    "sessions",
    "category_lists",
    "device_lists",
    sql="""
    select session_id, user_id, event_date, page_views, unique_products_viewed,
      add_to_cart_events, purchase_events, search_events,
      strftime(session_start, '%Y-%m-%d %H:%M:%S.%f') as session_start,
      strftime(session_end, '%Y-%m-%d %H:%M:%S.%f') as session_end,
      coalesce(category_counts, '') as category_counts, coalesce(device_counts, '') as device_counts,
      coalesce(categories_viewed, '') as categories_viewed, coalesce(devices_used, '') as devices_used,
      seconds as session_duration_seconds,
      cast(purchase_events > 0 as integer) as converted_to_purchase,
      cast(add_to_cart_events > 0 as integer) as converted_to_cart
    from sessions
    left join category_lists using (session_id, user_id, event_date)
    left join device_lists using (session_id, user_id, event_date)""",
)
_oracle(
    "product_metrics",
    "enriched",
    sql="""
    select product_id, product_name, product_category, product_brand, event_date,
      total_views, unique_users, unique_sessions, add_to_cart_count, purchase_count,
      round(avg_price, 6) as avg_price, round(total_value, 6) as total_value,
      round(add_to_cart_count / total_views, 6) as view_to_cart_rate,
      round(purchase_count / total_views, 6) as view_to_purchase_rate,
      round(case when add_to_cart_count > 0 then purchase_count / add_to_cart_count else 0e0 end, 6)
        as cart_to_purchase_rate
    from (
      select product_id, max(product_name) as product_name, event_date,
        max(product_category) as product_category, max(product_brand) as product_brand,
        count(*) as total_views, count(distinct user_id) as unique_users,
        count(distinct session_id) as unique_sessions,
        count(*) filter (event_type = 'add_to_cart') as add_to_cart_count,
        count(*) filter (event_type = 'purchase') as purchase_count,
        avg(product_price) as avg_price, sum(product_price) as total_value
      from enriched where product_id is not null
      group by product_id, event_date) as totals""",
)
_oracle(
    "product_metrics_carts",
    "enriched",
    sql="""
    select product_id, product_name, product_category, product_brand, event_date,
      total_views, unique_users, unique_sessions, add_to_cart_count, purchase_count,
      round(add_to_cart_count / total_views, 6) as view_to_cart_rate,
      round(purchase_count / total_views, 6) as view_to_purchase_rate,
      round(case when add_to_cart_count > 0 then purchase_count / add_to_cart_count else 0e0 end, 6)
        as cart_to_purchase_rate
    from (
      select product_id, max(product_name) as product_name, event_date,
        max(product_category) as product_category, max(product_brand) as product_brand,
        count(*) as total_views, count(distinct user_id) as unique_users,
        count(distinct session_id) as unique_sessions,
        count(*) filter (event_type = 'add_to_cart') as add_to_cart_count,
        count(*) filter (event_type = 'purchase') as purchase_count
      from (
        select product_id, product_name, product_category, product_brand,
          event_type, event_date, user_id, session_id
        from enriched where event_type <> 'purchase' and product_id is not null
        union all
        select 'P' || l_partkey, null, null, null,
          event_type, event_date, user_id, session_id
        from enriched join lineitem on l_orderkey = event_number where event_type = 'purchase'
      ) as named group by product_id, event_date) as totals""",
)
_oracle(
    "hourly_metrics",
    "enriched",
    sql="""
    select event_date, event_hour, count(*) as total_events,
      count(distinct user_id) as unique_users, count(distinct session_id) as unique_sessions,
      count(*) filter (event_type = 'page_view') as page_views,
      count(*) filter (event_type = 'add_to_cart') as add_to_cart,
      count(*) filter (event_type = 'purchase') as purchases,
      count(*) filter (event_type = 'search') as searches
    from enriched group by event_date, event_hour""",
)
_oracle(
    "hourly_metrics_merged",
    "enriched",
    sql="""
    select event_date, event_hour, count(*) as total_events,
      count(*) filter (event_type = 'page_view') as page_views,
      count(*) filter (event_type = 'add_to_cart') as add_to_cart,
      count(*) filter (event_type = 'purchase') as purchases,
      count(*) filter (event_type = 'search') as searches
    from enriched group by event_date, event_hour""",
)
_STATEMENTS["session_metrics_merged"] = _STATEMENTS["session_metrics"]
_CATEGORY_METRICS = """
    select product_category, event_date, count(*) as category_views,
      count(distinct user_id) as unique_users,
      count(*) filter (event_type = 'add_to_cart') as add_to_cart,
      count(*) filter (event_type = 'purchase') as purchases
    from enriched where product_category is not null group by product_category, event_date"""
_oracle("category_metrics", "enriched", sql=_CATEGORY_METRICS)
_oracle(
    "device_metrics",
    "enriched",
    sql="""
    select event_date, count(*) filter (device_type = 'mobile') as mobile_events,
      count(*) filter (device_type = 'desktop') as desktop_events,
      count(*) filter (device_type = 'tablet') as tablet_events
    from enriched group by event_date""",
)
_oracle(
    "event_type_counts",
    "enriched",
    sql="""select event_type, count(*) as "count" from enriched group by event_type""",
)
_oracle(
    "processing_summary",
    "enriched",
    sql="""
    select count(*) as total_events_processed, count(distinct user_id) as unique_users,
      count(distinct session_id) as unique_sessions, count(distinct product_id) as unique_products
    from enriched""",
)
_oracle(
    "daily_activity",
    "enriched",
    sql=f"""
    select event_date as "date", count(*) as total_events, count(distinct user_id) as unique_users,
      count(*) filter (event_type = 'purchase') as purchases
    from enriched where day >= date '{AS_OF}' - 1 group by event_date order by event_date desc""",
)
_oracle(
    "daily_summary",
    "enriched",
    sql=f"""
    select event_date as report_date, count(*) as total_events,
      count(distinct user_id) as unique_users, count(distinct session_id) as unique_sessions,
      count(*) filter (event_type = 'purchase') as total_purchases,
      count(*) filter (event_type = 'add_to_cart') as total_add_to_cart,
      round(avg(case when event_type = 'purchase' then product_price end), 6) as avg_purchase_value
    from enriched where day >= date '{AS_OF}' - 1 group by event_date""",
)
_CONVERSION = """count(*) as sessions, cast(sum(converted_to_purchase) as bigint) as conversions,
      round(sum(converted_to_purchase) / count(*), 6) as conversion_rate"""
_oracle("conversion_rate", "inputs", sql=f"select {_CONVERSION} from inputs")
_oracle(
    "conversion_by_device",
    "inputs",
    sql=f"""
    select device_type, {_CONVERSION} from inputs group by device_type
    order by conversion_rate desc, device_type""",
)
_oracle(
    "conversion_by_hour",
    "inputs",
    sql=f"""
    select event_hour, {_CONVERSION} from inputs group by event_hour order by event_hour""",
)
_oracle(
    "describe_sessions",
    "inputs",
    sql=" union all ".join(
        f"""select '{m}' as measure, count({m}) as "count", round(avg({m}), 6) as mean,
        round(stddev({m}), 6) as stddev, round(cast(min({m}) as double), 6) as "min",
        round(cast(max({m}) as double), 6) as "max" from inputs"""
        for m in (
            "page_views",
            "unique_products_viewed",
            "add_to_cart_events",
            "search_events",
            "session_duration_seconds",
        )
    ),
)
_oracle(
    "top_products",
    "enriched",
    sql="""
    select product_id, count(*) as views from enriched where product_id is not null
    group by product_id order by views desc, product_id limit 10""",
)
_oracle(
    "top_products_recounted",
    "enriched",
    sql="""
    select product_id, count(*) as views from enriched
    where product_id is not null and event_at is not null
    group by product_id order by views desc, product_id limit 10""",
)
_oracle(
    "geo_distribution",
    "enriched",
    sql="""
    select city, count(*) as total_events, count(distinct user_id) as unique_users
    from enriched group by city""",
)
_oracle(
    "category_conversion",
    "enriched",
    sql=f"""
    select product_category, cast(sum(category_views) as bigint) as category_views,
      cast(sum(purchases) as bigint) as purchases,
      round(sum(purchases) / sum(category_views), 6) as conversion_rate
    from ({_CATEGORY_METRICS}) as daily group by product_category""",
)
_oracle(
    "top_sellers",
    "lines",
    sql="""
    select product_id, cast(sum(quantity) as bigint) as units_sold,
      round(sum(line_value), 2) as revenue
    from lines group by product_id order by units_sold desc, product_id limit 10""",
)
_oracle(
    "revenue_by_period",
    "lines",
    sql="""
    select event_date as period_start, count(distinct order_id) as orders,
      round(sum(line_value), 2) as revenue,
      round(sum(line_value), 2) / count(distinct order_id) as avg_order_value
    from lines group by event_date""",
)
_oracle(
    "customer_value",
    "lines",
    sql="""
    select user_id, round(sum(line_value), 2) as lifetime_value,
      count(distinct order_id) as orders,
      strftime(min(event_at), '%Y-%m-%d %H:%M:%S.%f') as first_purchase,
      strftime(max(event_at), '%Y-%m-%d %H:%M:%S.%f') as last_purchase
    from lines group by user_id""",
)

# -- window metrics: each event is put into every window that covers it ---------
_BOUNDS = """strftime(w, '%Y-%m-%d %H:%M') as window_start,
      strftime(w + interval {span}, '%Y-%m-%d %H:%M') as window_end"""


def _windowed(table: str, span: str, step: str, count: int, columns: str) -> str:
    """Rows of `table` times the `count` window starts that cover them."""
    return f"""
    select {columns}, time_bucket(interval {step}, event_at) - i * interval {step} as w
    from {table} cross join generate_series(0, {count - 1}) as g(i)"""


_oracle(
    "category_minute",
    "enriched",
    sql=f"""
    select {_BOUNDS.format(span="1 minute")}, product_category, count(*) as total_events,
      count(distinct user_id) as unique_users
    from (select *, date_trunc('minute', event_at) as w from enriched) as minutes
    group by w, product_category""",
)
_oracle(
    "event_rate_5m",
    "enriched",
    sql=f"""
    select {_BOUNDS.format(span="5 minutes")}, count(*) as total_events,
      round(count(*) / 300e0, 6) as events_per_second
    from ({_windowed("enriched", "5 minutes", "1 minute", 5, "event_id")}) as expanded group by w""",
)
_oracle(
    "conversion_1h",
    "enriched",
    sql=f"""
    select *, case when page_views = 0 then 'no views' when conversion_rate_pct >= 5 then 'green'
                   when conversion_rate_pct >= 2 then 'yellow' else 'red' end as status
    from (
      select {_BOUNDS.format(span="1 hour")},
        count(*) filter (event_type = 'purchase') as purchases,
        count(*) filter (event_type = 'page_view') as page_views,
        case when count(*) filter (event_type = 'page_view') = 0 then -1e0
             else round(count(*) filter (event_type = 'purchase') * 100e0
                        / count(*) filter (event_type = 'page_view'), 6) end as conversion_rate_pct
      from ({_windowed("enriched", "1 hour", "5 minutes", 12, "event_type")}) as expanded
      group by w) as rated""",
)
_oracle(
    "error_rate_5m",
    "flagged",
    sql=f"""
    select *, round(rejected_events / 300e0, 6) as errors_per_second
    from (
      select {_BOUNDS.format(span="5 minutes")},
        count(*) filter (not is_valid) as rejected_events
      from ({_windowed("timed", "5 minutes", "1 minute", 5, "is_valid")}
            where event_at is not null) as expanded group by w
      union all
      select null, null, count(*) filter (not is_valid) from timed where event_at is null
    ) as windows""".replace(
        "from timed", 'from (select *, try_cast("timestamp" as timestamp) as event_at from flagged) as timed'
    ),
)
_oracle(
    "active_users_1h",
    "enriched",
    sql=f"""
    select *, case when active_users >= 500 then 'green' when active_users >= 100 then 'yellow'
                   else 'red' end as status
    from (
      select {_BOUNDS.format(span="1 hour")}, count(distinct user_id) as active_users
      from (select *, date_trunc('hour', event_at) as w from enriched) as hours group by w
    ) as counted""",
)
_oracle(
    "revenue_1h",
    "lines",
    sql=f"""
    select *, case when revenue >= 5000 then 'green' when revenue >= 1000 then 'yellow'
                   else 'red' end as status
    from (
      select {_BOUNDS.format(span="1 hour")}, round(sum(line_value), 2) as revenue
      from (select *, date_trunc('hour', event_at) as w from lines) as hours group by w
    ) as summed""",
)

# -- features and rule-scored predictions -------------------------------------
_oracle("session_inputs", "inputs", sql="select * from inputs")
_FEATURES = feature_columns(TEST_CATEGORIES)
_oracle(
    "session_features",
    "features",
    sql="select session_id, user_id, event_date, device_desktop, "
    + ", ".join(
        f"round({c}, 6) as {c}" if c.startswith(("log_", "browse_")) else c for c in _FEATURES
    )
    + ", cast(converted_to_purchase as double) as label from features",
)
_oracle(
    "scored_sessions_rule",
    "scored",
    sql="""
    select session_id, user_id, event_date, probability_purchase, prediction_label from scored""",
)
_oracle(
    "confusion_matrix",
    "scored",
    sql="""
    select label, prediction_label, count(*) as "count" from scored
    group by label, prediction_label order by label, prediction_label""",
)
_oracle(
    "prediction_summary",
    "scored",
    sql="""
    select round(avg(p), 6) as avg_probability, round(stddev(p), 6) as stddev_probability,
      min(p) filter (place = cast(ceil(0.5e0 * total) as bigint)) as median_probability,
      min(p) filter (place = cast(ceil(0.95e0 * total) as bigint)) as p95_probability,
      count(*) as total_predictions, cast(sum(prediction_label) as bigint) as predicted_positives
    from (select probability_purchase as p, prediction_label,
            row_number() over (order by probability_purchase) as place,
            count(*) over () as total from scored) as ranked""",
)
_oracle(
    "prediction_drift",
    "scored",
    sql="""
    select metric, round(baseline, 6) as baseline, round(baseline * factor, 6) as "current",
      round(abs(baseline * factor - baseline), 6) as delta,
      cast(abs(baseline * factor - baseline) > 0.05e0 as integer) as drift_detected
    from (
      select 'avg_predicted_probability' as metric, avg(probability_purchase) as baseline,
        1.08e0 as factor from scored
      union all
      select 'predicted_positive_rate', sum(prediction_label) / count(*), 1.02e0 from scored
    ) as shifted""",
)
_oracle(
    "bucket_distribution",
    "scored",
    sql="""
    select probability_bucket, count(*) as session_count,
      cast(round(count(*) * 100.0 / sum(count(*)) over (), 1) as double) as pct
    from scored group by probability_bucket order by probability_bucket""",
)
_oracle(
    "funnel_by_device",
    "scored",
    sql="""
    select device_type, count(*) as sessions,
      cast(sum(prediction_label) as bigint) as predicted_conversions,
      round(sum(prediction_label) * 100e0 / count(*), 1) as conversion_rate_pct
    from scored group by device_type order by conversion_rate_pct desc, device_type""",
)
_oracle(
    "high_value_sessions",
    "scored",
    sql="""
    select session_id, user_id, round(probability_purchase * 100, 1) as purchase_probability_pct,
      page_views, add_to_cart_events, device_type
    from scored where probability_purchase > 0.80e0
    order by probability_purchase desc, session_id, user_id, event_date limit 20""",
)
_oracle(
    "model_by_hour",
    "scored",
    sql="""
    select event_hour, count(*) as sessions, cast(sum(prediction_label) as bigint) as predicted_purchases,
      cast(sum(converted_to_purchase) as bigint) as actual_purchases,
      round(avg(probability_purchase) * 100, 1) as avg_probability_pct
    from scored group by event_hour order by event_hour""",
)
_oracle(
    "prediction_export_rule",
    "scored",
    sql=f"""
    select session_id, user_id, event_date, event_hour, prediction_label, probability_purchase,
      cast(label as integer) as actual_converted, page_views, add_to_cart_events,
      unique_products_viewed, session_duration_seconds, device_type, categories_viewed,
      '{AS_OF} 00:00:00.000000' as prediction_timestamp,
      'purchase_propensity_model' as model_name, '1' as model_version, probability_bucket
    from scored""",
)

# Two fixed scores stand in for the two models.
_EVALUATED = """
    evaluated as (
      select m.model_type, case when cast('0x' || substr(md5(session_id), 1, 8) as bigint) % 100 < 80
          then 'train' else 'test' end as split, label, prediction_label,
        case m.model_type when 'logistic_regression' then probability_purchase
          else cast(add_to_cart_events as double) end as p
      from scored, (values ('logistic_regression'), ('gradient_boosted_trees')) as m(model_type)),
    ranks as (
      select *, rank() over (partition by model_type, split order by p)
          + (count(*) over (partition by model_type, split, p) - 1) / 2e0 as place
      from evaluated),
    areas as (
      select model_type, split, (sum(place) filter (label = 1)
          - count(*) filter (label = 1) * (count(*) filter (label = 1) + 1) / 2e0)
          / (count(*) filter (label = 1) * count(*) filter (label = 0)) as auc
      from ranks group by model_type, split),
    points as (
      select model_type, split, p, sum(tp) over w / sum(tp) over (partition by model_type, split) as recall,
        sum(tp) over w / sum(n) over w as precision
      from (select model_type, split, p, count(*) filter (label = 1) as tp, count(*) as n
            from evaluated group by model_type, split, p) as steps
      window w as (partition by model_type, split order by p desc)),
    curves as (
      select model_type, split,
        sum((recall - earlier) * (precision + coalesce(higher, precision)) / 2e0) as pr_auc
      from (select *, coalesce(lag(recall) over v, 0e0) as earlier, lag(precision) over v as higher
            from points window v as (partition by model_type, split order by p desc)) as pairs
      group by model_type, split),
    classes as (
      select e.model_type, c.label, count(*) filter (e.label = c.label) as actual,
        count(*) filter (e.prediction_label = c.label) as predicted,
        count(*) filter (e.label = c.label and e.prediction_label = c.label) as hit, count(*) as n
      from evaluated as e, (values (0e0), (1e0)) as c(label) where split = 'test'
      group by e.model_type, c.label)"""
_oracle(
    "model_metrics_rule",
    "scored",
    sql=f""", {_EVALUATED}
    select model_type, metric, round(value, 6) as value from (
      select model_type, split || '_auc' as metric, auc as value from areas
      union all select model_type, split || '_pr_auc', pr_auc from curves
      union all select model_type, 'test_accuracy', sum(hit) / max(n) from classes group by model_type
      union all select model_type, 'test_f1', sum(actual * 2e0 * hit / (actual + predicted)) / max(n)
        from classes where actual > 0 group by model_type) as found""",
)
_oracle(
    "champion_rule",
    "scored",
    sql=f""", {_EVALUATED}
    select model_type, round(auc, 6) as test_auc from areas where split = 'test'
    order by auc desc, model_type desc limit 1""",
)
_oracle(
    "split_stats",
    "features",
    sql="""
    select split, count(*) as "rows", cast(sum(converted_to_purchase) as bigint) as positives,
      round(sum(converted_to_purchase) / count(*), 6) as positive_rate
    from features group by split""",
)
_oracle(
    "scaled_features",
    "features",
    sql="select session_id, user_id, event_date, split, "
    + ", ".join(
        f"coalesce(round(({c} - mean_{c}) / nullif(std_{c}, 0), 4), 0) + 0e0 as {c}"
        for c in _FEATURES
    )
    + " from features cross join (select "
    + ", ".join(f"avg({c}) as mean_{c}, stddev({c}) as std_{c}" for c in _FEATURES)
    + " from features where split = 'train') as scale",
)


def _statement(needs: tuple[str, ...], sql: str) -> str:
    """The statement after a WITH clause of all sub-queries it depends on."""
    wanted: set[str] = set()

    def want(name: str) -> None:
        for inner in _PARTS[name][0]:
            want(inner)
        wanted.add(name)

    for name in needs:
        want(name)
    clauses = [f"{name} as ({_PARTS[name][1].strip()})" for name in _PARTS if name in wanted]
    return f"with {', '.join(clauses)} {sql.strip()}"  # a statement that starts with a comma adds its own


def oracle_sql() -> dict[str, str]:
    return {name: _statement(needs, sql) for name, (needs, sql) in _STATEMENTS.items()}
