"""SQL conformance over ``source``.

Jobs hand their SQL to Spark, so every SQL feature is available with no code of
our own. Each entry is one query over the decoded ``events`` messages, as
``(spark_sql, duckdb_sql)``; ``None`` for DuckDB means the same text runs there.
The DuckDB text reads a ``source`` CTE built from the same parquet table.

Results are kept exactly comparable across engines: sums of two-decimal values
are rounded to two decimals, averages are taken over integer cents, integer
result types are cast to match, windows and top-k are ordered to a unique key,
and lists are compared as sorted text. Windows partition by user *and* day, so
no single window partition grows with the length of the history.
"""

from __future__ import annotations

USER_DAY = "PARTITION BY user_id, substr(ts, 1, 10)"

CONFORMANCE: dict[str, tuple[str, str | None]] = {
    "sql_project": (
        "SELECT event_id, upper(event_type) AS et, value * 2 AS v2, user_id + 1 AS u1 FROM source",
        None,
    ),
    "sql_case_cast": (
        "SELECT event_id, CASE WHEN value > 50 THEN 'high' WHEN value > 10 THEN 'mid' ELSE 'low' END AS band, "
        "CAST(floor(value) AS INT) AS vi, CAST(user_id AS STRING) AS us, "
        "CAST(CAST(ts AS DATE) AS STRING) AS day FROM source",
        "SELECT event_id, CASE WHEN value > 50 THEN 'high' WHEN value > 10 THEN 'mid' ELSE 'low' END AS band, "
        "CAST(floor(value) AS INTEGER) AS vi, CAST(user_id AS VARCHAR) AS us, "
        "CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM source",
    ),
    "sql_filter": (
        "SELECT event_id, event_type, value FROM source "
        "WHERE (event_type IN ('click', 'purchase') AND value BETWEEN 5 AND 50) "
        "OR (event_type LIKE 'v%' AND user_id < 20) OR props IS NULL "
        "OR (ts LIKE '2024-01-3%' AND event_type <> 'error')",
        None,
    ),
    "sql_distinct": ("SELECT DISTINCT user_id, event_type FROM source", None),
    "sql_join_inner": (
        "SELECT a.event_id, a.user_id, b.n_events FROM source a "
        "JOIN (SELECT user_id, count(*) AS n_events FROM source GROUP BY user_id) b ON a.user_id = b.user_id",
        None,
    ),
    "sql_join_outer": (
        "SELECT coalesce(v.user_id, p.user_id) AS user_id, v.n_view, p.n_purchase, s.n_signup "
        "FROM (SELECT user_id, count(*) AS n_view FROM source WHERE event_type = 'view' GROUP BY user_id) v "
        "FULL OUTER JOIN (SELECT user_id, count(*) AS n_purchase FROM source "
        "WHERE event_type = 'purchase' AND value > 200 GROUP BY user_id) p ON v.user_id = p.user_id "
        "LEFT JOIN (SELECT user_id, count(*) AS n_signup FROM source WHERE event_type = 'signup' "
        "AND value > 300 GROUP BY user_id) s ON coalesce(v.user_id, p.user_id) = s.user_id",
        None,
    ),
    "sql_join_right": (
        # counted per type before the join: a right join cannot split a hot key of its left side
        "SELECT t.event_type, t.weight, coalesce(s.n, 0) AS n "
        "FROM (SELECT event_type, count(event_id) AS n FROM source GROUP BY event_type) s "
        "RIGHT JOIN (VALUES ('view', 1), ('refund', 3), ('signup', 5)) AS t(event_type, weight) "
        "ON s.event_type = t.event_type",
        None,
    ),
    "sql_join_semi_anti": (
        "SELECT s.event_id, s.user_id FROM source s "
        "WHERE s.user_id IN (SELECT user_id FROM source WHERE event_type = 'purchase' AND value > 150) "
        "AND NOT EXISTS (SELECT 1 FROM source e WHERE e.user_id = s.user_id "
        "AND e.event_type = 'error' AND e.value > 200)",
        None,
    ),
    "sql_join_range": (
        "SELECT s.event_id, b.band FROM source s "
        "JOIN (VALUES (0.0, 10.0, 'low'), (10.0, 100.0, 'mid'), (100.0, 1000.0, 'high')) AS b(lo, hi, band) "
        "ON s.value >= b.lo AND s.value < b.hi",
        None,
    ),
    "sql_join_values": (
        "SELECT s.event_id, t.weight FROM source s "
        "JOIN (VALUES ('view', 1), ('click', 2), ('purchase', 10), ('signup', 5)) AS t(event_type, weight) "
        "ON s.event_type = t.event_type",
        None,
    ),
    "sql_group_having": (
        "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total, min(value) AS mn, max(value) AS mx, "
        "avg(CAST(round(value * 100) AS BIGINT)) AS avg_cents FROM source GROUP BY user_id HAVING count(*) > 60",
        None,
    ),
    "sql_count_distinct": (
        "SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS n FROM source GROUP BY event_type",
        None,
    ),
    "sql_rollup": (
        "SELECT event_type, bucket, count(*) AS n, round(sum(value), 2) AS total, "
        "CAST(grouping(bucket) AS INT) AS g "
        "FROM (SELECT event_type, user_id % 3 AS bucket, value FROM source) t GROUP BY ROLLUP (event_type, bucket)",
        "SELECT event_type, bucket, count(*) AS n, round(sum(value), 2) AS total, "
        "CAST(grouping(bucket) AS INTEGER) AS g "
        "FROM (SELECT event_type, user_id % 3 AS bucket, value FROM source) t GROUP BY ROLLUP (event_type, bucket)",
    ),
    "sql_cube": (
        "SELECT event_type, bucket, count(*) AS n, CAST(grouping(event_type) AS INT) AS ge "
        "FROM (SELECT event_type, user_id % 3 AS bucket FROM source) t GROUP BY CUBE (event_type, bucket)",
        "SELECT event_type, bucket, count(*) AS n, CAST(grouping(event_type) AS INTEGER) AS ge "
        "FROM (SELECT event_type, user_id % 3 AS bucket FROM source) t GROUP BY CUBE (event_type, bucket)",
    ),
    "sql_grouping_sets": (
        "SELECT event_type, bucket, count(*) AS n, round(sum(value), 2) AS total "
        "FROM (SELECT event_type, user_id % 3 AS bucket, value FROM source) t "
        "GROUP BY GROUPING SETS ((event_type), (bucket), ())",
        None,
    ),
    # collected sets are over bounded domains (event types, their initials)
    "sql_collect": (
        "SELECT user_id, array_join(sort_array(collect_set(event_type)), ',') AS types, "
        "array_join(sort_array(collect_set(substr(event_type, 1, 1))), '') AS initials, "
        "size(collect_set(event_type)) AS n_types FROM source GROUP BY user_id",
        "SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types, "
        "array_to_string(list_sort(list(DISTINCT substr(event_type, 1, 1))), '') AS initials, "
        "CAST(count(DISTINCT event_type) AS INTEGER) AS n_types FROM source GROUP BY user_id",
    ),
    "sql_pivot": (
        "SELECT user_id, coalesce(n_view, 0) AS n_view, coalesce(n_click, 0) AS n_click, "
        "coalesce(n_purchase, 0) AS n_purchase FROM (SELECT user_id, event_type FROM source) "
        "PIVOT (count(*) FOR event_type IN ('view' AS n_view, 'click' AS n_click, 'purchase' AS n_purchase))",
        "SELECT user_id, count(*) FILTER (WHERE event_type = 'view') AS n_view, "
        "count(*) FILTER (WHERE event_type = 'click') AS n_click, "
        "count(*) FILTER (WHERE event_type = 'purchase') AS n_purchase FROM source GROUP BY user_id",
    ),
    "sql_window_rank": (
        f"SELECT event_id, user_id, row_number() OVER ({USER_DAY} ORDER BY value DESC, event_id) AS rn, "
        f"rank() OVER ({USER_DAY} ORDER BY event_type) AS rk, "
        f"dense_rank() OVER ({USER_DAY} ORDER BY event_type) AS drk, "
        f"ntile(3) OVER ({USER_DAY} ORDER BY event_id) AS tile FROM source",
        f"SELECT event_id, user_id, CAST(row_number() OVER ({USER_DAY} ORDER BY value DESC, event_id) AS INTEGER) AS rn, "
        f"CAST(rank() OVER ({USER_DAY} ORDER BY event_type) AS INTEGER) AS rk, "
        f"CAST(dense_rank() OVER ({USER_DAY} ORDER BY event_type) AS INTEGER) AS drk, "
        f"CAST(ntile(3) OVER ({USER_DAY} ORDER BY event_id) AS INTEGER) AS tile FROM source",
    ),
    "sql_window_analytic": (
        "SELECT event_id, lag(event_type) OVER w AS prev_type, lead(value, 1, 0.0) OVER w AS next_value, "
        "first_value(event_type) OVER w AS first_type FROM source "
        f"WINDOW w AS ({USER_DAY} ORDER BY ts, event_id)",
        None,
    ),
    "sql_window_frame": (
        "SELECT event_id, round(sum(value) OVER "
        f"({USER_DAY} ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS rolling3, "
        f"count(*) OVER ({USER_DAY} ORDER BY value RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS near5 "
        "FROM source",
        None,
    ),
    "sql_topk": ("SELECT event_id, user_id, value FROM source ORDER BY value DESC, event_id LIMIT 20", None),
    "sql_union": (
        "SELECT user_id, 'view' AS kind FROM source WHERE event_type = 'view' AND value > 300 "
        "UNION SELECT user_id, 'click' AS kind FROM source WHERE event_type = 'click' AND value > 300 "
        "UNION ALL SELECT user_id, 'signup' AS kind FROM source WHERE event_type = 'signup' AND value > 200",
        None,
    ),
    "sql_intersect": (
        "SELECT user_id FROM source WHERE event_type = 'view' AND value > 120 "
        "INTERSECT SELECT user_id FROM source WHERE event_type = 'purchase' AND value > 120",
        None,
    ),
    "sql_except": (
        "SELECT user_id FROM source WHERE event_type = 'view' "
        "EXCEPT SELECT user_id FROM source WHERE event_type = 'error' AND value > 300",
        None,
    ),
    "sql_subquery": (
        "SELECT s.event_id, s.value FROM source s WHERE s.value > (SELECT avg(value) * 3 FROM source) "
        "AND s.user_id IN (SELECT user_id FROM source WHERE event_type = 'signup' AND value > 100) "
        "AND EXISTS (SELECT 1 FROM source e WHERE e.user_id = s.user_id AND e.event_type = 'purchase' "
        "AND e.value > 150)",
        None,
    ),
    "sql_cte": (
        "WITH per_user AS (SELECT user_id, count(*) AS n FROM source GROUP BY user_id), "
        "top AS (SELECT max(n) AS mx FROM per_user) "
        "SELECT user_id, n FROM per_user WHERE n >= (SELECT mx FROM top) - 10",
        None,
    ),
    "sql_fn_string": (
        "SELECT event_id, concat(event_type, '-', CAST(user_id AS STRING)) AS c, upper(event_type) AS u, "
        "lower(upper(event_type)) AS l, substr(event_type, 2, 3) AS s, trim(concat('  ', event_type, ' ')) AS t, "
        "regexp_replace(event_type, '[aeiou]', '*') AS r, split(ts, ' ')[1] AS tm, length(event_type) AS len, "
        "lpad(CAST(user_id AS STRING), 5, '0') AS pad, instr(event_type, 'i') AS pos, "
        "replace(props, ' ', '') AS compact FROM source",
        "SELECT event_id, concat(event_type, '-', CAST(user_id AS VARCHAR)) AS c, upper(event_type) AS u, "
        "lower(upper(event_type)) AS l, substr(event_type, 2, 3) AS s, trim(concat('  ', event_type, ' ')) AS t, "
        "regexp_replace(event_type, '[aeiou]', '*', 'g') AS r, string_split(ts, ' ')[2] AS tm, "
        "CAST(length(event_type) AS INTEGER) AS len, lpad(CAST(user_id AS VARCHAR), 5, '0') AS pad, "
        "CAST(instr(event_type, 'i') AS INTEGER) AS pos, replace(props, ' ', '') AS compact FROM source",
    ),
    "sql_fn_date": (
        "SELECT event_id, date_format(date_trunc('HOUR', to_timestamp(ts)), 'yyyy-MM-dd HH:mm:ss') AS hr, "
        "datediff(to_date(ts), DATE'2024-01-01') AS days, hour(to_timestamp(ts)) AS h, "
        "dayofweek(to_date(ts)) AS dow, date_format(date_add(to_date(ts), 7), 'yyyy-MM-dd') AS next_week, "
        "month(to_date(ts)) AS m FROM source",
        "SELECT event_id, strftime(date_trunc('hour', CAST(ts AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S') AS hr, "
        "CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS days, "
        "CAST(hour(CAST(ts AS TIMESTAMP)) AS INTEGER) AS h, "
        "CAST(dayofweek(CAST(ts AS DATE)) + 1 AS INTEGER) AS dow, "
        "strftime(CAST(ts AS DATE) + INTERVAL 7 DAY, '%Y-%m-%d') AS next_week, "
        "CAST(month(CAST(ts AS DATE)) AS INTEGER) AS m FROM source",
    ),
    "sql_fn_math": (
        "SELECT event_id, round(value) AS r0, abs(value - 100) AS a, CAST(floor(value) AS BIGINT) AS fl, "
        "CAST(ceil(value) AS BIGINT) AS ce, pmod(user_id - 75, 7) AS pm, power(user_id, 2) AS p2, "
        "sqrt(value) AS sq, CAST(sign(value - 100) AS DOUBLE) AS sg FROM source",
        "SELECT event_id, round(value) AS r0, abs(value - 100) AS a, CAST(floor(value) AS BIGINT) AS fl, "
        "CAST(ceil(value) AS BIGINT) AS ce, ((user_id - 75) % 7 + 7) % 7 AS pm, pow(user_id, 2) AS p2, "
        "sqrt(value) AS sq, CAST(sign(value - 100) AS DOUBLE) AS sg FROM source",
    ),
    "sql_fn_array": (
        "SELECT event_id, size(tags) AS n, array_contains(tags, 'v') AS has_v, "
        "array_join(sort_array(tags), ',') AS sorted, element_at(tags, 2) AS second, "
        "array_join(slice(tags, 1, 2), ',') AS first2 FROM source",
        "SELECT event_id, CAST(len(tags) AS INTEGER) AS n, list_contains(tags, 'v') AS has_v, "
        "array_to_string(list_sort(tags), ',') AS sorted, tags[2] AS second, "
        "array_to_string(tags[1:2], ',') AS first2 FROM source",
    ),
    "sql_explode": (
        "SELECT event_id, t FROM source LATERAL VIEW explode(tags) x AS t",
        "SELECT event_id, unnest(tags) AS t FROM source",
    ),
    "sql_fn_json": (
        "SELECT event_id, get_json_object(props, '$.k') AS k_text, from_json(props, 'k INT').k AS k, "
        "to_json(named_struct('t', event_type, 'u', user_id)) AS j FROM source",
        "SELECT event_id, props->>'$.k' AS k_text, CAST(props->>'$.k' AS INTEGER) AS k, "
        "json_object('t', event_type, 'u', user_id)::VARCHAR AS j FROM source",
    ),
    "sql_fn_map": (
        "SELECT event_id, map('type', event_type, 'user', CAST(user_id AS STRING))['type'] AS t, "
        "array_join(sort_array(map_keys(map('type', event_type, 'user', CAST(user_id AS STRING)))), ',') AS ks, "
        "map('view', 1, 'click', 2)[event_type] AS code FROM source",
        "SELECT event_id, map(['type', 'user'], [event_type, CAST(user_id AS VARCHAR)])['type'] AS t, "
        "array_to_string(list_sort(map_keys(map(['type', 'user'], [event_type, CAST(user_id AS VARCHAR)]))), ',') AS ks, "
        "map(['view', 'click'], [1, 2])[event_type] AS code FROM source",
    ),
    "sql_fn_null": (
        "SELECT event_id, coalesce(nullif(event_type, 'error'), 'none') AS t, "
        "if(value > 50, 'big', 'small') AS sz, nvl(CASE WHEN value > 400 THEN event_type END, '-') AS hi, "
        "nullif(user_id % 10, 0) AS nz, isnull(nullif(event_type, 'view')) AS is_view FROM source",
        "SELECT event_id, coalesce(nullif(event_type, 'error'), 'none') AS t, "
        "if(value > 50, 'big', 'small') AS sz, coalesce(CASE WHEN value > 400 THEN event_type END, '-') AS hi, "
        "nullif(user_id % 10, 0) AS nz, nullif(event_type, 'view') IS NULL AS is_view FROM source",
    ),
    "sql_approx_distinct": (
        # approximate by design: checked as lying within three standard errors of the exact count
        "SELECT event_type, abs(approx_count_distinct(user_id) - count(DISTINCT user_id)) "
        "<= 3 * 0.05 * count(DISTINCT user_id) + 1 AS within_bound FROM source GROUP BY event_type",
        "SELECT event_type, true AS within_bound FROM source GROUP BY event_type",
    ),
}
