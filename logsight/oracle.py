"""The catalog's queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations



def _q(col: str, p: float) -> str:
    """Quantile by linear interpolation between the two neighbours, spelled out."""
    at = f"(CAST({p} AS DOUBLE) * (count({col}) - 1))"
    values = f"list_sort(list(CAST({col} AS DOUBLE)) FILTER (WHERE ({col}) IS NOT NULL))"
    lo, hi = f"({values})[CAST(floor({at}) AS BIGINT) + 1]", f"({values})[CAST(ceil({at}) AS BIGINT) + 1]"
    return f"({lo} + ({hi} - {lo}) * ({at} - floor({at})))"


LOG = """
base AS (
  SELECT event_id, user_id, event_type, ts,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(ROUND(value * 100) AS BIGINT) AS v
  FROM events
),
query_log AS (
  SELECT user_id % 10 AS instance_id, user_id, event_id % 7 AS database_id, event_id AS query_id,
    CASE WHEN event_type IN ('view', 'error') THEN 'select' WHEN event_type = 'click' THEN 'insert'
         WHEN event_type = 'signup' THEN 'update'
         WHEN event_type = 'purchase' THEN CASE WHEN k < 30 THEN 'COPY' WHEN k < 40 THEN 'unload' ELSE 'analyze' END
    END AS query_type,
    ts AS arrival_timestamp,
    CASE WHEN event_id % 5 <> 0 THEN 2 + 2 * (user_id % 10) END AS cluster_size,
    CASE WHEN event_id % 11 <> 0 THEN 'fp' || CAST((user_id * 31 + k) % 97 AS VARCHAR) END AS feature_fingerprint,
    CASE WHEN k % 4 = 1 THEN '' WHEN k % 4 = 2 THEN '12' WHEN k % 4 = 3 THEN '12,34,56' END AS read_table_ids,
    CASE WHEN event_type = 'click' THEN '7' END AS write_table_ids,
    k % 3 AS num_permanent_tables_accessed, event_id % 2 AS num_external_tables_accessed,
    CAST(0 AS BIGINT) AS num_system_tables_accessed,
    k % 5 AS num_joins, event_id % 4 AS num_scans, (k // 5) % 4 AS num_aggregations,
    CASE WHEN k % 8 <> 0 THEN k * 7 END AS compile_duration_ms,
    CASE WHEN k % 10 = 0 THEN v * 40 WHEN k % 10 < 4 THEN v ELSE v // 20 END AS execution_duration_ms,
    CASE event_id % 9 WHEN 0 THEN 0 WHEN 1 THEN v * 20 WHEN 2 THEN v * 2 ELSE v % 700 END AS queue_duration_ms,
    CASE event_id % 6 WHEN 1 THEN 0 WHEN 2 THEN v // 50 WHEN 3 THEN v * 20 WHEN 4 THEN v * 900 WHEN 5 THEN v END AS mbytes_scanned,
    CASE WHEN event_id % 13 = 0 THEN v ELSE 0 END AS mbytes_spilled,
    event_id % 23 = 0 AS was_aborted, event_id % 17 = 0 AS was_cached
  FROM base
)"""

MEASURED = (
    LOG
    + """,
measured AS (
  SELECT *, lower(query_type) IN ('copy', 'unload') AS transfer,
    coalesce(mbytes_scanned, 0) AS scanned,
    num_scans + num_joins + num_aggregations AS complexity,
    CASE WHEN coalesce(mbytes_scanned, 0) > 0
         THEN CAST(execution_duration_ms AS DOUBLE) / (mbytes_scanned + 1) ELSE 0.0 END AS r
  FROM query_log
)"""
)


def _class_case(f: float = 1.0) -> str:
    return f"""CASE
      WHEN was_cached THEN 'normal_queries'
      WHEN transfer AND execution_duration_ms > {500 * f} THEN 'network_bound_queries'
      WHEN NOT transfer AND (num_joins > 1 OR num_aggregations > 1) AND scanned > 0
           AND r > CAST({20.0 * f} AS DOUBLE) AND execution_duration_ms > {1000 * f} THEN 'cpu_bound_queries'
      WHEN NOT transfer AND scanned >= {2000 * f} AND r < CAST({0.061 * f!r} AS DOUBLE)
           AND (mbytes_spilled > 0 OR num_scans > 1) AND execution_duration_ms > {1000 * f} THEN 'io_bound_queries'
      WHEN queue_duration_ms >= execution_duration_ms AND queue_duration_ms > {1000 * f}
           AND execution_duration_ms > 0 AND complexity < 4 THEN 'queue_wlm_bound_queries'
      ELSE 'normal_queries' END"""


CLASSIFIED = MEASURED + f""",
classified AS (SELECT *, {_class_case()} AS query_class FROM measured)"""


def _stats(width: str) -> str:
    return (
        CLASSIFIED
        + f""",
counted AS (
  SELECT time_bucket(INTERVAL '{width}', arrival_timestamp, TIMESTAMP '1970-01-01') AS window_start, instance_id,
    arg_max(cluster_size, (arrival_timestamp, query_id)) FILTER (WHERE cluster_size IS NOT NULL) AS own_size,
    count(*) AS total_queries,
    count(*) FILTER (WHERE query_class = 'normal_queries') AS normal_queries,
    count(*) FILTER (WHERE query_class = 'cpu_bound_queries') AS cpu_bound_queries,
    count(*) FILTER (WHERE query_class = 'io_bound_queries') AS io_bound_queries,
    count(*) FILTER (WHERE query_class = 'network_bound_queries') AS network_bound_queries,
    count(*) FILTER (WHERE query_class = 'queue_wlm_bound_queries') AS queue_wlm_bound_queries,
    CAST(sum(mbytes_spilled) AS DOUBLE) AS total_spilled_mb,
    CAST(sum(queue_duration_ms) AS DOUBLE) AS total_queue_time_ms,
    CAST(sum(execution_duration_ms) AS DOUBLE) AS total_exec_time_ms
  FROM classified GROUP BY 1, 2
),
stats AS (
  SELECT window_start, instance_id,
    coalesce(last_value(own_size IGNORE NULLS) OVER (PARTITION BY instance_id ORDER BY window_start
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS cluster_size,
    * EXCLUDE (window_start, instance_id, own_size)
  FROM counted
)"""
    )


PREDICTED = (
    LOG
    + """,
predicted AS (
  SELECT *, greatest(CAST(CASE query_id % 4 WHEN 0 THEN execution_duration_ms // 12
    WHEN 1 THEN execution_duration_ms - 130000 WHEN 2 THEN execution_duration_ms ELSE 70000 END AS DOUBLE), 1.0) AS pred_execution_ms
  FROM query_log WHERE NOT was_aborted
),
ranked AS (
  SELECT *,
    CAST(rank() OVER (PARTITION BY instance_id ORDER BY execution_duration_ms) AS DOUBLE)
      + (count(*) OVER (PARTITION BY instance_id, execution_duration_ms) - 1) / 2.0 AS true_up,
    CAST(rank() OVER (PARTITION BY instance_id ORDER BY pred_execution_ms) AS DOUBLE)
      + (count(*) OVER (PARTITION BY instance_id, pred_execution_ms) - 1) / 2.0 AS pred_up,
    count(*) OVER (PARTITION BY instance_id) AS n
  FROM predicted
),
quantiled AS (
  SELECT *, CAST(true_up AS DOUBLE) / n AS true_quantile, CAST(pred_up AS DOUBLE) / n AS pred_quantile,
    CAST(n + 1 - true_up AS DOUBLE) AS true_rank_desc, CAST(n + 1 - pred_up AS DOUBLE) AS pred_rank_desc,
    CAST(execution_duration_ms AS DOUBLE) AS true_ms, pred_execution_ms AS pred_ms_used
  FROM ranked
),
errors AS (
  SELECT *, pred_rank_desc - true_rank_desc AS rank_gap_desc, abs(true_ms - pred_ms_used) AS abs_err_ms,
    pred_ms_used - true_ms AS signed_err_ms, true_ms / greatest(pred_ms_used, 1.0) AS under_ratio
  FROM quantiled
)"""
)

PREDICTED_DAILY = PREDICTED.replace("PARTITION BY instance_id", "PARTITION BY CAST(arrival_timestamp AS DATE), instance_id")


def _flagged(ratio: float = 10.0, delta: float = 120_000.0) -> str:
    by_ratio, by_delta = f"under_ratio >= {ratio}", f"true_ms - pred_ms_used >= {delta}"
    by_rank = "true_quantile >= CAST(0.99 AS DOUBLE) AND pred_quantile <= CAST(0.90 AS DOUBLE)"
    return (
        PREDICTED
        + f""",
flagged AS (
  SELECT *, true_ms >= 60000 AND ({by_ratio} OR {by_delta} OR ({by_rank})) AS is_anomaly,
    CASE WHEN true_ms < 60000 THEN '' WHEN {by_ratio} THEN 'underestimated_ratio'
         WHEN {by_delta} THEN 'underestimated_delta' WHEN {by_rank} THEN 'misrank_quantiles' ELSE '' END AS anomaly_reason
  FROM errors
)"""
    )


FLAGGED = _flagged()

HITS = (
    FLAGGED
    + """,
hits AS (
  SELECT time_bucket(INTERVAL '10 minutes', arrival_timestamp, TIMESTAMP '1970-01-01') AS window_start,
    instance_id, user_id, database_id, query_id, true_ms, pred_ms_used AS pred_ms,
    CAST(0 AS DOUBLE) AS pred_mean_ms, CAST(0 AS DOUBLE) AS pred_q_ms, abs_err_ms, signed_err_ms, under_ratio,
    anomaly_reason, query_type, arrival_timestamp, cluster_size
  FROM flagged WHERE is_anomaly
)"""
)

MINUTE = _stats("10 minutes")
IDS = "(1, 2, 3, 5, 8)"
FLAG_COLUMNS = "query_id, true_ms, pred_ms_used, abs_err_ms, signed_err_ms, under_ratio, is_anomaly, anomaly_reason"


def _bounds(days: int) -> str:
    return f""",
bounds AS (SELECT max(window_start) AS latest, max(window_start) - INTERVAL {days} DAY AS cur,
  max(window_start) - INTERVAL {2 * days} DAY AS prev FROM stats)"""


def _report(days: int, with_hits: bool = False) -> str:
    head = MINUTE
    if with_hits:
        # the statistics and the hits share the query log
        head = MINUTE + HITS[len(LOG):]
    return head + _bounds(days) + ", cur AS (SELECT s.* FROM stats s, bounds b WHERE s.window_start >= b.cur)"


PROBLEMS = ("cpu_bound", "io_bound", "queue_wlm_bound", "network_bound")
CLASSES = ("normal", "cpu_bound", "io_bound", "network_bound", "queue_wlm_bound")


def _critical(p: str) -> str:
    s = f"sum({p}_queries)"
    return f"({s} > 50 OR CAST({s} AS DOUBLE) / nullif(CAST(sum(total_queries) AS DOUBLE), 0) > CAST(0.05 AS DOUBLE))"


def _problem_union() -> str:
    parts = [
        f"SELECT '{p}' AS problem FROM cur WHERE instance_id IN {IDS} GROUP BY instance_id HAVING {_critical(p)}"
        for p in PROBLEMS
    ]
    return "SELECT DISTINCT problem FROM (" + " UNION ALL ".join(parts) + ")"


def _metrics(cond: str, suffix: str) -> str:
    def s(c: str) -> str:
        return f"CAST(sum({c}) FILTER (WHERE {cond}) AS DOUBLE)"

    queue, execution = s("total_queue_time_ms"), s("total_exec_time_ms")
    return f"""CAST(min(cluster_size) FILTER (WHERE {cond}) AS DOUBLE) AS cluster_size{suffix},
      {s('normal_queries')} / nullif({s('total_queries')}, 0) AS score{suffix},
      {s('total_spilled_mb')} AS spilled_mb{suffix}, {queue} AS queue_time{suffix},
      {queue} / nullif({queue} + {execution}, 0) AS queue_ratio{suffix}"""


def _fleet() -> str:
    names = ("cluster_size", "score", "spilled_mb", "queue_time", "queue_ratio", "anomalies_count")
    out = ", ".join(
        f"coalesce({m}, 0) AS {m}, coalesce({m}, 0) - coalesce({m}_prev, 0) AS {m}_delta" for m in names
    )
    return f"""WITH {_report(7, True)},
m AS (SELECT {_metrics('s.window_start >= b.cur', '')}, {_metrics('s.window_start >= b.prev AND s.window_start < b.cur', '_prev')}
  FROM stats s, bounds b WHERE instance_id IN {IDS}),
a AS (SELECT CAST(count(*) FILTER (WHERE arrival_timestamp >= b.cur) AS DOUBLE) AS anomalies_count,
  CAST(count(*) FILTER (WHERE arrival_timestamp >= b.prev AND arrival_timestamp < b.cur) AS DOUBLE) AS anomalies_count_prev
  FROM hits h, bounds b WHERE instance_id IN {IDS})
SELECT {out} FROM m, a"""


CHART = ", ".join(f"CAST(sum({c}_queries) AS BIGINT) AS {c}_queries" for c in CLASSES)
TOTALS = (
    f"WITH {_report(7, True)}, t AS (SELECT CAST(sum(total_queries) AS BIGINT) AS total_queries, {CHART} "
    f"FROM cur WHERE instance_id IN {IDS}), a AS (SELECT count(*) AS anomalies_count FROM hits h, bounds b "
    f"WHERE arrival_timestamp >= b.cur AND instance_id IN {IDS}), totals AS (SELECT total_queries, "
    + ", ".join(
        f"{c}_queries, CAST({c}_queries AS DOUBLE) / nullif(total_queries, 0) AS {c}_queries_pct" for c in CLASSES
    )
    + ", anomalies_count, CASE WHEN total_queries > 0 THEN CAST(anomalies_count AS DOUBLE) / total_queries "
    "WHEN anomalies_count = 0 THEN 0 END AS anomalies_pct FROM t, a) "
)


def _summary(key: str, *per: str) -> str:
    keys = ", ".join([key, *per])
    groups = ", ".join(str(i + 1) for i in range(1 + len(per)))
    return f"""WITH {FLAGGED} SELECT {keys}, count(*) AS anoms, sum(true_ms) AS true_sum_ms, sum(abs_err_ms) AS abs_err_sum_ms,
  {_q("true_ms", 0.5)} AS median_true_ms, {_q("under_ratio", 0.5)} AS median_under_ratio
  FROM flagged WHERE is_anomaly GROUP BY {groups}"""


def _bucket(col: str, edges: tuple) -> str:
    whens = " ".join(f"WHEN {col} >= {e} THEN {float(e)}" for e in reversed(edges[1:]))
    return f"CAST(CASE {whens} ELSE {float(edges[0])} END AS DOUBLE)"


RATIO_BUCKET = _bucket("r", (0.0, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0, 500.0))
SCAN_BUCKET = _bucket("scanned", (0, 200, 500, 1000, 2000, 5000, 10000, 50000, 100000))
TRANSFER_BUCKET = _bucket("execution_duration_ms", (0, 50, 200, 500, 1000, 5000))
QUEUE_BUCKET = _bucket("queue_duration_ms", (0, 500, 1000, 2000, 5000, 10000))


def _pct(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond}) * CAST(100 AS DOUBLE) / count(*)"


def _avg(col: str) -> str:
    return f"CAST(sum({col}) AS DOUBLE) / count(*)"


RATIO_PROFILE = (
    CLASSIFIED
    + f""",
ratio_buckets AS (SELECT {RATIO_BUCKET} AS bucket, count(*) AS n, sum(execution_duration_ms) AS exec_sum,
  {_pct('mbytes_spilled > 0')} AS spill_pct, {_pct('queue_duration_ms >= execution_duration_ms')} AS queue_dominant_pct
  FROM classified WHERE NOT was_cached AND NOT transfer AND scanned > 0 AND num_joins + num_aggregations > 1 GROUP BY 1),
ratio_profile AS (SELECT bucket, n, spill_pct, queue_dominant_pct, CAST(exec_sum AS DOUBLE) / n AS avg_exec_ms,
  (CAST(exec_sum AS DOUBLE) / n) / (SELECT CAST(sum(exec_sum) AS DOUBLE) / CAST(sum(n) AS DOUBLE) FROM ratio_buckets) AS vs_overall
  FROM ratio_buckets),
transfer_profile AS (SELECT lower(query_type) AS query_type, {TRANSFER_BUCKET} AS bucket, count(*) AS n,
  {_avg('scanned')} AS avg_scan_mb, {_q('scanned', 0.5)} AS scan_p50_mb
  FROM classified WHERE NOT was_cached AND transfer GROUP BY 1, 2)"""
)

PURE = """CASE query_class
  WHEN 'cpu_bound_queries' THEN mbytes_spilled <= 0 AND queue_duration_ms < execution_duration_ms AND complexity > 1
  WHEN 'io_bound_queries' THEN scanned >= 2000 AND (mbytes_spilled > 0 OR num_scans > 1)
  WHEN 'network_bound_queries' THEN transfer AND execution_duration_ms > 500
  ELSE queue_duration_ms >= execution_duration_ms AND queue_duration_ms > 1000 END"""

CPU_RULE = """NOT was_cached AND NOT transfer AND (num_joins > 1 OR num_aggregations > 1) AND scanned > 0
  AND r > 20 AND execution_duration_ms > 1000"""
IO_RULE = """NOT was_cached AND NOT transfer AND scanned >= 2000 AND r < CAST(0.061 AS DOUBLE)
  AND (mbytes_spilled > 0 OR num_scans > 1) AND execution_duration_ms > 1000"""
QUEUE_RULE = """NOT was_cached AND queue_duration_ms >= execution_duration_ms AND queue_duration_ms > 1000
  AND execution_duration_ms > 0 AND complexity < 4"""
NET_RULE = "NOT was_cached AND transfer AND execution_duration_ms > 500"


def _overlap() -> str:
    pairs = (("cpu_io", CPU_RULE, IO_RULE), ("cpu_queue", CPU_RULE, QUEUE_RULE), ("io_queue", IO_RULE, QUEUE_RULE), ("network_queue", NET_RULE, QUEUE_RULE))
    return " UNION ALL ".join(
        f"SELECT '{n}' AS pair, count(*) FILTER (WHERE ({a}) AND ({b})) AS n FROM measured" for n, a, b in pairs
    )


def _variants() -> str:
    base = "NOT was_cached AND NOT transfer AND (num_joins > 1 OR num_aggregations > 1) AND scanned > 0 AND r > 20"
    span, slow = "scanned BETWEEN 5 AND 434", "execution_duration_ms > 1000"
    rules = {"A": f"{base} AND {span}", "B": base, "C": f"{base} AND {slow}", "D": f"{base} AND {span} AND {slow}"}
    pure = "mbytes_spilled <= 0 AND queue_duration_ms < execution_duration_ms AND complexity > 1"
    return " UNION ALL ".join(
        f"""SELECT '{v}' AS variant, count(*) AS n, {_pct(pure)} AS purity_pct, {_avg('execution_duration_ms')} AS avg_exec_ms,
        {_avg('complexity')} AS avg_complexity, {_pct('mbytes_spilled > 0')} AS spill_pct,
        count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM measured) AS pct FROM measured WHERE {cond} HAVING count(*) > 0"""
        for v, cond in rules.items()
    )


def _sensitivity() -> str:
    parts = [
        f"SELECT '{name}' AS variant, {_class_case(f)} AS query_class FROM measured"
        for name, f in (("minus20", 0.8), ("base", 1.0), ("plus20", 1.2))
    ]
    return f"""SELECT variant, query_class, count(*) AS n,
      count(*) * CAST(100 AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY variant) AS DOUBLE) AS pct
      FROM ({' UNION ALL '.join(parts)}) GROUP BY variant, query_class"""


DAYS = LOG + ", days AS (SELECT DISTINCT CAST(arrival_timestamp AS DATE) AS day FROM query_log)"
ISO = "strftime(arrival_timestamp, '%Y-%m-%dT%H:%M:%S.%f')"
LANDED = """SELECT CAST(arrival_timestamp AS DATE) AS day, count(*) AS rows, CAST(sum(execution_duration_ms) AS BIGINT) AS exec_ms
  FROM query_log WHERE NOT was_cached AND NOT was_aborted GROUP BY 1"""


def _csv_count(col: str) -> str:
    return f"""CASE WHEN trim(coalesce({col}, '')) IN ('', 'nan', 'None') THEN 0
      ELSE length({col}) - length(replace({col}, ',', '')) + 1 END"""


FEATURES = ("num_permanent_tables_accessed", "num_external_tables_accessed", "num_system_tables_accessed", "num_joins", "num_scans", "num_aggregations", "compile_duration_ms", "read_table_count", "write_table_count", "has_write", "arrival_hour", "arrival_dow", "cluster_size", "fp_freq", "fp_is_rare")


def _bucketed(freq: str) -> str:
    return f"CASE WHEN {freq} = 0 THEN 'unseen' WHEN {freq} < 3 THEN 'rare' WHEN {freq} < 50 THEN 'moderate' ELSE 'common' END"


def _prepared() -> str:
    numbers = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)
    missing = ", ".join(f"CAST({c} IS NULL AS DOUBLE) AS {c}__is_missing" for c in FEATURES)
    return f"""WITH {LOG},
fp AS (SELECT coalesce(feature_fingerprint, 'NA') AS f, count(*) AS fp_freq FROM query_log GROUP BY 1),
raw AS (SELECT l.* EXCLUDE (execution_duration_ms), CAST(execution_duration_ms AS DOUBLE) AS execution_duration_ms, fp_freq,
  CAST(fp_freq < 3 AS BIGINT) AS fp_is_rare, {_bucketed('fp_freq')} AS fp_bucket,
  {_csv_count('read_table_ids')} AS read_table_count, {_csv_count('write_table_ids')} AS write_table_count,
  CASE WHEN {_csv_count('write_table_ids')} > 0 THEN 1 ELSE 0 END AS has_write,
  hour(arrival_timestamp) AS arrival_hour, isodow(arrival_timestamp) - 1 AS arrival_dow
  FROM query_log l JOIN fp ON fp.f = coalesce(feature_fingerprint, 'NA') WHERE NOT was_aborted)
SELECT query_id, query_type, fp_bucket, {numbers}, {missing},
  CAST(coalesce(compile_duration_ms = 0, false) AS DOUBLE) AS compile_duration_ms__is_zero, execution_duration_ms FROM raw"""


def _draw(seed: int) -> str:
    return f"md5('{seed}:' || CAST(query_id AS VARCHAR))"


def _stream_windows() -> str:
    return f"WITH {_stats('1 hour')} SELECT s.* FROM stats s WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(arrival_timestamp) FROM query_log)"


SQL: dict[str, str] = {
    "log_scan": "SELECT * FROM events",
    "first_messages": f"WITH {LOG} SELECT arrival_timestamp, query_id FROM query_log ORDER BY 1, 2 LIMIT 1000",
    "query_log_view": f"WITH {LOG} SELECT * FROM query_log",
    "day_scan": "SELECT event_id, ts, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'",
    "present_columns": f"WITH {LOG} SELECT query_id, query_type, user_id FROM query_log",
    "log_days": f"WITH {DAYS} SELECT day FROM days",
    "days_in_bounds": f"WITH {DAYS} SELECT day FROM days WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
    "training_windows": f"""WITH {DAYS}, o AS (SELECT day, row_number() OVER (ORDER BY day) AS i FROM days)
      SELECT e.day AS eval_day, t.day AS train_day FROM o e JOIN o t ON t.i >= e.i - 7 AND t.i < e.i""",
    "latest_days": f"WITH {DAYS} SELECT day FROM days ORDER BY day DESC LIMIT 14",
    "daily_file_scan": f"WITH {LOG} SELECT CAST(arrival_timestamp AS DATE) AS day, count(*) AS rows FROM query_log GROUP BY 1",
    "training_union": f"""WITH {LOG} SELECT query_id, query_type,
      CASE WHEN arrival_timestamp >= TIMESTAMP '2024-01-16' THEN num_joins END AS num_joins FROM query_log""",
    "accepted_messages": f"WITH {LOG} SELECT * FROM query_log WHERE query_id % 50 NOT IN (0, 1, 2)",
    "rejected_messages": f"""WITH {LOG} SELECT CASE WHEN query_id % 50 = 0 THEN 'malformed_json' ELSE 'bad_timestamp' END AS reject_reason,
      count(*) AS messages FROM query_log WHERE query_id % 50 IN (0, 1, 2) GROUP BY 1""",
    "anomaly_messages": f"""WITH {HITS} SELECT CAST(instance_id AS VARCHAR) AS key, query_id, anomaly_reason,
      {ISO} || 'Z' AS sent_at FROM hits""",
    "typed_events": f"""WITH {LOG} SELECT query_id, CASE WHEN query_id % 7 > 1 THEN num_joins END AS num_joins,
      CASE WHEN query_id % 5 <> 0 THEN arrival_timestamp END AS arrival_timestamp,
      query_id % 6 IN (0, 2, 4, 5) AS was_cached, CASE WHEN query_id % 4 <> 0 THEN query_id % 2 = 1 END AS was_aborted,
      CAST(CASE query_id % 3 WHEN 1 THEN 12.5 WHEN 2 THEN 12 END AS DOUBLE) AS mbytes_scanned,
      CASE WHEN query_id % 2 = 0 THEN '1,2,' || CAST(query_id AS VARCHAR) END AS read_table_ids, CAST(NULL AS BIGINT) AS user_id
      FROM query_log""",
    "bool_flags": f"""WITH {LOG} SELECT query_id, query_id % 6 IN (0, 2, 4, 5) AS was_cached,
      query_id % 4 <> 0 AND query_id % 2 = 1 AS was_aborted, false AS missing FROM query_log""",
    "normalised_batch": f"""WITH {LOG} SELECT query_id, coalesce(query_type, 'NA') AS query_type,
      coalesce(feature_fingerprint, 'NA') AS feature_fingerprint, arrival_timestamp, coalesce(read_table_ids, '') AS read_table_ids,
      CAST(NULL AS DOUBLE) AS cluster_size, 'NA' AS fp_bucket FROM query_log""",
    "landable_events": f"WITH {LOG} {LANDED}",
    "id_lists": f"""WITH {LOG} SELECT query_id, {_csv_count('read_table_ids')} AS n_ids, coalesce(read_table_ids, '') AS csv,
      CAST(CASE WHEN read_table_ids IS NULL THEN 0 ELSE len(string_split(read_table_ids, ',')) END AS BIGINT) AS n_listed,
      CAST(database_id AS VARCHAR) AS database_csv FROM query_log""",
    "time_values": f"""WITH {LOG} SELECT query_id, arrival_timestamp AS parsed, epoch_us(arrival_timestamp) // 1000 AS epoch_ms,
      date_trunc('hour', arrival_timestamp) AS hour, CAST(arrival_timestamp AS DATE) AS day FROM query_log""",
    "file_days": f"WITH {LOG} SELECT query_id, CASE WHEN query_id % 3 <> 0 THEN CAST(arrival_timestamp AS DATE) END AS day FROM query_log",
    "finite_values": f"WITH {LOG} SELECT query_id, CASE WHEN query_id % 5 > 2 THEN CAST(query_id AS DOUBLE) END AS x FROM query_log",
    "flattened_records": f"""WITH {LOG} SELECT query_id, 'compile' AS kind, compile_duration_ms AS ms FROM query_log WHERE compile_duration_ms IS NOT NULL
      UNION ALL SELECT query_id, 'execute', execution_duration_ms FROM query_log WHERE execution_duration_ms IS NOT NULL""",
    "classified_queries": f"WITH {CLASSIFIED} SELECT query_id, query_class FROM classified",
    "classified_strict": f"""WITH {LOG}, m AS (SELECT *, CAST(execution_duration_ms AS DOUBLE) / (mbytes_scanned + 1) AS r FROM query_log)
      SELECT query_id, CASE
        WHEN NOT was_cached AND query_type IN ('copy', 'unload') AND execution_duration_ms > 500 THEN 'network_bound_queries'
        WHEN NOT was_cached AND query_type NOT IN ('copy', 'unload') AND (num_joins > 1 OR num_aggregations > 1)
          AND mbytes_scanned > 0 AND r > 20 AND execution_duration_ms > 1000 THEN 'cpu_bound_queries'
        WHEN NOT was_cached AND query_type NOT IN ('copy', 'unload') AND mbytes_scanned >= 2000 AND r < CAST(0.061 AS DOUBLE)
          AND (mbytes_spilled > 0 OR num_scans > 1) AND execution_duration_ms > 1000 THEN 'io_bound_queries'
        WHEN NOT was_cached AND queue_duration_ms >= execution_duration_ms AND queue_duration_ms > 1000
          AND execution_duration_ms > 0 AND num_scans + num_joins + num_aggregations < 4 THEN 'queue_wlm_bound_queries'
        ELSE 'normal_queries' END AS query_class FROM m""",
    "class_measures": f"WITH {MEASURED} SELECT query_id, CAST(r AS DOUBLE) AS scan_ratio, complexity FROM measured",
    "minute_stats": f"WITH {MINUTE} SELECT * FROM stats",
    "hour_stats": f"WITH {_stats('1 hour')} SELECT * FROM stats",
    "day_stats": f"WITH {_stats('1 day')} SELECT * FROM stats",
    "filled_cluster_size": f"""WITH {LOG} SELECT query_id, coalesce(last_value(cluster_size IGNORE NULLS) OVER (PARTITION BY instance_id
      ORDER BY arrival_timestamp, query_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS cluster_size FROM query_log""",
    "fingerprint_counts": f"WITH {LOG} SELECT coalesce(feature_fingerprint, 'NA') AS feature_fingerprint, count(*) AS fp_freq FROM query_log GROUP BY 1",
    "fingerprint_features": f"""WITH {LOG}, fp AS (SELECT coalesce(feature_fingerprint, 'NA') AS f, count(*) AS c FROM query_log
        WHERE arrival_timestamp < TIMESTAMP '2024-01-02' GROUP BY 1),
      j AS (SELECT query_id, coalesce(c, 0) AS fp_freq FROM query_log LEFT JOIN fp ON f = coalesce(feature_fingerprint, 'NA'))
      SELECT query_id, fp_freq, CAST(fp_freq < 3 AS BIGINT) AS fp_is_rare, {_bucketed('fp_freq')} AS fp_bucket FROM j""",
    "time_features": f"""WITH {LOG} SELECT query_id, CAST(hour(arrival_timestamp) AS DOUBLE) AS arrival_hour,
      CAST(isodow(arrival_timestamp) - 1 AS DOUBLE) AS arrival_dow FROM query_log""",
    "table_counts": f"""WITH {LOG} SELECT query_id, {_csv_count('read_table_ids')} AS read_table_count,
      {_csv_count('write_table_ids')} AS write_table_count,
      CASE WHEN {_csv_count('write_table_ids')} > 0 THEN 1 ELSE 0 END AS has_write FROM query_log""",
    "prepared_features": _prepared(),
    "scaled_targets": f"""WITH {LOG}, e AS (SELECT [{', '.join(_q('execution_duration_ms', p) for p in (0.25, 0.5, 0.75))}] AS q FROM query_log),
      y AS (SELECT query_id, CAST(execution_duration_ms AS DOUBLE) AS y FROM query_log)
      SELECT query_id, CASE WHEN y <= q[1] THEN 0 WHEN y <= q[2] THEN 1 WHEN y <= q[3] THEN 2 ELSE 3 END AS quartile,
        CAST(y >= 600000 AS BIGINT) AS explodes, round(ln(1 + y), 6) AS log_ms,
        round(greatest(exp(ln(1 + y) - 1) - 1, 1.0), 3) AS back_ms, greatest(y, 70000.0) AS conservative_ms FROM y, e""",
    "target_quartiles": f"""WITH {LOG}, e AS (SELECT [{', '.join(_q('execution_duration_ms', p) for p in (0.25, 0.5, 0.75))}] AS q FROM query_log)
      SELECT q[1] AS q25, q[2] AS q50, q[3] AS q75 FROM e""",
    "training_profile": f"""WITH {LOG} SELECT count(*) AS rows, count(DISTINCT CAST(arrival_timestamp AS DATE)) AS days,
      count(DISTINCT coalesce(feature_fingerprint, 'NA')) AS fingerprints FROM query_log""",
    "instance_ranks": f"WITH {PREDICTED} SELECT query_id, true_quantile, pred_quantile, true_rank_desc, pred_rank_desc, rank_gap_desc FROM errors",
    "flags_default": f"WITH {FLAGGED} SELECT {FLAG_COLUMNS} FROM flagged",
    "flags_high_ratio": f"WITH {_flagged(ratio=1000.0)} SELECT {FLAG_COLUMNS} FROM flagged WHERE is_anomaly",
    "flags_rank_only": f"WITH {_flagged(1e9, 1e12)} SELECT {FLAG_COLUMNS} FROM flagged WHERE is_anomaly",
    "flags_ratio_and_rank": f"WITH {_flagged(delta=1e12)} SELECT {FLAG_COLUMNS} FROM flagged WHERE is_anomaly",
    "anomaly_hits": f"WITH {HITS} SELECT * FROM hits",
    "instance_summary": _summary("instance_id"),
    "user_summary": _summary("user_id"),
    "row_sample": f"WITH {LOG} SELECT query_id, instance_id, query_type FROM query_log ORDER BY {_draw(0)} LIMIT 500",
    "control_sample": f"WITH {FLAGGED} SELECT query_id, true_ms, under_ratio FROM flagged WHERE NOT is_anomaly ORDER BY {_draw(1)} LIMIT 200",
    "report_bounds_day": f"WITH {MINUTE}{_bounds(1)} SELECT latest, cur AS window_start, prev AS prev_window_start FROM bounds",
    "report_bounds_week": f"WITH {MINUTE}{_bounds(7)} SELECT latest, cur AS window_start, prev AS prev_window_start FROM bounds",
    "report_instances": f"WITH {_report(1)} SELECT DISTINCT instance_id FROM cur",
    "critical_instances": f"WITH {_report(7)} SELECT instance_id FROM cur GROUP BY instance_id HAVING {' OR '.join(_critical(p) for p in PROBLEMS)}",
    "critical_problem_types": f"WITH {_report(1)} {_problem_union()}",
    "critical_problem_types_by_union": f"WITH {_report(1)} {_problem_union()}",
    "fleet_metrics": _fleet(),
    "anomaly_details": f"""WITH {_report(7, True)} SELECT instance_id, arrival_timestamp, query_id, user_id, database_id, anomaly_reason,
      signed_err_ms AS absolute_delta, under_ratio AS relative_delta FROM hits h, bounds b WHERE arrival_timestamp >= b.cur AND instance_id IN {IDS}""",
    "class_chart": f"WITH {_report(1)} SELECT window_start, {CHART} FROM cur WHERE instance_id IN {IDS} GROUP BY 1",
    "class_shares": f"WITH {_report(1)}, c AS (SELECT window_start, {CHART}, CAST(sum(total_queries) AS DOUBLE) AS t FROM cur WHERE instance_id IN {IDS} GROUP BY 1) SELECT window_start, "
    + ", ".join(f"CAST({c}_queries AS DOUBLE) / t * 100 AS {c}_queries" for c in CLASSES)
    + " FROM c",
    "class_totals": TOTALS + "SELECT * FROM totals",
    "class_totals_rows": TOTALS
    + " UNION ALL ".join(
        f"SELECT '{label}' AS type, {name} AS count, CAST({pct} AS DOUBLE) AS pct FROM totals"
        for label, name, pct in (
            ("Total", "total_queries", "1"),
            ("Normal", "normal_queries", "normal_queries_pct"),
            ("CPU", "cpu_bound_queries", "cpu_bound_queries_pct"),
            ("IO", "io_bound_queries", "io_bound_queries_pct"),
            ("Network", "network_bound_queries", "network_bound_queries_pct"),
            ("Queue/WLM", "queue_wlm_bound_queries", "queue_wlm_bound_queries_pct"),
            ("Anomalies", "anomalies_count", "anomalies_pct"),
        )
    ),
    "evolved_table": f"""WITH {LOG} SELECT query_id, query_type, CASE WHEN query_id % 2 = 0 THEN num_joins END AS num_joins,
      CASE WHEN query_id % 2 = 1 THEN num_scans END AS num_scans FROM query_log""",
    "stats_table": f"WITH {_stats('1 hour')} SELECT * FROM stats",
    "anomaly_table": f"WITH {HITS} SELECT window_start, query_id, anomaly_reason, true_ms, pred_ms FROM hits",
    "ledger": f"""WITH {FLAGGED} SELECT CAST(arrival_timestamp AS DATE) AS day, 'postcompile' AS stage, count(*) AS rows_scored,
      count(*) FILTER (WHERE is_anomaly) AS rows_anoms FROM flagged GROUP BY 1""",
    "daily_control_sample": f"""WITH {FLAGGED}, d AS (SELECT query_id, CAST(arrival_timestamp AS DATE) AS day, true_ms FROM flagged WHERE NOT is_anomaly)
      SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY day ORDER BY {_draw(2)}) <= 15""",
    "daily_instance_ranks": f"""WITH {PREDICTED_DAILY} SELECT query_id, true_quantile, pred_quantile, true_rank_desc, pred_rank_desc, rank_gap_desc FROM errors""",
    "daily_user_summary": _summary("user_id", "CAST(arrival_timestamp AS DATE) AS day"),
    "pending_days": f"WITH {DAYS} SELECT day FROM days WHERE day(day) % 2 = 1",
    "waiting_writers": f"""WITH {LOG}, p AS (SELECT DISTINCT CAST(arrival_timestamp AS DATE) AS day, 'w' || CAST(user_id % 4 AS VARCHAR) AS writer FROM query_log)
      SELECT p.day, p.writer FROM p WHERE day = (SELECT max(q.day) FROM p q WHERE q.writer = p.writer)""",
    "retention_cutoff": f"WITH {DAYS} SELECT min(day) AS cutoff FROM (SELECT day FROM days ORDER BY day DESC LIMIT 8)",
    "archived_stats": f"""WITH {_stats('1 day')}, d AS (SELECT min(x) AS cutoff FROM (SELECT DISTINCT CAST(window_start AS DATE) AS x FROM stats ORDER BY x DESC LIMIT 8))
      SELECT count(*) FILTER (WHERE window_start >= cutoff) AS kept, any_value(cutoff) AS first_day,
        count(*) FILTER (WHERE window_start < cutoff) AS moved FROM stats, d""",
    "ratio_profile": f"WITH {RATIO_PROFILE} SELECT * FROM ratio_profile",
    "scan_profile": f"""WITH {CLASSIFIED} SELECT {SCAN_BUCKET} AS bucket, count(*) AS n, {_pct('mbytes_spilled > 0')} AS spill_pct,
      {_pct('num_scans > 1')} AS multi_scan_pct, {_avg('mbytes_spilled')} AS avg_spill_mb, {_q('r', 0.5)} AS ratio_p50
      FROM classified WHERE NOT was_cached AND NOT transfer AND scanned > 0 GROUP BY 1""",
    "transfer_profile": f"WITH {RATIO_PROFILE} SELECT * FROM transfer_profile",
    "queue_profile": f"""WITH {CLASSIFIED} SELECT {QUEUE_BUCKET} AS bucket, count(*) AS n, {_avg('queue_duration_ms')} AS avg_queue_ms,
      {_avg('execution_duration_ms')} AS avg_exec_ms, {_pct('queue_duration_ms >= execution_duration_ms')} AS queue_dominant_pct,
      ({_avg('queue_duration_ms')}) / ({_avg('execution_duration_ms')}) AS queue_per_exec
      FROM classified WHERE queue_duration_ms > 0 AND execution_duration_ms > 0 GROUP BY 1""",
    "transitions": f"""WITH {RATIO_PROFILE} SELECT 'ratio' AS profile, min(bucket) AS bucket FROM ratio_profile WHERE vs_overall >= 2
      UNION ALL SELECT 'transfer_' || query_type, min(bucket) FROM transfer_profile WHERE scan_p50_mb >= 50 GROUP BY query_type""",
    "class_distribution": f"""WITH {CLASSIFIED} SELECT query_class, count(*) AS n, {_avg('scanned')} AS avg_scan_mb,
      {_pct('mbytes_spilled > 0')} AS spill_pct, {_pct('queue_duration_ms >= execution_duration_ms')} AS queue_dominant_pct,
      {_avg('complexity')} AS avg_complexity, count(*) * CAST(100 AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS pct,
      {_q('execution_duration_ms', 0.5)} AS exec_p50_ms,
      {_q('CASE WHEN scanned > 0 THEN r END', 0.5)} AS ratio_p50 FROM classified GROUP BY query_class""",
    "class_purity": f"""WITH {CLASSIFIED}, p AS (SELECT *, {PURE} AS pure FROM classified WHERE query_class <> 'normal_queries')
      SELECT query_class, count(*) AS n, count(*) FILTER (WHERE pure) AS pure, {_pct('pure')} AS purity_pct,
      {_pct('execution_duration_ms > 1000 AND complexity > 1')} AS slow_complex_pct FROM p GROUP BY query_class""",
    "class_overlap": f"WITH {MEASURED} {_overlap()}",
    "sensitivity": f"WITH {MEASURED} {_sensitivity()}",
    "cpu_variants": f"WITH {MEASURED} {_variants()}",
    "ratio_ceiling": f"""WITH {MEASURED}, b AS (SELECT {SCAN_BUCKET} AS bucket, {_q('r', 0.25)} AS p FROM measured
      WHERE NOT was_cached AND NOT transfer AND scanned >= 2000 GROUP BY 1) SELECT round(avg(p), 9) AS ratio_ceiling, count(*) AS buckets FROM b""",
    "streamed_hour_stats": _stream_windows(),
    "streamed_landing": f"WITH {LOG} {LANDED}",
    "streamed_anomaly_windows": f"WITH {HITS} SELECT window_start, query_id, anomaly_reason, true_ms, pred_ms FROM hits",
}


SQL["model_bounds"] = f"""WITH {LOG}
SELECT count(*) AS rows_scored, CAST(0 AS BIGINT) AS below_floor, CAST(0 AS BIGINT) AS not_larger
FROM query_log WHERE NOT was_aborted"""

SQL["backtest_coverage"] = f"""WITH {LOG},
days AS (SELECT DISTINCT CAST(arrival_timestamp AS DATE) AS day FROM query_log),
late AS (SELECT day FROM days ORDER BY day OFFSET 2)
SELECT day, 'postcompile' AS stage, count(*) AS rows_scored
FROM query_log JOIN late ON day = CAST(arrival_timestamp AS DATE) WHERE NOT was_aborted GROUP BY day"""

SQL["streamed_lagging_events"] = f"""WITH {LOG},
arriving AS (
  SELECT instance_id, arrival_timestamp AS ts, time_bucket(INTERVAL '10 minutes', arrival_timestamp) AS window_start,
    CASE WHEN instance_id IN (3, 7) AND query_id % 5 = 0 THEN least((day(arrival_timestamp) - 1) // 8 + 1, 3)
         ELSE (day(arrival_timestamp) - 1) // 8 END AS batch
  FROM query_log
),
clocks AS (  -- before each batch, and after the last
  SELECT b.batch, i.instance_id,
    greatest(max(ts) FILTER (WHERE a.instance_id = i.instance_id), max(ts) - INTERVAL '1 day') AS closed_to,
    bool_or(a.instance_id = i.instance_id) AS seen
  FROM (SELECT unnest(range(5)) AS batch) b
  JOIN (SELECT DISTINCT instance_id FROM arriving) i ON true
  JOIN arriving a ON a.batch < b.batch
  GROUP BY 1, 2
),
judged AS (
  SELECT a.*, coalesce(c.seen AND window_start + INTERVAL '70 minutes' <= c.closed_to, false) AS late,
    window_start + INTERVAL '70 minutes' <= e.closed_to AS closed
  FROM arriving a
  LEFT JOIN clocks c ON c.batch = a.batch AND c.instance_id = a.instance_id
  JOIN clocks e ON e.batch = 4 AND e.instance_id = a.instance_id
)
SELECT CASE WHEN late THEN 'late' WHEN closed THEN 'closed' ELSE 'open' END AS outcome, instance_id, window_start, count(*) AS events
FROM judged GROUP BY ALL"""

SQL["model_checks"] = "SELECT true AS covers, true AS mean_fits, true AS quantile_fits, CAST(0 AS BIGINT) AS changed_by_reload"

SQL["widened_table"] = f"""WITH {LOG}
SELECT query_id,
  CASE query_id % 5 WHEN 1 THEN CAST(query_id + 1099511627776 AS VARCHAR) WHEN 2 THEN CAST(CAST(query_id AS DOUBLE) / 2 AS VARCHAR)
    WHEN 3 THEN 'q' || query_id ELSE CAST(query_id AS VARCHAR) END AS word,
  CASE query_id % 5 WHEN 1 THEN query_id + 1099511627776 ELSE query_id END AS number
FROM query_log"""

SQL["shard_scan"] = f"WITH {LOG} SELECT query_id, query_type, num_scans, execution_duration_ms FROM query_log"

SQL["manifest_scan"] = f"""WITH {LOG}
SELECT query_id, query_type, CASE WHEN query_id % 2 = 1 THEN num_joins END AS num_joins FROM query_log"""

SQL["trained_days"] = f"""WITH {LOG},
days AS (SELECT DISTINCT CAST(arrival_timestamp AS DATE) AS day FROM query_log WHERE NOT was_cached AND NOT was_aborted),
numbered AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS i FROM days),
due AS (SELECT day FROM numbered WHERE i % 7 = 0 AND day < (SELECT max(CAST(arrival_timestamp AS DATE)) FROM query_log))
SELECT day AS trained_on, 'postcompile' AS stage,
  CAST(1 AS BIGINT) AS versions
FROM due"""

SQL["stopped_stream"] = f"""WITH {LOG}
SELECT CAST(arrival_timestamp AS DATE) AS day, count(*) AS queries FROM query_log
WHERE CAST(arrival_timestamp AS DATE) < (SELECT min(CAST(arrival_timestamp AS DATE)) FROM query_log) + 3 GROUP BY 1"""

SQL["category_codes"] = f"""WITH {LOG}
SELECT query_id, query_type, dense_rank() OVER (ORDER BY query_type) - 1 AS code
FROM query_log WHERE NOT was_aborted"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
