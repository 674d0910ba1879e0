"""Time axes, clocks, instants and windows."""

from pyspark.sql import functions as F

from chronolode.functions import timestamps as t
from chronolode.operators import axis, files, stats
from chronolode.queries import views as v
from chronolode.queries.views import oracle

NOW_NS = 900_000_000_000_000_000


def _axis(spark, sf, *arrays):
    raw = v.v_raw(spark, sf, "secs", "nanos", *arrays)
    return raw.withColumn("ts", t.ts_combine(F.col("secs"), F.col("nanos")))


def q_ts_combine(spark, sf):
    return _axis(spark, sf).select(
        "path", "signal_name", "price", F.get("ts", 0).alias("first_ns"), F.element_at("ts", -1).alias("last_ns"),
        F.aggregate("ts", F.lit(0).cast("bigint"), lambda a, x: a + (x - F.lit(1_700_000_000_000_000_000))).alias("offset_sum"),
    )


def q_ts_bounds(spark, sf):
    kept = files.ts_bounds(_axis(spark, sf), F.size("ts"), 8)
    return kept.groupBy("path").agg(F.count("*").alias("n"))


def q_period_first_pair(spark, sf):
    return _axis(spark, sf).where(F.col("ts").isNotNull()).select(
        "path", "price", t.period_first_pair(F.col("ts")).alias("period_ns")
    )


def q_period_whole_sec(spark, sf):
    every = F.filter("secs", lambda _, i: i % 4 == 0)  # one sample per second
    return v.v_raw(spark, sf, "secs").select(
        "path", "price",
        t.period_whole_sec(F.col("secs"), guard=False).alias("unguarded"),
        t.period_whole_sec(F.col("secs")).alias("guarded"),
        t.period_whole_sec(every).alias("per_second"),
    )


def q_period_mean(spark, sf):
    return stats.period_mean(v.v_points(spark, sf).withColumnRenamed("name", "pv"))


def q_regular_sampling(spark, sf):
    # gaps of seconds: a tolerance that tells about half of the signals apart
    return axis.regular_sampling(v.v_samples(spark, sf), 10, 200_000_000_000_000)


def q_regular_gaps(spark, sf):
    ts = F.col("ts")
    return _axis(spark, sf).where(ts.isNotNull()).select(
        "path", "price", t.regular_gaps(ts, t.period_first_pair(ts)).alias("regular")
    )


def q_time_axis(spark, sf):
    return v.v_raw(spark, sf, "dims").select(
        "path", "price", t.time_axis(F.col("dims"), F.lit(8).cast("bigint")).alias("axis"),
        t.time_axis(F.col("dims"), F.lit(5).cast("bigint")).alias("fallback_axis"),
    )


def _elements(array, finish=lambda x: x):
    return [finish(F.get(array, F.lit(i))).alias(f"v{i}") for i in range(8)]


def q_axis_slice(spark, sf):
    dims = F.col("dims")
    raw = axis.computed(v.v_raw(spark, sf, "dims", "vals"), at=t.time_axis(dims, F.lit(8).cast("bigint")))
    sliced = axis.computed(raw, s=t.axis_slice(F.col("vals"), dims, F.col("at")))
    return sliced.select("path", "price", F.size("s").alias("n"), *_elements(F.col("s")))


def q_numeric_cascade(spark, sf):
    raw = axis.computed(v.v_raw(spark, sf, "texts"), x=t.numeric_cascade(F.col("texts")))
    bad = F.isnan(F.get("x", F.lit(2))).alias("bad")
    return raw.select("path", "price", F.size("x").alias("n"), bad, *_elements(F.col("x"), lambda x: F.nanvl(x, F.lit(None))))


def q_validate_signal(spark, sf):
    checked = files.validate_signal(_axis(spark, sf, "texts"), F.col("texts"), F.size("ts"))
    return checked.select("path", "signal_name", "price", "ok", "reason")


def q_expand_clock(spark, sf):
    rows = axis.expand_clock(v.v_clock_buckets(spark, sf), "pv", "request_id", "first_ns")
    return rows.groupBy("pv", "request_id").agg(
        F.count("*").alias("n"), F.sum(F.col("ts_ns") - F.col("first_ns")).alias("offset_sum"),
        F.round(F.sum(F.col("value") * (F.col("pos") + 1)), 4).alias("checksum"),
    )


def q_expand_timestamps(spark, sf):
    rows = axis.expand_timestamps(v.v_buckets(spark, sf), "pv")
    return rows.select("pv", "pos", "ts_ns", F.nanvl("value", F.lit(None)).alias("value"))


def q_regular_series(spark, sf):
    events = v.v_events_meta(spark, sf).withColumn("n", F.col("id") % 4)
    return axis.regular_series(events.withColumn("ms", F.lit(250)), "start_ns", "ms", "n", "id")


def q_clock_stats(spark, sf):
    out = axis.clock_stats(v.v_clock_buckets(spark, sf))
    return out.select("bucket_id", "request_id", F.round("freq_hz", 6).alias("freq_hz"), "duration_ns")


def _with_next(spark, sf):
    a = v.v_points(spark, sf).select("event_id", "ts_ns")
    b = a.select((F.col("event_id") - 1).alias("event_id"), F.col("ts_ns").alias("next_ns"))
    return a.join(b, "event_id")


def q_ts_diff_ms(spark, sf):
    return _with_next(spark, sf).select(
        "event_id", t.ts_diff_ms(F.col("ts_ns"), F.col("next_ns")).alias("ms"),
        t.ts_diff_ms(F.col("next_ns"), F.col("ts_ns")).alias("back_ms"),
    )


def q_ts_seconds(spark, sf):
    return v.v_points(spark, sf).select("event_id", F.round(t.ts_seconds(F.col("ts_ns")), 5).alias("seconds"))


def q_ts_from_seconds(spark, sf):
    return v.v_points(spark, sf).select("event_id", t.ts_from_seconds(F.abs("event_id") * 0.25).alias("ns"))


def q_ts_iso(spark, sf):
    ns = F.col("ts_ns") + F.col("event_id") % 1000
    return v.v_points(spark, sf).select("event_id", t.ts_iso(ns).alias("iso"), t.ts_iso(ns, 3).alias("iso_ms"))


def q_ts_valid(spark, sf):
    """Instants a BIGINT can't hold are read as the last one it can, which is as far beyond the bound."""
    step = F.col("event_id") - 5

    def instant(unit, begin=0):
        return F.coalesce(F.try_add(F.try_multiply(step, F.lit(unit)), F.lit(begin)), F.lit((1 << 63) - 1))

    return v.v_points(spark, sf).select(
        "event_id",
        t.ts_valid(instant(1_000_000_000)).alias("low"),
        t.ts_valid(instant(10**12, 4_102_444_000 * 10**9)).alias("high"),
        t.ts_parts_valid(F.col("event_id"), F.col("event_id") * 500_000).alias("parts_valid"),
    )


def _dates(spark, sf):
    """Date texts in all formats; every 17th month is 13."""
    split = F.split(F.expr("substr(CAST(o_orderdate AS STRING), 1, 10)"), "-")
    month = F.when(F.col("o_orderkey") % 17 == 0, "13").otherwise(split[1])
    return v.table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(month, split[2], split[0]).alias("mdy"),
        F.concat(split[2], month, split[0]).alias("dmy"),
        F.concat_ws("-", month, split[2], split[0]).alias("dashed"),
        F.concat(F.concat_ws("-", split[0], month, split[2]), F.lit("T01:02:03.004Z")).alias("iso"),
        F.concat(F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit("3015")).alias("hms"),
    )


def q_parse_when(spark, sf):
    return _dates(spark, sf).select(
        "o_orderkey",
        t.parse_when(F.col("mdy"), F.col("hms")).alias("mdy"),
        t.parse_when(F.col("dmy"), None, "DDMMYYYY").alias("dmy"),
        t.parse_when(t.swap_day_month(F.col("dmy")), None, "MM-DD-YYYY").alias("swapped"),
        t.parse_when(F.col("dashed"), None, "MM-DD-YYYY").alias("dashed"),
        t.parse_when(F.col("iso"), None, "ISO").alias("iso"),
    )


def q_resolve_window(spark, sf):
    k = F.col("o_orderkey")
    args = (
        F.when(k % 5 != 0, F.col("mdy")),
        F.when(k % 2 == 0, F.col("hms")),
        F.when(k % 3 == 0, F.col("mdy")),
        F.when(k % 7 == 0, F.lit("235959")),
    )
    return _dates(spark, sf).select(
        "o_orderkey", t.resolve_window(*args, "query").alias("q"), t.resolve_window(*args, "dataset").alias("d")
    ).select(
        "o_orderkey",
        F.col("q.begin_ns").alias("q_begin"),
        F.col("q.end_ns").alias("q_end"),
        F.col("d.begin_ns").alias("d_begin"),
        F.col("d.end_ns").alias("d_end"),
    )


def q_time_range_hours(spark, sf):
    hours = (F.col("o_orderkey") % 48).cast("bigint")
    return _dates(spark, sf).select("o_orderkey", t.time_range_hours(F.col("dashed"), hours).alias("r")).select("o_orderkey", "r.*")


def q_event_duration(spark, sf):
    return v.v_events_meta(spark, sf).select("id", t.event_duration_ms(F.col("start_ns"), F.col("stop_ns")).alias("ms"))


def q_event_active(spark, sf):
    return v.v_events_meta(spark, sf).select(
        "id", t.event_active(F.col("start_ns"), F.col("stop_ns"), F.col("start_ns") + 1_000_000_000).alias("active"),
        t.event_active(F.col("start_ns"), F.col("stop_ns"), F.lit(NOW_NS)).alias("active_now"),
    )


_S = "1000000000"
_EIGHT = ", ".join(f"max(CASE WHEN i = {k} THEN {{x}} END) AS v{k}" for k in range(8))
_EPOCH_OK = "o_orderkey % 17 <> 0"
_DAY = "CAST(epoch(o_orderdate) AS BIGINT)"
_HMS = "(o_orderkey % 24 * 3600 + 30 * 60 + 15)"

QUERIES = {
    "ts_combine": (
        q_ts_combine,
        oracle(
            f"""SELECT path, signal_name, price, CASE WHEN bad THEN NULL ELSE min(sec * {_S} + nano) END AS first_ns,
            CASE WHEN bad THEN NULL ELSE max(CASE WHEN i = 7 THEN sec * {_S} + nano END) END AS last_ns,
            CASE WHEN bad THEN NULL ELSE CAST(sum(sec * {_S} + nano - 1700000000::BIGINT * {_S}) AS BIGINT) END AS offset_sum
            FROM (SELECT *, file_no % 23 = 0 AND file_no % 7 <> 0 AS bad FROM v_raw_long)
            GROUP BY lid, path, signal_name, price, bad"""
        ),
    ),
    "ts_bounds": (
        q_ts_bounds,
        oracle(
            """SELECT path, count(*) AS n FROM v_raw WHERE NOT (file_no % 23 = 0 AND file_no % 7 <> 0)
            GROUP BY path"""
        ),
    ),
    "period_first_pair": (
        q_period_first_pair,
        oracle(
            f"""SELECT path, price, max(CASE WHEN i = 1 THEN sec * {_S} + nano END)
            - max(CASE WHEN i = 0 THEN sec * {_S} + nano END) AS period_ns FROM v_raw_long
            WHERE NOT (file_no % 23 = 0 AND file_no % 7 <> 0) GROUP BY lid, path, price"""
        ),
    ),
    "period_whole_sec": (
        q_period_whole_sec,
        oracle(
            f"""SELECT path, price, max(CASE WHEN i = 1 THEN sec END) * {_S} - max(CASE WHEN i = 0 THEN sec END) * {_S}
            AS unguarded, {_S}::BIGINT AS guarded, (max(CASE WHEN i = 4 THEN sec END) - max(CASE WHEN i = 0 THEN sec END)) * {_S}
            AS per_second FROM v_raw_long GROUP BY lid, path, price"""
        ),
    ),
    "period_mean": (
        q_period_mean,
        oracle(
            f"""SELECT name AS pv, CASE WHEN count(*) = 1 THEN {_S} ELSE (max(ts_ns) - min(ts_ns)) // (count(*) - 1) END
            AS period_ns FROM v_points GROUP BY name"""
        ),
    ),
    "regular_sampling": (
        q_regular_sampling,
        oracle(
            """WITH g AS (SELECT pv, row_number() OVER w AS rn, ts_ns - lag(ts_ns) OVER w AS gap FROM v_samples
            WINDOW w AS (PARTITION BY pv ORDER BY ts_ns)), p AS (SELECT pv, gap AS period FROM g WHERE rn = 2)
            SELECT g.pv, count(*) < 3 OR bool_and(coalesce(abs(gap - period) <= 200000000000000, true)) AS regular
            FROM g LEFT JOIN p ON p.pv = g.pv WHERE rn <= 11 GROUP BY g.pv"""
        ),
    ),
    "regular_gaps": (
        q_regular_gaps,
        oracle(
            f"""WITH g AS (SELECT lid, path, price, sec * {_S} + nano - lag(sec * {_S} + nano) OVER
              (PARTITION BY lid ORDER BY i) AS gap, i FROM v_raw_long WHERE NOT (file_no % 23 = 0 AND file_no % 7 <> 0)),
            p AS (SELECT lid, gap AS period FROM g WHERE i = 1)
            SELECT path, price, bool_and(abs(gap - period) <= 1000) AS regular
            FROM g JOIN p USING (lid) WHERE i > 0 GROUP BY lid, path, price"""
        ),
    ),
    "time_axis": (
        q_time_axis,
        oracle(
            """SELECT path, price, CASE file_no % 5 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 1 ELSE 2 END
            AS axis, CASE file_no % 5 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 1 ELSE 2 END
            AS fallback_axis FROM v_raw"""
        ),
    ),
    "axis_slice": (
        q_axis_slice,
        oracle(
            f"""SELECT path, price, CAST(count(*) AS INT) AS n, {_EIGHT.format(x="quantity + i")}
            FROM v_raw_long GROUP BY lid, path, price"""
        ),
    ),
    "numeric_cascade": (
        q_numeric_cascade,
        oracle(
            f"""SELECT path, price, 8 AS n, bool_or(i = 2 AND x IS NULL) AS bad, {_EIGHT.format(x="x")}
            FROM (SELECT *, TRY_CAST(val_text AS DOUBLE) AS x FROM v_raw_long) GROUP BY lid, path, price"""
        ),
    ),
    "validate_signal": (
        q_validate_signal,
        oracle(
            """SELECT path, signal_name, price, NOT bad AS ok, CASE WHEN bad THEN 'no time axis' ELSE '' END AS reason
            FROM (SELECT *, file_no % 23 = 0 AND file_no % 7 <> 0 AS bad FROM v_raw)"""
        ),
    ),
    "expand_clock": (
        q_expand_clock,
        oracle(
            """SELECT pv, request_id, count(*) AS n, CAST(sum(i * period_ns) AS BIGINT) AS offset_sum,
            round(sum(value * (i + 1)), 4) AS checksum FROM v_requests_long GROUP BY pv, request_id"""
        ),
    ),
    "expand_timestamps": (
        q_expand_timestamps,
        # samples of one instant follow each other by value, as in a bucket
        oracle(
            """SELECT pv, CAST(row_number() OVER (PARTITION BY pv, ts_ns // 86400000000000 ORDER BY ts_ns, value NULLS FIRST) - 1 AS INT) AS pos,
            ts_ns, CASE WHEN isnan(value) THEN NULL ELSE value END AS value FROM v_samples"""
        ),
    ),
    "regular_series": (
        q_regular_series,
        oracle(
            """SELECT id, CAST(pos AS BIGINT) AS pos, start_ns + pos * 250000000 AS ts_ns
            FROM (SELECT id, start_ns, unnest(range(id % 4)) AS pos FROM v_events_meta)"""
        ),
    ),
    "clock_stats": (
        q_clock_stats,
        oracle(
            """SELECT bucket_id, request_id, round(1e9 / period_ns, 6) AS freq_hz,
            period_ns * (sample_count - 1) AS duration_ns FROM v_clock_buckets"""
        ),
    ),
    "ts_diff_ms": (
        q_ts_diff_ms,
        oracle(
            f"""SELECT event_id, (b // {_S} - a // {_S}) * 1000 + CAST(trunc((b % {_S} - a % {_S}) / 1e6) AS BIGINT) AS ms,
            (a // {_S} - b // {_S}) * 1000 + CAST(trunc((a % {_S} - b % {_S}) / 1e6) AS BIGINT) AS back_ms
            FROM (SELECT x.event_id, x.ts_ns AS a, y.ts_ns AS b FROM v_points x JOIN v_points y
              ON y.event_id = x.event_id + 1)"""
        ),
    ),
    "ts_seconds": (q_ts_seconds, oracle("SELECT event_id, round(ts_ns // 1000 / 1e6, 5) AS seconds FROM v_points")),
    "ts_from_seconds": (q_ts_from_seconds, oracle("SELECT event_id, event_id * 250000000 AS ns FROM v_points")),
    "ts_iso": (
        q_ts_iso,
        oracle(
            """SELECT event_id, strftime(make_timestamp(ns // 1000), '%Y-%m-%dT%H:%M:%S') || '.'
            || lpad(CAST(ns % 1000000000 AS VARCHAR), 9, '0') || 'Z' AS iso,
            strftime(make_timestamp(ns // 1000), '%Y-%m-%dT%H:%M:%S') || '.'
            || lpad(CAST(ns % 1000000000 // 1000000 AS VARCHAR), 3, '0') || 'Z' AS iso_ms
            FROM (SELECT event_id, ts_ns + event_id % 1000 AS ns FROM v_points)"""
        ),
    ),
    "ts_valid": (
        q_ts_valid,
        oracle(
            """SELECT event_id, event_id > 5 AS low, 4102444000 + (event_id - 5) * 1000 < 4102444800 AS high,
            event_id > 0 AND event_id * 500000 < 1000000000 AS parts_valid FROM v_points"""
        ),
    ),
    "parse_when": (
        q_parse_when,
        f"""SELECT o_orderkey, CASE WHEN {_EPOCH_OK} THEN {_DAY} + {_HMS} END AS mdy,
        CASE WHEN {_EPOCH_OK} THEN {_DAY} END AS dmy, CASE WHEN {_EPOCH_OK} THEN {_DAY} END AS swapped,
        CASE WHEN {_EPOCH_OK} THEN {_DAY} END AS dashed, CASE WHEN {_EPOCH_OK} THEN {_DAY} + 3723 END AS iso FROM orders""",
    ),
    "resolve_window": (
        q_resolve_window,
        f"""SELECT o_orderkey, CASE WHEN has_date THEN b END * {_S} AS q_begin,
        CASE WHEN has_end THEN e WHEN has_date THEN b + 3600 END * {_S} AS q_end,
        CASE WHEN has_date THEN b ELSE 1 END * {_S} AS d_begin,
        CASE WHEN NOT has_date THEN 2147483647 WHEN NOT has_end AND NOT has_end_time THEN b + 86400 ELSE e END * {_S}
        AS d_end FROM (SELECT o_orderkey, day + s AS b, o_orderkey % 5 <> 0 AS has_date,
          day + CASE WHEN o_orderkey % 7 = 0 THEN 86399 ELSE s END AS e, o_orderkey % 3 = 0 AS has_end,
          o_orderkey % 7 = 0 AS has_end_time FROM (SELECT o_orderkey, CASE WHEN {_EPOCH_OK} THEN {_DAY} END AS day,
            CASE WHEN o_orderkey % 2 = 0 THEN {_HMS} ELSE 0 END AS s FROM orders))""",
    ),
    "time_range_hours": (
        q_time_range_hours,
        f"""SELECT o_orderkey, CASE WHEN {_EPOCH_OK} THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z') END AS begin,
        CASE WHEN {_EPOCH_OK} THEN strftime(o_orderdate + to_hours(o_orderkey % 48), '%Y-%m-%dT%H:%M:%S.000Z') END AS end
        FROM orders""",
    ),
    "event_duration_ms": (
        q_event_duration,
        oracle("SELECT id, CASE WHEN stop_ns IS NULL THEN 0 ELSE (stop_ns - start_ns) // 1000000 END AS ms FROM v_events_meta"),
    ),
    "event_active": (
        q_event_active,
        oracle(
            f"""SELECT id, stop_ns IS NOT NULL AND start_ns + 1000000000 <= stop_ns AS active,
            coalesce(start_ns <= {NOW_NS} AND {NOW_NS} <= stop_ns, false) AS active_now FROM v_events_meta"""
        ),
    ),
}
