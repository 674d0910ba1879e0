"""Column functions over instants (BIGINT nanoseconds) and signal time axes.

No function depends on the session time zone: wall-clock text is read in an
explicit zone, and text is printed in UTC by integer arithmetic.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronolode.schema import NS_PER_DAY, NS_PER_SEC

# Bounds of a plausible instant, and the widest dataset window.
MAX_EPOCH_SEC = 4_102_444_800
WIDEST_WINDOW_SEC = (1, 2_147_483_647)

MIN_PERIOD_NS = 100
MAX_PERIOD_NS = 10_000_000_000


def div(a, b) -> Column:
    """Integer division truncating toward zero."""
    return F.call_function("div", F.lit(a).cast("bigint"), F.lit(b).cast("bigint"))


def epoch_us(ts: Column) -> Column:
    """Microseconds since the epoch of a wall-clock column read as UTC."""
    return F.unix_micros(F.from_utc_timestamp(ts.cast("timestamp"), F.current_timezone()))


def seconds_part(ns: Column) -> Column:
    return div(ns, NS_PER_SEC)


def nanos_part(ns: Column) -> Column:
    return ns - seconds_part(ns) * F.lit(NS_PER_SEC)


def day_of(ns: Column) -> Column:
    """UTC calendar day of an instant."""
    return F.date_from_unix_date(div(ns, NS_PER_DAY).cast("int"))


# --- conversions -----------------------------------------------------------


def ts_diff_ms(start: Column, end: Column) -> Column:
    """Whole milliseconds between instants, the nanosecond part truncated on its own."""
    sec = seconds_part(end) - seconds_part(start)
    return sec * 1000 + div(nanos_part(end) - nanos_part(start), 1_000_000)


def ts_seconds(ns: Column) -> Column:
    return seconds_part(ns).cast("double") + nanos_part(ns).cast("double") / F.lit(1e9)


def ts_from_seconds(seconds: Column) -> Column:
    whole = F.floor(seconds).cast("bigint")
    return whole * F.lit(NS_PER_SEC) + F.floor((seconds - whole) * F.lit(1e9)).cast("bigint")


def ts_iso(ns: Column, digits: int = 9) -> Column:
    """``YYYY-MM-DDTHH:MM:SS.fffZ`` in UTC, with ``digits`` decimals (truncated)."""
    sec = seconds_part(ns)
    in_day = sec % 86_400

    def two(n):
        return F.lpad(n.cast("string"), 2, "0")

    fraction = F.lpad(nanos_part(ns).cast("string"), 9, "0").substr(1, digits)
    return F.concat(
        day_of(ns).cast("string"),
        F.lit("T"),
        two(div(in_day, 3600)),
        F.lit(":"),
        two(div(in_day, 60) % 60),
        F.lit(":"),
        two(in_day % 60),
        F.lit("."),
        fraction,
        F.lit("Z"),
    )


def ts_valid(ns: Column) -> Column:
    sec = seconds_part(ns)
    return (sec > 0) & (sec < MAX_EPOCH_SEC)


def ts_parts_valid(sec: Column, nanos: Column) -> Column:
    """The same test while seconds and nanoseconds are still separate."""
    return (sec > 0) & (sec < MAX_EPOCH_SEC) & (nanos < NS_PER_SEC)


# --- parsing dates ---------------------------------------------------------

# format name -> pattern over the date text; groups in the order given
_DATE_FORMATS = {
    "YYYYMMDD": (r"^(\d{4})(\d{2})(\d{2})$", ("y", "m", "d")),
    "MMDDYYYY": (r"^(\d{2})(\d{2})(\d{4})$", ("m", "d", "y")),
    "DDMMYYYY": (r"^(\d{2})(\d{2})(\d{4})$", ("d", "m", "y")),
    "MM-DD-YYYY": (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", ("m", "d", "y")),
}
_ISO = r"^(\d{4})-(\d{2})-(\d{2})T(\d{2}):(\d{2}):(\d{2})"
_TIME = r"^(\d{2})(\d{2})(\d{2})$"


def _int_group(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(text, pattern, group).try_cast("int")


def civil_seconds(y: Column, m: Column, d: Column, h: Column, mi: Column, s: Column, tz: str = "UTC") -> Column:
    """Epoch seconds of whole numbers of a date and time in ``tz``; NULL if not a real instant."""
    instant = F.try_make_timestamp(y, m, d, h, mi, s.cast("decimal(16,6)"), F.lit(tz))
    # second 60 would be carried over into the next minute; what else is out of range is an exception for each row
    real = (s < 60) & (mi < 60) & (h < 24) & m.between(1, 12) & d.between(1, 31)
    return F.when(real, F.unix_seconds(instant))


def parse_when(date: Column, time: Column | None = None, fmt: str = "MMDDYYYY", tz: str = "UTC") -> Column:
    """Epoch seconds of a date (and HHMMSS time) read in ``tz``; NULL if not a real instant."""
    if fmt == "ISO":
        y, m, d, h, mi, s = (_int_group(date, _ISO, i) for i in range(1, 7))
    else:
        pattern, order = _DATE_FORMATS[fmt]
        part = {key: _int_group(date, pattern, i + 1) for i, key in enumerate(order)}
        y, m, d = part["y"], part["m"], part["d"]
        clock = F.lit("000000") if time is None else time
        h, mi, s = (_int_group(clock, _TIME, i) for i in (1, 2, 3))
    return civil_seconds(y, m, d, h, mi, s, tz)


def swap_day_month(date: Column) -> Column:
    """DDMMYYYY text as MM-DD-YYYY; empty when not eight characters."""
    return F.when(
        F.length(date) == 8, F.concat_ws("-", date.substr(3, 2), date.substr(1, 2), date.substr(5, 4))
    ).otherwise(F.lit(""))


def file_timestamp(date: Column, time: Column, tz: str = "UTC") -> Column:
    """Epoch seconds of the date and time parts of a file name; 0 when unusable."""
    return F.coalesce(parse_when(date, time, "YYYYMMDD", tz), F.lit(0).cast("bigint"))


def resolve_window(
    date: Column, time: Column, end_date: Column, end_time: Column, mode: str = "query", tz: str = "UTC"
) -> Column:
    """``struct<begin_ns, end_ns>`` of a command-style window.

    ``query``: no end date means one hour, whatever the end time says.
    ``dataset``: no end at all means 24 hours; no date means the widest window.
    """
    clock = F.coalesce(time, F.lit("000000"))
    begin = parse_when(date, clock, "MMDDYYYY", tz)
    if mode == "query":
        end = F.when(end_date.isNull(), begin + 3600).otherwise(
            parse_when(end_date, F.coalesce(end_time, clock), "MMDDYYYY", tz)
        )
    elif mode == "dataset":
        end = F.when(end_date.isNull() & end_time.isNull(), begin + 86_400).otherwise(
            parse_when(F.coalesce(end_date, date), F.coalesce(end_time, clock), "MMDDYYYY", tz)
        )
        lo, hi = (F.lit(v).cast("bigint") for v in WIDEST_WINDOW_SEC)
        begin, end = F.when(date.isNull(), lo).otherwise(begin), F.when(date.isNull(), hi).otherwise(end)
    else:
        raise ValueError(f"unknown window mode {mode!r}")
    return F.struct((begin * NS_PER_SEC).alias("begin_ns"), (end * NS_PER_SEC).alias("end_ns"))


def time_range_hours(date: Column, hours: Column | int = 24, tz: str = "UTC") -> Column:
    """``struct<begin, end>`` as ISO text (milliseconds) from an MM-DD-YYYY date."""
    begin = parse_when(date, None, "MM-DD-YYYY", tz)
    span = F.lit(hours).cast("bigint") * 3600
    return F.struct(
        ts_iso(begin * NS_PER_SEC, 3).alias("begin"), ts_iso((begin + span) * NS_PER_SEC, 3).alias("end")
    )


# --- events ----------------------------------------------------------------


def event_duration_ms(start: Column, stop: Column) -> Column:
    """Milliseconds from start to stop; 0 when either is missing."""
    return F.coalesce(ts_diff_ms(start, stop), F.lit(0).cast("bigint"))


def event_active(start: Column, stop: Column, now: Column) -> Column:
    """Whether ``now`` lies within the event, both ends included."""
    return F.coalesce(now.between(start, stop), F.lit(False))


# --- time axes of signals --------------------------------------------------


def ts_combine(secs: Column, nanos: Column) -> Column:
    """Nanosecond instants of a time axis; NULL when it must be rejected."""
    zeros = F.transform(secs, lambda _: F.lit(0).cast("bigint"))
    aligned = F.coalesce(nanos, zeros)
    return F.when(
        F.size(secs) == F.size(aligned), F.zip_with(secs, aligned, lambda s, n: s * F.lit(NS_PER_SEC) + n)
    )


def instant_at(secs: Column, nanos: Column, index: Column | int) -> Column:
    """One instant of a time axis, without building the whole axis."""
    return F.get(secs, F.lit(index)) * F.lit(NS_PER_SEC) + F.coalesce(F.get(nanos, F.lit(index)), F.lit(0))


def period_first_pair(ts: Column) -> Column:
    """Gap of the first two samples in nanoseconds; one second below two samples."""
    return F.when(F.size(ts) < 2, F.lit(NS_PER_SEC)).otherwise(F.get(ts, 1) - F.get(ts, 0))


def period_whole_sec(secs: Column, guard: bool = True) -> Column:
    """Gap of the first two whole seconds; with ``guard``, implausible gaps become one second."""
    period = F.when(F.size(secs) < 2, F.lit(NS_PER_SEC)).otherwise(
        (F.get(secs, 1) - F.get(secs, 0)) * F.lit(NS_PER_SEC)
    )
    return guard_period(period) if guard else period


def guard_period(period: Column) -> Column:
    return F.when(period.between(MIN_PERIOD_NS, MAX_PERIOD_NS), period).otherwise(F.lit(NS_PER_SEC))


def regular_gaps(ts: Column, period: Column, checks: int = 10, tol: int = 1000) -> Column:
    """Whether the first ``checks`` gaps of a packed axis stay within ``tol`` of ``period``."""
    head = F.slice(ts, 1, checks + 1)
    gaps = F.zip_with(
        F.slice(head, 2, checks),
        F.slice(head, 1, checks),
        lambda later, earlier: F.abs(later - earlier - period) <= tol,
    )
    # the longer side leaves one NULL pair at the end
    return F.when(F.size(ts) < 3, F.lit(True)).otherwise(F.forall(gaps, lambda ok: F.coalesce(ok, F.lit(True))))


def time_axis(dims: Column, count: Column) -> Column:
    """0-based axis that carries time: exact length, else within 1 %, else the longest."""
    ratio = F.transform(dims, lambda d: d.cast("double") / count)
    near = F.transform(ratio, lambda r: (r > 0.99) & (r < 1.01))
    found = F.coalesce(
        F.nullif(F.array_position(dims, count), F.lit(0)),
        F.nullif(F.array_position(near, F.lit(True)), F.lit(0)),
        F.array_position(dims, F.array_max(dims)),
    )
    single_row = (F.size(dims) == 2) & (F.array_min(dims) == 1)
    # of a 1 x 1 signal the second axis wins, elsewhere the first of the longest
    tie = single_row & (F.array_max(dims) == 1) & (count != 1)
    axis = F.when(tie, F.lit(1)).otherwise(found.cast("int") - 1)
    return F.when(F.size(dims).between(1, 3), axis)


def axis_slice(vals: Column, dims: Column, axis: Column) -> Column:
    """Vector along ``axis`` at offset 0 of the others, from row-major values."""
    n = F.get(dims, axis)
    after = F.slice(dims, axis + 2, F.size(dims))
    stride = F.aggregate(after, F.lit(1).cast("bigint"), lambda acc, d: acc * d)
    # positions are laid out once; inside the lambda nothing but the lookup is left
    positions = F.sequence(F.lit(0).cast("bigint"), (n - 1) * stride, stride)
    picked = F.transform(positions, lambda i: F.get(vals, i.cast("int")))
    return F.when((n < 1) | (stride < 1), F.slice(vals, 1, 0)).when(stride == 1, F.slice(vals, 1, n.cast("int"))).otherwise(
        picked
    )


def numeric_cascade(raw: Column) -> Column:
    """Every element as DOUBLE; what is not a number becomes NaN, never dropped."""
    return F.transform(raw, lambda x: F.coalesce(x.try_cast("double"), F.lit(float("nan"))))


# --- sampling clocks -------------------------------------------------------


def clock_frequency_hz(period: Column) -> Column:
    return F.when(period == 0, F.lit(0.0)).otherwise(F.lit(1e9) / period)


def clock_duration_ns(period: Column, count: Column) -> Column:
    """Span of the clock; NULL for an empty one."""
    return F.when(count > 0, period * (count - 1))
