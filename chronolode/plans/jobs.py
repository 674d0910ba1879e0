"""End-to-end jobs: statistics of a window, directory import, archive import, dataset export."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolode.functions.archive import is_finite, mask_invalid, point_valid
from chronolode.functions.names import parse_file_lenient, parse_pv_split
from chronolode.functions.timestamps import axis_slice, div, guard_period, instant_at, time_axis
from chronolode.operators import files
from chronolode.operators.archive import archive_attributes
from chronolode.operators.axis import computed
from chronolode.operators.buckets import query_samples
from chronolode.operators.stats import FILE_TAGS, pv_statistics
from chronolode.schema import CLOCK, LIST, NS_PER_SEC
from chronolode.sources.archive_json import described, parse_answers


def statistics_of_window(
    buckets: DataFrame,
    begin_ns: int,
    end_ns: int,
    pvs: list[str] | None = None,
    pattern: str | None = None,
    max_span_days: int | None = None,
) -> DataFrame:
    """Statistics per signal in a window."""
    return pv_statistics(query_samples(buckets, begin_ns, end_ns, pvs, pattern, False, max_span_days))


def _text(value: Column) -> Column:
    return value.cast("string")


def _attributes(pairs: dict[str, Column]) -> Column:
    return F.map_from_arrays(F.array(*map(F.lit, pairs)), F.array(*pairs.values()))


def import_checks(
    raw: DataFrame,
    manifest: DataFrame | None = None,
    min_file_bytes: int | None = None,
    max_file_bytes: int | None = None,
    max_objects: int | None = None,
    max_samples: int | None = None,
) -> DataFrame:
    """Decoded datasets with ``reason``, empty where the dataset can be imported, and the axis of its time.

    Every dataset stays, so accepted and refused ones add up to the input. A
    limit that is not given does not apply. All tests use sizes and
    dimensions; no array of values is touched.
    """
    secs, nanos, dims = F.col("secs"), F.col("nanos"), F.col("dims")
    count = F.size(secs)
    if manifest is None:
        raw = raw.withColumn("__done", F.lit(False))
    else:
        done = manifest.select("path").distinct().withColumn("__done", F.lit(True))
        raw = raw.join(done, "path", "left").withColumn("__done", F.coalesce("__done", F.lit(False)))
    signals = computed(raw, __axis=time_axis(dims, count.cast("bigint")))

    def above(column: Column, most: int | None) -> Column:
        return F.lit(False) if most is None else column > most

    reason = (
        F.when(F.col("__done"), "file imported before")
        .when(files.size_fault(min_file_bytes, max_file_bytes).isNotNull(), files.size_fault(min_file_bytes, max_file_bytes))
        .when(F.col("signal_name").isin(*files.TIME_DATASETS), "time, not a signal")
        .when(above(F.col("n_objects"), max_objects), "too many objects")
        .when(secs.isNull(), "no time axis")
        .when(nanos.isNotNull() & (F.size(nanos) != count), "seconds and nanoseconds differ")
        .when(count < 1, "no samples")
        .when(above(count, max_samples), "too many samples")
        .when(~F.coalesce(F.get(dims, F.col("__axis")) == count, F.lit(False)), "no dimension fits the time axis")
    )
    return signals.withColumn("reason", F.coalesce(reason, F.lit(""))).drop("__done")


def import_rejects(raw: DataFrame, manifest: DataFrame | None = None, **limits: int | None) -> DataFrame:
    """``path, signal_name, reason`` of the datasets that ``import_requests`` leaves out."""
    return import_checks(raw, manifest, **limits).where(F.col("reason") != "").select("path", "signal_name", "reason")


def import_requests(
    raw: DataFrame, provider_id: str, received_ns: int, manifest: DataFrame | None = None, **limits: int | None
) -> DataFrame:
    """Decoded signal files as ingest requests, one per signal; ``import_rejects`` has what is left out and why.

    ``limits`` are those of ``import_checks``. Arrays of accepted signals are
    built once.
    """
    secs, nanos, dims = F.col("secs"), F.col("nanos"), F.col("dims")
    count = F.size(secs)
    signals = import_checks(raw, manifest, **limits).where(F.col("reason") == "")
    start, last = instant_at(secs, nanos, 0), instant_at(secs, nanos, count - 1)
    period = F.when(count < 2, F.lit(NS_PER_SEC)).otherwise(instant_at(secs, nanos, 1) - start)
    signals = computed(signals, __vals=axis_slice(F.col("vals"), dims, F.col("__axis")))
    signals = computed(
        signals,
        __nan=F.size(F.filter("__vals", F.isnan)),
        __valid=F.size(F.filter("__vals", is_finite)),
        __n=F.size("__vals"),
        __file=parse_file_lenient(F.col("path")),
        __pv=parse_pv_split(F.col("signal_name")),
    )
    nan, valid, n = F.col("__nan"), F.col("__valid"), F.col("__n")
    inf = n - nan - valid
    always = {
        "pv_name": F.col("signal_name"),
        "source_file": F.col("path"),
        "sample_count": _text(n),
        "beam_line": F.col("__file.beam_line"),
        "acquisition_date": F.col("__file.date"),
        "acquisition_time": F.col("__file.time_id"),
        "valid_samples": _text(valid),
        "nan_samples": _text(nan),
        "inf_samples": _text(inf),
        "data_quality_ratio": F.format_string("%.6f", valid / n),
    }
    named = {k: F.col(f"__pv.{k}") for k in ("device_type", "device_area", "device_location", "measurement_type")}
    quality = [
        F.when(nan > 0, F.lit("contains_nan")),
        F.when(inf > 0, F.lit("contains_inf")),
        F.when(valid == n, F.lit("all_valid")),
    ]
    return signals.select(
        F.sha2(F.concat_ws("\x1f", "path", "signal_name"), 256).alias("request_id"),
        F.lit(provider_id).alias("provider_id"),
        F.col("path").alias("stream_id"),
        F.array_compact(F.array(*map(F.lit, FILE_TAGS), *quality)).alias("tags"),
        F.when(F.col("__pv.valid"), _attributes(always | named)).otherwise(_attributes(always)).alias("attributes"),
        F.struct(
            F.concat(F.lit("H5: "), F.col("signal_name")).alias("description"),
            start.alias("start_ns"),
            last.alias("stop_ns"),
        ).alias("event"),
        F.struct(
            F.lit(CLOCK).alias("kind"),
            start.alias("start_ns"),
            guard_period(period).alias("period_ns"),
            count.cast("bigint").alias("count"),
            F.lit(None).cast("array<bigint>").alias("ts_ns"),
        ).alias("ts"),
        F.array(F.struct(F.col("signal_name").alias("name"), F.col("__vals").alias("vals"))).alias("columns"),
        F.lit(received_ns).cast("bigint").alias("received_ns"),
    )


def archive_requests(
    answers: DataFrame, provider_id: str, received_ns: int, column: str = "payload", clock: bool = True
) -> DataFrame:
    """Archiver answers as ingest requests: points masked, metadata and quality as attributes and tags.

    An answer is one row and stays one: it is parsed once, and its points and its own metadata are used where they were
    read, in the order given. With ``clock`` the time axis is the clock of the
    mean period, else the list of all instants.
    """
    points = F.col("__points")
    parsed = parse_answers(answers, column)
    packed = computed(parsed.select("pv", "error", "meta", F.col("points").alias("__p")), __points=F.col("__p"))
    packed = packed.where((F.col("error") == "") & (F.size(points) > 0))
    packed = archive_attributes(described(packed)).withColumn("__enums", F.size("enums") > 0)
    packed = computed(
        packed,
        __n=F.size(points),
        __valid=F.size(F.filter(points, lambda p: point_valid(p["val"], p["severity"]))),
        __alarms=F.size(F.filter(points, lambda p: p["severity"] > 0)),
        __first=F.get(points, 0)["ts_ns"],
        __last=F.element_at(points, -1)["ts_ns"],
    )
    n, first, last = F.col("__n"), F.col("__first"), F.col("__last")
    pct = F.col("__valid") / n * 100
    figures = {
        "data_valid_count": _text(F.col("__valid")),
        "data_total_count": _text(n),
        "data_valid_percentage": F.format_string("%.6f", pct),
        "data_alarm_count": _text(F.col("__alarms")),
        "has_enums": _text(F.col("__enums")),
    }
    tags = [
        F.lit("archiver_data"),
        F.lit("epics_data"),
        F.concat(F.lit("device_"), F.col("attributes")["device"]),
        F.concat(F.lit("project_"), F.col("attributes")["project"]),
        F.when(F.col("__enums"), F.lit("has_enums")),
        F.when(F.col("__alarms") > 0, F.lit("has_alarms")),
        F.when(pct > 90, F.lit("high_quality_data")),
        F.when(pct < 10, F.lit("low_quality_data")),
    ]
    period = F.when(n > 1, div(last - first, F.greatest(n - 1, F.lit(1)))).otherwise(F.lit(NS_PER_SEC))
    instants = F.transform(points, lambda p: p["ts_ns"])
    return packed.select(
        F.sha2(F.concat_ws("\x1f", F.col("pv"), _text(first)), 256).alias("request_id"),
        F.lit(provider_id).alias("provider_id"),
        F.lit("archive").alias("stream_id"),
        F.array_compact(F.array(*tags)).alias("tags"),
        F.map_concat("attributes", _attributes(figures)).alias("attributes"),
        F.struct(
            F.concat(F.lit("EPICS Archiver Data: "), F.col("pv")).alias("description"),
            first.alias("start_ns"),
            last.alias("stop_ns"),
        ).alias("event"),
        F.struct(
            F.lit(CLOCK if clock else LIST).alias("kind"),
            first.alias("start_ns"),
            (period if clock else F.lit(0).cast("bigint")).alias("period_ns"),
            n.cast("bigint").alias("count"),
            (F.lit(None).cast("array<bigint>") if clock else instants).alias("ts_ns"),
        ).alias("ts"),
        F.array(
            F.struct(
                F.col("pv").alias("name"),
                F.transform(points, lambda p: mask_invalid(p["val"], p["severity"])).alias("vals"),
            )
        ).alias("columns"),
        F.lit(received_ns).cast("bigint").alias("received_ns"),
    )
