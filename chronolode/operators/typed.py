"""Buckets of values of any type.

A sample's value is a VARIANT. A bucket holds one signal's samples of a day in the storage of their type: DOUBLE values
stay in ``vals``, which all numeric operators read; integers are exact in ``longs``, also those beyond 2^53 and unsigned
ones, whose bits are kept; texts of few kinds and enumerated states are codes into sorted ``labels``; nested values are
JSON text. Samples of several types make a MIXED bucket of texts, each with its type. Storages not in use are NULL, so a
DOUBLE bucket takes no more room than without them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolode.functions.status import CONDITION, sample_conditions, status_runs
from chronolode.functions.values import IMAGE_OBJECT
from chronolode.operators.axis import computed, with_condition
from chronolode.operators.buckets import MAX_BUCKET_SAMPLES, bucket_groups, bucket_head, request_head, request_rows, request_tail
from chronolode.schema import CLOCK

# Type of a value -> its storage.
STORAGE = {
    "DOUBLE": "vals",
    "FLOAT": "vals",
    "INT": "longs",
    "LONG": "longs",
    "UINT": "longs",
    "ULONG": "longs",
    "TIMESTAMP": "longs",
    "BOOLEAN": "flags",
    "STRING": "labels",
    "ENUM": "labels",
    "BYTES": "blobs",
    "IMAGE": "blobs",
    "ARRAY": "nested",
    "STRUCTURE": "nested",
}
MIXED = "MIXED"
# Kinds of text up to which a bucket stores codes.
MAX_LABELS = 256


def _of(kind: Column, *storages: str) -> Column:
    return kind.isin(*[k for k, s in STORAGE.items() if s in storages])


def natural_type(v: Column) -> Column:
    """The type a value has by itself; NULL for a missing value."""
    t = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | (t == "VOID"), F.lit(None).cast("string"))
        .when(t == "STRING", "STRING")
        .when(t == "BOOLEAN", "BOOLEAN")
        .when(t == "BIGINT", "LONG")
        .when(t.startswith("DECIMAL(20,0)") & _signed(F.try_variant_get(v, "$", "decimal(20,0)")).isNotNull(), "ULONG")
        .when(t.startswith("ARRAY"), "ARRAY")
        .when(t == IMAGE_OBJECT, "IMAGE")
        .when(t.startswith("OBJECT"), "STRUCTURE")
        .when(t.startswith("TIMESTAMP"), "TIMESTAMP")
        .when(t == "BINARY", "BYTES")
        .when(t == "FLOAT", "FLOAT")
        .otherwise("DOUBLE")
    )


def _two_to(n: int) -> Column:
    return F.lit(str(1 << n)).cast("decimal(20,0)")


def _signed(d: Column) -> Column:
    """The 64 bits of an unsigned number as BIGINT; NULL for a number they do not hold."""
    bits = F.when(d < 0, F.lit(None)).when(d < _two_to(63), d).when(d < _two_to(64), d - _two_to(64))
    return bits.cast("bigint")


def _unsigned(bits: Column) -> Column:
    return F.when(bits < 0, bits.cast("decimal(20,0)") + _two_to(64)).otherwise(bits).cast("decimal(20,0)")


def _nanos(v: Column) -> Column:
    """A timestamp, or a number of nanoseconds, as BIGINT nanoseconds."""
    given = F.unix_micros(F.try_variant_get(v, "$", "timestamp")) * 1000
    return F.when(F.schema_of_variant(v).startswith("TIMESTAMP"), given).otherwise(F.try_variant_get(v, "$", "bigint"))


def _parts(v: Column, kind: Column) -> dict[str, Column]:
    """A value taken apart by storage; all but the parts of its type are NULL."""
    get = lambda path, type: F.try_variant_get(v, path, type)
    whole = F.when(kind == "ULONG", _signed(get("$", "decimal(20,0)"))).when(kind == "TIMESTAMP", _nanos(v)).otherwise(get("$", "bigint"))
    text = F.when(kind == "IMAGE", get("$.file_type", "string")).when(_of(kind, "nested"), F.to_json(v)).otherwise(get("$", "string"))
    return {
        "number": F.when(_of(kind, "vals"), get("$", "double")),
        "whole": F.when(_of(kind, "longs"), whole),
        "flag": F.when(_of(kind, "flags"), get("$", "boolean")),
        "text": F.when(_of(kind, "labels", "nested") | (kind == "IMAGE"), text),
        "blob": F.when(kind == "IMAGE", get("$.image", "binary")).when(kind == "BYTES", get("$", "binary")),
    }


def _written(s: Column) -> Column:
    """A sample of a MIXED bucket as text."""
    kind = s["kind"]
    return (
        F.when(_of(kind, "vals"), s["number"].cast("string"))
        .when(kind == "ULONG", _unsigned(s["whole"]).cast("string"))
        .when(_of(kind, "longs"), s["whole"].cast("string"))
        .when(_of(kind, "flags"), s["flag"].cast("string"))
        .when(kind == "IMAGE", F.concat(s["text"], F.lit(" "), F.base64(s["blob"])))
        .when(kind == "BYTES", F.base64(s["blob"]))
        .otherwise(s["text"])
    )


def typed_buckets(samples: DataFrame, max_samples: int = MAX_BUCKET_SAMPLES) -> DataFrame:
    """Samples (pv, ts_ns, value VARIANT) as buckets of one signal and UTC day in the storage of their type.

    A column ``data_type`` states types that a value does not show (ENUM, INT, UINT, TIMESTAMP in nanoseconds); a value
    that does not fit its stated type is missing. Columns severity, status and message are stored as runs. Missing values
    have no type and fit any bucket. Days above ``max_samples`` are cut by time.
    """
    stated = F.coalesce(F.col("data_type"), natural_type(F.col("value"))) if "data_type" in samples.columns else natural_type(F.col("value"))
    status = [c for c in CONDITION if c in samples.columns]
    rows = samples.select("pv", "ts_ns", stated.alias("kind"), "value", *status)
    absent = {c: F.lit(None).cast("string" if c == "message" else "int") for c in CONDITION if c not in status}
    parts = _parts(F.col("value"), F.col("kind"))
    rows = rows.select("pv", "ts_ns", "kind", *(c.alias(n) for n, c in parts.items()), *status, *(c.alias(n) for n, c in absent.items()))
    order = ["ts_ns", "kind", *parts, *CONDITION]
    keyed, groups = bucket_groups(rows, max_samples, order)
    packed = keyed.groupBy(*groups).agg(F.array_sort(F.collect_list(F.struct(*order))).alias("__s"), F.collect_set("kind").alias("__kinds"))
    return _stored(packed, bucket_head(groups), [F.col("day")])


def typed_request_buckets(requests: DataFrame) -> DataFrame:
    """One bucket per column of every request; no shuffle.

    Columns are ``struct<name, values array<struct<value VARIANT, data_type, severity, status, message>>>``.
    """

    def taken_apart(x: Column) -> Column:
        kind = F.coalesce(x["data_type"], natural_type(x["value"]))
        parts = _parts(x["value"], kind) | {c: x[c] for c in CONDITION}
        return F.struct(kind.alias("kind"), *(c.alias(n) for n, c in parts.items()))

    rows = request_rows(requests)
    packed = computed(rows, __s=F.transform("c.values", taken_apart))
    packed = packed.withColumn("__kinds", F.array_distinct(F.array_compact(F.col("__s.kind"))))
    return _stored(packed, request_head(), request_tail())


def _stored(packed: DataFrame, head: list[Column], tail: list[Column]) -> DataFrame:
    """Buckets from samples taken apart (``__s``) and the types that occur among them (``__kinds``)."""
    s = F.col("__s")
    packed = computed(packed, data_type=F.when(F.size("__kinds") > 1, MIXED).otherwise(F.coalesce(F.get("__kinds", 0), F.lit("DOUBLE"))))
    kind, mixed = F.col("data_type"), F.col("data_type") == MIXED
    coded = F.when(mixed, s["kind"]).otherwise(s["text"])
    packed = computed(packed, __kinds_of=F.array_sort(F.array_distinct(F.array_compact(coded))))
    few = F.size("__kinds_of") <= MAX_LABELS
    texts = _of(kind, "labels") | mixed | (kind == "IMAGE")
    codes = F.transform(coded, lambda t: F.nullif(F.array_position("__kinds_of", t).cast("int"), F.lit(0)) - 1)
    return packed.select(
        *head,
        "data_type",
        F.when(_of(kind, "vals"), s["number"]).alias("vals"),
        F.when(_of(kind, "longs"), s["whole"]).alias("longs"),
        F.when(_of(kind, "flags"), s["flag"]).alias("flags"),
        F.when(texts & few, codes).alias("codes"),
        F.when(texts & few, F.col("__kinds_of")).when(texts, coded).alias("labels"),
        F.when(_of(kind, "blobs"), s["blob"]).alias("blobs"),
        F.when(_of(kind, "nested"), s["text"]).when(mixed, F.transform(s, _written)).alias("nested"),
        status_runs(s).alias("status_runs"),
        *tail,
    )


def _labelled(i: Column) -> Column:
    """The text of a sample: by its code, or where a bucket has none, as it stands."""
    return F.when(F.col("codes").isNull(), F.get("labels", i)).otherwise(F.get("labels", F.get("codes", i)))


def _value(kind: Column, i: Column) -> Column:
    """Sample ``i`` of a bucket as VARIANT."""
    text = F.get("nested", i)

    def variant(c: Column) -> Column:
        return c.cast("variant")

    def image(name: Column, data: Column) -> Column:
        return F.to_variant_object(F.struct(name.alias("file_type"), data.alias("image")))

    whole, label = F.get("longs", i), _labelled(i)
    return (
        F.when(_of(kind, "vals"), variant(F.get("vals", i)))
        .when(kind == "ULONG", variant(_unsigned(whole)))
        .when(_of(kind, "longs"), variant(whole))
        .when(_of(kind, "flags"), variant(F.get("flags", i)))
        .when(_of(kind, "labels"), variant(label))
        .when((kind == "IMAGE") & F.get("blobs", i).isNotNull(), image(label, F.get("blobs", i)))
        .when(kind == "BYTES", variant(F.get("blobs", i)))
        .when(_of(kind, "nested"), F.try_parse_json(text))
        .when(kind == MIXED, _read(label, text))
    )


def _read(kind: Column, text: Column) -> Column:
    """The value that :func:`_written` wrote."""
    variant = lambda c: c.cast("variant")
    data = F.unbase64(F.element_at(F.split(text, " "), -1))
    picture = F.to_variant_object(F.struct(F.get(F.split(text, " "), 0).alias("file_type"), data.alias("image")))
    return (
        F.when(_of(kind, "vals"), variant(text.try_cast("double")))
        .when(kind == "ULONG", variant(text.try_cast("decimal(20,0)")))
        .when(_of(kind, "longs"), variant(text.try_cast("bigint")))
        .when(_of(kind, "flags"), variant(text.try_cast("boolean")))
        .when(kind == "BYTES", variant(data))
        .when((kind == "IMAGE") & text.isNotNull(), picture)
        .when(_of(kind, "nested"), F.try_parse_json(text))
        .otherwise(variant(text))
    )


def typed_samples(buckets: DataFrame, *keep: str) -> DataFrame:
    """``keep..., pos, ts_ns, data_type, value VARIANT, severity, status, message`` of buckets of any type.

    Instants (TIMESTAMP) are BIGINT nanoseconds. ``data_type`` is that of the sample, in MIXED buckets too.
    """
    ready = computed(buckets, __conditions=sample_conditions(F.col("status_runs")))
    i = F.col("pos")
    rows = ready.select("*", F.explode(F.sequence(F.lit(0), F.col("sample_count").cast("int") - 1)).alias("pos"))
    instant = F.when(F.col("ts_kind") == CLOCK, F.col("first_ns") + i.cast("bigint") * F.col("period_ns")).otherwise(F.get("ts_ns", i))
    kind = F.col("data_type")
    rows = rows.select(
        *keep,
        "pos",
        instant.alias("ts_ns"),
        F.when(kind == MIXED, _labelled(i)).otherwise(kind).alias("data_type"),
        _value(kind, i).alias("value"),
        "__conditions",
    )
    return with_condition(rows)
