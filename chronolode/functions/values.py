"""Column functions over attributes, heterogeneous values, structures, arrays and images."""

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")

# Image file types in their numeric order, with MIME type and extension.
IMAGE_TYPES = [
    ("RAW", "application/octet-stream", ".raw"),
    ("JPEG", "image/jpeg", ".jpg"),
    ("GIF", "image/gif", ".gif"),
    ("TIFF", "image/tiff", ".tiff"),
    ("BMP", "image/bmp", ".bmp"),
    ("PNG", "image/png", ".png"),
    ("EPS", "application/postscript", ".eps"),
    ("SVG", "image/svg+xml", ".svg"),
    ("PDF", "application/pdf", ".pdf"),
]
# Printed name of each result status.
RESULT_LABELS = {"REJECT": "REJECTED", "ERROR": "ERROR", "EMPTY": "EMPTY", "NOT_READY": "NOT_READY"}


# --- attributes: array<struct<key, value>> --------------------------------


def last_wins(pairs: Column) -> Column:
    """Drop pairs whose key comes again later, so that the last one wins."""
    return F.filter(
        pairs,
        lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]),
    )


def attr_to_map(pairs: Column) -> Column:
    return F.map_from_entries(last_wins(pairs))


def map_to_attr(mapping: Column) -> Column:
    """Pairs of a map ordered by key."""
    return F.array_sort(F.map_entries(mapping))


def attr_find(pairs: Column, name: Column | str) -> Column:
    """Value of the first pair with this key, else NULL."""
    return F.get(F.filter(pairs, lambda p: p["key"] == F.lit(name)), 0)["value"]


def attr_upsert(pairs: Column, name: Column | str, value: Column | str) -> Column:
    """Set the first pair with this key, or append a new one."""
    at = F.array_position(F.transform(pairs, lambda p: p["key"]), F.lit(name))
    new = F.struct(F.lit(name).alias("key"), F.lit(value).alias("value"))
    return F.when(at == 0, F.concat(pairs, F.array(new))).otherwise(
        F.transform(pairs, lambda p, i: F.when(i + 1 == at, new).otherwise(p))
    )


# --- heterogeneous values: VARIANT ----------------------------------------


IMAGE_OBJECT = "OBJECT<file_type: STRING, image: BINARY>"


def _variant_type(v: Column) -> Column:
    return F.schema_of_variant(v)


def value_kind(v: Column) -> Column:
    """string, numeric, bool, array, structure, image, timestamp, bytes or none.

    An image is an object of a file type and binary data alone.
    """
    t = _variant_type(v)
    return (
        F.when(v.isNull() | (t == "VOID"), "none")
        .when(t == "STRING", "string")
        .when(t == "BOOLEAN", "bool")
        .when(t.startswith("ARRAY"), "array")
        .when(t == IMAGE_OBJECT, "image")
        .when(t.startswith("OBJECT"), "structure")
        .when(t.startswith("TIMESTAMP") | (t == "DATE"), "timestamp")
        .when(t == "BINARY", "bytes")
        .otherwise("numeric")
    )


def value_is_set(v: Column) -> Column:
    return value_kind(v) != "none"


def value_as_double(v: Column, on_other: str = "nan") -> Column:
    """A numeric value as DOUBLE; any other kind NaN (statistics) or NULL (lookup)."""
    number = F.when(value_kind(v) == "numeric", F.try_variant_get(v, "$", "double"))
    return F.coalesce(number, F.lit(NAN)) if on_other == "nan" else number


def value_as_string(v: Column) -> Column:
    return F.when(value_kind(v) == "string", F.try_variant_get(v, "$", "string"))


def value_as_bool(v: Column) -> Column:
    return F.when(value_kind(v) == "bool", F.try_variant_get(v, "$", "boolean"))


def value_status(value: Column, status_code: Column, severity: Column, message: Column) -> Column:
    """``struct<value, status>``; no status where neither code nor message is given."""
    status = F.struct(
        message.alias("message"), status_code.alias("status_code"), severity.alias("severity")
    )
    given = status_code.isNotNull() | message.isNotNull()
    return F.struct(value.alias("value"), F.when(given, status).alias("status"))


def has_status(v: Column) -> Column:
    return v["status"].isNotNull()


# --- structures: array<struct<key, value>>, order and duplicates kept ------


def struct_get(fields: Column, name: Column | str) -> Column:
    """Value of the first field with this name."""
    return attr_find(fields, name)


def struct_has(fields: Column, name: Column | str) -> Column:
    return F.exists(fields, lambda f: f["key"] == F.lit(name))


def struct_names(fields: Column) -> Column:
    return F.transform(fields, lambda f: f["key"])


def struct_to_map(fields: Column) -> Column:
    return attr_to_map(fields)


def map_to_struct(mapping: Column) -> Column:
    return map_to_attr(mapping)


def json_fields(text: Column) -> Column:
    """Fields of a JSON object as ``array<struct<key, value>>``; none for bad text."""
    pairs = F.map_entries(F.from_json(text, "map<string,string>"))
    return F.coalesce(pairs, F.array().cast("array<struct<key:string,value:string>>"))


# --- arrays ----------------------------------------------------------------


def array_size(a: Column) -> Column:
    return F.size(a)


def array_get(a: Column, index: Column | int) -> Column:
    """Element by 0-based index; NULL out of range."""
    return F.get(a, F.lit(index))


def array_slice(a: Column, start: Column | int, end: Column | int) -> Column:
    """Elements at positions ``start`` to before ``end``, cut at the array's end."""
    lo, hi = F.lit(start), F.least(F.lit(end), F.size(a))
    return F.slice(a, lo + 1, F.greatest(hi - lo, F.lit(0)))


# --- images ----------------------------------------------------------------


def image_info(image: Column, file_type: Column) -> Column:
    """``struct<mime, ext, bytes, valid>`` of an image."""
    names = F.array(*[F.lit(n) for n, _, _ in IMAGE_TYPES])
    at = F.array_position(names, file_type).cast("int") - 1

    def pick(k):
        return F.coalesce(F.get(F.array(*[F.lit(t[k]) for t in IMAGE_TYPES]), at), F.lit(IMAGE_TYPES[0][k]))

    return F.struct(
        pick(1).alias("mime"),
        pick(2).alias("ext"),
        F.octet_length(image).alias("bytes"),
        (at >= 0).alias("valid"),
    )


# --- records and results ---------------------------------------------------


def json_render(record: Column) -> Column:
    """JSON text of a record, unset fields printed too."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def json_parse(text: Column, schema: str) -> Column:
    """``struct<ok, record>``; text that is no JSON object gives ok = false."""
    ok = F.try_parse_json(text).isNotNull() & text.rlike(r"^\s*\{")
    return F.struct(ok.alias("ok"), F.when(ok, F.from_json(text, schema)).alias("record"))


def result_status(status: Column, message: Column) -> Column:
    label = F.lit("UNKNOWN")
    for code, name in RESULT_LABELS.items():
        label = F.when(status == code, F.lit(name)).otherwise(label)
    return F.concat(label, F.lit(": "), message)


def is_error(status: Column) -> Column:
    return status == "ERROR"


def is_empty(status: Column) -> Column:
    return status == "EMPTY"


def text_match(query: str, *fields: Column) -> Column:
    """Whether any word of ``query`` is a word of any field, case ignored.

    One regular expression per field: the text is scanned once and no word
    list is built for it.
    """
    import re

    words = sorted({w for w in re.split(r"\W+", query.lower(), flags=re.ASCII) if w})
    if not words:
        return F.lit(False)
    pattern = r"(^|\W)(" + "|".join(map(re.escape, words)) + r")(\W|$)"
    hit = F.lit(False)
    for field in fields:
        hit = hit | F.coalesce(F.lower(field).rlike(pattern), F.lit(False))
    return hit
