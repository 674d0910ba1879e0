"""Annotations on datasets, their links and calculations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolode.functions.values import text_match
from chronolode.schema import CLOCK


def annotations_query(
    annotations: DataFrame,
    id=None,
    owner: str | None = None,
    dataset=None,
    annotation=None,
    text: str | None = None,
    tag: str | None = None,
    attr: tuple[str, str] | None = None,
) -> DataFrame:
    """All given criteria must hold; none given means all."""
    out = annotations
    if id is not None:
        out = out.where(F.col("annotation_id") == id)
    if owner is not None:
        out = out.where(F.col("owner") == owner)
    if dataset is not None:
        out = out.where(F.array_contains("dataset_ids", dataset))
    if annotation is not None:
        out = out.where(F.array_contains("annotation_ids", annotation))
    if tag is not None:
        out = out.where(F.array_contains("tags", tag))
    if attr is not None:
        out = out.where(F.col("attributes")[attr[0]] == attr[1])
    if text is not None:  # last: it reads the whole text
        out = out.where(text_match(text, F.col("name"), F.col("comment"), F.col("event_description")))
    return out


def annotation_datasets(annotations: DataFrame, datasets: DataFrame) -> DataFrame:
    """One row per annotation and dataset with the dataset's content.

    Rows instead of a list per annotation: nothing is collected, and the join
    keeps annotations whose dataset is unknown.
    """
    refs = annotations.select(
        "annotation_id", F.posexplode_outer("dataset_ids").alias("position", "dataset_id")
    )
    content = datasets.select(
        "dataset_id", F.col("name").alias("dataset_name"), F.col("owner").alias("dataset_owner"), "description", "blocks"
    )
    return refs.join(content, "dataset_id", "left")


def annotation_links(annotations: DataFrame, id=None) -> DataFrame:
    """``annotation_id, linked_by``: who refers to an annotation, one hop; of all when no id is given."""
    refs = annotations.select(
        F.explode("annotation_ids").alias("target"), F.col("annotation_id").alias("linked_by")
    )
    if id is not None:
        refs = refs.where(F.col("target") == id)
    known = annotations.select(F.col("annotation_id").alias("target"))
    return refs.join(known, "target", "left_semi").select(F.col("target").alias("annotation_id"), "linked_by")


def _with_unknown(rows: DataFrame, column: str, table: DataFrame, id: str) -> DataFrame:
    """Ids made for rows that refer, in a list column, to something ``table`` lacks."""
    refs = rows.select("__made", F.explode(column).alias("__ref")).distinct()
    known = table.select(F.col(id).alias("__ref")).distinct()
    return refs.join(known, "__ref", "left_anti").select("__made").distinct()


def create_annotations(
    incoming: DataFrame, datasets: DataFrame | None = None, annotations: DataFrame | None = None
) -> DataFrame:
    """Add ``annotation_id``, ``status`` and ``message``: owner, name and a dataset are required.

    With the tables of datasets and annotations, what an annotation refers to
    must be there. The id is a hash of all fields given.
    """

    def blank(c):
        return F.col(c).isNull() | (F.col(c) == "")

    fault = (
        F.when(blank("owner"), "owner missing")
        .when(blank("name"), "name missing")
        .when(F.coalesce(F.size("dataset_ids"), F.lit(0)) < 1, "no datasets")
    )
    # every field that is given, so that different annotations never share an id
    given = [c for c in sorted(incoming.columns) if c not in ("annotation_id", "status", "message")]
    made = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in given]), {"ignoreNullFields": "false"}), 256)
    rows = incoming.withColumn("__made", made)
    for column, table, id in (("dataset_ids", datasets, "dataset_id"), ("annotation_ids", annotations, "annotation_id")):
        if table is not None:
            unknown = _with_unknown(rows, column, table, id).withColumn("__unknown", F.lit(True))
            rows = rows.join(unknown, "__made", "left")
            fault = fault.when(F.col("__unknown"), F.lit(f"unknown {id.removesuffix('_id')}"))
            rows = rows.withColumn("message", F.coalesce(fault, F.lit(""))).drop("__unknown")
            fault = F.when(F.col("message") != "", F.col("message"))
    return (
        rows.withColumn("message", F.coalesce(fault, F.lit("")))
        .withColumn("status", F.when(F.col("message") == "", "CREATED").otherwise("REJECT"))
        .withColumn("annotation_id", F.when(F.col("status") == "CREATED", F.col("__made")))
        .drop("__made")
    )


def calculation_frames(calculations: DataFrame) -> DataFrame:
    """``calc_id, frame, column, pos, ts_ns, value``; a frame whose columns differ in length is left out."""
    frames = calculations.select("calc_id", F.explode("frames").alias("f"))
    ts = F.col("f.ts")
    n = F.when(ts["kind"] == CLOCK, ts["count"]).otherwise(F.size(ts["ts_ns"]))
    whole = frames.where(F.forall("f.columns", lambda c: F.size(c["vals"]) == n))
    columns = whole.select("calc_id", F.col("f.name").alias("frame"), ts.alias("ts"), F.explode("f.columns").alias("c"))
    rows = columns.select(
        "calc_id", "frame", F.col("c.name").alias("column"), "ts", F.posexplode("c.vals").alias("pos", "value")
    )
    instant = F.when(
        F.col("ts.kind") == CLOCK, F.col("ts.start_ns") + F.col("pos").cast("bigint") * F.col("ts.period_ns")
    ).otherwise(F.get("ts.ts_ns", F.col("pos")))
    return rows.select("calc_id", "frame", "column", "pos", instant.alias("ts_ns"), "value")
