"""Signal files of any format, by a parse function the user brings.

Spark lists and reads the files, so they may lie in any store it has a connector for. Each file is parsed by itself in an
executor task and yields ``raw_signals``; a file that cannot be parsed, or a signal that does not fit the schema, becomes
a reject with its reason and never ends the job.
"""

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolode import schema
from chronolode.session import cut_lineage

#: A parse function takes a file's path and bytes and gives its signals, each a dict of columns of ``raw_signals``.
Parse = Callable[[str, bytes], Iterable[dict]]

_REASON = T.StructField("reason", T.StringType())
_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("file_bytes", pa.int64()),
        ("n_objects", pa.int32()),
        ("signal_name", pa.string()),
        ("label", pa.string()),
        ("matlab_class", pa.string()),
        ("dims", pa.list_(pa.int64())),
        ("secs", pa.list_(pa.int64())),
        ("nanos", pa.list_(pa.int64())),
        ("vals", pa.list_(pa.float64())),
        ("reason", pa.string()),
    ]
)


def _rows(parse: Parse, path: str, size: int, content: bytes) -> Iterator[dict]:
    """A file's signals as far as they can be read, and a row with a reason for what cannot."""
    known = {"path": path, "file_bytes": size}
    try:
        for signal in parse(path, content):
            extra = set(signal) - set(_ARROW.names)
            if extra or not signal.get("signal_name"):
                yield known | {"reason": f"unknown columns {sorted(extra)}" if extra else "signal without a name"}
            else:
                yield {k: v for k, v in signal.items() if k != "reason"} | known
    except Exception as error:  # whatever a parser throws is about this file
        yield known | {"reason": f"{type(error).__name__}: {error}"[:500]}


def _parsed(parse: Parse):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):  # one file's signals at a time
                path, size, content = (batch.column(i)[at].as_py() for i in range(3))
                for row in _rows(parse, path, size, content):
                    try:
                        yield pa.RecordBatch.from_pylist([row], schema=_ARROW)
                    except (pa.ArrowException, TypeError, ValueError, OverflowError) as error:
                        bad = {"path": path, "file_bytes": size, "signal_name": str(row.get("signal_name")), "reason": f"{type(error).__name__}: {error}"[:500]}
                        yield pa.RecordBatch.from_pylist([bad], schema=_ARROW)

    return run


def read_signal_files(spark: SparkSession, paths: str | list[str], parse: Parse, pattern: str | None = None, keep: bool = True) -> tuple[DataFrame, DataFrame]:
    """``raw_signals`` of all files below ``paths`` that match the glob ``pattern``, and the rejects ``path, file_bytes,
    signal_name, reason``.

    Files are dealt to tasks by their sizes; one file is held at a time and is bounded by what Spark reads as one value
    (2 GB). With ``keep`` the parsed signals are written once to the checkpoint folder, as both results come from them;
    without it, each result parses the files anew.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(paths).select("path", F.col("length").alias("file_bytes"), "content")
    parsed = files.mapInArrow(_parsed(parse), T.StructType([*schema.RAW_SIGNALS.fields, _REASON]))
    if keep:
        parsed = cut_lineage(parsed)
    good = parsed.where("reason IS NULL").drop("reason")
    return good, parsed.where("reason IS NOT NULL").select("path", "file_bytes", "signal_name", "reason")


def parse_archive_answer(path: str, content: bytes) -> Iterator[dict]:
    """A parser for files that hold an archiver's JSON answer: one signal with its points."""
    import json

    answer = json.loads(content)
    if not isinstance(answer, list) or not answer:
        raise ValueError("an answer is a list with one entry at least")
    meta, points = answer[0].get("meta", {}), answer[0].get("data", [])
    number = lambda x: float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else float("nan")
    yield {
        "n_objects": len(answer),
        "signal_name": meta.get("name"),
        "label": meta.get("DESC"),
        "dims": [len(points)],
        "secs": [p.get("secs", 0) for p in points],
        "nanos": [p.get("nanos", 0) for p in points],
        "vals": [number(p.get("val", 0)) for p in points],
    }


def parse_answer_lines(path: str, content: bytes) -> Iterator[dict]:
    """A parser for files with an answer on every line; a line that holds none gives a signal without a name."""
    for line in content.decode().splitlines():
        try:
            yield from parse_archive_answer(path, line.encode())
        except (ValueError, AttributeError):
            yield {"signal_name": None}
