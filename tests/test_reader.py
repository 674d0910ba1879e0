"""The reader hook over many files, some of them broken."""

import json

from pyspark.sql import functions as F

from chronolode.schema import RAW_SIGNALS
from chronolode.sources.reader import parse_archive_answer, read_signal_files


def lines():
    """A parser of lines ``name,value,value...``; made here so that it travels with the job."""

    def parse(path, content):
        for line in content.decode().splitlines():
            name, *values = line.split(",")
            if name == "wrong":
                yield {"signal_name": name, "vals": ["text"]}
            elif name == "odd":
                yield {"signal_name": name, "colour": 1}
            else:
                yield {"signal_name": name, "vals": [float(v) for v in values], "dims": [len(values)]}

    return parse


def test_thousand_files_with_broken_ones(spark, tmp_path):
    for i in range(1000):
        folder = tmp_path / f"d{i % 7}"
        folder.mkdir(exist_ok=True)
        text = f"sig{i},{i},2.5\nsame,1"
        if i % 50 == 0:
            text = "first,1\nsig,not a number"
        elif i % 51 == 0:
            text = f"wrong,1\nodd,1\n,5\nsig{i},7"
        elif i % 53 == 0:
            (folder / f"{i}.txt").write_bytes(b"\xff\xfe")
            continue
        (folder / f"{i}.txt").write_text(text)
    (tmp_path / "other.log").write_text("not,read")
    good, bad = read_signal_files(spark, str(tmp_path), lines(), "*.txt")
    assert good.schema == RAW_SIGNALS
    broken = {i for i in range(1000) if i % 50 == 0}
    partly = {i for i in range(1000) if i % 51 == 0} - broken
    unread = {i for i in range(1000) if i % 53 == 0} - broken - partly
    whole = 1000 - len(broken | partly | unread)
    counts = {r["signal_name"]: r["count"] for r in good.groupBy("signal_name").count().collect()}
    assert counts["same"] == whole and counts["first"] == len(broken) and all(counts[f"sig{i}"] == 1 for i in partly)
    assert good.count() == 2 * whole + len(broken) + len(partly)
    assert good.where("signal_name = 'sig7'").first().asDict() | {"path": None} == dict.fromkeys(RAW_SIGNALS.names) | {
        "file_bytes": 17, "signal_name": "sig7", "dims": [2], "vals": [7.0, 2.5]
    }
    reasons = {r["kind"]: r["count"] for r in bad.groupBy(F.regexp_extract("reason", r"^\w+", 0).alias("kind")).count().collect()}
    assert reasons == {"ValueError": len(broken), "UnicodeDecodeError": len(unread)} | dict.fromkeys(set(reasons) - {"ValueError", "UnicodeDecodeError"}, len(partly))
    assert len(reasons) == 5


def test_archive_answers(tmp_path, spark):
    answers = {"a": [{"meta": {"name": "X:Y:1:Z", "DESC": "d"}, "data": [{"secs": 1, "nanos": 2, "val": 3}, {"val": "bad"}, {"val": True}]}], "b": [], "c": {"no": 1}}
    for name, answer in answers.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(answer))
    (tmp_path / "d.json").write_text("{half")
    good, bad = read_signal_files(spark, str(tmp_path), parse_archive_answer)
    row = good.first()
    assert good.count() == 1 and bad.count() == 3 and (row.signal_name, row.label, row.secs, row.dims) == ("X:Y:1:Z", "d", [1, 0, 0], [3])
    assert row.vals[0] == 3.0 and all(v != v for v in row.vals[1:])


def test_no_files(spark, tmp_path):
    (tmp_path / "x.txt").write_text("a,1")
    good, bad = read_signal_files(spark, str(tmp_path), lines(), "*.none")
    assert good.count() == bad.count() == 0
