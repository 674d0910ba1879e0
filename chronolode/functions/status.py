"""Conditions of samples (severity, status, message) as runs of equal ones.

Most samples are normal, and alarms last. So a bucket stores one entry for each stretch of samples under one condition,
and nothing at all where every sample is normal.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

CONDITION = ["severity", "status", "message"]


def condition(sample: Column) -> Column:
    """``struct<severity, status, message>`` of a sample; missing numbers are 0, an empty message is NULL."""
    return F.struct(
        F.coalesce(sample["severity"].cast("int"), F.lit(0)).alias("severity"),
        F.coalesce(sample["status"].cast("int"), F.lit(0)).alias("status"),
        F.nullif(sample["message"], F.lit("")).alias("message"),
    )


def is_normal(c: Column) -> Column:
    return (c["severity"] == 0) & (c["status"] == 0) & c["message"].isNull()


def status_runs(samples: Column) -> Column:
    """Runs ``array<struct<n, severity, status, message>>`` of an array of samples in order; NULL if all are normal."""
    n = F.size(samples)

    def at(i: Column) -> Column:
        return condition(F.get(samples, i))

    def run(begin: Column, k: Column, begins: Column) -> Column:
        end = F.coalesce(F.get(begins, k + 1), n)
        return F.struct((end - begin).alias("n"), *(at(begin)[c].alias(c) for c in CONDITION))

    indices = F.sequence(F.lit(0), n - 1)
    begins = F.filter(indices, lambda i: (i == 0) | ~at(i).eqNullSafe(at(i - 1)))
    # a lambda over one element binds the begins, which are then made once
    runs = F.get(F.transform(F.array(begins), lambda b: F.transform(b, lambda i, k: run(i, k, b))), 0)
    return F.when(F.exists(samples, lambda s: ~is_normal(condition(s))), runs)


def sample_conditions(runs: Column) -> Column:
    """The condition of every sample in order; NULL for NULL."""
    one = lambda r: F.array_repeat(F.struct(*(r[c].alias(c) for c in CONDITION)), r["n"])
    return F.flatten(F.transform(runs, one))
