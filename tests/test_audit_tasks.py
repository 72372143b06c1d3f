"""V3's keys are dealt to tasks by the number of rows, with the same breaks."""

import pytest

from marquee.operators import quality as qa
from pyspark.sql import functions as F


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("task_rows", [100, 10 ** 6])
def test_breaks_do_not_depend_on_the_tasks(spark, task_rows):
    child = spark.range(3000).select((F.col("id") % 1200).alias("ref")).unionByName(spark.sql("select cast(null as bigint) as ref from range(5)"))
    parent = spark.range(1000).withColumnRenamed("id", "key")
    twice = qa._unique(child, "u", [F.col("ref")], task_rows)
    assert {(r.key, r.n) for r in twice.collect()} == {(str(i), 3 if i < 600 else 2) for i in range(1200)}
    missing = qa._foreign(child, "ref", parent, "key", "f", task_rows)
    assert {(r.rule, r.key, r.n) for r in missing.collect()} == {("f", str(i), 2) for i in range(1000, 1200)}


def test_keys_are_not_grouped_before_they_are_dealt(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 700).alias("ref"))
    for df in (qa._unique(rows, "u", [F.col("k")], 100), qa._foreign(rows, "ref", spark.range(500), "id", "f", 100)):
        plan = _plan(df)
        final = plan.split("== Initial Plan ==")[0]
        assert ", 10), REPARTITION_BY_NUM" in final and "ENSURE_REQUIREMENTS" not in final
