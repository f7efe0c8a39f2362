"""Indicators from one base against a table built indicator by indicator."""

import pytest
from pyspark.sql import functions as F

from tallyloom.plans import kpi
from tallyloom.workload import REGISTRY
from tests.conftest import rows


def test_indicators_of_one_base_equal_those_built_one_by_one(spark):
    base = spark.createDataFrame(
        [(1, "a", 1, 2.0), (1, "a", 2, None), (1, "b", 2, 4.5), (1, None, 1, 1.0), (2, "c", 3, None), (None, "d", 1, 9.0)],
        "unit int, person string, kind int, amount double")
    units = spark.createDataFrame([(1,), (1,), (2,), (3,)], "unit int")
    one = F.col("kind") == 1
    indicators = {"rows": kpi.counted(one), "people": kpi.counted_ids(one), "people_rate": kpi.id_rate(one), "row_rate": kpi.row_rate(one, among=F.col("kind") < 3),
                  "total": kpi.summed(F.col("amount")), "each": kpi.per_id(F.col("amount")), "text": kpi.counts_text(one, F.col("kind") == 2, F.col("kind").isNull())}
    got = rows(kpi.kpi_from_base(units, base, indicators, id_col="person"))
    grouped = base.groupBy("unit")
    n = lambda df: df.select("unit", F.nullif("n", F.lit(0)).alias("value"))
    whole = base.withColumn("person", F.col("person"))
    apart = {
        "rows": n(grouped.agg(F.count_if(one).alias("n"))), "people": n(grouped.agg(F.count_distinct(F.when(one, F.col("person"))).alias("n"))),
        "people_rate": kpi.kpi_rate(whole.filter(one & F.col("person").isNotNull()), whole.filter("person is not null"), "unit", "person"),
        "row_rate": kpi.kpi_rate(base.filter(one).withColumn("i", F.monotonically_increasing_id()), base.filter("kind < 3").withColumn("i", F.monotonically_increasing_id()), "unit", "i"),
        "total": grouped.agg(F.sum("amount").alias("value")), "each": grouped.agg(F.round(F.try_divide(F.sum("amount"), F.count_distinct("person")), 2).alias("value")),
        "text": grouped.agg(kpi.slashed(F.count_if(one), F.count_if(F.col("kind") == 2), F.lit(0)).alias("value"))}
    assert got == rows(kpi.kpi_table(units, apart).select("unit", "indicator", "value"))
    assert (3, "text", None) in got and (1, "people", "1") in got and len(got) == 21


def test_ids_need_a_column(spark):
    with pytest.raises(ValueError, match="id_col"):
        kpi.kpi_from_base(spark.range(1).toDF("unit"), spark.range(1).toDF("unit"), {"x": kpi.counted_ids(F.lit(True))})


@pytest.mark.parametrize("name", ["kpi_table_by_nation", "kpi_one_pass"])
def test_one_scan_for_all_indicators(spark, name):
    plan = REGISTRY[name].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    scans = [str(plan.collectLeaves().apply(k).output().toString()) for k in range(plan.collectLeaves().size())]
    assert sum("o_custkey" in s for s in scans) == 1
