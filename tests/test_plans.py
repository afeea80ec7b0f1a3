"""Plan-shape checks: pruning, pushdown, join strategies, no Python in the plans."""

from __future__ import annotations

from tillroll.plans.features import export_frame
from tillroll.plans.pipeline import fact_table
from tillroll.plans.view import DEFAULT_SPEC, view
from tillroll.sources.star import raw_transactions


def _plan(df) -> str:
    df.collect() if df.count() < 10_000 else None
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted") and df._jdf.queryExecution().explainString(
        df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_view_filters_reach_the_parquet_scan(spark, sf_small):
    v = view(export_frame(fact_table(spark, sf_small)), DEFAULT_SPEC).select("transaction_id", "total_amount")
    text = _formatted(v)
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,1996-01-01)" in text
    assert "PartitionFilters: [isnotnull(year" in text and "(year#" in text  # year pruning
    read_schema = [ln for ln in text.splitlines() if ln.startswith("ReadSchema")]
    assert read_schema and "unit_price" not in read_schema[0] and "store_id" not in read_schema[0]


def test_fact_to_fact_join_is_sort_merge(spark, sf_small):
    text = _formatted(raw_transactions(spark, sf_small))
    assert "SortMergeJoin" in text
    scans = [ln for ln in text.splitlines() if ln.startswith("ReadSchema")]
    assert all("l_comment" not in s and "l_tax" not in s for s in scans)


def test_no_python_and_no_cross_join_in_any_query_of_the_registry(spark, sf_small):
    from tillroll.registry import QUERIES

    for name, fn in QUERIES.items():
        df = fn(spark, sf_small)
        text = df._jdf.queryExecution().executedPlan().toString()
        for marker in (
            "BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas",
            "CartesianProduct", "BroadcastNestedLoopJoin",
        ):
            assert marker not in text, (name, marker)


def _exchanges_by_id(spark, run) -> int:
    """Shuffles by transaction_id in the executed plans of all executions that ``run`` starts."""
    jvm, store = spark.sparkContext._jvm, spark._jsparkSession.sharedState().statusStore()
    known = lambda: {e.executionId(): e for e in jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.executionsList())}
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    before = set(known())
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    found = 0
    for i, e in known().items():
        if i not in before:
            # an adaptive plan lists its nodes twice: as they ran and as first planned
            found += e.physicalPlanDescription().count("hashpartitioning(transaction_id") // 2
    return found


def test_one_dedup_shuffle_per_job(spark, sf_small, tmp_out):
    from tillroll.plans.clean import clean
    from tillroll.plans.pipeline import raw_table, run_pipeline
    from tillroll.registry import QUERIES

    raw = raw_table(spark, sf_small)
    fact_table(spark, sf_small)
    assert _exchanges_by_id(spark, lambda: clean(raw).write.format("noop").mode("overwrite").save()) == 1
    assert _exchanges_by_id(spark, lambda: run_pipeline(spark, raw, tmp_out)) == 1
    for key in ("impute_city_mode", "cap_outliers", "outlier_rows", "outlier_count", "quantity_p99"):
        n = _exchanges_by_id(spark, lambda: QUERIES[key](spark, sf_small).write.format("noop").mode("overwrite").save())
        assert n == 1, (key, n)


def test_whole_rows_are_exchanged_twice_per_job(spark, sf_small, tmp_out):
    """Once for dedup, once for clustering by year; the rank moves three columns and a number."""
    import re

    from tillroll.plans.pipeline import raw_table, write_fact

    jvm, store = spark.sparkContext._jvm, spark._jsparkSession.sharedState().statusStore()
    known = lambda: {e.executionId(): e for e in jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.executionsList())}
    raw = raw_table(spark, sf_small)
    before = set(known())
    key = "spark.sql.autoBroadcastJoinThreshold"
    threshold = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        write_fact(raw, tmp_out + "/fact")
    finally:
        spark.conf.set(key, threshold)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    widths = []
    for i, e in known().items():
        if i not in before:
            text = e.physicalPlanDescription().split("== Initial Plan ==")[-1]
            found = re.findall(r"Exchange\nInput \[(\d+)\]: \[.*\]\nArguments: (\w+)", text)
            widths += [int(n) for n, _ in found]
            # dedup's partial aggregate is two columns: the id and all others
            widths += [13 for line in re.findall(r"Exchange\nInput \[2\]: \[transaction_id#\d+, min#\d+\]", text)]
    assert len([n for n in widths if n > 10]) <= 2, widths


def test_counts_and_bounds_come_from_the_footers(spark, sf_small):
    from tillroll.registry import QUERIES

    for key, what in (("row_count", "COUNT(*)"), ("filter_date_bounds", "MIN(date), MAX(date)")):
        text = _formatted(QUERIES[key](spark, sf_small))
        assert f"PushedAggregation: [{what}]" in text, text
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is left alone


def _rows_scanned(df) -> int:
    """Rows that the file scan of a plan gave, after row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_a_date_range_within_a_year_reads_fewer_row_groups(spark, sf_small, tmp_out):
    import datetime as dt

    from tillroll.plans.pipeline import FACT_LAYOUT, read_fact
    from tillroll.plans.view import FilterSpec
    from tillroll.sources.files import write_parquet

    fact = fact_table(spark, sf_small).union(fact_table(spark, sf_small)).union(fact_table(spark, sf_small))
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "16384")
    hadoop.set("parquet.page.size.row.check.min", "50")
    hadoop.set("parquet.block.size.row.check.min", "50")
    try:
        write_parquet(fact.repartition(4), tmp_out + "/plain", partition_by="year")
        write_parquet(fact.repartition(4), tmp_out + "/laid", **FACT_LAYOUT)
    finally:
        for k in ("parquet.block.size", "parquet.page.size.row.check.min", "parquet.block.size.row.check.min"):
            hadoop.unset(k)
    spec = FilterSpec(date_from=dt.date(1997, 3, 1), date_to=dt.date(1997, 3, 31))
    scanned, found = {}, {}
    for name in ("plain", "laid"):
        v = view(read_fact(spark, f"{tmp_out}/{name}"), spec).select("transaction_id", "total_amount")
        found[name] = sorted(map(tuple, v.collect()), key=str)
        scanned[name] = _rows_scanned(view(read_fact(spark, f"{tmp_out}/{name}"), spec).select("transaction_id", "total_amount"))
    assert found["plain"] == found["laid"] and len(found["laid"]) > 0
    assert scanned["laid"] < scanned["plain"] * 0.6, scanned


def test_rows_stored_by_id_are_joined_and_grouped_without_an_exchange(spark, sf_small):
    from pyspark.sql import functions as F

    from tillroll.operators.dedup import dedup_transactions
    from tillroll.operators.joins import bucketed
    from tillroll.plans.pipeline import raw_table
    from tillroll.session import scratch_scope

    before = {t.name for t in spark.catalog.listTables()}
    with scratch_scope(spark):
        rows = bucketed(dedup_transactions(raw_table(spark, sf_small)), "transaction_id")
        per_id = rows.groupBy("transaction_id").agg(F.count("*").alias("c"))
        assert "Exchange" not in _formatted(per_id).replace("ReusedExchange", "")
        twice = rows.join(per_id.hint("merge"), "transaction_id")
        assert "Exchange" not in _formatted(twice) and "SortMergeJoin" in _formatted(twice)
        assert twice.where("c > 1").count() == 0 and twice.count() == rows.count()
        # the number of duplicate ids needs no second shuffle of the rows
        assert _formatted(rows.agg(F.count_distinct("transaction_id"))).count("hashpartitioning") == 0
    assert {t.name for t in spark.catalog.listTables()} == before
