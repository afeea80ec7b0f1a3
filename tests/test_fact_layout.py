"""What the building of the fact moves and sorts, and that its shares don't grow with the table."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from tillroll.functions.calendar import calendar_columns
from tillroll.operators.rank import customer_txn_rank, with_rank
from tillroll.plans.pipeline import read_fact, write_fact
from tillroll.schema import RAW_SCHEMA
from tillroll.session import ROWS_PER_PARTITION, spread_for


def _raw(spark, path):
    """Own rows: repeated ids, null and bad values, two years."""
    rows = [
        (f"T{i % 90:03d}", None if i % 17 == 0 else f"{1996 + i % 2}-{1 + i % 12:02d}-{1 + i % 28:02d}", i % 24, None if i % 11 == 0 else f"C{i % 7}",
         f"S{i % 4}", None if i % 5 == 0 else f"city{i % 3}", f"p{i % 6}", f"cat{i % 2}", 1 + i % 9, 1.5 * (i % 8), None if i % 13 == 0 else float(i % 5),
         10.0 + i, None if i % 19 == 0 else "card")
        for i in range(120)
    ]
    spark.createDataFrame(rows, RAW_SCHEMA).write.parquet(path)
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def _plans(spark, run) -> list[str]:
    """Plans of all executions that ``run`` starts, as they ran and as first planned."""
    store = spark._jsparkSession.sharedState().statusStore()
    known = lambda: {e.executionId(): e for e in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.executionsList())}
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    before = set(known())
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    return [e.physicalPlanDescription() for i, e in known().items() if i not in before]


def test_rows_are_clustered_before_columns_are_derived(spark, tmp_out):
    raw = _raw(spark, tmp_out + "/raw")
    plans = _plans(spark, lambda: write_fact(raw, tmp_out + "/fact"))
    found = [re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\(year", p) for p in plans]
    moved = [x for some in found for x in some]
    assert moved
    for columns in moved:  # the amount, the calendar but its two keys and the bucket are made behind the exchange
        names = set(re.findall(r"(\w+)#\d+", columns))
        assert len(names) <= 16 and not names & {"day_name", "month_name", "year_month", "revenue_bucket", "total_amount_clean"}, names


def test_the_shuffles_of_the_fact_are_sized_by_its_rows(spark, tmp_out):
    raw = _raw(spark, tmp_out + "/raw")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    wanted = 5 + int(before)
    plans = _plans(spark, lambda: write_fact(raw, tmp_out + "/fact", rows=wanted * ROWS_PER_PARTITION))
    assert any(re.search(rf"hashpartitioning\(transaction_id#\d+, {wanted}\)", p) for p in plans)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    write_fact(raw, tmp_out + "/plain")
    one, two = (sorted(map(str, read_fact(spark, f"{tmp_out}/{n}").collect())) for n in ("fact", "plain"))
    assert one == two and len(one) == 90
    with spread_for(spark, 10) as n:
        assert n == int(before)  # enough as it is


def test_the_rank_is_joined_without_sorting_the_rows(spark, tmp_out):
    rows = _raw(spark, tmp_out + "/raw").dropDuplicates(["transaction_id"])
    joined = with_rank(rows, customer_txn_rank(rows), null_key=False)
    assert "ShuffledHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 90 and joined.where("cust_txn_rank is null").count() == 0


def test_calendar_names_are_those_of_the_date_patterns(spark):
    days = spark.range(0, 1200).select(F.date_add(F.lit(dt.date(1999, 12, 20)), F.col("id").cast("int")).alias("date"))
    odd = spark.sql("select explode(array(date'0001-01-01', date'0999-12-31', date'9999-12-31', null, date_add(date'9999-12-31', 1), date'-0001-05-05')) as date")
    d = F.col("date")
    cols = calendar_columns("date")
    want = {"day_name": F.date_format(d, "EEEE"), "month_name": F.date_format(d, "MMMM"), "year_month": F.date_format(d, "yyyy-MM")}
    differ = F.lit(False)
    for name, old in want.items():
        differ = differ | ~cols[name].eqNullSafe(old)
    assert days.union(odd).where(differ).count() == 0
