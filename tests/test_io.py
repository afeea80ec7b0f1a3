"""Sources and sinks: declared-schema reads, malformed input, missing paths, round trips."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tillroll.plans.features import export_frame
from tillroll.plans.pipeline import fact_table, raw_table, read_fact, run_pipeline
from tillroll.schema import CLEAN_SCHEMA, RAW_SCHEMA, SUMMARY_SCHEMAS
from tillroll.sources import files


def test_bad_csv_permissive_and_quarantine(spark, tmp_out):
    # bad_csv: non-integer quantity, unparseable date, empty fields, missing id
    p = os.path.join(tmp_out, "bad.csv")
    with open(p, "w") as f:
        f.write(",".join(RAW_SCHEMA.fieldNames()) + "\n")
        f.write("T1,2024-01-01,9,C1,S1,Pune,p,c,two,1.5,0,3.0,Cash\n")
        f.write("T2,2024-13-45,9,C1,S1,,p,c,2,1.5,,3.0,\n")
        f.write(",2024-01-01,9,C1,S1,Pune,p,c,2,1.5,0,3.0,Cash\n")
    df = files.read_raw_csv(spark, p)
    rows = {r.transaction_id: r for r in df.collect()}
    assert rows["T1"].quantity is None  # malformed int -> NULL in PERMISSIVE mode
    assert rows["T2"].city is None and rows["T2"].discount_pct is None and rows["T2"].payment_method is None
    valid, quarantined = files.quarantine(df)
    assert valid.count() == 2 and quarantined.count() == 1
    from tillroll.plans.clean import with_parsed_date

    assert with_parsed_date(valid).where(F.col("date").isNull()).count() == 1


def test_missing_input_guard(spark, tmp_out):
    with pytest.raises(files.MissingInputError):
        files.read_cleaned_csv(spark, os.path.join(tmp_out, "nope.csv"))
    assert files.read_summary(spark, os.path.join(tmp_out, "nope.csv"), "summary_city") is None


def _file(folder, name, *lines, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding=encoding) as f:
        f.write("".join(line + "\n" for line in lines))
    return path


ROW = dict(zip(RAW_SCHEMA.fieldNames(), "T1,2024-01-01,9,C1,S1,Pune,p,c,2,1.5,0.5,3.0,Cash".split(",")))
TYPED = ("T1", "2024-01-01", 9, "C1", "S1", "Pune", "p", "c", 2, 1.5, 0.5, 3.0, "Cash")


def test_columns_are_bound_by_header_name(spark, tmp_out):
    """Any order, further columns (one without a name), capitals, blanks, a byte order mark."""
    names = [*reversed(RAW_SCHEMA.fieldNames())]
    header = ["", "\ufeff" + names[0], names[1].upper(), " " + names[2], *names[3:6], "note", *names[6:]]
    line = ["0", *[ROW[n] for n in names[:6]], "seen", *[ROW[n] for n in names[6:]]]
    path = _file(tmp_out, "mixed.csv", ",".join(header), ",".join(line))
    for corrupt in (False, True):
        got = files.read_raw_csv(spark, path, with_corrupt=corrupt)
        assert got.columns == RAW_SCHEMA.fieldNames() + [files.CORRUPT] * corrupt
        assert tuple(got.first()) == TYPED + (None,) * corrupt
        assert [tuple(r) for r in got.select("city", "quantity").collect()] == [("Pune", 2)]
    swapped = _file(tmp_out, "summary.csv", "total_quantity,avg_order_value,num_transactions,total_revenue,category", "7,2.5,3,7.5,x")
    assert tuple(files.read_summary(spark, swapped, "summary_category").first()) == ("x", 7.5, 3, 2.5, 7)
    clean = {f.name: "1" for f in CLEAN_SCHEMA} | {"date": "2024-01-01", "city": "Pune"}
    turned = _file(tmp_out, "clean.csv", ",".join(reversed(clean)), ",".join(reversed(clean.values())))
    row = files.read_cleaned_csv(spark, turned).first()
    assert (row.city, str(row.date), row.quantity, row.year_month) == ("Pune", "2024-01-01", 1, "1")


def test_a_header_without_a_declared_column_is_refused(spark, tmp_out):
    names = RAW_SCHEMA.fieldNames()
    path = _file(tmp_out, "short.csv", ",".join(n for n in names if n not in ("city", "hour")), "T1")
    with pytest.raises(files.HeaderError, match="hour, city"):
        files.read_raw_csv(spark, path)
    with pytest.raises(files.HeaderError):
        files.read_summary(spark, path, "summary_city")
    data = _file(tmp_out, "bare.csv", ",".join(ROW.values()))  # no header at all
    with pytest.raises(files.HeaderError):
        files.read_raw_csv(spark, data)


def test_files_of_one_folder_must_have_one_header(spark, tmp_out):
    names = RAW_SCHEMA.fieldNames()
    folder = os.path.join(tmp_out, "parts")
    _file(folder, "a.csv", ",".join(names), ",".join(ROW.values()))
    _file(folder, "b.csv", ",".join(names), ",".join(ROW.values()))
    assert files.read_raw_csv(spark, folder).count() == 2
    turned = ["city", *[n for n in names if n != "city"]]
    _file(folder, "c.csv", ",".join(turned), ",".join(ROW[n] for n in turned))
    with pytest.raises(Exception, match="(?s)CSV header does not conform|header"):
        files.read_raw_csv(spark, folder).collect()


def test_files_without_rows_or_lines(spark, tmp_out):
    only = _file(tmp_out, "only.csv", ",".join(reversed(RAW_SCHEMA.fieldNames())))
    assert files.read_raw_csv(spark, only).collect() == []
    nothing = _file(tmp_out, "nothing.csv")
    assert files.read_raw_csv(spark, nothing).collect() == []
    _file(os.path.join(tmp_out, "hidden"), "_SUCCESS")
    back = files.read_raw_csv(spark, os.path.join(tmp_out, "hidden"))
    assert back.collect() == [] and back.columns == RAW_SCHEMA.fieldNames()


def test_malformed_lines_of_a_reordered_file(spark, tmp_out):
    names = ["payment_method", *RAW_SCHEMA.fieldNames()[:-1]]
    bad = ROW | {"quantity": "two", "transaction_id": "T2"}
    path = _file(tmp_out, "bad.csv", ",".join(names), ",".join(ROW[n] for n in names), ",".join(bad[n] for n in names))
    raw = files.read_raw_csv(spark, path, with_corrupt=True)
    good, rejected = files.quarantine(raw.cache())
    assert [r.transaction_id for r in good.collect()] == ["T1"]
    assert [(r.reason, r.payment_method) for r in rejected.collect()] == [("corrupt_record", "Cash")]


def test_csv_round_trip_raw(spark, sf_small, tmp_out):
    raw = raw_table(spark, sf_small)
    path = files.write_csv(raw, os.path.join(tmp_out, "raw_csv"))
    back = files.read_raw_csv(spark, path)
    assert back.schema.fieldNames() == RAW_SCHEMA.fieldNames()
    assert raw.exceptAll(back).count() == 0 and back.exceptAll(raw).count() == 0


def test_pipeline_outputs(spark, sf_small, tmp_out):
    res = run_pipeline(spark, raw_table(spark, sf_small), tmp_out, write_parquet_export=True)
    paths, prof = res["paths"], res["profile"]
    assert prof["num_rows"] == 6000 and prof["duplicates"] == 6000 - prof["rows_after_dedup"]
    fact = read_fact(spark, paths["fact"])
    export = export_frame(fact)
    csv_back = files.read_cleaned_csv(spark, paths["cleaned_csv"])
    pq_back = files.read_cleaned_parquet(spark, paths["cleaned_parquet"])
    for back in (csv_back, pq_back):
        assert back.schema == CLEAN_SCHEMA
        assert export.exceptAll(back.select(*export.columns)).count() == 0
        assert back.count() == export.count() == prof["rows_after_dedup"]
    from tillroll.plans.analysis import SUMMARIES

    for name in SUMMARY_SCHEMAS:
        s = files.read_summary(spark, paths[name], name)
        want = SUMMARIES[name](fact)
        assert s.columns == want.columns
        assert sorted(map(tuple, s.collect()), key=str) == sorted(map(tuple, want.collect()), key=str), name


def test_pipeline_accounts_for_every_row_and_leaves_no_scratch(spark, tmp_out):
    from tillroll.session import checkpoint_root

    p = os.path.join(tmp_out, "bad.csv")
    good = ["T%d,2024-01-%02d,9,C%d,S1,Pune,p,c,2,1.5,0,3.0,Cash" % (i, i % 28 + 1, i % 3) for i in range(1, 41)]
    with open(p, "w") as f:
        f.write("\n".join([
            ",".join(RAW_SCHEMA.fieldNames()), *good, good[0], good[1],
            "T90,2024-01-01,9,C1,S1,Pune,p,c,two,1.5,0,3.0,Cash",  # malformed quantity
            *[",2024-01-01,9,C1,S1,Pune,p,c,%d,1.5,0,3.0,Cash" % q for q in range(5)],  # no id
            "T91,2024-01-01,24,C1,S1,Pune,p,c,2,1.5,0,3.0,Cash",  # no such hour
            "T92,2024-02-30,9,C1,S1,Pune,p,c,2,1.5,0,3.0,Cash",  # no such day: stays, without a date
        ]) + "\n")
    scratch = os.path.join(checkpoint_root(spark).removeprefix("file:"), "tillroll")
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    res = run_pipeline(spark, files.read_raw_csv(spark, p, with_corrupt=True), os.path.join(tmp_out, "out"))
    prof = res["profile"]
    assert (prof["num_rows"], prof["rows_after_dedup"], prof["duplicates"], prof["quarantined"]) == (50, 41, 2, 7)
    assert prof["quarantined__missing_id"] == 5 and prof["quarantined__corrupt_record"] == 1
    assert prof["quarantined__hour_out_of_range"] == 1 and prof["rejected_dates"] == 1
    kept = spark.read.parquet(res["paths"]["quarantine"])
    assert {r.reason: r["count"] for r in kept.groupBy("reason").count().collect()} == {
        "missing_id": 5, "corrupt_record": 1, "hour_out_of_range": 1,
    }
    assert kept.where("_corrupt_record like 'T90%'").count() == 1
    assert read_fact(spark, res["paths"]["fact"]).count() == 41
    assert set(os.listdir(scratch)) <= before


def test_derived_tables_follow_their_input(spark, sf_small, tmp_out):
    import shutil

    for t in ("lineitem", "orders", "customer", "nation", "part"):
        shutil.copy(f"{sf_small}/{t}.parquet", tmp_out)
    assert raw_table(spark, tmp_out).count() == 6000 >= fact_table(spark, tmp_out).count() > 1000
    duckdb.sql(f"COPY (SELECT * FROM '{sf_small}/lineitem.parquet' LIMIT 1000) TO '{tmp_out}/lineitem.parquet'")
    assert raw_table(spark, tmp_out).count() == 1000
    assert fact_table(spark, tmp_out).count() <= 1000


def test_year_output_has_few_files(spark, sf_small, tmp_out):
    fact = fact_table(spark, sf_small).repartition(64)
    path = files.write_parquet(fact, os.path.join(tmp_out, "by_year"), partition_by="year")
    years = [d for d in os.listdir(path) if d.startswith("year=")]
    counts = [len([f for f in os.listdir(os.path.join(path, y)) if f.endswith(".parquet")]) for y in years]
    assert len(years) >= 5 and max(counts) <= 2
    assert read_fact(spark, path).count() == fact.count()


def test_summary_invariants(spark, sf_small):
    """Counts add up to the fact's rows and revenue to its total in every summary."""
    from tillroll.plans import analysis as A

    fact = fact_table(spark, sf_small)
    n = fact.count()
    total = fact.agg(F.sum("total_amount_clean").cast("double")).first()[0]
    for fn, cnt, rev in (
        (A.summary_category, "num_transactions", "total_revenue"),
        (A.summary_monthly, "monthly_orders", "monthly_revenue"),
        (A.summary_city, "orders", "revenue"),
        (A.summary_payment, "txn_count", "revenue"),
    ):
        agg = fn(fact).agg(F.sum(cnt), F.sum(rev)).first()
        assert agg[0] == n and abs(agg[1] - total) < 0.01
    assert A.summary_hourly(fact).agg(F.sum("txn_count")).first()[0] == n
    # capped quantity never above the cap
    from tillroll.operators.cap import quantile_cap
    from tillroll.operators.dedup import dedup_transactions

    cap = quantile_cap(dedup_transactions(raw_table(spark, sf_small))).first().cap
    assert fact.agg(F.max("quantity_capped")).first()[0] <= cap


def test_report_tables_equal_the_per_table_plans(spark, sf_small):
    from tillroll.plans.analysis import ANALYSES, SUMMARIES
    from tillroll.plans.report import report_tables

    fact = fact_table(spark, sf_small)
    tables = report_tables(fact)
    for name, fn in {**ANALYSES, **SUMMARIES}.items():
        want, got = fn(fact), tables[name]
        assert got.columns == want.columns, name
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str), name


def test_scratch_folder_and_conf(spark):
    from tillroll.session import CLUSTER_CONF, apply_conf, checkpoint_root, scratch_path

    root = checkpoint_root(spark)
    assert root and scratch_path(spark, "x").startswith(root + "/tillroll/x-")
    before = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    apply_conf(spark, {"spark.sql.adaptive.skewJoin.enabled": CLUSTER_CONF["spark.sql.adaptive.skewJoin.enabled"]})
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", before)


def test_shape_and_profile_composite(spark, sf_small):
    from tillroll.operators.profile import profile, profile_pass

    raw = raw_table(spark, sf_small)
    s = files.shape(raw).first()
    assert (s.num_rows, s.num_columns) == (6000, 13)
    p = profile(raw)
    assert set(p) == {"null_counts", "duplicate_count", "describe_numeric"}
    nulls = p["null_counts"].first().asDict()
    one_pass = profile_pass(raw).first().asDict()
    assert all(nulls[c] == one_pass[f"nulls__{c}"] for c in raw.columns)
    d = p["duplicate_count"].first()
    assert d.num_rows == 6000 and d.duplicates == 6000 - d.distinct_ids
    assert {r.column for r in p["describe_numeric"].collect()} == {"quantity", "unit_price", "discount_pct", "total_amount"}


def test_export_parquet_and_bad_format(spark, sf_small, tmp_out):
    from tillroll.plans.pipeline import export

    fact = fact_table(spark, sf_small)
    paths = export(fact, tmp_out, fmt="parquet")
    back = files.read_cleaned_parquet(spark, paths["cleaned"])
    assert back.schema == CLEAN_SCHEMA and back.count() == fact.count()
    assert set(SUMMARY_SCHEMAS) <= set(paths)
    with pytest.raises(ValueError):
        export(fact, tmp_out + "/x", fmt="orc")
