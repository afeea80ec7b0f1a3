"""Staged outputs: nothing half-written is ever seen, a failed job leaves the old output."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tillroll.plans import pipeline
from tillroll.plans.pipeline import fact_table, raw_table, run_pipeline
from tillroll.sources import files
from tillroll.sources.publish import KEEP, PublishConflict, published, staged


def _put(spark, out, value):
    with staged(spark, out) as stage:
        path = files.write_parquet(spark.createDataFrame([(value,)], "v string"), f"{stage.path}/table")
        stage.commit({"table": path})


def _seen(spark, out):
    return spark.read.parquet(published(spark, out)["table"]).first().v


def test_versions_replace_each_other(spark, tmp_out):
    with pytest.raises(files.MissingInputError):
        published(spark, tmp_out)
    for i in range(4):
        _put(spark, tmp_out, str(i))
        assert _seen(spark, tmp_out) == str(i)
    assert len(os.listdir(f"{tmp_out}/versions")) == KEEP == len([f for f in os.listdir(f"{tmp_out}/manifests") if f.endswith(".json")])


def test_a_failing_write_keeps_the_old_output(spark, tmp_out):
    _put(spark, tmp_out, "old")
    with pytest.raises(Exception, match="no such|DIVIDE|zero|raise"):
        with staged(spark, tmp_out) as stage:
            half = files.write_parquet(spark.createDataFrame([("new",)], "v string"), f"{stage.path}/table")
            spark.range(10).select(F.raise_error(F.lit("raise in a task"))).write.parquet(f"{stage.path}/other")
            stage.commit({"table": half})
    assert _seen(spark, tmp_out) == "old" and len(os.listdir(f"{tmp_out}/versions")) == 1
    # a driver that is lost neither commits nor cleans up; the next job does
    os.makedirs(f"{tmp_out}/versions/00000002-lost0000/table")
    assert _seen(spark, tmp_out) == "old"
    _put(spark, tmp_out, "next")
    _put(spark, tmp_out, "last")
    assert _seen(spark, tmp_out) == "last"
    assert not any("lost" in v for v in os.listdir(f"{tmp_out}/versions"))


def test_of_two_jobs_the_later_is_refused(spark, tmp_out):
    with pytest.raises(PublishConflict):
        with staged(spark, tmp_out) as slow:
            files.write_parquet(spark.createDataFrame([("slow",)], "v string"), f"{slow.path}/table")
            _put(spark, tmp_out, "quick")
            slow.commit({"table": f"{slow.path}/table"})
    assert _seen(spark, tmp_out) == "quick" and len(os.listdir(f"{tmp_out}/versions")) == 1


def test_a_pipeline_that_fails_keeps_the_last_outputs(spark, sf_small, tmp_out, monkeypatch):
    raw = raw_table(spark, sf_small)
    first = run_pipeline(spark, raw, tmp_out)["paths"]
    assert published(spark, tmp_out) == first
    before = sorted(map(tuple, files.read_summary(spark, first["summary_city"], "summary_city").collect()))
    write, calls = pipeline.write_csv, []

    def failing(df, path, *a):
        calls.append(path)
        if path.endswith("summary_payment.csv"):
            raise RuntimeError("disk full")
        return write(df, path, *a)

    monkeypatch.setattr(pipeline, "write_csv", failing)
    with pytest.raises(RuntimeError, match="disk full"):
        run_pipeline(spark, raw.limit(100), tmp_out)
    with pytest.raises(RuntimeError, match="disk full"):
        pipeline.export(fact_table(spark, sf_small), tmp_out)
    assert len(calls) > 6 and published(spark, tmp_out) == first
    now = files.read_summary(spark, published(spark, tmp_out)["summary_city"], "summary_city")
    assert sorted(map(tuple, now.collect())) == before
    monkeypatch.undo()
    again = run_pipeline(spark, raw, tmp_out)["paths"]
    assert published(spark, tmp_out) == again != first
