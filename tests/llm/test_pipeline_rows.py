"""The pipeline on odd rows and on an empty table."""

from __future__ import annotations

import shutil

import corpus_pipeline
from tests.llm.cases import documents, empty

SF = "/root/testdata/sf0.001"
TEXT = " ".join(f"plain{i} words{i * 7 % 31} here{i * 3 % 17}" for i in range(40))


def _run(spark, docs, folder):
    shutil.copy(f"{SF}/benchmark.parquet", folder)
    docs.write.parquet(f"{folder}/documents.parquet")
    return corpus_pipeline.run(spark, folder).collect()


def test_odd_rows(spark, tmp_out):
    good = [(20 + i, f"{TEXT} number {i} of " + " ".join(f"own{i}x{j}" for j in range(60)), "en", "b") for i in range(4)]
    good += [good[0], (None, good[1][1] + " no id", None, None)]
    columns = documents(spark).columns
    more = documents(spark, good).select(*columns)
    rows = _run(spark, documents(spark).union(more), tmp_out)
    ids = {r.doc_id for r in rows}
    assert ids and ids <= {1, 4, 5, 6, 8, 20, 21, 22, 23, None}  # null, empty and wordless texts are gone
    assert sorted(r.slot for r in rows if r.shard == rows[0].shard) == list(range(sum(r.shard == rows[0].shard for r in rows)))


def test_empty_table(spark, tmp_out):
    assert _run(spark, empty(spark), tmp_out) == []
