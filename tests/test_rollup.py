"""Dashboard panels from the rollups against the same panels over the rows."""

from __future__ import annotations

import datetime as dt

import pytest

from tests.compare import rows_key
from tests.test_view_dashboard import _export_rows, _row
from tillroll.plans import dashboard as D
from tillroll.plans import rollup
from tillroll.plans.pipeline import fact_table, rollup_path
from tillroll.plans.features import export_frame
from tillroll.plans.view import DEFAULT_SPEC, FilterSpec, coverage, view

SPECS = {
    "default": DEFAULT_SPEC,
    "all": FilterSpec(),
    "days": FilterSpec(date_from=dt.date(1996, 3, 5), date_to=dt.date(1996, 3, 19)),
    "one_city": FilterSpec(cities=("NATION_3",)),
    "payments": FilterSpec(categories=("PROMO",), payments=("2-HIGH",)),
    "none": FilterSpec(categories=()),
}


def _same(a, b, name):
    assert sorted(a.columns) == sorted(b.columns), name
    rows = [rows_key(x.columns, [tuple(r) for r in x.collect()], 9) for x in (a, b)]
    assert rows[0] == rows[1], name


@pytest.mark.parametrize("spec", SPECS.values(), ids=SPECS.keys())
def test_panels_of_the_rollup_equal_panels_of_the_rows(spark, sf_small, spec):
    rows = export_frame(fact_table(spark, sf_small))
    tables = rollup.read_rollups(spark, rollup_path(spark, sf_small))
    v = view(rows, spec)
    got = rollup.panels(tables, spec, rows)
    assert set(got) == set(D.DASH_QUERIES) - {"preview_rows"}
    for name, table in got.items():
        _same(table, D.DASH_QUERIES[name](v), name)
    _same(rollup.coverage(tables, spec), coverage(rows, spec), "coverage")


def test_rollup_takes_nulls_and_no_rows(spark, tmp_out):
    rows = _export_rows(spark, [
        _row(1, dt.date(2024, 1, 1), "Monday", 7, 10.5), _row(2, dt.date(2024, 1, 1), "Monday", 7, None),
        _row(3, None, None, 8, 1.0), _row(4, dt.date(2024, 2, 1), "Thursday", None, 2.5, cat=None, city=None, pay=None),
        dict(_row(5, dt.date(2024, 2, 1), "Thursday", 3, 2.5), discount_pct=None, quantity=None),
    ])
    for at, some in (("a", rows), ("b", rows.limit(0))):
        tables = rollup.write_rollups(some, f"{tmp_out}/{at}")
        for spec in (FilterSpec(), FilterSpec(date_from=dt.date(2024, 1, 1)), FilterSpec(cities=("X",))):
            for name, table in rollup.panels(tables, spec, some).items():
                _same(table, D.DASH_QUERIES[name](view(some, spec)), name)
            _same(rollup.coverage(tables, spec), coverage(some, spec), "coverage")


def test_rollup_has_a_row_per_cell_and_panels_read_it_once(spark, tmp_out):
    rows = _export_rows(spark, [_row(i, dt.date(2024, 1, 1 + i % 2), "Monday", 7, 1.25) for i in range(400)])
    tables = rollup.write_rollups(rows, tmp_out)
    assert tables["sales"].count() == 2 and tables["products"].count() == 6
    groups, _ = rollup.panel_groups(view(tables["sales"], FilterSpec()))
    assert groups._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = rollup.panels(tables, FilterSpec())
    for name in rollup.PANELS:
        assert "/sales" not in got[name]._jdf.queryExecution().executedPlan().toString(), name
    assert "unique_customers" not in got["kpis"].columns
