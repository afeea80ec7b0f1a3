from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tillroll.plans import dashboard as D
from tillroll.plans.view import DEFAULT_SPEC, FilterSpec, coverage, predicate, view
from tillroll.schema import CLEAN_SCHEMA


def _export_rows(spark, rows):
    names = CLEAN_SCHEMA.fieldNames()
    full = []
    for r in rows:
        d = dict.fromkeys(names)
        d.update(r)
        full.append(tuple(d[n] for n in names))
    return spark.createDataFrame(full, CLEAN_SCHEMA)


def _row(i, date, day, hour, amount, cat="A", city="X", pay="P", wk=0):
    return dict(
        transaction_id=f"T{i}", date=date, day_name=day, hour=hour, total_amount=amount, category=cat,
        city=city, payment_method=pay, quantity=1, discount_pct=5.0, customer_id=f"C{i % 2}",
        year=date and date.year, quarter=date and (date.month - 1) // 3 + 1,
        year_month=date and date.strftime("%Y-%m"), is_weekend=wk,
        product_name=f"prod{i % 3}",
    )


def test_heatmap_zero_fill_fixed_rows(spark):
    # sparse_heat: only Monday at 7 and Sunday at 22
    v = _export_rows(spark, [_row(1, dt.date(2024, 1, 1), "Monday", 7, 10.5), _row(2, dt.date(2024, 1, 7), "Sunday", 22, 3.25, wk=1)])
    rows = D.heatmap_wide(v).collect()
    assert [r.day_name for r in rows] == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert rows[0].hour_7 == 10.5 and rows[6].hour_22 == 3.25
    total = sum(sum(v for k, v in r.asDict().items() if k.startswith("hour_")) for r in rows)
    assert total == 13.75


def test_kpis_and_empty_view(spark):
    v = _export_rows(spark, [_row(i, dt.date(2024, 1, i + 1), "Monday", 8, 1.1 * (i + 1)) for i in range(5)])
    k = D.kpis(v).first()
    assert k.total_orders == 5 and k.unique_customers == 2 and k.total_quantity == 5
    assert abs(k.total_revenue - 16.5) < 1e-9 and abs(k.avg_order_value - 3.3) < 1e-9 and k.avg_discount == 5.0
    empty = view(v, FilterSpec(categories=()))
    assert empty.isEmpty()
    e = D.kpis(empty).first()
    assert e.total_orders == 0 and e.total_revenue is None and e.avg_order_value is None


def test_filter_spec_rules(spark):
    v = _export_rows(
        spark,
        [_row(1, dt.date(1995, 6, 1), "Thursday", 8, 1.0), _row(2, dt.date(1997, 6, 2), "Monday", 8, 2.0, cat="ECONOMY", city="NATION_1", pay="2-HIGH")],
    )
    assert view(v, FilterSpec()).count() == 2  # no filter: all rows
    assert view(v, FilterSpec.from_range((dt.date(1996, 1, 1),))).count() == 2  # one date picked: no range
    assert view(v, FilterSpec.from_range((dt.date(1996, 1, 1), dt.date(1999, 1, 1)))).count() == 1
    assert view(v, DEFAULT_SPEC).count() == 1
    c = coverage(v, DEFAULT_SPEC).first()
    assert (c.shown, c.total) == (1, 2)
    assert v.where(predicate(FilterSpec(cities=()))).count() == 0


def test_rows_without_a_date_are_outside_every_view(spark):
    v = _export_rows(spark, [_row(1, None, None, 8, 1.0), _row(2, dt.date(1997, 6, 2), "Monday", 8, 2.0)])
    assert view(v, FilterSpec()).count() == 1
    assert view(v, FilterSpec.from_range((dt.date(1996, 1, 1),))).count() == 1
    c = coverage(v, FilterSpec()).first()
    assert (c.shown, c.total) == (1, 2)


def test_heatmap_holds_every_hour(spark):
    hours = [0, 3, 6, 8, 23]
    v = _export_rows(spark, [_row(i, dt.date(2024, 1, 1), "Monday", h, 1.5 + i) for i, h in enumerate(hours)])
    wide = D.heatmap_wide(v).collect()
    assert [r.day_name for r in wide][:1] == ["Monday"] and len(wide[0]) == 25
    assert [wide[0][f"hour_{h}"] for h in hours] == [1.5, 2.5, 3.5, 4.5, 5.5]
    total = sum(v for r in wide for k, v in r.asDict().items() if k != "day_name")
    assert total == sum(r.revenue for r in D.heatmap_long(v).collect()) == 17.5


def test_shares_sum_to_one_and_topk_tie_break(spark):
    v = _export_rows(spark, [_row(i, dt.date(2024, 1, 1), "Monday", 8, 10.0, cat="ABC"[i % 3]) for i in range(10)])
    s = D.category_share(v).collect()
    assert abs(sum(r.share for r in s) - 1.0) < 1e-12
    top = D.top10_products(v, k=2).collect()
    assert [r.product_name for r in top] == ["prod1", "prod0"]  # prod0 (40.0) and prod1 (30.0) vs prod2 (30.0): name breaks tie
    assert D.weekend(v).first().type == "Weekday"
    assert D.quarterly(v).first().period == "2024-Q1"


def test_dashboard_composite_over_exported_csv(spark, sf_small, tmp_out):
    from tillroll.plans.dashboard import dashboard
    from tillroll.plans.pipeline import export, fact_table
    from tillroll.sources.files import read_cleaned_csv

    paths = export(fact_table(spark, sf_small), tmp_out, fmt="csv")
    tables = dashboard(read_cleaned_csv(spark, paths["cleaned"]))
    k = tables["kpis"].first()
    c = tables["filter_coverage"].first()
    assert k.total_orders == c.shown > 0
    assert len(tables["dash_heatmap_wide"].collect()) == 7
