"""End-to-end pipeline: raw -> clean -> features -> written fact -> export + summaries.

The feature fact is written once as Parquet partitioned by ``year`` in the shared
checkpoint folder (cuts lineage, survives executor loss); every analysis, summary and
dashboard query then reads it with column pruning, pushed filters and partition pruning
instead of recomputing dedup and imputation per query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.dedup import dedup_transactions
from tillroll.operators.joins import DEFAULT_BROADCAST_ROWS, bucketed, pinned
from tillroll.functions.calendar import calendar_columns
from tillroll.operators.rank import customer_txn_rank, with_rank
from tillroll.plans.analysis import ANALYSES, SUMMARIES
from tillroll.plans.clean import imputed_with_cap, priced, purchases
from tillroll.plans.features import add_features, export_frame
from tillroll.plans.report import report_tables
from tillroll.plans.rollup import write_rollups
from tillroll.operators.profile import profile_pass
from tillroll.schema import FACT_SCHEMA, RAW_SCHEMA
from tillroll.session import app_id, input_state, scratch_path, scratch_scope, spread_for, together
from tillroll.sources.files import CORRUPT, REASONS, clustered, quarantine, read_summary, write_csv, write_parquet, write_laid_out
from tillroll.sources.publish import staged
from tillroll.sources.star import raw_transactions, table


# Where a row of the fact is stored: months of a year together, ordered by date and city within
# a file; the dashboard filters on these and on the two columns with Bloom filters.
FACT_LAYOUT = {
    "partition_by": "year",
    "cluster_by": ("month",),
    "sort_by": ("date", "city"),
    "bloom": ("category", "payment_method"),
}


def write_fact(
    raw: DataFrame, path: str, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, rows: int | None = None
) -> int:
    """Clean + features, written as Parquet clustered and partitioned by year; returns the
    number of rows after dedup. ``rows``, about the number of raw rows if the caller knows it,
    sizes the shuffles and the buckets, so that no task's share grows with the table.

    The deduplicated rows are stored once by their id in the shared scratch folder and read by
    their consumers (store -> city table, quantity bins, the three columns that the rank needs,
    the rows themselves). The rank comes back to the rows by their id, so whole rows are
    exchanged twice in all: for dedup and for clustering by year; the second time with their
    filled columns and the rank only; amount, calendar and revenue bucket are derived behind it.
    All scratch is deleted when the fact is written.
    """
    with spread_for(raw.sparkSession, rows), scratch_scope(raw.sparkSession):
        deduped = bucketed(dedup_transactions(raw), "transaction_id")
        imputed, cap, sizes = imputed_with_cap(deduped, max_broadcast_rows)
        ranks = customer_txn_rank(purchases(deduped))
        ranked = with_rank(imputed, ranks, null_key=sizes["null_ids"] > 0)
        when = calendar_columns("date")
        placed = ranked.withColumns({c: when[c] for c in (FACT_LAYOUT["partition_by"], *FACT_LAYOUT["cluster_by"])})
        placed = clustered(placed, **{k: v for k, v in FACT_LAYOUT.items() if k != "bloom"})
        features = add_features(priced(placed, cap), with_rank=False)
        write_laid_out(features.select(*FACT_SCHEMA.fieldNames()), path, FACT_LAYOUT["partition_by"], bloom=FACT_LAYOUT["bloom"])
    return sizes["rows"]


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FACT_SCHEMA).parquet(path)


_TABLES: dict[tuple[str, ...], str] = {}
_INPUTS = ("lineitem", "orders", "customer", "nation", "part")


def _memo(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Path of a derived table, built once per application and state of its input files."""
    state = [input_state(spark, f"{sf_dir}/{t}.parquet") for t in _INPUTS]
    key = (app_id(spark), sf_dir, name, *state)
    path = _TABLES.get(key)
    if path is None:
        path = build(scratch_path(spark, name))
        _TABLES[key] = path
    return path


def raw_path(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> str:
        with spread_for(spark, table(spark, sf_dir, "lineitem").count()):
            return write_parquet(raw_transactions(spark, sf_dir), path)

    return _memo(spark, sf_dir, "raw", build)


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw transactions derived from the star tables in ``sf_dir``, written once per
    application as Parquet (the counterpart of the reference's raw transaction file)."""
    return spark.read.schema(RAW_SCHEMA).parquet(raw_path(spark, sf_dir))


def fact_path(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> str:
        raw = raw_table(spark, sf_dir)
        write_fact(quarantine(raw)[0], path, rows=raw.count())
        return path

    return _memo(spark, sf_dir, "fact", build)


def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature fact derived from the star tables in ``sf_dir``, built once per
    application and reused by every query of the registry."""
    return read_fact(spark, fact_path(spark, sf_dir))


def rollup_path(spark: SparkSession, sf_dir: str) -> str:
    """The dashboard's rollups of the fact, built once per application."""

    def build(path: str) -> str:
        write_rollups(export_frame(fact_table(spark, sf_dir)), path)
        return path

    return _memo(spark, sf_dir, "rollup", build)


def run_pipeline(
    spark: SparkSession,
    raw: DataFrame,
    out_dir: str,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    write_parquet_export: bool = False,
) -> dict:
    """The reference job end to end: profile the raw rows (one pass), set bad rows aside,
    clean, add features, write the fact (Parquet by year, a superset of the 21 exported
    columns), the 21-column cleaned export as CSV (and as Parquet by year on request) and six
    summaries. The seven analysis tables come back as small frames over the written report
    passes. Returns the output paths and the profile as small driver-side values.

    The outputs are staged and published together (:mod:`tillroll.sources.publish`): if the job
    fails, those of the last one remain.

    ``raw`` should be a file scan; derive-and-write it first when it comes from a join, as
    :func:`raw_table` does. A CSV scan with its corrupt lines
    (``read_raw_csv(..., with_corrupt=True)``) is landed once, because which lines are
    malformed depends on the columns that a query parses. Every input row is a clean row, a
    duplicate or in the quarantine: ``num_rows = rows_after_dedup + duplicates + quarantined``.
    """
    with staged(spark, out_dir) as stage:
        at = stage.path
        with scratch_scope(spark):
            if CORRUPT in raw.columns:
                raw = pinned(raw)
            good, rejected = quarantine(raw)
            paths = {"quarantine": f"{at}/quarantine", "fact": f"{at}/fact"}
            row, _ = together(spark, lambda: profile_pass(raw).first(), lambda: write_parquet(rejected, paths["quarantine"]))
            prof = row.asDict()
            prof["rows_after_dedup"] = write_fact(good, paths["fact"], max_broadcast_rows, prof["num_rows"])
        prof["quarantined"] = sum(prof[f"quarantined__{r}"] for r in REASONS)
        prof["duplicates"] = prof["num_rows"] - prof["quarantined"] - prof["rows_after_dedup"]
        fact = read_fact(spark, paths["fact"])
        exported, (tables, written) = together(
            spark,
            lambda: _write_export(fact, at, ["csv", "parquet"] if write_parquet_export else ["csv"]),
            lambda: _write_summaries(fact, at),
        )
        paths |= exported | written
        stage.commit(paths)
    return {"paths": paths, "profile": prof, "tables": {k: v for k, v in tables.items() if k in ANALYSES}}


def _write_export(features: DataFrame, out_dir: str, formats: list[str]) -> dict[str, str]:
    cleaned, paths = export_frame(features), {}
    if "csv" in formats:
        paths["cleaned_csv"] = write_csv(cleaned, f"{out_dir}/cleaned.csv")
    if "parquet" in formats:
        paths["cleaned_parquet"] = write_parquet(cleaned, f"{out_dir}/cleaned.parquet", partition_by="year")
    return paths


def _write_summaries(features: DataFrame, out_dir: str) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The report passes and the six summaries, written next to the fact; all tables, and the
    summaries' paths."""

    def keep(df: DataFrame, name: str) -> DataFrame:
        at = write_parquet(df, f"{out_dir}/report/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(at)

    tables = report_tables(features, keep)
    paths = together(features.sparkSession, *[lambda name=name: write_csv(tables[name], f"{out_dir}/{name}.csv") for name in SUMMARIES])
    return tables, dict(zip(SUMMARIES, paths))


def export(features: DataFrame, out_dir: str, fmt: str = "csv") -> dict[str, str]:
    """Write the 21-column cleaned export (``csv`` or ``parquet`` by year) and the six
    summaries (CSV) from a feature frame, with Spark's distributed writers, and publish them
    together."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown format {fmt!r}")
    with staged(features.sparkSession, out_dir) as stage:
        paths = _write_export(features, stage.path, [fmt])
        paths["cleaned"] = paths[f"cleaned_{fmt}"]
        paths |= _write_summaries(features, stage.path)[1]
        stage.commit(paths)
    return paths


def published_summaries(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The six written summaries, read back and stacked: ``summary``, ``key`` (the grouping
    values), ``measure``, ``value``."""
    out = None
    for name in SUMMARIES:
        t, table = SUMMARIES[name], read_summary(spark, paths[name], name)
        measures = [c for c in table.columns if c not in t.keys]
        pairs = [x for m in measures for x in (F.lit(m), F.col(m).cast("double"))]
        long = table.select(
            F.lit(name).alias("summary"),
            F.concat(*[x for i, k in enumerate(t.keys) for x in ([F.lit("|")] if i else []) + [F.col(k).cast("string")]]).alias("key"),
            F.stack(F.lit(len(measures)), *pairs).alias("measure", "value"),
        )
        out = long if out is None else out.union(long)
    return out
