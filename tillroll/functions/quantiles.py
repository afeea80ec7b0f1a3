"""Exact quantiles by histograms of nested bins, in a fixed number of scans.

Spark's exact ``percentile`` keeps every distinct value in one final task. Here the target ranks
are closed in on digit by digit, for all columns and probabilities at once:

1. one aggregate gives rows, least and greatest value per column;
2. a scan counts the rows of at most about ``accuracy`` bins per column, with the least and
   greatest value of each (map-side partial aggregation: a value that a third of all rows hold is
   one row per task). Running sums over the bins find the bin of each target rank; a bin of one
   value is an answer;
3. the other bins are split in the same way, or, once they hold no more than ``max_rows`` rows,
   by value.

The bin of a value grows with it. Whole numbers, dates and decimals drop the low bits of their
64-bit code. Doubles over several magnitudes are first put in bins by logarithm, which leaves two
per cent between the ends of a bin at most, then by equal parts of what is left. A scan takes 16
bits off, so four of them end it whatever the data; 10^12 evenly spread doubles need two. No row
is shuffled, only bins are; what reaches the driver is one bin per target rank.

Semantics match SQL ``percentile_disc`` (``method="disc"``: first value whose cumulative
share reaches p) and ``percentile_cont`` (``method="linear"``: interpolation between the
values at ranks floor/ceil of (n-1)p). NaN is the greatest double.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, DoubleType, FloatType, IntegralType

# Bins into which one scan splits what is left of a column.
BINS = 1 << 16
# Rows that a bin may hold before its values are counted one by one.
MAX_ROWS = 100_000
# Doubles whose ends are further apart than this factor are put in bins by logarithm.
MAGNITUDE = 1024.0


def _ranks(n: int, p: float, method: str) -> tuple[int, int, float]:
    """The two 1-based target ranks and the weight of the second."""
    if method == "disc":
        r = max(math.ceil(p * n), 1)
        return r, r, 0.0
    if method != "linear":
        raise ValueError(f"unknown method {method!r}")
    pos = (n - 1) * p
    return math.floor(pos) + 1, math.ceil(pos) + 1, pos - math.floor(pos)


def _check(kinds: dict[str, DataType]) -> None:
    for c, kind in kinds.items():
        if not isinstance(kind, (IntegralType, DoubleType, FloatType, DateType)) and not (
            isinstance(kind, DecimalType) and kind.precision <= 18
        ):
            raise TypeError(f"no exact quantiles of {c}: {kind.simpleString()}")


def _code(value, kind: DataType) -> int:
    """The 64-bit code of a whole number, date or decimal; as :func:`_code_column` gives it."""
    if isinstance(value, dt.date):
        return (value - dt.date(1970, 1, 1)).days
    return int(Decimal(value).scaleb(kind.scale)) if isinstance(kind, DecimalType) else int(value)


def _code_column(x: Column, kind: DataType) -> Column:
    if isinstance(kind, DateType):
        return F.unix_date(x).cast("long")
    if isinstance(kind, DecimalType):
        return (x.cast("decimal(38,18)") * F.lit(10**kind.scale)).cast("long")
    return x.cast("long")


def _logarithm(x: float) -> float:
    return math.copysign(math.log(abs(x)) + 745.0, x) if x else 0.0


def _bin(x: Column, kind: DataType, lo, hi, rows: int, accuracy: int, max_rows: int) -> Column | None:
    """The bin of a value between ``lo`` and ``hi``; None if values are to be counted one by one."""
    if rows <= max_rows:
        return None
    if not isinstance(kind, (DoubleType, FloatType)):
        a, b, shift = _code(lo, kind), _code(hi, kind), 0
        while (b >> shift) - (a >> shift) >= accuracy:
            shift += 1
        return F.shiftright(_code_column(x, kind), shift) if shift else None
    if not (math.isfinite(lo) and math.isfinite(hi)):
        # infinities and NaN have bins of their own
        finite = _bin(x, kind, -sys.float_info.max, sys.float_info.max, rows, accuracy, max_rows)
        above = F.when(F.isnan(x), accuracy + 3).when(x == float("inf"), accuracy + 2)
        return above.when(x == float("-inf"), -1).otherwise(finite)
    x = x.cast("double")
    if lo <= 0 <= hi or max(abs(lo), abs(hi)) > MAGNITUDE * min(abs(lo), abs(hi)):
        # logarithms don't fall where their argument grows, nor do sums and products by constants
        size = F.log(F.abs(x)) + 745.0
        x = F.when(x > 0, size).when(x < 0, -size).otherwise(0.0)
        lo, hi = _logarithm(lo) - 1e-9, _logarithm(hi) + 1e-9
    return F.floor((x - lo) * (accuracy / (hi - lo)))


def column_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """Rows with a value, least and greatest value of each column, from one aggregate."""
    each = [(f"n{i}", F.count(c)) for i, c in enumerate(columns)]
    each += [(f"lo{i}", F.min(c)) for i, c in enumerate(columns)] + [(f"hi{i}", F.max(c)) for i, c in enumerate(columns)]
    got = df.agg(*[x.alias(name) for name, x in each]).first()
    return {c: (got[f"n{i}"], got[f"lo{i}"], got[f"hi{i}"]) for i, c in enumerate(columns)}


def _split(df: DataFrame, spans: list[dict], kinds: dict[str, DataType], common: str) -> DataFrame:
    """The bins of the spans: ``id`` of the span, ``bin``, rows ``c``, least and greatest value,
    and ``upto``, the rows of the span up to the bin's end."""
    used = list(dict.fromkeys(s["column"] for s in spans))
    cells, some = [], None
    for c in used:
        cell = None
        for i, s in enumerate(spans):
            if s["column"] == c:
                there = F.col(c).between(F.lit(s["lo"]), F.lit(s["hi"]))
                v = F.col(c).cast(common)
                # two keys: a bin's number where values are put in bins, else the value
                at = F.struct(
                    F.lit(i).alias("id"),
                    (F.lit(0) if s["bin"] is None else s["bin"]).cast("long").alias("bin"),
                    (v if s["bin"] is None else F.lit(None).cast(common)).alias("one"),
                    v.alias("v"),
                )
                cell = F.when(there, at) if cell is None else cell.when(there, at)
                some = there if some is None else some | there
        cells.append(cell)
    rows = df.select(*used).where(some)
    rows = rows.select((F.explode(F.array(*cells)) if len(cells) > 1 else cells[0]).alias("x"))
    bins = rows.groupBy("x.id", "x.bin", "x.one").agg(F.count(F.lit(1)).alias("c"), F.min("x.v").alias("lo"), F.max("x.v").alias("hi"))
    # a span has at most as many bins as a scan makes, or rows to be counted one by one
    upto = Window.partitionBy("id").orderBy("bin", "one").rowsBetween(Window.unboundedPreceding, 0)
    return bins.withColumn("upto", F.sum("c").over(upto))


def rank_values(
    df: DataFrame, ranges: dict[str, tuple], ranks: dict[str, set[int]], accuracy: int = BINS, max_rows: int = MAX_ROWS
) -> tuple[dict[tuple[str, int], object], int]:
    """The value at each 1-based rank of each column, and the number of scans it took."""
    kinds = {c: df.schema[c].dataType for c in ranks}
    _check(kinds)
    common = next(iter(kinds.values())).simpleString() if len(kinds) == 1 else "double"
    found: dict[tuple[str, int], object] = {}
    spans = []
    for c, wanted in ranks.items():
        n, lo, hi = ranges[c]
        if n and lo == hi:
            found |= {(c, r): lo for r in wanted}
        elif n:
            spans.append({"column": c, "lo": lo, "hi": hi, "rows": n, "below": 0, "ranks": wanted})
    scans = 0
    while spans:
        scans += 1
        for s in spans:
            c = s["column"]
            s["bin"] = _bin(F.col(c), kinds[c], s["lo"], s["hi"], s["rows"], accuracy, max_rows)
        wanted = None
        for i, s in enumerate(spans):
            for r in sorted(s["ranks"]):
                hit = (F.col("id") == i) & (F.col("upto") >= r - s["below"]) & (F.col("upto") - F.col("c") < r - s["below"])
                wanted = hit if wanted is None else wanted | hit
        left = []
        for b in _split(df, spans, kinds, common).where(wanted).collect():
            s = spans[b["id"]]
            below = s["below"] + b["upto"] - b["c"]
            mine = {r for r in s["ranks"] if below < r <= below + b["c"]}
            if b["lo"] == b["hi"] or s["bin"] is None:
                found |= {(s["column"], r): b["lo"] for r in mine}
            else:
                left.append(s | {"lo": b["lo"], "hi": b["hi"], "rows": b["c"], "below": below, "ranks": mine})
        spans = left
    return found, scans


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    method: str = "disc",
    accuracy: int = BINS,
    max_rows: int = MAX_ROWS,
    ranges: dict[str, tuple] | None = None,
) -> DataFrame:
    """One row per column that has non-null values: ``column, n, <names...>``.

    With several columns values are compared as doubles; one column keeps its type. ``df`` is
    read a few times, only the columns asked for: give a file scan or a written table.
    ``ranges`` (rows, least and greatest value per column) saves a scan if they are known.
    """
    if accuracy < 2:
        raise ValueError("accuracy must be 2 at least")
    names = list(names or [f"p{i}" for i in range(len(probs))])
    values = df.select(*columns)
    kind = values.schema.fields[0].dataType if len(columns) == 1 else DoubleType()
    _check({f.name: f.dataType for f in values.schema.fields})
    ranges = ranges or column_ranges(values, columns)
    targets = [(c, name, *_ranks(ranges[c][0], float(p), method)) for c in columns if ranges[c][0] for p, name in zip(probs, names)]
    wanted: dict[str, set[int]] = {}
    for c, _, r1, r2, _ in targets:
        wanted.setdefault(c, set()).update((r1, r2))
    at, _ = rank_values(values, ranges, wanted, accuracy, max_rows)
    rows = [(c, ranges[c][0], name, at[c, r1], at[c, r2], w) for c, name, r1, r2, w in targets]
    schema = "column string, n long, name string, a {0}, b {0}, w double".format(kind.simpleString())
    one = df.sparkSession.createDataFrame(rows, schema)
    if method == "linear":
        a, b = F.col("a").cast("double"), F.col("b").cast("double")
        one = one.withColumn("a", a + F.col("w") * (b - a))
    return one.groupBy("column").agg(
        F.max("n").alias("n"), *[F.max(F.when(F.col("name") == name, F.col("a"))).alias(name) for name in names]
    )


def percentile_disc(
    df: DataFrame, column: str, p: float, name: str = "value", ranges: dict[str, tuple] | None = None
) -> DataFrame:
    """One-row frame ``(<name>)`` with the exact discrete percentile of ``column``; no row if
    the column has no value."""
    return exact_quantiles(df, [column], [p], [name], method="disc", ranges=ranges).select(name)
