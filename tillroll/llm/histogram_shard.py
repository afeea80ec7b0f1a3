"""Sharding by histogram sort.

Documents are sorted by a key, the hash of the text and then of the id, and cut into shards
of near equal bytes. Splitters are found before any row moves: each round counts the exact
bytes and rows below candidate boundaries (equal steps inside every interval that holds a
wanted cut, ``PROBES`` in all) and narrows to one step, until each cut is within ``tolerance``
of its place or falls between two adjacent keys. The open intervals of a round are key prefixes
of one length, so rows meet theirs by a join on the prefix, however many cuts there are. Then the rows are exchanged once, into many ranges per
shard, and numbered. Built-in functions only.

Equal texts have adjacent keys and share a shard, with one exception: a group that would
move a cut by over ``group_tolerance`` of a shard is cut by id.

Defined results: a null text has size 1; repeated rows (same id and text) are adjacent and
numbered in any order; an empty table gives no rows. Extra columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.joins import pinned

BITS = 12  # of the key that a round may narrow
PROBES = 1 << 16  # boundaries counted per round, hence rows that a round collects
N_SHARDS = 8
RANGE_BYTES = 64 << 20  # bytes of one range of the exchange


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The narrow table that is cut: id, size, checksum and the two parts of the sort key."""
    return docs.select(
        docs[doc_id].alias("doc_id"),
        size_of(docs[text]).alias("size"),
        F.crc32(F.coalesce(docs[text], F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(docs[text]).alias("k1"),
        F.xxhash64(docs[doc_id].cast("string")).alias("k2"),
    )


LOW, HIGH = -(1 << 63), (1 << 63) - 1


def _longs(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def interval(cuts: list[tuple[int, int]]) -> Column:
    """How many of the sorted cuts are at or below the row's key: a binary search in two
    constant arrays, of as many steps as the number of cuts has bits."""
    if not cuts:
        return F.lit(0)
    a, b = _longs([c[0] for c in cuts]), _longs([c[1] for c in cuts])
    k1, k2 = F.col("k1"), F.col("k2")

    def step(acc: Column, _: Column) -> Column:
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        above = (F.get(a, mid) < k1) | ((F.get(a, mid) == k1) & (F.get(b, mid) <= k2))
        going = acc["lo"] < acc["hi"]
        return F.struct(
            F.when(going & above, mid + 1).otherwise(acc["lo"]).alias("lo"),
            F.when(going & ~above, mid).otherwise(acc["hi"]).alias("hi"),
        )

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(cuts).bit_length())), start, step, lambda acc: acc["lo"])


def _histogram(table: DataFrame, part: int, opened: list[tuple[int, int]], width: int, bits: int) -> dict[tuple[int, int], list[tuple[int, int, int]]]:
    """Exact (step, bytes, rows) by open interval. An interval is the keys k1 (k2 of the rows
    with one k1, in part 1) that share all but their last ``width`` bits, and is cut into
    2^``bits`` equal steps. Keys are taken as unsigned, in the order of the signed ones."""
    unsigned = lambda c: F.col(c).bitwiseXOR(F.lit(LOW))
    key, group = (unsigned("k2"), F.col("k1")) if part else (unsigned("k1"), F.lit(0).cast("long"))
    prefix = F.shiftrightunsigned(key, width) if width < 64 else F.lit(0).cast("long")
    step = F.shiftrightunsigned(key, width - bits).bitwiseAND(F.lit((1 << bits) - 1))
    rows = table.select(group.alias("g"), prefix.alias("p"), step.cast("long").alias("step"), "size")
    if part or width < 64:
        # a prefix has at most 64 bits; as a long it may be negative
        wanted = [(g, p - (1 << 64) if p > HIGH else p) for g, p in opened]
        pairs = F.explode(F.arrays_zip(_longs([g for g, _ in wanted]).alias("g"), _longs([p for _, p in wanted]).alias("p")))
        known = table.sparkSession.range(1).select(pairs.alias("x")).select("x.g", "x.p")
        rows = rows.join(F.broadcast(known), ["g", "p"])  # one row per open interval: fewer than cuts
    got = rows.groupBy("g", "p", "step").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for r in sorted(got):
        found.setdefault((r["g"], r["p"] % (1 << 64)), []).append((r["step"], r["b"], r["n"]))
    return found


def find_cuts(table: DataFrame, places: list[int], slack: float, group_slack: float) -> list[dict]:
    """For each wanted place (bytes below), a cut: the key (k1, k2) with the exact bytes and
    rows below it. A cut that falls into a group of equal texts goes to the nearer end of the
    group if that is within ``group_slack``, else into the group, by id: all places are
    narrowed by k1 first, then those inside a group by k2."""
    cuts: list[dict | None] = [None] * len(places)
    # open places: interval (group, prefix), bytes and rows below it
    opened = {i: (0, 0, 0, 0) for i in range(len(places))}
    inner: dict[int, tuple[int, int, int, int]] = {}
    signed = lambda u: u + LOW
    for part in (0, 1):
        width = 64
        while opened:
            intervals = sorted({s[:2] for s in opened.values()})
            bits = max(1, min(BITS, width, (PROBES // len(intervals)).bit_length() - 1))
            found = _histogram(table, part, intervals, width, bits)
            left = width - bits  # bits that a step still has
            still: dict[int, tuple[int, int, int, int]] = {}
            for i, (group, prefix, done, rows) in opened.items():
                chosen = None
                for step, b, n in found.get((group, prefix), []):
                    if done + b > places[i]:
                        chosen = (step, b, n)
                        break
                    done, rows = done + b, rows + n
                if chosen is None:  # the place is at the very end
                    cuts[i] = {"key": (HIGH, HIGH), "bytes": done, "rows": rows}
                    continue
                step, b, n = chosen
                at = (prefix << bits) | step
                low, after = signed(at << left), signed((at + 1) << left)
                if not part:
                    key, end = (low, LOW), (after, LOW) if after <= HIGH else (HIGH, HIGH)
                else:
                    key = (group, low)
                    end = (group, after) if after <= HIGH else ((group + 1, LOW) if group < HIGH else (HIGH, HIGH))
                before, beyond = places[i] - done, done + b - places[i]
                start, stop = {"key": key, "bytes": done, "rows": rows}, {"key": end, "bytes": done + b, "rows": rows + n}
                if before <= slack:
                    cuts[i] = start
                elif beyond <= slack:
                    cuts[i] = stop
                elif left > 0:
                    still[i] = (group, at, done, rows)
                elif part or min(before, beyond) <= group_slack:
                    cuts[i] = start if before <= beyond else stop
                else:  # one text: go on by id
                    inner[i] = (low, 0, done, rows)
            opened, width = still, left
        opened = inner
    return cuts


def shard(docs: DataFrame, n_shards: int = N_SHARDS, tolerance: float = 0.002, group_tolerance: float = 0.05,
          range_bytes: int = RANGE_BYTES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``k1``, ``k2``, ``shard`` and ``slot`` (gapless
    from 0 in each shard, in key order)."""
    table = pinned(keyed(docs, doc_id, text))
    total, rows = table.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    # ranges per shard: of about range_bytes of text, and at most 4096 in all
    per = max(1, min(4096 // n_shards, -(-total // (n_shards * range_bytes)), rows))
    n = n_shards * per
    slack = total / n_shards * tolerance
    cuts = find_cuts(
        table, [total * i // n for i in range(1, n)], min(slack, total / n / 4), total / n_shards * group_tolerance
    ) if rows else []
    order = sorted(range(len(cuts)), key=lambda i: cuts[i]["key"])
    cuts = [cuts[i] for i in order]
    below = [0, *[c["rows"] for c in cuts]]
    first = [below[(i // per) * per] if rows else 0 for i in range(n)]
    offset = F.array(*[F.lit(below[i] - first[i]).cast("long") for i in range(n)]) if rows else F.array(F.lit(0).cast("long"))
    ranged = table.withColumn("range", interval([c["key"] for c in cuts]))
    place = Window.partitionBy("range").orderBy("k1", "k2", "doc_id")
    return ranged.select(
        "doc_id", "size", "text_crc32", "k1", "k2",
        F.floor(F.col("range") / per).cast("int").alias("shard"),
        (F.get(offset, F.col("range")) + F.row_number().over(place) - 1).alias("slot"),
    )


def report(docs: DataFrame, **options) -> DataFrame:
    return shard(docs, **options).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
