"""Positions without a window over a whole key or over the whole table.

``row_number() over (partition by key order by seq)`` sends every row of a key to one
task, so a key holding a third of the log becomes a third of the job in one task. The
helpers here cut the order into ranges of about ROWS_PER_RANGE rows, count rows per key and
range (a map-side combined aggregate), turn the counts into offsets on that small table, and
number rows only inside a range. The largest window partition is then one key's share of one range.

The cuts are sampled splitters in two levels, for any orderable type: values whose hash falls
into a thin class are sorted; some square root of the number of ranges of them are literals in
the plan, and each range between two of those has its own splitters in a small written table.
So ranges keep their size however long the table is, and every pass agrees on the cuts.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollwise.session import checkpoint_path

ROWS_PER_RANGE = 100_000
SAMPLES_PER_RANGE = 64
#: a splitter of a string column needs no more of the string than this
SPLITTER_CHARS = 64


@dataclass
class Ranges:
    """Splitters of an order: ``coarse`` values, and a table (_rw_c, _rw_fine) of the splitters between them (None: none)."""

    coarse: list
    fine: DataFrame | None

    def tag(self, df: DataFrame, order_col: str) -> DataFrame:
        """Add ``_rw_range``, which grows with the value (NULL orders have the first)."""
        kind = df.schema[order_col].dataType.simpleString()

        def upto(some: Column) -> Column:
            return F.coalesce(F.size(F.filter(some, lambda e: e <= F.col(order_col))), F.lit(0)).cast("bigint")

        if self.fine is None:
            return df.withColumn("_rw_range", F.lit(0).cast("bigint"))
        # Exploded, not named: the planner would carry the expression of a named column over to the splitters'
        # side of the join as a filter, where the order column is not.
        coarse = F.explode(F.array(upto(F.lit(self.coarse).cast(f"array<{kind}>")))) if self.coarse else F.lit(0).cast("bigint")
        # A splitter is a number or at most SPLITTER_CHARS characters, and there are as many as ranges.
        joined = df.withColumn("_rw_c", coarse).join(F.broadcast(self.fine), "_rw_c", "left")
        return joined.withColumn("_rw_range", F.col("_rw_c") * (1 << 32) + F.greatest(upto(F.col("_rw_fine")), F.lit(0))).drop("_rw_c", "_rw_fine")


def ranges(df: DataFrame, order_col: str, n_ranges: int | None = None) -> Ranges:
    """Splitters that cut the rows into about ``n_ranges`` ranges of about equally many rows.

    ``n_ranges`` defaults to one per ROWS_PER_RANGE rows. Only the coarse splitters, some
    square root of their number, reach the driver.
    """
    rows = df.select(F.count(order_col)).first()[0]
    if n_ranges is None:
        n_ranges = -(-rows // ROWS_PER_RANGE)
    if n_ranges <= 1:
        return Ranges([], None)
    value = F.col(order_col)
    if isinstance(df.schema[order_col].dataType, T.StringType):
        value = F.left(value, F.lit(SPLITTER_CHARS))
    n_coarse = isqrt(n_ranges - 1) + 1
    n_fine = -(-n_ranges // n_coarse)
    thin = max(1, rows // (SAMPLES_PER_RANGE * n_ranges))  # one value in so many is a sample
    sample = df.filter(F.col(order_col).isNotNull()).select(order_col).filter(F.pmod(F.xxhash64(order_col), F.lit(thin)) == 0).select(value.alias("_rw_v"))
    # One sample in n_fine is looked at for the coarse splitters.
    top = [r["_rw_v"] for r in sample.filter(F.pmod(F.xxhash64(F.col("_rw_v"), F.lit(1)), F.lit(n_fine)) == 0).distinct().orderBy("_rw_v").collect()]
    coarse = top[:: max(1, len(top) // n_coarse)][1:]
    kind = df.schema[order_col].dataType.simpleString()
    at = F.size(F.filter(F.lit(coarse).cast(f"array<{kind}>"), lambda e: e <= F.col("_rw_v"))).cast("bigint") if coarse else F.lit(0).cast("bigint")
    per = sample.withColumn("_rw_c", at).groupBy("_rw_c").agg(F.array_sort(F.collect_set("_rw_v")).alias("_rw_all"))
    step = F.greatest(F.expr(f"CAST(size(_rw_all) div {n_fine} AS INT)"), F.lit(1))
    picked = F.filter("_rw_all", lambda v, i: (i > 0) & (i % step == 0))
    path = checkpoint_path(df.sparkSession, f"splitters-{uuid.uuid4().hex}")
    per.select("_rw_c", picked.alias("_rw_fine")).write.parquet(path)
    fine = df.sparkSession.read.schema(f"_rw_c bigint, _rw_fine array<{kind}>").parquet(path)
    return Ranges(coarse, fine)


def key_columns(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """Two columns without NULL per key (its value or a stand-in, and whether it is NULL): equality on them is null-safe."""
    types = dict(df.dtypes)
    out = {}
    for i, k in enumerate(keys):
        blank = F.lit("").cast("string") if types[k] == "string" else F.lit(0).try_cast(types[k])
        if types[k] in ("date", "timestamp", "timestamp_ntz"):
            blank = F.lit("1970-01-01").cast(types[k])
        out[f"_rw_k{i}"] = F.coalesce(F.col(k), blank)
        out[f"_rw_n{i}"] = F.col(k).isNull()
    return out


def rank_within_key(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    *,
    out: str = "pos",
    count_col: str | None = None,
    n_ranges: int | None = None,
    starts: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: 0-based position of the row within ``keys`` ordered by ``order_col``.

    ``order_col`` is unique within a key (an append sequence) and of any orderable type; NULL
    keys form a group of their own and NULL orders come first. ``count_col`` optionally adds
    the key's total row count. ``starts`` (the keys, one row each, and a bigint ``start``) has the
    position to count from, where it is not 0. One plan for every size.
    """
    keys = list(keys)
    cuts = ranges(df, order_col, n_ranges)
    named = key_columns(df, keys)
    by = [*named, "_rw_range"]
    tagged = cuts.tag(df.withColumns(named) if named else df, order_col)
    counts = tagged.groupBy(*by).agg(F.count(F.lit(1)).alias("_rw_n"))
    # One narrow row per key and range that has rows.
    before = Window.partitionBy(*named).orderBy("_rw_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_rw_off", F.coalesce(F.sum("_rw_n").over(before), F.lit(0)))
    if count_col:
        offsets = offsets.withColumn(count_col, F.sum("_rw_n").over(Window.partitionBy(*named)))
    if starts is not None:  # added to the offsets, which are dealt by key already: the rows need no shuffle by key
        first = starts.select(*[c.alias(x) for x, c in key_columns(starts, keys).items()], F.col("start").alias("_rw_start"))
        counted = F.col("_rw_off") + F.coalesce("_rw_start", F.lit(0))
        offsets = offsets.join(first, on=[*named], how="left").withColumn("_rw_off", counted).drop("_rw_start")
    # Rows are hashed on (key, range) — not on the key alone — so a hot key spreads over
    # tasks whichever join strategy runs; a sort-merge join needs this partitioning anyway.
    joined = tagged.repartition(*by).join(offsets.drop("_rw_n"), on=by, how="inner")
    local = Window.partitionBy(*by).orderBy(order_col)
    return joined.withColumn(out, (F.row_number().over(local) - F.lit(1) + F.col("_rw_off")).cast("bigint")).drop(*by, "_rw_off")


def first_by(df: DataFrame, order_col: str, n: int, *, newest: bool = False, n_ranges: int | None = None) -> DataFrame:
    """The first ``n`` rows by ``order_col`` (the last ``n`` when ``newest``), of any orderable type.

    Narrow counts per range tell which ranges can hold them; only rows of those ranges reach
    the final top-N, so scan tasks do not each ship ``n`` whole rows.
    """
    order = F.col(order_col).desc() if newest else F.col(order_col).asc()
    tagged = ranges(df, order_col, n_ranges).tag(df, order_col)
    counts = tagged.groupBy("_rw_range").agg(F.count(F.lit(1)).alias("_rw_n"))
    side = F.col("_rw_range").desc() if newest else F.col("_rw_range").asc()
    before = Window.orderBy(side).rowsBetween(Window.unboundedPreceding, -1)  # a narrow row per range
    used = counts.withColumn("_rw_off", F.coalesce(F.sum("_rw_n").over(before), F.lit(0))).filter(F.col("_rw_off") < n)
    kept = tagged.join(used.select("_rw_range"), "_rw_range", "left_semi").drop("_rw_range")
    return kept.orderBy(order).limit(n)


def global_positions(
    df: DataFrame,
    sort_key: str,
    tie_key: str | Sequence[str],
    *,
    out: str = "gpos",
    prefix_chars: int = 4,
    first: int | None = None,
) -> DataFrame:
    """0-based position of each row in the order ``(sort_key, tie_key)`` over the whole table.

    ``first`` keeps only the first so many rows: buckets beyond them are dropped before any row is shuffled.

    ``sort_key`` must be a hex string (an md5), so its first ``prefix_chars`` characters
    split the rows into at most 16**prefix_chars evenly filled buckets. Counts per bucket
    (at most 65,536 rows by default, a proven bound) are turned into offsets and broadcast;
    rows are numbered only within their bucket.
    """
    n_buckets = 16**prefix_chars
    bucketed = df.withColumn("_gp_b", F.coalesce(F.substring(F.col(sort_key), 1, prefix_chars), F.lit("")))
    counts = bucketed.groupBy("_gp_b").agg(F.count(F.lit(1)).alias("_gp_n"))
    before = Window.orderBy("_gp_b").rowsBetween(Window.unboundedPreceding, -1)
    # The window above has no partition key on purpose: its input is the bucket table,
    # at most n_buckets rows whatever the data size.
    offsets = counts.withColumn("_gp_off", F.coalesce(F.sum("_gp_n").over(before), F.lit(0))).drop("_gp_n")
    assert n_buckets <= 1 << 20, "bucket table must stay small enough to broadcast"
    if first is not None:
        offsets = offsets.filter(F.col("_gp_off") < first)
    joined = bucketed.join(F.broadcast(offsets), on="_gp_b", how="inner")
    ties = [tie_key] if isinstance(tie_key, str) else list(tie_key)
    local = Window.partitionBy("_gp_b").orderBy(sort_key, *ties)
    placed = joined.withColumn(out, (F.row_number().over(local) - F.lit(1) + F.col("_gp_off")).cast("bigint"))
    return (placed if first is None else placed.filter(F.col(out) < first)).drop("_gp_b", "_gp_off")
