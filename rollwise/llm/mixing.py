"""Operator 3, mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of ``block_rows`` documents. With target weight w, its k-th block
is released at slot floor(k / w) and due by slot ceil((k + 1) / w); every slot goes to the
released block due first (ties to the source listed first). Weights are exact ratios of whole
numbers: of the given ones where their sum stays below 2^31, else of 2^62 parts. There is no
period: after any number of slots each source has its weighted share to within less than one block. That holds up to the first slot at
which a source may have run out (``on_target``); the blocks left then follow by deadline.

The schedule is laid out in ranges of ``RANGE_SLOTS`` slots, each by a task of its own. Where a
range begins at slot T, the blocks due by T are done, and of the blocks released before T and
due after it (one per source at most) those done are known without the slots before: a set can
be done by T if for every a at most T - a of its blocks are released at a or later, and earliest
deadline first gives, of all such sets, the one with the earliest deadlines. So a task finds its
start by one walk over these blocks, latest release first, and schedules its slots from there;
the walk goes back as far as the earliest of them was released, the reach of the lightest source.
What is left at the end is ranged by deadline: the number of blocks due by D is the sum of
floor(w D), so a task finds the deadlines of its ranks by bisection.

A document's number inside its source comes from counts per (source, hash range): ranges are
made small enough that a hot source spreads over many tasks, only narrow rows are counted, and
rows are numbered inside a range, whose row also carries the slots of its blocks. Nothing is
dropped or repeated. The driver and each laying-out task hold one number per source, never documents.

Defined cases: a null source is a source of its own; a null doc_id and repeated rows are rows
like any others (rows equal in doc_id and text are numbered in any order); a source of weight
zero is refused when it has rows; an empty table gives an empty result; extra columns are
ignored by ``schedule`` and kept by ``mix``; null and empty texts count like any document.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from math import ceil, gcd, lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollwise.llm.common import packed, stage, text_key, unpacked

BLOCK_ROWS = 32
#: without given weights, a source's weight is its number of documents to this power
TEMPERATURE = 0.5
RANGE_ROWS = 1024
MAX_RANGES = 1 << 24
RANGE_SLOTS = 1 << 16
#: slots looked at together on the way back from the start of a range
WINDOW = 1 << 18
#: weights are whole numbers of this many parts
WHOLE = 1 << 62


def shares(weights: list) -> tuple[list[int], int]:
    """Whole numbers in the ratio of the weights, and their sum.

    Exact where the sum stays below 2^31 (a float counts as the decimal number it is written as),
    else parts of WHOLE, rounded by largest remainders.
    """
    if any(not w > 0 for w in weights):
        raise ValueError("every source needs a positive weight")
    exact = [Fraction(str(w)) if isinstance(w, float) else Fraction(w) for w in weights]
    scale = lcm(*(x.denominator for x in exact))
    out = [int(x * scale) for x in exact]
    common = gcd(*out)
    out = [x // common for x in out]
    total = sum(out)
    if total < 1 << 31:
        return out, total
    rest = [x * WHOLE % total for x in out]
    out = [max(1, x * WHOLE // total) for x in out]
    order = sorted(range(len(out)), key=lambda s: -rest[s])
    for s in order[: max(0, WHOLE - sum(out))]:
        out[s] += 1
    out[out.index(max(out))] += WHOLE - sum(out)  # what sources below one part take
    return out, WHOLE


class Timetable:
    """Earliest deadline first over sources with shares ``p`` of ``whole`` and numbers of blocks ``blocks``."""

    def __init__(self, p: list[int], whole: int, blocks: list[int]) -> None:
        self.p, self.whole, self.blocks = p, whole, blocks
        self.high, self.low = np.array([x >> 31 for x in p], np.int64), np.array([x & (1 << 31) - 1 for x in p], np.int64)
        #: every source has blocks left up to this slot
        self.end = min((b * whole // x for x, b in zip(p, blocks)), default=0)
        self.total = sum(blocks)

    def release(self, s: int, k: int) -> int:
        return k * self.whole // self.p[s]

    def deadline(self, s: int, k: int) -> int:
        return -(-(k + 1) * self.whole // self.p[s])

    def due(self, t) -> np.ndarray:
        """Blocks of each source due by slot ``t`` (one, or one for each): floor(w t), exactly."""
        if np.max(t, initial=0) < 1 << 31:
            if self.whole < 1 << 31:
                return self.low * t // self.whole
            return (self.high * t + (self.low * t >> 31)) >> 31
        return np.array([x * int(u) // self.whole for x, u in zip(self.p, np.broadcast_to(t, len(self.p)), strict=True)], np.int64)

    def released(self, t) -> np.ndarray:
        """Blocks of each source released before slot ``t`` (one, or one for each): ceil(w t), exactly."""
        if np.max(t, initial=0) < 1 << 31:
            if self.whole < 1 << 31:
                return -(-self.low * t // self.whole)
            low = self.low * t
            return (self.high * t + (low >> 31) + (1 << 31) - 1 + ((low & (1 << 31) - 1) > 0)) >> 31
        return np.array([-(-x * int(u) // self.whole) for x, u in zip(self.p, np.broadcast_to(t, len(self.p)), strict=True)], np.int64)

    def _releases(self, s: np.ndarray, k: np.ndarray) -> np.ndarray:
        """floor(k / w) of blocks ``k`` of sources ``s``: a float guess, set right by exact counts."""
        guess = (k * (self.whole / np.array(self.p, float)[s])).astype(np.int64)
        each = Timetable([self.p[i] for i in s.tolist()], self.whole, [])
        guess -= each.released(guess) > k
        return guess + (each.released(guess + 1) <= k)

    def _room(self, t: int, due: np.ndarray, releases: np.ndarray) -> np.ndarray:
        """For each of the falling ``releases``: the least room at it, or between it and the next one.

        The room at a is t - a, less the blocks due by t and released at a or later.
        """
        out = np.full(len(releases), t)
        later, hi, last = 0, t, int(releases[-1])
        rising = releases[::-1]
        while hi > last:
            lo = max(last, hi - WINDOW)
            first, stop = self.released(lo), np.minimum(self.released(hi), due)
            many = np.maximum(stop - first, 0)
            s = np.repeat(np.arange(len(many)), many)
            k = np.arange(len(s)) - np.repeat(np.cumsum(many) - many, many) + first[s]
            since = later + np.cumsum(np.bincount(self._releases(s, k) - lo, minlength=hi - lo)[::-1])[::-1]
            later, a = int(since[0]), np.arange(lo, hi)
            at = np.searchsorted(rising, a)  # the least release at or above a
            some = at < len(rising)
            np.minimum.at(out, len(rising) - 1 - at[some], (t - a - since)[some])
            hi = lo
        return out

    def done(self, t: int) -> np.ndarray:
        """Blocks of each source that earliest deadline first has done by slot ``t``."""
        due = self.due(t)
        open_: dict[int, list[int]] = {}
        for s in np.flatnonzero(self.released(t) > due).tolist():
            open_.setdefault(self.release(s, int(due[s])), []).append(s)
        out, chosen = due.copy(), []  # heap of (deadline, source), the latest first
        if open_:
            releases = np.array(sorted(open_, reverse=True), np.int64)
            for a, room in zip(releases.tolist(), self._room(t, due, releases).tolist(), strict=True):
                for s in open_[a]:
                    heapq.heappush(chosen, (-self.deadline(s, int(due[s])), -s))
                while len(chosen) > room:
                    heapq.heappop(chosen)
        while len(chosen) > t - int(due.sum()):
            heapq.heappop(chosen)
        for _, s in chosen:
            out[-s] += 1
        return out

    def slots(self, first: int, stop: int) -> Iterator[tuple[int, int, int, int, int]]:
        """(source, block, slot, release, deadline) for every slot from ``first`` up to ``stop``."""
        done = self.done(first).tolist()
        waiting = [(self.release(s, k), s) for s, k in enumerate(done)]
        heapq.heapify(waiting)
        ready: list[tuple[int, int, int]] = []
        for slot in range(first, stop):
            while waiting and waiting[0][0] <= slot:
                release, s = heapq.heappop(waiting)
                heapq.heappush(ready, (self.deadline(s, done[s]), s, release))
            deadline, s, release = heapq.heappop(ready)
            yield s, done[s], slot, release, deadline
            done[s] += 1
            heapq.heappush(waiting, (self.release(s, done[s]), s))

    def rest(self, first: int, stop: int) -> Iterator[tuple[int, int, int, int, int]]:
        """The same for ranks from ``first`` up to ``stop`` of the blocks left at ``end``, by (deadline, source)."""
        done, blocks = self.done(self.end), np.array(self.blocks, np.int64)

        def upto(d: int) -> np.ndarray:
            return np.clip(self.due(d), done, blocks)

        def bisect(rank: int) -> int:
            """The least deadline by which more than ``rank`` of these blocks are due."""
            lo, hi = self.end, self.end + 1
            while int((upto(hi) - done).sum()) <= rank:
                lo, hi = hi, 2 * hi
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (lo, mid) if int((upto(mid) - done).sum()) > rank else (mid, hi)
            return hi

        early, late = bisect(first) - 1, bisect(stop - 1)
        before, after = upto(early), upto(late)
        found = sorted(
            (self.deadline(s, k), s, k) for s in np.flatnonzero(after > before).tolist() for k in range(int(before[s]), int(after[s]))
        )
        rank = int((before - done).sum())
        for i, (deadline, s, k) in enumerate(found, rank):
            if first <= i < stop:
                yield s, k, self.end + i, self.release(s, k), deadline


def layout(spark: SparkSession, table: Timetable) -> DataFrame:
    """(_source, block, slot, release, deadline) of every block, each range by a task of its own; written."""
    shared = spark.sparkContext.broadcast((table.p, table.whole, table.blocks))  # two numbers per source
    on, rest = table.end, table.total - table.end
    ranges = [(lo, min(lo + RANGE_SLOTS, on), True) for lo in range(0, on, RANGE_SLOTS)] + [(lo, min(lo + RANGE_SLOTS, rest), False) for lo in range(0, rest, RANGE_SLOTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_source", "block", "slot", "release", "deadline"]
        for b in batches:
            for first, stop, on_target in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                table = Timetable(*shared.value)
                rows = list(table.slots(first, stop) if on_target else table.rest(first, stop))
                for lo in range(0, len(rows), 8192):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[lo : lo + 8192], strict=True)], names=names)

    asked = spark.createDataFrame(ranges, "first long, stop long, on_target boolean").repartition(max(1, len(ranges)))
    return stage(asked.mapInArrow(run, "_source long, block long, slot long, release long, deadline long"), "mixing-layout")


def _numbered(rows: DataFrame, total: int, sources: DataFrame, placed: DataFrame, block_rows: int) -> DataFrame:
    """``rows`` (source, h, more) with ``number``, from 0 within the source by (h, doc_id, th), and ``at``, its block's place."""
    bits = min(max(0, ceil(total / RANGE_ROWS) - 1).bit_length(), MAX_RANGES.bit_length() - 1)
    at = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")
    # Equality on these two is null-safe, so the join and the window share a shuffle.
    rows = rows.withColumns({"_s": F.coalesce("source", F.lit("")), "_n": F.col("source").isNull(), "_at": at})
    counts = rows.groupBy("_s", "_n", "_at").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("_s", "_n").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(counts.select("_s", "_n", "_at", "n", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("start")), "mixing-starts")
    # The places of the blocks of each hash range: RANGE_ROWS rows have some RANGE_ROWS / block_rows of them.
    each = starts.join(sources, ["_s", "_n"]).withColumn("block", F.explode(F.expr(f"sequence(start div {block_rows}, (start + n - 1) div {block_rows})")))
    found = each.join(placed, ["_source", "block"]).groupBy("_s", "_n", "_at")
    found = found.agg(F.min("start").alias("start"), F.array_sort(F.collect_list(F.struct("block", "slot", "release", "deadline"))).alias("_blocks"))
    found = stage(found, "mixing-places")
    inside = F.row_number().over(Window.partitionBy("_s", "_n", "_at").orderBy("h", "doc_id", "th"))
    out = rows.join(found, ["_s", "_n", "_at"]).withColumn("number", F.col("start") + inside - 1)
    own = F.expr(f"CAST(number div {block_rows} - start div {block_rows} AS INT)")
    return out.withColumn("at", F.get("_blocks", own)).drop("_s", "_n", "_at", "start", "_blocks")


def _placed(rows: DataFrame, weights: dict | None, block_rows: int) -> DataFrame:
    """``rows`` (doc_id, th, source, more) with block, release, deadline, slot, mix_position and on_target."""
    spark = rows.sparkSession
    counts = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.count("*").alias("n")).collect()}  # a row per source
    order = sorted(counts, key=lambda s: (s is None, s))
    given = [counts[s] ** TEMPERATURE if weights is None else weights.get(s, 0) for s in order]
    table = Timetable(*shares(given), [-(-counts[s] // block_rows) for s in order])
    sources = spark.createDataFrame([(s or "", s is None, i) for i, s in enumerate(order)], "_s string, _n boolean, _source long")
    h = F.xxhash64(F.col("doc_id"), F.col("th"))
    out = _numbered(rows.withColumn("h", h), sum(counts.values()), sources, layout(spark, table), block_rows)
    slot = F.col("at.slot")
    return out.withColumns(
        {
            "block": F.col("at.block"),
            "release": F.col("at.release"),
            "deadline": F.col("at.deadline"),
            "slot": slot,
            "mix_position": slot * block_rows + F.col("number") % block_rows,
            "on_target": slot < table.end,
        }
    ).drop("at", "h", "number")


def schedule(docs: DataFrame, weights: dict | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, source, block, release, deadline, slot, mix_position and on_target of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("th"), F.col("source").cast("string").alias("source"))
    return _placed(stage(rows, "mixing-rows"), weights, block_rows).drop("th")


def mix(docs: DataFrame, weights: dict | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` in mixed order: ranges of mix_position, sorted inside, all rows and columns kept."""
    rows = packed(docs, F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("th"), F.col("source").cast("string").alias("source"))
    placed = _placed(rows, weights, block_rows)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return unpacked(placed.select("_row", "mix_position").repartitionByRange(parts, "mix_position").sortWithinPartitions("mix_position"))
