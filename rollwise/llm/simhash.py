"""Operator 4, SimHash near-dedup by the generalised pigeonhole principle.

A document's 64-bit fingerprint has a bit set when more than half of its shingle hashes
(XXH64, seed 42) have it. Equal fingerprints are merged first, so copies never meet again.
Two fingerprints link when they differ in at most ``max_distance`` bits:

* Bit statistics of all distinct fingerprints (64 x 64 co-occurrence counts, summed in Spark)
  tell which bits are correlated; correlated bits are grouped into the same partition.
* Unequal thresholds t_i per partition with sum(t_i + 1) = max_distance + 1 are allocated by
  dynamic programming on the estimated rows and candidates; a linked pair then differs in at
  most t_i bits of some partition i (t_i = -1: partition unused). The number of partitions is
  chosen the same way. The estimates steer cost only, never the result.
* Every fingerprint is indexed under its value of each partition and probes the values within
  t_i flips. Buckets are dealt by key; a task verifies the members of a bucket with XOR and
  population counts and returns one link per member, never the pairs.
* A bucket over ``bucket_rows`` members is split exactly: members linked by the rest of their
  bits differ in at most max_distance of six groups of them, so they agree on some three or
  more of the groups. Splitting twice leaves a bounded number of free bits per bucket.

Links go to connected components in Spark. Defined cases: null or empty text and text without
words have fingerprint zero and link like any other; a null doc_id takes part, and a component
of only null ids has a null component_id; repeated rows are kept; the smallest doc_id wins
ties; extra columns are ignored by ``near_duplicates`` and kept by ``deduplicate``; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollwise.llm.common import maybe_broadcast, packed, row_key, stage, text_key, unpacked
from rollwise.llm.components import components

SHINGLE = 3
MAX_DISTANCE = 3
BITS = 64
BUCKET_ROWS = 512
SPLIT_GROUPS = 6
BROADCAST_ROWS = 50_000
HASH_CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one UTF-8 text (A-Z lowered, ASCII white space between words)."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, len(starts), HASH_CHUNK):
        part = zip(starts[lo : lo + HASH_CHUNK].tolist(), ends[lo : lo + HASH_CHUNK].tolist(), strict=True)
        h = np.array([xxh64_intdigest(line[a:b], 42) for a, b in part], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, th, fp): th is a hash of the text, fp the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).cast(pa.binary()).to_pylist()
            fp = np.array([fingerprint(t or b"", shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], names=["doc_id", "th", "fp"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("th"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, th long, fp long")


def _bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for all of them, how often two bits are both set (64 x 64)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for b in batches:
            x = b.column(0).to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(x, axis=1, bitorder="little").astype(np.float32)
            total += np.rint(bits.T @ bits).astype(np.int64)
            n += len(bits)
        i, j = np.indices((BITS, BITS))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i.ravel(), -1)), pa.array(np.append(j.ravel(), -1)), pa.array(np.append(total.ravel(), n))],
            names=["i", "j", "n"],
        )

    both, n = np.zeros((BITS, BITS)), 0
    for r in fps.select("fp").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        if r["i"] < 0:
            n = r["n"]
        else:
            both[r["i"], r["j"]] = r["n"]
    return n, both


def partition_plan(n: int, both: np.ndarray, max_distance: int = MAX_DISTANCE) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the partitions in use, for n fingerprints with these bit statistics."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    corr = np.abs(cov / np.outer(sd, sd))
    differ = np.clip(2 * p * (1 - p), 1e-6, 0.5)
    best, best_cost = None, np.inf
    for m in range(2, max_distance + 2):
        left, groups = set(range(BITS)), []
        for k in range(m):
            size = len(left) // (m - k)
            seed = max(left, key=lambda b: (sum(corr[b, x] for x in left), -b))
            group = [seed]
            while len(group) < size:
                group.append(max(left - set(group), key=lambda b: (sum(corr[b, x] for x in group), -b)))
            left -= set(group)
            groups.append(sorted(group))
        units = max_distance + 1
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for g in groups:
            at = np.zeros(units)
            at[0] = 1.0
            for b in g:
                at[1:] = at[1:] * (1 - differ[b]) + at[:-1] * differ[b]
                at[0] *= 1 - differ[b]
            choose, cost = 1.0, [0.0]
            probes = 0.0
            for d in range(units):
                probes += choose if d == 0 else choose / 2
                cost.append(n * probes * 4 + n * n / 2 * at[: d + 1].sum() * 0.02)
                choose = choose * (len(g) - d) / (d + 1)
            step: dict[int, tuple[float, list[int]]] = {}
            for used, (c, alloc) in table.items():
                for u in range(units - used + 1):
                    new = (c + cost[u], [*alloc, u - 1])
                    if used + u not in step or new[0] < step[used + u][0]:
                        step[used + u] = new
            table = step
        cost, alloc = table[units]
        if cost < best_cost:
            best, best_cost = [(g, t) for g, t in zip(groups, alloc, strict=True) if t >= 0], cost
    return best


def _gather(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The chosen bits of each fingerprint, packed into the low bits."""
    out = np.zeros(len(fps), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def _keys(fps: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """(part, key, fp, probe): index rows, and probe rows for every value within the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy().astype("<i8").view(np.uint64)
            for part, (bits, t) in enumerate(plan):
                value = _gather(fp, bits)
                flips = [0] + [sum(1 << x for x in c) for d in range(1, t + 1) for c in combinations(range(len(bits)), d)]
                for f in flips:
                    near = value ^ np.uint64(f)
                    use = np.ones(len(fp), bool) if f == 0 else near < value  # the other side of a pair probes otherwise
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(use.sum(), part, np.int32)),
                            pa.array(near[use].view(np.int64)),
                            pa.array(fp[use].view(np.int64)),
                            pa.array(np.full(use.sum(), f != 0)),
                        ],
                        names=["part", "key", "fp", "probe"],
                    )

    return fps.select("fp").mapInArrow(run, "part int, key long, fp long, probe boolean")


def _split(rows: DataFrame, plan: list[tuple[list[int], int]], level: int, max_distance: int) -> DataFrame:
    """Members of large buckets under longer keys: the bits outside the partition, less max_distance of six groups.

    The second level splits the groups left out at the first one in the same way.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        choices = list(combinations(range(SPLIT_GROUPS), max_distance))
        for b in batches:
            part, key, fp, probe, path = (b.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            ufp = fp.astype("<i8").view(np.uint64)
            for p, before in sorted(set(zip(part.tolist(), path.tolist(), strict=True))):
                free = [x for x in range(BITS) if x not in plan[p][0]]
                if level:
                    free = [x for g in choices[before] for x in free[g::SPLIT_GROUPS]]
                at = np.flatnonzero((part == p) & (path == before))
                for c, out in enumerate(choices):
                    keep = [x for g in range(SPLIT_GROUPS) if g not in out for x in free[g::SPLIT_GROUPS]]
                    sub = _gather(ufp[at], keep).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(part[at]),
                            pa.array(key[at]),
                            pa.array(sub),
                            pa.array(fp[at]),
                            pa.array(probe[at]),
                            pa.array(np.full(len(at), before * len(choices) * level + c, np.int32)),
                        ],
                        names=["part", "key", "sub", "fp", "probe", "path"],
                    )

    out = rows.select("part", "key", "fp", "probe", "path").mapInArrow(
        run, "part int, key long, sub long, fp long, probe boolean, path int"
    )
    return out.withColumn("key", F.xxhash64("key", "sub", "path")).drop("sub")  # a clash adds candidates, never links


def bucket_links(key: np.ndarray, fp: np.ndarray, probe: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links inside equal, adjacent keys: (member, representative) fingerprints, one row per linked member."""
    n = len(fp)
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, n))
    size_of = np.repeat(sizes, sizes)
    at = np.arange(n) - np.repeat(starts, sizes)
    left, right = [], []
    for shift in range(1, int(sizes.max(initial=1))):
        i = np.flatnonzero(at + shift < size_of)
        j = i + shift
        ok = (~(probe[i] & probe[j])) & (np.bitwise_count(fp[i] ^ fp[j]) <= max_distance)
        left.append(i[ok])
        right.append(j[ok])
    i = np.concatenate(left) if left else np.zeros(0, np.int64)
    j = np.concatenate(right) if right else np.zeros(0, np.int64)
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        if (low == label[i]).all() and (low == label[j]).all():
            break
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
    linked = np.flatnonzero(label != np.arange(n))
    return fp[linked], fp[label[linked]]


def _verify(keyed: DataFrame, max_distance: int) -> DataFrame:
    """Links (a, b) found inside buckets; rows are dealt by (part, key) and read in key order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done(part, key, fp, probe):
            code = np.append(True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])).cumsum()  # a number per bucket
            a, b = bucket_links(code, fp.view(np.uint64), probe, max_distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            held.append(tuple(b.column(i).to_numpy(zero_copy_only=False) for i in range(4)))
            part, key, fp, probe = (np.concatenate(x) for x in zip(*held, strict=True))
            last = int(np.flatnonzero((key != key[-1]) | (part != part[-1])).max(initial=-1)) + 1
            if last:
                yield done(part[:last], key[:last], fp[:last].astype("<i8"), probe[:last].astype(bool))
            held = [(part[last:], key[last:], fp[last:], probe[last:])]
        if held:
            part, key, fp, probe = held[0]
            yield done(part, key, fp.astype("<i8"), probe.astype(bool))

    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.select("part", "key", "fp", "probe").repartition(parts, "part", "key").sortWithinPartitions("part", "key", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that give the components of all pairs within max_distance."""
    n, both = _bit_statistics(fps)
    plan = partition_plan(n, both, max_distance)
    rows = stage(_keys(fps, plan).withColumn("path", F.lit(0)), "simhash-keys")
    found = None
    for level in range(3):
        full = stage(
            rows.groupBy("part", "key").agg(F.count("*").alias("n")).filter(F.col("n") > bucket_rows).select("part", "key"), "simhash-full"
        )
        last = level == 2 or full.isEmpty()
        few = maybe_broadcast(full, BROADCAST_ROWS)
        small = rows if last else rows.join(few, ["part", "key"], "left_anti")
        edges = stage(_verify(small, max_distance), "simhash-links")
        found = edges if found is None else found.union(edges)
        if last:
            break
        rows = stage(_split(rows.join(few, ["part", "key"], "left_semi"), plan, level, max_distance), "simhash-split")
    return found


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, th, fp, group_fp (a fingerprint naming the group) and component_id of every row."""
    marked = stage(fingerprints(docs, shingle), "simhash-fingerprints")
    merged = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = stage(components(links(merged, max_distance)), "simhash-roots")
    linked = stage(roots.join(merged, roots.node == merged.fp).select("fp", "root", "least"), "simhash-linked")
    ids = stage(linked.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-ids")
    named = stage(linked.join(ids, "root").select("fp", "root", "component_id"), "simhash-named")
    whole = stage(
        merged.join(named, "fp", "left").select(
            "fp",
            F.coalesce("root", "fp").alias("group_fp"),
            F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
        ),
        "simhash-whole",
    )
    return marked.join(whole, "fp").select("doc_id", "th", "fp", "group_fp", "component_id")


def hex_fingerprint(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of ``docs`` per near-duplicate group, unchanged: the smallest doc_id (null ids last), then text hash.

    Of rows repeated whole, one stays.
    """
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("th"))
    keep = (
        near_duplicates(docs, shingle, max_distance)
        .groupBy("group_fp")
        .agg(F.min(order).alias("k"))
        .select(*row_key(F.col("k.doc_id"), F.col("k.th")))
    )
    keep = stage(keep, "simhash-keep")
    key = ["_id", "_null", "_th"]
    kept = packed(docs, *row_key(F.col("doc_id"), text_key())).join(keep, key, "left_semi")
    one = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1)))
    return unpacked(kept.withColumn("_n", one).filter("_n = 1"))
