"""Operator 1, substring dedup with prefix-partitioned suffix trees.

A window is ``window`` consecutive words of one document; every word covered by a window whose
word sequence also starts anywhere else (same document included) is removed.

* Copies first: texts with equal words (by their sha256) are counted map-side. Every window of a
  text that occurs twice or more is a repeat, so all such rows lose all their words at once;
  one representative goes on, as a place where other texts may find their windows.
* Sampling of suffixes: each window names its least 8-word gram (by hash), and as its anchor the
  place of the window before it while that is still a least gram, else the rightmost one (robust
  winnowing). Equal windows name equal grams, so windows can only be equal inside the group of
  suffixes that share an anchor gram. About one position in fourteen is an anchor, and one in
  twenty-eight where a text repeats few words over and over; only those are shuffled, as hashes,
  and groups of one are dropped.
* Prefix partitions: the gram is the first prefix. The surviving suffixes are sent, with the
  words of the windows they stand for (62 words at most at the default window), to the task
  that owns the gram. A gram with more than ``group_rows`` suffixes is too large for a
  task: it is dealt by text and place into parts (copies are gone, so texts differ and parts are
  even, about ``group_rows`` each), each part settles the windows it sees twice, and the rest go on
  under the longest prefix, the whole window, whose equal names are counted in Spark.
* Subtrees: a task names all word runs of length 1, 2, 4, ... window in its suffixes by sorting
  pairs of shorter names (Karp-Miller-Rosenberg), which are the nodes of the suffix tree cut at
  that depth. A node at depth ``window`` with two leaves or more is a repeat; runs of
  neighbouring repeats are the maximal ones and leave as one interval.

Work and memory follow the input: nothing is kept per pair of equal passages. Defined cases:
null text has no words; a null doc_id is a row like any other; a document repeated as a whole
row counts as another place, so both lose all covered words; texts shorter than a window keep
everything; ties and order do not matter (windows are judged on the input); extra columns are
ignored by ``digests`` and kept by ``deduplicate``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwise.llm.common import maybe_broadcast, packed, row_key, stage, text_key, unpacked

WINDOW = 35
GRAM = 8
GROUP_ROWS = 2048
#: words a task names at once (whole groups; a part of a gram has about group_rows suffixes)
BATCH_WORDS = 1 << 19
WORD_CACHE = 1 << 19
BROADCAST_ROWS = 100_000
NO_WORDS = hashlib.sha256(b"").hexdigest()
KEY = ["_id", "_null", "_th"]
KEY_TYPE = "_id long, _null boolean, _th long"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

_word_hashes: dict[bytes, int] = {}


def _hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    cache = _word_hashes
    if len(cache) > WORD_CACHE:
        cache.clear()
    out = [cache.get(w) for w in words]
    for i, h in enumerate(out):
        if h is None:
            out[i] = cache[words[i]] = xxh64_intdigest(words[i], 7)
    return np.array(out, dtype=np.uint64)


def anchors(words: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, first window start, last window start, places) of each anchor, for all windows of a text.

    ``places`` is 2 where the windows of an anchor hold their least gram more than once, so that two
    of them may be equal, else 1.
    """
    n_windows = len(words) - window + 1
    if n_windows < 1:
        return np.zeros(0, np.int64), *[np.zeros(0, np.int32) for _ in range(3)]
    gram = min(GRAM, window)
    h = _hashes(words)
    value = np.zeros(len(words) - gram + 1, np.uint64)
    for j in range(gram):
        value *= MULTIPLIER
        value += h[j : j + len(value)]
    value ^= value >> np.uint64(31)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(29)
    span = window - gram + 1
    at = np.arange(len(value))
    low, width = value, 1
    while width < span:  # least gram of each run of ``width`` grams, rightmost on ties
        step = min(width, span - width)
        first = low[:-step] < low[step:]
        low = np.where(first, low[:-step], low[step:])
        at = np.where(first, at[:-step], at[step:])
        width += step
    # Neighbouring windows with equal least grams keep one anchor while it lies inside them.
    starts = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    ends = np.append(starts[1:], len(low)) - 1
    more = []
    for i in np.flatnonzero(at[starts] < ends).tolist():
        place, end = int(at[starts[i]]) + 1, int(ends[i])
        while place <= end:
            more.append(place)
            place = int(at[place]) + 1
    if more:
        starts = np.sort(np.append(starts, more))
        ends = np.append(starts[1:], len(low)) - 1
    places = 1 + (at[ends] != at[starts])
    return low[starts].view(np.int64), starts.astype(np.int32), ends.astype(np.int32), places.astype(np.int32)


def _keyed(docs: DataFrame, *first: Column) -> DataFrame:
    return docs.select(*first, *row_key(F.col("doc_id"), text_key()), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _anchored(docs: DataFrame, window: int) -> DataFrame:
    """One row per document: doc_id, key, n_words, digest of all its words, and its anchors."""
    schema = f"doc_id long, {KEY_TYPE}, n_words long, sha string, anchors array<struct<h:bigint,a:int,b:int,places:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, n, sha = [], [], []
            for t in _texts(b, 4):
                words = t.split()
                found.append(anchors(words, window))
                n.append(len(words))
                sha.append(_digest(words))
            offsets = np.concatenate(([0], np.cumsum([len(f[0]) for f in found]))).astype(np.int32)
            flat = [np.concatenate([f[i] for f in found]) if found else np.zeros(0) for i in range(4)]
            structs = pa.StructArray.from_arrays(
                [pa.array(flat[0], pa.int64()), *[pa.array(x, pa.int32()) for x in flat[1:]]], names=["h", "a", "b", "places"]
            )
            lists = pa.ListArray.from_arrays(pa.array(offsets), structs)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array(n, pa.int64()), pa.array(sha, pa.string()), lists],
                names=["doc_id", *KEY, "n_words", "sha", "anchors"],
            )

    return _keyed(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, schema)


def _copies(base: DataFrame, window: int) -> DataFrame:
    """(sha, key of a representative as r_*, rows with that key) of every word sequence that several rows hold."""
    rows = base.filter(F.col("n_words") >= window).groupBy("sha", *KEY).agg(F.count("*").alias("rows"))
    least = F.min(F.struct("rows", *KEY)).alias("r")
    several = rows.groupBy("sha").agg(F.sum("rows").alias("n"), least).filter("n > 1")
    return several.select("sha", "r.rows", *[F.col(f"r.{c}").alias(f"r{c}") for c in KEY])


def _contexts(docs: DataFrame, picked: DataFrame, copies: DataFrame, window: int) -> DataFrame:
    """(h, part, key, start, words) per surviving anchor: the words of the windows it stands for.

    ``picked``: key, and per document an array ``picks`` of (h, a, b, parts). A representative
    whose whole row is repeated gives its words once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            picks = b.column(4)
            offsets = picks.offsets.to_numpy() - picks.offsets[0].as_py()
            h, first, last, parts = (x.to_numpy() for x in picks.flatten().flatten())
            of_row = np.repeat(np.arange(b.num_rows), np.diff(offsets))
            runs = []
            for r, t in enumerate(_texts(b, 3)):
                words = t.split()
                lo, hi = offsets[r], offsets[r + 1]
                runs += [b" ".join(words[x : y + window]) for x, y in zip(first[lo:hi].tolist(), last[lo:hi].tolist(), strict=True)]
            th = b.column(2).to_numpy()
            spread = (th[of_row].view(np.uint64) ^ (first.astype(np.uint64) * MULTIPLIER)) >> np.uint64(7)
            rows = pa.array(of_row)
            for lo in range(0, len(runs), 1 << 14):
                cut = slice(lo, lo + (1 << 14))
                at = rows[cut]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h[cut]),
                        pa.array((spread[cut] % parts[cut].astype(np.uint64)).astype(np.int32)),
                        pa.array(parts[cut] > 1),
                        *[b.column(i).take(at) for i in range(3)],
                        pa.array(first[cut].astype(np.int32)),
                        pa.array(runs[cut], pa.binary()),
                    ],
                    names=["h", "part", "split", *KEY, "start", "words"],
                )

    rows = _keyed(docs)
    again = copies.filter("rows > 1").select(*[F.col(f"r{c}").alias(c) for c in KEY])
    if not again.isEmpty():
        again = maybe_broadcast(again, BROADCAST_ROWS)
        rows = rows.join(again, KEY, "left_anti").union(rows.join(again, KEY, "left_semi").dropDuplicates(KEY))
    rows = rows.join(picked, KEY)
    return rows.mapInArrow(run, f"h long, part int, split boolean, {KEY_TYPE}, start int, words binary")


def repeated_names(ids: np.ndarray, run_of: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, names) of every window lying inside one run; equal words get equal names.

    Names of runs of 1, 2, 4, ... words are pairs of shorter names put in order, the nodes of
    the suffix tree at those depths; the last pair overlaps to reach ``window`` exactly.
    """
    name, length = ids.astype(np.int64), 1
    while length < window:
        step = min(length, window - length)
        if len(name) <= step:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair = name[:-step] * (name.max() + 1) + name[step:]
        name = np.unique(pair, return_inverse=True)[1]
        length += step
    at = np.flatnonzero(run_of[: len(name)] == run_of[window - 1 :][: len(name)])
    return at, name[at]


def _subtrees(contexts: DataFrame, window: int) -> DataFrame:
    """Repeats found inside groups: (key, s, e) intervals, and for split groups windows still open.

    Open rows carry ``name`` (a 128-bit digest of the window's words): those seen once in their
    part with their place, those seen more often without (their places are settled).
    """
    schema = f"{KEY_TYPE}, s int, e int, name binary, n int"

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        split, ids_, nulls, ths, starts, texts = (np.concatenate(x) for x in zip(*rows, strict=True))
        words = b" ".join(texts.tolist()).split()
        lens = np.fromiter((t.count(b" ") + 1 for t in texts), np.int64, len(texts))
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        run_of = np.repeat(np.arange(len(lens)), lens)
        begin = np.cumsum(lens) - lens
        at, name = repeated_names(ids, run_of, window)
        run, start = run_of[at], at - begin[run_of[at]] + starts[run_of[at]]
        count = np.bincount(name, minlength=1)[name] if len(name) else name
        hit = count > 1
        # Neighbouring repeats of one suffix leave as one interval.
        r, s = run[hit], start[hit]
        head = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (s[1:] != s[:-1] + 1))) if len(r) else np.zeros(0, np.int64)
        tail = np.append(head[1:], len(r)) - 1 if len(r) else head
        rows_of, s_out, e_out = r[head], s[head], s[tail] + window
        digests, n_out = [None] * len(head), [0] * len(head)
        open_ = np.flatnonzero(split[run]) if len(run) else np.zeros(0, np.int64)
        if len(open_):
            _, one = np.unique(name[open_], return_index=True)
            open_ = open_[one]
            digests += [hashlib.md5(b" ".join(words[p : p + window])).digest() for p in at[open_].tolist()]
            n_out += np.minimum(count[open_], 2).tolist()
            rows_of, s_out, e_out = np.append(rows_of, run[open_]), np.append(s_out, start[open_]), np.append(e_out, start[open_] + window)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids_[rows_of], pa.int64()),
                pa.array(nulls[rows_of], pa.bool_()),
                pa.array(ths[rows_of], pa.int64()),
                pa.array(s_out, pa.int32()),
                pa.array(e_out, pa.int32()),
                pa.array(digests, pa.binary()),
                pa.array(n_out, pa.int32()),
            ],
            names=[*KEY, "s", "e", "name", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for b in batches:
            if not b.num_rows:
                continue
            h, part = b.column(0).to_numpy(), b.column(1).to_numpy()
            edge = np.append(True, (h[1:] != h[:-1]) | (part[1:] != part[:-1]))
            edge[0] = last is not None and last != (h[0], part[0])
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(2, 8)]
            at = 0
            for cut in [*np.flatnonzero(edge).tolist(), b.num_rows]:
                if cut > at:
                    held.append(tuple(c[at:cut] for c in cols))
                    size += sum(map(len, cols[5][at:cut])) // 6
                if cut < b.num_rows and size >= BATCH_WORDS:
                    yield settle(held)
                    held, size = [], 0
                at = cut
            last = (h[-1], part[-1])
        if held:
            yield settle(held)

    parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = contexts.repartition(parts, "h", "part").sortWithinPartitions("h", "part")
    return dealt.mapInArrow(run, schema)


def covered(docs: DataFrame, window: int = WINDOW, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """(per document: doc_id, key, n_words, sha of all words, ``whole``; (key, s, e) of the repeats).

    Documents that are ``whole`` have a copy and lose all words; they need no intervals.
    """
    base = stage(_anchored(docs, window), "substrings-anchors")
    copies = stage(_copies(base, window), "substrings-copies")
    marked = base.join(maybe_broadcast(copies, BROADCAST_ROWS), "sha", "left")
    whole = F.col("rows").isNotNull()
    is_first = F.expr(" AND ".join(f"{c} = r{c}" for c in KEY))
    each = marked.filter(~whole | is_first).select(*KEY, F.explode("anchors").alias("x")).select(*KEY, "x.*")
    grams = stage(each.groupBy("h").agg(F.count("*").alias("n"), F.sum("places").alias("places")).filter("places > 1").select("h", "n"), "substrings-grams")
    parts = F.ceil(F.col("n") / group_rows).cast("int").alias("parts")
    picked = each.join(grams, "h").groupBy(*KEY).agg(F.collect_set(F.struct("h", "a", "b", parts)).alias("picks"))
    found = stage(_subtrees(_contexts(docs, picked, copies, window), window), "substrings-repeats")
    still = found.filter("name IS NOT NULL")
    twice = stage(still.groupBy("name").agg(F.sum("n").alias("n")).filter("n > 1").select("name"), "substrings-open")
    settled = found.filter("name IS NULL").select(*KEY, "s", "e").union(
        still.filter("n = 1").join(twice, "name").select(*KEY, "s", "e")
    )
    return marked.select("doc_id", *KEY, "n_words", "sha", whole.alias("whole")), settled


def _spans(repeats: DataFrame) -> DataFrame:
    """Per key, ``spans``: its (s, e) word positions."""
    return repeats.groupBy(*KEY).agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def kept_words(words: list[bytes], starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The words outside the half-open spans."""
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


def _spans_of(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    lists = batch.column(column)
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    s, e = (x.to_numpy() for x in lists.flatten().flatten())
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield s[lo:hi], e[lo:hi]


def digests(docs: DataFrame, window: int = WINDOW, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document.

    Texts travel again only to documents that lose a part of their words; the others have their
    digest already.
    """
    base, repeats = covered(docs, window, group_rows)
    spans = _spans(repeats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sha = [], []
            for t, (s, e) in zip(_texts(b, 3), _spans_of(b, 4), strict=True):
                words = t.split()
                kept = kept_words(words, s, e)
                n.append(len(words) - len(kept))
                sha.append(_digest(kept))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(n, pa.int64()), pa.array(sha, pa.string())], names=[*KEY, "n_removed", "kept"])

    cut = _keyed(docs).join(spans, KEY).mapInArrow(run, f"{KEY_TYPE}, n_removed long, kept string")
    cut = stage(cut.groupBy(*KEY).agg(F.first("n_removed").alias("n_removed"), F.first("kept").alias("kept")), "substrings-cut")
    return base.join(cut, KEY, "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("whole"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("whole"), F.lit(NO_WORDS)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )


def deduplicate(docs: DataFrame, window: int = WINDOW, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``docs`` with the repeated words taken out of ``text``: kept words joined by one space.

    Texts that lose nothing stay as they are.
    """
    base, repeats = covered(docs, window, group_rows)
    gone = base.filter("whole").select(*KEY, F.lit(0).alias("s"), F.col("n_words").cast("int").alias("e"))
    spans = _spans(repeats.union(gone))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [
                b" ".join(kept_words(t.split(), s, e)).decode() if len(s) else t.decode()
                for t, (s, e) in zip(_texts(b, 1), _spans_of(b, 2), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["_row", "_kept"])

    rows = packed(docs, *row_key(F.col("doc_id"), text_key()), F.col("text").cast("string").alias("_text"))
    rows = rows.join(spans, KEY, "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<s:int,e:int>>")))
    row_type = packed(docs).schema["_row"].dataType.simpleString()
    done = rows.select("_row", F.coalesce("_text", F.lit("")).alias("_text"), "spans").mapInArrow(run, f"_row {row_type}, _kept string")
    text = F.when(F.col("_row.text").isNotNull(), F.col("_kept"))
    return unpacked(done.withColumn("_row", F.col("_row").withField("text", text)))
