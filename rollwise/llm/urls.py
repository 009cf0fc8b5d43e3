"""Operator 7, URL filters: rules first, then a ratio of two character language models.

URLs that a rule decides are the labelled rows: those allowed train one model, those blocked
the other. Each model is a variable-order Markov model over the characters of host and path:
orders 0 to 3, interpolated by Witten-Bell smoothing, so that a context lends its weight to a
shorter one as far as it has been seen with few or many followers. Characters are mapped to a
fixed alphabet, so a model has at most 43^4 cells whatever the input (the proof of the size of
what is collected and broadcast). A URL's score is the mean, over its characters and its end, of
the difference of the two log-likelihoods. Labelled URLs whose hash of host and path is divisible by
five are held out: the counts come from all others, and the threshold is calibrated on the scores of
all held out ones (histogram of fixed bins, best balanced accuracy). Equal URLs are on one side.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and
is judged by the score of the empty string; when no URL or only one verdict is labelled there is
no ratio and the rest is allowed with score 0; where either side of the split lacks a verdict, all
labelled URLs stand for that side; repeated rows count and are judged one by one; an
empty table gives an empty result; rules of equal length cannot both fit unless they are equal
(the first listed wins); extra columns are ignored by ``judge`` and kept by ``keep_allowed``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwise.llm.common import packed, stage, unpacked

# The rules of the registered query, as (verdict, host and path).
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789/.-_%"
ORDER = 3
SYMBOLS = len(ALPHABET) + 2  # one for any other character, one for begin and end
BIN = 0.01
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def held_out() -> Column:
    """Whether a labelled row calibrates the threshold, and is not counted."""
    return F.pmod(F.xxhash64("text"), F.lit(5)) == 0


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL, both empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits."""
    name = verdict = None
    for v, text in sorted(rules, key=lambda r: -len(r[1])):
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        name = F.when(fits, text) if name is None else name.when(fits, text)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return (name, verdict) if rules else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(cell of every character and end of the texts, text each belongs to); a cell is a context and its next symbol."""
    table = np.full(128, SYMBOLS - 2, np.int64)
    for i, c in enumerate(ALPHABET):
        table[ord(c)] = table[ord(c.upper())] = i
    edge = "\x00" * ORDER
    chars = np.frombuffer((edge + edge.join(texts) + edge).encode("utf-32-le"), np.uint32)
    code = np.where(chars < 128, table[np.minimum(chars, 127)], SYMBOLS - 2)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(lens + ORDER) - lens
    last = first + lens  # the end symbol of each text
    for i in range(ORDER):
        code[first - ORDER + i] = SYMBOLS - 1
        code[last + i] = SYMBOLS - 1
    of = np.repeat(np.arange(len(texts)), lens + 1)
    at = np.arange(len(of)) + np.repeat(first - (np.cumsum(lens + 1) - lens - 1), lens + 1)
    cell = code[at]
    for k in range(1, ORDER + 1):
        cell = cell + code[at - k] * SYMBOLS**k
    return cell, of


def _cells(labelled: DataFrame) -> DataFrame:
    """(label, cell, n) over every labelled text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            cell, of = _codes(b.column(1).to_pylist())
            label = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[of]
            key, n = np.unique(label * SYMBOLS ** (ORDER + 1) + cell, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    return labelled.select("allowed", "text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """log P(next | context) for each cell of a (SYMBOLS,) * (ORDER + 1) count array, Witten-Bell smoothed."""
    by_order = [counts.astype(np.float64)]
    while by_order[-1].ndim > 1:
        by_order.append(by_order[-1].sum(axis=0))
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for c in reversed(by_order):
        seen, kinds = c.sum(axis=-1, keepdims=True), (c > 0).sum(axis=-1, keepdims=True)
        p = np.where(seen > 0, (c + kinds * p) / np.maximum(seen + kinds, 1), p)
    return np.log(p)


def scores(texts: list[str], ratio: np.ndarray) -> np.ndarray:
    """Length-normalised log-likelihood difference of each text."""
    if not texts:
        return np.zeros(0)
    cell, of = _codes(texts)
    return np.bincount(of, weights=ratio[cell], minlength=len(texts)) / np.bincount(of, minlength=len(texts))


def _threshold(scored: DataFrame) -> float:
    """The score with the best balanced accuracy on labelled rows, in the middle of equally good ones."""
    by_bin = scored.filter("allowed IS NOT NULL").groupBy(F.floor(F.col("score") / BIN).alias("bin"), held_out().alias("held")).agg(
        F.count_if("allowed").alias("allow"), F.count_if(~F.col("allowed")).alias("block")
    )
    rows = by_bin.collect()  # at most twice the score range over BIN
    held = [r for r in rows if r["held"]]
    if any(r["allow"] for r in held) and any(r["block"] for r in held):
        rows = held
    total = sum(r["allow"] for r in rows), sum(r["block"] for r in rows)
    right = {}
    for edge in {r["bin"] + k for r in rows for k in (0, 1)}:
        good = sum(r["allow"] for r in rows if r["bin"] >= edge) / total[0]
        right[edge] = good + sum(r["block"] for r in rows if r["bin"] < edge) / total[1]
    best = [e for e, v in right.items() if v == max(right.values())]
    return (min(best) + max(best)) / 2 * BIN


def _scored(rows: DataFrame) -> tuple[DataFrame, float | None]:
    """``rows`` (text, allowed, more) with a score, and the threshold; None where a verdict has no labelled row."""
    spark = rows.sparkSession
    cells = SYMBOLS ** (ORDER + 1)

    def counted(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        table = _cells(labelled).toArrow()  # at most two tables of 43^4 cells
        counts = np.zeros(2 * cells)
        counts[table.column("key").to_numpy()] = table.column("n").to_numpy()
        return counts[:cells], counts[cells:]

    shape = (SYMBOLS,) * (ORDER + 1)
    labelled = rows.filter("allowed IS NOT NULL")
    blocked, allowed = counted(labelled.filter(~held_out()))
    if not blocked.any() or not allowed.any():
        blocked, allowed = counted(labelled)
    if not blocked.any() or not allowed.any():
        return rows.withColumn("score", F.lit(0.0)), None
    ratio = (log_probabilities(allowed.reshape(shape)) - log_probabilities(blocked.reshape(shape))).astype(np.float32).ravel()
    model = spark.sparkContext.broadcast(ratio)
    at = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = pa.array(np.round(scores(b.column(at).to_pylist(), model.value), 9), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, s], names=[*b.schema.names, "score"])

    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", score double"
    scored = stage(rows.mapInArrow(run, schema), "urls-scored")
    return scored, _threshold(scored)


def _labelled(url: Column, rules: list[tuple[str, str]]) -> list[Column]:
    host, path = parts(url)
    name, verdict = rule(host, path, rules)
    return [host.alias("host"), path.alias("path"), name.alias("rule"), (verdict == "allow").alias("allowed"), F.concat(host, path).alias("text")]


def _verdict(threshold: float | None) -> Column:
    good = F.lit(True) if threshold is None else F.col("score") >= F.lit(threshold)
    return F.when(F.coalesce(F.col("allowed"), good), "allow").otherwise("block")


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row."""
    rows = stage(pages.select("page_id", *_labelled(F.col("url"), rules)), "urls-parts")
    scored, threshold = _scored(rows)
    return scored.select("page_id", "host", "path", "rule", _verdict(threshold).alias("verdict"), "score")


def keep_allowed(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """The rows of ``pages`` whose verdict is allow, all columns unchanged."""
    scored, threshold = _scored(packed(pages, *_labelled(F.col("url"), rules)))
    return unpacked(scored.filter(_verdict(threshold) == "allow"))
