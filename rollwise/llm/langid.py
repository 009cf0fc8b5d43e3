"""Operator 5, language identification with a bidirectional gated recurrent network over bytes.

Trained in numpy by backpropagation through time on a bounded sample: at most ``TRAIN_WINDOWS``
windows of ``window`` bytes, equally many per language, taken from documents whose
crc32(doc_id as text) mod 5 is not 0 and whose language is known. Documents are drawn by a 64-bit
hash with a quota per language, and a window's place is drawn over the whole text. Every byte of every text is
then read: texts are cut into windows, a forward and a backward network run over the windows of
many documents at once, every position gets a probability per language, and a document's
probabilities are the mean over the positions of its letters. The highest wins, ties to the
smaller language name.

Language, source and doc_id are never inputs of a prediction. Defined cases: null text, or text
without a letter, gives ``und`` with score 0; a null doc_id is never learned from and not held
out; with nothing to learn from every prediction is ``und``; repeated rows are predicted alike;
texts of any length are read whole, a batch of windows at a time; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 64
HIDDEN = 8
#: windows in the training sample, over all languages, and windows taken from one document at most
TRAIN_WINDOWS = 2400
#: the most languages that are learned
LANGUAGES = 200
PER_DOCUMENT = 2
STEPS = 180
BATCH = 160
RATE = 0.03
#: windows that run through the network together
AT_ONCE = 4096

LETTER = re.compile(r"[^\W\d_]")
IS_LETTER = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)] + [False])
PAD = 256  # the byte after a window's end


def _soft(x: np.ndarray) -> np.ndarray:
    """Softsign, x / (1 + |x|): a cheap tanh; its slope is (1 - |y|)^2 at value y."""
    y = np.abs(x)
    y += np.float32(1)
    return np.divide(x, y, out=y)


def _slope(y: np.ndarray) -> np.ndarray:
    return np.square(1 - np.abs(y))


class Direction:
    """Gated recurrent units reading (time, batch) bytes in one direction.

    Gates: update z, reset r and candidate n; h = (1 - z) n + z h, n = soft(W x + r (U h)),
    z and r are (1 + soft(W x + U h)) / 2.
    """

    def __init__(self, rng: np.random.Generator, hidden: int) -> None:
        self.hidden = hidden
        self.w = (rng.standard_normal((PAD + 1, 3 * hidden)) * 0.3).astype(np.float32)
        self.u = (rng.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32)

    def forward(self, x: np.ndarray, keep: bool = False):
        k = self.hidden
        h = np.zeros((x.shape[1], k), np.float32)
        states, cache = np.empty((*x.shape, k), np.float32), []
        half = np.float32(0.5)
        for t in range(len(x)):
            a, b = np.take(self.w, x[t], axis=0), h @ self.u
            gates = _soft(a[:, : 2 * k] + b[:, : 2 * k])
            gates *= half
            gates += half
            z, r = gates[:, :k], gates[:, k:]
            n = r * b[:, 2 * k :]
            n += a[:, 2 * k :]
            n = _soft(n)
            if keep:
                cache.append((h, z, r, n, b[:, 2 * k :]))
            h = np.subtract(h, n, out=states[t])
            h *= z
            h += n
        return states, cache

    def backward(self, x: np.ndarray, cache: list, up: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of w and u, given that of every state."""
        k = self.hidden
        dw, du = np.zeros_like(self.w), np.zeros_like(self.u)
        back = np.zeros_like(up[0])
        for t in range(len(x) - 1, -1, -1):
            h, z, r, n, un = cache[t]
            d = up[t] + back
            dn = d * (1 - z) * _slope(n)
            dz = d * (h - n) * _slope(2 * z - 1) / 2
            dr = dn * un * _slope(2 * r - 1) / 2
            da = np.concatenate([dz, dr, dn], axis=1)
            db = np.concatenate([dz, dr, dn * r], axis=1)
            np.add.at(dw, x[t], da)
            du += h.T @ db
            back = d * z + db @ self.u.T
        return dw, du


class Model:
    """Two directions, and a softmax over languages at every position."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.behind = Direction(rng, hidden), Direction(rng, hidden)
        self.out = (rng.standard_normal((2 * hidden, len(languages))) * 0.1).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def _states(self, x: np.ndarray, keep: bool = False):
        f, cf = self.ahead.forward(x, keep)
        b, cb = self.behind.forward(x[::-1], keep)
        return np.concatenate([f, b[::-1]], axis=2), cf, cb

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(time, batch, languages) of (time, batch) bytes."""
        logits = self._states(x)[0] @ self.out
        logits += self.bias
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits

    def train(self, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, seed: int = 5) -> None:
        """Adam on the cross-entropy of every letter position; windows are (rows, window) bytes."""
        rng = np.random.default_rng(seed)
        weights = [self.ahead.w, self.ahead.u, self.behind.w, self.behind.u, self.out, self.bias]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        for step in range(1, steps + 1):
            at = rng.integers(len(windows), size=batch)
            x, y = windows[at].T, labels[at]
            states, cf, cb = self._states(x, keep=True)
            logits = states @ self.out + self.bias
            p = np.exp(logits - logits.max(axis=2, keepdims=True))
            p /= p.sum(axis=2, keepdims=True)
            mask = IS_LETTER[x]
            p[:, np.arange(batch), y] -= 1
            p *= (mask / max(1, mask.sum()))[:, :, None].astype(np.float32)
            flat = p.reshape(-1, p.shape[2])
            d = p @ self.out.T
            k = self.ahead.hidden
            grads = [
                *self.ahead.backward(x, cf, d[:, :, :k]),
                *self.behind.backward(x[::-1], cb, d[::-1, :, k:]),
                states.reshape(-1, 2 * k).T @ flat,
                flat.sum(axis=0),
            ]
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                m += (g - m) * np.float32(0.1)
                v += (g * g - v) * np.float32(0.01)
                w -= np.float32(rate) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + np.float32(1e-8))

    def documents(self, texts: list[str | None]) -> Iterator[tuple[int, float]]:
        """(language number or -1, its mean probability) of each text, in order."""
        sums = np.zeros((len(texts), len(self.languages)))
        counts = np.zeros(len(texts))
        queue: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        waiting = 0

        def run() -> None:
            x, of = np.concatenate(queue), np.concatenate(owners)
            mask = IS_LETTER[x]
            p = self.probabilities(x.T)
            p *= mask.T[:, :, None]
            np.add.at(sums, of, p.sum(axis=0))
            np.add.at(counts, of, mask.sum(axis=1))

        for i, text in enumerate(texts):
            if not text or not LETTER.search(text):
                continue
            raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
            for lo in range(0, len(raw), WINDOW * AT_ONCE):
                part = raw[lo : lo + WINDOW * AT_ONCE]
                x = np.full(-(-len(part) // WINDOW) * WINDOW, PAD, np.int32)
                x[: len(part)] = part
                queue.append(x.reshape(-1, WINDOW))
                owners.append(np.full(len(queue[-1]), i))
                waiting += len(queue[-1])
                if waiting >= AT_ONCE:
                    run()
                    queue, owners, waiting = [], [], 0
        if waiting:
            run()
        for i in range(len(texts)):
            if counts[i]:
                best = int(np.argmax(sums[i]))
                yield best, float(min(1.0, sums[i, best] / counts[i]))
            else:
                yield -1, 0.0


def _fold(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def training_sample(docs: DataFrame, train_windows: int = TRAIN_WINDOWS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, windows, labels): a bounded sample of the labelled documents that may be learned from.

    The ``LANGUAGES`` most frequent languages (ties by name) are learned, with an equal share of
    ``train_windows`` in all; rarer ones are not, so neither their names nor their rows are
    collected. Every language gives the documents with its smallest hashes, as many as wanted. A
    threshold per language, from the count of all its rows, drops most others before they are
    ranked; it lets enough pass that one with too few is next to impossible. Only the windows are collected.
    """
    rows = docs.filter((_fold() != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    most = max(1, min(LANGUAGES, train_windows // PER_DOCUMENT))
    frequent = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most)
    counts = {r["lang"]: r["n"] for r in frequent.collect()}
    if not counts:
        return [], np.zeros((0, WINDOW), np.int16), np.zeros(0, np.int64)
    languages = sorted(counts)
    want = train_windows // PER_DOCUMENT // len(languages)
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, (1.5 * want + 32) / n))])
    place = lambda seed: F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.greatest(F.length("text") - WINDOW + 1, F.lit(1))) + 1
    drawn = (
        rows.withColumn("text", F.col("text").cast("string"))
        .withColumn("draw", F.xxhash64(F.col("doc_id").cast("string"), "text"))
        .filter(F.col("lang").isin(languages))
        .filter((F.col("draw") / float(1 << 64) + 0.5) < share[F.col("lang")])
        .select("lang", "draw", F.array(*[F.substring("text", place(i), F.lit(WINDOW)) for i in range(PER_DOCUMENT)]).alias("cuts"))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "cuts"))
    taken = drawn.withColumn("rank", rank).filter(F.col("rank") <= want).orderBy("draw", "lang", "cuts").collect()
    windows, labels = [], []
    for r in taken:
        for cut in r["cuts"]:
            raw = np.frombuffer(cut.encode("utf-8", "replace"), np.uint8)[:WINDOW]
            x = np.full(WINDOW, PAD, np.int16)
            x[: len(raw)] = raw
            windows.append(x)
            labels.append(languages.index(r["lang"]))
    return languages, np.array(windows, np.int16).reshape(-1, WINDOW), np.array(labels, np.int64)


def fit(docs: DataFrame) -> Model | None:
    languages, windows, labels = training_sample(docs)
    if not len(windows):
        return None
    model = Model(languages)
    model.train(windows, labels)
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            found = list(model.documents(texts)) if model else [(-1, 0.0)] * len(texts)
            names = ["und" if i < 0 else model.languages[i] for i, _ in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(names, pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(_fold() == 0, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def predict(docs: DataFrame) -> DataFrame:
    """Learn from the rows of ``docs`` that are not held out, then predict every row."""
    return identify(docs, fit(docs))
