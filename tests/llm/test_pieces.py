"""Sampled segmentations: exact round trips, and brute force over every segmentation of small texts."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollwise.llm import pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def every(v, text):
    """All segmentations of a text (ids) with their probability."""
    text = " " + text
    weight = {p: math.exp(v.log_weight[i]) for p, i in v.piece.items()}

    def go(at):
        if at == len(text):
            yield (), 1.0
            return
        for end in range(at + 1, min(len(text), at + v.longest) + 1):
            if text[at:end] in v.piece:
                for ids, w in go(end):
                    yield (v.piece[text[at:end]], *ids), w * weight[text[at:end]]
        if text[at] not in v.piece:
            for ids, w in go(at + 1):
                yield (*(v.byte[b] for b in text[at].encode()), *ids), w * math.exp(v.log_byte_weight)

    found = dict(go(0))
    total = sum(found.values())
    return {ids: w / total for ids, w in found.items()}


def draw(v, texts, seeds, k):
    encoder = pieces.Encoder(v)
    out = []
    for samples, kappa in encoder.sample(texts, seeds, k):
        out.append(([(tuple(encoder.ids(s.units)[0].tolist()), float(s.log_p.sum()), s.score) for s in samples], kappa))
    return out


def test_probabilities_and_top_k_match_brute_force(vocabulary):
    for text in ("the cat", "a\nb", "é☃x", "▁to", "  it "):
        truth = every(vocabulary, text)
        n = 6000
        got = draw(vocabulary, [text] * n, list(range(n)), 3)
        for samples, kappa in got[:300]:
            assert len({ids for ids, _, _ in samples}) == len(samples) == min(3, len(truth))
            assert all(abs(p - math.log(truth[ids])) < 1e-9 for ids, p, _ in samples)
            scores = [s for _, _, s in samples]
            assert scores == sorted(scores, reverse=True) and (kappa < scores[-1])
        first, second = Counter(s[0][0] for s, _ in got), Counter(s[1][0] for s, _ in got if len(s) > 1)
        for ids, p in sorted(truth.items(), key=lambda x: -x[1])[:6]:
            sd = math.sqrt(p * (1 - p) / n)
            assert abs(first[ids] / n - p) < 5 * sd + 1e-3
            if len(truth) > 1:  # without replacement: the second draw is from what the first left
                q = sum(truth[a] * p / (1 - truth[a]) for a in truth if a != ids)
                assert abs(second[ids] / n - q) < 5 * math.sqrt(q * (1 - q) / n) + 1e-3
        # Inclusion scores are unbiased: sums of 1 / inclusion over samples average to the number of segmentations' weight.
        if len(truth) > 3:
            total = [sum(math.exp(p - pieces.log_inclusion(p, kappa)) for _, p, _ in s) for s, kappa in got]
            assert abs(np.mean(total) - 1) < 5 * np.std(total) / math.sqrt(n) + 1e-2


def test_all_segmentations_when_few(vocabulary):
    (samples, kappa), = draw(vocabulary, ["\n"], [1], 50)
    truth = every(vocabulary, "\n")
    assert {ids for ids, _, _ in samples} == set(truth) and kappa == -math.inf
    assert all(pieces.log_inclusion(p, kappa) == 0 for _, p, _ in samples)
    assert draw(vocabulary, [""], [1], 2)[0][0][0][:2] == ((), 0.0)


def test_independent_of_batching(vocabulary):
    r = random.Random(0)
    texts = [" ".join(r.choices(["alpha", "beta,", "γδ", "x" * 70, "\t", "12"], k=r.randint(0, 40))) for _ in range(40)]
    whole = draw(vocabulary, texts, list(range(40)), 3)
    assert whole == [draw(vocabulary, [t], [i], 3)[0] for i, t in enumerate(texts)]


def test_bounds_do_not_depend_on_the_batch(vocabulary):
    """Every node's edges, their bounds and shares are bit-equal alone and among 400 texts."""
    r = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzéß日"
    texts = ["".join(r.choices(letters + " ", k=r.randint(1, 400))) for _ in range(400)]
    chunks = list(dict.fromkeys(c for t in texts for c in pieces.CHUNK.findall(" " + t)))

    def edges(lattices, chunk):
        lo = int(lattices.start[lattices.known[chunk]])
        first = lattices.first[lo : lo + len(chunk) + 1]
        cut = slice(int(first[0]), int(first[-1]))
        return [x[cut].tobytes() for x in (lattices.upto, lattices.log_p)] + [lattices.to[cut].astype(int).tolist()[0] - lo, (first - first[0]).tolist()]

    whole = pieces.Lattices(vocabulary)
    for c in chunks:
        whole.known[c]
    whole.add()
    for c in chunks[::40]:
        alone = pieces.Lattices(vocabulary)
        alone.known[c]
        alone.add()
        assert edges(alone, c) == edges(whole, c)


def test_large_batches_draw_alike(vocabulary):
    r = random.Random(7)
    texts = ["".join(r.choices("aeiourstlnm ", k=r.randint(200, 1500))) for _ in range(400)]
    whole = draw(vocabulary, texts, list(range(400)), 2)
    assert all(whole[i] == draw(vocabulary, [texts[i]], [i], 2)[0] for i in range(0, 400, 10))


def test_round_trip_and_edges(spark, vocabulary):
    texts = ["Hello  world. ", "▁▁ raw", "tab\tnew\n\nline", "日本語 テキスト 😀", "a" * 3000, "long text " * 30_000, " lead", "", None, "\x00\x01"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "null id", "x"), (0, texts[0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, samples string")
    out = pieces.sampled(df, k=3).collect()
    assert all(r["round_trip"] for r in out)
    count = Counter(r["doc_id"] for r in out)
    assert count[8] == 0 and count[7] == 1 and count[None] == 3 and count[0] == 6 and count[4] == 3
    assert len({r["ids_hash"] for r in out if r["doc_id"] == 0}) == 3  # the repeated row draws alike
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    coded = pieces.encode(df)
    back = pieces.decode(coded, F.transform("samples", lambda s: s["ids"]), ["doc_id", "samples"])
    for r in back.collect():
        text = texts[r["doc_id"] or 0] if r["doc_id"] is not None else "null id"
        assert text is None or set(r["decoded"]) == {text}
        if text and "▁" not in text:
            assert all(model.decode(s["ids"]) == text for s in r["samples"])
    assert pieces.sampled(df.limit(0)).count() == 0
