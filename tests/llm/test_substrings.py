"""Substring dedup against brute force over all windows."""

import hashlib
import random
from collections import Counter

from rollwise.llm import substrings


def brute(rows, window):
    texts = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, texts):
        gone = {i + j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(window)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, vocab_size):
    r = random.Random(seed)
    vocab = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(vocab_size)]
    shared = [r.choices(vocab, k=r.randint(20, 90)) for _ in range(6)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(r.randint(0, 4)):
            words += r.choice(shared) if r.random() < 0.5 else r.choices(vocab, k=r.randint(0, 60))
        rows.append((i, r.choice([" ", "\n", "\t "]).join(words)))
    rows += [(500, None), (501, ""), (None, rows[3][1]), (7, rows[7][1]), (7, "x y"), (502, " ".join(["a"] * 500)), (503, " ".join(["b", "c"] * 18)), (504, " ".join(["z"] * 36)), (505, " ".join(["y", "x"] * 19))]
    return rows


def test_matches_brute_force(spark):
    for seed, vocab, window, group in ((1, 500, 35, 2048), (2, 3, 35, 2048), (3, 400, 35, 3), (4, 2, 12, 5), (5, 50, 5, 4)):
        rows = corpus(seed, vocab)
        df = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, n_words int")
        got = sorted(map(tuple, substrings.digests(df, window, group).collect()), key=repr)
        assert got == brute(rows, window), (seed, vocab, window, group)


def test_deduplicate_texts(spark):
    p = " ".join(f"p{i}" for i in range(40))
    rows = [(1, f"a  {p} b", "k"), (2, f"c {p}", None), (3, "left  as is", "k"), (4, None, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = substrings.deduplicate(df)
    assert out.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "a b", 2: "c", 3: "left  as is", 4: None}
    assert substrings.deduplicate(df.limit(0)).count() == 0 and substrings.digests(df.limit(0)).count() == 0


def test_copies_do_not_land_in_one_part(spark, monkeypatch):
    r = random.Random(6)
    p = " ".join(f"p{i}" for i in range(80))
    rows = [(i, p if i % 2 else p.replace(" ", "\n")) for i in range(300)] + [(1000, "whole row " + p)] * 200
    rows += [(2000 + i, " ".join(["t", str(i), p, str(r.random())])) for i in range(100)] + [(3000, p + " end"), (3001, "short")]
    largest, real = [], substrings._subtrees

    def watched(contexts, window):
        largest.append(max(x["count"] for x in contexts.groupBy("h", "part").count().collect()))
        return real(contexts, window)

    monkeypatch.setattr(substrings, "_subtrees", watched)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, substrings.digests(df, 35, 16).collect()), key=repr)
    assert got == brute(rows, 35)
    assert max(largest) <= 4 * 16
    kept = {(x["doc_id"], x["text"]) for x in substrings.deduplicate(df, 35, 16).collect()}
    assert {t for d, t in kept if d <= 1000} == {""} and (3000, "end") in kept and (3001, "short") in kept


def test_texts_of_few_words_have_few_anchors():
    """The words sent for the anchors stay within a few times the text, whatever it repeats."""
    for words in ([b"a"] * 10_000, [b"a", b"b"] * 5_000, [b"%d" % i for i in range(10_000)], [b"a"] * 5_000 + [b"%d" % i for i in range(5_000)]):
        h, first, last, places = substrings.anchors(words)
        assert first[0] == 0 and last[-1] == len(words) - 35 and (first[1:] == last[:-1] + 1).all()  # each window once
        assert (last - first + 35).sum() < 5 * len(words) and len(h) < len(words) / 10
