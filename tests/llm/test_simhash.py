"""SimHash near-dedup against a brute-force version over all pairs."""

import random

import numpy as np
import xxhash

from rollwise.llm import simhash
from rollwise.llm.components import components


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    """rows: (doc_id, fp); smallest non-null doc_id reachable, per row."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    arr = np.array(fps, dtype=np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1 :] ^ arr[i]) <= 3):
            a, b = find(f), find(fps[i + 1 + j])
            root[max(a, b)] = min(a, b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return [least.get(find(f)) for _, f in rows]


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_duplicates(df, **kw).select("doc_id", simhash.hex_fingerprint().alias("f"), "component_id").collect()
    marked = [(d, brute_fingerprint(t)) for d, t in rows]
    want = sorted(((d, f"{f:016x}", c) for (d, f), c in zip(marked, brute_components(marked))), key=repr)
    assert sorted(map(tuple, got), key=repr) == want


def test_documents_match_brute_force(spark):
    r = random.Random(1)
    vocab = ["".join(r.choices("abcdefghij", k=r.randint(2, 7))) for _ in range(200)]
    rows = []
    for i in range(150):
        words = r.choices(vocab, k=r.choice([1, 2, 3, 30, 400]))
        rows.append((3 * i, " ".join(words)))
        for k in range(r.randint(0, 4)):
            w = list(words)
            w[r.randrange(len(w))] = r.choice(vocab)
            rows.append((3 * i + 1 + 1000 * k, "\t ".join(w).title()))
    rows += [(7, None), (8, ""), (None, " \n"), (9, "é É"), (None, "only null id here"), (5, rows[0][1]), (5, rows[0][1])]
    r.shuffle(rows)
    check(spark, rows)


def test_large_buckets_are_split_exactly(spark):
    r = random.Random(2)
    base = r.getrandbits(64)
    fps = {base}
    while len(fps) < 900:
        x = r.choice(sorted(fps)) if r.random() < 0.5 else base
        for b in r.sample(range(64), r.randint(1, 5)):
            x ^= 1 << b
        fps.add(x)
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {n: t for n, t in components(simhash.links(df, bucket_rows=40)).collect()}
    want = brute_components([(i, f) for i, f in enumerate(sorted(fps))])
    by_got, by_want = {}, {}
    for i, f in enumerate(signed):
        by_got.setdefault(got.get(f, f), set()).add(i)
        by_want.setdefault(want[i], set()).add(i)
    assert sorted(map(sorted, by_got.values())) == sorted(map(sorted, by_want.values()))


def test_deduplicate_keeps_one_row_and_all_columns(spark):
    rows = [(2, "a b c d e", "x"), (1, "a b c d e", "y"), (1, "a b c d e", "y"), (3, "q r s t u v w x y z " * 5, None), (None, "a b c d e", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    out = simhash.deduplicate(df)
    assert out.columns == ["doc_id", "text", "fp"]
    assert sorted(map(tuple, out.collect())) == [(1, "a b c d e", "y"), (3, rows[3][1], None)]
    assert simhash.deduplicate(df.limit(0)).count() == 0


def test_plan_covers_the_distance():
    both = np.diag(np.full(64, 500.0)) + 250 * (1 - np.eye(64))
    for n in (1_000, 10**6, 10**9):
        plan = simhash.partition_plan(1000, both) if n == 1000 else simhash.partition_plan(n, both * (n / 1000))
        assert sum(t + 1 for _, t in plan) == 4
        assert len({b for g, _ in plan for b in g}) == sum(len(g) for g, _ in plan)
