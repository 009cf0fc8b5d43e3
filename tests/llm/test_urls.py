"""URL filters: parts and rules against brute force, models against direct counting, verdicts on held-out URLs."""

import math
import random

import numpy as np

from rollwise.llm import urls


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), tail[:stop]


def brute_rule(host, path):
    fits = [(len(t), t, v) for v, t in urls.RULES for h, p in [t.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


CASES = [
    "http://www.Example.com/en/1?x#y", "https://example.com/en/", "http://a.example.com/en/x", "http://foo.net/es/1", "http://foo.net/fr/", "http://foo.net/de/9",
    "https://x.org", "http://com", "http://com/", "x://notcom/", "ftp://u@h.COM:80/p#f", "no scheme", "", None, "http://É.com/À", "a://b://c/d", "http:///p", "http://h?q/x",
]


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(CASES)] + [(None, CASES[0], "x")], "page_id long, url string, host string")
    for r in urls.judge(df).collect():
        host, path = brute_parts(CASES[r["page_id"] or 0])
        assert (r["host"], r["path"]) == (host, path)
        name, verdict = brute_rule(host, path)
        assert r["rule"] == name and (verdict is None or r["verdict"] == verdict) and r["verdict"] in ("allow", "block")
    assert urls.judge(df.limit(0)).count() == 0
    kept = urls.keep_allowed(df)
    assert kept.columns == df.columns and kept.count() == urls.judge(df).filter("verdict = 'allow'").count()


def test_one_label_allows_the_rest(spark):
    df = spark.createDataFrame([(1, "http://a.com/"), (2, "http://b.org/")], "page_id long, url string")
    assert {r["verdict"] for r in urls.judge(df).collect()} == {"allow"}


def test_cells_and_smoothing():
    texts = ["abc", "", "Zé9/"]
    cell, of = urls._codes(texts)
    assert np.bincount(of).tolist() == [4, 1, 5]
    code = lambda c: urls.SYMBOLS - 1 if c == "$" else urls.ALPHABET.index(c) if c in urls.ALPHABET else urls.SYMBOLS - 2
    want = []
    for t in ("$$$abc$", "$$$$", "$$$zé9/$"):
        want += [sum(code(t[i - k]) * urls.SYMBOLS**k for k in range(4)) for i in range(3, len(t))]
    assert cell.tolist() == want
    counts = np.zeros(urls.SYMBOLS**4)
    np.add.at(counts, cell, 1)
    p = np.exp(urls.log_probabilities(counts.reshape((urls.SYMBOLS,) * 4)))
    assert np.allclose(p.sum(axis=-1), 1) and (p > 0).all()


def test_held_out_verdicts(spark):
    """Paths of allowed hosts read like words, those of blocked hosts like random codes; unseen hosts are told apart."""
    r = random.Random(5)
    word = lambda: r.choice(["garden", "river", "stone", "light", "music", "table"])
    junk = lambda: "".join(r.choices("xqzjk0987", k=6))
    rows, truth = [], {}
    for i in range(1500):
        good = r.random() < 0.5
        path = "/".join(word() if good else junk() for _ in range(3))
        host = r.choice(["good.com", "new.org"]) if good else r.choice(["bad.net/es", "new.org"])
        rows.append((i, f"http://{host}/{path}"))
        truth[i] = "allow" if good else "block"
    out = urls.judge(spark.createDataFrame(rows, "page_id long, url string")).filter("rule IS NULL").collect()
    right = sum(truth[x["page_id"]] == x["verdict"] for x in out) / len(out)
    assert len(out) > 300 and right > 0.95, right
    assert all(math.isfinite(x["score"]) for x in out)


def test_threshold_of_held_out_urls(spark):
    """The threshold does as well as any other on the rows held out."""
    r = random.Random(9)
    rows = []
    for _ in range(800):
        good = r.random() < 0.5
        text = "".join(r.choices("abcdefgh" if good else "defghijk", k=6))
        rows.append((text, good))
    scored, threshold = urls._scored(spark.createDataFrame(rows, "text string, allowed boolean"))
    held = [(x["score"], x["allowed"]) for x in scored.filter(urls.held_out()).collect()]
    n = sum(a for _, a in held), sum(not a for _, a in held)
    assert 100 < len(held) < 220

    def accuracy(t):
        return sum(a for s, a in held if s >= t) / n[0] + sum(not a for s, a in held if s < t) / n[1]

    edges = [math.floor(s / urls.BIN) * urls.BIN for s, _ in held]
    assert accuracy(threshold) >= max(accuracy(e) for e in edges) - 0.05
