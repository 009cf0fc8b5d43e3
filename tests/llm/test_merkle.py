"""Merkle fingerprints against a plain Python tree, successors against a sort, and located edits."""

import hashlib
import random
import re

import duckdb
import pytest

from rollwise.llm import merkle

md5 = lambda s: hashlib.md5(s.encode()).hexdigest()


def plain(text):
    """(fingerprint, distinct leaves with their lengths) straight from the definition."""
    sections, now = [], []
    for p in re.findall(r"[^\n]*\n|[^\n]+", text):
        leaves = [f"{len(x):03d}{md5(x)}" for x in re.findall(merkle.LEAF, p)]
        h = md5("".join(leaves))
        now.append((h, [x[:13] for x in leaves]))
        if h < "4":
            sections.append(now)
            now = []
    sections += [now] if now else []
    hashes = [md5("".join(h for h, _ in s)) for s in sections]
    body = "".join(f"{h[:8]}[{','.join(p[:8] + '=' + '.'.join(x) for p, x in s)}]" for h, s in zip(hashes, sections))
    return md5("".join(hashes)) + ":" + body, {x: int(x[:3]) for s in sections for _, l in s for x in l}


def near(a, b):
    (fa, la), (fb, lb) = plain(a), plain(b)
    if fa[:32] == fb[:32]:
        return 1.0
    whole, both = sum(la.values()) + sum(lb.values()), 2 * sum(n for x, n in la.items() if x in lb)
    return both / whole if both < whole else whole / (whole + 1)


def documents(n=120):
    r = random.Random(5)
    vocab = ["alpha", "béta", "γ", "😀", "end.", "3.14", "what?!", "x" * 90, "y" * 400, "\n", "\n\n", "tab\t", "", "..", "a" * 3]
    rows = [(i * 7 - 300, " ".join(r.choices(vocab, k=r.randint(0, 60)))) for i in range(n)]
    rows += [(None, "null id one."), (None, "null id two."), (None, None), (9000, None), (9001, ""), (9002, "same.\n" * 5000), (9003, "same.\n" * 5000), (3, "a"), (3, "b"), (3, "b"), (2**63 - 1, "top"), (-(2**63), "low")]
    r.shuffle(rows)
    return rows


def test_leaves_cover_the_text():
    for _, text in documents():
        for p in re.findall(merkle.PARAGRAPH, text or ""):
            assert "".join(re.findall(merkle.LEAF, p)) == p and max(map(len, re.findall(merkle.LEAF, p))) <= merkle.LEAF_CHARS + 10
        assert "".join(re.findall(merkle.PARAGRAPH, text or "")) == (text or "")


@pytest.mark.parametrize("partitions", [1, 4])
def test_edited_matches_plain_python(spark, partitions):
    rows = documents()
    df = spark.createDataFrame([(a, b, "clash", 1) for a, b in rows], "doc_id long, text string, fingerprint string, block int").repartition(partitions)
    key = dict(spark.createDataFrame(rows, "doc_id long, text string").select("text", merkle.text_key()).distinct().collect())
    order = sorted(rows, key=lambda x: (x[0] is None, -x[0] if x[0] is not None else 0, key[x[1]]))
    want = []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        new = text[: len(text) - cut] + after[:cut]
        want.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), plain(text)[0], plain(new)[0], round(near(text, new), 12), round(near(text, after), 12)))
    got = [(*r[:5], round(r[5], 12), round(r[6], 12)) for r in merkle.edited(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_blocks_of_every_number(spark, monkeypatch):
    rows = [(i, f"text number {i}. and more") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (1, 2, 7, 4096):
        monkeypatch.setattr(merkle, "MAX_BLOCKS", most)
        got = {r["doc_id"]: r["_next"] for r in merkle.with_next(df).collect()}
        assert got == {i: rows[i - 1][1] for i in range(50)}
    one = merkle.with_next(df.filter("doc_id = 7")).collect()
    assert [(r["text"], r["_next"]) for r in one] == [(rows[7][1], rows[7][1])]
    assert merkle.edited(df.limit(0)).count() == 0


def test_sql_gives_the_same_on_odd_rows(spark):
    rows = [x for x in {a: (a, b) for a, b in documents()}.values()]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.sql(merkle.oracle()).fetchall()
    got = merkle.edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    fix = lambda rows: sorted(((*r[:5], round(r[5], 12), round(r[6], 12)) for r in rows), key=repr)
    assert fix(got) == fix(want)


def test_differences_locate_the_edits(spark):
    r = random.Random(1)
    lines = [" ".join(f"w{r.randint(0, 10**6)}" for _ in range(r.randint(3, 30))) + ". Then more.\n" for _ in range(60)]
    other = lines[:10] + ["A new line here.\n"] + lines[10:40] + [lines[40].replace("Then", "Than")] + lines[41:]
    a, b = "".join(lines), "".join(other)
    df = merkle.fingerprints(spark.createDataFrame([(1, a, b), (2, a, a), (3, "", "x. y")], "k int, text string, b string"), "a")
    assert df.columns == ["k", "text", "b", "a"]
    pairs = merkle.fingerprints(df.withColumnRenamed("text", "t").withColumnRenamed("b", "text"), "b2")
    found = merkle.differences(pairs, ["k"], "a", "b2").collect()
    text = {(1, "a"): a, (1, "b"): b, (3, "b"): "x. y"}
    got = sorted((r["k"], r["side"], text[r["k"], r["side"]][r["start"] : r["start"] + r["len"]]) for r in found)
    assert got == sorted([(1, "a", "Then more.\n"), (1, "b", "Than more.\n"), (1, "b", "A new line here.\n"), (3, "b", "x. "), (3, "b", "y")])


def test_extra_cases(spark):
    df = spark.createDataFrame([(1, "ab", 5)], "doc_id long, text string, fingerprint int")
    assert merkle.fingerprints(df).columns == df.columns
    assert merkle.fingerprints(df.limit(0)).count() == 0
    assert plain("a\nb\n")[0][:32] != plain("b\na\n")[0][:32]
    assert near("a\nb\n", "b\na\n") < 1
