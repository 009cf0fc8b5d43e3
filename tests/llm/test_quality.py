"""Quality rules: counts against plain Python, fences and verdicts against plain quantiles of the same sketch."""

import random
import re
from collections import Counter, defaultdict

import duckdb

from rollwise.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {i + j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "n_lines": len(lines),
    }


def bin_of(v):
    shift = max(0, v.bit_length() - 6)
    return v >> shift << shift


def verdicts(rows, min_group, reach):
    """rows: (lang, source, counts); (base_failed, kept) of each, straight from sorted bins."""
    rate = lambda c, r: 0 if not c[quality.RATES[r][1]] else c[quality.RATES[r][0]] * quality.RATES[r][2] // c[quality.RATES[r][1]]
    groups = defaultdict(list)
    failed = lambda c: c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]
    for lang, source, c in rows:
        for key in (("f", lang, source), ("m", lang), ("w",)):
            if not failed(c):
                groups[key].append(c)
    out = []
    for lang, source, c in rows:
        level = next((groups[k] for k in (("f", lang, source), ("m", lang)) if len(groups[k]) >= min_group), groups[("w",)])
        if failed(c):
            out.append((True, False))
            continue
        inside = True
        for r, (_, _, _, least) in quality.RATES.items():
            bins = sorted(bin_of(rate(x, r)) for x in level)
            q25, q50, q75 = (bins[-(-len(bins) * p // 100) - 1] for p in (25, 50, 75))
            inside &= rate(c, r) <= q50 + reach * max(q75 - q50, least)
            inside &= r != "word_length" or rate(c, r) >= q50 - reach * max(q50 - q25, least)
        out.append((False, inside))
    return out


def make():
    r = random.Random(9)
    vocab = ["".join(r.choices("abcdeé", k=r.randint(1, 9))) for _ in range(60)]
    rows = []
    for i in range(400):
        words = r.choices(vocab, k=r.choice([0, 3, 25, 60, 120]))
        kind = r.random()
        if kind < 0.08:
            words = [w + r.choice(["###", "&&", "|"]) for w in words]
        elif kind < 0.16:
            words = words + words[: len(words) // 2]
        elif kind < 0.2:
            words = [w * 9 for w in words]
        sep = r.choice([" ", " \n", "\t", "\r\n\n"])
        rows.append((i, sep.join(words), r.choice(["en", "en", "en", "fr", None]), r.choice(["a", "a", "a", "b", None])))
    rows += [(900, None, None, None), (901, "", "en", "zz"), (902, "x " * 40_000, "en", "a"), (903, "same line\n" * 50, "fr", "b"), (None, rows[5][1], "en", "a"), rows[7], rows[7]]
    return rows


def test_counts_fences_and_verdicts(spark):
    rows = make()
    df = spark.createDataFrame([(a, b, c, d, "clash") for a, b, c, d in rows], "doc_id long, text string, lang string, source string, n_words string")
    for min_group, reach in ((50, 4), (10_000, 1)):
        out = quality.judge(df, min_group, reach).collect()
        each = [(a, counts(b), c, d) for a, b, c, d in rows]
        marks = verdicts([(c, d, m) for _, m, c, d in each], min_group, reach)
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        want = [(a, *(m[n] for n in names), *v) for (a, m, _, _), v in zip(each, marks)]
        got = [(r["doc_id"], *(r[n] for n in names), r["base_failed"], r["kept"]) for r in out]
        assert sorted(got, key=repr) == sorted(want, key=repr)
        kept = quality.quality_filter(df, min_group, reach)
        assert kept.columns == df.columns
        assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((w[0] for w in want if w[-1]), key=repr)
    assert quality.judge(df.limit(0)).count() == 0 and quality.quality_filter(df.limit(0)).count() == 0


def test_sql_gives_the_same_on_odd_rows(spark):
    rows = make()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    sql = con.sql(f"WITH {quality.oracle()} SELECT doc_id, n_repeat_words, n_dup_lines, base_failed, kept FROM judged").fetchall()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = quality.judge(df).select("doc_id", "n_repeat_words", "n_dup_lines", "base_failed", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(sql, key=repr)


def test_sketches_merge_by_adding(spark):
    df = spark.createDataFrame([(i, "w " * (i % 90), "en", "s") for i in range(500)], "doc_id long, text string, lang string, source string")
    cells = lambda x: quality.sketches(quality.measured(x.select("lang", "source", quality.F.col("text").alias("_text"))))
    parts = cells(df.filter("doc_id % 3 = 0")).union(cells(df.filter("doc_id % 3 <> 0")))
    key = ["lang", "source", "rate", "bin"]
    merged = {tuple(r[:4]): r[4] for r in parts.groupBy(*key).agg(quality.F.sum("n")).collect()}
    assert merged == {tuple(r[:4]): r[4] for r in cells(df).select(*key, "n").collect()}


def test_a_repetitive_source_keeps_its_clean_documents(spark):
    """300 repetitive and 60 clean documents of one source: the clean ones stay; so they do among empty and coded ones."""
    r = random.Random(11)
    clean = lambda: " ".join("".join(r.choices("abcdefgh", k=r.randint(3, 7))) for _ in range(150))
    rows = [(i, "the same eight words again and over again " * 30, "en", "a") for i in range(300)]
    rows += [(1000 + i, clean(), "en", "a") for i in range(60)]
    rows += [(2000 + i, None, "en", "b") for i in range(300)] + [(3000 + i, clean(), "en", "b") for i in range(60)]
    rows += [(4000 + i, "".join(f"line {j} of {i}\n" + "same line\n" * 9 for j in range(60)), "en", "c") for i in range(300)] + [(5000 + i, clean(), "en", "c") for i in range(60)]
    out = {x["doc_id"]: x["kept"] for x in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(out[i] for i in out if 1000 <= i < 2000 or 3000 <= i < 4000 or i >= 5000)
    assert not any(out[i] for i in out if i < 1000 or 2000 <= i < 3000)


def test_quantiles_decide(spark):
    """A rate that is usual in one source is too high in another: the fence moves with the sketch."""
    r = random.Random(12)
    words = lambda n, mark: " ".join(("#" if r.random() < mark else "") + "".join(r.choices("abcdefgh", k=5)) for _ in range(n))
    rows = [(i, words(200, r.choice([0.0, 0.1, 0.2, 0.3])), "en", "code") for i in range(300)] + [(1000 + i, words(200, 0.0), "en", "prose") for i in range(300)]
    rows += [(2000, words(200, 0.4), "en", "code"), (2001, words(200, 0.4), "en", "prose")]
    out = {x["doc_id"]: x["kept"] for x in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert out[2000] and not out[2001] and all(out[i] for i in out if i < 2000)
