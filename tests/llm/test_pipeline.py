"""The pipeline's stages, each against a plain version on its own input, and the driver contract."""

import sys

import duckdb
import pytest

from rollwise.llm import mixing, pieces, quality, secrets
from tests.conftest import SF_SMALL
from tests.llm.test_secrets import base, weak
from tests.llm.test_simhash import brute_components, brute_fingerprint

import corpus_pipeline


SECRET = "password=abcdefgh12 user=svc_account https://db.example.com:5432/x"


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    """The documents of the smallest table, one with secrets and a near copy of it."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    long = docs.filter("length(text) BETWEEN 3000 AND 9000").orderBy("doc_id").first()
    text = SECRET + " " + " ".join(reversed(long["text"].split(" ")))
    more = [(10**6 + i, t, long["lang"], long["source"], len(t)) for i, t in enumerate((text, text + " end"))]
    path = str(tmp_path_factory.mktemp("in") / "documents.parquet")
    docs.union(spark.createDataFrame(more, docs.schema)).coalesce(1).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def stages(spark, documents, tmp_path_factory):
    docs = spark.read.parquet(documents)
    out = [docs]
    for name, fn in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t")
        fn(spark, docs, SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "secret_scan", "source_mix", "encoding"]
    assert all(d.dtypes == stages[0].dtypes for d in stages[1:5])


def test_quality_stage(stages, documents):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{documents}/*.parquet')")
    rows = con.sql(f"WITH {quality.oracle()} SELECT doc_id FROM judged WHERE kept").fetchall()
    assert sorted(r["doc_id"] for r in stages[1].collect()) == sorted(r[0] for r in rows)


def test_dedup_stage(stages):
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in stages[1].collect()]
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted(set(brute_components(rows)))


def test_secret_stage(stages):
    before = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    after = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    assert stages[3].filter("n_chars <> length(text)").count() == 0
    assert before.keys() == after.keys()
    changed = 0
    for i, text in before.items():
        out, at, end = [], 0, -1
        for s, e in sorted((s, e) for _, s, e in base(text) + weak(text)):
            if s >= end:
                out += [text[at:s], secrets.REDACTED]
            at = end = max(e, end)
        want = "".join([*out, text[at:]]) if out else text
        changed += bool(out)
        assert after[i] == want
    assert changed


def test_mix_stage(stages):
    place = {r["doc_id"]: r["mix_position"] for r in mixing.schedule(stages[3]).collect()}
    assert sorted(r["doc_id"] for r in stages[4].collect()) == sorted(place)


def test_encoding_stage(stages):
    table = pieces.load().bytes_of
    text = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    got = stages[5].collect()
    assert sorted(r["doc_id"] for r in got) == sorted(text)
    for r in got:
        assert len({tuple(s["ids"]) for s in r["samples"]}) == len(r["samples"]) == pieces.SAMPLES
        assert all(b"".join(table[i] for i in s["ids"]).decode()[1:] == text[r["doc_id"]] for s in r["samples"])


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, fn in corpus_pipeline.STAGES:
        docs = fn(spark, docs, SF_SMALL)
        assert docs.count() == 0


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert "corpus_pipeline" in sys.modules
