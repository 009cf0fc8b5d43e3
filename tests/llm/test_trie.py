"""The conversation trie against a plain dictionary of prefixes, with shards of every size."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from rollwise.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string"
WHITE = " \t\n\x0b\x0c\r"


def sha(ids):
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


def plain_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        head = c - (c - 20 * int(c / 20))
        out[c] = own.get(head, [])[:h] + v[h:]
    return out


def plain_nodes(ways):
    members, ends, children = defaultdict(set), defaultdict(set), defaultdict(set)
    for c, way in ways.items():
        for d in range(len(way) + 1):
            members[tuple(way[:d])].add(c)
            if d:
                children[tuple(way[: d - 1])].add(tuple(way[:d]))
        ends[tuple(way)].add(c)
    count = lambda text: len([w for w in "".join(" " if x in WHITE else x for x in text).split(" ") if w])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = sum(saved[x] for x in below) + ((len(members[node]) - 1) * count(node[-1][1]) if node else 0)
    return sorted(
        ((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n], sha(ends[n])) for n, m in members.items()),
        key=repr,
    )


def conversations(n=150):
    r = random.Random(4)
    rows = []
    for c in range(-45, n):
        if r.random() < 0.1:
            continue
        for turn in range(r.choice([0, 1, 2, 3, 3, 5, 9])):
            rows.append((c, turn, r.choice(["user", "assistant", None]), r.choice(["a b", "c\td e", "", None, "f  g\nh"]), "x"))
    for c in (1000, 1001, 1002, 1003, 1004, 1007):  # long equal conversations, two parting late
        rows += [(c, t, "user", f"same {t}" if (c, t) not in ((1003, 70), (1007, 79)) else "other", "x") for t in range(80)]
    rows += [(None, 1, "user", "nobody", "x"), (2000, None, "user", "null turn", "x"), (2000, 1, "b", "tie", "x"), (2000, 1, "b", "tie", "x"), (2000, 1, "a", "tie", "x"), (2000, 2, "a", "w " * 20_000, "x")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("members", [1, 2, 5, 4096])
def test_nodes_match_a_plain_trie(spark, members):
    rows = conversations()
    got = trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), members).collect()
    assert sorted(map(tuple, got), key=repr) == plain_nodes(plain_rebuilt(rows))


def test_rebuilt_turns(spark):
    rows = conversations(60)
    both, sizes = trie.rebuilt(spark.createDataFrame(rows, SCHEMA))
    want = plain_rebuilt(rows)
    key = lambda role, text: hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
    assert sorted((r["conv_id"], r["depth"], bytes(r["turn_key"])) for r in both.collect()) == sorted((c, i, key(*t)) for c, w in want.items() for i, t in enumerate(w, 1))
    assert {r["conv_id"]: r["turns"] for r in sizes.collect()} == {c: len(w) for c, w in want.items()}
    assert 0 in (len(w) for w in want.values())


def test_one_hot_prefix(spark):
    """All conversations equal: one path, trunk or shard alike, and one end list of all ids."""
    rows = [(c, t, "user", f"t{t}", "x") for c in range(0, 400, 20) for t in range(6)]
    for members in (3, 4096):
        got = trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), members).collect()
        assert sorted(map(tuple, got), key=repr) == plain_nodes(plain_rebuilt(rows)) and len(got) == 7


def test_sql_gives_the_same(spark):
    rows = [x[:4] for x in conversations(80)]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    cols = "conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256"
    assert sorted(con.sql(f"SELECT {cols} FROM ({trie.oracle()})").fetchall(), key=repr) == plain_nodes(plain_rebuilt(rows))


def test_no_conversations(spark):
    df = spark.createDataFrame([(None, 1, "user", "x", "y")], SCHEMA)
    assert trie.conversation_trie(df).collect() == [] and trie.conversation_trie(df.limit(0)).collect() == []
