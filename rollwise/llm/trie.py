"""Operator 11, conversation prefix trie by vertical bitmaps.

A node is a distinct sequence of a conversation's first turns (role and text). ``rebuilt`` gives
the turns of every conversation with a borrowed head; ``nodes`` builds the trie of any turns.

* A turn is the MD5 of its role and text; a node's key is the MD5 chain of its turns, computed
  by streaming each conversation's narrow rows in order. Members are counted per key by a
  map-side combined aggregate.
* Nodes with one member need no search (their subtree is a path). Nodes with more than
  ``shard_members`` members, and the root, form the trunk. What hangs below the trunk and is
  shared is cut into shards: the subtree of the first node on a conversation's way that has at
  most ``shard_members`` members. Shards are dealt by their key and streamed in order, so a task
  holds one shard at a time, and a hot prefix is split into the shards below it.
* Inside a shard conversations get bit numbers in ascending order. The index maps (position,
  turn) to the bitset of its conversations. Depth-first, a node's children are the intersections
  of its bitset with the postings of the next position; popcounts give members, the lowest bit the
  smallest member, and the bitset of conversations ending there the end list.
* Sums over the trunk's subtrees are taken by doubling: each round adds what hangs twice as far
  below and doubles every pointer upwards, so rounds grow with the logarithm of the trunk's depth.
* End lists of trunk nodes can hold any number of conversations; they are hashed by streaming
  sorted ids, never gathered.

Defined cases: null roles and texts are empty; turns are ordered by turn (null first), ties by
role, the text's first ``TIE_CHARS`` characters and its hash, so repeated rows are turns of their
own; rows without a conv_id belong to no conversation; a conversation without turns is a member
of the root and ends there; an empty table has no nodes; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollwise.llm.common import WORD, stage

SHARD_MEMBERS = 4096
GROUP = 20
TIE_CHARS = 64
HEADS = 4
ROOT = hashlib.md5(b"").digest()


def _head_size(c: Column) -> Column:
    """How many turns a conversation borrows: unsigned crc32 of its decimal id, modulo HEADS."""
    return F.crc32(c.cast("string").cast("binary")) % HEADS


def turns(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 1), turn_key (MD5 of role and text) and words of every turn."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.unhex(F.md5(F.concat(F.length(role), F.lit(":"), role, text)))
    narrow = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        key.alias("turn_key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        role.alias("_role"),
        F.xxhash64(text).alias("_text"),
        F.left(text, F.lit(TIE_CHARS)).alias("_start"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "_role", "_start", "_text", "turn_key")
    return narrow.select("conv_id", F.row_number().over(order).cast("long").alias("place"), "turn_key", "words")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns of every rebuilt conversation: conv_id, depth, turn_key, words; conv_id and its number of turns).

    Conversation c starts with the first h turns of conversation c - c % 20, h its head size,
    and goes on with its own turns after the first h.
    """
    own = stage(turns(rows), "trie-turns")
    sizes = own.groupBy("conv_id").agg(F.max("place").alias("own"))
    sizes = sizes.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("head"), _head_size(F.col("conv_id")).alias("h"))
    heads = own.filter((F.col("conv_id") % GROUP == 0) & (F.col("place") < HEADS))  # a few rows per group
    found = heads.groupBy(F.col("conv_id").alias("head")).agg(F.max("place").alias("had"))
    sizes = sizes.join(found, "head", "left").withColumn("lent", F.least("h", F.coalesce("had", F.lit(0)))).drop("had")
    sizes = stage(sizes.withColumn("turns", F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "trie-sizes")
    first = sizes.select("conv_id", "head", "h").join(heads.withColumnRenamed("conv_id", "head"), "head").filter("place <= h")
    rest = own.join(sizes.select("conv_id", "h", "lent"), "conv_id").filter("place > h")
    both = first.select("conv_id", F.col("place").alias("depth"), "turn_key", "words").union(
        rest.select("conv_id", F.col("place") - F.col("h") + F.col("lent"), "turn_key", "words")
    )
    return both, sizes.select("conv_id", "turns")


def keyed(both: DataFrame) -> DataFrame:
    """Turns with the keys of their node and of its parent, by streaming each conversation in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, key = None, ROOT
        for b in batches:
            node, parent = [], []
            for c, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if c != conv:
                    conv, key = c, ROOT
                parent.append(key)
                key = hashlib.md5(key + t).digest()
                node.append(key)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(node, pa.binary()), pa.array(parent, pa.binary())], names=[*b.schema.names, "node", "parent"])

    ordered = both.select("conv_id", "depth", "turn_key", "words").repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    return ordered.mapInArrow(run, "conv_id long, depth long, turn_key binary, words long, node binary, parent binary")


def _sha(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


NOTHING = _sha([])


class Shard:
    """One shard: its conversations in ascending order, and postings by (position, turn)."""

    def __init__(self, rows: list[tuple]) -> None:
        """``rows``: (conv_id, depth, turn_key, words, node, turns), the shared part of each conversation's way."""
        self.ids = sorted({r[0] for r in rows})
        bit = {c: 1 << i for i, c in enumerate(self.ids)}
        self.top = min(r[1] for r in rows)
        self.postings: dict[tuple[int, bytes], int] = {}
        self.words: dict[bytes, int] = {}
        self.key: dict[tuple[int, int], bytes] = {}  # (position, smallest member's bit number) -> node
        self.shared = [0] * (max(r[1] for r in rows) - self.top + 2)  # conversations whose way is shared up to a position
        self.ends: dict[int, int] = {}
        self.at: list[dict[int, bytes]] = [{} for _ in self.shared]  # per position: conversation's bit number -> its turn
        for c, depth, turn, words, node, turns_ in rows:
            p = depth - self.top
            self.postings[p, turn] = self.postings.get((p, turn), 0) | bit[c]
            self.at[p][bit[c].bit_length() - 1] = turn
            self.words[turn] = words
            self.shared[p] |= bit[c]
            self.key[p, bit[c].bit_length() - 1] = node
            if turns_ == depth:
                self.ends[depth] = self.ends.get(depth, 0) | bit[c]

    def _members(self, bits: int) -> list[int]:
        out = []
        while bits:
            low = bits & -bits
            out.append(self.ids[low.bit_length() - 1])
            bits ^= low
        return out

    def nodes(self) -> list[list]:
        """[node key, n_children, n_leaves, saved_tokens, ends_sha256] of every node, depth first."""
        found: list[list] = []
        # (position, bitset, words of the last turn, row of the parent)
        low = self.shared[0] & -self.shared[0]
        first = self.at[0][low.bit_length() - 1]
        todo = [(0, self.postings[0, first], self.words[first], -1)]
        while todo:
            p, bits, words, parent = todo.pop()
            ends = bits & self.ends.get(self.top + p, 0)
            alone = (bits & ~ends & ~self.shared[p + 1]).bit_count()  # go on in a branch of one member
            smallest = (bits & -bits).bit_length() - 1
            row = [self.key[p, smallest], alone, alone, (bits.bit_count() - 1) * words, _sha(self._members(ends)) if ends else NOTHING, parent]
            found.append(row)
            left = bits & self.shared[p + 1]
            while left:
                turn = self.at[p + 1][(left & -left).bit_length() - 1]
                child = bits & self.postings[p + 1, turn]
                todo.append((p + 1, child, self.words[turn], len(found) - 1))
                row[1] += 1
                left &= ~child
        for row in reversed(found):  # children come after their parents
            if not row[1]:
                row[2] = 1
            if row[5] >= 0:
                found[row[5]][2] += row[2]
                found[row[5]][3] += row[3]
        return found


def _searched(rows: DataFrame) -> DataFrame:
    """node, n_children, n_leaves, saved_tokens, ends_sha256 of all nodes in shards (column ``shard``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (x for b in batches for x in zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True))
        for _, group in groupby(each, key=lambda x: x[0]):
            found = Shard([x[1:] for x in group]).nodes()
            for lo in range(0, len(found), 4096):
                part = list(zip(*found[lo : lo + 4096], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[0], pa.binary()), *(pa.array(x, pa.int64()) for x in part[1:4]), pa.array(part[4], pa.string())],
                    names=["node", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
                )

    dealt = rows.select("shard", "conv_id", "depth", "turn_key", "words", "node", "turns").repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, "node binary, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """node and ends_sha256 of each node in ``ends`` (node, conv_id): sorted ids streamed into the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, hashlib.sha256()
        out = lambda: pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()])], names=["node", "ends_sha256"])
        for b in batches:
            for key, group in groupby(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True), key=lambda x: x[0]):
                text = ",".join(str(c) for _, c in group)
                if key == node:
                    sha.update(b"," + text.encode())
                    continue
                if node is not None:
                    yield out()
                node, sha = key, hashlib.sha256(text.encode())
        if node is not None:
            yield out()

    return ends.repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(run, "node binary, ends_sha256 string")


def _subtree_sums(trunk: DataFrame) -> DataFrame:
    """node, n_leaves and saved_tokens summed over the trunk's subtrees; ``trunk``: (node, up, n_leaves, saved_tokens).

    After a round a node's sums reach 2^round levels down and ``up`` points 2^round levels up.
    """
    now = stage(trunk, "trie-trunk")
    while now.filter("up IS NOT NULL").limit(1).count():
        below = now.filter("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        above = now.select(F.col("node").alias("up"), F.col("up").alias("far"))
        now = stage(
            now.join(below, "node", "left")
            .join(above, "up", "left")
            .select("node", F.col("far").alias("up"), (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens")),
            "trie-trunk",
        )
    return now.select("node", "n_leaves", "saved_tokens")


def nodes(both: DataFrame, sizes: DataFrame, shard_members: int = SHARD_MEMBERS) -> DataFrame:
    """The trie's nodes, the root included, of turns (conv_id, depth, turn_key, words) and (conv_id, turns).

    Columns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.
    """
    ways = stage(keyed(both), "trie-ways")
    sizes = sizes.select("conv_id", "turns")
    counted = ways.groupBy("node").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("words").alias("words")
    )
    counted = stage(counted, "trie-counts")
    whole = sizes.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")  # the root: one row
    root = whole.select(F.lit(ROOT).alias("node"), "n_convs", "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("words"))
    trunk = stage(counted.filter(F.col("n_convs") > shard_members).unionByName(root), "trie-trunk-nodes")

    # Shards: the shared nodes with at most shard_members members, under the first of them on the way.
    shared = counted.filter(F.col("n_convs").between(2, shard_members)).select("node")
    on_way = ways.join(shared, "node", "left_semi")
    first = F.first("node").over(Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    searched = stage(_searched(on_way.withColumn("shard", first).join(sizes, "conv_id")), "trie-searched")

    # The trunk: children by kind, then sums over subtrees, then ends.
    child = counted.select("node", F.col("parent").alias("up"), "n_convs").join(trunk.select(F.col("node").alias("up")), "up", "left_semi")
    child = child.join(searched.select("node", "n_leaves", "saved_tokens"), "node", "left")
    per = child.groupBy("up").agg(
        F.count("*").alias("n_children"),
        F.sum(F.when(F.col("n_convs") == 1, 1).otherwise(F.coalesce("n_leaves", F.lit(0)))).alias("n_leaves"),
        F.sum(F.coalesce("saved_tokens", F.lit(0))).alias("saved_tokens"),
    )
    own = trunk.join(per.withColumnRenamed("up", "node"), "node", "left").select(
        "node",
        F.col("parent").alias("up"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
        (F.coalesce("saved_tokens", F.lit(0)) + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    own = stage(own, "trie-trunk-own")
    sums = _subtree_sums(own.select("node", "up", "n_leaves", "saved_tokens"))
    at_end = ways.join(trunk.select("node"), "node", "left_semi").join(sizes, "conv_id").filter("depth = turns").select("node", "conv_id")
    ends = _end_hashes(at_end.union(sizes.filter("turns = 0").select(F.lit(ROOT), "conv_id")))
    of_trunk = own.select("node", "n_children").join(sums, "node").join(ends, "node", "left").select(
        "node", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")
    )

    # Nodes of one member: a path to the conversation's last turn.
    alone = counted.filter((F.col("n_convs") == 1) & (F.col("node") != F.lit(ROOT))).join(sizes, "conv_id")
    last = F.col("depth") == F.col("turns")
    of_alone = alone.select(
        "node",
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )
    facts = searched.unionByName(of_trunk).unionByName(of_alone)
    every = counted.unionByName(root)
    above = every.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        every.join(facts, "node")
        .join(above, "parent", "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    )


def conversation_trie(rows: DataFrame, shard_members: int = SHARD_MEMBERS) -> DataFrame:
    """The trie of the rebuilt conversations of a table (conv_id, turn, role, text)."""
    both, sizes = rebuilt(rows)
    return nodes(stage(both, "trie-rebuilt"), sizes, shard_members)


# DuckDB: nodes as lists of turns, subtrees by pairing every node with the nodes on its way up.
def oracle(table: str = "conversations") -> str:
    crc = """list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
      lambda a, b: list_reduce([xor(a, b)] || range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))"""
    return f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
  coalesce(role, '') AS role, coalesce(text, '') AS text FROM {table} WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % {GROUP} AS head, xor({crc}, 4294967295) % {HEADS} AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS part, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.head AND t.place <= c.h
  UNION ALL SELECT c.conv_id, 1, t.place, t.role, t.text FROM c JOIN t USING (conv_id) WHERE t.place > c.h),
k AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth, md5(length(role) || ':' || role || text) AS turn,
  len(regexp_extract_all(text, '{WORD}')) AS words FROM r),
w AS (SELECT conv_id, list(turn ORDER BY depth) AS way FROM k GROUP BY conv_id),
m AS (SELECT conv_id, 0 AS depth, '' AS node, NULL AS parent, 0 AS words, 0 AS turns FROM c WHERE conv_id NOT IN (SELECT conv_id FROM w)
  UNION ALL SELECT conv_id, 0, '', NULL, 0, len(way) FROM w
  UNION ALL SELECT k.conv_id, k.depth, md5(array_to_string(way[1 : k.depth], ',')), CASE k.depth WHEN 1 THEN '' ELSE md5(array_to_string(way[1 : k.depth - 1], ',')) END, words, len(way) FROM k JOIN w USING (conv_id)),
n AS (SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
  sha256(coalesce(string_agg(CASE WHEN turns = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM m GROUP BY node, depth),
ch AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
full_n AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (node)),
up AS (SELECT DISTINCT a.node AS top, b.node AS sub FROM m a JOIN m b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
s AS (SELECT top AS node, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((f.n_convs - 1) * f.words) AS saved_tokens
  FROM up JOIN full_n f ON f.node = up.sub GROUP BY top)
SELECT f.conv_id, f.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM full_n f JOIN s USING (node) LEFT JOIN n p ON p.node = f.parent"""
