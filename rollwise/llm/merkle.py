"""Operator 12, document fingerprints: a Merkle tree over the paragraphs and sections of a text.

A paragraph is a line with its line break. It is cut into leaves, sentence by sentence, of at
most ``LEAF_CHARS`` + 10 code points, so that a long paragraph can be told apart in places. A
section is a run of paragraphs; it ends after a paragraph whose hash starts with 0 to 3, so
where sections end depends on the text alone and an insertion moves no later border. A leaf's
hash is the MD5 of its text, a paragraph's that of its leaves' lengths and hashes, a section's
that of its paragraphs' hashes, the root's that of its sections' hashes. Leaves cover every
character: equal texts have equal roots, and unlike roots mean unlike texts.

A fingerprint is one string: the root (32 hex digits), a colon, and every section as
``hash[paragraph,paragraph]`` with a paragraph as ``hash=leaf.leaf``; a leaf has three digits
for its length and ten of its hash. ``differences`` goes down two fingerprints and lists the
leaves below the branches that only one side has; ``likeness`` is twice the length of the
distinct leaves both have over the length of each one's distinct leaves (1 for equal roots and
below 1 for unlike ones).

``edited`` pairs every document with the next one by descending doc_id in one shuffle of the
texts. The order is cut into blocks at keys that a range partitioning of the narrow keys gives
(at most ``MAX_BLOCKS`` keys, literals in the plan); the first row of each block also goes to the
block before it, the first of all to the last block, so a window inside a block finds every
row's successor. All of it is SQL functions and one window.

Defined cases: a null text counts as empty; an empty text has no sections (its root is the MD5
of nothing); null doc_ids come last; rows of one doc_id are ordered by the hash of their text,
so a hot doc_id spreads over blocks; repeated rows follow each other (all but the last have a
copy of themselves as next document); a single document is its own next; extra columns are
ignored by ``edited`` and kept by ``fingerprints``; an empty table gives an empty result.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollwise.llm.common import packed, text_key, unpacked

LEAF_CHARS = 60
MAX_BLOCKS = 4096
BLOCKS_PER_PARTITION = 8
# How a text is cut; every character belongs to one paragraph and one leaf.
PARAGRAPH = r"[^\n]*\n|[^\n]+"
LEAF = rf"[^\n.!?]{{1,{LEAF_CHARS}}}[.!?]{{0,8}}\x20?\n?|[.!?]{{1,8}}\x20?\n?|\n"
# The parts of a fingerprint: pattern and group of each level.
LEAF_PART = r"[=.]([0-9a-f]{13})"
LEVELS = {"section": (r"[0-9a-f]{8}\[[^\]]*\]", 0), "paragraph": (r"[0-9a-f]{8}=[0-9a-f.]*", 0), "leaf": (LEAF_PART, 1)}


def _fingerprint_sql(column: str) -> str:
    """SQL of a text column's fingerprint; intermediates are bound to names (``transform(array(x), name -> ...)[0]``)."""
    leaf = "concat(lpad(CAST(length(l) AS STRING), 3, '0'), md5(l))"
    paragraph = f"""transform(array(transform(regexp_extract_all(p, r'{LEAF}', 0), l -> {leaf})), f ->
      transform(array(md5(array_join(f, ''))), h ->
        concat(h, '=', array_join(transform(f, x -> left(x, 13)), '.'), CASE WHEN h < '4' THEN ';' ELSE ',' END))[0])[0]"""
    paragraphs = f"transform(regexp_extract_all(coalesce({column}, ''), r'{PARAGRAPH}', 0), p -> {paragraph})"
    hashes = "transform(n, x -> md5(array_join(regexp_extract_all(x, '([0-9a-f]{32})=', 1), '')))"
    short = "regexp_replace(regexp_replace(x, '([0-9a-f]{8})[0-9a-f]{24}=', '$1='), ',$', '')"
    return f"""transform(array(filter(split(array_join({paragraphs}, ''), ';'), x -> x <> '')), n -> transform(array({hashes}), h ->
      concat(md5(array_join(h, '')), ':', array_join(transform(n, (x, i) -> concat(left(get(h, i), 8), '[', {short}, ']')), '')))[0])[0]"""


def fingerprint(column: str = "text") -> Column:
    """The fingerprint of the texts in a column."""
    return F.expr(_fingerprint_sql(column))


def fingerprints(docs: DataFrame, out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of ``text``; a column of that name is replaced."""
    rows = packed(docs, F.col("text").cast("string").alias("_text"))
    return unpacked(rows.select(F.col("_row").withField(out, fingerprint("_text")).alias("_row")))


def likeness(a: str, b: str) -> Column:
    """How alike the texts of two fingerprint columns are, from 0 to 1 (1 only for equal roots)."""
    leaves = lambda f: f"array_distinct(regexp_extract_all({f}, r'{LEAF_PART}', 1))"
    size = lambda x: f"aggregate({x}, 0L, (n, v) -> n + CAST(left(v, 3) AS INT))"
    return F.expr(f"""CASE WHEN left({a}, 32) = left({b}, 32) THEN 1D ELSE
      transform(array(struct({leaves(a)} AS a, {leaves(b)} AS b)), x ->
        transform(array(struct({size("x.a")} + {size("x.b")} AS whole, 2 * {size("array_intersect(x.a, x.b)")} AS both)), y ->
          CASE WHEN y.both < y.whole THEN y.both / y.whole ELSE y.whole / (y.whole + 1D) END)[0])[0] END""")


def _parts(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def _chars(parts: Column) -> Column:
    """Code points under the given parts of a fingerprint."""
    sizes = F.transform(parts, lambda p: F.aggregate(_parts(p, r"[=.]([0-9]{3})", 1), F.lit(0).cast("long"), lambda n, x: n + x.cast("int")))
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda n, x: n + x)


def differences(pairs: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """(keys, side, section, paragraph, leaf, start, len) of every leaf only one of two fingerprints has.

    Goes down from the root: equal roots give nothing; a section the other side has too is left
    out whole, then a paragraph that the other side's differing sections have, then a leaf likewise. ``side`` is 'a' or 'b', numbers count from 0
    (paragraph inside its section, leaf inside its paragraph), ``start`` is in code points.
    """
    unlike = pairs.filter(F.left(a, F.lit(32)) != F.left(b, F.lit(32)))
    rows = unlike.select(*keys, F.col(a).alias("_a"), F.col(b).alias("_b"), F.array(a).alias("_ina"), F.array(b).alias("_inb"))
    for level, (pattern, group) in LEVELS.items():  # the branches of this level that only one side has, below such branches
        for side in "ab":
            rows = rows.withColumn(f"_all{side}", F.flatten(F.transform(f"_in{side}", lambda x: _parts(x, pattern, group))))  # noqa: B023
        rows = rows.withColumns({"_ina": F.array_except("_alla", "_allb"), "_inb": F.array_except("_allb", "_alla")})
        rows = rows.withColumns({f"_a_{level}": F.col("_ina"), f"_b_{level}": F.col("_inb")})

    def only(side: str) -> DataFrame:
        at, names = rows.withColumns({"_part": F.col(f"_{side}"), "_at": F.lit(0).cast("long")}), []
        for level, (pattern, group) in LEVELS.items():
            at = at.withColumn("_all", _parts(F.col("_part"), pattern, group))
            at = at.select(*keys, *names, "_at", "_all", *[f"_{side}_{x}" for x in LEVELS], F.posexplode("_all").alias(level, "_part"))
            at = at.filter(F.array_contains(f"_{side}_{level}", F.col("_part")))
            before = F.slice("_all", F.lit(1), F.col(level))
            if level == "leaf":
                before = F.transform(before, lambda x: F.concat(F.lit("="), x))
            at = at.withColumn("_at", F.col("_at") + _chars(before))
            names.append(level)
        return at.select(*keys, F.lit(side).alias("side"), *names, F.col("_at").alias("start"), F.left("_part", F.lit(3)).cast("int").alias("len"))

    return only("a").unionByName(only("b"))


def _order() -> list[Column]:
    """Ascending columns of the documents' order: doc_id downwards, nulls last, then the text's hash."""
    doc_id = F.col("doc_id").cast("long")
    return [doc_id.isNull().alias("_n"), F.coalesce(F.bitwise_not(doc_id), F.lit(0)).alias("_i"), text_key().alias("_t")]


def _edges(docs: DataFrame, blocks: int) -> list[tuple]:
    """The least key of each of at most ``blocks`` ranges of about equally many rows, ascending."""
    ranged = docs.select(*_order()).repartitionByRange(blocks, "_n", "_i", "_t")
    least = ranged.groupBy(F.spark_partition_id().alias("_at")).agg(F.min(F.struct("_n", "_i", "_t")).alias("k"))
    return sorted(tuple(r["k"]) for r in least.collect())  # a row per range


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty) and fingerprint of every document, and _next and _next_fingerprint of the next one."""
    spark = docs.sparkSession
    blocks = min(MAX_BLOCKS, BLOCKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    edges = _edges(docs, blocks) or [(False, 0, 0)]
    step = isqrt(len(edges)) + 1
    table = lambda some: F.expr(f"array({', '.join(f'struct({str(n).lower()} AS _n, {i}L AS _i, {t}L AS _t)' for n, i, t in some)})")
    key = F.struct("_n", "_i", "_t")
    coarse = F.size(F.filter(table(edges[::step]), lambda e: e <= key)) - 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *_order())
    rows = rows.withColumn("_c", coarse * step).withColumn("_e", F.slice(table(edges), F.col("_c") + 1, F.lit(step)))
    rows = rows.withColumn("_b", F.col("_c") + F.size(F.filter("_e", lambda e: e <= key)) - 1)
    here = F.struct(F.col("_b").alias("block"), F.lit(0).alias("again"))
    before = F.struct(((F.col("_b") + len(edges) - 1) % len(edges)).alias("block"), F.lit(1).alias("again"))
    places = F.when(F.get("_e", F.col("_b") - F.col("_c")) == key, F.array(here, before)).otherwise(F.array(here))
    rows = rows.select("doc_id", "text", "_n", "_i", "_t", F.explode(places).alias("_p"))
    # Fingerprints are made after the texts' one shuffle, which the window shares.
    rows = rows.select("doc_id", "text", "_n", "_i", "_t", "_p.block", "_p.again").repartition("block")
    rows = rows.withColumn("fingerprint", fingerprint("text"))
    order = Window.partitionBy("block").orderBy("again", "_n", "_i", "_t")
    rows = rows.withColumns({"_next": F.lead("text").over(order), "_next_fingerprint": F.lead("fingerprint").over(order)})
    return rows.filter("again = 0").select("doc_id", "text", "fingerprint", "_next", "_next_fingerprint")


def edited(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint beside that of its edited text and of the next document.

    The edited text has the last third of the code points (rounded down) replaced by as many of
    the next document's first ones, or all it has. Columns: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.
    """
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long")).withColumn("_cut", F.expr("CAST(n_chars div 3 AS INT)"))
    rows = rows.withColumn("_edited", F.expr("concat(left(text, CAST(n_chars AS INT) - _cut), left(_next, _cut))"))
    rows = rows.withColumn("edited_fingerprint", fingerprint("_edited"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "_next_fingerprint").alias("near_next"),
    )


def oracle(table: str = "documents") -> str:
    """DuckDB: the rows of ``edited``."""

    def tree(text: str) -> str:
        leaf = "lpad(length(l)::VARCHAR, 3, '0') || md5(l)"
        paragraph = f"""list_transform([list_transform(regexp_extract_all(p, '{LEAF}'), lambda l: {leaf})], lambda f:
          list_transform([md5(array_to_string(f, ''))], lambda h: h || '=' || array_to_string(list_transform(f, lambda x: left(x, 13)), '.') || CASE WHEN h < '4' THEN ';' ELSE ',' END)[1])[1]"""
        paragraphs = f"list_transform(regexp_extract_all({text}, '{PARAGRAPH}'), lambda p: {paragraph})"
        return f"list_filter(string_split(array_to_string({paragraphs}, ''), ';'), lambda x: x <> '')"

    hashes = "list_transform(n, lambda x: md5(array_to_string(regexp_extract_all(x, '([0-9a-f]{32})=', 1), '')))"
    short = "regexp_replace(regexp_replace(z.n[i], '([0-9a-f]{8})[0-9a-f]{24}=', '\\1=', 'g'), ',$', '')"
    mark = lambda n: f"""list_transform([{{'n': {n}, 'h': list_transform([{n}], lambda n: {hashes})[1]}}], lambda z:
      md5(array_to_string(z.h, '')) || ':' || array_to_string(list_transform(range(1, len(z.n) + 1), lambda i: left(z.h[i], 8) || '[' || {short} || ']'), ''))[1]"""  # noqa: E731
    size = lambda x: f"coalesce(list_sum(list_transform({x}, lambda v: left(v, 3)::BIGINT)), 0)"
    near = lambda a, b: f"""CASE WHEN left({a}, 32) = left({b}, 32) THEN 1.0 ELSE list_transform([{{
      'a': list_distinct(regexp_extract_all({a}, '{LEAF_PART}', 1)), 'b': list_distinct(regexp_extract_all({b}, '{LEAF_PART}', 1))}}], lambda x:
      list_transform([{{'whole': {size("x.a")} + {size("x.b")}, 'both': 2 * {size("list_intersect(x.a, x.b)")}}}], lambda y:
        CASE WHEN y.both < y.whole THEN y.both::DOUBLE / y.whole::DOUBLE ELSE y.whole::DOUBLE / (y.whole + 1)::DOUBLE END)[1])[1] END::DOUBLE"""  # noqa: E731
    return f"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id DESC NULLS LAST) AS rid, doc_id, coalesce(text, '') AS t FROM {table}),
nx AS (SELECT d.*, coalesce(lead(t) OVER (ORDER BY rid), first(t) OVER (ORDER BY rid)) AS nt, length(t)::BIGINT AS n_chars FROM d),
ed AS (SELECT *, left(t, n_chars - n_chars // 3) || left(nt, n_chars // 3) AS e FROM nx),
tr AS (SELECT *, {tree('t')} AS tn, {tree('e')} AS en FROM ed),
fp AS (SELECT rid, doc_id, n_chars, sha256(e) AS edited_sha256,
  {mark('tn')} AS fingerprint, {mark('en')} AS edited_fingerprint FROM tr),
pr AS (SELECT *, coalesce(lead(fingerprint) OVER (ORDER BY rid), first(fingerprint) OVER (ORDER BY rid)) AS nf FROM fp)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, {near('fingerprint', 'edited_fingerprint')} AS near_edited, {near('fingerprint', 'nf')} AS near_next FROM pr"""
