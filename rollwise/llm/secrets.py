"""Operator 9, secret scans: base detectors, and weak candidates linked as parts of one credential.

Base spans (assignments, access identifiers, long hex runs) are always reported. Weak
candidates (account identifiers, mixed-case random-looking runs, endpoints) are reported only
when complementary parts co-occur in a scope. A scope is the union of overlapping intervals
reaching ``scope_chars`` code points to either side of an identifier (strong or weak). Parts and
scopes are interval-joined where they overlap, however long the part is: both are dealt to the
position bins they cover, and a pair is kept in the first bin that both cover. Then, per scope:

* a weak identifier is reported if the scope holds a secret (an assignment, hex run or weak one);
* a weak secret is reported (the scope holds an identifier by its making);
* an endpoint is reported if the scope holds a secret besides the identifier.

Everything is SQL functions, aggregates, windows and joins. Only narrow rows are shuffled: a
row per match, keyed by document; windows run inside one document's matches.

Defined cases: null text counts as empty; null doc_id is a key like any other; repeated rows
get equal results (matches are found once per distinct (doc_id, text) and joined back); weak
spans overlapping a base span are dropped; a part reaching into several scopes counts in each and
is reported once; ties in start are ordered by kind as listed;
extra columns are ignored by ``scan`` and kept by ``redact``; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollwise.llm.common import packed, row_key, stage, text_key, unpacked

SCOPE_CHARS = 256
REDACTED = "[REDACTED]"
# The detectors by kind, base kinds first, in the order used for ties.
KEYWORD = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
PATTERNS = {
    "assign": rf"""(?:{KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
    "ident": r"""(?:[Cc]lient_?[Ii][Dd]|[Uu]ser(?:name)?|[Ll]ogin|[Aa]ccount)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
    "random": r"[A-Za-z0-9/+_-]{20,}",
    "endpoint": r"""[a-z][a-z0-9+.-]*://[^\x20\x09-\x0D"'<>]+""",
}
KINDS = list(PATTERNS)
BASE = KINDS[:3]
# Text that every match of a kind holds: a cheap test before the pattern.
HINTS = {"access": "AKIA", "endpoint": "://"}
MIN_VALUE = 8
KEY = ["_id", "_null", "_th"]


def _accept(kind: str, match: Column) -> Column:
    """The test a match of a kind must pass; a failing match still uses up its text."""
    if kind == "assign":
        return F.length(F.regexp_extract(match, PATTERNS["assign"], 1)) >= MIN_VALUE
    if kind == "random":
        return match.rlike("[a-z]") & match.rlike("[A-Z]") & match.rlike("[0-9]")
    return F.lit(True)


def _piece(kind: str):
    """Builds (gap, len, ok) from the text before a match and the match."""
    return lambda gap, match: F.struct(
        F.length(gap).cast("long").alias("gap"), F.length(match).cast("long").alias("len"), _accept(kind, match).alias("ok")
    )


def matches(docs: DataFrame) -> DataFrame:
    """One row per document: its key, and per kind an array of (gap, len, ok).

    gap is the number of code points since the previous match of the kind. The pattern splits
    the text into gaps and extracts the matches between them.
    """
    rows = docs.select("doc_id", *row_key(F.col("doc_id"), text_key()), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    found = {}
    for kind, pattern in PATTERNS.items():
        got = F.regexp_extract_all("_text", F.lit(f"({pattern})"), F.lit(1))
        if kind in HINTS:
            got = F.when(F.contains(F.col("_text"), F.lit(HINTS[kind])), got)
        found[f"_{kind}"] = F.coalesce(got, F.array().cast("array<string>"))
    rows = rows.withColumns(found)
    pieces = {}
    for kind, pattern in PATTERNS.items():
        m = F.col(f"_{kind}")
        gaps = F.slice(F.split("_text", pattern, -1), F.lit(1), F.size(m))
        pieces[kind] = F.when(F.size(m) > 0, F.zip_with(gaps, m, _piece(kind)))
    return rows.select("doc_id", *KEY, *[c.alias(k) for k, c in pieces.items()])


def spans(found: DataFrame) -> DataFrame:
    """(key, kind, s, e) of every accepted match, once per distinct document; ``found`` is a written ``matches`` table."""
    some = found.filter(F.greatest(*[F.col(k).isNotNull() for k in KINDS]))
    once = some.groupBy(*KEY).agg(*[F.first(k).alias(k) for k in KINDS])
    by_kind = once.select(*KEY, F.explode(F.create_map(*[x for k in KINDS for x in (F.lit(k), F.col(k))])).alias("kind", "pieces"))
    each = by_kind.select(*KEY, "kind", F.posexplode("pieces").alias("pos", "m"))
    run = Window.partitionBy(*KEY, "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = each.withColumn("e", F.sum(F.col("m.gap") + F.col("m.len")).over(run))
    return ends.filter("m.ok").select(*KEY, "kind", (F.col("e") - F.col("m.len")).alias("s"), "e")


def linked(all_spans: DataFrame, scope_chars: int = SCOPE_CHARS) -> DataFrame:
    """The weak spans to report: complementary parts of one credential inside one scope."""
    by_doc = Window.partitionBy(*KEY).orderBy("s")
    before = by_doc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = by_doc.rowsBetween(Window.currentRow, Window.unboundedFollowing)

    def overlaps(blocks: Column) -> Column:
        return F.coalesce(F.max(F.when(blocks, F.col("e"))).over(before) > F.col("s"), F.lit(False)) | F.coalesce(
            F.min(F.when(blocks, F.col("s"))).over(after) < F.col("e"), F.lit(False)
        )

    kind = F.col("kind")
    marked = all_spans.withColumns({"in_base": overlaps(kind.isin(BASE)), "in_other": overlaps(kind != "random")})
    parts = marked.filter(kind.isin(*BASE, "endpoint") | ((kind == "ident") & ~F.col("in_base")) | ((kind == "random") & ~F.col("in_other")))
    parts = stage(parts.select(*KEY, "kind", "s", "e"), "secrets-parts")

    reach = parts.filter(kind.isin("access", "ident")).select(
        *KEY, F.greatest(F.col("s") - scope_chars, F.lit(0)).alias("lo"), (F.col("e") + scope_chars).alias("hi")
    )
    by_lo = Window.partitionBy(*KEY).orderBy("lo", "hi")
    so_far = F.max("hi").over(by_lo.rowsBetween(Window.unboundedPreceding, -1))
    apart = reach.withColumn("new", F.when(F.col("lo") <= so_far, 0).otherwise(1))
    scopes = (
        apart.withColumn("scope", F.sum("new").over(by_lo.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(*KEY, "scope")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .select(*KEY, "lo", "hi", F.explode(F.expr(f"sequence(lo div {scope_chars}, hi div {scope_chars})")).alias("bin"))
    )
    dealt = parts.withColumn("bin", F.explode(F.expr(f"sequence(s div {scope_chars}, (e - 1) div {scope_chars})")))
    met = dealt.join(scopes, [*KEY, "bin"]).filter(f"s < hi AND e > lo AND bin = greatest(s, lo) div {scope_chars}")
    secret = F.max(kind.isin("assign", "hex", "random")).over(Window.partitionBy(*KEY, "lo"))
    return met.withColumn("secret", secret).filter(~kind.isin(BASE) & F.col("secret")).select(*KEY, "kind", "s", "e").distinct()


def _listed(kinds: list[str]) -> Column:
    """kind:start:end of the collected spans of some kinds, by start, then kind as listed."""
    names = F.array(*[F.lit(k) for k in KINDS])
    of = F.filter("spans", lambda x: x["k"].isin([KINDS.index(k) for k in kinds]))
    return F.array_join(F.transform(of, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")


def found_spans(docs: DataFrame, scope_chars: int = SCOPE_CHARS) -> tuple[DataFrame, DataFrame]:
    """(documents with their keys, key -> ``spans``: array of (s, k, e) in reporting order, k the kind's number)."""
    found = stage(matches(docs), "secrets-matches")
    every = stage(spans(found), "secrets-spans")
    report = every.filter(F.col("kind").isin(BASE)).union(linked(every, scope_chars))
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    rows = F.struct(F.col("s"), number.alias("k"), F.col("e"))
    return found.select("doc_id", *KEY), report.groupBy(*KEY).agg(F.array_sort(F.collect_list(rows)).alias("spans"))


def scan(docs: DataFrame, scope_chars: int = SCOPE_CHARS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every document."""
    ids, found = found_spans(docs, scope_chars)
    rows = ids.join(found, KEY, "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<s:bigint,k:int,e:bigint>>")))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["k"] == KINDS.index(kind))).cast("long")
    return rows.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(_listed(BASE), 256).alias("base_sha256"),
        _listed(KINDS).alias("spans"),
    )


def redact(docs: DataFrame, scope_chars: int = SCOPE_CHARS) -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced; overlapping spans become one mark."""
    _, found = found_spans(docs, scope_chars)
    rows = packed(docs, *row_key(F.col("doc_id"), text_key()), F.col("text").cast("string").alias("_text")).join(found, KEY, "left")
    merged = F.expr("""
      aggregate(spans, CAST(array() AS array<struct<s:bigint,e:bigint>>), (a, x) ->
        CASE WHEN size(a) > 0 AND x.s < element_at(a, -1).e
             THEN concat(slice(a, 1, size(a) - 1), array(named_struct('s', element_at(a, -1).s, 'e', greatest(element_at(a, -1).e, x.e))))
             ELSE concat(a, array(named_struct('s', x.s, 'e', x.e))) END)""")
    rows = rows.withColumn("_cut", F.when(F.col("spans").isNotNull(), merged))
    kept = F.expr(f"""
      concat(array_join(transform(_cut, (x, i) -> concat(
               substring(_text, CAST(CASE WHEN i = 0 THEN 1 ELSE get(_cut, i - 1).e + 1 END AS INT),
                         CAST(x.s - CASE WHEN i = 0 THEN 0 ELSE get(_cut, i - 1).e END AS INT)), '{REDACTED}')), ''),
             substring(_text, CAST(element_at(_cut, -1).e + 1 AS INT)))""")
    return unpacked(rows.withColumn("_row", F.col("_row").withField("text", F.when(F.col("_cut").isNull(), F.col("_row.text")).otherwise(kept))))
