"""Operator 10, quality rules: adaptive thresholds from mergeable quantile sketches.

Per document five counts are measured with SQL functions. Rates derived from them go into
quantile sketches, one per (language, source) and rate: log-linear histograms whose bins are
at most 1/32 of their value wide. Only documents that pass the base rule (enough words, not
mostly repeats) are sketched, so a source full of empty or repetitive documents does not set the
measure for its sound ones. Sketches are merged by adding the counts of equal bins, so
they aggregate map-side before the shuffle, a hot source is never gathered in one task, and a
group with fewer than ``min_group`` such documents uses the merged sketch of its language, or of
the whole corpus. The quantiles give fences: the median plus ``reach`` times the spread up to the
upper quartile, and for word length, the one rate that can be too low, the median less ``reach``
times the spread down to the lower quartile. A small least spread stands in where the quartiles
fall together. The fences are joined back and a document outside them is rejected.

Defined cases: a null text counts as empty (no words: ``base_failed``); null language or
source form groups of their own; repeated rows are measured and judged one by one; an empty
table gives an empty result; extra columns are ignored by ``judge`` and kept by
``quality_filter``. Ties at a fence are inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwise.llm.common import WORD, maybe_broadcast, packed, same, stage, unpacked

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
MIN_GROUP = 200
REACH = 8
#: rate -> (numerator, denominator, scale, least spread): spreads and fences are on the scaled integers.
RATES = {
    "symbols": ("n_symbols", "n_words", 1000, 12),
    "word_length": ("word_chars", "n_words", 100, 15),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 45),
    "repeats": ("n_repeat_words", "n_words", 1000, 32),
}
#: rates with a lower fence too; the others are defects, bad only when high
TWO_SIDED = ("word_length",)
BROADCAST_ROWS = 100_000


def _equal_neighbours(pairs: str) -> str:
    """SQL: positions, ascending, of the sorted (k, p) structs in ``pairs`` whose k occurs again."""
    return f"""
      transform(array(array_sort({pairs})), s -> array_sort(transform(
        filter(sequence(1, size(s)), j -> (j > 1 AND get(s, j - 2).k = get(s, j - 1).k)
                                       OR (j < size(s) AND get(s, j).k = get(s, j - 1).k)),
        j -> get(s, j - 1).p)))[0]"""


def _repeat_words(column: str) -> Column:
    """Words inside a WINDOW-word run that occurs twice or more in the text.

    Hashes of the runs find the candidates; only their words are compared. Every array is
    bound to a name once (``transform(array(x), name -> ...)[0]``), so a planner that puts the
    column's definition here does not repeat it for each element.
    """
    words = "w"
    hashed = f"transform(sequence(1, size({words}) - {WINDOW - 1}), i -> xxhash64(slice({words}, i, {WINDOW})))"
    candidates = _equal_neighbours("transform(h, (k, p) -> struct(k AS k, p + 1 AS p))")
    exact = _equal_neighbours(f"transform(c, p -> struct(array_join(slice({words}, p, {WINDOW}), ' ') AS k, p AS p))")
    covered = f"""
      aggregate(r, named_struct('n', 0L, 'last', CAST({1 - WINDOW} AS INT)),
        (a, p) -> named_struct('n', a.n + least({WINDOW}, p - a.last), 'last', CAST(p AS INT)), a -> a.n)"""
    return F.expr(f"""
      transform(array({column}), {words} -> CASE WHEN size({words}) <= {WINDOW} THEN 0L ELSE
        transform(array({hashed}), h ->
          CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE
            transform(array({candidates}), c ->
              transform(array({exact}), r -> CASE WHEN size(r) = 0 THEN 0L ELSE {covered} END)[0])[0]
          END)[0]
      END)[0]""")


def measured(df: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines from column ``_text``."""
    df = df.withColumn("_text", F.coalesce(F.col("_text"), F.lit("")))
    df = df.withColumns(
        {
            "_words": F.regexp_extract_all("_text", F.lit(f"({WORD})"), F.lit(1)),
            "_lines": F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD)),
        }
    )
    out = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": _repeat_words("_words"),
            "n_lines": F.size("_lines").cast("long"),
        }
    )
    return out.drop("_text", "_words", "_lines")


def _rate(name: str) -> Column:
    top, below, scale, _ = RATES[name]
    return F.expr(f"CASE WHEN {below} = 0 THEN 0L ELSE ({top} * {scale}) div {below} END")


def _bin(v: Column) -> Column:
    """Lower edge of the log-linear bin of a non-negative integer: exact below 64, 1/32 wide above."""
    shift = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, shift), shift)


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def sketches(measures: DataFrame) -> DataFrame:
    """Mergeable sketches of the documents passing the base rule: (lang, source, rate, bin, n), one row per non-empty bin."""
    long = measures.filter(~_base_failed()).select(
        "lang", "source", F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), _rate(r).alias("v")) for r in RATES])).alias("x")
    )
    return long.groupBy("lang", "source", "x.rate", _bin(F.col("x.v")).alias("bin")).agg(F.count("*").alias("n"))


def fences(cells: DataFrame, min_group: int = MIN_GROUP, reach: int = REACH) -> DataFrame:
    """One row per (lang, source) that has sketched documents, with <rate>_high, and <rate>_low for two-sided rates.

    The sketches of a language, and of everything, are merged from the cells; a group takes
    the finest of the three that holds at least ``min_group`` documents (the whole if none).
    """

    def quantiles(keys: list[str]) -> DataFrame:
        merged = cells.groupBy(*keys, "rate", "bin").agg(F.sum("n").alias("n"))
        part = ", ".join([*keys, "rate"])
        run = merged.withColumns(
            {
                "upto": F.expr(f"sum(n) OVER (PARTITION BY {part} ORDER BY bin)"),
                "total": F.expr(f"sum(n) OVER (PARTITION BY {part})"),
            }
        )
        at = lambda pct: F.expr(f"min(CASE WHEN upto * 100 >= total * {pct} THEN bin END)")
        return run.groupBy(*keys, "rate").agg(F.max("total").alias("docs"), at(25).alias("q25"), at(50).alias("q50"), at(75).alias("q75"))

    spread = F.create_map(*[x for r, v in RATES.items() for x in (F.lit(r), F.lit(v[3]).cast("long"))])
    groups = cells.select("lang", "source", "rate").distinct()
    fine, mid, whole = quantiles(["lang", "source"]), quantiles(["lang"]), quantiles([])
    q = lambda a: F.struct(*[F.col(f"{a}.{c}") for c in ("q25", "q50", "q75")])
    chosen = (
        groups.alias("g")
        .join(fine.alias("f"), same([(F.col(f"g.{c}"), F.col(f"f.{c}")) for c in ("lang", "source", "rate")]))
        .join(mid.alias("m"), same([(F.col(f"g.{c}"), F.col(f"m.{c}")) for c in ("lang", "rate")]))
        .join(whole.alias("w"), F.col("g.rate") == F.col("w.rate"))
        .select(
            "g.lang",
            "g.source",
            "g.rate",
            F.when(F.col("f.docs") >= min_group, q("f")).when(F.col("m.docs") >= min_group, q("m")).otherwise(q("w")).alias("q"),
        )
    )
    high = F.col("q.q50") + reach * F.greatest(F.col("q.q75") - F.col("q.q50"), spread[F.col("rate")])
    low = F.col("q.q50") - reach * F.greatest(F.col("q.q50") - F.col("q.q25"), spread[F.col("rate")])
    wide = []
    for r in RATES:
        wide.append(F.max(F.when(F.col("rate") == r, high)).alias(f"{r}_high"))
        if r in TWO_SIDED:
            wide.append(F.max(F.when(F.col("rate") == r, low)).alias(f"{r}_low"))
    return chosen.groupBy("lang", "source").agg(*wide)


def _verdict(measures: DataFrame, fence: DataFrame) -> DataFrame:
    joined = measures.alias("d").join(
        maybe_broadcast(fence, BROADCAST_ROWS).alias("f"),
        same([(F.col(f"d.{c}"), F.col(f"f.{c}")) for c in ("lang", "source")]),
        "left",
    )
    inside = F.lit(True)
    for r in RATES:
        inside = inside & (_rate(r) <= F.col(f"{r}_high"))
        if r in TWO_SIDED:
            inside = inside & (_rate(r) >= F.col(f"{r}_low"))
    return joined.select("d.*", _base_failed().alias("base_failed"), (~_base_failed() & inside).alias("kept"))


def judge(docs: DataFrame, min_group: int = MIN_GROUP, reach: int = REACH) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document (text, lang, source read)."""
    m = stage(measured(docs.select("doc_id", "lang", "source", F.col("text").alias("_text"))), "quality-measures")
    fence = stage(fences(stage(sketches(m), "quality-sketches"), min_group, reach), "quality-fences")
    return _verdict(m, fence).drop("lang", "source", "n_lines")


def quality_filter(docs: DataFrame, min_group: int = MIN_GROUP, reach: int = REACH) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns unchanged.

    The text is never shuffled: rows are written once with their counts, the fences made from the
    narrow counts and applied to the written rows.
    """
    rows = stage(measured(packed(docs, F.col("lang"), F.col("source"), F.col("text").alias("_text"))), "quality-rows")
    cells = stage(sketches(rows.drop("_row")), "quality-sketches")
    fence = stage(fences(cells, min_group, reach), "quality-fences")
    return unpacked(_verdict(rows, fence).filter("kept"))


# DuckDB: the same counts, sketch bins and fences over the table ``{table}``.
def oracle(table: str = "documents", min_group: int = MIN_GROUP, reach: int = REACH) -> str:
    """A WITH list ending in ``judged`` (every column of the table, the counts, base_failed, kept)."""
    rate = {r: f"CASE WHEN {b} = 0 THEN 0 ELSE ({t} * {s}) // {b} END" for r, (t, b, s, _) in RATES.items()}
    level = lambda name, keys: f"""
{name}_run AS (SELECT {keys}rate, bin, sum(n) OVER (PARTITION BY {keys}rate ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {keys}rate) AS total
  FROM (SELECT {keys}rate, bin, sum(n) AS n FROM cells GROUP BY {keys}rate, bin)),
{name} AS (SELECT {keys}rate, max(total) AS docs, min(CASE WHEN upto * 100 >= total * 25 THEN bin END) AS q25,
  min(CASE WHEN upto * 100 >= total * 50 THEN bin END) AS q50, min(CASE WHEN upto * 100 >= total * 75 THEN bin END) AS q75
  FROM {name}_run GROUP BY {keys}rate)"""  # noqa: E731
    spread = " ".join(f"WHEN '{r}' THEN {v[3]}" for r, v in RATES.items())
    failed = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words)"
    longs = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS rate, {rate[r]} AS v FROM measures WHERE NOT {failed}" for r in RATES)
    bound = lambda r, side: f"(SELECT min({side}) FROM fence x WHERE x.rate = '{r}' AND x.lang IS NOT DISTINCT FROM m.lang AND x.source IS NOT DISTINCT FROM m.source)"
    inside = " AND ".join([f"{rate[r]} <= {bound(r, 'hi')}" for r in RATES] + [f"{rate[r]} >= {bound(r, 'lo')}" for r in TWO_SIDED])
    return f"""
src AS (SELECT row_number() OVER () AS rid, * FROM {table}),
ws AS (SELECT rid, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM src),
win AS (SELECT rid, i, array_to_string(w[i : i + {WINDOW - 1}], ' ') AS k
  FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM ws WHERE len(w) > {WINDOW})),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, sum(least({WINDOW}, coalesce(nx - i, {WINDOW}))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nx FROM rep) GROUP BY rid),
measures AS (SELECT s.*, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines
  FROM src s JOIN ws USING (rid) LEFT JOIN cov USING (rid)),
longs AS ({longs}),
cells AS (SELECT lang, source, rate, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bin, count(*) AS n
  FROM longs GROUP BY ALL),{level("fine", "lang, source, ")},{level("mid", "lang, ")},{level("whole", "")},
picked AS (SELECT f.lang, f.source, f.rate,
  CASE WHEN f.docs >= {min_group} THEN f.q25 WHEN m.docs >= {min_group} THEN m.q25 ELSE w.q25 END AS q25,
  CASE WHEN f.docs >= {min_group} THEN f.q50 WHEN m.docs >= {min_group} THEN m.q50 ELSE w.q50 END AS q50,
  CASE WHEN f.docs >= {min_group} THEN f.q75 WHEN m.docs >= {min_group} THEN m.q75 ELSE w.q75 END AS q75
  FROM fine f JOIN mid m ON f.lang IS NOT DISTINCT FROM m.lang AND f.rate = m.rate JOIN whole w ON f.rate = w.rate),
fence AS (SELECT lang, source, rate, q50 - {reach} * greatest(q50 - q25, CASE rate {spread} END) AS lo,
  q50 + {reach} * greatest(q75 - q50, CASE rate {spread} END) AS hi FROM picked),
judged AS (SELECT *, NOT base_failed AND inside AS kept FROM (SELECT m.*,
  {failed} AS base_failed, coalesce({inside}, false) AS inside FROM measures m))"""
