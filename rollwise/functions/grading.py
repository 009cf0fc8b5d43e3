"""Reward and grading column functions (G1-G4) as native regex and string expressions.

Accuracy grading extracts the answer from both sides, normalises it to a typed value and compares
values of one type. The answer of a text is its rightmost closed ``\\boxed{}`` (braces of any
depth, escaped ones aside), else what follows its last "answer is"; a gold text may also give it
as its last ``$...$``, as the last number of a sentence in words, or as the whole text. Types:

* a number: integers, decimals, scientific notation, thousands separators, fractions (``a/b``,
  ``\\frac{a}{b}``, ``\\frac12``), multiples of a root or of pi (``2\\sqrt{3}/5``), an equation's
  right-hand side, units after a number (words or ``\\text{}``), degree and percent marks;
* a tuple or an interval (kept apart by their brackets): elements in order;
* a set in braces, or a bare list (commas, semicolons, "or", "and"): elements in any order;
* anything else is text, equal only to the same text: relations, several equations, expressions.

Two types never compare equal, and elements compare as numbers where both are, else as text. What
is not covered: symbolic equality of expressions (no LaTeX solver), brackets inside sequences. A
gold answer that yields nothing grades as NULL (unknown), never 0.

Each rule is written once and rendered both for Spark (Java regex) and for DuckDB (RE2),
so the SQL oracle applies the same steps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The format reward's pattern — "<think>" at the very start, "</think>" later.
THINK_OPEN, THINK_CLOSE = "<think>", "</think>"
FORMAT_PATTERN = r"^<think>[\s\S]*?</think>"

BOX = r"\boxed{"
# What follows the last "answer is"; for gold texts also the last $...$ and the last number.
ANCHOR = r"(?s)^.*[Aa]nswer is:?[ \t]*([^\n]+)"
MATH = r"(?s)^.*\$([^$]+)\$"
LAST_NUMBER = r"(?s)^(?:.*[^0-9.,-])?(-?[0-9][0-9,]*(?:\.[0-9]+)?)"

# A plain text that is a sentence: words, digits, and nothing of a formula.
SENTENCE = r"^[^\\\[\](){}<>=]*[A-Za-z]{2,}[^\\\[\](){}<>=]*$"

# (pattern, replacement) steps; a replacement "#1#2" names capture groups, anything else is literal.
_PLAIN = r"(?:[^{}+-]|\\sqrt\{[^{}]*\})+"
NORMALISE = [
    (r"\{,\}", ","),  # a thousands separator kept from spacing
    (r"\\left|\\right|\\[!,;:]|\\\(|\\\)|\$", ""),
    (r"([0-9})])\s*(?:\\(?:text|mathrm)\{\s*(?:or|and)\s*\}|\s(?:or|and)\s)\s*([0-9\\({.-])", "#1,#2"),
    (r"([0-9}])\s*\\(?:text|mathrm)\{\s*[A-Za-z][A-Za-z ]*\}(?:\^\{?[0-9]\}?)?\s*\.?\s*$", "#1"),  # a unit after a number
    (r"\\(?:text|mathrm|textbf)\{([^{}]*)\}", "#1"),
    (r"\\sqrt\s*([0-9])", "\\sqrt{#1}"),
    (r"\\[dt]?frac\s*([0-9])\s*([0-9])", "#1/#2"),
    (r"\\[dt]?frac\s*([0-9])\s*\{([^{}]+)\}", "#1/#2"),
    (rf"\\[dt]?frac\{{(-?{_PLAIN})\}}\s*([0-9])", "#1/#2"),
    (rf"\\[dt]?frac\{{(-?{_PLAIN})\}}\{{(-?[^{{}}+-]+)\}}", "#1/#2"),
    (r"\\[dt]?frac\{([^{}]+)\}\{([^{}]+)\}", "(#1)/(#2)"),
    (r"\^\{?\\circ\}?|\\?%", ""),
    (r"\.(?:\s[\s\S]*)?$", ""),  # the end of the sentence and what comes after
    (r"([0-9])\s+[A-Za-z][A-Za-z ]*$", "#1"),  # a unit in words
    (r"\\cdot|\\times", "*"),
    (r"\s+", ""),
    (r"^(-?[0-9]{1,3}),([0-9]{3})$", "#1#2"),  # thousands separators, up to three of them
    (r"^(-?[0-9]{1,3}),([0-9]{3})(\.[0-9]+)$", "#1#2#3"),
    (r"^(-?[0-9]{1,3}),([0-9]{3}),([0-9]{3})(\.[0-9]+)?$", "#1#2#3#4"),
    (r"^(-?[0-9]{1,3}),([0-9]{3}),([0-9]{3}),([0-9]{3})(\.[0-9]+)?$", "#1#2#3#4#5"),
]
# One equation stands for its right-hand side (``x=5`` reads as 5); a relation or several equations do not.
RHS = r"^[^=<>!]*=([^=<>]+)$"
_NUM = r"(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
# sign, factor, root, pi, divisor
TERM = rf"^([+-]?)({_NUM})?(?:\*?\\sqrt\{{({_NUM})\}})?(\*?\\pi)?(?:/(-?{_NUM}))?$"
TERM_HAS = r"^[+-]?(?:[0-9.]|\\sqrt|\\pi)"
# opening bracket, elements, closing bracket; or elements alone
_INNER = r"(?:[^()\[\]{}]|\\sqrt\{[^{}]*\})*"
SEQUENCE = rf"^(\\\{{|[(\[])({_INNER}[,;]{_INNER})(\\\}}|[)\]])$"
LIST = rf"^{_INNER}[,;]{_INNER}$"
ANY_ORDER = ("\\{\\}", ",")  # the kinds whose elements come in any order: sets and bare lists
TOLERANCE = 1e-9


def format_reward(text: Column | str) -> Column:
    """G1: 1.0 when the text starts with ``<think>`` and a ``</think>`` follows, else 0.0.

    Same as the anchored lazy pattern, written as a prefix test and a substring search.
    """
    t = F.col(text) if isinstance(text, str) else text
    ok = t.startswith(THINK_OPEN) & (F.locate(THINK_CLOSE, t, len(THINK_OPEN) + 1) > 0)
    return F.when(F.coalesce(ok, F.lit(False)), F.lit(1.0)).otherwise(F.lit(0.0))


def _spark_repl(r: str) -> str:
    return r.replace("\\", "\\\\").replace("#", "$")


def normalise(c: Column) -> Column:
    for pat, repl in NORMALISE:
        c = F.regexp_replace(c, pat, _spark_repl(repl))
    return c


def _box_content(piece: Column) -> Column:
    """The text up to the brace that closes the box opened just before ``piece``; NULL when none does."""
    seen = F.aggregate(
        F.split(F.regexp_replace(piece, r"\\[{}]", "__"), ""),
        F.struct(F.lit(1).alias("depth"), F.lit(0).alias("at")),
        lambda acc, ch: F.when(acc["depth"] == 0, acc).otherwise(
            F.struct(
                (acc["depth"] + F.when(ch == "{", 1).when(ch == "}", -1).otherwise(0)).alias("depth"), (acc["at"] + 1).alias("at")
            )
        ),
        lambda acc: F.when(acc["depth"] == 0, acc["at"]),
    )
    return F.left(piece, seen - 1)


def _boxed(text: Column) -> Column:
    """Content of the rightmost closed box."""
    pieces = F.split(text, r"\\boxed\{", -1)
    closed = F.filter(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), _box_content), lambda x: x.isNotNull())
    return F.try_element_at(closed, F.lit(-1))


def extract_answer(text: Column, *, gold: bool = False) -> Column:
    """The rightmost box, else the last "answer is"; a gold text may also be in ``$``, a sentence or bare."""
    other = F.when(text.rlike(ANCHOR), F.regexp_extract(text, ANCHOR, 1))
    if gold:
        bare = F.btrim(text)
        sentence = bare.rlike(r"\s") & bare.rlike(r"[0-9]") & bare.rlike(SENTENCE) & ~bare.rlike(r"[0-9]\s+(?:or|and)\s+[0-9]")
        other = other.when(text.rlike(MATH), F.regexp_extract(text, MATH, 1))
        other = other.when(sentence, F.regexp_extract(bare, LAST_NUMBER, 1)).when(bare != "", bare)
    raw = F.coalesce(F.when(F.contains(text, F.lit(BOX)), _boxed(text)), other)
    n = normalise(raw)
    n = F.when(n.rlike(RHS), F.regexp_extract(n, RHS, 1)).otherwise(n)
    return F.when(n != "", n)


def answer_value(norm: Column) -> Column:
    """Numeric value of a normalised answer or element: a number, a fraction, a multiple of a root or of pi, else NULL."""
    part = lambda i: F.regexp_extract(norm, TERM, i)
    number = lambda i: F.coalesce(F.when(part(i) != "", part(i)).try_cast("double"), F.lit(1.0))
    top = F.when(part(1) == "-", -1.0).otherwise(1.0) * number(2) * F.sqrt(number(3)) * F.when(part(4) != "", F.lit(math.pi)).otherwise(1.0)
    return F.when(norm.rlike(TERM) & norm.rlike(TERM_HAS), F.try_divide(top, number(5)))


def answer_kind(norm: Column) -> Column:
    """The brackets of a tuple, interval or set, a comma for a bare list, the empty string for one value or text."""
    brackets = F.concat(F.regexp_extract(norm, SEQUENCE, 1), F.regexp_extract(norm, SEQUENCE, 3))
    return F.when(norm.rlike(SEQUENCE), brackets).when(norm.rlike(LIST), F.lit(",")).otherwise(F.lit(""))


def answer_elements(norm: Column, kind: Column) -> Column:
    """(value, text) of each element, sorted where the kind has them in any order; one element for one value."""
    inner = F.when(norm.rlike(SEQUENCE), F.regexp_extract(norm, SEQUENCE, 2)).otherwise(norm)
    texts = F.when(kind == "", F.array(norm)).otherwise(F.split(inner, "[,;]", -1))
    each = F.transform(texts, lambda t: F.struct(answer_value(t).alias("v"), t.alias("t")))
    return F.when(kind.isin(*ANY_ORDER), F.array_sort(each)).otherwise(each)


def grade_from_parts(p: Column, g: Column, p_kind: Column, g_kind: Column, p_el: Column, g_el: Column) -> Column:
    """The grading rule over extracted answers, their kinds and their elements."""

    def same(x: Column, y: Column) -> Column:
        close = F.abs(x["v"] - y["v"]) <= F.lit(TOLERANCE) * F.greatest(F.lit(1.0), F.abs(y["v"]))
        return F.when(x["v"].isNotNull() & y["v"].isNotNull(), close).otherwise(x["t"] == y["t"])

    equal = (p_kind == g_kind) & (F.size(p_el) == F.size(g_el)) & F.forall(F.zip_with(p_el, g_el, same), lambda x: F.coalesce(x, F.lit(False)))
    return F.when(g.isNull(), F.lit(None).cast("double")).when(p.isNull(), F.lit(0.0)).otherwise(F.when(equal, 1.0).otherwise(0.0))


def with_accuracy(df: DataFrame, pred: str, gold: str, out: str = "reward", *, keep_parts: bool = False) -> DataFrame:
    """Add ``out`` = 1.0 / 0.0, or NULL when the gold answer cannot be read.

    Extraction, kinds and elements are projected as their own columns first, so each regex chain
    is evaluated once per row (inlining them into one expression repeats them and overflows
    the generated code).
    """
    staged = df.withColumn("_p", extract_answer(F.col(pred))).withColumn("_g", extract_answer(F.col(gold), gold=True))
    staged = staged.withColumns({"_pk": answer_kind(F.col("_p")), "_gk": answer_kind(F.col("_g"))})
    staged = staged.withColumns({"_pe": answer_elements(F.col("_p"), F.col("_pk")), "_ge": answer_elements(F.col("_g"), F.col("_gk"))})
    res = staged.withColumn(out, grade_from_parts(*(F.col(c) for c in ("_p", "_g", "_pk", "_gk", "_pe", "_ge"))))
    if keep_parts:
        one = lambda k, e: F.when(F.col(k) == "", F.get(e, F.lit(0))["v"])
        res = res.withColumns({"pred_value": one("_pk", "_pe"), "gold_value": one("_gk", "_ge")})
        return res.withColumnsRenamed({"_p": "pred_answer", "_g": "gold_answer"}).drop("_pk", "_gk", "_pe", "_ge")
    return res.drop("_p", "_g", "_pk", "_gk", "_pe", "_ge")


# ----------------------------------------------------------------------------- DuckDB forms


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_normalise(expr: str) -> str:
    for pat, repl in NORMALISE:
        expr = f"regexp_replace({expr}, {_q(pat)}, {_q(repl.replace(chr(92), chr(92) * 2).replace('#', chr(92)))}, 'g')"
    return expr


def sql_extract(expr: str, *, gold: bool = False) -> str:
    bare = f"trim({expr})"
    # The first position at which the braces opened so far are all closed ends a box.
    flat = "regexp_replace(s, '\\\\[{}]', '__', 'g')"
    depth = f"1 + length(replace(left({flat}, i), '}}', '')) - length(replace(left({flat}, i), '{{', ''))"
    end = f"list_min(list_filter(range(1, length(s) + 1), lambda i: {depth} = 0))"
    boxed = (
        f"list_filter(list_transform(string_split({expr}, '{BOX}')[2:], lambda s: left(s, CAST({end} AS BIGINT) - 1)), lambda c: c IS NOT NULL)[-1]"
    )
    more = ""
    if gold:
        more = (
            f" WHEN regexp_matches({expr}, {_q(MATH)}) THEN regexp_extract({expr}, {_q(MATH)}, 1)"
            f" WHEN regexp_matches({bare}, '\\s') AND regexp_matches({bare}, '[0-9]') AND regexp_matches({bare}, {_q(SENTENCE)}) AND NOT regexp_matches({bare}, '[0-9]\\s+(?:or|and)\\s+[0-9]')"
            f" THEN regexp_extract({bare}, {_q(LAST_NUMBER)}, 1) WHEN {bare} <> '' THEN {bare}"
        )
    raw = (
        f"(CASE WHEN {boxed} IS NOT NULL THEN {boxed}"
        f" WHEN regexp_matches({expr}, {_q(ANCHOR)}) THEN regexp_extract({expr}, {_q(ANCHOR)}, 1){more} END)"
    )
    # A list of one lets the normalised text be named and used twice.
    rhs = f"(CASE WHEN regexp_matches(n, {_q(RHS)}) THEN regexp_extract(n, {_q(RHS)}, 1) ELSE n END)"
    return f"nullif(list_transform([{sql_normalise(raw)}], lambda n: {rhs})[1], '')"


def sql_value(n: str) -> str:
    part = lambda i: f"regexp_extract({n}, {_q(TERM)}, {i})"
    number = lambda i: f"coalesce(TRY_CAST(nullif({part(i)}, '') AS DOUBLE), 1.0)"
    top = f"(CASE {part(1)} WHEN '-' THEN -1.0 ELSE 1.0 END) * {number(2)} * sqrt({number(3)}) * (CASE WHEN {part(4)} <> '' THEN pi() ELSE 1.0 END)"
    return f"(CASE WHEN regexp_matches({n}, {_q(TERM)}) AND regexp_matches({n}, {_q(TERM_HAS)}) THEN ({top}) / nullif({number(5)}, 0) END)"


def sql_kind(n: str) -> str:
    brackets = f"regexp_extract({n}, {_q(SEQUENCE)}, 1) || regexp_extract({n}, {_q(SEQUENCE)}, 3)"
    return f"(CASE WHEN regexp_matches({n}, {_q(SEQUENCE)}) THEN {brackets} WHEN regexp_matches({n}, {_q(LIST)}) THEN ',' ELSE '' END)"


def sql_elements(n: str, kind: str) -> str:
    inner = f"CASE WHEN regexp_matches({n}, {_q(SEQUENCE)}) THEN regexp_extract({n}, {_q(SEQUENCE)}, 2) ELSE {n} END"
    each = f"list_transform(CASE WHEN {kind} = '' THEN [{n}] ELSE string_split_regex({inner}, '[,;]') END, lambda t: {{'v': {sql_value('t')}, 't': t}})"
    any_order = ", ".join(_q(k) for k in ANY_ORDER)
    return f"(CASE WHEN {kind} IN ({any_order}) THEN list_sort({each}, 'ASC', 'NULLS FIRST') ELSE {each} END)"


def sql_equal(pk: str, gk: str, pe: str, ge: str) -> str:
    """Whether two answers of these kinds and elements are equal."""
    x, y = f"{pe}[i]", f"{ge}[i]"
    close = f"abs({x}.v - {y}.v) <= {TOLERANCE} * greatest(1.0, abs({y}.v))"
    same = f"CASE WHEN {x}.v IS NOT NULL AND {y}.v IS NOT NULL THEN {close} ELSE {x}.t = {y}.t END"
    return f"({pk} = {gk} AND len({pe}) = len({ge}) AND len(list_filter(range(1, len({ge}) + 1), lambda i: {same})) = len({ge}))"


def sql_format_reward(expr: str) -> str:
    return f"CAST(CASE WHEN coalesce(regexp_matches({expr}, {_q(FORMAT_PATTERN)}), false) THEN 1.0 ELSE 0.0 END AS DOUBLE)"
