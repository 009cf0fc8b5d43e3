"""Text column functions: Python-compatible strip, prompt templates, chat rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.isspace()`` accepts, i.e. what ``str.strip()``
# removes. Spark's ``trim`` removes spaces only, so the set is given explicitly.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The default chat template's role markers, in template order.
ROLE_MARKERS = {"user": "<|user|>", "system": "<|system|>", "assistant": "<|assistant|>"}
GENERATION_PROMPT = "<|assistant|>\n"
DEFAULT_EOS = "<|endoftext|>"

# The one prompt template, as prefix and suffix around the question.
PROMPTS = {
    "RL_ZERO": (
        "You first think about the reasoning process as an internal monologue and then provide the user "
        "with the answer. Respond in the following format: <think>\n...\n</think>\n<answer>\n...\n</answer>"
        "<|endoftext|>\n\nQuestion: ",
        "",
    )
}


def trim_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: remove every Unicode whitespace character at both ends."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(PY_WHITESPACE))


def sql_whitespace_literal() -> str:
    """The same character set as a DuckDB expression built from code points."""
    return " || ".join(f"chr({ord(ch)})" for ch in PY_WHITESPACE)


def fill_template(question: Column | str, prompt_type: str | None) -> Column:
    """Template with the question put in once; no brace re-substitution, no ``%`` formatting."""
    q = F.col(question) if isinstance(question, str) else question
    if prompt_type is None:
        return q
    if prompt_type not in PROMPTS:
        raise ValueError(f"unknown prompt type {prompt_type!r}; expected one of {sorted(PROMPTS)}")
    prefix, suffix = PROMPTS[prompt_type]
    return F.concat(F.lit(prefix), q, F.lit(suffix))


def render_chat(messages: Column | str, *, add_generation_prompt: bool = False, eos: str = DEFAULT_EOS) -> Column:
    """Render an ``ARRAY<STRUCT<role, content>>`` with the default chat template.

    Known roles give ``<|role|>\\n`` + content + eos + ``\\n``; other roles give nothing.
    """
    m = F.col(messages) if isinstance(messages, str) else messages
    marker = F.create_map(*[x for kv in ROLE_MARKERS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    known = F.filter(m, lambda x: x["role"].isin(*ROLE_MARKERS))
    parts = F.transform(
        known, lambda x: F.concat(F.element_at(marker, x["role"]), F.lit("\n"), x["content"], F.lit(eos + "\n"))
    )
    body = F.array_join(parts, "")
    if add_generation_prompt:
        # the generation marker follows the last message only when there is one
        body = F.concat(body, F.when(F.size(m) > 0, F.lit(GENERATION_PROMPT)).otherwise(F.lit("")))
    return body


def prompt_key(rendered: Column | str) -> Column:
    """P5: grouping/cache key of a prompt: SHA-256 of its rendered text."""
    return F.sha2(F.col(rendered) if isinstance(rendered, str) else rendered, 256)


ASCII_WHITESPACE = "\t\n\x0b\x0c\r "


def word_count(text: Column | str) -> Column:
    """Token count stand-in: number of runs of non-whitespace characters (no tokenizer library)."""
    t = F.btrim(F.col(text) if isinstance(text, str) else text, F.lit(ASCII_WHITESPACE))
    n = F.size(F.split(t, r"[\t\n\x0B\f\r ]+"))
    return (n - F.when(t == "", 1).otherwise(0)).cast("bigint")


def sql_word_count(expr: str) -> str:
    """DuckDB form of :func:`word_count`."""
    ws = " || ".join(f"chr({ord(c)})" for c in ASCII_WHITESPACE)
    t = f"trim({expr}, {ws})"
    return f"CAST(len(string_split_regex({t}, '[\\t\\n\\x0B\\f\\r ]+')) - CASE WHEN {t} = '' THEN 1 ELSE 0 END AS BIGINT)"
