"""Preparation of prompt tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollwise.operators.positions import first_by, global_positions, key_columns, ranges

TRAINING_COLUMNS = ("prompt", "messages", "solution", "ground_truth")
#: role and text bytes of a conversation that is kept as one record
RECORD_BYTES = 64 << 20


def _msg(role: str | Column, content: Column) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    return F.struct(r.alias("role"), content.alias("content"))


def training_projection(
    raw: DataFrame,
    *,
    question: str = "question",
    solution: str = "r1_solution_1",
    final_answer: str = "final_answer",
    keep: Sequence[str] = TRAINING_COLUMNS,
) -> DataFrame:
    """P1 + P2: build ``prompt``/``messages``/``solution``/``ground_truth`` and keep only ``keep``.

    Other columns of ``raw`` listed in ``keep`` pass through; everything else is dropped,
    so the scan reads only the columns used.
    """
    q, s = F.col(question), F.col(solution)
    built = {
        "prompt": F.array(_msg("user", q)),
        "messages": F.array(_msg("user", q), _msg("assistant", s)),
        "solution": s,
        "ground_truth": F.col(final_answer),
    }
    return raw.select(*[built[c].alias(c) if c in built else F.col(c) for c in keep])


def assemble_messages(turns: DataFrame, *, conv: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns -> one ordered ``messages`` array per conversation.

    The array is the row's own content (a conversation is one record of the prompt table);
    ``last_assistant`` is the turn number of the last assistant message, NULL when none.
    """
    items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(role).alias("role"), F.col(text).alias("content"))))
    g = turns.groupBy(conv).agg(
        items.alias("_items"), F.max(F.when(F.col(role) == "assistant", F.col(order))).alias("last_assistant")
    )
    return g.select(
        conv,
        F.transform("_items", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"),
        F.transform("_items", lambda x: x["o"]).alias("turns"),
        "last_assistant",
    )


def message_runs(
    turns: DataFrame,
    *,
    max_bytes: int = RECORD_BYTES,
    conv: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
    n_ranges: int | None = None,
) -> DataFrame:
    """P6 for conversations of any length: a conversation's turns, in order, cut into runs of bounded size.

    Returns ``conv, run, messages, turns, total_bytes``: a run begins where a multiple of
    ``max_bytes`` is passed, so it holds at most that many bytes of role and text and one turn more.
    Bytes are summed per conversation and range of turns (map-side combined), the sums turned into
    offsets on that small table, and running sums taken inside a range, so no task holds a
    whole conversation. Equal turn numbers go by role and text, NULL first; NULL roles and texts
    have no bytes; NULL conversations are one.
    """
    named = key_columns(turns, [conv])
    by = [*named, "_rw_range"]
    size = F.coalesce(F.octet_length(role), F.lit(0)) + F.coalesce(F.octet_length(text), F.lit(0))
    narrow = turns.select(conv, order, role, text, size.cast("bigint").alias("_size"))
    tagged = ranges(narrow, order, n_ranges).tag(narrow.withColumns(named), order)
    sums = tagged.groupBy(*by).agg(F.sum("_size").alias("_in"))
    earlier = Window.partitionBy(*named).orderBy("_rw_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_off", F.coalesce(F.sum("_in").over(earlier), F.lit(0))).withColumn("total_bytes", F.sum("_in").over(Window.partitionBy(*named)))
    local = Window.partitionBy(*by).orderBy(order, role, text).rowsBetween(Window.unboundedPreceding, -1)
    placed = tagged.repartition(*by).join(sums.drop("_in"), by)
    placed = placed.withColumn("run", F.floor((F.col("_off") + F.coalesce(F.sum("_size").over(local), F.lit(0))) / max_bytes))
    items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(role).alias("role"), F.col(text).alias("content"))))
    per = placed.groupBy(conv, "run").agg(items.alias("_items"), F.max("total_bytes").alias("total_bytes"))
    return per.select(
        conv,
        "run",
        F.transform("_items", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"),
        F.transform("_items", lambda x: x["o"]).alias("turns"),
        "total_bytes",
    )


def bounded_messages(turns: DataFrame, *, max_bytes: int = RECORD_BYTES, conv: str = "conv_id", role: str = "role", **names) -> tuple[DataFrame, DataFrame]:
    """P6 with a bound: (records as of :func:`assemble_messages`, overflow).

    Conversations of more than ``max_bytes`` are no records but lie in the overflow as their runs; nothing is lost.
    """
    runs = message_runs(turns, max_bytes=max_bytes, conv=conv, role=role, **names)
    last = F.array_max(F.filter(F.zip_with("turns", "messages", lambda t, m: F.when(m["role"] == "assistant", t)), lambda t: t.isNotNull()))
    fits = F.col("total_bytes") <= max_bytes
    # A conversation of just max_bytes may have turns without bytes behind its first run.
    items = F.array_sort(F.collect_list(F.struct("run", "turns", "messages")))
    records = runs.filter(fits).groupBy(conv).agg(items.alias("_r")).select(
        conv, F.flatten(F.transform("_r", lambda x: x["messages"])).alias("messages"), F.flatten(F.transform("_r", lambda x: x["turns"])).alias("turns")
    )
    return records.withColumn("last_assistant", last), runs.filter(~fits)


def split_at_last_assistant(conv: DataFrame) -> DataFrame:
    """Prompt = messages before the last assistant turn; solution = that turn's content.

    Conversations with no assistant turn keep every message as prompt and a NULL solution.
    """
    zipped = F.arrays_zip(F.col("turns").alias("t"), F.col("messages").alias("m"))
    la = F.col("last_assistant")
    before = F.transform(F.filter(zipped, lambda z: la.isNull() | (z["t"] < la)), lambda z: z["m"])
    sol = F.element_at(F.transform(F.filter(zipped, lambda z: z["t"] == la), lambda z: z["m"]["content"]), 1)
    return conv.withColumn("prompt", before).withColumn("solution", F.when(la.isNotNull(), sol))


def assistant_prefix(prompt: str = "prompt", completion: str = "completion") -> tuple[Column, Column]:
    """When the prompt ends with an assistant message, drop it from the prompt and put its
    content in front of the completion. Returns ``(prompt, completion)`` columns; pure, no mutation."""
    p, c = F.col(prompt), F.col(completion)
    last = F.try_element_at(p, F.lit(-1))
    ends_assistant = F.coalesce(last["role"] == "assistant", F.lit(False))
    new_p = F.when(ends_assistant, F.slice(p, 1, F.size(p) - 1)).otherwise(p)
    new_c = F.when(ends_assistant, F.concat(last["content"], c)).otherwise(c)
    return new_p, new_c


def length_filter(df: DataFrame, n_tokens: Column, max_length: int | None, *, inclusive: bool = False) -> DataFrame:
    """keep rows whose token count is below ``max_length`` (``<=`` when inclusive); None keeps all.

    A row without a count (NULL) is not known to be too long, and kept.
    """
    if max_length is None:
        return df
    return df.filter(F.coalesce(n_tokens <= max_length if inclusive else n_tokens < max_length, F.lit(True)))


def seeded_order_key(key: str, seed: int) -> Column:
    """md5 of ``seed:key``; a NULL key sorts by the seed alone."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def seeded_sample(
    df: DataFrame,
    key: str,
    n: int | None,
    *,
    seed: int = 42,
    split: str | None = "split",
    sample_split: str = "train",
    on_short: str = "clamp",
    tie: str | None = None,
) -> DataFrame:
    """Seeded shuffle and first ``n`` of the sampled split; other splits pass through.

    A falsy ``n`` keeps everything. The order is ``md5(seed:key)`` then ``key``, reproducible
    across engines; ``tie`` orders rows that share a key. Rows whose split is NULL are not of the sampled split and pass through.
    Buckets of the order beyond ``n`` are dropped before any row is shuffled, whatever ``n`` is.
    ``on_short='raise'`` fails when the split has fewer than ``n`` rows.
    """
    if not n:
        return df
    chosen = F.col(split).eqNullSafe(F.lit(sample_split)) if split else F.lit(True)
    part = df.filter(chosen)
    if on_short == "raise":
        have = part.count()
        if have < n:
            raise ValueError(f"sample size {n} > {have} rows in split {sample_split!r}")
    ordered = part.withColumn("_order", seeded_order_key(key, seed))
    picked = global_positions(ordered, "_order", [key, tie] if tie else key, out="_gpos", first=n).select(*df.columns)
    return picked.unionByName(df.filter(~chosen)) if split else picked


def first_n(df: DataFrame, key: str, n: int | None) -> DataFrame:
    """The first ``n`` rows by ``key`` (the ``num_examples`` option made real)."""
    return df if not n else first_by(df, key, n)


def first_per_key(df: DataFrame, key: str, seq: str, cols: Sequence[str]) -> DataFrame:
    """One row per key, the values of its earliest row by ``seq``.

    An aggregate with ``min_by`` (partial aggregation before the shuffle), so a hot key
    sends one partial row per task instead of all its rows.
    """
    return df.groupBy(key).agg(
        F.min(seq).alias(seq), *[F.min_by(F.col(c), F.col(seq)).alias(c) for c in cols]
    )


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows per split."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"))
