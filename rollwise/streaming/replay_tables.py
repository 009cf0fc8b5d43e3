"""ST1 with its state in a table: every trigger is a batch job over the new rows and the buffers they touch.

``replay_cache.streaming_replays`` handles a prompt's rows of one trigger in one state call. Here
a trigger's rows are numbered on from the state with the skew-safe rank, its buffers are found by
the range join of the batch replay, and the state rows to keep by another one, so a prompt with any
number of rows in one trigger is spread over many tasks.

The state of a prompt is the C rows before its open step and its newest C rows, each with the
prompt's head: the next position, the open step, the position it starts at and its blocks that are
answered. A trigger writes the states of the prompts it touched; every ``full_every`` triggers it
writes all of them, and what is older goes. State and replays of a trigger lie in folders
named by its number and count only once a marker commits it, so a repeated or half-failed
trigger leaves what one would.

A prompt's steps arrive one after the other, as its trainer writes them. NULL prompts are one
prompt; a NULL block asks for nothing; rows of other modes are left out; an empty trigger changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollwise.operators.positions import rank_within_key
from rollwise.operators.replay import GROUP, ReplayConfig, buffer_asof, choose, gate
from rollwise.streaming.replay_cache import route

KEY = "prompt_key"
ROW = (KEY, "pos", "rollout_id", "seq", "score")
FULL_EVERY = 20


def _state_schema(key_type: T.DataType) -> T.StructType:
    head = T.StructType.fromDDL("pos bigint, rollout_id bigint, seq bigint, score double, next_pos bigint, p0 bigint, open_step bigint, blocks array<int>")
    return T.StructType([T.StructField(KEY, key_type), *head.fields])


def _replay_schema(key_type: T.DataType) -> T.StructType:
    named = T.StructType.fromDDL("batch_step bigint, batch_block int, replay_slot bigint, rollout_id bigint")
    return T.StructType([T.StructField(KEY, key_type), *named.fields])


def _fs(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _commits(spark: SparkSession, folder: str) -> dict[int, bool]:
    """Committed triggers, and whether each wrote the states of all prompts."""
    fs, path = _fs(spark, f"{folder}/commits")
    names = [x.getPath().getName() for x in fs.listStatus(path)] if fs.exists(path) else []
    return {int(n.split("-")[0]): n.endswith("-full") for n in names}


def _read(spark: SparkSession, folder: str, table: str, ids: list[int], schema: T.StructType) -> DataFrame:
    if not ids:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{folder}/{table}")
    return rows.filter(F.col("batch").isin(ids))  # prunes the folders of other triggers


def _same(a: DataFrame, b: DataFrame, *more: str) -> Column:
    on = a[KEY].eqNullSafe(b[KEY])
    for c in more:
        on = on & (a[c] == b[c])
    return on


def states(spark: SparkSession, folder: str, key_type: T.DataType) -> DataFrame:
    """The newest committed state of every prompt: at most 2 C rows each."""
    done = _commits(spark, folder)
    since = max((n for n, full in done.items() if full), default=0)
    rows = _read(spark, folder, "state", [n for n in done if n >= since], _state_schema(key_type))
    # A prompt has at most 2 C rows in each trigger since the last full one.
    newest = F.max("batch").over(Window.partitionBy(KEY))
    return rows.withColumn("_newest", newest).filter(F.col("batch") == F.col("_newest")).drop("batch", "_newest")


def read_replays(spark: SparkSession, folder: str, key_type: T.DataType) -> DataFrame:
    """The replays of all committed triggers."""
    return _read(spark, folder, "replays", list(_commits(spark, folder)), _replay_schema(key_type)).drop("batch")


def advance(before: DataFrame, rows: DataFrame, cfg: ReplayConfig, n_ranges: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(numbered rows, replays, next states) of ``rows`` on top of the states of their prompts.

    The first one is read by the other two: persist it before running them.
    """
    c = cfg.max_cache
    heads = before.groupBy(F.col(KEY).alias("_key")).agg(
        F.max("next_pos").alias("h_next"), F.max("p0").alias("h_p0"), F.max("open_step").alias("h_step"), F.any_value("blocks").alias("h_blocks")
    )
    starts = heads.select(F.col("_key").alias(KEY), F.col("h_next").alias("start"))
    numbered = rank_within_key(rows, [KEY], "seq", out="pos", n_ranges=n_ranges, starts=starts).persist()

    steps = numbered.groupBy(KEY, "step").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.collect_set("block").alias("asked"))
    goes_on = F.col("step").eqNullSafe(F.col("h_step"))
    steps = steps.join(heads.drop("h_next"), F.col(KEY).eqNullSafe(F.col("_key")), "left").select(
        KEY, "step", "first", "last", "asked",
        F.coalesce(F.when(goes_on, F.col("h_p0")), "first").alias("p0"),
        F.coalesce(F.when(goes_on, F.col("h_blocks")), F.array().cast("array<int>")).alias("answered"),
    )

    combined = before.select(*ROW).unionByName(numbered.select(*ROW))
    requests = steps.select(
        KEY,
        F.col("step").alias("batch_step"),
        F.explode(F.array_except("asked", "answered")).alias("batch_block"),
        "p0",
        F.least(F.col("p0"), F.lit(c)).cast("bigint").alias("buf_size"),
    )
    buffers = buffer_asof(combined, gate(requests, cfg.min_cache), c, key=KEY, carry=ROW[2:])
    replays = choose(buffers, cfg, key=KEY).select(KEY, *GROUP, "replay_slot", "rollout_id")

    opened = F.struct(F.col("step").alias("open_step"), "p0", F.array_union("answered", "asked").alias("blocks"))
    after = steps.groupBy(KEY).agg((F.max("last") + 1).alias("next_pos"), F.max_by(opened, "first").alias("h"))
    after = after.select(KEY, "next_pos", "h.p0", "h.open_step", "h.blocks")
    ends = [F.greatest(x, F.lit(0)) for x in (F.col("p0") - c, F.col("p0") - 1, F.col("next_pos") - c, F.col("next_pos") - 1)]
    wanted = after.withColumn("_rng", F.explode(F.array_distinct(F.transform(F.array(*ends), lambda x: F.floor(x / c)))))
    placed = combined.withColumn("_rng", F.floor(F.col("pos") / c))
    kept = placed.join(wanted, _same(placed, wanted, "_rng")).filter(
        (F.col("pos") >= F.col("next_pos") - c) | ((F.col("pos") >= F.col("p0") - c) & (F.col("pos") < F.col("p0")))
    )
    return numbered, replays, kept.select(placed[KEY], *ROW[1:], "next_pos", "p0", "open_step", "blocks")


def replay_trigger(cfg: ReplayConfig, folder: str, *, score: str = "score", full_every: int = FULL_EVERY) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: replays and states of a trigger, written and committed under ``folder``."""
    cfg.validate()

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = _commits(spark, folder)
        if number in done:
            return
        src = route(batch, cfg.modes) if cfg.modes else batch
        rows = src.select(
            KEY, F.col("rollout_id").cast("bigint"), F.col("seq").cast("bigint"), F.col(score).cast("double").alias("score"),
            F.col("step").cast("bigint"), F.col("block").cast("int"),
        ).persist()
        key_type = rows.schema[KEY].dataType
        every = states(spark, folder, key_type)
        touched = rows.select(KEY).distinct()
        # read for the heads, the buffers and the next states
        before = every.join(touched, _same(every, touched), "left_semi").persist()
        numbered, replays, kept = advance(before, rows, cfg)
        last_full = max((n for n, full in done.items() if full), default=None)
        full = last_full is None or number - last_full >= full_every
        if full:
            kept = kept.unionByName(every.join(touched, _same(every, touched), "left_anti"))
        replays.write.mode("overwrite").parquet(f"{folder}/replays/batch={number}")
        kept.write.mode("overwrite").parquet(f"{folder}/state/batch={number}")
        fs, marker = _fs(spark, f"{folder}/commits/{number}-{'full' if full else 'part'}")
        fs.create(marker, True).close()
        for held in (numbered, before, rows):
            held.unpersist()
        if full:
            for n in done:  # states older than this full one are read no more
                fs.delete(_fs(spark, f"{folder}/state/batch={n}")[1], True)

    return run


def run_replays(stream: DataFrame, cfg: ReplayConfig, folder: str, *, score: str = "score", full_every: int = FULL_EVERY) -> DataFrame:
    """ST1: run a rollout stream until its input is drained; returns the replays of all triggers."""
    query = stream.writeStream.foreachBatch(replay_trigger(cfg, folder, score=score, full_every=full_every))
    query.option("checkpointLocation", f"{folder}/offsets").trigger(availableNow=True).start().awaitTermination()
    return read_replays(stream.sparkSession, folder, stream.schema[KEY].dataType)
