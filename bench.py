"""Benchmark: headline queries of each operator group at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (the whole plan executes, nothing
is collected): once untimed, so that its generated code is compiled and the JIT is warm,
then once timed. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollwise.plans import registry  # noqa: E402
from rollwise.session import local_session  # noqa: E402

HEADLINE = {
    # preparation
    "prep_render": "p4_chat_render",
    "prep_benchmarks": "u1_union_benchmarks",
    "prep_sample": "t1_seeded_sample_large",
    # replay
    "replay_highest_k": "r5_highest_k",
    "replay_max_variance_k": "r7_max_variance_k",
    "replay_buffer_asof": "j2_buffer_asof",
    # advantage (flagship) and metrics
    "flagship_split_advantage": "v3_split_advantage",
    "metrics_rewards": "a1_reward_stats",
    # loss
    "loss_metrics": "l7_loss_metrics",
    # evaluation and grading
    "eval_summary": "e5_eval_summary",
    "grade_accuracy": "g2_accuracy_reward",
    "schedule_repeat": "t3_repeat_schedule",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    default_parts = 2 * int(cpus) if cpus.isdigit() else 16  # two shuffle partitions per core
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", default_parts)), app="rollwise-bench")
    registry.load_all()
    times = {}
    for label, name in HEADLINE.items():
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        df = registry.QUERIES[name](spark, sf_dir)
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        times[label] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
