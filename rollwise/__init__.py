"""rollwise: rollout analytics as Spark DataFrame operators.

Modules: ``sources`` (tables, readers, writers), ``functions`` (column expressions for text,
rewards and grading), ``operators`` (replay, advantages, metrics, evaluation, preparation,
benchmarks, token arrays, loss, schedules, registries), ``plans`` (fixtures, flagship,
registered queries with DuckDB oracles) and ``streaming`` (keyed-state replay cache).
"""
