"""Gathering a row's cells from a stream in which they arrive in any order.

State is kept by (projection, row): the names that have come, until all expected ones are there or nothing has come
for a while; then the missing ones are named, so that they can be loaded directly.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIMEOUT_MS = 180_000
RESULT = "projection int, row int, complete boolean, names string, missing string"


def _gather(timeout_ms: int):
    def step(key, batches: Iterable[pd.DataFrame], state):
        seen, expected = (set(state.get[0].split(",")) - {""}, set(state.get[1].split(",")) - {""}) if state.exists else (set(), set())
        for b in batches:
            seen |= set(b["name"].dropna())
            for text in b["expected"].dropna():
                expected |= set(text.split(",")) - {""}
        done = bool(expected) and expected <= seen
        if done or state.hasTimedOut:
            if state.exists:
                state.remove()
            missing = sorted(expected - seen)
            yield pd.DataFrame({"projection": [key[0]], "row": [key[1]], "complete": [done], "names": [",".join(sorted(seen))], "missing": [",".join(missing)]})
        else:
            state.update((",".join(sorted(seen)), ",".join(sorted(expected))))
            state.setTimeoutDuration(timeout_ms)

    return step


def gather_rows(arrivals: DataFrame, timeout_ms: int = TIMEOUT_MS) -> DataFrame:
    """arrivals: a stream of projection, row, name, expected (comma list of the row's cells). A row comes out once, complete or timed out."""
    return arrivals.groupBy("projection", "row").applyInPandasWithState(_gather(timeout_ms), RESULT, "seen string, expected string", "append", "ProcessingTimeTimeout")


def gathered_batch(arrivals: DataFrame) -> DataFrame:
    """The same for arrivals at rest."""
    rows = arrivals.groupBy("projection", "row").agg(F.array_sort(F.collect_set("name")).alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.split("expected", ","))))).alias("e"))
    return rows.select("projection", "row", (F.size(F.array_except("e", "n")) == 0).alias("complete"), F.concat_ws(",", "n").alias("names"), F.concat_ws(",", F.array_except("e", "n")).alias("missing"))


def save_each_batch(stream: DataFrame, path: str, checkpoint: str):
    """Appends every micro-batch to a table; a batch that is run again replaces its own part."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_arrivals(spark, path: str, schema: str, files_per_trigger: int = 30) -> DataFrame:
    """Files as they arrive, so many at a time at most."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
