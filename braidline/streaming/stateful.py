"""Ordered state per key, the same for a stream and for a table.

A step function takes the state of a key and one row and returns the new state
and the rows to emit. On a stream, rows wait in the state until the watermark
has passed them and are then handed to the step in time order, so micro-batches
may deliver them in any order. On a table the rows of each partition are sorted
and walked once, with one state in memory.

A key stands for one device or session, whose rate the device itself bounds;
the work of different keys is spread over the cluster, on a stream in GROUPS
groups of keys by their hash.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor

from braidline import session
from braidline.ordered import floor_div

Step = Callable[[Any, dict], tuple[Any, list[dict]]]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def walk_table(
    rows: DataFrame, keys: list[str], order: list[str], step: Step, output: str
) -> DataFrame:
    """Apply ``step`` to the rows of each key in order. ``output`` names the emitted columns.

    Rows reach the step as Python values: longs are exact, missing values are
    None and NaN stays NaN.
    """
    session.ship_package(rows.sparkSession)
    out = T.StructType([*[rows.schema[k] for k in keys], *schema_of(output).fields])
    shape = to_arrow_schema(out)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state = None, None
        for batch in batches:
            emitted = []
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                if key != here:
                    here, state = key, None
                state, found = step(state, row)
                emitted += [{**dict(zip(keys, key)), **r} for r in found]
            yield pa.RecordBatch.from_pylist(emitted, shape)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(walk, out)


GROUPS = 4096  # keys of a stream share this many states


class _Ordered(StatefulProcessor):
    """Keeps the states of a group of keys and, row by row, what still waits for the watermark.

    Every call to the state store costs the same for little or much; a group
    pays for it once for all its keys.
    """

    def __init__(self, keys, time, seq, step, names):
        self._keys, self._time, self._seq = keys, time, seq
        self._step, self._names = step, names

    def init(self, handle) -> None:
        self._handle = handle
        self._cells = handle.getValueState("cells", "blob binary, first long")
        self._waiting = handle.getListState("waiting", "t long, seq long, blob binary")

    def close(self) -> None:
        pass

    def _run(self, fresh, timer_values):
        held = self._cells.get()
        blob, first = held if held is not None else (None, None)
        before = first
        # event times have microseconds; a row beyond the watermark may still be overtaken
        edge_us = timer_values.getCurrentWatermarkInMs() * 1000
        later = [r for r in fresh if r[0] // 1000 > edge_us]
        ready = [r for r in fresh if r[0] // 1000 <= edge_us]
        if first is not None and first // 1000 <= edge_us:
            for row in self._waiting.get():
                (ready if row[0] // 1000 <= edge_us else later).append(tuple(row))
            self._waiting.clear()
            first = None
        if later:
            self._waiting.appendList(later)
            first = min([r[0] for r in later] + ([] if first is None else [first]))
        if ready:
            cells = pickle.loads(blob) if blob is not None else {}
            for _, _, packed in sorted(ready, key=lambda r: r[:2]):
                row = pickle.loads(packed)
                key = tuple(row[k] for k in self._keys)
                cells[key], found = self._step(cells.get(key), row)
                for r in found:
                    values = {**dict(zip(self._keys, key)), **r}
                    yield Row(**{n: values[n] for n in self._names})
            blob = pickle.dumps(cells)
        if ready or first != before:
            self._cells.update((blob, first))
        if first is not None:
            self._handle.registerTimer(-(-first // 1_000_000))

    def handleInputRows(self, key, rows, timerValues):
        fresh = [
            (r[self._time], r[self._seq], pickle.dumps(r.asDict(recursive=True))) for r in rows
        ]
        yield from self._run(fresh, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._run([], timerValues)


def walk_stream(
    rows: DataFrame,
    keys: list[str],
    time: str,
    seq: str,
    step: Step,
    output: str,
    delay: str = "0 seconds",
) -> DataFrame:
    """The streaming form of ``walk_table``; ``time`` is in nanoseconds.

    Rows later than ``delay`` behind the newest time are dropped by the
    watermark, as any stateful stream must do.
    """
    session.ship_package(rows.sparkSession)
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    out = T.StructType([*[rows.schema[k] for k in keys], *schema_of(output).fields])
    timed = rows.withColumn("_event_time", F.timestamp_micros(floor_div(F.col(time), 1000)))
    dealt = timed.withColumn("_group", F.pmod(F.xxhash64(*keys), F.lit(GROUPS)))
    grouped = dealt.withWatermark("_event_time", delay).groupBy("_group")
    return grouped.transformWithState(
        statefulProcessor=_Ordered(keys, time, seq, step, [f.name for f in out]),
        outputStructType=out,
        outputMode="Append",
        timeMode="EventTime",
    )


def read_batches(spark: SparkSession, path: str, schema, files: int = 1) -> DataFrame:
    """A folder of parquet files as a stream of micro-batches of ``files`` files each."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def run_to_table(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a stream over all available input into a file sink and read the result."""
    spark = stream.sparkSession
    out = session.scratch_path(spark, label)
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", out)
        .option("checkpointLocation", session.scratch_path(spark, f"{label}-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_batches(stream: DataFrame, label: str, handle) -> None:
    """Run ``handle(batch, batch_id)`` on every micro-batch of the available input."""
    (
        stream.writeStream.foreachBatch(handle)
        .option(
            "checkpointLocation", session.scratch_path(stream.sparkSession, f"{label}-state")
        )
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
