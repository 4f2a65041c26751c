"""Applying the force model: raw counts to wrenches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidline import ordered, session

# Layer widths of the force network.
LAYERS = (12, 128, 64, 36, 24, 12, 6)
AXES = ("fx", "fy", "fz", "mx", "my", "mz")


@dataclass(frozen=True)
class ForceModel:
    """Weights and normalisation of one side: a few kilobytes, whatever the data."""

    weights: tuple[np.ndarray, ...]
    biases: tuple[np.ndarray, ...]
    mu_x: np.ndarray
    sd_x: np.ndarray
    mu_y: np.ndarray
    sd_y: np.ndarray
    axis_map: tuple[int, ...] = (0, 1, 2, 3, 4, 5)
    axis_sign: tuple[float, ...] = (1.0,) * 6

    def predict(self, zeroed: np.ndarray) -> np.ndarray:
        """Wrenches of a batch of tared rows, one matrix product per layer."""
        h = (zeroed.astype("float32") - self.mu_x) / self.sd_x
        last = len(self.weights) - 1
        for i, (w, b) in enumerate(zip(self.weights, self.biases)):
            h = h @ w + b
            if i < last:
                h = np.maximum(h, 0.0)
        y = h * self.sd_y + self.mu_y
        return y[:, list(self.axis_map)] * np.asarray(self.axis_sign)


def seeded_model(seed: int, layers: tuple[int, ...] = LAYERS) -> ForceModel:
    """A model with reproducible weights, for tests and demonstrations."""
    rng = np.random.default_rng(seed)
    weights = tuple(
        (rng.standard_normal((a, b)) / np.sqrt(a)).astype("float32")
        for a, b in zip(layers, layers[1:])
    )
    biases = tuple(np.full(b, 0.01, dtype="float32") for b in layers[1:])
    n, m = layers[0], layers[-1]
    return ForceModel(
        weights, biases, np.zeros(n), np.ones(n), np.zeros(m), np.full(m, 2.0)
    )


def predict_wrench(
    rows: DataFrame, side: str, channels: str, models: dict[str, ForceModel], out: str = "wrench"
) -> DataFrame:
    """Add the model's wrench of each row's tared ``channels``; null channels give null. (M1)

    The models travel with the task. Each Arrow batch is scored with one matrix
    product per layer and side.
    """
    session.ship_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(models)
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides, inputs = batch.column(side).to_pylist(), batch.column(channels).to_pylist()
            usable = [c is not None and None not in c for c in inputs]
            result: list[np.ndarray | None] = [None] * len(inputs)
            for name, model in shared.value.items():
                at = [i for i, ok in enumerate(usable) if ok and sides[i] == name]
                if at:
                    found = model.predict(np.array([inputs[i] for i in at], dtype="float64"))
                    for i, wrench in zip(at, found):
                        result[i] = wrench
            yield batch.append_column(out, pa.array(result, pa.list_(pa.float64())))

    return rows.mapInArrow(score, schema)


def calibrated_wrench(
    rows: DataFrame,
    keys: list[str],
    side: str,
    order: list[str],
    channels: list[str],
    models: dict[str, ForceModel],
    tare_samples: int = 300,
    ignored_samples: int = 10,
    window: int = 5,
    bias: dict[str, list[float]] | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Raw counts to wrenches: tare, model, bias, moving average."""
    from braidline.operators import labels

    by = [*keys, side]
    tared = labels.tare_progress(
        rows, by, order, channels, tare_samples, ignored_samples, rows_per_task
    )
    ready = F.col("calibration_status") == "ok"
    packed = tared.withColumn(
        "_zeroed", F.when(ready, F.array(*[F.col(f"{c}_zeroed") for c in channels]))
    ).drop(*[f"{c}_zeroed" for c in channels])
    scored = predict_wrench(packed, side, "_zeroed", models, "_w")
    for i, axis in enumerate(AXES):
        value = F.get("_w", F.lit(i))
        for name, b in (bias or {}).items():
            value = F.when(F.col(side) == name, value - b[i]).otherwise(value)
        scored = scored.withColumn(f"_{axis}", value)
    pieces = ordered.trailing_rows(
        scored.where(F.col("_w").isNotNull()), by, order, window, rows_per_task,
        **{a: ("avg", f"_{a}") for a in AXES},
    )
    waiting = scored.where(F.col("_w").isNull()).select(
        "*", *[F.lit(None).cast("double").alias(a) for a in AXES]
    )
    return pieces.unionByName(waiting).drop("_w", "_zeroed", *[f"_{a}" for a in AXES])
