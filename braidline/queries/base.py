"""Registry of queries over the given tables, each with its SQL where one exists.

The tables stand in for the sensor data: ``events`` per user are streams of a
session (``view`` the target frames, ``click`` the camera, ``purchase`` the
force sensor, ``signup``/``error`` the start and stop events), ``embeddings``
hold channel vectors, wrenches and quaternions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from braidline import session

HOUR = 3_600_000_000_000  # nanoseconds
DAY = 24 * HOUR

REGISTRY: dict[str, "Query"] = {}


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[["Tables"], DataFrame]
    sql: str | None


class Tables:
    """The tables of one scale folder and the stand-in streams made of them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        session.ship_package(spark)
        self._open: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """The table; its file footers are read once."""
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._open[name]

    def events(self, *kinds: str) -> DataFrame:
        """Events with their time in nanoseconds as ``t``."""
        df = self.table("events")
        if kinds:
            df = df.where(F.col("event_type").isin(*kinds))
        return df.select(
            "event_id",
            "user_id",
            "event_type",
            "value",
            "props",
            (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("t"),
        )

    def orders(self) -> DataFrame:
        return self.table("orders").select(
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            "o_totalprice",
            "o_orderpriority",
            (F.unix_micros(F.col("o_orderdate").cast("timestamp")) * 1000).alias("t"),
        )

    def vectors(self) -> DataFrame:
        """Embeddings as double arrays."""
        return self.table("embeddings").select(
            "vec_id", "label", F.col("embedding").cast("array<double>").alias("e")
        )

    def conversations(self) -> DataFrame:
        return self.table("conversations")


# SQL counterparts of the stand-ins
EV = """(SELECT event_id, user_id, event_type, value, props, epoch_us(ts) * 1000 AS t FROM events)"""
ORD = """(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
          epoch_us(o_orderdate) * 1000 AS t FROM orders)"""
VEC = """(SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings)"""


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"query registered twice: {name}")
        REGISTRY[name] = Query(name, fn, sql)
        return fn

    return register


def r6(x: Column | str) -> Column:
    """Rounded to six places, without a negative zero."""
    x = F.col(x) if isinstance(x, str) else x
    return F.rint(x.cast("double") * 1e6) / 1e6 + F.lit(0.0)


def q6(expr: str) -> str:
    return f"(round_even(({expr})::DOUBLE * 1e6::DOUBLE, 0) / 1e6::DOUBLE + 0.0::DOUBLE)"


def r_items(col: Column, n: int, prefix: str) -> list[Column]:
    """Array elements as rounded columns prefix0 .. prefixN-1."""
    return [r6(F.get(col, F.lit(i))).alias(f"{prefix}{i}") for i in range(n)]


def stamp(number: str) -> Column:
    """A nanosecond column with nulls, that must pass every operator unchanged."""
    n = F.col(number)
    return F.when(n % 3 > 0, F.lit(1_700_000_000_123_456_789) + n * 7)


def stamp_sql(number: str) -> str:
    return f"CASE WHEN {number} % 3 > 0 THEN 1700000000123456789 + {number} * 7 END"
