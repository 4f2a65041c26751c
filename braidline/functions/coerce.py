"""Lenient text coercion, enum decoding, array packing and time conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from braidline.ordered import floor_div

# Recording event codes and camera tracking states.
EVENT_NAMES = {
    1: "force_restart_requested",
    2: "record_start",
    3: "record_stop",
    4: "record_discard",
}
TRACKING_STATES = {0: "unknown", 1: "normal", 2: "limited", 3: "unavailable"}


def text(value: Column) -> Column:
    """Trimmed text, null when blank."""
    return F.nullif(F.trim(value), F.lit(""))


def to_double(value: Column) -> Column:
    """Text to double; blank or junk becomes null."""
    return text(value).try_cast("double")


def to_long(value: Column) -> Column:
    """Text to long with truncation toward zero; blank, junk or non-finite becomes null."""
    exact = text(value).try_cast("decimal(38,9)")
    return F.coalesce(text(value).try_cast("long"), exact.try_cast("long"))


def typed_long(value: Column, is_integer: Column) -> Column:
    """A number that arrived typed counts as an integer only when it was one."""
    return F.when(is_integer, value.try_cast("long"))


def first_truthy(first: Column, second: Column) -> Column:
    """The first timestamp that is neither null nor zero, else the second."""
    return F.coalesce(F.nullif(first, F.lit(0)), second)


def channel_array(prefix: str, count: int = 12) -> Column:
    """``prefix1 .. prefixN`` as one array, nulls kept."""
    return F.array(*[F.col(f"{prefix}{i}") for i in range(1, count + 1)])


def complete_vector(vector: Column) -> Column:
    """The vector, or null as soon as one element is null."""
    return F.when(F.forall(vector, lambda x: x.isNotNull()), vector)


def preferred_wrench(left: Column, right: Column, computed: Column) -> tuple[Column, Column]:
    """Recorded wrench pair when both sides have six values, else the computed one. (P5)

    ``computed`` is a struct with fields left and right. Returns the pair as a
    struct and a label of its origin.
    """
    recorded = (
        (F.size(F.coalesce(left, F.array())) == 6)
        & (F.size(F.coalesce(right, F.array())) == 6)
        & complete_vector(left).isNotNull()
        & complete_vector(right).isNotNull()
    )
    pair = F.when(recorded, F.struct(left.alias("left"), right.alias("right"))).otherwise(computed)
    origin = (
        F.when(recorded, F.lit("recorded"))
        .when(computed.isNotNull(), F.lit("offline_model"))
        .otherwise(F.lit("raw_only"))
    )
    return pair, origin


def decode(code: Column, names: dict[int, str], default: str = "unknown") -> Column:
    """Enum code to name. (P10)"""
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.try_element_at(table, code.cast("int")), F.lit(default))


def ns_to_iso(ns: Column) -> Column:
    """Epoch nanoseconds to ISO-8601 UTC text with microseconds."""
    return F.date_format(
        F.timestamp_micros(floor_div(ns, 1000)),
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    )


def iso_to_ns(value: Column) -> Column:
    """ISO-8601 text to epoch nanoseconds; junk becomes null."""
    return F.unix_micros(F.try_to_timestamp(value)) * F.lit(1000)


def seconds_to_ns(seconds: Column) -> Column:
    """Float seconds to nanoseconds, truncated toward zero."""
    return (seconds * F.lit(1e9)).cast("long")
