"""Binary scans: fixed-length sensor packets and depth images."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from braidline import ordered, session

# The packet layout of the force sensors (little endian).
PACKET_BYTES = 58
PACKET = np.dtype(
    [("header", "V2"), ("sequence", "<u4"), ("time_us", "<u4"), ("left", "<u2", 12), ("right", "<u2", 12)]
)
DEPTH_CLIP_M = 0.5
DEPTH_RESAMPLE_MAX_M = 10.0
DEPTH_VALID_M = (0.05, 8.0)
SLICE_BYTES = 256 << 20
PACKETS_AT_ONCE = 8192
PACKETS_PER_TASK = 2_000_000

PACKET_COLUMNS = ["sequence_id", "device_time_us", "left_raw", "right_raw", "error", "path"]
PACKET_SCHEMA = "sequence_id long, device_time_us long, left_raw array<long>, right_raw array<long>, error string, path string"


@dataclass(frozen=True)
class PacketRange(InputPartition):
    """Consecutive whole packets of one log; ``tail`` bytes after the last one are left over."""

    path: str
    first: int
    count: int
    tail: int = 0


class PacketReader(DataSourceReader):
    """Plans ranges of whole packets and decodes each in batches."""

    def __init__(self, options: dict):
        self.paths = options["path"].split(",")
        self.most = max(1, int(options.get("packetsPerTask", PACKETS_PER_TASK)))
        self.at_once = max(1, int(options.get("packetsAtOnce", PACKETS_AT_ONCE)))

    def partitions(self) -> list[PacketRange]:
        found = []
        for path in self.paths:
            fs, inner = pafs.FileSystem.from_uri(uri_of(path))
            place = fs.get_file_info(inner)
            if place.type == pafs.FileType.Directory:
                files = fs.get_file_info(pafs.FileSelector(inner))
            elif place.type == pafs.FileType.File:
                files = [place]
            else:
                raise FileNotFoundError(path)
            prefix = uri_of(path)[: -len(inner)] if uri_of(path).endswith(inner) else uri_of(path).removesuffix("/")
            for file in sorted(files, key=lambda f: f.path):
                # names that Spark hides hold no data either
                if file.type != pafs.FileType.File or file.base_name.startswith(("_", ".")):
                    continue
                whole, tail = divmod(file.size, PACKET_BYTES)
                name = prefix + file.path
                starts = range(0, whole, self.most)
                found += [PacketRange(name, at, min(self.most, whole - at)) for at in starts]
                if tail:
                    found.append(PacketRange(name, whole, 0, tail))
        return found or [PacketRange("", 0, 0)]

    def read(self, part: PacketRange) -> Iterator[pa.RecordBatch]:
        if part.tail:
            yield _packet_batch(np.zeros(0, PACKET), part.path, ["incomplete packet"])
        if not part.count:
            return
        fs, inner = pafs.FileSystem.from_uri(part.path)
        with fs.open_input_file(inner) as log:
            for at in range(part.first, part.first + part.count, self.at_once):
                n = min(self.at_once, part.first + part.count - at)
                raw = log.read_at(n * PACKET_BYTES, at * PACKET_BYTES)
                yield _packet_batch(np.frombuffer(raw, PACKET), part.path, [])


def uri_of(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def _packet_batch(packets: np.ndarray, path: str, more: list[str]) -> pa.RecordBatch:
    """Packets as columns; wrong headers and ``more`` become error rows."""
    n, size = len(packets), len(packets) + len(more)
    whole = np.zeros(size, bool)
    whole[:n] = packets["header"] == np.void(b"\x00\x00")

    def numbers(column: str) -> pa.Array:
        values = np.zeros(size, np.int64)
        values[:n] = packets[column]
        return pa.array(values, mask=~whole)

    def channels(column: str) -> pa.Array:
        # a null list has no items
        items = pa.array(packets[column][whole[:n]].astype(np.int64).ravel())
        offsets = np.concatenate([[0], np.cumsum(np.where(whole, 12, 0))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(~whole, False)), items)

    errors = np.full(size, "packet header mismatch", object)
    errors[n:] = more
    columns = [
        numbers("sequence"),
        numbers("time_us"),
        channels("left"),
        channels("right"),
        pa.array(errors, pa.string(), mask=whole),
        pa.array([path] * size, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, PACKET_COLUMNS)


class PacketSource(DataSource):
    """``spark.read.format("force_packets").load(path)``: packet logs of the force sensors.

    ``path`` is a log, a folder of logs, or several of them with commas between.
    Options: packetsPerTask, packetsAtOnce.
    """

    @classmethod
    def name(cls) -> str:
        return "force_packets"

    def schema(self) -> str:
        return PACKET_SCHEMA

    def reader(self, schema: T.StructType) -> PacketReader:
        return PacketReader(self.options)


def read_packets(spark: SparkSession, path: str, **options: int) -> DataFrame:
    """Packet logs as rows; a packet with a wrong header, or a torn one, becomes an error row.

    Only file sizes are looked at for planning. A log of any size is read in
    ranges, and a range as Arrow batches, without a Python object per packet.
    """
    session.ship_package(spark)
    spark.dataSource.register(PacketSource)
    return spark.read.format("force_packets").options(**options).load(path)


def _resized(image: np.ndarray, size: tuple[int, int], centred: bool) -> np.ndarray:
    """Nearest-neighbour resize to (width, height)."""
    shift = 0.5 if centred else 0.0
    h, w = image.shape
    ys = np.minimum(((np.arange(size[1]) + shift) * h / size[1]).astype(int), h - 1)
    xs = np.minimum(((np.arange(size[0]) + shift) * w / size[0]).astype(int), w - 1)
    return image[ys][:, xs]


def _images(rows: list[dict]) -> Iterator[tuple[dict, np.ndarray | None]]:
    """The image of each index row: rows are sorted, so each file is opened once per batch."""
    for path, part in groupby(rows, key=lambda r: r["path"]):
        try:
            fs, inner = pafs.FileSystem.from_uri(path)
            handle = fs.open_input_file(inner)
        except (OSError, TypeError, ValueError):
            yield from ((row, None) for row in part)
            continue
        with handle:
            for row in part:
                item, (h, w) = np.dtype(row["dtype"]), (row["height"] or 0, row["width"] or 0)
                want, offset = h * w * item.itemsize, row["byte_offset"]
                valid = offset is not None and offset >= 0 and row["byte_count"] == want
                raw = handle.read_at(want, offset) if valid else b""
                if len(raw) != want or not want:
                    yield row, None
                else:
                    yield row, np.frombuffer(raw, item).reshape(h, w).astype("float32")


def _per_image(index: DataFrame, keys: list[str], columns: str, measure) -> DataFrame:
    """``measure(row, image)`` of every index row, as columns beside its keys.

    Keys stay in the Arrow batch they came in.
    """
    names = [f.name for f in index.schema if f.name in keys]
    added = T.StructType.fromDDL(columns)
    schema = T.StructType([*[index.schema[n] for n in names], *added.fields])
    shape = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(row, image) for row, image in _images(batch.to_pylist())]
            values = pa.RecordBatch.from_pylist(found, shape)
            kept = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(kept + values.columns, [*names, *shape.names])

    return _by_slice(index).mapInArrow(run, schema)


def _by_slice(index: DataFrame) -> DataFrame:
    """Bring neighbouring images together; a large file is shared out in slices."""
    session.ship_package(index.sparkSession)
    part = ordered.floor_div(F.coalesce("byte_offset", F.lit(0).cast("long")), SLICE_BYTES)
    return (
        index.withColumn("_slice", part)
        .repartition("path", "_slice")
        .sortWithinPartitions("path", "byte_offset")
        .drop("_slice")
    )


def decode_depth(
    index: DataFrame, keys: list[str], size: tuple[int, int], clip_m: float = DEPTH_CLIP_M
) -> DataFrame:
    """Depth images in metres, clipped and resized; null when the bytes are not there.

    ``index`` has path, byte_offset, byte_count, width, height, dtype and unit_m
    (metres per count). Tasks read only the byte ranges they need.
    """

    def decode(row: dict, image: np.ndarray | None) -> dict:
        if image is None:
            return {}
        metres = np.clip(image * np.float32(row["unit_m"]), 0.0, clip_m)
        return dict(depth=_resized(metres, size, centred=False).ravel())

    return _per_image(index, keys, "depth array<float>", decode)


STATS_SCHEMA = """readable boolean, pixels long, min_m double, max_m double, sum_m double,
    nonzero long, center_m double, valid_ratio double"""


def _stats(image: np.ndarray | None) -> dict:
    if image is None:
        return dict(readable=False)
    low, high = DEPTH_VALID_M
    ok = np.isfinite(image) & (image > low) & (image < high)
    h, w = image.shape
    cy, cx = h // 2, w // 2
    near = (slice(max(0, cy - 2), cy + 3), slice(max(0, cx - 2), cx + 3))
    centre = image[near][ok[near]]
    step = max(1, min(h, w) // 48)
    return dict(
        readable=True,
        pixels=image.size,
        min_m=float(image.min()),
        max_m=float(image.max()),
        sum_m=float(image.sum(dtype="float64")),
        nonzero=int((image > 0).sum()),
        center_m=float(centre.mean(dtype="float64")) if len(centre) else None,
        valid_ratio=float(ok[::step, ::step].mean()),
    )


def depth_frame_stats(index: DataFrame, keys: list[str]) -> DataFrame:
    """One row of statistics per depth image: range, centre depth, share of valid pixels."""
    return _per_image(
        index,
        keys,
        STATS_SCHEMA,
        lambda row, image: _stats(None if image is None else image * row["unit_m"]),
    )


def depth_stats(frames: DataFrame, keys: list[str]) -> DataFrame:
    """Frames, range, mean and share of non-zero pixels from per-image statistics."""
    ok = frames.where("readable")
    return ok.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frames"),
        F.min("min_m").alias("min_m"),
        F.max("max_m").alias("max_m"),
        (F.sum("sum_m") / F.sum("pixels")).alias("mean_m"),
        (F.sum("nonzero") / F.sum("pixels")).alias("nonzero_ratio"),
    )


def resample_depth(index: DataFrame, keys: list[str], size: tuple[int, int]) -> DataFrame:
    """Depth on a fixed grid with its count of valid pixels: 0 < d, at most 10 m."""

    def resample(row: dict, image: np.ndarray | None) -> dict:
        if image is None:
            return dict(valid_pixels=0)
        grid = _resized(image * np.float32(row["unit_m"]), size, centred=True)
        good = np.isfinite(grid) & (grid > 0)
        grid = np.where(good, np.minimum(grid, DEPTH_RESAMPLE_MAX_M), 0.0)
        return dict(depth=grid.astype("float32").ravel(), valid_pixels=int(good.sum()))

    return _per_image(index, keys, "depth array<float>, valid_pixels long", resample)


def confidence_histogram(frames: DataFrame, keys: list[str], levels: str, top: int = 2) -> DataFrame:
    """Pixels per confidence level; higher levels count as the top one."""
    return (
        frames.select(*keys, F.explode(levels).alias("_c"))
        .groupBy(*keys, F.least(F.col("_c").cast("int"), F.lit(top)).alias("confidence"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
