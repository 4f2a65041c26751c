"""Text scans: JSON lines, CSV streams and demo files."""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidline import ordered, schemas, session
from braidline.functions import coerce, se3


def _columns(schema: str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def parsed_line(line: Column, schema: str) -> Column:
    """The row of a JSON object; null for anything else. Values of another type read as null."""
    is_object = F.try_parse_json(line).isNotNull() & F.ltrim(line).startswith("{")
    return F.when(is_object, F.from_json(line, _columns(schema), {"mode": "PERMISSIVE"}))


def plain_path(path: Column) -> Column:
    """A path with one slash after its scheme; readers write one or three."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def read_stream_jsonl(
    spark: SparkSession, paths: list[str] | str, schema: str
) -> tuple[DataFrame, DataFrame]:
    """JSON lines as (good rows, error rows).

    Blank lines are skipped. A line that is no JSON object becomes an error row
    with its file and text and never stops the scan; a value of another type
    than its column reads as null. ``source_file`` names the file of every row.
    """
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("source_file"))
    parsed = lines.where(F.trim("value") != "").withColumn(
        "_row", parsed_line(F.col("value"), schema)
    )
    good = parsed.where(F.col("_row").isNotNull()).select("_row.*", "source_file")
    bad = parsed.where(F.col("_row").isNull()).select(
        F.lit("normalization_error").alias("row_type"),
        "source_file",
        F.col("value").alias("line"),
        F.lit("malformed_json").alias("error"),
    )
    return good, bad


MOST_BLOCKS = 2_000_000  # blocks of all files whose places are broadcast


def _within_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the number and first byte of each line inside its block; a task reads blocks in order."""
    here, line, byte = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("source_file"), batch.column("_block")
        # where the next block begins
        new = pc.or_(
            pc.not_equal(file.slice(1), file.slice(0, len(file) - 1)),
            pc.not_equal(block.slice(1), block.slice(0, len(block) - 1)),
        ).to_numpy(zero_copy_only=False)
        starts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        size = batch.column("_bytes").to_numpy()
        numbers, bytes_ = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
        for lo, hi in zip(starts, starts[1:]):
            if (run := (file[lo].as_py(), block[lo].as_py())) != here:
                here, line, byte = run, 0, 0
            numbers[lo:hi] = np.arange(line, line + hi - lo)
            ends = byte + np.cumsum(size[lo:hi])
            bytes_[lo:hi] = ends - size[lo:hi]
            line, byte = line + hi - lo, int(ends[-1])
        yield batch.append_column("_line", pa.array(numbers)).append_column("_start", pa.array(bytes_))


def lines_with_places(
    spark: SparkSession, paths: list[str] | str, **options: str | bool
) -> DataFrame:
    """value, source_file, line_number (from 1) and start_byte of every line.

    Lines and bytes are counted for each block that a task reads; only these
    counts, one row for each block, are added up along a file. Lines stay where
    they are read. A line ends at a line feed, so one that ends with a carriage
    return as well counts that byte, and has it in its value.
    """
    session.ship_package(spark)
    read = spark.read.option("lineSep", "\n").options(**options).text(paths)
    raw = read.select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        (F.octet_length("value") + 1).cast("long").alias("_bytes"),
    )
    placed = raw.mapInArrow(
        _within_blocks,
        "value string, source_file string, _block long, _bytes long, _line long, _start long",
    )
    counts = raw.groupBy("source_file", "_block").agg(
        F.count(F.lit(1)).alias("_lines"), F.sum("_bytes").alias("_size")
    )
    return _numbered(spark, placed, counts)


def _numbered(spark: SparkSession, placed: DataFrame, counts: DataFrame) -> DataFrame:
    """Places in files from places in blocks and the lines and bytes of each block.

    Only blocks behind the first one of their file have anything before them.
    """
    counts = session.materialise(spark, counts, "blocks")
    before = Window.partitionBy("source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.select(
        F.col("source_file").alias("_file"),
        F.col("_block").alias("_at"),
        F.sum("_lines").over(before).alias("_lines_before"),
        F.sum("_size").over(before).alias("_bytes_before"),
    ).where("_lines_before IS NOT NULL")
    few = counts.where("_block > 0").count() <= MOST_BLOCKS
    same = (F.col("source_file") == F.col("_file")) & (F.col("_block") == F.col("_at"))
    none = F.lit(0).cast("long")
    return placed.join(F.broadcast(blocks) if few else blocks, same, "left").select(
        "value",
        "source_file",
        (F.coalesce("_lines_before", none) + F.col("_line") + 1).alias("line_number"),
        (F.coalesce("_bytes_before", none) + F.col("_start")).alias("start_byte"),
    )


PACKED_BYTES = 1 << 16  # of a block of a packed file
NO_PATH = "__HIVE_DEFAULT_PARTITION__"  # the file of lines whose path is null, as writers name it


def pack_lines(rows: DataFrame, path: str, order: list[str], line: str) -> DataFrame:
    """The files ``path`` of ``line`` in ``order``, packed: a row (path, start, content) for a block.

    Files by the million take longer to list and open than to read. A block
    holds whole lines, a file as many blocks as it needs; ``start`` is the byte
    of its file that a block begins at.
    """
    sized = rows.select(
        F.coalesce(F.col(path).cast("string"), F.lit(NO_PATH)).alias("path"),
        *order,
        F.coalesce(line, F.lit("")).alias("_line"),
        (F.coalesce(F.octet_length(line), F.lit(0)) + 1).cast("long").alias("_bytes"),
    )
    ended = ordered.scan(sized, ["path"], order, _end=ordered.RunSum("_bytes"))
    first = F.col("_end") - F.col("_bytes")
    lines = F.sort_array(F.collect_list(F.struct(first.alias("at"), F.col("_line").alias("line"))))
    return (
        ended.groupBy("path", ordered.floor_div(first, PACKED_BYTES).alias("_block"))
        .agg(F.min(first).alias("start"), lines.alias("_lines"))
        .select("path", "start", F.concat(F.array_join("_lines.line", "\n"), F.lit("\n")).cast("binary").alias("content"))
    )


def _lines_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each line of packed blocks with its number and first byte inside its block."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("content")), 0).to_numpy())
        # pieces of some megabytes, whatever the number of rows
        cuts = np.flatnonzero(np.diff(size >> 22, prepend=0)).tolist()
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            if lo < hi:
                yield _split(batch.slice(lo, hi - lo))


def _split(batch: pa.RecordBatch) -> pa.RecordBatch:
    lists = pc.split_pattern(batch.column("content"), "\n")
    value, block = lists.flatten(), pc.list_parent_indices(lists)
    n = np.diff(lists.offsets.to_numpy())
    first = np.cumsum(n) - n
    size = pc.binary_length(value).to_numpy().astype(np.int64) + 1
    end = np.cumsum(size)
    parent = block.to_numpy()
    begin = end - size
    # what follows the last line end is a line only if there is something
    last = np.zeros(len(value), bool)
    last[first + n - 1] = True
    use = pa.array(~(last & (size == 1)))
    columns = [
        value,
        batch.column("path").take(block),
        batch.column("start").take(block),
        pa.array(np.arange(len(value)) - first[parent]),
        pa.array(begin - begin[first][parent]),
    ]
    names = ["value", "source_file", "_block", "_line", "_start"]
    return pa.RecordBatch.from_arrays(columns, names).filter(use)


def packed_lines(spark: SparkSession, packed: DataFrame) -> DataFrame:
    """What ``lines_with_places`` gives, of files packed as rows of path, start and content."""
    session.ship_package(spark)
    placed = packed.select("path", "start", "content").mapInArrow(
        _lines_of_blocks,
        "value binary, source_file string, _block long, _line long, _start long",
    )
    content = F.col("content").cast("string")
    ends = F.octet_length(content) - F.octet_length(F.replace(content, F.lit("\n")))
    counts = packed.select(
        F.col("path").alias("source_file"),
        F.col("start").alias("_block"),
        ends.cast("long").alias("_lines"),
        F.octet_length("content").cast("long").alias("_size"),
    )
    return _numbered(spark, placed.withColumn("value", F.col("value").cast("string")), counts)


def error_line_numbers(
    spark: SparkSession, paths: list[str] | str | DataFrame, schema: str
) -> DataFrame:
    """Error rows of JSON lines with the 1-based number of their line; packed files count too."""
    packed = isinstance(paths, DataFrame)
    lines = packed_lines(spark, paths) if packed else lines_with_places(spark, paths)
    wrong = (F.trim(without_return(F.col("value"))) != "") & parsed_line(F.col("value"), schema).isNull()
    return lines.where(wrong).select(
        F.lit("normalization_error").alias("row_type"),
        "source_file",
        "line_number",
        without_return(F.col("value")).alias("line"),
        F.lit("malformed_json").alias("error"),
    )


def without_return(line: Column) -> Column:
    """A line without the carriage return before its line feed."""
    return F.regexp_replace(line, "\\r$", "")


HEADER_BYTES = 1 << 16  # read at once while looking for the end of the first line


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The column names in the first line of each file."""
    for batch in batches:
        paths = batch.column("path").to_pylist()
        names = []
        for path in paths:
            store, place = fs.FileSystem.from_uri(path)
            with store.open_input_stream(place) as stream:
                pieces = [stream.read(HEADER_BYTES)]
                while pieces[-1] and b"\n" not in pieces[-1]:
                    pieces.append(stream.read(HEADER_BYTES))
            line = b"".join(pieces).split(b"\n", 1)[0].decode("utf-8-sig")
            names.append([n.strip() for n in next(csv.reader([line]), [])])
        yield pa.RecordBatch.from_pydict(
            {"path": paths, "names": names},
            pa.schema([("path", pa.string()), ("names", pa.list_(pa.string()))]),
        )


def _read_strings(
    spark: SparkSession, root: str | list[str], pattern: str, columns: list[str]
) -> DataFrame:
    """CSV files as strings, each column found by the header of its own file.

    Files may order columns differently and lack some, which read as null.
    """
    session.ship_package(spark)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    headers = files.select("path").mapInArrow(_first_lines, "path string, names array<string>")
    headers = session.materialise(spark, headers, "headers")
    width = headers.agg(F.max(F.size("names"))).first()[0] or 0
    places = [f"_{i}" for i in range(width)] or ["_0"]
    raw = (
        spark.read.schema(", ".join(f"{p} string" for p in places))
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .csv(root)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )

    same = plain_path(F.col("source_file")) == plain_path(F.col("path"))
    named = raw.join(headers, same)
    values = F.array(*places)
    return named.select(
        *[F.get(values, F.array_position("names", F.lit(c)).cast("int") - 1).alias(c) for c in columns],
        "source_file",
    )


def read_camera_csv(
    spark: SparkSession, root: str | list[str], pattern: str = "frame_timestamps.csv"
) -> DataFrame:
    """Camera timestamp files below ``root``, coerced leniently."""
    raw = _read_strings(spark, root, pattern, schemas.CAMERA_COLUMNS)
    real = ("host_receive_time_s", "realsense_frame_timestamp_ms")
    cols = []
    for c in schemas.CAMERA_COLUMNS:
        if c == "realsense_timestamp_domain":
            cols.append(coerce.text(F.col(c)).alias(c))
        elif c in real:
            cols.append(coerce.to_double(F.col(c)).alias(c))
        else:
            cols.append(coerce.to_long(F.col(c)).alias(c))
    return raw.select(*cols, "source_file")


def read_force_csv(
    spark: SparkSession, root: str | list[str], pattern: str = "*_stream.csv"
) -> DataFrame:
    """Force streams below ``root`` with channels packed into arrays.

    Files without the calibration columns read as null there.
    """
    columns = schemas.FORCE_COLUMNS + schemas.FORCE_CALIBRATION_COLUMNS
    raw = _read_strings(spark, root, pattern, columns)

    def ints(names):
        return F.array(*[coerce.to_long(F.col(n)) for n in names])

    def reals(names):
        return coerce.complete_vector(F.array(*[coerce.to_double(F.col(n)) for n in names]))

    out = [coerce.to_long(F.col(c)).alias(c) for c in schemas.FORCE_COLUMNS[:5]]
    for s in ("left", "right"):
        out.append(ints([f"{s}_c{i}" for i in range(1, 13)]).alias(f"{s}_raw"))
        out.append(reals([f"{s}_zeroed_c{i}" for i in range(1, 13)]).alias(f"{s}_zeroed"))
        out.append(
            reals([f"{s}_{a}" for a in ("fx", "fy", "fz", "mx", "my", "mz")]).alias(f"{s}_wrench")
        )
    return raw.select(
        *out,
        coerce.text(F.col("calibration_status")).alias("calibration_status"),
        coerce.text(F.col("calibration_error")).alias("calibration_error"),
        "source_file",
    )


def committed_prefix(
    rows: DataFrame, commits: DataFrame, session: str, sequence: str = "sequence"
) -> tuple[DataFrame, DataFrame]:
    """Rows up to the durable commit of their session, and sessions shorter than it.

    ``commits`` has session, committed_sequence and frame_count.
    """
    kept = (
        rows.join(commits, session)
        .where(F.col(sequence) <= F.col("committed_sequence"))
        .select(*rows.columns)
    )
    sizes = kept.groupBy(session).agg(F.count(F.lit(1)).alias("rows"))
    short = (
        commits.join(sizes, session, "left")
        .withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))
        .where(F.col("rows") < F.col("frame_count"))
        .select(session, "rows", "frame_count")
    )
    return kept, short


def explode_demo(demos: DataFrame, path: str = "source_file") -> DataFrame:
    """One row per pose of demos stored as column arrays; the side comes from the file name."""
    side = F.regexp_extract(path, r"(left|right)[^/]*$", 1)
    return demos.select(
        path,
        F.nullif(side, F.lit("")).alias("side"),
        F.posexplode(
            # a missing array reads as one of nulls
            F.arrays_zip(
                *[
                    F.coalesce(c, F.array()).alias(c)
                    for c in ("poseTimes", "poseTransforms", "cameraPoses", "poses")
                ]
            )
        ).alias("frame_index", "_p"),
    ).select(
        path,
        "side",
        "frame_index",
        coerce.iso_to_ns(F.col("_p.poseTimes")).alias("t"),
        F.col("_p.cameraPoses").alias("camera_pose"),
        F.col("_p.poseTransforms").alias("transform"),
        F.col("_p.poses").alias("pose6"),
    )


def read_demos(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Demo files, one JSON document each, as one row per pose."""
    demos = (
        spark.read.schema(schemas.DEMO)
        .option("multiLine", True)
        .json(paths)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
    return explode_demo(demos)


def with_demo_pose(rows: DataFrame, name: str = "pose") -> DataFrame:
    """Position and rotation vector from the camera pose, else 4x4, else six numbers."""
    q = F.col("camera_pose.orientation")
    p = F.col("camera_pose.position")
    unit = F.array(*se3.unit_quat([q["w"], q["x"], q["y"], q["z"]]))
    staged = rows.withColumn("_q", F.when(F.col("camera_pose").isNotNull(), unit)).withColumn(
        "_r",
        F.coalesce(
            F.when(
                F.col("_q").isNotNull(),
                se3.pack(se3.unit_quat_to_rotation(se3.items(F.col("_q"), 4))),
            ),
            F.when(
                F.col("transform").isNotNull(),
                se3.pack(se3.rotation_of(se3.cells(F.col("transform"), 4, 4))),
            ),
        ),
    )
    place = F.when(F.col("camera_pose").isNotNull(), F.array(p["x"], p["y"], p["z"])).otherwise(
        F.array(*se3.translation_of(se3.cells(F.col("transform"), 4, 4)))
    )
    turn = F.array(*se3.rotation_to_rotvec(se3.cells(F.col("_r"), 3, 3)))
    six = F.when(F.size("pose6") == 6, F.col("pose6"))
    return staged.withColumn(
        name, F.when(F.col("_r").isNotNull(), F.concat(place, turn)).otherwise(six)
    ).drop("_r", "_q")


def pick_time_column(df: DataFrame, candidates: list[str] | None = None) -> Column:
    """The first of the known timestamp columns the table has."""
    for name in candidates or schemas.TIME_COLUMNS:
        if name in df.columns:
            return F.col(name)
    raise ValueError(f"no timestamp column among {df.columns}")
