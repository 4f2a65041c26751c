"""The shared folder and the sources' error handling."""

import numpy as np
import pytest

from braidline import session
from braidline.plans import formats
from braidline.sources import discovery, text


class Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"


def test_a_cluster_must_name_a_shared_folder():
    with pytest.raises(RuntimeError):
        session.shared_dir(Cluster)


def test_shared_folder_comes_from_the_session(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_configs_merge_at_every_level():
    base = {"a": 1, "b": {"c": 2, "d": {"e": 3}}}
    out = formats.merge_config(base, {"b": {"d": {"f": 4}}, "g": 5})
    assert out == {"a": 1, "b": {"c": 2, "d": {"e": 3, "f": 4}}, "g": 5}
    assert base == {"a": 1, "b": {"c": 2, "d": {"e": 3}}}


def test_formats_refuse_duplicates_and_unknown_names():
    known = formats.Formats()
    known.add(formats.Format("x", lambda df, c: df))
    with pytest.raises(ValueError):
        known.add(formats.Format("x", lambda df, c: df))
    with pytest.raises(KeyError):
        known.build("y", None)


def test_bad_lines_have_file_and_number(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\n{"a": \n{"a": 2}\n{"a": \n')
    (tmp_path / "b.jsonl").write_text('{"a": 3}\n')
    good, bad = text.read_stream_jsonl(spark, str(tmp_path), "a long")
    assert sorted(r["a"] for r in good.collect()) == [1, 2, 3]
    assert bad.count() == 2
    numbered = text.error_line_numbers(spark, str(tmp_path), "a long").collect()
    assert sorted(r["line_number"] for r in numbered) == [3, 5]
    assert all(r["source_file"].endswith("a.jsonl") for r in numbered)


def test_places_in_files_of_many_blocks_and_both_line_ends(spark, tmp_path):
    """Blocks far smaller than a file, lines longer than a block, no line end at the end."""
    rng = np.random.default_rng(3)
    want = {}
    for name, end in (("a", b"\n"), ("b", b"\r\n"), ("c", b"\n")):
        lines = ["é" * int(n) for n in rng.integers(0, 40, 300)] + ["x" * 3000, "", "y"]
        data = end.join(line.encode() for line in lines) + (b"" if name == "c" else end)
        (tmp_path / f"{name}.txt").write_bytes(data)
        at = 0
        for number, line in enumerate(lines, 1):
            want[f"{name}.txt", number] = (line, at)
            at += len(line.encode()) + len(end)
    (tmp_path / "empty.txt").write_bytes(b"")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        lines = text.lines_with_places(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 10
        rows = lines.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {
        (r["source_file"].rsplit("/", 1)[1], r["line_number"]): (r["value"].removesuffix("\r"), r["start_byte"])
        for r in rows
    }
    assert got == want and len(rows) == len(want)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Window" in plan


def test_episodes_are_found_from_real_files(spark, tmp_path):
    for run, ep in (("r1", 3), ("r1", 7), ("r2", 0)):
        d = tmp_path / run / "raw" / "force" / f"episode_{ep:06d}"
        d.mkdir(parents=True)
        (d / "raw_stream.csv").write_text("x")
    files = discovery.list_files(spark, str(tmp_path))
    got = {(r["run_id"], r["source_episode_index"]) for r in discovery.discover_episodes(files).collect()}
    assert got == {("r1", 3), ("r1", 7), ("r2", 0)}


def test_missing_time_column_is_an_error(spark):
    with pytest.raises(ValueError):
        text.pick_time_column(spark.range(1))


def test_packet_logs_are_read_by_ranges_of_whole_packets(spark, tmp_path):
    """Ranges smaller than a log, a torn last packet, a wrong header, an empty and a hidden file."""
    from braidline.sources import binary

    packets = np.zeros(25, binary.PACKET)
    packets["sequence"] = np.arange(25) + 2**32 - 10 & 0xFFFFFFFF
    packets["left"] = np.arange(25)[:, None] + np.arange(12)
    raw = bytearray(packets.tobytes())
    raw[7 * binary.PACKET_BYTES] = 9
    folder = tmp_path / "logs"
    folder.mkdir()
    (folder / "a.bin").write_bytes(bytes(raw) + b"torn")
    (folder / "b.bin").write_bytes(packets[:3].tobytes())
    (folder / "c.bin").write_bytes(b"")
    (folder / "_d.bin").write_bytes(b"hidden")
    rows = binary.read_packets(spark, str(folder), packetsPerTask=4, packetsAtOnce=3).collect()
    assert len(rows) == 25 + 1 + 3
    assert sorted(r["error"] for r in rows if r["error"]) == ["incomplete packet", "packet header mismatch"]
    whole = [r for r in rows if r["error"] is None and r["path"].endswith("a.bin")]
    assert sorted(r["sequence_id"] for r in whole) == sorted(
        int(s) for i, s in enumerate(packets["sequence"]) if i != 7
    )
    assert all(r["left_raw"] == [r["left_raw"][0] + k for k in range(12)] for r in whole)
    assert all(r["left_raw"] is None and r["sequence_id"] is None for r in rows if r["error"])
    one = binary.read_packets(spark, f"{folder}/b.bin,file://{folder}/c.bin")
    assert one.count() == 3


def _files(path):
    """The files below a folder, packed as one row each."""
    return [(str(f), 0, f.stat().st_size, f.read_bytes()) for f in sorted(path.rglob("*.*"))]


def test_packed_files_have_the_places_of_files(spark, tmp_path):
    """Blank lines, both line ends, no line end at the end, an empty file, more rows than a batch."""
    (tmp_path / "a.txt").write_bytes(b"x\r\n\r\n\n" + "éé".encode() + b"\ny")
    (tmp_path / "b.txt").write_bytes(b"\n")
    (tmp_path / "c.txt").write_bytes(b"")
    (tmp_path / "d.txt").write_bytes(b"".join(b"%d\n" % k for k in range(20_000)))
    packed = spark.createDataFrame(_files(tmp_path), "path string, start long, length long, content binary")

    def places(df):
        return sorted(
            (r["source_file"].rsplit("/", 1)[1], r["line_number"], r["start_byte"], r["value"]) for r in df.collect()
        )

    assert places(text.packed_lines(spark, packed)) == places(text.lines_with_places(spark, str(tmp_path)))


def test_packed_lines_of_a_file_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(text, "PACKED_BYTES", 50)
    rows = [(k % 3 or None, k, None if k == 12 else "é" * (k % 40)) for k in range(600)]
    lines = spark.createDataFrame(rows, "f long, k long, line string").repartition(5)
    packed = session.materialise(spark, text.pack_lines(lines, "f", ["k"], "line"))
    assert packed.count() > 100
    want = []
    for f in (None, 1, 2):
        at = 0
        for number, line in enumerate((x or "" for g, _, x in rows if g == f), 1):
            want.append((str(f or text.NO_PATH), number, at, line))
            at += len(line.encode()) + 1
    found = text.packed_lines(spark, packed)
    assert sorted((r["source_file"], r["line_number"], r["start_byte"], r["value"]) for r in found.collect()) == sorted(want)


def test_sessions_of_one_line_commit_nothing(spark, tables):
    """Such a session has a marker of no frames; packed files give what folders give."""
    from braidline.queries import io
    from braidline.queries.base import Tables

    class Few(Tables):
        def events(self, *kinds):
            return spark.createDataFrame(
                [(k, u, 1000 * k) for k, u in enumerate([3, 5, 6, 3, 3, 5, 7, 7, 7, 7, None])],
                "event_id long, user_id long, t long",
            )

    rows, errors = io._archive(Few(spark, tables.folder))
    assert sorted((r["session"], r["sequence"]) for r in rows.collect()) == [(7, 6), (7, 7), (7, 8)]
    assert sorted((r["session"], r["error"]) for r in errors.collect()) == [
        (3, "shorter_than_commit"), (5, "invalid_checksum"),
    ]


def test_folders_and_packed_files_commit_alike(spark, tmp_path):
    import pandas as pd

    from braidline.queries import io
    from braidline.sources import archive

    lines = [f'{{"sequence": {k}}}' for k in range(9)]
    made = next(io._session_files([pd.DataFrame({"session": [2, 3, 5, 8], "lines": [lines, lines, lines, lines[:1]]})]))
    made["path"] = [f"{tmp_path}/{p}" for p in made["path"]]
    for r in made.itertuples():
        (tmp_path / "sessions" / r.path.split("/")[-2]).mkdir(parents=True, exist_ok=True)
        with open(r.path, "wb") as out:
            out.write(r.content)
    packed = spark.createDataFrame([tuple(r) for r in made.itertuples(index=False)], io.PACKED_FILES)

    def found(root):
        both = archive.committed_lines(spark, root, "frame_index.jsonl", "sequence long", "frame_index_size")
        return [sorted((r[0].rsplit("/", 1)[1], r[1]) for r in x.collect()) for x in both]

    assert found(packed) == found(str(tmp_path))
    assert found(packed)[0] == [("2", k) for k in range(6)]
