"""Two recorded sessions from raw rows to training rows."""

import math

import pytest
from pyspark.sql import functions as F

from braidline import session
from braidline.plans import normalize, postprocess
from braidline.sources import sinks
from braidline.sources.episodes import EpisodeTable

MS = 1_000_000
SECOND = 1000 * MS
OFFSET = 2_000 * SECOND


def raw(spark, frames=60):
    """Session a is recorded from frame 10 to 50; session b never stops."""
    index, meta, events, sync, camera, force = [], [], [], [], [], []
    for s, session in enumerate(("a", "b")):
        base = s * 100 * SECOND
        for i in range(frames):
            t = base + i * 33 * MS
            index.append(("r", session, i, t, t + OFFSET + 5 * MS, t + 3 * OFFSET, i // 25, i * 100, 100, i % 25 == 0))
            m = [1.0, 0, 0, 0.01 * i, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1]
            meta.append(("r", session, i, t, 1, 1, True, True, 10 <= i <= 50, [float(x) for x in m], True, t, 0, float(i), False))
        for i in range(40):
            phone = base + i * 100 * MS
            sync.append(("r", session, i, phone, phone + OFFSET, 500_000 + i))
        events.append(("r", session, 10, 2, 0))
        if session == "a":
            events.append(("r", session, 50, 3, 1))
    for i in range(90):
        t = OFFSET + i * 25 * MS
        camera.append(("r", "cam", i, None, t, 1000 + i, 1000 + i))
    for i in range(450):
        t = OFFSET + i * 5 * MS
        w = [float(i)] * 6
        force.append(("r", "f", i, t, (i * 5000) % (1 << 32), w, w))
    make = spark.createDataFrame
    return dict(
        index=make(index, """run_id string, session_id string, sequence long, capture_timestamp_ns long,
            host_receive_monotonic_ns long, host_receive_unix_ns long, video_segment int,
            video_byte_offset long, video_annex_b_bytes long, key_frame boolean"""),
        meta=make(meta, """run_id string, session_id string, sequence long, capture_timestamp_ns long,
            tracking_state int, pose_frame int, pose_valid boolean, world_calibrated boolean,
            recording_active boolean, camera_in_user_world_transform array<double>, gripper_valid boolean,
            gripper_timestamp_ns long, gripper_age_ns long, gripper_open_percent double, depth_valid boolean""")
        .withColumn("depth_width", F.lit(0)).withColumn("depth_height", F.lit(0)),
        depth=make([], """run_id string, session_id string, sequence long, byte_offset long, byte_count long,
            width int, height int"""),
        events=make(events, "run_id string, session_id string, sequence long, code int, event_index int"),
        sync=make(sync, """run_id string, session_id string, request_id long, phone_midpoint_ns long,
            host_midpoint_ns long, round_trip_ns long"""),
        camera=make(camera, """run_id string, source_file string, frame_index long, host_receive_time_s double,
            host_receive_monotonic_ns long, color_sensor_timestamp_us long, depth_sensor_timestamp_us long"""),
        force=make(force, """run_id string, source_file string, packet_index long, host_receive_monotonic_ns long,
            teensy_time_us long, left_wrench array<double>, right_wrench array<double>"""),
        offsets=make([("r", "cam", 0)], "run_id string, source_file string, offset_ns long"),
    )


@pytest.fixture(scope="module")
def normal(spark):
    r = {k: session.materialise(spark, v, k) for k, v in raw(spark).items()}
    timed = session.materialise(spark, normalize.phone_timing(r["index"], r["sync"]), "timed")
    frames, bad = normalize.phone_frames(timed, r["meta"], r["depth"])
    assert bad.count() == 0
    out = dict(
        frames=frames,
        events=normalize.phone_events(r["events"], timed),
        camera=normalize.camera_frames(r["camera"], r["offsets"], (480, 640)),
        force=normalize.force_samples(r["force"]),
    )
    return {k: session.materialise(spark, v, k) for k, v in out.items()}


@pytest.fixture(scope="module")
def result(normal):
    return normal["frames"], postprocess.postprocess(**normal)


def test_frames_are_on_the_host_clock(result):
    rows = {(r["session_id"], r["sequence"]): r for r in result[0].collect()}
    assert rows["a", 30]["aligned_ns"] == pytest.approx(30 * 33 * MS + OFFSET, abs=1000)
    assert rows["a", 30]["rgb"]["frame_index"] == 5
    assert rows["a", 30]["pose"]["valid"] and rows["a", 30]["pose"]["frame"] == "user_world"


def test_only_the_closed_session_is_an_episode(result):
    out = result[1]
    ep = out.episodes.collect()
    assert [(e["session_id"], e["episode_index"]) for e in ep] == [("a", 0)]
    assert [r["reason"] for r in out.refused_sessions.collect()] == ["unmatched_events"]


def test_training_rows(result):
    out = result[1]
    rows = out.training.orderBy("sequence").collect()
    assert [r["sequence"] for r in rows] == list(range(10, 51))
    assert rows[0]["action"][0] == pytest.approx(10.0)  # 0.01 m in mm
    assert rows[-1]["action"] == [0.0] * 6
    assert rows[0]["gripper_state"] == 0.0 and rows[-1]["gripper_state"] == 1.0
    want = 330 * MS / (5 * MS)
    assert rows[0]["force"][0][0] == pytest.approx(want, abs=0.01)
    assert out.verdicts.first()["ok"]
    assert all(math.isfinite(x) for r in rows for x in r["pos"])


def test_episode_writes_append_replace_and_fail_whole(spark, tmp_path):
    path = str(tmp_path / "episodes")
    base = spark.range(30).select(
        F.lit("r").alias("run_id"), (F.col("id") % 3).alias("source_episode_index"), F.col("id").alias("v")
    )
    ep = F.col("source_episode_index")
    assert sinks.write_episodes(base.where(ep == 0), path) == 10
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "episodes").rglob("*.parquet")}
    sinks.write_episodes(base.where(ep == 1), path)
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())
    broken = base.where(ep == 2).withColumn("v", F.assert_true(F.lit(False), "stop").cast("long"))
    with pytest.raises(Exception):
        sinks.write_episodes(broken, path)
    table = EpisodeTable(spark, path)
    assert table.read().select("source_episode_index").distinct().count() == 2
    sinks.write_episodes(base.where(ep == 0).withColumn("v", F.col("v") + 100), path)
    back = table.read()
    assert back.where(ep == 0).agg(F.min("v")).first()[0] == 100
    assert back.where(ep == 1).count() == 10
    nothing = base.join(base.where(ep == 9).select("v"), "v").select(*base.columns)
    assert sinks.write_episodes(nothing, path) == 0
    assert sinks.write_stream(nothing, str(tmp_path / "none")) == 0


def test_only_a_commit_changes_what_is_read(spark, tmp_path, monkeypatch):
    """Stop a change between its files, before its commit, and at a commit that came first."""
    base = spark.range(40).select(
        F.lit("01").alias("run_id"), (F.col("id") % 4).alias("source_episode_index"), F.col("id").alias("v")
    )
    ep = F.col("source_episode_index")
    table = EpisodeTable(spark, str(tmp_path / "episodes"))
    assert table.read() is None and table.current() is None
    table.delete(base)
    assert table.write(base) == 40

    def state():
        return sorted(tuple(r) for r in table.read().collect())

    old = state()
    assert old[0] == (0, "01", 0, 0) and table.read().schema["run_id"].dataType.simpleString() == "string"
    changed = base.where(ep < 2).withColumn("v", F.col("v") + 100)
    table.stage(changed)  # files written, then nothing more
    assert state() == old
    with monkeypatch.context() as m:  # the list is written too, but never becomes a commit
        m.setattr(EpisodeTable, "_publish", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError):
            table.write(changed)
    assert state() == old
    publish, lost = EpisodeTable._publish, []

    def beaten(self, number, manifest, schema):
        if not lost:  # another writer takes the number first
            lost.append(number)
            EpisodeTable(spark, self.path).delete(base.where(ep == 3))
        return publish(self, number, manifest, schema)

    monkeypatch.setattr(EpisodeTable, "_publish", beaten)
    table.write(changed)
    assert {e for _, _, e, _ in state()} == {0, 1, 2}  # both changes count
    assert sorted(v for v, _, e, _ in state() if e < 2) == sorted(v + 100 for v in range(40) if v % 4 < 2)
    table.delete(base.where(ep == 1))
    assert {(r["source_episode_index"], r["episode_index"]) for r in table.read().collect()} == {(0, 0), (2, 1)}
    table.delete(base)
    assert table.read().count() == 0 and table.current().number == 4


def test_files_of_a_write_do_not_grow_with_its_episodes(spark, tmp_path):
    """A folder or file for each episode is what a large table cannot list."""
    rows = spark.range(1200).select(
        F.lit("007").alias("run_id"), F.expr("if(id < 3, NULL, id div 3)").alias("source_episode_index"),
        F.col("id").alias("v"),
    )
    table = EpisodeTable(spark, str(tmp_path / "episodes"))
    assert table.write(rows) == 1200
    assert len(list((tmp_path / "episodes" / "data").rglob("*.parquet"))) < 40
    found = sorted(tuple(r) for r in table.read().collect())
    # rows without a key are in no episode that is read
    shift = 1 if table.manifest().where("source_episode_index IS NULL").count() else 0
    assert found == [(v, "007", v // 3, v // 3 - 1 + shift) for v in range(3, 1200)]


def test_delete_renumbers_later_episodes(spark):
    index = spark.createDataFrame([("r", i, i) for i in range(3)], "run string, ep long, episode_index long")
    gone = spark.createDataFrame([("r", 1)], "run string, ep long")
    out = sinks.delete_episodes(index, gone, "run", "ep").orderBy("ep").collect()
    assert [(r["ep"], r["episode_index"]) for r in out] == [(0, 0), (2, 1)]


def test_registry_keeps_the_newest(spark, tmp_path):
    table = str(tmp_path / "registry")
    for path in ("one", "two"):
        sinks.register_artifact(spark, table, "r", "export", "train", path, {"kind": "folder"})
    latest = sinks.latest_artifacts(spark.read.parquet(table)).collect()
    assert [r["path"] for r in latest] == ["two"]


def test_large_keys_give_the_same_training_rows(normal, result):
    out = postprocess.postprocess(**normal, settings=postprocess.Settings(rows_per_task=60))
    key = lambda x: x["sequence"]
    assert sorted(out.training.collect(), key=key) == sorted(result[1].training.collect(), key=key)


def test_ticks_take_the_nearest_frame_and_judge_it(normal):
    """Episode 0 runs from frame 10 to frame 50, 33 ms apart: ticks of 20 ms share frames."""
    settings = postprocess.Settings(target_fps=50, rows_per_task=60)
    out = postprocess.postprocess(**normal, settings=settings)
    rows = out.timeline.orderBy("aligned_ns").collect()
    start = out.episodes.first()["start_ns"]
    assert [r["aligned_ns"] - start for r in rows] == [20 * MS * k for k in range(len(rows))]
    assert len(rows) == (40 * 33) // 20
    for r in rows:
        assert r["frame"]["valid"] and abs(r["frame"]["source_delta_ms"]) <= 16.5 + 1e-3
        assert r["sequence"] == round(10 + (r["aligned_ns"] - start) / (33 * MS))
    verdict = out.verdicts.first()
    assert not verdict["ok"] and "duplicate_targets" in verdict["reasons"]
    strict = postprocess.Settings(target_fps=50, frame_max_ms=10)
    few = postprocess.postprocess(**normal, settings=strict).timeline.collect()
    assert 0 < sum(r["frame"]["valid"] for r in few) < len(few)
    assert all(r["frame"]["valid"] or not r["all_valid"] for r in few)


def _states(out):
    return {(r["run_id"], r["episode_index"]): (r["state"], r["reasons"]) for r in out.states.collect()}


def test_every_gate_refuses_and_the_report_tells(spark, normal, result):
    out = result[1]
    assert _states(out) == {("r", 0): ("complete", "")}
    assert {(r["gate"], r["ok"]) for r in out.gates.collect()} == {(g, True) for g in postprocess.GATES}
    manifest = out.manifest.collect()
    assert [(m["source_episode_index"], m["episode_index"], m["rows_len"]) for m in manifest] == [(0, 0, 41)]
    report = {(r["stage"], r["metric"]): r["value"] for r in out.report.collect()}
    assert report["normalize", "frames"] == 41 and report["align", "timeline_rows"] == 41
    assert report["export", "missing_camera_depth"] == 0 and report["normalize", "events"] == 2

    def refused(settings=postprocess.Settings(), **changed):
        bad = postprocess.postprocess(**{**normal, **changed}, settings=settings)
        assert bad.training.count() == 0 and bad.manifest.count() == 0
        return _states(bad)["r", 0]

    state, reasons = refused(force=normal["force"].where("packet_index < 0"))
    assert state == "input" and reasons == "missing_force"
    state, reasons = refused(force=normal["force"].withColumn("left_wrench", F.lit(None).cast("array<double>")))
    assert state == "normalization" and reasons == "calibrated_samples_missing"
    broken = normal["camera"].withColumn("color_frame_number", F.col("frame_index") * 2)
    assert refused(camera=broken) == ("normalization", "camera_discontinuous")
    late = normal["camera"].where("frame_index % 40 = 0")
    state, reasons = refused(camera=late)
    assert state == "alignment" and "camera_valid_ratio_low" in reasons
    only_phone_depth = postprocess.Settings(media=("phone_image", "phone_depth"))
    assert refused(only_phone_depth) == ("media", "missing_phone_depth_ratio_high")


def test_tasks_of_ticks_follow_the_ticks(spark, monkeypatch):
    from braidline import ordered
    from braidline.plans import alignment

    ep = spark.createDataFrame([(k, 1000 * k, 1000 * k + 500) for k in range(8)], "e long, s long, x long")
    want = [(k, n, 1000 * k + 10 * n) for k in range(8) for n in range(50)]
    monkeypatch.setattr(ordered, "PARTITION_ROWS", 40)
    ticks = alignment.uniform_targets(ep, ["e"], "s", "x", 1e8)
    assert ticks.rdd.getNumPartitions() == 10
    assert sorted(tuple(r) for r in ticks.collect()) == want
