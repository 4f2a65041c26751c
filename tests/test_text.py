"""Text files with unusual first lines."""

from braidline.sources import text


def test_columns_far_behind_in_the_header_are_found(spark, tmp_path):
    others = [f"other_{'x' * 200}_{k}" for k in range(700)]
    names = [*others[:400], "frame_index", *others[400:], "host_receive_time_s"]
    assert len(",".join(names[:400])) > text.HEADER_BYTES
    values = ["0"] * 400 + ["7"] + ["0"] * 300 + ["1.5"]
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + ",".join(values) + "\n")
    (tmp_path / "b.csv").write_text("frame_index,host_receive_time_s")
    rows = text.read_camera_csv(spark, str(tmp_path), "*.csv").collect()
    assert [(r.frame_index, r.host_receive_time_s) for r in rows] == [(7, 1.5)]
