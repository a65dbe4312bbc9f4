"""What queries write under way, against what they return."""

import os

from framewise import queries_io
from framewise.fixtures import table

SF = "/root/testdata/sf0.001"


def test_pose_documents_are_small(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries_io, "new_folder", lambda spark, name: f"{tmp_path}/{name}")
    rows = queries_io.QUERIES["a3_read_camera_json"](spark, SF).count()
    written = sum(os.path.getsize(f"{tmp_path}/poses/{f}") for f in os.listdir(tmp_path / "poses"))
    assert rows == table(spark, SF, "frames").count() and written < 30 * rows
