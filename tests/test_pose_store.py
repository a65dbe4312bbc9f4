"""Two-phase writing of pose documents: status, refusal, killed tasks and writers, restoring."""

import json
import os

import pytest

from framewise.sources import pose_store as store

PAYLOAD = "prefix string, content string, source_hash string, current_hash string, extra int"


def payloads(spark, *rows):
    return spark.createDataFrame([(*r, "h", "h", 1) if len(r) == 2 else (*r, 1) for r in rows], PAYLOAD)


def documents(spark, root, version=None):
    return {(r.prefix, r.suffix): r.content for r in store.read_documents(spark, root, version).collect()}


def statuses(status):
    return {(r.prefix, r.suffix): r.status for r in status.collect()}


def test_status_refusal_and_versions(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    assert store.manifest(spark, root).count() == 0 and store.versions(spark, root) == []
    status, version = store.write_pose_pairs(payloads(spark, ("a", '{"x": 1, "y": [2.5]}'), ("b", "{}"), ("b", "{}")), root)
    assert version == 1 and set(statuses(status).values()) == {"written"} and len(statuses(status)) == 4
    first = documents(spark, root)
    assert first["a", "GT"] == first["a", "occ"] == '{"x": 1, "y": [2.5]}'

    same = payloads(spark, ("a", '{ "y": [2.50], "x": 1.0 }'))
    status, version = store.write_pose_pairs(same, root)
    assert version == 1 and set(statuses(status).values()) == {"unchanged"} and documents(spark, root) == first

    other = payloads(spark, ("a", '{"x": 2}'), ("c", "[]"))
    status, version = store.write_pose_pairs(other, root)
    assert version is None and statuses(status) == {("a", "GT"): "conflict", ("a", "occ"): "conflict", ("c", "GT"): "written", ("c", "occ"): "written"}
    assert documents(spark, root) == first and store.versions(spark, root) == [1]
    assert store.write_pose_pairs(other, root, overwrite=True)[1] == 2
    now = documents(spark, root)
    assert now == first | {("a", s): '{"x": 2}' for s in store.SUFFIXES} | {("c", s): "[]" for s in store.SUFFIXES}
    assert documents(spark, root, 1) == first
    assert store.restore(spark, root, 1) == 3 and documents(spark, root) == first
    assert store.abandoned(spark, root).count() == 0


@pytest.mark.parametrize("row, want", [
    (("a", None), "invalid"), (("a", "{"), "invalid"), (("a", '{"x": NaN}'), "invalid"), (("a", '{"x": 1e999}'), "invalid"), ((None, "{}"), "invalid"), (("a", ""), "invalid"),
    (("a", "{}", "h", "g"), "source_changed"), (("a", "{}", "h", None), "source_changed"), (("a", "{}", None, None), "written"), (("a", "[" * 100_000), "invalid"),
])
def test_odd_payloads(spark, tmp_path, row, want):
    status, version = store.write_pose_pairs(payloads(spark, row, ("fine", "{}")), f"file://{tmp_path}/store", overwrite=True)
    assert {v for k, v in statuses(status).items() if k[0] != "fine"} == {want}
    assert version == (1 if want == "written" else None)


def test_different_payloads_of_a_prefix(spark, tmp_path):
    status, version = store.write_pose_pairs(payloads(spark, ("a", "{}"), ("a", "[]")), f"file://{tmp_path}/store", overwrite=True)
    assert set(statuses(status).values()) == {"ambiguous"} and version is None
    status, version = store.write_pose_pairs(payloads(spark).limit(0), f"file://{tmp_path}/store")
    assert status.count() == 0 and version == 0


def test_changed_lost_and_broken_files(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    store.write_pose_pairs(payloads(spark, *((k, "{}") for k in "abc")), root)
    paths = {(r.prefix, r.suffix): f"{tmp_path}/store/{r.path}" for r in store.manifest(spark, root).collect()}
    with open(paths["a", "occ"], "w") as f:
        f.write("{broken")
    os.rename(paths["b", "GT"], f"{tmp_path}/elsewhere")
    assert documents(spark, root)["b", "GT"] is None
    status = statuses(store.write_pose_pairs(payloads(spark, *((k, "{}") for k in "abc")), root)[0])
    assert [k for k, v in status.items() if v == "conflict"] == [("a", "occ")] and [k for k, v in status.items() if v == "written"] == [("b", "GT")]
    assert store.write_pose_pairs(payloads(spark, *((k, "{}") for k in "abc")), root, overwrite=True)[1] == 2
    assert set(documents(spark, root).values()) == {"{}"} and len(documents(spark, root)) == 6


def test_a_killed_task_leaves_no_half_pair(spark, tmp_path):
    root, flag = f"file://{tmp_path}/store", str(tmp_path / "killed")
    store.write_pose_pairs(payloads(spark, *((f"p{k}", '{"v": 0}') for k in range(30))), root)
    before = documents(spark, root)
    after = payloads(spark, *((f"p{k}", json.dumps({"v": k + 1})) for k in range(40)))

    def dies(where, path, data):
        """The worker goes in the middle of a document of its fifth pair."""
        with where.open_output_stream(path) as f:
            f.write(data[:3])
            if data == b'{"v": 20}' and not os.path.exists(flag):
                open(flag, "w").close()
                os._exit(1)
            f.write(data[3:])

    with pytest.raises(Exception):
        store.write_pose_pairs(after, root, overwrite=True, write=dies)
    assert os.path.exists(flag) and documents(spark, root) == before and store.versions(spark, root) == [1]
    assert store.abandoned(spark, root).count() > 0
    assert store.write_pose_pairs(after, root, overwrite=True, write=dies)[1] == 2
    now = documents(spark, root)
    assert all(now[f"p{k}", s] == json.dumps({"v": k + 1}) for k in range(40) for s in store.SUFFIXES) and len(now) == 80


def test_a_killed_writer_and_two_writers(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    store.write_pose_pairs(payloads(spark, ("a", "{}")), root)
    assert store._claim(spark, root, False) == 2  # a writer at work, or one that died
    with pytest.raises(RuntimeError):
        store.write_pose_pairs(payloads(spark, ("b", "{}")), root)
    assert store.write_pose_pairs(payloads(spark, ("b", "{}")), root, take_over=True)[1] == 3
    assert store.versions(spark, root) == [1, 3] and len(documents(spark, root)) == 4
    with pytest.raises(ValueError):
        store.restore(spark, root, 2)
    assert store.write_pose_pairs(payloads(spark, ("c", "{}")), root)[1] == 4  # the failed call left no claim
