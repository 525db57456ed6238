import threading

import pytest
from pyspark.sql import functions as F

from vellum.sources import versions
from vellum.sources.shared_files import create_once, names_in, qualified, read_text, write_text, write_whole
from vellum.sources.store import STORE_SCHEMA, read_store, remove_old_versions, stored_subjects, write_store


def rows(spark, subject, *ids):
    data = [(i, f"text {i}", None, [0.5, float(n)], "m", n, 1, subject) for n, i in enumerate(ids)]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STORE_SCHEMA.fields)
    return spark.createDataFrame(data, f"{fields}, subject string")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_reader_sees_one_version(spark, tmp_path):
    store = str(tmp_path / "store")
    write_store(rows(spark, "a", "1", "2").union(rows(spark, "b", "9")), store)
    reader = read_store(spark, store, "a")
    write_store(rows(spark, "a", "3"), store)                    # a rebuild while the reader is at work
    assert ids(reader) == ["1", "2"] and ids(read_store(spark, store, "a")) == ["3"]
    assert ids(read_store(spark, store)) == ["3", "9"]           # the other subject stays
    assert read_store(spark, store, "b", ["id"]).columns == ["id"]


def test_a_build_that_fails_changes_nothing(spark, tmp_path):
    store = str(tmp_path / "store")
    write_store(rows(spark, "a", "1"), store)
    bad = rows(spark, "a", "2").withColumn("id", F.when(F.col("id") == "2", F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        write_store(bad, store)
    assert ids(read_store(spark, store, "a")) == ["1"]


def test_all_subjects_of_a_build_change_at_once(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    write_store(rows(spark, "a", "1").union(rows(spark, "b", "2")), store)
    number, _ = versions.latest(spark, store)
    write_store(rows(spark, "a", "3").union(rows(spark, "b", "4")), store, subjects=["a", "b"])
    assert versions.latest(spark, store)[0] == number + 1
    assert ids(read_store(spark, store)) == ["3", "4"]


def test_subjects_without_rows_are_refused(spark, tmp_path):
    store = str(tmp_path / "store")
    with pytest.raises(FileNotFoundError, match="x"):
        read_store(spark, store, "x")
    write_store(rows(spark, "a", "1"), store)
    with pytest.raises(FileNotFoundError, match="x"):
        read_store(spark, store, "x")
    write_store(rows(spark, "a", "1").limit(0), store, subjects=["a"])
    for subject in ("a", None):
        with pytest.raises(FileNotFoundError):
            read_store(spark, store, subject)
    assert stored_subjects(spark, store) == []


def test_parts_are_added_and_replayed_once(spark, tmp_path):
    store = str(tmp_path / "store")
    for _ in range(2):
        write_store(rows(spark, "a", "1"), store, part="s-0")
    write_store(rows(spark, "a", "2"), store, part="s-1")
    assert ids(read_store(spark, store, "a")) == ["1", "2"]
    write_store(rows(spark, "a", "7"), store)                    # a whole build replaces all parts
    assert ids(read_store(spark, store, "a")) == ["7"]


def test_odd_subject_names(spark, tmp_path):
    store = str(tmp_path / "store")
    names = ["a b", "50%", "x=y", "ümlaut", "a/b", "q?"]
    for n in names:
        write_store(rows(spark, n, n), store)
    assert stored_subjects(spark, store) == sorted(names)
    for n in names:
        assert [(r.id, r.subject) for r in read_store(spark, store, n).collect()] == [(n, n)]


def test_writers_at_a_time_do_not_undo_each_other(spark, tmp_path):
    root = str(tmp_path / "root")
    threads = [threading.Thread(target=lambda k=k: versions.switch(spark, root, lambda m: {**m, str(k): k})) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    number, manifest = versions.latest(spark, root)
    assert number == 8 and manifest == {str(k): k for k in range(8)}
    for k in range(20):
        versions.switch(spark, root, lambda m, k=k: {"last": k})
    assert versions.latest(spark, root) == (28, {"last": 19})
    assert len([n for n in names_in(spark, f"{root}/_versions") if n.endswith(".json")]) <= versions.KEPT_MANIFESTS


def test_old_versions_are_removed_when_no_manifest_names_them(spark, tmp_path):
    store = str(tmp_path / "store")
    for k in range(versions.KEPT_MANIFESTS + 3):
        write_store(rows(spark, "a", str(k)), store)
    assert remove_old_versions(spark, store) == []               # too young
    assert len(remove_old_versions(spark, store, older_than_seconds=-1)) == 3
    assert ids(read_store(spark, store, "a")) == [str(versions.KEPT_MANIFESTS + 2)]


def test_small_files(spark, tmp_path):
    name = str(tmp_path / "f" / "x.json")
    assert create_once(spark, name, "1") and not create_once(spark, name, "2") and read_text(spark, name) == "1"
    write_text(spark, name, "3 ü")
    assert read_text(spark, name) == "3 ü"
    assert qualified(spark, name) == f"file://{name}"
    write_whole(qualified(spark, str(tmp_path / "g" / "y")), b"z")
    assert names_in(spark, str(tmp_path / "g")) == ["y"] and names_in(spark, str(tmp_path / "none")) == []
