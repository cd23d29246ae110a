"""Commits become one file while loads run; no reader sees a mark fall."""

from threading import Event, Thread

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from postmill.plans.store import COMMIT_FILES, Store


def test_many_commits_stay_few_files(spark, tmp_path):
    store, stop, seen, wrong = Store(spark, str(tmp_path / "s")), Event(), [], []

    def look() -> None:
        other, last = Store(spark, store.root), {}
        while not stop.is_set():
            now = other.marks()
            wrong.extend((kind, n, now.get(kind)) for kind, n in last.items() if now.get(kind, -1) < n)
            last = now
            seen.append(len(now))

    reader = Thread(target=look)
    reader.start()
    try:
        for number in range(1, 2 * COMMIT_FILES + 6):
            with store.writing():
                store.publish({"stage": number, **({"merged": number} if number % 5 == 0 else {})})
            assert len(store._commit_files()) <= COMMIT_FILES
    finally:
        stop.set()
        reader.join(120)
    assert seen and not wrong
    assert store.marks() == {"stage": 2 * COMMIT_FILES + 5, "merged": 2 * COMMIT_FILES + 5 - (2 * COMMIT_FILES + 5) % 5}


def test_commit_that_comes_during_a_fold_is_kept(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    for number in range(1, COMMIT_FILES + 1):
        store._append_marks({"stage": number})
    append = store._append_marks

    def late(marks: dict[str, int]) -> None:
        if len(marks) > 1 or marks.get("stage", 0) > COMMIT_FILES:  # what the fold writes
            Store(spark, store.root)._append_marks({"stage": 99})
        append(marks)

    append({"main": 7})
    monkeypatch.setattr(store, "_append_marks", late)
    store._fold_commits()
    assert store.marks() == {"stage": 99, "main": 7}
    assert len(store._commit_files()) == 2


def test_fold_that_was_cut_short_changes_nothing(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    for number in range(1, COMMIT_FILES + 2):
        store._append_marks({"stage": number, "main": 1})
    before = store.marks()

    def stopped(path: str) -> None:
        raise OSError(path)

    monkeypatch.setattr(store, "remove", stopped)
    with pytest.raises(OSError):
        store._fold_commits()
    monkeypatch.undo()
    assert store.marks() == before
    store.publish({"stage": 50})
    assert store.marks() == {**before, "stage": 50} and len(store._commit_files()) == 1


def test_reader_looks_again_when_files_have_become_one(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    store._append_marks({"stage": 1})
    store._append_marks({"stage": 2})
    old = store._commit_files()
    store._append_marks({"stage": 2})
    store.remove(f"commits/{old[0]}")
    store.remove(f"commits/{old[1]}")
    listings = iter([old])
    true_listing = Store._commit_files
    monkeypatch.setattr(store, "_commit_files", lambda: next(listings, None) or true_listing(store))
    assert store.marks() == {"stage": 2}


def test_errors_that_are_not_missing_files_are_raised(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store._append_marks({"stage": 1})
    (tmp_path / "s" / "commits" / "broken.parquet").write_text("not parquet")
    with pytest.raises((PySparkException, Py4JJavaError)):
        store.marks()
