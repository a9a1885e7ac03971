"""Stored pages: ranges, early stop, cursors, the index, and pages that must not be opened."""

import json

import pytest
from eventloom.sources import paged


def put(folder, name, rows, **more):
    (folder / name).write_text(json.dumps({"rows": rows} | more), encoding="utf-8")


def row(n, day, **more):
    return {"title": f"T{n}", "publish_time": f"2024-01-{day:02d} 08:00:00", "url": f"u{n}"} | more


@pytest.fixture()
def pages(tmp_path):
    for n in range(1, 9):  # page n has the days 33 - 4 n and the one before
        put(tmp_path, f"page-{n}.json", [row(n * 2, 33 - 4 * n), row(n * 2 + 1, 32 - 4 * n)])
    return tmp_path


def titles(df):
    return sorted(r.title for r in df.collect())


def test_pages_after_the_range_are_not_opened(spark, pages):
    found = paged.history(spark, f"file://{pages}", "2024-01-16", "2024-01-25", pages_per_partition="5")
    (pages / "page-7.json").write_text("{malformed")  # opened, it would be an error; page 6 begins a partition and ends it
    assert titles(found) == ["T4", "T5", "T6", "T7", "T8", "T9"]
    (pages / "page-4.json").write_text("{malformed")
    with pytest.raises(Exception, match="Expecting"):
        found.collect()


def test_index_spares_all_pages_outside(spark, pages):
    days = [{"page": f"page-{n}.json", "newest": f"2024-01-{33 - 4 * n:02d} 08:00:00", "oldest": f"2024-01-{32 - 4 * n:02d} 08:00:00"} for n in range(1, 9)]
    (pages / "index.json").write_text(json.dumps(days))
    for n in (1, 2, 5, 6, 7, 8):
        (pages / f"page-{n}.json").write_text("{malformed")
    assert titles(paged.history(spark, f"file://{pages}", "2024-01-16", "2024-01-21", pages_per_partition="1")) == ["T6", "T7", "T8", "T9"]


def test_cursors_and_times(spark, tmp_path):
    put(tmp_path, "first", [row(1, 20), {"title": "ms", "time_ms": 1705708800000, "url": "m"}, {"title": "bad", "time_ms": "x"}, {"title": "", "publish_time": "2024-01-20"}, row(1, 20)], next="c2")
    put(tmp_path, "c2", [row(2, 15)], next="c3")
    put(tmp_path, "c3", [row(3, 9)], next="c4")
    (tmp_path / "c4").write_text("{malformed")
    found = paged.history(spark, f"file://{tmp_path}", "2024-01-10", "2024-01-31", cursor="first").collect()
    assert sorted((r.title, r.publish_time[:10]) for r in found) == [("T1", "2024-01-20"), ("T2", "2024-01-15"), ("ms", "2024-01-20")]
    put(tmp_path, "alone", [row(1, 20)], next="not-there")
    assert titles(paged.history(spark, f"file://{tmp_path}", cursor="alone")) == ["T1"]
    assert titles(paged.history(spark, f"file://{tmp_path}", cursor="nothing")) == []
