"""The job over a growing folder."""

import pytest
from test_ingest import FEEDS, HEAD, Job, put

from feedwell import Totals, ingest_arrivals
from feedwell.plans import arrivals


@pytest.fixture()
def job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    return Job(spark, tmp_path / "in")


def start(job, tmp_path, **how):
    seen = []
    batches = ingest_arrivals(
        job.spark, str(job.folder), FEEDS, job.current, job.history, job.rejects, str(tmp_path / "checkpoint"),
        done=lambda batch, totals: seen.append(totals), **how)
    assert batches == len(seen)
    return seen


def counts(job):
    log = job.spark.table(job.history).collect()
    return sorted((r.feed, r.filename, r.flagged_line_count) for r in log)


def test_each_file_is_loaded_once(job, tmp_path):
    put(job.folder, "north_1.xlsx", 0, [["a", 1, "y"]])
    put(job.folder, "south_1.xlsx", 1, [["b", 1, "y"], ["c", 1, "y"]])
    put(job.folder, "ignored.txt", 2, b"x")
    assert start(job, tmp_path) == [Totals(2, 0, 3, 3, 3)]
    assert start(job, tmp_path) == []
    put(job.folder, "north_2.xlsx", 3, [["d", 1, None]])
    put(job.folder, "west_1.xlsx", 4, b"junk")
    assert start(job, tmp_path) == [Totals(1, 1, 1, 1, 0)]
    assert [r[0] for r in job.rows()] == ["b", "c", "d"]  # the south's rows stay
    assert counts(job) == [("north", "north_1.xlsx", 1), ("north", "north_2.xlsx", 0), ("south", "south_1.xlsx", 2)]


def test_a_batch_that_is_repeated_appends_nothing(job, tmp_path, monkeypatch):
    put(job.folder, "north_1.xlsx", 0, [["a", 1, "y"]])
    put(job.folder, "south_1.xlsx", 1, [["b", 1, "y"]])
    load = arrivals.load_batch

    def stops(*args):
        load(*args)
        raise RuntimeError("lost after its tables were written")

    monkeypatch.setattr(arrivals, "load_batch", stops)
    with pytest.raises(Exception, match="lost after"):
        start(job, tmp_path)
    monkeypatch.undo()
    before = counts(job)
    assert len(before) == 2
    assert len(start(job, tmp_path)) == 1
    assert counts(job) == before and [r[0] for r in job.rows()] == ["a", "b"]


def test_files_come_in_the_order_of_their_times(job, tmp_path):
    for n in range(4):
        put(job.folder, f"north_{9 - n}.xlsx", n, [[f"k{i}", 1, "y"] for i in range(n + 1)], head=HEAD)
    assert [t.rows_kept for t in start(job, tmp_path, files_per_batch=1)] == [1, 2, 3, 4]
    assert [c for _, _, c in sorted(counts(job), key=lambda r: r[2])] == [1, 2, 3, 4] and len(job.rows()) == 4
