import pytest
from pyspark.sql import functions as F

from feedmill.sources.scratch import exists
from feedmill.streaming import ingest
from feedmill.streaming.ingest import (
    BronzeWriter, Live, bronze_table, commit, compact, entries, file_stream, latest, ledger_table, start_ingest, sweep, update,
)
from feedmill.streaming.progress import ProgressLog, progress_table, request_stop, run_until_marked
from workloads import catalog


def write_lines(spark, folder, start, count):
    lines = spark.range(start, start + count).select(F.concat(F.lit("row "), "id").alias("value"))
    lines.coalesce(1).write.mode("append").text(folder)


def run_once(spark, base, trigger=None):
    source = file_stream(spark, f"{base}/topic", maxFilesPerTrigger="2")
    return start_ingest(source, f"{base}/bronze", f"{base}/ledger", f"{base}/checkpoint", trigger=trigger)


def ledger_rows(spark, base):
    return [tuple(row) for row in ledger_table(spark, f"{base}/ledger").orderBy("batch").collect()]


def test_batches_ledger_and_restart(spark, tmp_path):
    base = str(tmp_path)
    for part in range(5):
        write_lines(spark, f"{base}/topic", part * 10, 10)
    run_once(spark, base).awaitTermination()
    assert ledger_rows(spark, base) == [(0, 20, 20), (1, 20, 40), (2, 10, 50)]
    run_once(spark, base).awaitTermination()
    assert len(ledger_rows(spark, base)) == 3  # nothing new, nothing repeated
    write_lines(spark, f"{base}/topic", 50, 7)
    run_once(spark, base).awaitTermination()
    assert ledger_rows(spark, base)[-1] == (3, 7, 57)
    values = bronze_table(spark, f"{base}/bronze", ledger=f"{base}/ledger")
    assert values.columns == ["value"]
    assert values.count() == values.distinct().count() == 57


def test_repeated_batch_replaces_itself(spark, tmp_path):
    base = str(tmp_path)
    writer = BronzeWriter(f"{base}/bronze", f"{base}/ledger")
    first, second = [spark.range(n).selectExpr("string(id) AS value") for n in (4, 6)]
    writer(first, 0)
    writer(second, 1)
    # The same batch again, from this writer and from one after a restart.
    writer(second, 1)
    BronzeWriter(f"{base}/bronze", f"{base}/ledger")(second, 1)
    assert ledger_rows(spark, base) == [(0, 4, 4), (1, 6, 10)]
    assert bronze_table(spark, f"{base}/bronze", ledger=f"{base}/ledger").count() == 10
    # A shorter second try leaves none of the first one's rows.
    writer(first, 1)
    assert ledger_rows(spark, base) == [(0, 4, 4), (1, 4, 8)]
    assert bronze_table(spark, f"{base}/bronze", ledger=f"{base}/ledger").count() == 8


def test_unfinished_batches_are_not_read(spark, tmp_path):
    base = str(tmp_path)
    writer = BronzeWriter(f"{base}/bronze", f"{base}/ledger")
    writer(numbers(spark, 0, 4), 0)
    numbers(spark, 4, 6).write.parquet(f"{base}/bronze/batch-1-unfinished")  # no version names it
    assert bronze_table(spark, f"{base}/bronze", ledger=f"{base}/ledger").count() == 4
    writer(numbers(spark, 4, 6), 1)
    assert bronze_table(spark, f"{base}/bronze", ledger=f"{base}/ledger").count() == 10
    with pytest.raises(ValueError, match="ledger"):
        bronze_table(spark, f"{base}/bronze")


def test_empty_batch_leaves_no_entry(spark, tmp_path):
    base = str(tmp_path)
    writer = BronzeWriter(f"{base}/bronze", f"{base}/ledger")
    writer(spark.range(3).selectExpr("string(id) AS value"), 0)
    writer(spark.range(0).selectExpr("string(id) AS value"), 1)
    writer(spark.range(2).selectExpr("string(id) AS value"), 2)
    assert ledger_rows(spark, base) == [(0, 3, 3), (2, 2, 5)]


def test_timed_trigger(spark, tmp_path):
    base = str(tmp_path)
    write_lines(spark, f"{base}/topic", 0, 10)
    query = run_once(spark, base, trigger="200 milliseconds")
    try:
        query.processAllAvailable()
        write_lines(spark, f"{base}/topic", 10, 5)
        query.processAllAvailable()
    finally:
        query.stop()
    assert sum(rows for _, rows, _ in ledger_rows(spark, base)) == 15
    assert bronze_table(spark, f"{base}/bronze", ledger=f"{base}/ledger").distinct().count() == 15


def test_binary_values_become_text(spark, tmp_path):
    base = str(tmp_path)
    spark.createDataFrame([(bytearray(b"a"),), (bytearray(b"b"),)], "value binary").write.parquet(f"{base}/topic")
    source = file_stream(spark, f"{base}/topic", "parquet", "value binary")
    start_ingest(source, f"{base}/bronze", f"{base}/ledger", f"{base}/checkpoint", trigger=None).awaitTermination()
    assert sorted(row["value"] for row in bronze_table(spark, f"{base}/bronze", ledger=f"{base}/ledger").collect()) == ["a", "b"]


def numbers(spark, start, count):
    return spark.range(start, start + count).selectExpr("string(id) AS value")


def filled(spark, base, batches):
    writer = BronzeWriter(f"{base}/bronze", f"{base}/ledger")
    for batch in range(batches):
        writer(numbers(spark, batch * 10, 10), batch)
    return f"{base}/bronze", f"{base}/ledger"


def folders(tmp_path):
    return {path.name.rsplit("-", 1)[0] for path in (tmp_path / "bronze").iterdir() if path.is_dir()}


def test_compaction_folds_finished_batches(spark, tmp_path):
    base = str(tmp_path)
    bronze, ledger = filled(spark, base, 5)
    assert compact(spark, bronze, ledger, kept_versions=1, leftover_seconds=0) == 3
    assert ledger_rows(spark, base) == [(2, 30, 30), (3, 10, 40), (4, 10, 50)]
    assert folders(tmp_path) == {"fold-2", "batch-3", "batch-4"}
    # The last batch again, as after a restart, a folded one, then a new one: totals go on.
    again = BronzeWriter(bronze, ledger)
    again(numbers(spark, 40, 10), 4)
    again(numbers(spark, 10, 10), 1)
    again(numbers(spark, 50, 7), 5)
    assert ledger_rows(spark, base)[-2:] == [(4, 10, 50), (5, 7, 57)]
    assert compact(spark, bronze, ledger, keep=1) == 2  # the first fold stays
    assert [row[0] for row in ledger_rows(spark, base)] == [2, 4, 5]
    values = bronze_table(spark, bronze, ledger=ledger)
    assert values.count() == values.distinct().count() == 57
    assert compact(spark, bronze, ledger) == 0


def test_folds_are_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "FOLD_WIDTH", 2)
    base = str(tmp_path)
    bronze, ledger = f"{base}/bronze", f"{base}/ledger"
    writer = BronzeWriter(bronze, ledger, fold_after=3)
    for batch in range(12):
        writer(numbers(spark, batch * 10, 10), batch)
    live = latest(spark, ledger)[1]
    assert max(item.level for item in live) >= 2 and len(live) < 8
    values = bronze_table(spark, bronze, ledger=ledger)
    assert values.count() == values.distinct().count() == live[-1].total_rows == 120


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["replace_table", "update", "commit", "sweep", "delete"])
def test_crash_at_every_step_of_a_fold(spark, tmp_path, monkeypatch, step):
    """The rows stay the same, and the next run leaves no folder behind."""
    base = str(tmp_path)
    bronze, ledger = filled(spark, base, 5)
    numbers(spark, 900, 9).write.parquet(f"{bronze}/batch-7-unfinished")

    def rows():
        return sorted(int(row["value"]) for row in bronze_table(spark, bronze, ledger=ledger).collect())

    with monkeypatch.context() as broken:
        for moment in ("before", "after"):
            true = getattr(ingest, step)

            def crash(*given, true=true, moment=moment):
                if moment == "after":
                    true(*given)
                raise Crash

            broken.setattr(ingest, step, crash)
            with pytest.raises(Crash):
                compact(spark, bronze, ledger, kept_versions=1, leftover_seconds=0)
                sweep(spark, bronze, ledger, 1, 0)
            broken.setattr(ingest, step, true)
            assert rows() == list(range(50))
    compact(spark, bronze, ledger, kept_versions=1, leftover_seconds=0)
    sweep(spark, bronze, ledger, 1, 0)
    assert rows() == list(range(50))
    assert folders(tmp_path) == {"fold-2", "batch-3", "batch-4"}
    assert len(list((tmp_path / "ledger").iterdir())) == 1


def test_readers_keep_their_version(spark, tmp_path):
    base = str(tmp_path)
    bronze, ledger = filled(spark, base, 4)
    number, live = latest(spark, ledger)
    assert number == 4 and [item.total_rows for item in entries(spark, ledger, 2)] == [10, 20]
    old = bronze_table(spark, bronze, ledger=ledger, version=number)
    compact(spark, bronze, ledger, keep=1)
    assert latest(spark, ledger)[0] == 5
    assert old.count() == 40 and bronze_table(spark, bronze, ledger=ledger, version=2).count() == 20
    assert sweep(spark, bronze, ledger, 1) == 0  # too young to be taken for leftovers
    assert sweep(spark, bronze, ledger, 1, 0) == 3
    assert bronze_table(spark, bronze, ledger=ledger).count() == 40


def test_two_writers_of_one_version(spark, tmp_path):
    ledger = f"{tmp_path}/ledger"
    item = lambda batch, rows: Live(f"batch-{batch}", batch, batch, rows, 0, 0)
    assert commit(spark, ledger, 1, [item(0, 5)]) and not commit(spark, ledger, 1, [item(0, 6)])
    tries = []

    def change(live):
        tries.append(len(live))
        if len(tries) == 1:
            assert commit(spark, ledger, 2, [*live, item(1, 7)])  # another writer comes first
        return [*live, item(2, 8)]

    assert update(spark, ledger, change) == 3
    assert tries == [1, 2] and [row.total_rows for row in latest(spark, ledger)[1]] == [5, 12, 20]
    # A version whose write did not end is none, and its number is used again.
    (tmp_path / "ledger" / "version-4").mkdir()
    assert latest(spark, ledger)[0] == 3
    assert update(spark, ledger, lambda live: live[:1]) == 4
    assert ledger_table(spark, ledger).agg(F.max("total_rows")).first()[0] == 5
    assert ledger_table(spark, f"{tmp_path}/none").collect() == []


def test_progress_of_a_stream(spark, tmp_path):
    base = str(tmp_path)
    assert progress_table(spark, f"{base}/progress").count() == 0
    log = ProgressLog(spark, f"{base}/progress", write_after=2)
    spark.streams.addListener(log)
    try:
        for part in range(5):
            write_lines(spark, f"{base}/topic", part * 10, 10)
        run_once(spark, base).awaitTermination()
        assert log.ended.wait(30)
    finally:
        spark.streams.removeListener(log)
    rows = [row for row in progress_table(spark, f"{base}/progress").orderBy("batch").collect() if row["batch"] is not None]
    assert [(row["batch"], row["rows"]) for row in rows if row["rows"]] == [(0, 20), (1, 20), (2, 10)]
    assert all(row["milliseconds"] >= 0 for row in rows) and len({row["run"] for row in rows}) == 1
    assert [(batch, count) for batch, count, _ in ledger_rows(spark, base)] == [(row["batch"], row["rows"]) for row in rows if row["rows"]]


def test_marker_ends_a_timed_stream(spark, tmp_path):
    base = str(tmp_path)
    write_lines(spark, f"{base}/topic", 0, 10)
    query = run_once(spark, base, trigger="200 milliseconds")
    query.processAllAvailable()
    request_stop(spark, f"{base}/stop")
    assert exists(spark, f"{base}/stop")
    assert run_until_marked(query, spark, f"{base}/stop", every=0.1)
    assert not query.isActive
    ended = run_once(spark, base)
    assert not run_until_marked(ended, spark, f"{base}/no-stop", every=30)
    assert sum(rows for _, rows, _ in ledger_rows(spark, base)) == 10


def test_a_backlog_comes_in_few_batches(spark, sf_dir, monkeypatch):
    assert [ingest.backlog_files(files, 2) for files in (0, 128, 129, 6_000, 36_000)] == [2, 2, 3, 94, 563]
    monkeypatch.setattr(catalog, "STREAM_CHUNK_ROWS", 5)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    bronze, ledger = catalog.ingest_events(spark, sf_dir, files_per_batch="2")
    live = latest(spark, ledger)[1]
    assert events.count() > 2 * 5 * ingest.BACKLOG_BATCHES and len(live) <= ingest.BACKLOG_BATCHES
    assert live[-1].total_rows == bronze_table(spark, bronze, ledger=ledger).count() == events.count()


def test_a_batch_neither_lists_nor_reads_the_ledger(spark, tmp_path, monkeypatch):
    base, calls = str(tmp_path), []
    for name in ("children", "entries"):
        true = getattr(ingest, name)
        monkeypatch.setattr(ingest, name, lambda *given, true=true, name=name: calls.append(name) or true(*given))
    bronze, ledger = filled(spark, base, 6)
    assert calls == ["children"] * 2  # of the first batch, before any version
    assert [row[0] for row in ledger_rows(spark, base)] == list(range(6))


def test_a_writer_finds_versions_of_others(spark, tmp_path):
    base = str(tmp_path)
    bronze, ledger = f"{base}/bronze", f"{base}/ledger"
    first, second = BronzeWriter(bronze, ledger), BronzeWriter(bronze, ledger)
    first(numbers(spark, 0, 10), 0)
    second(numbers(spark, 10, 10), 1)
    first(numbers(spark, 20, 10), 2)
    assert compact(spark, bronze, ledger, keep=1, kept_versions=1, leftover_seconds=0) == 2
    second(numbers(spark, 30, 10), 3)  # what it knew has been swept
    first(numbers(spark, 0, 10), 0)  # folded
    assert ledger_rows(spark, base) == [(1, 20, 20), (2, 10, 30), (3, 10, 40)]
    assert sorted(int(row["value"]) for row in bronze_table(spark, bronze, ledger=ledger).collect()) == list(range(40))
