"""Commits of the comment table: all or nothing, only what a batch touches, and what dead jobs leave."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from commentlens.plans import daily
from commentlens.sources import filings, store
from commentlens.streaming import ingest


def _rows(spark, *rows):
    df = spark.createDataFrame(list(rows), "id_submission string, text_data string, date_disseminated string")
    return df.withColumn("date_disseminated", F.to_timestamp("date_disseminated"))


def _show(spark, table):
    rows = store.read_comments(spark, table).collect()
    return sorted((r.id_submission, r.text_data, str(r.day)) for r in rows)


FIRST = (("1", "one", "2017-05-01"), ("2", "two", "2017-05-02"), ("3", "three", "2017-05-02"))
CHANGE = (("1", "uno", "2017-05-03"), ("4", "quattro", "2017-05-01"))
AFTER = [("1", "uno", "2017-05-03"), ("2", "two", "2017-05-02"), ("3", "three", "2017-05-02"), ("4", "quattro", "2017-05-01")]


class Died(Exception):
    pass


@pytest.mark.parametrize("step", ["rows", "ids", "manifest"])
def test_a_job_that_dies_changes_nothing(spark, tmp_path, monkeypatch, step):
    table = str(tmp_path / "table")
    daily.ingest(spark, _rows(spark, *FIRST), table)
    before = _show(spark, table)

    def die(*args):
        raise Died

    real = store._write

    def write(rows, folder, by):
        done = real(rows, folder, by)
        if f"/{step}/" in folder:
            raise Died
        return done

    with monkeypatch.context() as m:
        m.setattr(store, "_commit", die) if step == "manifest" else m.setattr(store, "_write", write)
        with pytest.raises(Died):
            daily.ingest(spark, _rows(spark, *CHANGE), table)
        assert _show(spark, table) == before
    daily.ingest(spark, _rows(spark, *CHANGE), table)
    assert _show(spark, table) == AFTER
    left = store.vacuum(spark, table)
    assert left and _show(spark, table) == AFTER
    assert store.vacuum(spark, table) == []


def test_two_jobs_at_once(spark, tmp_path):
    table = str(tmp_path / "table")
    daily.ingest(spark, _rows(spark, *FIRST), table)
    with pytest.raises(store.ConcurrentCommit):
        store._commit(spark, table, store.Manifest(1, 4, {}, {}))
    assert len(_show(spark, table)) == 3
    assert [n for n in store._names(spark, f"{table}/manifest") if "json" not in n] == []


def test_readers_keep_their_state(spark, tmp_path):
    table = str(tmp_path / "table")
    daily.ingest(spark, _rows(spark, *FIRST), table)
    held = store.read_comments(spark, table)
    daily.ingest(spark, _rows(spark, *CHANGE), table)
    assert held.count() == 3 and _show(spark, table) == AFTER
    for _ in range(2):
        daily.ingest(spark, _rows(spark, *CHANGE), table)
    assert len(store._numbers(spark, table)) == store.RETAIN + 1
    used = store.current(spark, table).folders()
    days = {f"rows/{v}/{d}" for v in store._names(spark, f"{table}/rows") for d in store._names(spark, f"{table}/rows/{v}") if "=" in d}
    assert days >= {f for f in used if f.startswith("rows")} and len(days) <= 2 * len(used)


def test_only_touched_buckets_and_days_are_read(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "table")
    many = [(str(i), f"text {i}", f"2017-05-{1 + i % 9:02d}") for i in range(200)]
    daily.ingest(spark, _rows(spark, *many), table)
    state = store.current(spark, table)
    assert len(state.days) == 9 and len(state.ids) == store.BUCKETS
    opened = []
    real = store._folders
    monkeypatch.setattr(store, "_folders", lambda spark, base, folders, schema: opened.extend(folders) or real(spark, base, folders, schema))
    daily.ingest(spark, _rows(spark, ("7", "seven", "2017-05-20")), table)
    ids = {f for f in opened if "/ids/" in f}
    days = {f.split("day=")[1] for f in opened if "/rows/" in f}
    assert len(ids) == 1 and days == {"2017-05-08", "2017-05-20"}
    assert [r for r in _show(spark, table) if r[0] == "7"] == [("7", "seven", "2017-05-20")]


def test_ids_follow_a_row_that_moves_often(spark, tmp_path, monkeypatch):
    """More moves than versions that one bucket may have; entries of one bucket are then put together."""
    monkeypatch.setattr(store, "PARTS", 3)
    table = str(tmp_path / "table")
    fixed = [(str(i), "fixed", "2017-05-01") for i in range(20)]
    store_rows = _rows(spark, ("a", "moves", "2017-06-01"), *fixed).withColumn(store.ORDER, F.current_timestamp())
    store.upsert(spark, table, store_rows, buckets=1)
    for day in range(2, 9):
        daily.ingest(spark, _rows(spark, ("a", f"moved {day}", f"2017-06-{day:02d}")), table)
        assert len(store.current(spark, table).ids["0"]) <= 3
    rows = _show(spark, table)
    assert [r for r in rows if r[0] == "a"] == [("a", "moved 8", "2017-06-08")] and len(rows) == 21
    found = store.places(spark, table, store.current(spark, table), spark.createDataFrame([("a",), ("3",), ("none",)], "id_submission string"))
    assert sorted((r[0], str(r[1])) for r in found.collect()) == [("3", "2017-05-01"), ("a", "2017-06-08")]


def test_landed_days_are_pruned(spark, tmp_path):
    source, landing = str(tmp_path / "in"), str(tmp_path / "landing")
    lines = [f'{{"id_submission":"{i}","text_data":"t","date_disseminated":"2017-05-0{1 + i % 3}T10:00:00.000Z","extra":{i}}}' for i in range(9)]
    spark.createDataFrame([(x,) for x in [*lines, '{"id_submission":"x"}']], "value string").write.text(source)
    for _ in range(2):
        filings.land(spark, source, landing, "first")
    day = filings.read_landed(spark, landing, "2017-05-02", "2017-05-02")
    assert sorted(r.id_submission for r in day.collect()) == ["1", "4", "7"]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "PartitionFilters: [" in plan
    assert filings.read_landed(spark, landing).count() == 10
    assert filings.read_landed(spark, landing, last="1999-01-01").collect()[0].id_submission == "x"
    assert spark.read.text(landing).filter(F.col("value").contains('"extra":7')).count() == 1


def test_stream_that_dies_in_a_commit(spark, tmp_path, monkeypatch):
    source, table, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    write = lambda name, *rows: _rows(spark, *rows).coalesce(1).write.json(f"{source}/{name}")
    write("p=1", *FIRST)
    start = lambda: ingest.upsert_stream(ingest.filing_stream(spark, f"{source}/*", 1), table, state)
    start().awaitTermination()

    def die(*args):
        raise Died

    write("p=2", *CHANGE, FIRST[1])
    with monkeypatch.context() as m:
        m.setattr(store, "_commit", die)
        with pytest.raises(StreamingQueryException):
            start().awaitTermination()
    assert len(_show(spark, table)) == 3
    start().awaitTermination()
    assert _show(spark, table) == AFTER
    stamps = {r[0]: r[1] for r in store.read_comments(spark, table).select("id_submission", store.ORDER).collect()}
    assert stamps["2"] == stamps["3"] < stamps["1"] == stamps["4"]  # the repeat of 2 was dropped


def test_corrections_are_no_repeats(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    _rows(spark, ("1", "old", "2017-05-01"), ("1", "old", "2017-05-01"), ("1", "new", "2017-05-02")).write.json(f"{source}/a")
    ingest.upsert_stream(ingest.filing_stream(spark, f"{source}/*"), table, str(tmp_path / "state")).awaitTermination()
    assert _show(spark, table) == [("1", "new", "2017-05-02")]


def test_patch_does_not_shuffle_stored_rows(spark, tmp_path, monkeypatch):
    """Days are patched in groups of few patch rows, read and written where they lie; a day with more goes by a shuffle."""
    monkeypatch.setattr(store, "PATCH_ROWS", 3)
    table, days = str(tmp_path / "table"), {1: 2, 2: 1, 3: 2, 4: 7, 5: 1}
    ids = [(f"{d}-{i}", f"text {d} {i}", f"2017-05-0{d}") for d, n in days.items() for i in range(n)]
    rows = spark.createDataFrame(ids, "id_submission string, text_data string, at string").withColumn("date_disseminated", F.to_timestamp("at")).drop("at")
    daily.ingest(spark, rows, table)
    before = {r.id_submission: r for r in store.read_comments(spark, table).collect()}
    real, written = store._write, []

    def write(rows, folder, by, rebalance=True):
        written.append((rebalance, rows._jdf.queryExecution().executedPlan().toString()))
        return real(rows, folder, by, rebalance)

    monkeypatch.setattr(store, "_write", write)
    patch = spark.createDataFrame([(i, f"src {i}") for i, _, at in ids if at != "2017-05-05"] + [("gone", "x")], "id_submission string, source string")
    store.update_analysis(spark, table, patch)
    assert [r for r, _ in written] == [False, False, True]
    assert all("SortMergeJoin" not in plan and "BroadcastHashJoin" in plan for r, plan in written if not r)
    after = {r.id_submission: r for r in store.read_comments(spark, table).collect()}
    assert after.keys() == before.keys()
    for i, row in after.items():
        assert row.analysis.source == (before[i].analysis.source if i.startswith("5") else f"src {i}")
        assert row.text_data == before[i].text_data and row.day == before[i].day and row.analysis.words == before[i].analysis.words
