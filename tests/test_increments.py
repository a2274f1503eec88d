"""Loads that break off after each step, compaction, null ids, conflicts."""

import pytest

from nestfold.operators import increments as inc


def _batch(spark, *ids):
    return spark.createDataFrame([(i, f"r{i}") for i in ids], "id bigint, v string")


def _loaded(spark, root):
    return sorted((r.id, r._load) for r in inc.loaded_rows(spark, root).collect())


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["_write_rows", "_write_ids", "_merge", "_commit"])
@pytest.mark.parametrize("after", [False, True])
def test_a_load_that_breaks_off_is_run_again(spark, workdir, monkeypatch, step, after):
    inc.load_increment(_batch(spark, 1, 2), workdir, "id")
    real = getattr(inc, step)

    def broken(*args, **kwargs):
        if after:
            real(*args, **kwargs)
        raise Crash(step)

    with monkeypatch.context() as m:
        m.setattr(inc, step, broken)
        with pytest.raises(Crash):
            inc.load_increment(_batch(spark, 2, 3, 4), workdir, "id")
    inc.load_increment(_batch(spark, 2, 3, 4), workdir, "id")
    inc.load_increment(_batch(spark, 4, 5), workdir, "id")
    ids = [i for i, _ in _loaded(spark, workdir)]
    assert ids == [1, 2, 3, 4, 5]  # every row once, whether or not the broken load had committed
    assert sorted(r.id for r in inc.load_history(spark, workdir, "id").collect()) == [1, 2, 3, 4, 5]


def test_rows_of_one_new_id_all_come_and_null_ids_are_kept_apart(spark, workdir):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "x"), (None, "y")], "id bigint, v string")
    load = inc.load_increment(rows, workdir, "id")
    assert (load.version, load.n_rows, load.n_rejected) == (1, 2, 2)
    assert sorted(r.v for r in inc.rejected_rows(spark, workdir).collect()) == ["x", "y"]
    again = inc.load_increment(rows, workdir, "id", reject_null_ids=False)
    assert (again.version, again.n_rows, again.n_rejected) == (2, 2, 0)  # without an id it comes every time
    assert sorted(r.v for r in again.rows.collect()) == ["x", "y"]


def test_id_folders_are_merged_by_tiers_and_vacuum_removes_what_no_one_reads(spark, workdir):
    for i in range(9):
        inc.load_increment(_batch(spark, i, 100 + i), workdir, "id", fan=2)
    assert [r.n_id_folders for r in inc.load_log(spark, workdir).orderBy("version").collect()] == [1, 1, 2, 1, 2, 2, 3, 1, 2]
    _batch(spark, 77).write.parquet(f"{workdir}/attempts/00000010-dead/rows")
    assert inc.vacuum(spark, workdir) == []  # all too young
    gone = inc.vacuum(spark, workdir, grace_seconds=-60)
    assert any("dead" in g for g in gone) and len(gone) > 5
    assert sorted(r.id for r in inc.load_history(spark, workdir, "id").collect()) == sorted([*range(9), *range(100, 109)])
    assert len(_loaded(spark, workdir)) == 18
    assert inc.load_increment(_batch(spark, 3, 200), workdir, "id").n_rows == 1


def test_of_two_loads_at_once_one_wins(spark, workdir, monkeypatch):
    inc.load_increment(_batch(spark, 1), workdir, "id")
    real = inc._commit

    def late(spark_, root, version, entry):
        monkeypatch.setattr(inc, "_commit", real)
        inc.load_increment(_batch(spark, 2), workdir, "id")  # another writer is faster
        real(spark_, root, version, entry)

    monkeypatch.setattr(inc, "_commit", late)
    with pytest.raises(inc.LoadConflict):
        inc.load_increment(_batch(spark, 2, 3), workdir, "id")
    inc.load_increment(_batch(spark, 2, 3), workdir, "id")
    assert [i for i, _ in _loaded(spark, workdir)] == [1, 2, 3]


def test_empty_loads_and_new_columns(spark, workdir):
    assert inc.load_history(spark, workdir, "id") is None
    assert inc.load_increment(_batch(spark), workdir, "id").n_rows == 0
    assert inc.load_increment(_batch(spark, 1), workdir, "id").version == 2
    wider = spark.createDataFrame([(2, "r", 3.5)], "id bigint, v string, w double")
    inc.load_increment(wider, workdir, "id")
    rows = inc.loaded_rows(spark, workdir)
    assert sorted((r.id, r.w, r._load) for r in rows.collect()) == [(1, None, 2), (2, 3.5, 3)]


def test_string_ids(spark, workdir):
    df = spark.createDataFrame([("b",), ("a",)], "id string")
    inc.load_increment(df, workdir, "id")
    assert inc.load_increment(spark.createDataFrame([("a",), ("c",)], "id string"), workdir, "id").rows.collect()[0].id == "c"


def test_history_version_whose_write_broke_off(spark, workdir):
    from nestfold.operators.history import write_history

    path = write_history(_batch(spark, 1), workdir, 1)
    from nestfold.session import remove

    remove(spark, f"{path}/_SUCCESS")
    write_history(_batch(spark, 2), workdir, 1)
    assert [r.id for r in spark.read.parquet(path).collect()] == [2]
