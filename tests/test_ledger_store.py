"""The append-only ledger: deltas in proportion to changes, snapshots that survive a killed run, compaction."""

import glob

import pytest
from pyspark.sql import functions as F

from pkgsync.operators import ledger as LG
from pkgsync.operators.ledger_store import LedgerStore, changed
from pkgsync.session import local_dir, scratch_path


def _versions(spark, rows):
    return spark.createDataFrame(rows, LG.LEDGER_VERSIONS)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def store(spark):
    s = LedgerStore(spark, scratch_path(spark, "store"))
    s.create_if_absent({"versions": _versions(spark, [("r" + str(i % 3), "p" + str(i % 50), str(i), 0, 0, "") for i in range(1000)])})
    return s


def test_create_is_empty_and_keeps_what_is_there(spark):
    s = LedgerStore(spark, scratch_path(spark, "store"))
    assert s.snapshot() is None and all(t.count() == 0 for t in s.read().values())
    first = s.create_if_absent()
    assert first.seq == 0 and all(t.count() == 0 for t in s.read().values())
    s.append({"versions": _versions(spark, [("r", "p", "1", 1, 0, "")])})
    assert s.create_if_absent().seq == 1 and s.read()["versions"].count() == 1
    assert s.clean().seq == 2 and s.read()["versions"].count() == 0              # A11
    assert s.read(first)["versions"].count() == 0


def test_a_run_writes_only_the_rows_that_it_changed(spark, store):
    before = store.read()["versions"]
    new = LG.upsert_published(before, _versions(spark, [("r0", "p0", "0", 1, 0, ""), ("new", "n", "1", 1, 0, "")]))
    snap = store.append({"versions": new})
    assert _rows(store.part(snap.deltas[0], "versions")) == [("new", "n", "1", 1, 0, ""), ("r0", "p0", "0", 1, 0, "")]
    assert _rows(store.read()["versions"]) == _rows(new)
    again = store.append({"versions": LG.upsert_published(store.read()["versions"], new.where("published = 1"))})
    assert store.part(again.deltas[1], "versions").count() == 0                  # nothing changed, nothing written
    # null and '' are different values; the latest of several deltas counts
    last = store.append({"versions": store.read()["versions"].withColumn("publish_error", F.when(F.col("version") != "5", F.col("publish_error")))})
    assert _rows(store.part(last.deltas[2], "versions")) == [("r2", "p5", "5", 0, 0, None)]
    assert store.read()["versions"].where("publish_error is null").count() == 1


def test_a_run_killed_between_its_writes_leaves_the_old_snapshot(spark, store, monkeypatch):
    old, new = _rows(store.read()["versions"]), store.read()["versions"].withColumn("published", F.lit(1))

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(LedgerStore, "name", killed)                                     # data written, manifest not
        with pytest.raises(KeyboardInterrupt):
            store.append({"versions": new})
    assert glob.glob(f"{local_dir(store.root)}/delta/*/versions/*")
    assert store.snapshot().seq == 0 and _rows(store.read()["versions"]) == old
    with monkeypatch.context() as m:
        m.setattr(LG, "write_snapshot", killed)                                   # not even the data written
        with pytest.raises(KeyboardInterrupt):
            store.append({"versions": new})
    assert store.snapshot().seq == 0
    store.append({"versions": new})                                               # the next run goes through
    assert store.snapshot().seq == 1 and store.read()["versions"].where("published = 0").count() == 0


def test_compaction_and_old_snapshots(spark, store):
    first = store.snapshot()
    for i in range(3):
        store.append({"versions": store.read()["versions"].withColumn("published", F.when(F.col("version") == str(i), 1).otherwise(F.col("published")).cast("int"))})
    merged = _rows(store.read()["versions"])
    snap = store.compact()
    assert snap.deltas == [] and _rows(store.read()["versions"]) == merged
    assert store.read(first)["versions"].where("published = 1").count() == 0         # still readable


def test_two_writers_of_one_number_are_an_error(spark, store):
    store.name(store.snapshot())
    with pytest.raises(RuntimeError, match="two runs"):
        store.snapshot()


def test_changed_compares_whole_rows(spark):
    old = _versions(spark, [("r", "a", "1", 0, 0, ""), ("r", "b", "1", 0, 0, None)])
    new = _versions(spark, [("r", "a", "1", 0, 0, ""), ("r", "b", "1", 0, 0, None), ("r", "c", "1", 0, 0, None)])
    assert _rows(changed(old, new, LG.VER_KEY)) == [("r", "c", "1", 0, 0, None)]
