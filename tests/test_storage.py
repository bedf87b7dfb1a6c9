import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from warehaus.batch import Batch
from warehaus.plans.lease import LeaseHeld, lease
from warehaus.plans.storage import TableStore
from warehaus.sources.tables import SPREAD_CONF, spread

B = Batch.of(7, "2005-06-10")
ROWS = "id long, x int, src_create_timestamp timestamp_ntz"


def rows(spark, *r):
    return spark.createDataFrame([(i, x, dt.datetime(2005, m, 1) if m else None) for i, x, m in r], ROWS)


def files(store, table):
    """Data files by partition folder, with their modification times."""
    out = {}
    root = store.path(table).replace("file:", "")
    for d, _, names in os.walk(root):
        for n in names:
            if n.endswith(".parquet"):
                out.setdefault(os.path.relpath(d, root), set()).add((n, os.stat(f"{d}/{n}").st_mtime_ns))
    return out


def content(df):
    return sorted((r.id, r.x) for r in df.collect())


@pytest.fixture(params=["static", "dynamic"])
def overwrite_mode(spark, request):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", request.param)
    yield request.param
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_only_touched_partitions_are_rewritten(spark, tmp_root, overwrite_mode):
    store = TableStore(spark, f"{tmp_root}/wh")
    assert not store.exists("t") and store.parts("t") == []
    store.create("t", rows(spark, (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 0, None)))
    assert store.parts("t") == ["2005-01", "2005-02", "2005-03", "undated"]
    before = files(store, "t")
    touched = store.read("t", parts=["2005-02"])
    store.write_parts("t", touched.withColumn("x", F.col("x") + 5).unionByName(rows(spark, (5, 9, 2))))
    after = files(store, "t")
    assert content(store.read("t")) == [(1, 0), (2, 5), (3, 0), (4, 0), (5, 9)]
    assert {k for k in before if before[k] != after[k]} == {"part=2005-02"}
    assert content(store.read("t", parts=[])) == []


def test_failed_write_leaves_the_table(spark, tmp_root):
    store = TableStore(spark, f"{tmp_root}/wh")
    store.create("t", rows(spark, (1, 0, 1), (2, 0, 2)))
    before = files(store, "t")
    bad = store.read("t").withColumn("x", (F.lit(1) / (F.col("id") - F.col("id"))).cast("int"))
    with pytest.raises(Exception):
        store.write_parts("t", bad)
    assert files(store, "t") == before
    with pytest.raises(FileExistsError):
        store.create("t", rows(spark, (1, 0, 1)))


def test_emptied_partition_goes(spark, tmp_root, overwrite_mode):
    store = TableStore(spark, f"{tmp_root}/wh")
    day = spark.createDataFrame([(1, B.date), (2, dt.date(2005, 6, 9))], "id long, etl_batch_date date")
    store.create("daily_x", day)
    store.write_parts("daily_x", day.limit(0), emptied=[B.date_text])
    assert [r.id for r in store.read("daily_x").collect()] == [2]
    store.write_parts("daily_x", day.limit(0), emptied=["2005-06-09"])
    assert store.read("daily_x", day.schema).collect() == []


def test_empty_first_load_is_an_empty_table(spark, tmp_root):
    store = TableStore(spark, f"{tmp_root}/wh")
    empty = rows(spark, (1, 0, 1)).limit(0)
    store.write_parts("t", empty)
    assert store.exists("t") and store.read("t", empty.schema).collect() == []


def test_unreadable_table_raises(spark, tmp_root):
    """Only a missing path means that there is no table."""
    store = TableStore(spark, f"{tmp_root}/wh")
    schema = rows(spark, (1, 0, 1)).schema
    assert store.read("t", schema).collect() == []
    store.create("t", rows(spark, (1, 0, 1)))
    folder = store.path("t").replace("file:", "") + "/part=2005-01"
    for n in os.listdir(folder):
        os.remove(f"{folder}/{n}")
    with open(f"{folder}/part-0.parquet", "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):
        store.read("t", schema).collect()
    with pytest.raises(KeyError):
        store.read("other")


class Stop(Exception):
    pass


def stops_after(monkeypatch, store_class, method, calls):
    """Let ``method`` run ``calls`` times and then stop the program there."""
    real, seen = getattr(store_class, method), []

    def wrapped(self, *args):
        if len(seen) == calls:
            raise Stop
        seen.append(args)
        return real(self, *args)

    monkeypatch.setattr(store_class, method, wrapped)


def history(spark, *r):
    return spark.createDataFrame([(i, x, a, dt.date(2005, 6, 10) if a == 0 else None) for i, x, a in r],
                                 "id long, x int, dw_active_record_ind int, update_etl_batch_date date")


@pytest.mark.parametrize("method,calls", [("_move", 0), ("_move", 1), ("_delete", 0), ("_delete", 1), ("_delete", 2)])
def test_stopped_replacement_is_completed_on_the_next_open(spark, tmp_root, monkeypatch, method, calls):
    """``active`` and ``closed`` are replaced one after the other: a row just closed is in one of them after any stop."""
    store = TableStore(spark, f"{tmp_root}/wh")
    store.create("x_history", history(spark, (1, 10, 1), (2, 20, 1)))
    new = history(spark, (1, 10, 0), (1, 11, 1), (2, 20, 1))
    stops_after(monkeypatch, TableStore, method, calls)
    with pytest.raises(Stop):
        store.write_parts("x_history", new)
    monkeypatch.undo()
    want = [(1, 10), (1, 11), (2, 20)]
    assert content(TableStore(spark, f"{tmp_root}/wh").read("x_history")) == want
    again = TableStore(spark, f"{tmp_root}/wh")
    assert again._names(f"{again.root}/_pending/x_history") == [] and content(again.write_parts("x_history", new)) == want


def test_stopped_store_completes_before_its_next_use(spark, tmp_root, monkeypatch):
    store = TableStore(spark, f"{tmp_root}/wh")
    store.create("t", rows(spark, (1, 0, 1), (2, 0, 2), (3, 0, 3)))
    stops_after(monkeypatch, TableStore, "_move", 1)
    with pytest.raises(Stop):
        store.write_parts("t", rows(spark, (1, 9, 1), (2, 9, 2)), emptied=["2005-03"])
    monkeypatch.undo()
    assert store.parts("t") == ["2005-01", "2005-02"] and content(store.read("t")) == [(1, 9), (2, 9)]


def test_replacement_without_folder_renames(spark, tmp_root, monkeypatch):
    """Where a rename is no single step, a job copies the pending rows; stopped before it ends, it is done again."""
    store = TableStore(spark, f"{tmp_root}/wh", rename=False)
    store.create("t", rows(spark, (1, 0, 1), (2, 0, 2)))
    stops_after(monkeypatch, TableStore, "_delete", 0)
    with pytest.raises(Stop):
        store.write_parts("t", rows(spark, (1, 9, 1)), emptied=["2005-02"])
    monkeypatch.undo()
    assert content(TableStore(spark, f"{tmp_root}/wh", rename=False).read("t")) == [(1, 9)]


def test_write_without_a_record_is_dropped(spark, tmp_root, monkeypatch):
    store = TableStore(spark, f"{tmp_root}/wh")
    store.create("t", rows(spark, (1, 0, 1)))
    stops_after(monkeypatch, TableStore, "_note", 0)
    with pytest.raises(Stop):
        store.write_parts("t", rows(spark, (1, 9, 1)))
    monkeypatch.undo()
    again = TableStore(spark, f"{tmp_root}/wh")
    assert content(again.read("t")) == [(1, 0)] and len(again._names(f"{again.root}/_pending/t")) == 1
    again.drop_unfinished()
    assert again._names(f"{again.root}/_pending/t") == []


def test_lease_admits_one_run(spark, tmp_root):
    with lease(spark, f"{tmp_root}/wh", "batch 7"):
        with pytest.raises(LeaseHeld, match="batch 7"), lease(spark, f"{tmp_root}/wh", "batch 8"):
            pass
        with lease(spark, f"{tmp_root}/other", "batch 8"):
            pass
    with pytest.raises(Stop), lease(spark, f"{tmp_root}/wh", "batch 7"):
        raise Stop
    with lease(spark, f"{tmp_root}/wh", "batch 8"):  # released by the error
        # a dead driver's lease is taken over, and its late end leaves the new one alone
        with lease(spark, f"{tmp_root}/wh", "batch 9", take_over=True):
            pass
        with lease(spark, f"{tmp_root}/wh", "batch 10"):
            pass


def test_state_before_a_batch(spark, tmp_root):
    store = TableStore(spark, f"{tmp_root}/wh")
    schema = rows(spark, (1, 0, 1)).schema
    store.create("t", rows(spark, (1, 0, 1), (2, 0, 2), (3, 0, 3)))
    old, parts = store.state_before("t", schema, B, ["2005-01"])
    store.write_parts("t", old.withColumn("x", F.lit(1)))
    # the rerun touches one more partition, and a third run the same again
    for _ in range(2):
        old, parts = store.state_before("t", schema, B, ["2005-01", "2005-02"])
        assert content(old) == [(1, 0), (2, 0)] and parts == ["2005-01", "2005-02"]
        store.write_parts("t", old.withColumn("x", F.lit(2)))
    old, parts = store.state_before("t", schema, B, [])
    assert content(old) == [(1, 0), (2, 0)] and parts == ["2005-01", "2005-02"]
    assert store.later_batches("t", Batch.of(6, "2005-06-09")) == [7] and store.later_batches("t", B) == []


def test_spread_only_on_request(spark):
    few = spark.range(0, 1000, numPartitions=1)
    assert spread(few).rdd.getNumPartitions() == 1
    spark.conf.set(SPREAD_CONF, "5")
    try:
        assert spread(few).rdd.getNumPartitions() == 5
    finally:
        spark.conf.unset(SPREAD_CONF)
