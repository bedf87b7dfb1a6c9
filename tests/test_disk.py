"""What a run leaves on disk: bounded by its outputs, not by the steps between."""

import os

import pytest
from pyspark.sql import functions as F

from warehaus.batch import Batch
from warehaus.operators.upsert import pinned_for
from warehaus.plans import batches, runner
from warehaus.plans.storage import TableStore
from warehaus.plans.warehouse import load_table
from warehaus.schemas import conform
from warehaus.session import SHUFFLE_CLEANUP, _scratch_root, shuffles_dropped
from warehaus.sources import fixtures
from warehaus.sources.fixtures import Fixtures
from warehaus.sources.landing import PACKED, PACKED_ROWS, read_landing_raw, write_landing

from conftest import SF_SMALL


def files(path):
    return [f"{d}/{n}" for d, _, names in os.walk(path.replace("file:", "")) for n in names if not n.startswith((".", "_"))]


def folders(spark, purpose):
    path = f"{_scratch_root(spark)}/{purpose}".replace("file:", "")
    return set(os.listdir(path)) if os.path.isdir(path) else set()


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))


def test_packed_landing_holds_the_same_rows_in_less_space(spark, tmp_root):
    n = 2 * PACKED_ROWS + 50
    df = spark.range(0, n, numPartitions=1).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 100000 == 7, F.lit("two\nlines")).otherwise(
        F.concat(F.lit('some, "text" é '), F.col("id"))).alias("s"))
    plain, packed = write_landing(df, f"{tmp_root}/plain"), write_landing(df, f"{tmp_root}/packed", **PACKED)
    assert sum(map(os.path.getsize, files(packed))) < sum(map(os.path.getsize, files(plain))) / 2
    per_file = read_landing_raw(spark, packed, df.columns).groupBy(F.input_file_name()).count().agg(F.max("count"), F.count("*")).first()
    assert per_file[0] <= PACKED_ROWS and per_file[1] == 4  # three of single lines, one of the side folder
    one, other = (read_landing_raw(spark, p, df.columns).agg(F.count("*"), F.expr("bit_xor(xxhash64(*))")).first() for p in (plain, packed))
    assert one == other and one[0] == n


def test_runs_land_packed_files(spark, tmp_root):
    rows = spark.range(3).select(F.col("id").cast("string").alias("officecode"))
    roots = runner.Roots("", f"{tmp_root}/landing", "", "")
    batch = Batch.of(7, "2005-06-10")
    landed = runner.extract_all(lambda spec, b: conform(rows, spec.stage) if spec.name == "offices" else spark.createDataFrame([], spec.stage), roots, batch)
    assert files(landed["offices"]) and all(f.endswith(".csv.gz") for f in files(landed["offices"]))


def test_rows_between_steps_go_with_the_step(spark, tmp_root):
    before = folders(spark, "classified")
    with pinned_for(spark.range(5)) as rows:
        assert rows.count() == 5 and len(folders(spark, "classified") - before) == 1
    assert folders(spark, "classified") == before
    with pytest.raises(KeyError), pinned_for(spark.range(5)):
        raise KeyError
    fx, store = Fixtures(spark, SF_SMALL), TableStore(spark, f"{tmp_root}/wh")
    store.create("offices", fx.dw_offices)
    assert load_table(store, "offices", fx.stg_offices, fixtures.BATCH).count() == 25
    assert folders(spark, "classified") == before


def test_own_fixtures_go_and_shared_ones_stay(spark, monkeypatch):
    shared = Fixtures(spark, SF_SMALL)
    want = shared.stg_offices.count()
    monkeypatch.setattr(fixtures, "_WRITTEN", {w for w in fixtures._WRITTEN if w[2] != "dw_offices"})
    own = Fixtures(spark, SF_SMALL, own=True)
    assert own.dw_offices.count() == 23 and own.stg_offices.count() == want
    made = folders(spark, "own-fixtures")
    assert os.path.isdir(f"{own.own_root}/dw_offices".replace("file:", "")) and not os.path.isdir(f"{own.own_root}/stg_offices".replace("file:", ""))
    own.release()
    assert len(made - folders(spark, "own-fixtures")) == 1
    assert shared.stg_offices.count() == want and own.dw_offices.count() == 23
    own.release()


def test_two_batches_release_their_fixtures_before_the_batches(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(batches, "write_snapshots", lambda fx, root: fx.stg_offices.count() and seen.append(spark.conf.get(SHUFFLE_CLEANUP)))
    monkeypatch.setattr(batches, "seed_warehouse", lambda fx, root: None)
    monkeypatch.setattr(batches, "run_batch", lambda *a: seen.append(folders(spark, "own-fixtures") - made))
    monkeypatch.setattr(batches, "_RUNS", {})
    monkeypatch.setattr(fixtures, "_WRITTEN", set())
    made = folders(spark, "own-fixtures")
    batches.two_batch_roots(spark, SF_SMALL)
    assert seen == ["true", set(), set()]


def test_shuffle_files_go_with_their_query(spark, tmp_root):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    with shuffles_dropped(spark):
        kept = spark.range(1000).selectExpr("id % 7 as k", "id").groupBy("k").agg(F.sum("id").alias("s"))
        kept.write.parquet(f"{tmp_root}/sums")
        assert shuffle_files(spark) <= before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting and spark.read.parquet(f"{tmp_root}/sums").count() == 7


def test_round_trips_land_packed_files(spark):
    from warehaus.plans.ingest import round_trip
    before = folders(spark, "landing")
    rows = spark.range(9).select("id", F.lit("2005-06-10").alias("d"))
    got = round_trip(spark, rows, spark.createDataFrame([], "id long, d date").schema)
    assert got.where("d = date'2005-06-10'").count() == 9
    made = [f for n in folders(spark, "landing") - before for f in files(f"{_scratch_root(spark)}/landing/{n}")]
    assert made and all(f.endswith(".csv.gz") for f in made)
