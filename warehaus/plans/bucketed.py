"""Warehouse tables bucketed on their natural key: merges that do not move the target.

A merge matches the stage with every key of the target.  In a plain table
those keys are shuffled in each batch.  Here the files of every partition are
dealt to a fixed number of buckets by the hash of the natural key (Spark's
``bucketBy``), so a scan already lies as the join and the aggregate want it:
only the stage, dealt to as many buckets, is shuffled.  A load still rewrites
touched partitions only.

Spark knows a bucketed table by its catalog entry.  The entry is an external
table over the store's folder, declared again by every application, so the
folder stays all there is to keep.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from warehaus.plans.storage import PART, TableStore
from warehaus.schemas import TABLES


class BucketedStore(TableStore):
    """A ``TableStore`` whose tables in ``buckets`` (name -> number of buckets) are bucketed on their natural key.

    The number of a table's buckets is fixed by its first load: choose it so that
    a bucket of a full scan fits a task (its size over about 1 GB).
    """

    def __init__(self, spark: SparkSession, root: str, buckets: Mapping[str, int]):
        self.buckets = dict(buckets)
        self._declared: set[str] = set()
        super().__init__(spark, root, rename=True)
        fs, _ = self._hadoop(self.root)
        if fs.getUri().getScheme() not in ("file", "hdfs"):
            raise ValueError("bucketed tables need a file system that renames folders in one step")

    def name(self, table: str) -> str:
        """Catalog name, of this folder alone."""
        return f"wh_{hashlib.md5(self.path(table).encode()).hexdigest()[:16]}_{table}"

    def _declare(self, table: str) -> str:
        name = self.name(table)
        if table not in self._declared:
            spec = TABLES[table]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.dw_schema.fields)
            keys = ", ".join(f"`{k}`" for k in spec.dw_key)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `{PART}` STRING) USING parquet PARTITIONED BY (`{PART}`) "
                           f"CLUSTERED BY ({keys}) INTO {self.buckets[table]} BUCKETS LOCATION '{self.path(table)}'")
            self._declared.add(table)
        self.spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(name)
        return name

    def _scan(self, table: str, schema: StructType | None) -> DataFrame:
        return self.spark.table(self._declare(table)) if table in self.buckets else super()._scan(table, schema)

    def _write(self, table: str, rows: DataFrame, path: str) -> None:
        if table not in self.buckets:
            return super()._write(table, rows, path)
        n, keys = self.buckets[table], TABLES[table].dw_key
        passing = f"wh_pending_{uuid.uuid4().hex}"  # bucketing is written through the catalog only
        rows.write.partitionBy(PART).bucketBy(n, *keys).option("path", path).saveAsTable(passing)
        self.spark.sql(f"DROP TABLE {passing}")  # external: the files stay

    def by_key(self, table: str, rows: DataFrame, key: Iterable[str]) -> DataFrame:
        return rows.repartition(self.buckets[table], *key) if table in self.buckets else rows
