"""Landing folder -> stage Parquet as an ``availableNow`` file stream.

Each trigger picks up only files not yet recorded in the checkpoint, parses
them with the stage-load rules and appends good rows and rejects (split by
the reject flag) to the stage folder.  ``availableNow`` processes the
backlog in bounded micro-batches and stops, so the stream can be scheduled
like a batch job; a restart resumes from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from warehaus.sources.landing import CORRUPT, READ_OPTIONS
from warehaus.sources.stage_load import REJECTED, parse_landing


def stage_stream(spark: SparkSession, landing_dir: str, schema: StructType, out_path: str,
                 checkpoint: str, widths: dict[str, int] | None = None,
                 max_files_per_trigger: int = 1000):
    raw_schema = StructType([StructField(c, StringType()) for c in schema.names]
                            + [StructField(CORRUPT, StringType())])
    raw = (spark.readStream.schema(raw_schema).options(**READ_OPTIONS)
           .option("maxFilesPerTrigger", max_files_per_trigger).option("recursiveFileLookup", "true").csv(landing_dir))
    parsed = parse_landing(raw, schema, widths)
    query = (parsed.writeStream.format("parquet").partitionBy(REJECTED)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True)
             .start(out_path))
    query.awaitTermination()
    return query
