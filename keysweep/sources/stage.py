"""Reading staged and backed-up Parquet back.

Always with the table's schema: inferring would turn a partition value such
as ``007`` into the integer 7 and publish it as a different partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from keysweep.sinks import fs


def read_stage(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Staged rows with the table's exact schema; an absent or empty stage is 0 rows."""
    if not fs.has_data_files(spark, path):
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("basePath", path)
            .option("recursiveFileLookup", False).parquet(path).select(*schema.fieldNames()))


def read_backup(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Backed-up rows with the table's exact schema."""
    return read_stage(spark, path, schema)
