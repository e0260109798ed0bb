"""Tables between the jobs of one operator, kept in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from loanloom.session import ensure_checkpoint_dir


#: Rows and bytes of an Arrow batch between Spark and a Python worker: texts are long, and both sides hold a batch.
BATCH_ROWS = 1_000
BATCH_BYTES = 8 << 20


class Scratch:
    """Writes intermediate tables as Parquet below the checkpoint folder and reads them back.

    A written table cuts the lineage like a checkpoint does: a lost executor costs only the
    tasks it ran. ``drop`` removes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        ensure_checkpoint_dir(spark)
        rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
            spark.conf.set(rows, str(BATCH_ROWS))
        # a single row may be larger; it travels alone
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        self.spark = spark
        self.root = f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def store(self, df: DataFrame, codec: str = "zstd") -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:03d}"
        df.write.option("compression", codec).parquet(path)
        # the schema is known: no job to infer it, and empty tables read back as well
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a stored table; only for tables that no returned DataFrame reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)
