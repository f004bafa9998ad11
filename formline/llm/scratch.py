"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from formline.session import checkpoint_dir


class Scratch:
    """A folder of its own for the tables of one computation.

    For loops: a written table starts its readers' plans afresh. A checkpointed
    frame carries over what the optimizer inferred about its columns, which grows
    from round to round until planning takes longer than the work.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.count = spark, f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}", 0

    def table(self, df: DataFrame) -> DataFrame:
        """The rows, written and read back."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Remove the folder; frames read from it can't be used any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
