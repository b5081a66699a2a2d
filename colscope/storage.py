"""Tables written between the steps of an operator, in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names; where it is unset, a fresh local folder, but only if there is no other machine."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or getattr(sc, "_colscope_shared", None)
    if not found:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = sc._colscope_shared = "file://" + tempfile.mkdtemp(prefix="colscope-shared-")
    return found.rstrip("/")


class Stored:
    """A written table: its lineage ends there. ``drop`` deletes it; what is left goes when the application ends."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"
        where, files = self._files()
        files.mkdirs(where.getParent())
        files.deleteOnExit(where)
        schema = df.schema
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(schema).parquet(self.path)

    def _files(self):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def drop(self) -> None:
        where, files = self._files()
        files.delete(where, True)
