"""Intermediate tables in the shared folder, and small helpers for tasks."""

from __future__ import annotations

import logging
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import work_folder

log = logging.getLogger(__name__)


class Scratch:
    """Tables that one run writes below the folder all executors share.

    Reading a written table instead of its plan cuts the lineage, and survives the
    loss of executors. ``drop`` removes what no later step reads.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.root, self.n = spark, work_folder(spark), 0

    def keep(self, df: DataFrame, *by: str) -> DataFrame:
        """``df`` written and read back; in folders by the values of ``by``."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.partitionBy(*by).parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._scratch_path = path  # type: ignore[attr-defined]
        return kept

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            _remove(self.spark, table._scratch_path)  # type: ignore[attr-defined]

    def close(self) -> None:
        _remove(self.spark, self.root)


def _remove(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(conf).delete(folder, True)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of the id as text; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(0))


def pieces(total: int, each: int) -> int:
    """How many pieces of about ``each`` make up ``total``, one at least."""
    return max(1, -(-int(total) // each))


def let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it. On a cluster whose
    machines don't share that folder, ship the package with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{known}:{root}".strip(":")
