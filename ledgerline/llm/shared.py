"""What the operators share: shared scratch tables, table readers and word patterns."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than ASCII white space.
SPACE_CLASS = r"[\x20\x09-\x0D]"
ASCII_SPACE = " \t\n\x0b\f\r"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; where that is unset, only a local session gets one of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables of one operator, which go as soon as what is made of them has been written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.written = spark, []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """As materialize; the table stays until release()."""
        path = f"{scratch_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.written.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        jvm = self.spark.sparkContext._jvm
        for path in self.written:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        self.written.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(id_: Column, text: Column) -> Column:
    """What tells rows apart: the id itself and a digest of the text, so that only texts of one id could be confused."""
    return F.struct(id_.alias("id"), F.xxhash64(text).alias("digest"))


def by_value(module) -> None:
    """Ship a module's Python functions inside the tasks, so that executors need no copy of the repository."""
    cloudpickle.register_pickle_by_value(module)


def words(text: Column) -> Column:
    """Words of a text as array<string>; a null or blank text has none."""
    trimmed = F.btrim(text, F.lit(ASCII_SPACE))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) > 0, F.split(trimmed, SPACE_CLASS + "+")).otherwise(
        F.array().cast("array<string>")
    )


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions run once per row. A later filter on a plain projection's column would be pushed
    below it and repeat the whole expression; it stops at a generator."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))
