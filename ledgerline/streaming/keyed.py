"""A keyed table that batches update in place of a whole rewrite.

Rows live in buckets by the hash of their keys. A batch reads and writes the buckets of its own keys only, into files of
its own number, and then lists for every bucket which batch holds it. The list is written last, so a reader sees either
the state before a batch or the one after; a batch that is repeated starts from the list before it and writes the same again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

BUCKETS = 256


class KeyedTable:
    """Table at path with a schema and keys; buckets is fixed when the table is made."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], *, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path, schema, keys, buckets

    def _folder(self, name: str):
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of the batches that are complete, in order."""
        place, files = self._folder("lists")
        if not files.exists(place):
            return []
        found = (s.getPath() for s in files.listStatus(place))
        return sorted(int(p.getName()) for p in found if p.getName().isdigit() and files.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def held(self, version: int | None) -> dict[int, int]:
        """Batch that holds each bucket at a version; as many entries as buckets."""
        if version is None:
            return {}
        return {r["bucket"]: r["held"] for r in self.spark.read.schema("bucket int, held long").json(f"{self.path}/lists/{version}").collect()}

    def _read(self, held: dict[int, int]) -> DataFrame:
        folders = [f"{self.path}/rows/{n}/bucket={b}" for b, n in sorted(held.items())]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The table after a batch, by default the last complete one."""
        versions = self.versions()
        return self._read(self.held(version if version is not None else versions[-1] if versions else None))

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def merge(self, fresh: DataFrame, number: int, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Write batch `number`: combine(before, fresh) gives the rows of the touched buckets from what they held. Returns how many
        buckets were touched."""
        before = max((v for v in self.versions() if v < number), default=None)
        held = self.held(before)
        fresh = fresh.persist()
        touched = sorted(r[0] for r in fresh.select(self.bucket().alias("b")).distinct().collect())  # at most all buckets
        now = combine(self._read({b: held[b] for b in touched if b in held}), fresh).select(*self.schema.names)
        now = now.withColumn("bucket", self.bucket()).repartition(max(1, min(len(touched), self.spark.sparkContext.defaultParallelism)), "bucket")
        now.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/rows/{number}")
        place, files = self._folder(f"rows/{number}")
        filled = {int(s.getPath().getName().removeprefix("bucket=")) for s in files.listStatus(place) if s.getPath().getName().startswith("bucket=")}
        held = {b: n for b, n in held.items() if b not in touched} | dict.fromkeys(filled, number)
        rows = self.spark.createDataFrame(sorted(held.items()), "bucket int, held long")
        rows.coalesce(1).write.mode("overwrite").json(f"{self.path}/lists/{number}")
        fresh.unpersist()
        return len(touched)

    def upsert(self, fresh: DataFrame) -> int:
        """Fresh rows in place of stored ones of their keys, as the next version."""
        versions = self.versions()

        def replaced(before: DataFrame, new: DataFrame) -> DataFrame:
            return before.join(new.select(*self.keys), self.keys, "left_anti").unionByName(new.select(*before.columns))

        return self.merge(fresh, versions[-1] + 1 if versions else 0, replaced)

    def vacuum(self) -> list[int]:
        """Drop lists before the last and the batches that no bucket is held by any more; gives the numbers dropped."""
        versions = self.versions()
        needed = set(self.held(versions[-1]).values()) if versions else set()
        dropped = [v for v in versions[:-1] if v not in needed]
        for name in [*(f"lists/{v}" for v in versions[:-1]), *(f"rows/{v}" for v in dropped)]:
            place, files = self._folder(name)
            files.delete(place, True)
        return dropped


def into_table(stream: DataFrame, table: KeyedTable, checkpoint: str, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> StreamingQuery:
    """Merge a backlog into a table batch by batch, then stop. After a failure the last batch runs again under its number."""

    def write(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            table.merge(batch, number, combine)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
