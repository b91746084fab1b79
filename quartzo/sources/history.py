"""Dimension history that is kept up by batches of changes, in any order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartzo.operators.changes import scd2
from quartzo.operators.keys import latest_version
from quartzo.session import cut_lineage
from quartzo.sources.lake import read_or_empty


class History:
    """Spans of a dimension below ``path``, and the changes that they come from.

    Both lie in folders by a hash of the key. A batch reads and rewrites only folders that hold its keys, and works out
    anew only the spans of its keys; changes are only ever added. Keeping changes that altered nothing is what makes a late
    change right: it may split a span at a day on which the old value had been seen again.

    ``seq`` tells which of several changes of a key and day counts (the highest), whatever batch it came in; it is an
    attribute of the changes alone. A batch that is repeated under its number replaces itself.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, attrs: list[str], day: str, kinds: str, seq: str | None = None, buckets: int = 64):
        """``kinds``: the columns of a change with their types."""
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.attrs, self.day, self.seq, self.kinds, self.buckets = key, attrs, day, seq, kinds, buckets

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def changes(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/changes", f"{self.kinds}, batch bigint, bucket int")

    def _spans(self) -> DataFrame:
        names = {f.name: f.dataType.simpleString() for f in self.spark.createDataFrame([], self.kinds).schema}
        columns = ", ".join(f"`{c}` {names[c]}" for c in (self.key, *self.attrs))
        return read_or_empty(self.spark, f"{self.path}/spans", f"{columns}, valido_de date, valido_ate date, atual boolean, bucket int")

    def spans(self) -> DataFrame:
        return self._spans().drop("bucket")

    def rebuilt(self, changes: DataFrame) -> DataFrame:
        """Spans of the given changes, from nothing."""
        one = latest_version(changes.select(self.key, self.day, *self.attrs, *([self.seq] if self.seq else [])), [self.key, self.day], [self.seq] if self.seq else [])
        return scd2(one, self.key, self.attrs, self.day)

    def merge(self, changes: DataFrame, batch: int) -> list[int]:
        """Add a batch; returns the folders that were rewritten."""
        names = [f.name for f in self.spark.createDataFrame([], self.kinds).schema]
        came = cut_lineage(changes.select(*names).withColumn("bucket", self._bucket()))
        touched = sorted(r.bucket for r in came.select("bucket").distinct().collect())  # no more than there are folders
        if not touched:
            return []
        # first what came, then what follows from it: a merge that ends in between is repeated under the same number
        came.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{self.path}/changes/batch={batch}")
        keys = came.select(self.key).distinct()
        known = self.changes().filter(F.col("bucket").isin(touched)).join(keys, self.key, "left_semi")
        fresh = self.rebuilt(known).withColumn("bucket", self._bucket())
        kept = self._spans().filter(F.col("bucket").isin(touched)).join(keys, self.key, "left_anti")
        both = cut_lineage(kept.unionByName(fresh))  # the folders that are read are about to be replaced
        both.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{self.path}/spans")
        return touched
