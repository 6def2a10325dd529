"""The distinct values of a source, dealt out to buckets by hash.

A version adds to a bucket by a directory of its own that holds the new values only. Once a bucket has gathered ``merge_after`` directories, the
version that adds the next one writes the bucket whole instead. Which directories make up each bucket is told by a small list that
every version writes, so a reader opens those and nothing else, and a batch's values meet only the buckets they fall into.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.distinctness import VALUES_SCHEMA, unseen_values
from .log import Files

BUCKETS = 16
MERGE_AFTER = 8                 # directories of a bucket

Manifest = dict[int, list[str]]


class ValueBuckets:
    """``place(version)`` is the folder of a version below ``root``."""

    def __init__(self, spark: SparkSession, root: str, place: Callable[[int], str], buckets: int = BUCKETS, merge_after: int = MERGE_AFTER):
        self.spark, self.root, self.place, self.buckets, self.merge_after = spark, root, place, buckets, merge_after
        self.files = Files(spark)

    def _list(self, version: int) -> str:
        return f"{self.root}/source_distinct_lists/{self.place(version)}.json"

    def manifest(self, version: int) -> Manifest:
        """Directories of each bucket after a version; a bucket without values is not in it."""
        if version == 0 or not self.files.exists(self._list(version)):
            return {}
        found = json.loads(self.files.read(self._list(version)))
        self.buckets = found["buckets"]
        return {int(b): folders for b, folders in found["folders"].items()}

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("attribute", "value"), F.lit(self.buckets)).cast("int")

    def _read(self, folders: Iterable[str]) -> DataFrame:
        paths = [f"{self.root}/{f}" for f in folders]
        return self.spark.read.schema(VALUES_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], VALUES_SCHEMA)

    def values(self, version: int, buckets: Iterable[int] | None = None) -> DataFrame:
        """``attribute, value`` of all buckets, or of the given ones."""
        found = self.manifest(version)
        return self._read(f for b in sorted(found) if buckets is None or b in buckets for f in found[b])

    def _written(self, values: DataFrame, table: str, version: int) -> tuple[str, list[int]]:
        """Writes values by bucket; returns the folder and the buckets that have some. A large bucket is split over tasks."""
        folder = f"{table}/{self.place(version)}"
        dealt = values.select("attribute", "value", self.bucket().alias("bucket")).hint("rebalance", "bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/{folder}")
        return folder, [int(n.split("=")[1]) for n in self.files.names(f"{self.root}/{folder}") if n.startswith("bucket=")]

    def unseen(self, batch: DataFrame, version: int) -> DataFrame:
        """Those of a batch's distinct values that the versions before ``version`` do not hold."""
        known = self.manifest(version - 1)
        if not known:
            return batch
        folder, touched = self._written(batch, "batch_values", version)
        current = self._read([f"{folder}/bucket={b}" for b in touched])
        return unseen_values(current, self.values(version - 1, set(touched)))

    def add(self, added: DataFrame, version: int) -> None:
        """Store the values that a version is the first to show."""
        known = self.manifest(version - 1)
        folder, touched = self._written(added, "source_distinct_values", version)
        lists = {b: list(f) for b, f in known.items()}
        for b in touched:
            lists.setdefault(b, []).append(f"{folder}/bucket={b}")
        full = [b for b in touched if len(lists[b]) > self.merge_after]
        if full:
            merged, _ = self._written(self._read(f for b in full for f in lists[b]), "source_distinct_merged", version)
            lists |= {b: [f"{merged}/bucket={b}"] for b in full}
        self.files.write(self._list(version), json.dumps({"buckets": self.buckets, "folders": lists}))

    def added(self, version: int) -> DataFrame:
        """Values that a version was the first to show."""
        folder = f"source_distinct_values/{self.place(version)}"
        return self._read(f"{folder}/{n}" for n in self.files.names(f"{self.root}/{folder}") if n.startswith("bucket="))
