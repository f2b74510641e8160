"""A table of documents or labels with one row for each key.

Rows lie in buckets by a hash of the key. A write says what happens to a key
that is there already: ``skip`` keeps the stored row, ``overwrite`` takes the new
one, ``fail`` stops before anything is written. Only the buckets that the new
keys touch are written again, into a folder of this write; a manifest (a small
table: bucket, folder, rows) then names each bucket's folder. A reader takes the
newest complete manifest, so a write that fails, or is repeated after lost
executors, leaves the store as it was. Counting reads the manifest only.

Rows of one write that share a key: the greatest row (in the order of its columns
as JSON) stays for ``overwrite`` and ``skip``; ``fail`` refuses them. Rows with a
null key are rejected with an error. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import is_complete, path_exists

POLICIES = ("skip", "overwrite", "fail")
MANIFEST = "bucket int, folder string, n long"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete manifests of a store, rising."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifests")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(int(n) for n in names if n.isdigit() and is_complete(spark, f"{path}/manifests/{n}"))


def newest(spark: SparkSession, path: str, schema: str) -> list:
    """Rows of the newest complete manifest."""
    numbers = versions(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/manifests/{numbers[-1]}").collect() if numbers else []


def commit(spark: SparkSession, path: str, rows: list, schema: str) -> None:
    """Write the next manifest; it counts once it is complete."""
    number = (versions(spark, path) or [0])[-1] + 1
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifests/{number}")


class KeyedStore:
    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 32):
        """Open the store at ``path`` or, if there is none, make one with that many buckets."""
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        if path_exists(spark, f"{self.path}/layout"):
            row = spark.read.parquet(f"{self.path}/layout").first()
            if row["key"] != key:
                raise ValueError(f"this store is keyed by {row['key']!r}")
            buckets = row["buckets"]
        else:
            spark.createDataFrame([(key, buckets)], "key string, buckets int").coalesce(1).write.parquet(f"{self.path}/layout")
        self.buckets = buckets

    def manifest(self) -> dict[int, tuple[str, int]]:
        """bucket -> (folder, rows) of the newest write; at most ``buckets`` entries."""
        return {r["bucket"]: (r["folder"], r["n"]) for r in newest(self.spark, self.path, MANIFEST)}

    def _commit(self, entries: dict[int, tuple[str, int]]) -> None:
        commit(self.spark, self.path, [(b, f, n) for b, (f, n) in sorted(entries.items())], MANIFEST)

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def _read(self, entries: dict[int, tuple[str, int]]) -> DataFrame | None:
        paths = [f"{folder}/bucket={b}" for b, (folder, n) in sorted(entries.items()) if n]
        return self.spark.read.parquet(*paths) if paths else None

    def rows(self) -> DataFrame | None:
        """All rows, or None if nothing was ever written."""
        return self._read(self.manifest())

    def count(self) -> int:
        return sum(n for _, n in self.manifest().values())

    def write(self, df: DataFrame, on_repeat: str = "fail") -> dict[str, int]:
        """Merge ``df``; returns how many keys were new and how many were there already, and the buckets written."""
        if on_repeat not in POLICIES:
            raise ValueError(f"on_repeat is one of {POLICIES}")
        if df.where(F.col(self.key).isNull()).limit(1).count():
            raise ValueError(f"rows without {self.key}")
        names = df.columns
        whole = F.struct(*names)
        packed = df.groupBy(self.key).agg(F.max(F.struct(F.to_json(whole).alias("o"), whole.alias("r"))).alias("m"), F.count(F.lit(1)).alias("n"))
        if on_repeat == "fail" and packed.where("n > 1").limit(1).count():
            raise ValueError(f"several rows with one {self.key}")
        new = packed.select("m.r.*").withColumn("bucket", self._bucket())
        touched = [r[0] for r in new.select("bucket").distinct().collect()]  # at most `buckets`
        entries = self.manifest()
        old = self._read({b: entries[b] for b in touched if b in entries})
        repeated = 0
        if old is not None:
            repeated = new.join(old.select(self.key), self.key, "left_semi").count()
            if repeated and on_repeat == "fail":
                raise ValueError(f"{repeated} of the keys are in the store")
            first, second = (new, old) if on_repeat == "overwrite" else (old, new)
            both = first.drop("bucket").unionByName(second.drop("bucket").join(first.select(self.key), self.key, "left_anti"), allowMissingColumns=True)
            merged = both.withColumn("bucket", self._bucket())
        else:
            merged = new
        if not touched:
            return {"new": 0, "repeated": 0, "buckets": 0}
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        merged.repartition(min(len(touched), self.buckets), "bucket").write.partitionBy("bucket").parquet(folder)
        counts = dict(self.spark.read.parquet(folder).groupBy("bucket").count().collect())
        self._commit(entries | {b: (folder, counts.get(b, 0)) for b in touched})
        before = sum(entries[b][1] for b in touched if b in entries)
        return {"new": sum(counts.values()) - before, "repeated": repeated, "buckets": len(touched)}

    def clear(self) -> None:
        """Forget all rows; the store stays."""
        self._commit({})

    def vacuum(self) -> int:
        """Delete folders and manifests that the newest manifest does not need; returns how many folders went."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = hadoop(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        used = {f for f, _ in self.manifest().values()}
        for number in versions(self.spark, self.path)[:-1]:
            fs.delete(hadoop(f"{self.path}/manifests/{number}"), True)
        root, gone = hadoop(f"{self.path}/data"), 0
        for status in fs.listStatus(root) if fs.exists(root) else []:
            if f"{self.path}/data/{status.getPath().getName()}" not in used:
                fs.delete(status.getPath(), True)
                gone += 1
        return gone
