"""A keyed table in hash buckets: merges rewrite the touched buckets, reads open the wanted ones.

Layout under ``path``: ``data/<load>/bucket=<b>`` holds the rows that a load wrote, sorted by key
within each file; ``manifest/<load>`` is a table with a row per bucket (the load that wrote it,
its rows, its least and greatest key); ``versions/<n>`` names the load of version n. A load becomes
visible by creating its version file, which is one step, and fails if another load has created
it meanwhile (where the file system renames without replacing; one writer at a time elsewhere).
Readers take the greatest version, so a load that was stopped leaves nothing
that they see.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from enrichkit.operators.joins import skew_aware_join
from enrichkit.operators.keyed import keep_last

#: Wanted keys up to this number are sent to the scan as a filter; more are joined.
FEW_KEYS = 1000
_BUCKET, _NEW = "__bucket", "__new"


def _paths(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


@dataclass(frozen=True)
class KeyedTable:
    """The table at ``path``: rows of ``schema``, one per ``key`` (one column), in ``n_buckets``
    buckets. The manifest has a row per bucket, so ``n_buckets`` bounds what a driver reads of
    it. Give the same values to every use of one path."""

    spark: SparkSession
    path: str
    key: str
    schema: StructType
    n_buckets: int = 64

    def version(self) -> int:
        """The greatest version, 0 for a table without a load."""
        fs, at = _paths(self.spark, f"{self.path}/versions")
        return max((int(x.getPath().getName()) for x in fs.listStatus(at)), default=0) if fs.exists(at) else 0

    def _bucket(self) -> Column:
        kind = self.schema[self.key].dataType
        return F.pmod(F.xxhash64(F.col(f"`{self.key}`").cast(kind)), F.lit(self.n_buckets)).cast("int")

    def _manifest(self, version: int) -> list:
        if version == 0:
            return []
        load = self.spark.read.text(f"{self.path}/versions/{version}").first()[0]
        return self.spark.read.parquet(f"{self.path}/manifest/{load}").collect()  # a row per bucket

    def _rows(self, entries: list) -> DataFrame:
        """The rows of the buckets of these manifest entries; no other file is listed or read."""
        folders = [f"{self.path}/data/{e.load}/bucket={e.bucket}" for e in entries]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self) -> DataFrame:
        """All rows of the greatest version."""
        return self._rows(self._manifest(self.version()))

    def merge(self, df: DataFrame, order_cols: list[str] | None = None) -> int:
        """Add the rows of ``df``; a row replaces the stored one with its key, and of rows of
        ``df`` with one key the last by ``order_cols`` stays (ties: the greatest other columns).
        Rows with a null key are left out. Returns the new version.

        Only buckets that ``df`` has keys of are read and written again, in files sorted by
        bucket and key; the others' files stay as they are. ``order_cols`` that are not in the
        table's schema are used for the order only.
        """
        version = self.version()
        names = [f.name for f in self.schema.fields]
        fresh = df.where(F.col(f"`{self.key}`").isNotNull())
        fresh = keep_last(fresh, self.key, order_cols or []).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])
        fresh = fresh.withColumn(_BUCKET, self._bucket())
        load = f"{version + 1}-{uuid.uuid4().hex}"  # its own folders: nothing of a stopped load is in them
        new = f"{self.path}/data/{load}"
        fresh.write.mode("overwrite").parquet(f"{new}/_fresh")  # read twice: for the buckets and the merge
        fresh = self.spark.read.parquet(f"{new}/_fresh")
        touched = {r[0] for r in fresh.select(_BUCKET).distinct().collect()}  # at most n_buckets numbers
        manifest = self._manifest(version)
        old = self._rows([e for e in manifest if e.bucket in touched]).withColumn(_BUCKET, self._bucket())
        both = old.withColumn(_NEW, F.lit(False)).unionByName(fresh.withColumn(_NEW, F.lit(True)))
        merged = keep_last(both, [_BUCKET, self.key], [_NEW]).select(*names, F.col(_BUCKET).alias("bucket"))
        # Ranges of (bucket, key): a large bucket becomes several files, a file holds few buckets.
        ordered = merged.repartitionByRange("bucket", F.col(f"`{self.key}`")).sortWithinPartitions("bucket", F.col(f"`{self.key}`"))
        writer = ordered.write.mode("append").partitionBy("bucket").option(f"parquet.bloom.filter.enabled#{self.key}", "true")
        writer.parquet(new)
        own = self._written(new, sorted(touched))
        kept = [(e.bucket, e.load, e.rows, e.least, e.greatest) for e in manifest if e.bucket not in touched]
        entries = kept + [(r.bucket, load, r.rows, r.least, r.greatest) for r in own]
        kind = self.schema[self.key].dataType.simpleString()
        frame = self.spark.createDataFrame(entries, f"bucket int, load string, rows bigint, least {kind}, greatest {kind}")
        frame.coalesce(1).write.parquet(f"{self.path}/manifest/{load}")
        self._publish(version + 1, load)
        return version + 1

    def _publish(self, version: int, load: str) -> None:
        """Creates the version's file whole, by renaming; fails if another load was first."""
        fs, at = _paths(self.spark, f"{self.path}/versions/{version}")
        _, draft = _paths(self.spark, f"{self.path}/drafts/{load}")
        out = fs.create(draft, False)
        out.write(bytearray(load.encode()))
        out.close()
        fs.mkdirs(at.getParent())
        if fs.exists(at) or not fs.rename(draft, at):
            raise RuntimeError(f"version {version} of {self.path} was written by another load; merge again")

    def _written(self, new: str, touched: list[int]) -> list:
        if not touched:
            return []
        schema = StructType([*self.schema.fields, StructField("bucket", IntegerType())])
        rows = self.spark.read.schema(schema).option("basePath", new).parquet(*[f"{new}/bucket={b}" for b in touched])
        key = F.col(f"`{self.key}`")
        return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("least"), F.max(key).alias("greatest")).collect()

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """The stored rows of the keys in ``keys[key]``, each once.

        Buckets without a wanted key, or whose bounds hold none, are not read. Up to
        ``FEW_KEYS`` keys go to the scan as a filter, which skips row groups by the sorted
        files' bounds and Bloom filters; more are joined.
        """
        kind = self.schema[self.key].dataType
        wanted = keys.select(F.col(f"`{self.key}`").cast(kind).alias(self.key)).where(F.col(f"`{self.key}`").isNotNull()).distinct()
        wanted = wanted.withColumn(_BUCKET, self._bucket())
        few = wanted.limit(FEW_KEYS + 1).collect()
        manifest = {e.bucket: e for e in self._manifest(self.version())}
        if len(few) <= FEW_KEYS:
            hit = {r[1] for r in few if r[1] in manifest and manifest[r[1]].least <= r[0] <= manifest[r[1]].greatest}
            values = [r[0] for r in few if r[1] in hit]
            return self._rows([manifest[b] for b in sorted(hit)]).where(F.col(f"`{self.key}`").isin(values))
        key = F.col(f"`{self.key}`")
        bounds = wanted.groupBy(_BUCKET).agg(F.min(key).alias("a"), F.max(key).alias("b")).collect()  # a row per bucket
        hit = [manifest[r[0]] for r in bounds if r[0] in manifest and r.a <= manifest[r[0]].greatest and r.b >= manifest[r[0]].least]
        return self._rows(hit).join(wanted.select(self.key), self.key, "left_semi")

    def enrich(self, df: DataFrame, how: str = "left") -> DataFrame:
        """The rows of ``df`` with the stored columns of their key."""
        return skew_aware_join(df, self.rows_of(df), [self.key], how)
