"""Substitute ids on a stream: every key gets its id once over all micro-batches.

Each micro-batch is a get-or-create run against a store that is partitioned by micro-batch. A
batch's new ids are committed before its rows are written, both in folders of the batch's own
number, and a batch that runs again after a failure takes the ids that it has committed, so
every reader sees one id a key. Ids are created per distinct key (reduced map-side), so a key
that holds a large share of a batch is no hot group, and a sequence goes on without gaps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from enrichkit.operators.ids import dense_ids, known_ids, new_ids
from enrichkit.operators.joins import skew_aware_join
from enrichkit.streaming.dns import DEFAULT_TRIGGER

_EPOCH = "epoch_id"
_BEFORE = -1  # the folder of the ids that existed before the stream


def create_id_store(lookup: DataFrame, store_path: str, key: str, out: str = "deid") -> None:
    """A store for ``start_id_stream`` that holds the ids of ``lookup`` (an empty one is fine)."""
    lookup.select(key, out).write.mode("errorifexists").parquet(f"{store_path}/{_EPOCH}={_BEFORE}")


def _committed(spark: SparkSession, path: str) -> bool:
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def id_batches(
    store_path: str, out_path: str, key: str, *, mode: str = "hash", out: str = "deid", salt: str = "", how: str = "left"
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of ``start_id_stream``.

    For a sequence, the number that the next id will have is kept beside the store for each
    batch (``_next``), so no batch looks for the greatest id among all.
    """

    def assign(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        # Partitions of later batches, as after a restart from an older checkpoint, don't count.
        store = spark.read.option("basePath", store_path).parquet(store_path)
        lookup = store.where(F.col(_EPOCH) < epoch).select(key, out)
        mine, counters = f"{store_path}/{_EPOCH}={epoch}", f"{store_path}/_next"
        state = known_ids(batch, lookup, key, out)
        if not _committed(spark, mine):
            missing = state.where(F.col(out).isNull()).select(key)
            if mode == "sequence":
                before = _next_id(spark, counters, epoch)
                if before is None:
                    before = (lookup.agg(F.max(out)).first()[0] or 0) + 1
                created = dense_ids(missing, key, before, out)
                after = [(epoch, before + missing.count())]
                counter = spark.createDataFrame(after, f"{_EPOCH} bigint, next bigint").coalesce(1)
                counter.write.mode("overwrite").parquet(f"{counters}/of={epoch}")
            else:
                created = new_ids(missing, key, mode, out, lookup, salt)
            created.select(key, out).write.mode("overwrite").parquet(mine)
        created = spark.read.schema(state.schema).parquet(mine)
        mapping = state.where(F.col(out).isNotNull()).unionByName(created)
        enriched = skew_aware_join(batch, mapping, [key], how)
        enriched.write.mode("overwrite").parquet(f"{out_path}/{_EPOCH}={epoch}")

    return assign


def _next_id(spark: SparkSession, counters: str, epoch: int) -> int | None:
    if epoch == 0:
        return None
    kept = spark.read.parquet(f"{counters}/of={epoch - 1}")
    return kept.first()["next"]


def start_id_stream(
    events: DataFrame,
    *,
    store_path: str,
    out_path: str,
    checkpoint_location: str,
    key: str,
    mode: str = "hash",
    out: str = "deid",
    salt: str = "",
    how: str = "left",
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start a stream that gives every row of ``events`` the id of its key and creates the ids of
    new keys (``mode``: ``hash`` with a salt, ``uuid`` or ``sequence``).

    Rows go to ``out_path`` and new ids to ``store_path`` (see ``create_id_store``), each in
    folders by micro-batch. The store and ``checkpoint_location`` belong together: a new
    checkpoint needs a new store, made from the old one's ids. Rows with a null key have no id
    (``how="inner"`` drops them). One stream writes a store.
    """
    writer = events.writeStream.foreachBatch(id_batches(store_path, out_path, key, mode=mode, out=out, salt=salt, how=how))
    writer = writer.option("checkpointLocation", checkpoint_location).trigger(**(trigger or DEFAULT_TRIGGER))
    return (writer.queryName(query_name) if query_name else writer).start()
