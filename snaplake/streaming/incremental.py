"""ST-01: incremental load -- new lake files go once through insert-if-absent.

The daily schedule becomes a file stream run with ``availableNow``: each trigger picks up
only files not yet recorded in the checkpoint, and ``foreachBatch`` hands each micro-batch
to ``insert_if_absent``.  A replayed batch (after a failure between write and commit)
inserts nothing twice, because every key it carries is already stored.

``ingest_with_state`` does the same without a look at the stored rows: a state store holds the keys
that were loaded, as the warehouse's key index does, and the file sink writes each row once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from snaplake import schemas
from snaplake.operators.load import insert_if_absent, reconcile, reject_null_keys


def ingest_available(spark: SparkSession, source_dir: str, schema: StructType,
                     table_path: str, checkpoint: str, keys: Sequence[str],
                     partition_col: str, order: Sequence[Column] | None = None,
                     prepare=None, max_files_per_trigger: int | None = None,
                     fmt: str = "parquet") -> StreamingQuery:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_dir)

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        # One column of the files tells the days: only stored ones are compared with.
        days = [r[0] for r in rows.select(partition_col).distinct().collect()]
        insert_if_absent(rows, table_path, keys=keys, partition_col=partition_col,
                         order=order, days=days)

    q = stream.writeStream.foreachBatch(load_batch) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def ingest_lake(spark: SparkSession, source_dir: str, schema: StructType, dataset: str,
                table_path: str, checkpoint: str, **options) -> StreamingQuery:
    """New files of the lake into the raw table ``dataset``: LOAD-01..04 on each micro-batch, then
    the first row of a key by its arrival in the batch, and none of a key that is stored."""
    return ingest_available(spark, source_dir, schema, table_path, checkpoint,
                            keys=schemas.RAW_KEYS, partition_col=schemas.PARTITION_COLUMN,
                            prepare=lambda batch: reconcile(batch, dataset), **options)


def _place(arrival: str = schemas.ARRIVAL) -> Column:
    """The arrival as text that sorts alike."""
    part = lambda name, n: F.lpad(F.col(f"{arrival}.{name}").cast("string"), n, "0")
    return F.concat_ws("|", part("year", 10), part("page", 10), F.col(f"{arrival}.file"),
                       part("block", 20), part("pos", 10))


#: Hash buckets of a day's and source's keys; a bucket's ids are one value of the state.
STATE_BUCKETS = 2048


def _first_of_bucket(group, frames: Iterator[pd.DataFrame],
                     state: GroupState) -> Iterator[pd.DataFrame]:
    """The first row, by place and then text, of each id of the bucket that isn't in its state."""
    loaded = np.frombuffer(state.get[0] if state.exists else b"", dtype=np.int64)
    first = None
    for f in frames:
        f = f.loc[~np.isin(f["key"].to_numpy(), loaded), ["key", "place", "body"]]
        if len(f):
            rows = f if first is None else pd.concat([first, f])
            first = rows.sort_values(["key", "place", "body"]).drop_duplicates("key")
    if first is not None:
        state.update((np.sort(np.concatenate([loaded, first["key"].to_numpy()])).tobytes(),))
        yield first[["body"]].reset_index(drop=True)


def ingest_with_state(spark: SparkSession, source_dir: str, schema: StructType, dataset: str,
                      table_path: str, checkpoint: str, max_files_per_trigger: int | None = None,
                      fmt: str = "parquet") -> StreamingQuery:
    """New files of the lake into the raw table ``dataset``, the first row of a key to arrive kept:
    of a micro-batch the one that stood first in the responses, and none of a key that an earlier
    batch had.  The state is the sorted ids ever loaded of each (day, source, hash bucket), so a
    batch touches the state of its own days alone and Python is called once a bucket, not once a
    key.  It never expires, so no row is late; it belongs on disk
    (``spark.sql.streaming.stateStore.providerClass``: RocksDB) where keys are many.  A row travels
    through the state as one JSON text, so Python changes none of its values."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    target, keys = schemas.RAW_TABLES[dataset], list(schemas.RAW_KEYS)
    key, *rest = keys
    rows = reject_null_keys(reconcile(reader.load(source_dir), dataset), keys)
    packed = rows.select(
        *rest, F.pmod(F.xxhash64(key), F.lit(STATE_BUCKETS)).alias("bucket"),
        F.col(key).cast("long").alias("key"), _place().alias("place"),
        F.to_json(F.struct(*target.fieldNames())).alias("body"))
    kept = packed.groupBy(*rest, "bucket").applyInPandasWithState(
        _first_of_bucket, "body string", "loaded binary", "append", GroupStateTimeout.NoTimeout)
    out = kept.select(F.from_json("body", target).alias("r")).select("r.*")
    q = out.writeStream.format("parquet").partitionBy(schemas.PARTITION_COLUMN) \
        .option("path", table_path).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return q
