"""Global shuffle into shards by a two-pass external shuffle.

Pass 1 scatters whole records into buckets of about ``bucket_bytes`` by a seeded hash;
pass 2 puts each bucket in random order by a Fisher-Yates shuffle in memory.  The
buckets one after the other are a random order of all rows, and that order is dealt
out to the shards in turn, so their row counts are at most one apart.

Defined results
    NULL texts are empty.  Rows may repeat and keys may be NULL: every row gets a
    place of its own.  The same rows and seed give the same places, also when a task
    is run again.  Columns of the input that clash with a result column are replaced.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from statloom.llm.text import filled

BUCKET_BYTES = 32 << 20


def _order_in_bucket(seed: int):
    def shuffle(key: tuple, rows: pa.Table) -> pa.Table:
        # arrival order depends on the tasks before; start from a fixed one
        fixed = rows.sort_by([("_spread", "ascending"), ("_tie", "ascending")])
        places = np.arange(fixed.num_rows)
        bucket = zlib.crc32(f"{seed}:{key[0].as_py()}".encode())
        np.random.default_rng([seed, bucket]).shuffle(places)  # Fisher-Yates
        position = pa.array(np.arange(fixed.num_rows), pa.int64())
        return fixed.take(pa.array(places)).append_column("_in_bucket", position)

    return shuffle


def shuffled_shards(
    docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", seed: int = 17, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """All records with ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    own = ("shard", "slot", "_bucket", "_spread", "_tie", "_start", "_in_bucket")
    docs = docs.drop(*[c for c in own if c in docs.columns])
    total = docs.agg(F.sum(F.octet_length(filled(text)) + 1).alias("n")).first()["n"] or 0
    buckets = max(1, -(-int(total) // bucket_bytes))
    spread = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    marked = docs.withColumns({"_spread": spread, "_tie": F.xxhash64(F.col(text), F.col(key))})
    marked = marked.withColumn("_bucket", F.pmod("_spread", F.lit(buckets)))
    # one short row per bucket; blocks of buckets keep the running sum in many tasks
    counts = marked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("block", F.floor(F.col("_bucket") / 1000))
    blocks = counts.groupBy("block").agg(F.sum("n").alias("block_rows"))
    over_blocks = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("block_rows").over(over_blocks), F.lit(0)).alias("before"))
    inside = Window.partitionBy("block").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(blocks, "block")
    starts = starts.select("_bucket", (F.col("before") + F.col("inside")).alias("_start"))
    scattered = marked.join(starts, "_bucket")
    fields = [f for f in scattered.schema.fields] + [T.StructField("_in_bucket", T.LongType())]
    ordered = scattered.groupBy("_bucket").applyInArrow(_order_in_bucket(seed), T.StructType(fields))
    place = F.col("_start") + F.col("_in_bucket")
    return ordered.withColumns({"shard": F.pmod(place, F.lit(shards)).cast("int"), "slot": F.floor(place / F.lit(shards)).cast("long")}).drop(
        "_bucket", "_spread", "_tie", "_start", "_in_bucket"
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; each bucket's task writes its part in slot order."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)
