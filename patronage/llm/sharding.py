"""Weighted rendezvous sharding, in DataFrame functions only.

Every shard bids for every record by a hash of the record's key and the shard's number, and
the highest bid wins. A further shard wins only the records for which it bids highest, so no
record moves between the old shards; a shard with twice the weight gets twice the records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BID_DIGITS = 13    # hex digits of the hash that make a bid
BUCKETS = 4096     # pieces of a shard that are numbered on their own


def bid(key: Column, shard: int, weight: float) -> Column:
    """weight / -ln(u), where u in (0, 1) is a hash of the key and the shard."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, BID_DIGITS)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16 ** BID_DIGITS))
    return F.lit(float(weight)) / -F.log(u)


def winner(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard with the highest bid; the lower number wins a tie."""
    bids = [F.struct(bid(key, i, w).alias("bid"), F.lit(-i).alias("n")) for i, w in enumerate(weights)]
    return (-(F.greatest(*bids)["n"] if len(bids) > 1 else bids[0]["n"])).cast("int")


def sharded(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """docs with size, text_crc32, law, shard, slot, grown_shard (names that clash are replaced).

    The key is the id; null ids share one key. Size is the UTF-8 length plus one, null texts
    have crc32 0. Slots number the rows of a shard from 0 without gaps, by a hash bucket of id
    and text, then id, then checksum: rows of a bucket are numbered within it, and buckets
    start where those before them end. The table of bucket sizes has at most shards x BUCKETS
    rows, so it is broadcast; no task sees a whole shard.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    crc = F.crc32(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.withColumns({
        "size": F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1,
        "text_crc32": crc, "law": F.lit("key"), "shard": winner(key, weights),
        "grown_shard": winner(key, grown if grown is not None else [*weights, 1.0]),
        "_bucket": F.conv(F.substring(F.md5(F.concat(key, F.lit("/"), crc.cast("string"))), 1, 3), 16, 10).cast("int")})
    sizes = rows.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("shard").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    place = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy(F.col(id_col), "text_crc32", "size")) - 1
    return (rows.withColumn("_place", place)
            .join(F.broadcast(starts), (F.col("shard") == F.col("_s")) & (F.col("_bucket") == F.col("_b")))
            .withColumn("slot", (F.col("_from") + F.col("_place")).cast("long"))
            .drop("_place", "_from", "_bucket", "_s", "_b"))
