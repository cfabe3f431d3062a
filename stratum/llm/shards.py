"""Contiguous shards of near-equal bytes from distributed prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import running_totals, stored

SHARDS = 8

#: A group of equal texts stays whole unless it is larger than this share of a shard.
WHOLE_GROUP = 1 / 64


def _cuts(placed: DataFrame, shards: int, total: int) -> list[int]:
    """The ``shards - 1`` offsets to cut at: equal targets, moved to the nearer end of a small group they fall into."""
    targets = [total * k // shards for k in range(1, shards)]
    straddles = F.lit(False)
    for t in targets:
        straddles = straddles | ((F.col("_start") < t) & (F.col("_start") + F.col("size") > t))
    groups = [r[0] for r in placed.where(straddles).select("_group").distinct().collect()]  # one per target at most
    spans = (
        placed.where(F.col("_group").isin(groups))
        .groupBy("_group")
        .agg(F.min("_start"), F.max(F.col("_start") + F.col("size")))
        .collect()
        if groups
        else []
    )
    cuts = []
    for t in targets:
        for _, start, end in spans:
            if start < t < end and (end - start) * shards <= total * WHOLE_GROUP:
                t = start if t - start <= end - t else end
                break
        cuts.append(t)
    return cuts


def sharded(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row; the sizes of the shards are near equal.

    A row's size is the UTF-8 bytes of its text plus 1.  Rows are ordered by the MD5 of their text, then by
    id, so equal texts stand together; shards are consecutive pieces of that order, cut at equal shares of
    the total, and slots number the rows of a shard in it.  Prefix sums come from totals per range; only
    one offset per shard passes through the driver.

    Null text counts as size 1 with the checksum of the empty text, before all other texts; null ids come
    first among equal texts.  Rows that agree in text and id are interchangeable.  A text larger than a
    shard makes neighbours smaller or empty.  An empty table gives an empty result.
    """
    text = F.col("text")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    rows = stored(
        documents.select(
            "doc_id", size.alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.coalesce(F.md5(text.cast("binary")), F.lit("")).alias("_group"), F.lit(1).alias("_one"),
        ),
        "sizes",
    )
    placed = stored(
        running_totals(rows, ["_group", "doc_id"], {"_start": "size", "_index": "_one"}, purpose="shard-order"),
        "shard-places",
    )
    total = placed.agg(F.sum("size")).first()[0] or 0
    shard: Column = F.lit(0)
    for cut in _cuts(placed, shards, total):
        shard = shard + (F.col("_start") >= cut).cast("int")
    dealt = placed.withColumn("shard", shard)
    firsts = dealt.groupBy("shard").agg(F.min("_index").alias("_first"))  # a row per shard
    return dealt.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_index") - F.col("_first")).alias("slot")
    )
