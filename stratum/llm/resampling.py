"""Importance resampling towards a target: weights from hashed features, winners by distributed quickselect."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import arrow_batches, running_totals, stored

#: Buckets of features, percent of the eligible documents drawn, words an eligible document has at least, the draw.
BUCKETS, PERCENT, LEAST_WORDS, SEED = 10_000, 10, 20, 2024

#: Pivots per round of the selection: a round leaves about one part in so many of the rows in question.
PIVOTS = 16

# Every byte to what it is in a word: letters in lower case, digits and bytes beyond ASCII; others divide words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def buckets_of(text: bytes, n_buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of each word of a text, in order."""
    words = text.translate(_WORD_BYTES).split()
    return (np.array([zlib.crc32(w) for w in words], np.uint32) % np.uint32(n_buckets)).astype(np.uint16)


def hashed(texts: DataFrame, n_buckets: int = BUCKETS) -> DataFrame:
    """Rows of ``text`` with ``n_features`` and ``buckets`` (16-bit numbers, packed) in its place."""
    if not 0 < n_buckets <= 65536:
        raise ValueError("buckets have 16-bit numbers")
    own = [f for f in texts.schema.fields if f.name != "text"]
    schema = T.StructType([*own, T.StructField("n_features", T.LongType()), T.StructField("buckets", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [buckets_of(t or b"", n_buckets) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            kept = [batch.column(f.name) for f in own]
            sizes, packed = pa.array([len(b) for b in found], pa.int64()), pa.array([b.tobytes() for b in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*kept, sizes, packed], schema.fieldNames())

    return arrow_batches(texts).mapInArrow(run, schema)


def bucket_counts(rows: DataFrame, n_buckets: int = BUCKETS) -> np.ndarray:
    """How many features each bucket has over all ``rows``; a task sends one row per bucket it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            packed = b"".join(batch.column("buckets").to_pylist())
            total += np.bincount(np.frombuffer(packed, np.uint16), minlength=n_buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["bucket", "n"])

    sums = rows.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(n_buckets, np.int64)
    for r in sums.collect():  # at most n_buckets rows
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandfold log likelihood ratio of target and source per bucket, with one feature more in each."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), float(len(source))
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def _noise(seed: int) -> Column:
    """Gumbel noise in thousandths, from the id alone; a null id counts as an empty one."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def scored(rows: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """Add ``weight``, the floored mean gain of a row's features (0 without any), and ``score``, with the noise."""
    schema = T.StructType([*[f for f in rows.schema.fields if f.name != "buckets"], T.StructField("weight", T.LongType())])
    kept = [c for c in rows.columns if c != "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("buckets").to_pylist()
            sizes = np.array([len(b) // 2 for b in packed], np.int64)
            ends = np.cumsum(sizes)
            sums = np.concatenate([[0], np.cumsum(gain[np.frombuffer(b"".join(packed), np.uint16)])])
            weight = (sums[ends] - sums[ends - sizes]) // np.maximum(sizes, 1)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(weight, pa.int64())], schema.fieldNames())

    return rows.mapInArrow(run, schema).withColumn("score", (F.col("weight") + _noise(seed)).cast("long"))


@dataclass(frozen=True)
class Order:
    """A total order of rows: integer columns, ascending, nulls first; the last one is unique."""

    columns: tuple[str, ...]

    def before(self, key: tuple) -> Column:
        """Rows strictly before the row with this key."""
        out = F.lit(False)
        for c, v in reversed(list(zip(self.columns, key, strict=True))):
            less = F.lit(False) if v is None else F.col(c).isNull() | (F.col(c) < F.lit(v))
            out = less | (F.col(c).eqNullSafe(F.lit(v).cast("long")) & out)
        return F.coalesce(out, F.lit(False))

    def at(self, key: tuple) -> Column:
        out = F.lit(True)
        for c, v in zip(self.columns, key, strict=True):
            out = out & F.col(c).eqNullSafe(F.lit(v).cast("long"))
        return out


def kth(rows: DataFrame, order: Order, k: int, pivots: int = PIVOTS) -> tuple:
    """Key of the row with ``k`` rows before it, for 0 <= k < number of rows.

    Each round draws pivot keys by a hash of the key from the rows still in question, counts in one pass the rows
    before each of them and those equal to it, and goes on between the two pivots that enclose the place, until a
    pivot is the row.  Only pivots and their counts reach the driver.
    """
    low = high = None  # rows in question are after low and before high
    below = 0  # rows up to and with low
    for attempt in range(10_000):
        open_ = rows
        if low is not None:
            open_ = open_.where(~order.before(low) & ~order.at(low))
        if high is not None:
            open_ = open_.where(order.before(high))
        drawn = open_.orderBy(F.xxhash64(F.lit(attempt), *order.columns), *order.columns).limit(pivots).collect()
        keys = [tuple(r[c] for c in order.columns) for r in drawn]
        counts = open_.agg(
            *[F.count_if(order.before(key)).alias(f"b{i}") for i, key in enumerate(keys)],
            *[F.count_if(order.at(key)).alias(f"e{i}") for i, key in enumerate(keys)],
        ).first()
        found = sorted((below + counts[f"b{i}"], below + counts[f"b{i}"] + counts[f"e{i}"], i) for i in range(len(keys)))
        for first, end, i in found:
            if first <= k < end:
                return keys[i]
            if end <= k:
                low, below = keys[i], end
            elif first > k:
                high = keys[i]
                break
    raise RuntimeError("the rows change from one pass to the next")


def resampled(
    documents: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, n_buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``documents``, ranked where it is drawn.

    A row's features are its words, by hashed bucket; ``weight`` is the mean log ratio of their frequencies in
    ``target`` and ``documents``, and ``score`` adds noise from the id.  Of the rows with ``least_words`` words, the
    given percent with the highest scores are drawn; ties go to the smaller id (null first), then to fewer features.
    Null and empty texts have no features and weight 0.  Repeated rows count, and are drawn, one by one: their ids are
    the same and so are their scores.  Empty tables give an empty result, an empty target equal gains but for
    smoothing.  Other columns are not read.

    Texts are read once: what is kept of them is two bytes a word.
    """
    rows = stored(
        hashed(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), n_buckets), "hashed"
    )
    source = bucket_counts(rows, n_buckets)
    wanted = bucket_counts(hashed(target.select("text"), n_buckets), n_buckets)
    numbered = scored(rows, gains(source, wanted), seed).withColumn("_row", F.monotonically_increasing_id())
    table = stored(numbered.withColumn("_back", -F.col("score")), "scored")
    order = Order(("_back", "doc_id", "n_features", "_row"))
    eligible = table.where(F.col("n_features") >= least_words)
    draw = eligible.count() * percent // 100
    out = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if draw == 0:
        return table.select(*out, none)
    last = kth(eligible, order, draw - 1)
    wins = (F.col("n_features") >= least_words) & (order.before(last) | order.at(last))
    winners = table.where(wins).withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(winners, list(order.columns), {"_earlier": "_one"}, purpose="winners")
    return ranked.select(*out, (F.col("_earlier") + 1).alias("rank")).unionByName(table.where(~wins).select(*out, none))
