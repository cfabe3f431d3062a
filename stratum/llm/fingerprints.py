"""Document fingerprints: threshold-scaled sketches of word shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import running_totals, shingle_hashes, stored, words

SHINGLE = 5

#: One shingle hash in so many is retained: of passages of 30 words, all but one in 1,700 keep one.
SCALE = 4


def with_sketch(rows: DataFrame, text: str, name: str, width: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """Add the sketch of a text column: all shingle hashes below a fixed fraction of the hash range, sorted.

    If none is below it, the smallest one is retained, so only a text without words has an empty sketch.
    Null counts as empty.  The sketch of several texts together is the ``merge`` of their sketches.
    """
    limit = -(2**63) + 2**64 // scale
    # One column per step: a lambda evaluates what it refers to for every element, unless that is a column.
    steps = (
        rows.withColumn("_words", words(F.col(text)))
        .withColumn("_hashes", shingle_hashes(F.col("_words"), width))
        .withColumn("_below", F.filter("_hashes", lambda h: h < F.lit(limit)))
    )
    hashes, below = F.col("_hashes"), F.col("_below")
    found = F.when(F.size(below) > 0, F.sort_array(F.array_distinct(below))).otherwise(F.array(F.array_min(hashes)))
    return steps.withColumn(name, F.when(F.size(hashes) == 0, hashes).otherwise(found)).drop("_words", "_hashes", "_below")


def merge(a: Column, b: Column) -> Column:
    return F.sort_array(F.array_union(a, b))


def _shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has, however unequal the two are; 0 for an empty one."""
    return F.when(F.size(a) == 0, 0.0).otherwise(_shared(a, b) / F.greatest(F.size(a), F.lit(1)))


def likeness(a: Column, b: Column) -> Column:
    """The larger of the two containments: 1 for equal sketches, 0 if nothing is shared or just one is empty."""
    smaller = F.least(F.size(a), F.size(b))
    return F.when(a == b, 1.0).when(smaller == 0, 0.0).otherwise(_shared(a, b) / F.greatest(smaller, F.lit(1)))


def encoded(hashes: Column) -> Column:
    """A sketch as a string: 16 hex digits per hash."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def fingerprinted(documents: DataFrame) -> DataFrame:
    """Every document's fingerprint next to that of its edited text and of the next document.

    The edited text has its last quarter of code points replaced by as many from the start of the next
    document in ascending order of ids, the first document after the last.  Null text is empty.  A null
    id comes before all others.  Rows that share an id share their next document; where several rows have
    the next id, the one with the smallest SHA-256 counts.  Repeated rows give repeated results; an empty
    table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = documents.select("doc_id", key.alias("_key"), text.alias("_text"))
    ids = rows.groupBy("doc_id", "_key").agg(F.max(F.length("_text")).alias("_longest"))
    placed = stored(
        running_totals(ids.withColumn("_one", F.lit(1)), ["doc_id"], {"_place": "_one"}, purpose="id-order"), "id-places"
    )
    n = placed.count()
    needs = placed.select(
        F.col("_key").alias("_for"), ((F.col("_place") + 1) % F.lit(max(n, 1))).alias("_place"),
        F.floor(F.col("_longest") / 4).cast("int").alias("_need"),
    ).join(placed.select("_place", "_key"), "_place")
    # Both joins below read one exchange of the texts, as both need the same columns of it; the id is in the key.
    # Sketches are drawn behind it: those of the texts themselves are never exchanged.
    texts = rows.drop("doc_id")
    heads = (
        with_sketch(texts.join(stored(needs.select("_for", "_need", "_key"), "id-next"), "_key"), "_text", "_sketch")
        .select(
            "_for", F.sha2("_text", 256).alias("_sha"),
            F.struct(F.substring(F.col("_text"), F.lit(1), F.col("_need")).alias("head"), F.col("_sketch").alias("sketch")).alias("_next"),
        )
        .groupBy("_for").agg(F.min_by("_next", "_sha").alias("_next"))
    )
    joined = with_sketch(texts.join(heads.withColumnRenamed("_for", "_key"), "_key"), "_text", "_sketch")
    n_chars = F.length("_text")
    quarter = F.floor(n_chars / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("_text"), F.lit(1), n_chars - quarter), F.substring(F.col("_next.head"), F.lit(1), quarter)
    )
    kind = documents.schema["doc_id"].dataType.simpleString()
    both = joined.select(
        F.expr(f"try_cast(_key AS {kind})").alias("doc_id"), n_chars.cast("long").alias("n_chars"), edited.alias("_edited"), "_sketch",
        F.col("_next.sketch").alias("_next_sketch"),
    )
    drawn = with_sketch(both, "_edited", "_edited_sketch")
    return drawn.select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        encoded(F.col("_sketch")).alias("fingerprint"), encoded(F.col("_edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("_sketch"), F.col("_edited_sketch")).alias("near_edited"),
        likeness(F.col("_sketch"), F.col("_next_sketch")).alias("near_next"),
        containment(F.col("_edited_sketch"), F.col("_sketch")).alias("edited_in_text"),
    )
