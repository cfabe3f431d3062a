"""Exact removal of long repeated byte strings, by ordering suffixes of many pieces column by column.

Whole documents cannot be ordered column by column: there are as many rounds as the longest document has
bytes, each over the whole collection.  So documents are first cut into pieces of bounded length at places
that only depend on the bytes around them:

1. Of the ``ANCHOR``-byte strings inside every window of ``LENGTH`` bytes, the one with the smallest hash is an
   anchor.  Equal windows have equal anchors at equal places, so a window that occurs twice has an anchor that occurs
   twice.  Anchors are counted; those found once need nothing more.
2. Every remaining anchor gives a piece: all windows around it.  Pieces of one anchor meet in one task.
3. There the collection is built column by column from the right (``shared_starts``): each round puts one more byte in
   front of every piece, re-sorts the order of the suffixes by it (the collection's Burrows-Wheeler order), and
   updates the common prefixes of neighbours.  Windows whose suffix shares ``LENGTH`` bytes with a neighbour
   occur elsewhere.  Bytes are compared, not hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import arrow_batches, discard, salted_join, stored

#: A string of this many bytes that starts in two places is removed.
LENGTH = 200

#: Bytes of an anchor.  A window has LENGTH - ANCHOR + 1 of them.
ANCHOR = 40

_SPREAD = LENGTH - ANCHOR
_PIECE = LENGTH + _SPREAD

#: Pieces a task orders at once, in bytes; rows of one text that may go to one task.
BUCKET_BYTES, SALTS = 32 << 20, 16

#: An anchor with more pieces has its windows counted by 128-bit digests instead, spread over all tasks.
HOT_ANCHOR = 50_000

#: Bytes of documents looked at together, if they are not one document; anchors whose pieces are cut out together.
_CHUNK, _BLOCK = 1 << 18, 1 << 13

_PAD = 0xFF  # no byte of UTF-8 text
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(2**64 - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _both_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    size = max(_CHUNK, 1 << (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        _POWERS[size] = _powers(int(_BASE), size), _powers(pow(int(_BASE), -1, 2**64), size)
    return _POWERS[size][0][:n], _POWERS[size][1][:n]


def _sliding(values: np.ndarray, width: int, best: np.ufunc, worst: np.uint64) -> np.ndarray:
    """Best value of each run of ``width`` values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, worst, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    back = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of the documents that ``data`` holds one after another."""
    n = len(data)
    if n < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    powers, inverse = _both_powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    h = (sums[ANCHOR:] - sums[:-ANCHOR]) * inverse[: n - ANCHOR + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    least = _sliding(h, _SPREAD + 1, np.minimum, _TOP)  # of the window that starts here
    inside = np.zeros(n + 1, np.int32)
    long = ends - starts >= LENGTH
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - LENGTH + 1, -1)
    least[np.cumsum(inside)[: len(least)] <= 0] = 0
    reach = np.concatenate([np.zeros(_SPREAD, np.uint64), least, np.zeros(_SPREAD, np.uint64)])
    chosen = _sliding(reach, _SPREAD + 1, np.maximum, np.uint64(0)) == h
    places = np.flatnonzero(chosen & (h != 0))
    return places, h[places]


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents put together up to a size: number of the first, bytes, starts and ends."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= _CHUNK):
            size += len(texts[to])
            to += 1
        ends = np.cumsum([len(t) for t in texts[at:to]], dtype=np.int64)
        yield at, np.frombuffer(b"".join(texts[at:to]), np.uint8), np.concatenate([[0], ends[:-1]]).astype(np.int64), ends
        at = to


def shared_starts(groups: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """For different pieces, sorted by group: at which columns a window starts that another piece of the group has.

    Suffixes are kept in order inside their group.  ``common[i]`` is the length of the common prefix of the
    suffixes at places i - 1 and i, 0 at the start of a group.
    """
    m = len(groups)
    starts = np.zeros((_SPREAD + 1, m), bool)
    if m < 2:
        return starts
    first = np.concatenate([[True], groups[1:] != groups[:-1]])
    group = np.cumsum(first) - 1
    begin = np.append(np.flatnonzero(first), m)
    columns = np.ascontiguousarray(pieces.T)
    order, common = np.arange(m), np.zeros(m + 1, np.int32)
    for c in range(_PIECE - 1, -1, -1):
        symbols = columns[c][order]
        equal = symbols[1:] == symbols[:-1]
        falls = (symbols[1:] < symbols[:-1]) & ~first[1:]
        unsorted = np.unique(group[1:][falls])
        if len(unsorted):
            # Only groups in which the new symbols are out of order are sorted again.
            sizes = begin[unsorted + 1] - begin[unsorted]
            place = np.repeat(begin[unsorted] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            sub = symbols[place]
            moved = place[np.lexsort((sub, group[place]))]
            a, b = moved[:-1], moved[1:]
            alike = (symbols[a] == symbols[b]) & (group[a] == group[b])
            # The common prefix of two suffixes is the least one between them.
            between = np.minimum.reduceat(common, np.stack([a[alike] + 1, b[alike] + 1], 1).ravel())[::2] if alike.any() else []
            updated = np.zeros(len(place), np.int32)
            updated[1:][alike] = np.asarray(between) + 1
            common[1:m] = np.where(equal & ~first[1:], common[1:m] + 1, 0)
            common[place] = updated
            order[place] = order[moved]
        else:
            common[1:m] = np.where(equal & ~first[1:], common[1:m] + 1, 0)
        if c <= _SPREAD:
            hit = common >= LENGTH
            starts[c, order] = hit[:-1] | hit[1:]
    return starts


def _cut(data: np.ndarray, start: np.ndarray, end: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The bytes around each place, padded where the document ends."""
    index = places[:, None] + np.arange(-_SPREAD, LENGTH)
    outside = (index < start[:, None]) | (index >= end[:, None])
    found = data[np.clip(index, 0, len(data) - 1)]
    found[outside] = _PAD
    return found


def _blocks(*columns: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows of the columns, so many at once: of a text that is one character over and over every byte is an anchor."""
    for at in range(0, len(columns[0]), _BLOCK):
        yield tuple(c[at : at + _BLOCK] for c in columns)


def _text_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def _anchor_lists(rows: DataFrame) -> DataFrame:
    """Replace ``_text`` by ``_anchors``, the hashes of its anchors; a hash found several times is there twice."""
    others = [c for c in rows.columns if c != "_text"]
    schema = T.StructType([*[rows.schema[c] for c in others], T.StructField("_anchors", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists: list[np.ndarray] = []
            for _, data, starts, ends in _chunks(_text_bytes(batch, "_text")):
                places, hashes = anchors(data, starts, ends)
                bounds = np.searchsorted(places, [*starts, len(data)])
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    own, n = np.unique(hashes[a:b], return_counts=True)
                    lists.append(np.repeat(own, np.minimum(n, 2)).view(np.int64))
            offsets = np.cumsum([0, *map(len, lists)], dtype=np.int32)
            flat = pa.array(np.concatenate([np.empty(0, np.int64), *lists]))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.ListArray.from_arrays(pa.array(offsets), flat)], [*others, "_anchors"]
            )

    return arrow_batches(rows).mapInArrow(run, schema)


def _located(batch: pa.RecordBatch, wanted: str) -> Iterator[tuple]:
    """Per chunk: number of the first row, bytes, starts, ends, and the wanted anchors' rows, places and hashes."""
    lists = batch.column(wanted)
    flat, offsets = np.asarray(lists.flatten(), np.int64).view(np.uint64), np.asarray(lists.offsets)
    offsets = offsets - offsets[0]
    for at, data, starts, ends in _chunks(_text_bytes(batch, "_text")):
        places, hashes = anchors(data, starts, ends)
        owner = np.searchsorted(ends, places, side="right")
        keep = np.zeros(len(places), bool)
        bounds = np.searchsorted(owner, np.arange(len(ends) + 1))
        for i in range(len(ends)):
            a, b = bounds[i], bounds[i + 1]
            keep[a:b] = np.isin(hashes[a:b], flat[offsets[at + i] : offsets[at + i + 1]])
        yield at, data, starts, ends, owner[keep], places[keep], hashes[keep]


_KEYS = ("_md5", "_salt")


def _pieces(rows: DataFrame, buckets: int) -> DataFrame:
    """Packed pieces ``bucket, packed`` of the wanted anchors of ``_md5, _salt, _text, _wanted``."""

    def pack(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        hashes, keys, salts, counts, places, bytes_ = (np.concatenate(x) for x in zip(*parts, strict=True))
        bucket = (hashes >> np.uint64(20)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        first = np.cumsum(counts) - counts
        squeeze = zstandard.ZstdCompressor(level=1).compress
        names, packed = [], []
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order].astype(np.int64))) + 1):
            spots = np.repeat(first[part] - np.cumsum(counts[part]) + counts[part], counts[part]) + np.arange(counts[part].sum())
            names.append(int(bucket[part[0]]))
            packed.append(squeeze(b"".join([
                np.int64(len(part)).tobytes(), np.int64(len(spots)).tobytes(), hashes[part].tobytes(), keys[part].tobytes(),
                salts[part].tobytes(), counts[part].tobytes(), places[spots].tobytes(), bytes_[part].tobytes(),
            ])))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(packed, pa.binary())], ["bucket", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            md5 = np.frombuffer(b"".join(batch.column("_md5").to_pylist()), np.uint8).reshape(-1, 16)
            salt = np.asarray(batch.column("_salt"), np.int32)
            for at, data, starts, ends, owner, places, hashes in _located(batch, "_wanted"):
                for own, place, hash_ in _blocks(owner, places, hashes):
                    found = _cut(data, starts[own], ends[own], place)
                    # Equal pieces of a document travel once, with all their places of the block.
                    tagged = np.concatenate([own.astype(np.int64).view(np.uint8).reshape(-1, 8), hash_.view(np.uint8).reshape(-1, 8), found], 1)
                    _, one, which, counts = np.unique(
                        tagged.view(f"V{tagged.shape[1]}").ravel(), return_index=True, return_inverse=True, return_counts=True
                    )
                    spots = (place - starts[own])[np.argsort(which, kind="stable")]
                    row = own[one] + at
                    parts.append((hash_[one], md5[row], salt[row], counts.astype(np.int64), spots, found[one]))
                    held += len(one) * _PIECE
                    if held > BUCKET_BYTES // 2:
                        yield from pack(parts)
                        parts, held = [], 0
        if parts:
            yield from pack(parts)

    return arrow_batches(rows).mapInArrow(run, "bucket long, packed binary")


def _spans(bucket: list[bytes]) -> pa.RecordBatch:
    """Covered bytes ``_md5, _salt, start, end`` from the pieces of one bucket."""
    read = zstandard.ZstdDecompressor().decompress
    columns: list[list[np.ndarray]] = [[], [], [], [], [], []]
    for packed in bucket:
        raw = read(packed)
        n, k = np.frombuffer(raw, np.int64, 2)
        at = 16
        for column, (kind, size) in zip(columns, ((np.uint64, n), (np.uint8, 16 * n), (np.int32, n), (np.int64, n), (np.int64, k), (np.uint8, _PIECE * n)), strict=True):
            column.append(np.frombuffer(raw, kind, size, at))
            at += size * np.dtype(kind).itemsize
    hashes, keys, salts, counts, places, data = (np.concatenate(c) for c in columns)
    keys, data = keys.reshape(-1, 16), data.reshape(-1, _PIECE)
    tagged = np.concatenate([hashes.view(np.uint8).reshape(-1, 8), data], 1).view(f"V{8 + _PIECE}").ravel()
    _, one, which = np.unique(tagged, return_index=True, return_inverse=True)
    times = np.bincount(which, counts)
    # Equal pieces repeat each other; different ones of an anchor are ordered against each other.
    by_group = np.argsort(hashes[one], kind="stable")
    group = hashes[one][by_group]
    change = np.concatenate([[True], group[1:] != group[:-1], [True]])
    several = ~(change[:-1] & change[1:])
    flagged = np.zeros((_SPREAD + 1, len(one)), bool)
    flagged[:, by_group[several]] = shared_starts(group[several], data[one][by_group[several]])
    flagged[:, times > 1] = True
    # Windows have to lie inside the document: no padding in them.
    outside = np.concatenate([np.zeros((1, len(one)), np.int32), np.cumsum((data[one] == _PAD).T, 0, dtype=np.int32)])
    flagged &= outside[LENGTH : LENGTH + _SPREAD + 1] == outside[: _SPREAD + 1]
    edge = np.diff(np.pad(flagged, ((1, 1), (0, 0))).astype(np.int8), axis=0)
    piece, from_ = np.nonzero(edge.T == 1)
    _, to = np.nonzero(edge.T == -1)
    # Every place of every copy of a piece has the piece's runs.
    run_first, run_n = np.searchsorted(piece, np.arange(len(one))), np.bincount(piece, minlength=len(one))
    entry = np.repeat(np.arange(len(counts)), counts)
    times_each = run_n[which[entry]]
    rows = np.repeat(np.arange(len(entry)), times_each)
    runs = np.repeat(run_first[which[entry]] - np.cumsum(times_each) + times_each, times_each) + np.arange(times_each.sum())
    begin = places[rows] - _SPREAD + from_[runs]
    end = places[rows] - _SPREAD + to[runs] - 1 + LENGTH
    # Runs of one row that touch are one.
    tag = np.unique(np.concatenate([keys, salts.view(np.uint8).reshape(-1, 4)], 1).view("V20").ravel(), return_inverse=True)[1]
    owner = tag[entry[rows]]
    order = np.lexsort((begin, owner))
    owner, begin, end, source = owner[order], begin[order], end[order], entry[rows][order]
    if len(owner):
        shifted = end + owner.astype(np.int64) * (1 << 40)
        reach = np.maximum.accumulate(shifted)
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (begin[1:] + owner[1:].astype(np.int64) * (1 << 40) > reach[:-1])])
        heads = np.flatnonzero(new)
        end = np.maximum.reduceat(end, heads)
        begin, source = begin[heads], source[heads]
    return pa.RecordBatch.from_arrays(
        [pa.array([k.tobytes() for k in keys[source]], pa.binary()), pa.array(salts[source]), pa.array(begin, pa.int64()), pa.array(end, pa.int64())],
        [*_KEYS, "start", "end"],
    )


_SPAN_SCHEMA = "_md5 binary, _salt int, start long, end long"


def _ordered(pieces: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name = [], None
        for batch in batches:
            for bucket, packed in zip(batch.column("bucket").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                if held and bucket != name:
                    yield _spans(held)
                    held = []
                name = bucket
                held.append(packed)
        if held:
            yield _spans(held)

    dealt = pieces.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return arrow_batches(dealt).mapInArrow(run, _SPAN_SCHEMA)


def _counted_windows(rows: DataFrame) -> DataFrame:
    """Covered bytes from windows of hot anchors: their digests are counted, first in each task, then over all."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            md5, salt = batch.column("_md5").to_pylist(), batch.column("_salt").to_pylist()
            for at, data, starts, ends, owner, places, _ in _located(batch, "_hot"):
                reach = np.zeros(len(data) + 1, np.int32)
                np.add.at(reach, np.maximum(places - _SPREAD, 0), 1)
                np.add.at(reach, places + 1, -1)
                near = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
                whose = np.searchsorted(ends, near, side="right")
                ok = near + LENGTH <= ends[whose]
                for spots, rows_ in _blocks(near[ok], whose[ok]):
                    out = [
                        (hashlib.blake2b(data[p : p + LENGTH].tobytes(), digest_size=16).digest(), md5[at + i], salt[at + i], p - int(starts[i]))
                        for p, i in zip(spots.tolist(), rows_.tolist(), strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.binary(), pa.binary(), pa.int32(), pa.int64()), strict=True)],
                        ["digest", *_KEYS, "start"],
                    )

    windows = stored(arrow_batches(rows).mapInArrow(run, "digest binary, _md5 binary, _salt int, start long"), "hot-windows")
    repeated = windows.groupBy("digest").count().where("count > 1").select("digest")
    return salted_join(windows, repeated, ["digest"], "left_semi").select(*_KEYS, "start", (F.col("start") + LENGTH).alias("end"))


def _row_hash() -> Column:
    return F.xxhash64(F.to_json("_rest"))


def _merged(spans: Column) -> Column:
    """Sorted spans with those that touch or overlap put together."""
    one = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return (
            F.when(F.size(done) == 0, F.array(x))
            .when(x["start"] <= last["end"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)))
            .otherwise(F.concat(done, F.array(x)))
        )

    return F.aggregate(spans, F.array().cast(one), add)


def repeated_spans(documents: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``documents`` with ``_spans``: the covered bytes of its text, in order and not touching.

    A byte is covered if some string of ``LENGTH`` bytes around it starts in another place too, in the same
    or another row; strings do not cross rows.  Null counts as empty.  Rows with equal texts of at least
    ``LENGTH`` bytes are covered from end to end.  Rows are kept one to one, with all columns.
    """
    rows = documents.select(
        F.struct(*[c for c in documents.columns if c != text]).alias("_rest"), F.col(text).alias("_text"),
    )
    whole_text = F.coalesce("_text", F.lit(""))
    rows = rows.withColumns({
        "_md5": F.unhex(F.md5(whole_text.cast("binary"))),
        "_salt": F.pmod(_row_hash(), F.lit(SALTS)).cast("int"),
    })
    lists = _anchor_lists(rows.select("_md5", "_salt", _row_hash().alias("_row"), "_text"))
    # One row per different text, with the salt of one of its rows.  Anchors travel with a number of their text, not with its keys.
    texts = stored(
        lists.groupBy("_md5").agg(F.count("*").alias("_n"), F.min_by(F.struct("_salt", "_row", "_anchors"), "_row").alias("_one"))
        .select(F.monotonically_increasing_id().alias("_text_id"), "_md5", "_n", "_one.*"),
        "texts",
    )
    every = texts.select(F.explode("_anchors").alias("_anchor"))
    counts = stored(every.groupBy("_anchor").agg(F.count("*").alias("_times")).where("_times > 1"), "repeated-anchors")
    found = texts.select("_text_id", F.explode(F.array_distinct("_anchors")).alias("_anchor"))
    matched = found.join(counts, "_anchor").groupBy("_text_id").agg(
        F.collect_list(F.when(F.col("_times") <= HOT_ANCHOR, F.col("_anchor"))).alias("_wanted"),
        F.collect_list(F.when(F.col("_times") > HOT_ANCHOR, F.col("_anchor"))).alias("_hot"),
    )
    wanted = stored(texts.select("_text_id", *_KEYS, "_row").join(matched, "_text_id").drop("_text_id"), "wanted-anchors")
    copied = stored(texts.where("_n > 1").select("_md5"), "copied-texts")
    discard(counts, texts)
    n = wanted.agg(F.sum(F.size("_wanted"))).first()[0] or 0
    buckets = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n * _PIECE // BUCKET_BYTES))
    # All uses of the texts read one exchange, so all have the same columns and outer joins: an inner one, or a filter that
    # makes it one, would put a filter of its own before the exchange.
    met, named = rows.join(wanted, list(_KEYS), "left"), _row_hash() == F.col("_row")
    chosen = lambda rule, column: met.where(F.coalesce(rule, F.lit(False))).select(*_KEYS, "_text", column)
    spans = _ordered(_pieces(chosen(named, "_wanted"), buckets), buckets)
    if not wanted.where(F.size("_hot") > 0).isEmpty():
        spans = spans.unionByName(_counted_windows(chosen(named & (F.size("_hot") > 0), "_hot")))
    merged = spans.groupBy(*_KEYS).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_list"))
    copies = copied.select("_md5", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"), F.lit(True).alias("_copied"))
    # A small file of keys is many rows with all salts: too many to broadcast.
    joined = rows.join(merged, list(_KEYS), "left").join(copies.hint("merge"), list(_KEYS), "left")
    size = F.octet_length(whole_text).cast("long")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), size.alias("end")))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    covered = F.when(size < LENGTH, none).when(F.col("_copied"), whole).otherwise(F.coalesce(_merged(F.col("_list")), none))
    return joined.select("_rest", whole_text.alias("_text"), F.col("_text").isNull().alias("_null"), covered.alias("_spans"))


def _kept() -> Column:
    """The bytes of ``_text`` outside of ``_spans``."""
    n = F.size("_spans")
    part = lambda i: F.substring(
        F.col("_binary"),
        F.when(i == 0, 1).otherwise(F.get("_spans", i - 1)["end"] + 1).cast("int"),
        (F.coalesce(F.get("_spans", i)["start"], F.octet_length("_binary").cast("long")) - F.when(i == 0, 0).otherwise(F.get("_spans", i - 1)["end"])).cast("int"),
    )
    return F.aggregate(F.sequence(F.lit(0), n), F.lit(b""), lambda whole, i: F.concat(whole, part(i)))


def _whole_characters(span: Column) -> Column:
    """A span of ``_binary`` with its edges moved outwards to where characters of UTF-8 begin."""
    inner = lambda at: F.hex(F.substring(F.col("_binary"), (at + 1).cast("int"), F.lit(1))).between("80", "BF")

    def edge(at: Column, step: int) -> Column:
        return F.when(~inner(at), at).when(~inner(at + step), at + step).when(~inner(at + 2 * step), at + 2 * step).otherwise(at + 3 * step)

    return F.struct(edge(span["start"], -1).alias("start"), edge(span["end"], 1).alias("end"))


def removed(documents: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row: what is left of its bytes.

    Null text is empty.  A text all of which is repeated leaves nothing.  Null and repeated ids do no harm, as rows
    are told apart by their texts.  An empty table gives an empty result.
    """
    rows = repeated_spans(documents.select("doc_id", "text")).withColumn("_binary", F.col("_text").cast("binary"))
    cut = F.aggregate("_spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"])
    return rows.select(
        "_rest.doc_id", F.octet_length("_text").cast("long").alias("n_bytes"), cut.alias("n_removed"),
        F.size("_spans").cast("long").alias("n_spans"), _kept().alias("kept"),
    )


def without_repeats(documents: DataFrame) -> DataFrame:
    """``documents`` with repeated strings cut out of ``text``, all columns as they were.

    Bytes of a character that is cut through are left out with it; all other characters, replacement characters
    included, stay.  Null stays null; a text that is cut to nothing is empty.  ``n_chars``, if there, is the new length.
    """
    rows = repeated_spans(documents).withColumn("_binary", F.col("_text").cast("binary"))
    rows = rows.withColumn("_spans", F.transform("_spans", _whole_characters))
    cleaned = F.when(F.col("_null"), None).when(F.size("_spans") == 0, F.col("_text")).otherwise(_kept().cast("string"))
    step = rows.select("_rest", cleaned.alias("_new"))
    columns = [
        F.col("_new").alias(c) if c == "text"
        else F.length("_new").cast(documents.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col("_rest")[c].alias(c)
        for c in documents.columns
    ]
    return step.select(*columns)
