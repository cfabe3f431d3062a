"""WARC archives: writing deduplicated pages, and reading records back from any split by boundary chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import salted_join, shared_folder, stored

MAGIC = "WARC/1.1\r\n"

#: Payloads of fewer bytes are never revisits.
LEAST_PAYLOAD = 0

#: Records per file: chains of a file have at most so many links, and take the logarithm of it in rounds.
RECORDS_PER_FILE = 4096

#: Up to so many payloads that occur more than once are broadcast.
_BROADCAST_REPEATS = 100_000

_CONTENT = "text/html; charset=utf-8"

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base32: four digits for each five of the hexadecimal form."""
    hexed = F.sha1(data)
    digits = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*digits)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_roles(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """Add ``_digest``, ``_bytes`` and ``_refers`` (the page to refer to, null for a response) to ``page_id, url, html``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        "page_id", "url", payload.alias("_payload"), base32_sha1(payload).alias("_digest"),
        F.octet_length(payload).cast("long").alias("_bytes"),
    )
    repeats = stored(
        rows.where(F.col("_bytes") >= least).groupBy("_digest")
        .agg(F.max("page_id").alias("_newest"), F.count("*").alias("_n"))
        .where("_n > 1 AND _newest IS NOT NULL").select("_digest", "_newest"),
        "repeated-payloads",
    )
    if repeats.count() <= _BROADCAST_REPEATS:
        joined = rows.join(F.broadcast(repeats), "_digest", "left")
    else:
        joined = salted_join(rows, repeats, ["_digest"], "left")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("_newest")), None).otherwise(F.col("_newest"))
    return joined.select("page_id", "url", "_payload", "_digest", "_bytes", refers.alias("_refers"))


def _record(least: int) -> Column:
    """One record without the empty lines that end it."""
    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    number = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    response = F.col("_refers").isNull()
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK\r\nContent-Type: {_CONTENT}\r\nContent-Length: "), F.col("_bytes").cast("string"), F.lit("\r\n\r\n")
    )
    payload = F.when(response, F.col("_payload").cast("string")).otherwise("")
    safe_url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(response, "response").otherwise("revisit")),
        line("WARC-Record-ID", F.coalesce(number("page_id"), F.expr("concat('<urn:uuid:', uuid(), '>')"))),
        line("WARC-Date", F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", safe_url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        line("WARC-Refers-To", number("_refers")),
        line("WARC-Profile", F.when(~response, _PROFILE)),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length(http) + F.octet_length(payload)).cast("string")),
        F.lit("\r\n"),
        http,
        payload,
    )


def write(pages: DataFrame, path: str, least: int = LEAST_PAYLOAD, per_file: int = RECORDS_PER_FILE) -> None:
    """Write a record per page to uncompressed archives below ``path``.

    Of pages with equal payloads of at least ``least`` bytes, those with the largest id are responses and the
    others revisits without payload; smaller ones are all responses.  A record's block is an HTTP header, which
    tells the length of the full payload for revisits too, and the payload.  Records are dated by the time of
    writing.  Null html is an empty payload; a null id is smaller than any, and its record has a random UUID for an
    id.  Rows that share the largest id all are responses, and rows that share an id share their record's id.
    """
    (
        with_roles(pages, least).select(_record(least).alias("value"))
        .write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file).text(path)
    )


def _candidates(spark: SparkSession, path: str) -> DataFrame:
    """Whatever follows the magic, up to the next one, with the place it was read at."""
    return (
        spark.read.option("lineSep", MAGIC).text(path)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"), F.col("value").cast("binary").alias("chunk"),
        )
    )


def _parsed(chunks: DataFrame) -> DataFrame:
    """Header fields of a chunk, how long its headers are, and where, by its length field, the record after it starts."""
    text = F.col("chunk").cast("string")
    at = F.locate("\r\n\r\n", text)
    head = F.when(at > 0, F.substring(text, F.lit(1), at + 1))
    step = chunks.withColumns({"_head": head, "_block": F.when(at > 0, F.substring(text, at + 4, F.length(text)))})

    def field(name: str, head: str = "_head") -> Column:
        return F.regexp_extract(F.concat(F.lit("\r\n"), F.col(head)), rf"(?i)\r\n{name}: *([^\r\n]*)", 1)

    number = lambda c: F.expr(f"try_cast({c} AS BIGINT)")
    end = F.locate("\r\n\r\n", F.col("_block"))
    http = F.lower(field("Content-Type")).startswith("application/http") & (end > 0)
    step = step.withColumn("_http", F.when(http, F.substring(F.col("_block"), F.lit(1), end + 1))).withColumns({
        "type": field("WARC-Type"), "_id": F.regexp_extract(field("WARC-Record-ID"), "^<urn:page:(-?[0-9]+)>", 1),
        "digest": F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", ""),
        "_refers": F.regexp_extract(field("WARC-Refers-To"), "^<urn:page:(-?[0-9]+)>", 1),
        "_full": field("Content-Length", "_http"), "_length": field("Content-Length"),
        "size": F.octet_length("chunk").cast("long"),
    }).withColumns({
        "length": number("_length"), "head_bytes": F.octet_length("_head").cast("long") + 2,
        "http_bytes": F.coalesce(F.octet_length("_http").cast("long") + 2, F.lit(0)),
    })
    return step.withColumns({"page_id": number("_id"), "refers_to": number("_refers"), "full": number("_full")}).drop(
        "_head", "_block", "_http", "_id", "_refers", "_full", "_length"
    )


def _offsets(chunks: DataFrame) -> DataFrame:
    """Add ``offset``, the place of the magic in its file: sums of the lengths before, inside blocks and over them."""
    step = F.col("size") + len(MAGIC)
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    blocks = chunks.groupBy("file", "block").agg(F.sum(step).alias("_sum"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    within = chunks.withColumn("_within", F.coalesce(F.sum(step).over(inside), F.lit(0)))
    # The text before a file's first magic has no magic of its own.
    return within.join(starts, ["file", "block"]).withColumn(
        "offset", F.col("_start") + F.col("_within") - len(MAGIC)
    ).drop("_start", "_within")


def reachable(links: DataFrame) -> DataFrame:
    """Of candidates ``file, offset, next``, those on the chain from offset 0 of their file, by pointer jumping.

    In each round every candidate's pointer becomes that of the one it points to, and what the old pointers of
    reached candidates point to is reached; the chain doubles until no candidate is added.
    """
    jumps = candidates = stored(links.select("file", "offset", F.col("next").alias("to")), "chain")
    reached = stored(jumps.where("offset = 0").select("file", "offset"), "reached")
    count = reached.count()
    while True:
        ahead = jumps.join(reached, ["file", "offset"]).select("file", F.col("to").alias("offset"))
        known = reached.unionByName(ahead.join(candidates, ["file", "offset"], "left_semi")).distinct()
        known = stored(known, "reached")
        now = known.count()
        if now == count:
            return known
        reached, count = known, now
        onward = jumps.select("file", F.col("offset").alias("to"), F.col("to").alias("_to"))
        jumps = stored(jumps.join(onward, ["file", "to"]).select("file", "offset", F.col("_to").alias("to")), "chain")


def read(spark: SparkSession, path: str) -> DataFrame:
    """All records below ``path``: ``page_id, payload_bytes, payload_digest, record_type, refers_to, intact``.

    Archives are read in splits.  Every magic string is a candidate for a record; a candidate's length field
    says where its successor would start.  Only candidates on the chain from the file's start are records, so
    a magic string, or a whole record, inside a payload is none.  A block that is not HTTP is all payload.  Digest
    and length are those of the payload read;
    a revisit, which has no payload, tells those of the page it refers to.  ``intact`` says whether the payload has
    the digest its header names.  An empty folder of archives gives no rows.
    """
    parsed = _parsed(_candidates(spark, path))
    # What a chunk holds after its header is the payload, if the payload has no magic inside.
    whole = F.col("length") + F.col("head_bytes") <= F.col("size")
    body = F.when(whole, F.expr("substring(chunk, head_bytes + http_bytes + 1, length - http_bytes)"))
    index = stored(
        parsed.withColumns({"whole": whole, "read_digest": base32_sha1(body)}).drop("chunk"), "candidates"
    )
    placed = stored(_offsets(index), "candidate-offsets")
    links = placed.where("length IS NOT NULL AND offset >= 0").select(
        "file", "offset", (F.col("offset") + len(MAGIC) + F.col("head_bytes") + F.col("length") + 4).alias("next")
    )
    records = stored(
        placed.join(reachable(links), ["file", "offset"]), "records"
    )
    parted = records.where("NOT whole")
    if not parted.isEmpty():
        records = records.where("whole").unionByName(_reassembled(spark, path, placed, parted))
    response = F.col("type") == "response"
    digest = F.when(response, F.col("read_digest")).otherwise(F.col("digest"))
    return records.select(
        "page_id", F.when(response, F.col("length") - F.col("http_bytes")).otherwise(F.col("full")).alias("payload_bytes"),
        digest.alias("payload_digest"), F.col("type").alias("record_type"), "refers_to",
        (~response | (F.col("read_digest") == F.col("digest"))).alias("intact"),
    )


def _reassembled(spark: SparkSession, path: str, placed: DataFrame, parted: DataFrame) -> DataFrame:
    """Records whose payload holds the magic: their chunks are read a second time and put together in order.

    Splits of a folder are the same for the same settings, so places are found again; each chunk's length is
    compared.
    """
    end = F.col("offset") + len(MAGIC) + F.col("head_bytes") + F.col("length")
    spans = parted.select("file", F.col("offset").alias("_from"), end.alias("_to"))
    files = placed.join(spans.select("file").distinct(), "file", "left_semi").select("file", "block", "seq", "size", "offset")
    marked = files.join(
        spans.withColumn("offset", F.col("_from")).select("file", "offset", "_from", "_to"), ["file", "offset"], "left"
    )
    order = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    owned = marked.withColumns({
        "_from": F.last("_from", ignorenulls=True).over(order), "_to": F.last("_to", ignorenulls=True).over(order),
    }).where("_from IS NOT NULL AND offset < _to")
    wanted = stored(owned.select("file", "block", "seq", "size", "offset", "_from"), "parted-places")
    chunks = _candidates(spark, path).withColumn("size", F.octet_length("chunk").cast("long"))
    pieces = chunks.join(wanted, ["file", "block", "seq", "size"])
    joined = (
        pieces.groupBy("file", "_from")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "chunk"))).alias("_parts"))  # one record's payload
    )
    data = F.array_join(F.transform("_parts", lambda x: F.decode(x["chunk"], "ISO-8859-1")), MAGIC)
    whole = joined.select("file", F.col("_from").alias("offset"), F.encode(data, "ISO-8859-1").alias("_data"))
    body = F.expr("substring(_data, head_bytes + http_bytes + 1, length - http_bytes)")
    return (
        parted.drop("read_digest").join(whole, ["file", "offset"], "left").withColumn("read_digest", base32_sha1(body)).drop("_data")
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write archives to the shared folder and read them back."""
    path = shared_folder(pages.sparkSession, "warc")
    write(pages.select("page_id", "url", "html"), path)
    return read(pages.sparkSession, path)
