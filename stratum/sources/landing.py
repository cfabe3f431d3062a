"""Landing files to typed staging rows with lineage."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions import landing as lf
from stratum.schemas import LANDING, empty, staging_name, staging_schema
from stratum.sources.workspace import shared_folder

# Deliveries per load are few; above this many their list is joined without a hint.
_BROADCAST_DELIVERIES = 100_000

_AT_ONCE = 16

#: Files up to so many bytes are parsed by one task each, larger ones in splits.
WHOLE_FILE = 64 << 20

#: A quoted record of more characters than this is taken for a quote that was left open, and its file rejected.
LONGEST_RECORD = 16 << 20

# What may stand between cells; the header tells which does.
_DELIMITERS = (",", ";", "\t", "|")

_FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def list_files(spark: SparkSession, landing: str) -> DataFrame:
    """Paths of all CSV files below ``landing``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(landing)
        .select("path", "length")
    )


def stream_files(spark: SparkSession, landing: str, **options) -> DataFrame:
    """The same list as an unbounded table: every file appears in it once."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
    )
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load(landing).select("path", "length")


def parse_names(files: DataFrame, name: Column) -> DataFrame:
    """Add table, origin date and batch from the file name."""
    return (
        files.withColumn("table_name", lf.table_of(name))
        .withColumn("date_text", lf.date_text_of(name))
        .withColumn("origin_date", lf.origin_date_of(name))
        .withColumn("batch_value", lf.batch_of(name))
    )


def manifest(files: DataFrame, *, per_file: bool = False) -> DataFrame:
    """One row per delivery: its target table, lineage, and the reason if it cannot be loaded.

    Files without a table or date part are not deliveries and are left out.  With ``per_file``
    every part file of a delivery written by Spark stands for itself, as it must where files
    arrive one by one.
    """
    named = files.withColumn("file_name", lf.landing_name(F.col("path")))
    parsed = parse_names(named, F.col("file_name"))
    known = F.col("table_name").isin(*LANDING)
    reason = (
        F.when(~known, F.lit("unknown table"))
        .when(F.col("origin_date").isNull(), F.lit("bad date"))
        .when(F.col("batch_value").isNull(), F.lit("bad batch"))
    )
    return (
        parsed.where("table_name IS NOT NULL AND date_text IS NOT NULL")
        .withColumn("delivery", lf.file_path(F.col("path")) if per_file else lf.delivery_path(F.col("path")))
        .groupBy("delivery", "file_name", "table_name", "origin_date", "batch_value")
        .agg(
            F.count("*").alias("files"),
            F.sum("length").alias("bytes"),
            F.max("length").alias("largest"),
            F.min(F.when(F.col("length") > 0, F.col("path"))).alias("first_file"),
        )
        .withColumn("staging_table", F.concat(F.lit("dp_"), F.col("table_name"), F.lit("_staging")))
        .withColumn("reason", reason)
    )


def missing_tables(deliveries: DataFrame, existing: Sequence[str]) -> DataFrame:
    """Staging tables that deliveries name and the catalog does not hold."""
    return deliveries.select("staging_table").distinct().where(~F.col("staging_table").isin(*existing, ""))


@dataclass(frozen=True)
class Delivery:
    """One delivered file (or folder of part files) with its parsed name, header and the size of its largest file."""

    path: str
    file_name: str
    entity: str
    header: tuple[str, ...]
    delimiter: str = ","
    largest: int = 0


def first_lines(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """The first line of each file, by path.

    A limit of one row runs the first split of a file alone, which stops reading after the row: what is read does
    not grow with the files.  Many files are looked at together.
    """

    def one(file: str) -> tuple[str, str]:
        first = spark.read.text(file).select("value", F.col("_metadata.file_block_start").alias("start")).limit(1).collect()
        return file, "".join(r.value for r in first if r.start == 0)

    with ThreadPoolExecutor(_AT_ONCE) as pool:
        return dict(pool.map(one, files))


def _header(line: str, entity: str) -> tuple[tuple[str, ...], str]:
    """Names and delimiter of a header line: the delimiter that brings out most of the declared columns."""
    def names(delimiter: str) -> tuple[str, ...]:
        return tuple(next(csv.reader([line.removesuffix("\r")], delimiter=delimiter), ()))

    best = min(_DELIMITERS, key=lambda d: len(missing_columns(Delivery("", "", entity, names(d)))))
    return names(best), best


def probe(spark: SparkSession, deliveries: DataFrame, entity: str | None = None) -> list[Delivery]:
    """Loadable deliveries and their headers.

    What reaches the driver is one row per delivery and the first line of one file of each, never data.
    """
    rows = deliveries.where("reason IS NULL")
    if entity is not None:
        rows = rows.where(F.col("table_name") == entity)
    first = lf.file_path(F.col("first_file")).alias("first_file")
    chosen = rows.select("delivery", "file_name", "table_name", "largest", first).orderBy("delivery").collect()
    files = [r.first_file for r in chosen if r.first_file is not None]
    lines = first_lines(spark, files) if files else {}
    headers = [_header(lines.get(r.first_file, ""), r.table_name) for r in chosen]
    return [Delivery(r.delivery, r.file_name, r.table_name, *h, r.largest) for r, h in zip(chosen, headers, strict=True)]


def missing_columns(delivery: Delivery) -> list[str]:
    present = {c.strip().lower() for c in delivery.header}
    return [c for c in LANDING[delivery.entity].fieldNames() if c not in present]


_CSV = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line", "escape": '"'}
_QUOTES = """length(value) - length(replace(value, '"', ''))"""


def _layouts(entity: str, deliveries: Iterable[Delivery]) -> list[tuple[tuple[str, ...], str, list[Delivery]]]:
    """Deliveries by column order and delimiter; those that lack a column are left to the reject list."""
    found: dict[tuple[tuple[str, ...], str], list[Delivery]] = defaultdict(list)
    for d in deliveries:
        if d.entity == entity and not missing_columns(d):
            found[d.header, d.delimiter].append(d)
    return [(header, delimiter, own) for (header, delimiter), own in sorted(found.items())]


def _cells(header: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))] + [T.StructField("_line", T.StringType())])


def _picked(rows: DataFrame, entity: str, header: Sequence[str], delivery: Column, odd: Column) -> DataFrame:
    """The declared columns of parsed cells, by header name; a line break in a cell is a newline, however it is spelt."""
    positions = {c.strip().lower(): i for i, c in reversed(list(enumerate(header)))}
    names = LANDING[entity].fieldNames()
    malformed = F.col("_line").isNotNull() | odd
    return rows.select(
        *[F.replace(F.col(f"c{positions[n]}"), F.lit("\r\n"), F.lit("\n")).alias(n) for n in names], delivery.alias("delivery"), malformed.alias("_malformed"), odd.alias("_odd")
    )


def _no_rows(spark: SparkSession, entity: str) -> DataFrame:
    texts = [T.StructField(n, T.StringType()) for n in [*LANDING[entity].fieldNames(), "delivery"]]
    return empty(spark, T.StructType([*texts, *[T.StructField(n, T.BooleanType()) for n in ("_malformed", "_odd")]]))


def scan(
    spark: SparkSession, entity: str, deliveries: Iterable[Delivery], *, per_file: bool = False, whole_file: int = WHOLE_FILE
) -> DataFrame:
    """Declared columns of one entity as text, picked by header name, with the delivery path.

    ``_malformed`` marks records with another number of cells than the header.  Quoted text may hold
    delimiters, doubled quotes and line breaks.  Files up to ``whole_file`` bytes are one task's work anyway and are
    parsed from end to end.  Larger ones are read line by line in splits: lines with an odd number
    of quotes are ``_odd``, and ``scan_records`` is for their deliveries.

    A CSV schema binds by position, so deliveries are read in one scan per column order and delimiter.
    """
    where = lf.file_path if per_file else lf.delivery_path
    scans = []
    for header, delimiter, own in _layouts(entity, deliveries):
        options = {**_CSV, "sep": delimiter}
        small, large = ([d.path for d in own if (d.largest <= whole_file) == one] for one in (True, False))
        if small:
            raw = (
                spark.read.options(**options, header=True, multiLine=True, recursiveFileLookup=True, columnPruning=False)
                .schema(_cells(header)).csv(small)
            )
            scans.append(_picked(raw, entity, header, where(F.col("_metadata.file_path")), F.lit(False)))
        if large:
            lines = spark.read.option("recursiveFileLookup", True).text(large).select(
                "value", where(F.col("_metadata.file_path")).alias("delivery"), F.col("_metadata.file_block_start").alias("start")
            )
            first = F.from_csv("value", _ddl(_cells(header)), options)
            body = lines.where((F.col("value") != "") & ~((F.col("start") == 0) & _is_header(first, header)))
            odd = F.expr(f"({_QUOTES}) % 2 = 1").alias("_odd")
            parsed = body.select(first.alias("cells"), "delivery", odd).select("cells.*", "delivery", "_odd")
            scans.append(_picked(parsed, entity, header, F.col("delivery"), F.col("_odd")))
    return reduce(DataFrame.unionByName, scans) if scans else _no_rows(spark, entity)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def _is_header(cells: Column, header: Sequence[str]) -> Column:
    same = [cells[f"c{i}"].eqNullSafe(F.lit(name or None)) for i, name in enumerate(header)]
    return reduce(lambda a, b: a & b, same)


def _numbered_lines(spark: SparkSession, paths: Sequence[str], folder: str) -> DataFrame:
    """All lines of some files with their file, split and order, written once so that the order stays.

    Only the newline ends a line: a carriage return before it is part of the text if the text is quoted.
    """
    lines = spark.read.options(recursiveFileLookup=True, lineSep="\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), "value", F.expr(_QUOTES).alias("quotes"),
    )
    lines.write.parquet(folder)
    return spark.read.schema(lines.schema).parquet(folder)


def cut_records(lines: DataFrame, longest: int = LONGEST_RECORD) -> DataFrame:
    """Records of CSV files from the lines of their splits: ``file, record, text``, records numbered from 1.

    A line begins a record if the quotes before it in its file are even in number.  They are counted within each
    split; one row per split carries the parity, and the number of records, over from the splits before it.  Files
    that end within quotes, or have a record of more than ``longest`` characters, have a record of NULL text.
    """
    so_far, before = (Window.unboundedPreceding, Window.currentRow), (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file", "start").orderBy("at")
    seen = lines.withColumn("_odd", F.coalesce(F.sum("quotes").over(inside.rowsBetween(*before)), F.lit(0)) % 2)
    splits = seen.groupBy("file", "start").agg(
        (F.sum("quotes") % 2).alias("_parity"), F.count_if(F.col("_odd") == 0).alias("_even_begins"), F.count_if(F.col("_odd") == 1).alias("_odd_begins")
    )
    along = Window.partitionBy("file").orderBy("start")
    carried = splits.withColumn("_carry", F.coalesce(F.sum("_parity").over(along.rowsBetween(*before)), F.lit(0)) % 2)
    begins = F.when(F.col("_carry") == 0, F.col("_even_begins")).otherwise(F.col("_odd_begins"))
    carried = carried.select(
        "file", "start", "_carry", F.coalesce(F.sum(begins).over(along.rowsBetween(*before)), F.lit(0)).alias("_earlier"),
        (F.sum("_parity").over(Window.partitionBy("file")) % 2).alias("_left_open"),
    )
    begun = F.sum(F.when(F.col("_odd") == F.col("_carry"), 1).otherwise(0)).over(inside.rowsBetween(*so_far))
    numbered = seen.join(carried, ["file", "start"]).withColumn("record", F.col("_earlier") + begun)
    sizes = numbered.groupBy("file", "record").agg(F.sum(F.length("value") + 1).alias("_size"), F.max("_left_open").alias("_left_open"))
    broken = sizes.where((F.col("_size") > longest) | (F.col("_left_open") == 1)).select("file").distinct()
    pieces = F.array_sort(F.collect_list(F.struct("start", "at", "value")))
    text = F.array_join(F.transform(pieces, lambda p: p["value"]), "\n")
    whole = numbered.join(broken, "file", "left_anti").groupBy("file", "record").agg(F.regexp_replace(text, "\r$", "").alias("text"))
    return whole.unionByName(broken.select("file", F.lit(2).cast("long").alias("record"), F.lit(None).cast("string").alias("text")))


def scan_records(
    spark: SparkSession, entity: str, deliveries: Iterable[Delivery], folder: str, *, per_file: bool = False
) -> DataFrame:
    """What ``scan`` gives, for files with line breaks in quotes that are read in splits; lines are kept in ``folder``."""
    where = lf.file_path if per_file else lf.delivery_path
    scans = []
    for i, (header, delimiter, own) in enumerate(_layouts(entity, deliveries)):
        records = cut_records(_numbered_lines(spark, [d.path for d in own], f"{folder}/{i}")).where("record > 1")
        cells = F.from_csv("text", _ddl(_cells(header)), {**_CSV, "sep": delimiter, "multiLine": "true"}).alias("cells")
        broken = F.col("text").isNull().alias("_odd")
        rows = records.where("text IS NULL OR text <> ''").select(cells, where(F.col("file")).alias("delivery"), broken)
        scans.append(_picked(rows.select("cells.*", "delivery", "_odd"), entity, header, F.col("delivery"), F.col("_odd")))
    return reduce(DataFrame.unionByName, scans) if scans else _no_rows(spark, entity)


def typed_rows(raw: DataFrame, entity: str) -> DataFrame:
    """Text rows in the declared types, ``_unfit`` where a value does not fit or the line is malformed."""
    fields = LANDING[entity].fields
    bad = reduce(lambda a, b: a | b, [lf.unfit(F.col(f.name), f.dataType) for f in fields])
    if "_malformed" in raw.columns:
        bad = bad | F.col("_malformed")
    odd = [F.col("_odd")] if "_odd" in raw.columns else []
    return raw.select(
        *[lf.typed(F.col(f.name), f.dataType).alias(f.name) for f in fields], "delivery", bad.alias("_unfit"), *odd
    )


def read_typed(
    spark: SparkSession,
    entity: str,
    found: Sequence[Delivery],
    folder: str | None = None,
    *,
    per_file: bool = False,
    whole_file: int = WHOLE_FILE,
) -> DataFrame:
    """Typed rows of all deliveries, ``_unfit`` where a value does not fit or the record is malformed.

    With ``folder`` the rows are written there, so that files are parsed once.  It is needed where a file is larger than
    ``whole_file``: deliveries in which a line has an odd number of quotes are then read again by records.
    """
    typed = typed_rows(scan(spark, entity, found, per_file=per_file, whole_file=whole_file), entity)
    large = any(d.largest > whole_file for d in found)
    if folder is None:
        if large:
            raise ValueError("large files need a folder for their rows")
        return typed.drop("_odd")
    typed.write.parquet(f"{folder}/rows")
    typed = spark.read.schema(typed.schema).parquet(f"{folder}/rows")
    odd = {r.delivery for r in typed.where("_odd").select("delivery").distinct().collect()} if large else set()  # deliveries
    if odd:
        again = scan_records(spark, entity, [d for d in found if d.path in odd], f"{folder}/lines", per_file=per_file)
        rows = typed_rows(again, entity)
        rows.write.parquet(f"{folder}/records")
        names = F.broadcast(spark.createDataFrame([(d,) for d in sorted(odd)], "delivery string"))
        typed = typed.join(names, "delivery", "left_anti").select(*rows.columns).unionByName(
            spark.read.schema(rows.schema).parquet(f"{folder}/records")
        )
    return typed.drop("_odd")


def bad_deliveries(raw: DataFrame, entity: str) -> DataFrame:
    """Deliveries with at least one row that does not fit: they are rejected whole."""
    return _bad(typed_rows(raw, entity))


def _bad(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("delivery")
        .agg(F.count_if("_unfit").alias("bad_rows"), F.count("*").alias("rows"))
        .where("bad_rows > 0")
    )


def reject_bad(raw: DataFrame, entity: str, *, deliveries: int) -> DataFrame:
    """Typed rows of the deliveries in which every value fits."""
    return _without_bad(typed_rows(raw, entity), deliveries)


def _without_bad(rows: DataFrame, deliveries: int) -> DataFrame:
    """``deliveries`` is the number of deliveries read: it bounds the reject list, which is
    broadcast while it is small so that no data row is shuffled.
    """
    rejected = _bad(rows).select("delivery")
    if deliveries <= _BROADCAST_DELIVERIES:
        rejected = F.broadcast(rejected)
    return rows.drop("_unfit").join(rejected, "delivery", "left_anti")


def with_lineage(rows: DataFrame, entity: str, loaded_at: datetime) -> DataFrame:
    """Stamp load time (one value per load), batch, origin date and the pending flag."""
    name = lf.landing_name(F.col("delivery"))
    return rows.select(
        *LANDING[entity].fieldNames(),
        F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("inserted_at"),
        lf.batch_of(name).alias("batch_value"),
        lf.origin_date_of(name).alias("origin_date"),
        F.lit(0).alias("merge_status"),
    )


def with_row_ids(
    rows: DataFrame, entity: str, existing: DataFrame | None = None, *, first_id: int = 1, numbered: str | None = None
) -> DataFrame:
    """Unique row ids from ``first_id``, or above those of ``existing``; no shuffle of rows is needed for them.

    With ``numbered``, a fresh folder, ids have no gaps: rows are written there with the number of their partition and their
    place in it, which a task that is run again cannot change any more, and the counts of the partitions before
    are added up.  Without it there are gaps between partitions.
    """
    offset = F.lit(first_id).cast("long")
    if existing is not None:
        offset = F.coalesce(existing.agg(F.max("row_id")).scalar(), F.lit(0)) + 1
    if numbered is None:
        with_ids = rows.withColumn("row_id", F.monotonically_increasing_id() + offset)
    else:
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        rows.withColumns({"_part": F.spark_partition_id(), "_place": place}).write.parquet(numbered)
        kept = rows.sparkSession.read.parquet(numbered)
        counts = kept.groupBy("_part").agg(F.count("*").alias("_n"))  # a row per partition from here on
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
        with_ids = kept.join(F.broadcast(starts), "_part").withColumn("row_id", F.col("_before") + F.col("_place") + offset)
    return with_ids.select(*[F.col(f.name).cast(f.dataType) for f in staging_schema(entity).fields])


@dataclass(frozen=True)
class Load:
    """Staging rows of one entity, the deliveries read, and those that could not be loaded."""

    entity: str
    rows: DataFrame
    rejects: DataFrame
    found: list[Delivery]


def load(
    spark: SparkSession,
    deliveries: DataFrame,
    entity: str,
    loaded_at: datetime,
    existing: DataFrame | None = None,
    *,
    first_id: int = 1,
    parsed: str | None = None,
    numbered: str | None = None,
    per_file: bool = False,
    whole_file: int = WHOLE_FILE,
) -> Load:
    """All loadable deliveries of one entity in one plan; a bad delivery does not stop the rest.

    With ``parsed``, a folder, the typed rows are written there first, so that files are parsed once for
    rows and rejects together.  ``numbered`` is as in ``with_row_ids``.
    """
    found = probe(spark, deliveries, entity)
    if parsed is None and any(d.largest > whole_file for d in found):
        parsed = shared_folder(spark, "parsed")
    typed = read_typed(spark, entity, found, parsed, per_file=per_file, whole_file=whole_file)
    rows = with_row_ids(
        with_lineage(_without_bad(typed, len(found)), entity, loaded_at), entity, existing, first_id=first_id, numbered=numbered
    )
    incomplete = [(d.path, "missing column " + ", ".join(missing_columns(d))) for d in found if missing_columns(d)]
    named = deliveries.where((F.col("table_name") == entity) & F.col("reason").isNotNull()).select("delivery", "reason")
    rejects = named.unionByName(
        spark.createDataFrame(incomplete, "delivery string, reason string")
    ).unionByName(_bad(typed).select("delivery", F.lit("bad value").alias("reason")))
    return Load(entity, rows, rejects, found)


def move(spark: SparkSession, deliveries: Iterable[str], landing: str, archive: str) -> None:
    """Move deliveries, files or folders, to the same places below ``archive``; what is no longer there is left out.

    A move is one renaming in the store, without a copy; many run at a time.
    """
    path_of, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    files = path_of(landing).getFileSystem(conf)
    root = files.makeQualified(path_of(landing)).toUri().getPath()

    def one(delivery: str) -> None:
        place = path_of(delivery).toUri().getPath().removeprefix(root).lstrip("/")
        target = path_of(f"{archive.rstrip('/')}/{place}")
        if files.exists(path_of(delivery)):
            files.mkdirs(target.getParent())
            if not files.rename(path_of(delivery), target):
                raise OSError(f"cannot move {delivery} to {target}")

    with ThreadPoolExecutor(_AT_ONCE) as pool:
        list(pool.map(one, deliveries))


def append(rows: DataFrame, folder: str, entity: str) -> None:
    """Append a load to the staging table of its entity, partitioned by origin date."""
    rows.write.mode("append").partitionBy("origin_date").parquet(f"{folder}/{staging_name(entity)}")


def read_staging(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    schema = staging_schema(entity)
    return spark.read.schema(schema).parquet(f"{folder}/{staging_name(entity)}").select(*schema.fieldNames())
