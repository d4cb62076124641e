"""Landing folders: schemas inferred once and kept, and rows that never get lost.

A file may hold values that do not fit the schema, columns the schema does not
know, or columns in another order. Such values go to ``_rescued_data`` as JSON and
the row stays.
"""

from __future__ import annotations

import csv
import json
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from shopstrata import storage
from shopstrata.functions.columns import named

RESCUED = "_rescued_data"
RAGGED = "_corrupt_record"
SOURCE_FILE = "source_file"

FILE_TIME = "file_modified"

#: Names that ingestion itself gives to columns. A file's own column of such a name is
#: renamed, so its values are rescued like those of any column the schema does not know.
RESERVED = {RESCUED, RAGGED, SOURCE_FILE, FILE_TIME, "_metadata", "ingest_timestamp", "_ingest_batch"}
RENAMED = {f"{name}_" for name in RESERVED}


def kept_schema(
    spark: SparkSession, landing: str, keep_at: str, pattern: str = "*.csv", texts: Sequence[str] = ()
) -> StructType:
    """The schema stored at ``keep_at``; the first call infers it from all files in the landing folder.

    Headers and kinds of values are found by Spark jobs and reduced there; the driver sees one
    row for each distinct header. A column's type is the narrowest that holds its values in all
    files. Columns in ``texts`` are strings whatever the files hold: first files with plain
    numbers say nothing about later ones. The kinds of their values decide nothing, so they are not looked for.
    """
    if storage.exists(spark, keep_at):
        stored = StructType.fromJson(json.loads(storage.read_text(spark, keep_at)))
        return as_text(stored, texts)
    heads = file_headers(spark, landing, pattern)
    counts = {row.header: row["count"] for row in heads.groupBy("header").count().collect()}
    if not counts:
        raise FileNotFoundError(f"no {pattern} below {landing} to infer a schema from")
    names = {header: column_names(header) for header in counts}
    width = max(map(len, names.values()))
    settled = [n for n in range(width) if all(header[n] in texts for header in names.values() if n < len(header))]
    found = value_kinds(spark, landing, pattern, width, settled)
    if len(counts) == 1:  # all files have this header, so none need be looked up
        by_header = found.withColumn("header", F.lit(next(iter(counts))))
    else:
        by_header = found.join(heads, "file")
    by_header = by_header.groupBy("header").agg(*[F.bit_or(c).alias(c) for c in found.columns if c != "file"])
    kinds = {row.header: row[1:] for row in by_header.collect()}
    seen: dict[str, int] = {}
    for header in sorted(counts, key=lambda h: (-counts[h], h)):
        for name, kind in zip(names[header], kinds.get(header, [0] * len(names[header]))):
            seen[name] = seen.get(name, 0) | kind
    inferred = StructType()
    for name, kind in seen.items():
        if name not in RENAMED:
            inferred.add(name, narrowest(kind))
    storage.write_text(spark, keep_at, inferred.json())
    return as_text(inferred, texts)


def file_headers(spark: SparkSession, landing: str, pattern: str = "*.csv") -> DataFrame:
    """(file, header): the first line of every file that is not blank; files without one are left out.

    Lines are numbered in reading order, so a file's first line has the smallest number of those in
    its first block; numbers, not lines, are reduced, and then looked up. The numbers, one for each file
    as in Spark's own list of files, are broadcast: lines are not shuffled.
    """
    lines = _folder_reader(spark, pattern).text(landing).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
    ).withColumn("_line", F.monotonically_increasing_id())
    opening = lines.filter((F.col("_block") == 0) & (F.trim("value") != ""))
    first = opening.groupBy("file").agg(F.min("_line").alias("_line"))
    return opening.join(F.broadcast(first), ["file", "_line"]).select("file", F.col("value").alias("header"))


#: What a value can be read as, one bit each; the first that fits counts.
KINDS: tuple[DataType, ...] = (
    IntegerType(), LongType(), DecimalType(38, 0), DoubleType(), DateType(), TimestampType(), BooleanType())
TEXT = 1 << len(KINDS)


def value_kinds(
    spark: SparkSession, landing: str, pattern: str, width: int, settled: Sequence[int] = ()
) -> DataFrame:
    """(file, k0, k1, ...): for each place in a file's rows the bits of all kinds of values that occur.

    Rows are read by place, as text; reduced in each task to one row for each file. The values of a
    row go through one function as an array: generated code of a copy for each column would be too long to be
    compiled well. Places whose type is ``settled`` already get no bits.
    """
    places = StructType([StructField(f"c{n}", StringType()) for n in range(width)])
    rows = _folder_reader(spark, pattern).schema(places).option("header", True).csv(landing)
    asked = [n for n in range(width) if n not in settled]
    values = F.array(*[named(places.names[n]) for n in asked]).cast("array<string>")
    kinds = rows.select(F.col("_metadata.file_path").alias("file"), F.transform(values, _kind).alias("kinds"))
    bits = {n: F.bit_or(F.col("kinds")[at]) for at, n in enumerate(asked)}
    return kinds.groupBy("file").agg(*[bits.get(n, F.max(F.lit(0))).alias(f"k{n}") for n in range(width)])


#: What a cast leaves out at the ends of a value.
_ENDS = r"[\x00- \x7f]*"
#: First characters of all values that a cast to any of the kinds may take, and all such values, with more among them;
#: other values are texts. A cast that fails costs a Java exception, many times the work of a pattern.
_LEADS = (*range(33), 127, *map(ord, "+-.0123456789tTfFyYnNiI"))
_POSSIBLE = (
    rf"(?is)^(?:[-+.\d\x00- \x7f][-+.:/~\w\x00- \x7f]*|(?:t|true|f|false|y|yes|n|no|nan|inf|infinity|t\d.*){_ENDS})$")
_DOUBLE = (
    rf"(?i)^{_ENDS}[-+]?(?:nan|inf|infinity|0x[\da-f.]+p[-+]?\d+[fd]?|(?:\d+\.?\d*|\.\d+)(?:e[-+]?\d+)?[fd]?){_ENDS}$")
_MOMENT = rf"(?i)^{_ENDS}(?:[-+]?\d{{4}}|t\d)"
_SHORT_WHOLE = r"^-?\d{1,9}$"  # fits 32 bits, whatever the digits
_BOOLEAN = rf"(?i)^{_ENDS}(?:t|true|f|false|y|yes|n|no|1|0){_ENDS}$"


def _kind(text: Column) -> Column:
    """The bit of the first kind that a value fits; blanks around it make a text."""

    def bit(kind: type[DataType]) -> Column:
        return F.lit(1 << [type(k) for k in KINDS].index(kind))

    def fits(kind: DataType, able: Column) -> Column:
        return F.when(able & text.try_cast(kind).isNotNull(), bit(type(kind)))

    short, long, any_whole = text.try_cast("bigint"), F.length(text) > 18, text.try_cast(KINDS[2])
    whole = (
        F.when(long, F.when(any_whole.between(-(1 << 31), (1 << 31) - 1), bit(IntegerType))
               .when(any_whole.between(-(1 << 63), (1 << 63) - 1), bit(LongType))
               .when(any_whole.isNotNull(), bit(DecimalType)))
        .when(short.between(-(1 << 31), (1 << 31) - 1), bit(IntegerType)).when(short.isNotNull(), bit(LongType)))
    found = F.coalesce(
        F.when(text.contains(":") | ~F.ascii(text).between(*map(ord, "+9")) & ~text.rlike(_POSSIBLE), F.coalesce(
            fits(TimestampType(), text.contains(":") & text.rlike(_POSSIBLE)), F.lit(TEXT))),
        F.when(text.rlike(r"^[+-]?\d{1,38}$"), whole),
        fits(DateType(), text.rlike(r"^[+-]?\d{4,}(-\d{1,2}){1,2}$")),  # a cast would drop a time
        fits(DoubleType(), text.rlike(_DOUBLE)),
        fits(TimestampType(), text.rlike(_MOMENT) & text.rlike(_POSSIBLE)),
        fits(BooleanType(), text.rlike(_BOOLEAN)),
        F.lit(TEXT))
    blank = text.isNull() | (text == "")
    sure_text = text.startswith(" ") | text.endswith(" ") | ~F.ascii(text).isin(*_LEADS)
    return (
        F.when(blank, F.lit(0)).when(text.rlike(_SHORT_WHOLE), bit(IntegerType))
        .when(sure_text, F.lit(TEXT)).otherwise(found))


def narrowest(kinds: int) -> DataType:
    """The narrowest type that holds values of all these kinds; text where nothing else does, or nothing is known."""
    held = [kind for n, kind in enumerate(KINDS) if kinds >> n & 1]
    if not held or kinds & TEXT:
        return StringType()
    for ladder in (KINDS[:3], (KINDS[0], KINDS[1], KINDS[3]), KINDS[4:6], KINDS[6:]):
        if all(kind in ladder for kind in held):
            return max(held, key=ladder.index)
    return StringType()


def as_text(schema: StructType, texts: Sequence[str]) -> StructType:
    changed = StructType([
        StructField(f.name, StringType(), True) if f.name in texts else f for f in schema])
    for name in texts:
        if name not in schema.names:
            changed.add(name, StringType())
    return changed


def landing_files(spark: SparkSession, landing: str, pattern: str = "*.csv") -> DataFrame:
    """Paths in a landing folder. The binary reader lists files without opening them."""
    return _file_reader(spark.read, pattern).load(landing).select("path")


def stream_landing_files(
    spark: SparkSession, landing: str, pattern: str = "*.csv", max_files: int = 1000
) -> DataFrame:
    """A stream of newly arrived paths, files already there included.

    By default a file stream passes over files a week older than the newest it has
    seen; a late delivery that kept its old time would be lost.
    """
    reader = _file_reader(spark.readStream, pattern).option("maxFilesPerTrigger", max_files)
    return reader.option("maxFileAge", "36500d").load(landing).select("path")


def _folder_reader(spark: SparkSession, pattern: str):
    return spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)


def _file_reader(reader, pattern: str):
    return (
        reader.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
    )


def read_as_strings(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """All columns of all files as strings, matched by each file's own header."""
    groups = files_by_header(spark, paths)
    if not groups:
        return None
    parts = [_read_group(spark, files, header) for header, files in groups.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def files_by_header(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Group the files of one batch of the stream (``max_files`` at most) by their header columns.

    Only the first line of each file is opened, as Spark's own reader does to name columns.
    """
    with ThreadPool(min(32, max(1, len(paths)))) as pool:
        headers = pool.map(lambda path: storage.first_line(spark, path), paths)
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in zip(paths, headers):
        if header:  # an empty file has neither columns nor rows
            groups.setdefault(column_names(header), []).append(path)
    return groups


def column_names(header: str) -> tuple[str, ...]:
    names: list[str] = []
    for name in next(csv.reader([header.lstrip("\ufeff")])):
        name = name.strip() or "_unnamed"
        while name in names or name in RESERVED:  # such a column keeps its values under another name
            name += "_"
        names.append(name)
    return tuple(names)


def _read_group(spark: SparkSession, files: Sequence[str], header: Sequence[str]) -> DataFrame:
    schema = StructType()
    for name in (*header, RAGGED):
        schema.add(name, StringType())
    reader = spark.read.schema(schema).option("header", True).option("columnNameOfCorruptRecord", RAGGED)
    return reader.csv(list(files)).select(
        "*", F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias(FILE_TIME))


def rescued(strings: DataFrame, schema: StructType) -> DataFrame:
    """Type the columns of ``schema``; what does not fit goes to ``_rescued_data``."""
    present = set(strings.columns)
    typed: list[Column] = []
    misfit: list[tuple[str, Column]] = []
    for field in schema:
        if field.name not in present:
            typed.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        raw = named(field.name)
        value = raw.try_cast(field.dataType)
        typed.append(value.alias(field.name))
        if not isinstance(field.dataType, StringType):
            misfit.append((field.name, F.when(value.isNull(), raw)))
    known = {*schema.names, SOURCE_FILE, FILE_TIME}
    misfit += [(c, named(c)) for c in strings.columns if c not in known]

    entries = [part for name, value in misfit for part in (F.lit(name), value)]
    if entries:
        left_over = F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())
        # Most rows fit, and those build no map.
        payload = F.when(F.coalesce(*[v for _, v in misfit]).isNotNull(), F.to_json(left_over))
    else:
        payload = F.lit(None).cast("string")
    origin = [named(c) for c in (SOURCE_FILE, FILE_TIME) if c in present]
    return strings.select(*typed, payload.alias(RESCUED), *origin)
