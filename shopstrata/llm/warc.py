"""WARC archives with an index, read back by byte ranges.

Writing: every task appends its records to archives of its own below a folder that all
executors share, one gzip member a record, and returns an index row for each: archive, offset,
length, url, digest. A record whose payload another record holds becomes a ``revisit`` without
payload. The index is what is committed. A task that is run again writes new archives under new
names; files of lost attempts are in no index row and go with the folder.

Reading: index rows are selected by any condition, dealt out by stretch of archive, sorted by
offset, and neighbouring ranges are fetched in one read. Payloads are checked against their
digest.

Folders are opened through ``pyarrow.fs`` on the executors (local and mounted paths, hdfs, s3, gs).
"""

from __future__ import annotations

import hashlib
import time
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.llm.scratch import Scratch

LEAST_REVISIT = 100  # bytes; smaller payloads are always written
ARCHIVE_BYTES = 1 << 30  # an archive that has grown past this is closed
GAP = 64 << 10  # unwanted bytes that one read may pass over
REACH = 8 << 20  # most bytes of a read, unless one record is longer
SPAN = 16 << 20  # stretch of an archive that is read by one task
MOST_TASKS = 20_000  # beyond this many spans a task reads several
OUT_BYTES = 4 << 20

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "archive string, offset long, length long, record_id string, url string, digest string, record_type string"
RECORD = ("record_id string, url string, record_type string, payload binary, payload_bytes long, "
          "payload_digest string, refers_to string")
EOL = b"\r\n"


def _urn(key: str | None) -> str:
    return "<urn:page:" + quote(key or "", safe="") + ">"


def _key(urn: str) -> str | None:
    return unquote(urn[len("<urn:page:"):-1]) or None


def _headers(fields: list[tuple[str, str | None]]) -> bytes:
    return b"".join(f"{name}: {value}".encode() + EOL for name, value in fields if value is not None) + EOL


def record_bytes(key: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One uncompressed record; with ``refers_to`` a revisit, whose HTTP head still states the full length."""
    http = b"HTTP/1.1 200 OK" + EOL + _headers(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))])
    again = refers_to is not None
    block = http if again else http + payload
    return b"WARC/1.1" + EOL + _headers([
        ("WARC-Type", "revisit" if again else "response"), ("WARC-Record-ID", _urn(key)), ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else quote(url, safe="".join(map(chr, range(33, 127))))),
        ("WARC-Profile", PROFILE if again else None), ("WARC-Refers-To", _urn(refers_to) if again else None),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block)))]) + block + EOL + EOL


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8").split("\r\n")
    return first, {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}


def parse_record(data: bytes) -> dict:
    """The record's fields by the names of ``RECORD``; the payload's digest is computed anew."""
    head, _, rest = data.partition(EOL + EOL)
    version, fields = _fields(head)
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(EOL + EOL)
    size, stated = int(_fields(http)[1]["content-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
    again = fields["warc-type"] == "revisit"
    if not again and (len(payload) != size or hashlib.sha256(payload).hexdigest() != stated):
        raise ValueError(f"the payload of {fields['warc-record-id']} does not fit its digest")
    return {
        "record_id": _key(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"], "payload": None if again else payload, "payload_bytes": size,
        "payload_digest": stated, "refers_to": _key(fields["warc-refers-to"]) if again else None,
    }


class _Archives:
    """Archives of one task, opened one after another."""

    def __init__(self, folder: str, date: str, archive_bytes: int):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.lead, self.date, self.limit = uuid.uuid4().hex, date, archive_bytes
        self.stream, self.name, self.count, self.at = None, "", 0, 0

    def _write(self, record: bytes) -> int:
        packer = zlib.compressobj(wbits=31)
        packed = packer.compress(record) + packer.flush()
        self.stream.write(packed)
        self.at += len(packed)
        return len(packed)

    def append(self, record: bytes) -> tuple[str, int, int]:
        if self.stream is None:
            self.name, self.at = f"{self.lead}-{self.count:05d}.warc.gz", 0
            self.stream = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
            about = _headers([("software", "shopstrata"), ("format", "WARC File Format 1.1")])
            self._write(b"WARC/1.1" + EOL + _headers([
                ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", self.date),
                ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(about)))]) + about + EOL + EOL)
        begin = self.at
        place = self.name, begin, self._write(record)
        if self.at >= self.limit:
            self.close()
        return place

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream, self.count = None, self.count + 1


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder, made where it is missing, as a name that workers without Hadoop's defaults understand."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    name = fs.makeQualified(path).toString()
    return "file://" + name[len("file:"):] if name.startswith("file:/") and not name.startswith("file://") else name


def payload_copies(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(digest, first, copies) of payloads of at least ``least`` bytes that several rows hold."""
    return pages.where(F.col("bytes") >= least).groupBy("digest").agg(
        F.min("key").alias("first"), F.count("*").alias("copies")).where("copies > 1")


def write_archives(pages: DataFrame, scratch: Scratch, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", least: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES,
                   date: str | None = None) -> DataFrame:
    """Write one record for each row below ``folder`` and return the index, a row for each record.

    The payload is the text in UTF-8; null is empty. Of the rows with equal payloads of at
    least ``least`` bytes, that with the smallest id is a response and the others are revisits
    of it; so are rows with a null id where another row has one. Rows that share the smallest id
    are all responses, as are all rows where no id is given and all smaller payloads. Other
    columns are not looked at; an empty table makes an empty index.

    Digests and ids alone are reduced to the table of copies, with partial sums before the
    shuffle. The pages are joined with that table: in place while it is small (Spark decides by
    its written size), else by digest, where AQE splits the rows of a frequent payload.
    """
    spark, date = pages.sparkSession, date or time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    keyed = pages.select(F.col(id_col).alias("key"), F.col(url_col).alias("url"), payload.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("bytes"))
    copies = scratch.table(payload_copies(keyed, least), "copies")
    marked = keyed.join(copies, "digest", "left").select(
        F.col("key").cast("string"), "url", "payload", "digest",
        F.when((F.col("bytes") >= least) & ~F.col("key").eqNullSafe(F.col("first")), F.col("first"))
        .cast("string").alias("refers_to"))
    folder = qualified(spark, folder)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = _Archives(folder, date, archive_bytes)
        for batch in batches:
            keys, urls, payloads, digests, refers = batch.columns
            places = []
            for i in range(batch.num_rows):
                key, url, digest, to = (c[i].as_py() for c in (keys, urls, digests, refers))
                places.append(archives.append(record_bytes(key, url, payloads[i].as_py(), digest, to, date)))
            names, offsets, lengths = zip(*places) if places else ((), (), ())
            yield pa.RecordBatch.from_arrays([
                pa.array(names, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), keys, urls,
                digests, pa.array(["response" if to is None else "revisit" for to in refers.to_pylist()], pa.string()),
            ], schema=_arrow(INDEX))
        archives.close()

    return scratch.table(marked.mapInArrow(work, INDEX), "index")


def _arrow(columns: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))])


class _Reader:
    """Records at given places, fetched in reads that cover several neighbours."""

    def __init__(self, folder: str, gap: int, reach: int):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.gap, self.reach, self.name, self.file, self.reads = gap, reach, None, None, 0

    def records(self, places: list[tuple[str, int, int]]) -> Iterator[bytes]:
        low = 0
        while low < len(places):
            name, begin, length = places[low]
            end, high = begin + length, low + 1
            while high < len(places) and places[high][0] == name and begin <= places[high][1] <= end + self.gap:
                further = max(end, places[high][1] + places[high][2])
                if further - begin > self.reach:
                    break
                end, high = further, high + 1
            data = self._fetch(name, begin, end - begin)
            for _, offset, size in places[low:high]:
                yield zlib.decompress(data[offset - begin:offset - begin + size], wbits=31)
            low = high

    def _fetch(self, name: str, begin: int, size: int) -> bytes:
        if name != self.name:
            if self.file is not None:
                self.file.close()
            self.name, self.file = name, self.fs.open_input_file(f"{self.folder}/{name}")
        self.reads += 1
        return self.file.read_at(size, begin)


def read_records(index: DataFrame, folder: str, gap: int = GAP, reach: int = REACH, span: int = SPAN) -> DataFrame:
    """The records (``RECORD``) of the given index rows; rows may be any selection, repeats included.

    Index rows go to tasks by stretch of archive (``span`` bytes) and are sorted there; the
    number of tasks follows the bytes to read. A damaged record fails the task. An empty id
    comes back as null; the payload of a revisit is null, its length and digest are there.
    """
    folder = qualified(index.sparkSession, folder)
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = min(MOST_TASKS, 1 + total // span)
    dealt = index.select("archive", "offset", "length", F.expr(f"offset div {int(span)}").alias("stretch"))
    dealt = dealt.repartition(tasks, "archive", "stretch").sortWithinPartitions("archive", "offset")
    schema = _arrow(RECORD)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(folder, gap, reach)
        for batch in batches:
            held, size = [], 0
            places = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            for data in reader.records(places):
                held.append(parse_record(data))
                size += len(data)
                if size > OUT_BYTES:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
            yield pa.RecordBatch.from_pylist(held, schema)

    return dealt.mapInArrow(work, RECORD)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    folder = f"{scratch.folder}/archives"
    index = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch, folder)
    return read_records(index, folder).select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t)::BIGINT AS payload_bytes, sha256(t) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""
