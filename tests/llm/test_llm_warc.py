"""Archives written, indexed and read back by ranges."""

import gzip
import hashlib
import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from shopstrata.llm import warc  # noqa: E402
from shopstrata.llm.scratch import Scratch  # noqa: E402

SCHEMA = "page_id bigint, url string, html string"


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "warc")


def odd_pages():
    big, same = "<p>é漢</p>" * 200_000, "copy " * 30
    return [
        (1, "http://a/1", None), (2, "http://a/2", ""), (3, None, same), (7, "http://b/ü ?q=a b\r\nX: y", same), (5, "u", same),
        (None, "http://n", same), (3, "http://a/3", same), (8, "http://c", "x" * 99), (9, "http://c", "x" * 99),
        (10, "http://d", "x" * 100), (11, "http://d", "x" * 100), (12, "", "\r\n\r\nWARC/1.1\r\n" * 20), (13, "e", big),
        (14, "e", big), (None, "f", "lone " * 40), (None, "g", "lone " * 40), (15, "h", "z" * 500), (15, "h", "z" * 500),
    ]


def expected(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        peers = [k for k, _, h in rows if (h or "") == (html or "") and k is not None]
        again = len(data) >= 100 and peers and i != min(peers)
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", min(peers) if again else None))
    return brute.in_order(out)


def columns(df):
    return df.select(F.col("record_id").cast("long"), "payload_bytes", "payload_digest", "record_type",
                     F.col("refers_to").cast("long"))


def test_round_trip_of_odd_pages(spark, scratch):
    df = spark.createDataFrame(odd_pages(), SCHEMA).repartition(3).withColumns(
        {c: F.lit("x") for c in ("key", "digest", "payload", "first", "copies", "bytes", "refers_to", "offset")})
    index = warc.write_archives(df, scratch, f"{scratch.folder}/archives")
    got = warc.read_records(index, f"{scratch.folder}/archives")
    assert brute.in_order(columns(got).collect()) == expected(odd_pages())
    texts = {h for _, _, h in odd_pages() if h} | {""}
    assert {bytes(r.payload).decode() for r in got.where("payload is not null").collect()} == texts
    assert got.where("record_id = 12").first().url == ""
    assert got.where("record_id = 7").first().url == "http://b/%C3%BC%20?q=a%20b%0D%0AX:%20y"


def test_archives_are_gzip_members_at_the_indexed_places(spark, scratch, tmp_path):
    rnd = random.Random(1)
    rows = [(i, f"http://x/{i}", "".join(rnd.choices("abcdef ", k=rnd.randint(0, 3000)))) for i in range(200)]
    folder = str(tmp_path / "archives")
    index = warc.write_archives(spark.createDataFrame(rows, SCHEMA), scratch, folder, archive_bytes=20_000).collect()
    assert len({r.archive for r in index}) > 5
    for name in {r.archive for r in index}:
        data = (Path(folder) / name).read_bytes()
        mine = sorted((r for r in index if r.archive == name), key=lambda r: r.offset)
        assert mine[-1].offset + mine[-1].length == len(data)
        assert all(a.offset + a.length == b.offset for a, b in zip(mine, mine[1:]))
        assert gzip.decompress(data[:mine[0].offset]).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        for r in mine:
            record = warc.parse_record(gzip.decompress(data[r.offset:r.offset + r.length]))
            assert (record["record_id"], record["url"], record["payload_digest"]) == (r.record_id, r.url, r.digest)
            assert record["payload"].decode() == rows[int(r.record_id)][2]


def test_a_selection_reads_few_ranges(spark, scratch, tmp_path):
    rows = [(i, f"http://host{i % 2}/{i}", f"page {i} " * 50) for i in range(300)]
    folder = str(tmp_path / "archives")
    index = warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), scratch, folder)
    chosen = index.where("url like 'http://host1/%' and cast(record_id as int) < 100")
    assert sorted(int(r.record_id) for r in warc.read_records(chosen, folder).collect()) == list(range(1, 100, 2))
    places = sorted((r.archive, r.offset, r.length) for r in chosen.collect())
    for gap, reach, reads in ((1 << 16, 1 << 23, 1), (-1, 1 << 23, 50), (1 << 16, 0, 50)):
        reader = warc._Reader(folder, gap, reach)
        assert len(list(reader.records(places))) == 50 and reader.reads == reads
    assert len(list(warc._Reader(folder, 1 << 16, 1 << 23).records([places[0]] * 3))) == 3


def test_damage_is_noticed(spark, scratch, tmp_path):
    record = warc.record_bytes("1", "u", b"abc", hashlib.sha256(b"abc").hexdigest(), None, "2020-01-01T00:00:00Z")
    assert warc.parse_record(record)["payload"] == b"abc"
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(record.replace(b"abc", b"abd"))
    with pytest.raises(ValueError, match="no WARC"):
        warc.parse_record(record[3:])


def test_empty_table(spark, scratch, tmp_path):
    index = warc.write_archives(spark.createDataFrame([], SCHEMA), scratch, str(tmp_path / "a"))
    assert warc.read_records(index, str(tmp_path / "a")).collect() == []
