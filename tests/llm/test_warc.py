"""WARC bundles: round trip, seek table, SQL, edge cases."""

import glob
import struct

import duckdb
import zstandard

from streambed.llm import warc
from streambed.llm.queries import SQL, op8_warc
from tests.compare import difference, duck
from tests.llm.fixtures import TINY

ROWS = [
    (1, "http://a/ü x", "<p>one</p>"), (5, "http://b", "<p>one</p>"), (3, None, "<p>one</p>"), (7, "u", ""), (8, "u", None),
    (9, "u", "é" * 5000), (None, "n", "<p>one</p>"), (None, "n", "alone"), (5, "http://b", "<p>one</p>"),
    (4, "c", "a\r\n\r\nb: c\r\n\r\n"),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "page_id long, url string, html string, payload string, frame int"
    )


def test_round_trip_of_payloads_types_and_references(spark, tmp_path):
    index = warc.write_archives(pages(spark), f"file://{tmp_path}/w", frame_bytes=300)
    found = warc.read_records(index).collect()
    assert len(found) == len(ROWS)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in found), key=repr)
    want = []
    for page_id, _, html in ROWS:
        body = (html or "").encode()
        ids = [i for i, _, other in ROWS if (other or "") == (html or "") and i is not None]
        top = max(ids, default=None)
        revisit = top is not None and page_id != top
        want.append((page_id, "revisit" if revisit else "response", top if revisit else None, len(body), warc.digest(body)))
    assert got == sorted(want, key=repr)
    payloads = {r.payload_digest: r.payload for r in found if r.record_type == "response"}
    assert {bytes(p) for p in payloads.values()} == {(h or "").encode() for *_, h in ROWS}
    assert {r.url for r in found if r.page_id == 1} == {"http://a/%C3%BC%20x"}


def test_small_payloads_are_all_responses(spark, tmp_path):
    index = warc.write_archives(pages(spark), f"{tmp_path}/w", min_bytes=11)
    assert {r.record_type for r in warc.read_records(index).collect()} == {"response"}


def test_archives_are_plain_zstandard_with_a_seek_table(spark, tmp_path):
    many = [(k, f"http://x/{k}", "text %d " % k * 50) for k in range(200)]
    index = warc.write_archives(pages(spark, many).coalesce(1), f"{tmp_path}/w", frame_bytes=2000)
    rows = index.collect()
    assert sorted(r.record_id for r in rows) == sorted(warc.record_id(k) for k, *_ in many)
    for path in glob.glob(f"{tmp_path}/w/archives/*"):
        data = open(path, "rb").read()
        frames, flags, magic = struct.unpack("<IBI", data[-9:])
        assert (flags, magic) == (0, 0x8F92EAB1) and frames > 3
        with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as stream:
            text = stream.read()
        own = [r for r in rows if r.archive.endswith(path.rpartition("/")[2])]
        assert text.count(b"WARC/1.1\r\n") == len(own) + 1 and text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        reader = warc.Reader(path)
        for r in reversed(own):
            record = reader.record(r.frame, r.offset, r.length)
            assert record in text and warc.record_id(warc.decode(record)[0]) == r.record_id


def test_empty_table(spark, tmp_path):
    index = warc.write_archives(pages(spark, []), f"{tmp_path}/w")
    assert index.count() == 0 and warc.read_records(index).count() == 0


def test_query_against_sql(spark):
    assert difference(spark, duck(TINY), TINY, op8_warc, SQL["op8_warc"]) is None


def test_sql_finds_revisits(spark, tmp_path):
    rows = [r for r in ROWS if r[0] is not None][:6]
    pages(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert difference(spark, con, str(tmp_path), op8_warc, SQL["op8_warc"]) is None
