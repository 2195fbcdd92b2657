import gzip
from pathlib import Path

import pytest

from riskloom.llm import warc
from riskloom.session import shared_dir

SCHEMA = "page_id long, url string, html string, file string"
ROWS = [
    (5, "http://a/ b", "é" * 80, "x"), (2, "u2", "é" * 80, "x"), (9, "u9", "é" * 80, "x"), (None, None, "é" * 80, "x"), (3, "u3", "short", "x"),
    (4, "u4", "short", "x"), (6, "u6", None, "x"), (7, None, "", "x"), (2, "u2", "é" * 80, "x"), (8, "u8", "y" * 500_000, "x"),
    (None, "n", "z" * 200, "x"), (None, "n", "z" * 200, "x"),
]


def folder(spark):
    return shared_dir(spark, "test_warc")


def contents(path):
    return {p.name: p.read_bytes() for p in Path(path.removeprefix("file:")).glob("*.warc.gz")}


def test_round_trip(spark):
    at = folder(spark)
    warc.write(spark.createDataFrame(ROWS, SCHEMA), at)
    rows = warc.read(spark, at).collect()
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.html) for r in rows), key=repr)
    e, z = "é" * 80, "z" * 200
    want = [
        (2, "response", None, 160, e), (2, "response", None, 160, e), (5, "revisit", 2, 160, None), (9, "revisit", 2, 160, None), (None, "revisit", 2, 160, None),
        (3, "response", None, 5, "short"), (4, "response", None, 5, "short"), (6, "response", None, 0, ""), (7, "response", None, 0, ""),
        (8, "response", None, 500_000, "y" * 500_000), (None, "response", None, 200, z), (None, "response", None, 200, z),
    ]
    assert got == sorted(want, key=repr)
    assert {r.url for r in rows if r.page_id == 5} == {"http://a/%20b"}


def test_files_roll_and_do_not_depend_on_partitions(spark):
    rows = [(i, f"http://x/{i}", f"{i} " * 300, "") for i in range(300)]
    first, second = folder(spark), folder(spark)
    made = warc.write(spark.createDataFrame(rows, SCHEMA).repartition(3), first, 60_000, 2000).collect()
    warc.write(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7), second, 60_000, 2000)
    assert contents(first) == contents(second)
    assert {r.file for r in made} == set(contents(first)) and len(made) > 10
    assert max(r.bytes for r in made) < 4000
    assert gzip.decompress(contents(first)[made[0].file]).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    ids = [r.page_id for r in warc.read(spark, first).orderBy("file").collect()]
    assert sorted(ids) == list(range(300))


def test_damage_is_found(spark):
    record = warc._record([("WARC-Type", "response"), ("WARC-Record-ID", "x"), ("WARC-Payload-Digest", "sha256:0"), ("WARC-Target-URI", "u")], b"HTTP/1.1 200 OK\r\nContent-Length: 1\r\n\r\nab")
    with pytest.raises(ValueError, match="damaged payload"):
        warc.parse(gzip.decompress(record))
    with pytest.raises(ValueError, match="damaged record"):
        warc.parse(gzip.decompress(record).replace(b"ab\r\n", b"ac\r\n"))


def test_empty_table(spark):
    at = folder(spark)
    assert warc.write(spark.createDataFrame([], SCHEMA), at).count() == 0
    assert warc.read(spark, at).count() == 0
