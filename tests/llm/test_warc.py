import gzip
import hashlib
from pathlib import Path

import pytest

from levyflow.llm import warc
from levyflow.llm.warc import (
    archive_round_trip, build_index, look_up, parse_record, read_records, url_key, with_revisits, write_archives,
)
from tests.llm.tables import with_clashes
from tests.oracle import compare, scratch_below

SCHEMA = "page_id long, url string, html string"
LONG = "<p>" + "é" * 200 + "</p>"
PAGES = [
    (5, "http://www.Example.com/b?q=1#top", LONG), (3, "https://example.com:80/a", LONG), (9, "http://blog.example.com/a", LONG),
    (1, "http://example.com/a", "short"), (2, "http://example.com/a", "short"), (4, None, None), (6, "", ""),
    (7, "not a url", "x" * 99), (8, "not a url", "x" * 99), (10, "http://h/\r\nWARC-Type: x", "y" * 100),
    (11, "http://[bad", "y" * 100), (12, '"quoted"', "\r\n\r\n" * 50), (None, "http://example.com/a", LONG), (3, "https://example.com:80/a", LONG),
    (13, "http://x.org/漢", "z" * 3_000_000),
]


def expected(rows):
    first = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 100:
            first[html] = min(page, first.get(html, page))
    out = []
    for page, url, html in rows:
        raw = (html or "").encode()
        revisit = html in first and page != first[html]
        out.append((page, url, "revisit" if revisit else "response", first[html] if revisit else None, len(raw),
                    hashlib.sha256(raw).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_lines", [2000, 2])
def test_every_record_comes_back_through_the_index(spark, block_lines, tmp_path):
    pages = with_clashes(spark.createDataFrame(PAGES, SCHEMA).repartition(3))
    got = archive_round_trip(spark, pages, f"file://{tmp_path}", block_lines=block_lines)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(PAGES)


def test_archives_are_members_that_any_reader_opens(spark, tmp_path):
    folder = f"file://{tmp_path}"
    write_archives(with_revisits(spark.createDataFrame(PAGES, SCHEMA)), folder)
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path).glob("*.warc.gz"))
    assert whole.count(b"WARC/1.1\r\n") == len(PAGES)


@pytest.mark.parametrize("block_lines", [3, 50])
def test_look_up_finds_all_captures_and_no_others(spark, tmp_path, block_lines):
    """One URL has most captures and spans blocks and files."""
    pages = [(i, f"http://h{i % 7}.net/{i}" if i % 3 else "http://hot.net/", f"page {i}") for i in range(300)]
    folder = f"file://{tmp_path}"
    captures = write_archives(with_revisits(spark.createDataFrame(pages, SCHEMA).repartition(5)), folder)
    index = build_index(captures, folder, block_lines)
    keys = [url_key(u) for _, u, _ in pages[::10]] + ["net,hot)/", "absent)/", "", "zzz"]
    asked = spark.createDataFrame([(k,) for k in keys] + [(None,)], "url_key string")
    found = look_up(index, asked)
    wanted = sorted((url_key(u), i) for i, u, _ in pages if url_key(u) in keys)
    assert sorted((r.url_key, r.page_id) for r in found.collect()) == wanted
    assert sorted(r.page_id for r in read_records(found, folder).collect()) == sorted(i for _, i in wanted)


@pytest.mark.parametrize("url, key", [
    ("http://www.Example.com:8080/A?b=C#d", "com,example)/A?b=C"), ("example.com", "com,example)/"), (None, ""), ("  ", ""),
    ("http://user@h.org", "org,h)/"),
])
def test_url_key(url, key):
    assert url_key(url) == key


def test_payload_may_look_like_a_header():
    from levyflow.llm.warc import _record

    record = parse_record(_record("response", 1, "http://a\nb", b"x\r\n\r\ny", "d", 6, None))
    assert (record.payload, record.url, record.page_id) == (b"x\r\n\r\ny", "http://a\nb", 1)


def test_no_rows(spark, tmp_path):
    assert archive_round_trip(spark, spark.createDataFrame([], SCHEMA), f"file://{tmp_path}").count() == 0


def test_matches_sql_with_copies(spark, tmp_path):
    import duckdb

    from levyflow.llm.catalog import ORACLES, QUERIES

    rows = [(i, f"http://a/{i}", ("copy " * 40) if i % 3 == 0 else f"page {i} " * (i % 30)) for i in range(200)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    frame = QUERIES["op4_warc"](spark, str(tmp_path)).toPandas()
    frame["refers_to"] = frame["refers_to"].astype("Int64")
    assert compare(frame, db, ORACLES["op4_warc"]).startswith("ok")


def test_archives_on_another_file_system(spark, tmp_path):
    from pyarrow import fs

    name = f"pages{abs(hash(str(tmp_path)))}"
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{name}.link./data", f"file://{tmp_path}")
    mount, place = f"viewfs://{name}/data", str(tmp_path)

    def opened(folder):
        assert folder.startswith(mount)
        return fs.LocalFileSystem(), place + folder.removeprefix(mount)

    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    with scratch_below(spark, mount):
        got = archive_round_trip(spark, pages, opener=opened)
    assert sorted((tuple(r) for r in got.select("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest").collect()),
                  key=repr) == expected(PAGES)
    assert list(tmp_path.glob("levyflow/archives-*/archive-*.warc.gz"))
    with pytest.raises(ValueError, match="give an opener"):  # before any job
        archive_round_trip(spark, pages, folder=f"{mount}/x")


def test_names_of_schemes(monkeypatch):
    asked = []
    monkeypatch.setattr(warc.fs, "FileSystem", type("Stores", (), {"from_uri": staticmethod(asked.append)}))
    for folder in ("s3a://bucket/a b", "S3N://bucket/x", "hdfs://host:1/x", "file:///x", "/x", "gs://b/s3a://"):
        warc.open_folder(folder)
    assert asked == ["s3://bucket/a b", "s3://bucket/x", "hdfs://host:1/x", "file:///x", "/x", "gs://b/s3a://"]
