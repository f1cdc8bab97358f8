import gzip
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from stratamart.llm import warc

PAGES = [
    (3, "http://www.b.com/x?q=1#top", "p" * 200), (1, "https://B.com:80/x?q=1", "p" * 200), (2, "http://a.org/é \r\n y", "WARC/1.1\r\n\r\n\r\n" + "é" * 90),
    (4, None, None), (5, "", "short"), (6, "http://c.net/", "short"), (7, "ftp://u@a.org", "q" * 500_000), (None, "http://z.z/", "p" * 200), (8, "http://z.z/", "p" * 99), (9, "y", "p" * 99),
    (3, "http://b.com/again", "p" * 200),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, digest string").repartition(3)


@pytest.mark.parametrize("size", [100, 8_000_000])
def test_round_trip(spark, pages, tmp_path, monkeypatch, size):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", size)
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    path, index = str(tmp_path / "archives"), str(tmp_path / "index")
    warc.write_archives(pages, path)
    warc.write_index(spark, path, index)
    got = sorted((tuple(r) for r in warc.read_all(spark, path, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)
    expected = []
    for page_id, _, html in PAGES:
        data = (html or "").encode()
        revisit = len(data) >= 100 and html == "p" * 200 and page_id != 1
        expected.append((page_id, len(data), sha256(data).hexdigest(), "revisit" if revisit else "response", 1 if revisit else None))
    assert got == sorted(expected, key=repr)
    # Each archive is plain gzip of plain records.
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "archives").glob("part-*"))
    assert whole.count(b"WARC-Type: ") == len(PAGES)
    asked = spark.createDataFrame([("http://b.com/x?q=1",), ("http://z.z/",), ("http://none.at/",), (None,)], "url string")
    assert sorted((r["page_id"] for r in warc.look_up(asked, path, index).collect()), key=repr) == [1, 3, 8, None]


@pytest.fixture
def indexed(spark, pages, tmp_path, monkeypatch):
    """Small archives whose index has a line per block and two blocks per shard."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 100)
    monkeypatch.setattr(warc, "BLOCK_LINES", 1)
    monkeypatch.setattr(warc, "SHARD_BLOCKS", 2)
    path, index = str(tmp_path / "archives"), str(tmp_path / "index")
    warc.write_archives(pages, path)
    warc.write_index(spark, path, index)
    return path, index


def test_all_urls_through_shards_and_blocks(spark, pages, indexed):
    path, index = indexed
    shards = [r["n"] for r in spark.read.parquet(f"{index}/directory").groupBy("shard").agg({"block": "count"}).toDF("shard", "n").collect()]
    assert len(shards) > 1 and max(shards) <= 2
    # The page without a url is found by the empty one.
    assert warc.look_up(pages.select("url"), path, index).count() == len(PAGES)
    every = warc.look_up(pages.selectExpr("coalesce(url, '') as url"), path, index, payloads=False)
    assert every.columns == warc.named(warc.RECORD) and every.count() == len(PAGES)
    assert sorted(map(repr, every.collect())) == sorted(map(repr, warc.read_all(spark, path, index).drop("payload").collect()))


def test_what_is_not_asked_for_stays_unread(spark, indexed, tmp_path):
    path, index = indexed
    directory = spark.read.parquet(f"{index}/directory")
    wanted = [r["block"] for r in directory.where("first <= 'com,b)/x?q=1' and last >= 'com,b)/x?q=1'").collect()]
    assert len(wanted) == 2
    broken = str(tmp_path / "broken")
    blocks = spark.read.parquet(f"{index}/blocks")
    marked = blocks.withColumn("data", F.when(F.col("block").isin(wanted), F.col("data")).otherwise(F.lit(b"no block")))
    marked.write.parquet(f"{broken}/blocks")
    directory.write.parquet(f"{broken}/directory")
    needed = {r["path"] for r in warc.opened(blocks.where(F.col("block").isin(wanted))).collect()}
    for file in (tmp_path / "archives").glob("part-*"):
        if not any(p.endswith(file.name) for p in needed):
            file.write_bytes(b"no archive")
    asked = spark.createDataFrame([("http://b.com/x?q=1",)], "url string")
    got = warc.look_up(asked, path, broken).collect()
    assert sorted((r["page_id"], bytes(r["payload"])) for r in got) == [(1, b"p" * 200), (3, b"")]


def test_archives_that_only_spark_opens(spark, pages, indexed, monkeypatch):
    path, index = indexed
    by_offset = sorted(map(repr, warc.look_up(pages.select("url"), path, index).collect()))
    monkeypatch.setattr(warc, "positioned", lambda path: False)
    assert sorted(map(repr, warc.look_up(pages.select("url"), path, index).collect())) == by_offset


def test_reads_and_paths(monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 100)
    monkeypatch.setattr(warc, "GAP", 5)
    spans = [(300, 500), (0, 40), (45, 40), (95, 5), (106, 90)]
    assert list(warc.stretches(spans)) == [[(0, 40), (45, 40)], [(95, 5)], [(106, 90)], [(300, 500)]]
    assert list(warc.stretches([])) == []
    assert warc.store_of("file:/a/b c")[1] == warc.store_of("file:///a/b c")[1] == warc.store_of("/a/b c")[1] == "/a/b c"
    assert not warc.positioned("viewfs://x/y") and not warc.positioned("/none/such") and warc.positioned("/")


def test_keys():
    assert warc.url_key("https://www.Example.co.uk:443/a?b#c") == "uk,co,example)/a?b"
    assert warc.url_key("http://x.y/é \n") == warc.url_key(warc.header_url("http://x.y/é \n")) == "y,x)/%C3%A9%20%0A"
    assert warc.url_key(None) == warc.url_key("") == ")/"


def test_empty(spark, pages, tmp_path):
    path, index = str(tmp_path / "archives"), str(tmp_path / "index")
    warc.write_archives(pages.limit(0), path)
    warc.write_index(spark, path, index)
    assert warc.read_all(spark, path, index).count() == 0
