import glob
import gzip
import os
import random
import zlib

import pytest

from clientlens.llm import warc
from clientlens.llm.queries import QUERIES

from .helpers import sf_dir

SCHEMA = "page_id bigint, url string, html string"
PAGES = [(3, "http://a/x", "<p>same</p>"), (1, "http://b/y", "<p>same</p>"), (2, None, "<p>other ü</p>"), (4, "http://c\r\nX: y", None),
         (5, "http://c/", ""), (None, "http://d/", "<p>same</p>"), (None, "http://d/", "alone"), (7, "http://e", "twice"),
         (7, "http://e", "twice"), (8, "http://f", "x" * 300_000)]


def _expected(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    return sorted(((i, len((h or "").encode()), warc.base32_sha1((h or "").encode()),
                    "response" if first.get(h or "", i) == i else "revisit",
                    None if first.get(h or "", i) == i else first[h or ""]) for i, _, h in rows), key=str)


def test_round_trip_of_awkward_pages(spark):
    d = sf_dir(pages=spark.createDataFrame(PAGES, SCHEMA).repartition(3))
    got = [tuple(r) for r in QUERIES["op7_warc"](spark, d).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=str) == _expected(PAGES)


def test_files_are_plain_multi_member_gzip(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "a")
    warc.write_archive(spark.createDataFrame(PAGES, SCHEMA).coalesce(1), path)
    (name,) = [n for n in glob.glob(path + "/part-*") if os.path.getsize(n)]
    with gzip.open(name) as f:
        text = f.read()
    assert text.count(b"WARC/1.1\r\n") == len(PAGES) and b"<p>other \xc3\xbc</p>" in text
    records = {r.page: r for r in warc.read_archive(spark, path).collect() if r.page}
    assert records["4"].url == "http://c%0D%0AX: y" and records["2"].url is None and records["8"].digest_ok
    assert bytes(records["8"].payload) == b"x" * 300_000


def _stored(payload, page):
    """A member whose deflate data is stored plainly, so that it holds the
    payload's bytes, magics included."""
    warc_level, warc.LEVEL = warc.LEVEL, 0
    try:
        return warc.member(page, None, payload, None)
    finally:
        warc.LEVEL = warc_level


@pytest.mark.parametrize("split", [97, 700, 5_000, 1 << 20])
def test_ranges_and_chance_magics(spark, tmpdir_path, split):
    """Every record is read once and whole, wherever ranges begin and with
    magics inside of members, also many in a row and at their ends."""
    rng = random.Random(split)
    payloads = [b"".join(rng.choice([warc.MAGIC, b"\x1f", b"\x1f\x8b", rng.randbytes(5), b"WARC/", b"abc" * 9])
                         for _ in range(rng.randrange(0, 120))) for _ in range(40)]
    payloads += [warc.MAGIC * 50, b"", b"\0" * 50]
    path = os.path.join(tmpdir_path, "b")
    os.makedirs(path)
    for k in range(2):
        with open(os.path.join(path, f"part-{k}.warc"), "wb") as f:
            f.write(b"".join(_stored(p, f"{k}-{i}") for i, p in enumerate(payloads)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = warc.read_archive(spark, path)
        if split < 1000:
            assert rows.rdd.getNumPartitions() > 4
        got = {r.page: bytes(r.payload) for r in rows.collect()}
        assert rows.count() == 2 * len(payloads)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {f"{k}-{i}": p for k in range(2) for i, p in enumerate(payloads)}


def test_damaged_member_does_not_hide_its_neighbours(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "c")
    os.makedirs(path)
    parts = [warc.member(str(i), None, f"payload {i} ".encode() * 20, None) for i in range(5)]
    parts[2] = parts[2][:len(parts[2]) // 2]
    with open(os.path.join(path, "part-0"), "wb") as f:
        f.write(b"".join(parts))
    rows = warc.read_archive(spark, path).collect()
    assert sorted(r.page for r in rows if r.record_type == "response") == ["0", "1", "3", "4"]
    assert any(r.record_type == "damaged" for r in rows)


def test_large_records_end_in_a_zero_byte():
    m = warc.member("1", None, random.Random(0).randbytes(17 << 20), None)
    assert m[-1] == 0 and len(gzip.decompress(m)) > 17 << 20
    assert zlib.decompressobj(31).decompress(m)[:5] == b"WARC/"


def test_empty(spark):
    assert QUERIES["op7_warc"](spark, sf_dir(pages=spark.createDataFrame([], SCHEMA))).count() == 0


@pytest.mark.parametrize("split", [97, 5_000, 1 << 20])
def test_archives_with_a_codec_name(spark, tmpdir_path, split):
    """``.warc.gz`` files are cut into byte ranges like any other, beside plain names."""
    rng = random.Random(split)
    payloads = [b"".join(rng.choice([warc.MAGIC, b"\x1f", b"\x1f\x8b", rng.randbytes(5), b"abc" * 9])
                         for _ in range(rng.randrange(0, 120))) for _ in range(30)] + [warc.MAGIC * 50, b""]
    for name in ("a.warc.gz", "b.warc.GZ", "c.warc"):
        with open(os.path.join(tmpdir_path, name), "wb") as f:
            f.write(b"".join(_stored(p, f"{name}-{i}") for i, p in enumerate(payloads)))
    open(os.path.join(tmpdir_path, "empty.warc.gz"), "wb").close()
    got = {r.page: bytes(r.payload) for r in warc.read_archive(spark, tmpdir_path, split).collect()}
    assert got == {f"{n}-{i}": p for n in ("a.warc.gz", "b.warc.GZ", "c.warc") for i, p in enumerate(payloads)}
    one = warc.read_archive(spark, os.path.join(tmpdir_path, "a.warc.gz"), split)
    assert one.count() == len(payloads)


def test_a_file_system_that_only_spark_knows(spark, tmpdir_path, monkeypatch):
    with open(os.path.join(tmpdir_path, "a.warc.gz"), "wb") as f:
        f.write(b"".join(warc.member(str(i), None, f"payload {i} ".encode() * 20, None) for i in range(20)))

    def unknown(uri):
        raise OSError("no such file system")
    monkeypatch.setattr(warc, "_open_range", unknown)
    assert sorted(int(r.page) for r in warc.read_archive(spark, tmpdir_path).collect()) == list(range(20))


def test_ranges_own_the_magics_that_begin_inside():
    import io
    data = b"before" + warc.MAGIC + b"one" + warc.MAGIC + warc.MAGIC + b"three" + b"\x1f"
    for size in range(1, len(data) + 2):
        pieces = [p for s in range(0, len(data), size) for p in warc.cut_range(io.BytesIO(data), s, s + size)]
        assert pieces == [b"before", b"one", b"", b"three\x1f"]


def test_one_payload_on_most_pages(spark):
    """The error page that a third and more of all pages share is stored once."""
    rows = [(i, f"http://h/{i}", "error" if i % 3 else f"page {i}") for i in range(300)]
    got = [tuple(r) for r in QUERIES["op7_warc"](spark, sf_dir(pages=spark.createDataFrame(rows, SCHEMA).repartition(9))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=str) == _expected(rows)
