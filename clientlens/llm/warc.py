"""Operator 7: WARC archives, written and read back in splits.

Writing: payloads are digested with SHA-1; of equal payloads the page with the
smallest id becomes a response record, the others revisit records that carry no
payload. Each record is one gzip member. The members leave through Spark's text
sink, as raw bytes: a member always ends in a zero byte (the top byte of its
length, or an empty member after a record of 16 MiB and more), and that byte is
the line separator. So the files are plain multi-member gzip, committed task by
task by Spark, on any file system it can write.

Reading: Spark's line reader cuts the files at the gzip magic, any byte range
of a file at a time; files with a codec's name (``x.warc.gz``), which Spark would
inflate, are cut the same way by tasks that read byte ranges themselves. A range owns the candidates that start inside it and reads
on past its end to finish the last. A task decodes each candidate: compressed
data holds the magic by chance once in 16 million bytes, and then the
candidate's deflate stream is not finished and the next piece belongs to it. A
member is valid when it decodes and its content starts with a WARC version
line. Pieces that lose their other half to another range (a chance magic just
behind a range's start) are few; they are sorted by file and place and joined
in a second step.

Edge cases: a null payload is empty (and equal to empty ones); null ids come
last: a group without any id has responses only, and rows with the smallest id
are all responses; a null address gives a record without one; line breaks in
addresses are escaped; a damaged member becomes a record of type ``damaged``
and its neighbours are read; an empty table gives an empty archive; other
columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.llm import common
from clientlens.session import scratch_path

MAGIC = b"\x1f\x8b\x08"
REVISIT_BYTES = 0            # payloads of at least so many bytes are stored once
LEVEL = 1
# names for which Hadoop picks a codec
CODEC_NAMES = r"(?i)\.(gz|bz2|deflate|lz4|snappy|zst)$"
RANGE_BYTES = 64 << 20       # bytes of such a file that one task reads
READ_BYTES = 1 << 20
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the WARC 1.1 standard.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("record_type string, page string, refers_to string, url string, payload_digest string, "
          "payload_bytes bigint, payload binary, digest_ok boolean")
_FIELDS = ["record_type", "page", "refers_to", "url", "payload_digest", "payload_bytes", "payload", "digest_ok"]
_KINDS = [pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.bool_()]


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def member(page: str | None, url: str | None, payload: bytes, first: str | None) -> bytes:
    """The gzip member of one record; ``first``: the page it revisits."""
    digest = base32_sha1(payload)
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = head if first is not None else head + payload
    lines = [f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {_urn(page, digest)}",
             f"WARC-Date: {DATE}", "Content-Type: application/http;msgtype=response",
             f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page is not None:
        lines.append(f"Page-ID: {page}")
    if first is not None:
        lines += [f"WARC-Refers-To: {_urn(first, digest)}", f"Refers-To-Page-ID: {first}", f"WARC-Profile: {PROFILE}"]
    record = VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    out = packer.compress(record) + packer.flush()
    if out[-1]:
        empty = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        out += empty.compress(b"") + empty.flush()
    return out


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  revisit_bytes: int = REVISIT_BYTES) -> None:
    """Archives ``pages`` under ``path`` (one file per task)."""
    common.prepare(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    firsts = (rows.filter(F.octet_length("payload") >= revisit_bytes).groupBy("digest")
              .agg(F.min("id").alias("first"), F.count("*").alias("c")).filter("c > 1").drop("c"))
    marked = rows.join(firsts, "digest", "left").select(
        F.col("id").cast("string").alias("page"), "url", "payload",
        F.when((F.col("id") != F.col("first")) | F.col("id").isNull(), F.col("first")).cast("string").alias("first"))

    def records(batches):
        for b in batches:
            cols = (b.column(c).to_pylist() for c in ("page", "url", "payload", "first"))
            yield pa.RecordBatch.from_arrays([pa.array([member(*r)[:-1] for r in zip(*cols)], pa.binary())], names=["m"])

    (marked.mapInArrow(records, "m binary").select(F.col("m").cast("string").alias("value"))
     .write.option("lineSep", "\0").text(path))


class _Joiner:
    """Puts pieces (the bytes between two magics) back together to members."""

    def __init__(self):
        self.inflater, self.data, self.pieces = None, b"", []

    def feed(self, piece: bytes):
        """Yields (record bytes, None) for a finished member, or (None, pieces)
        for pieces that are no member on their own."""
        if self.inflater is not None:
            fresh = self._open(piece)
            if fresh is None or not fresh[1].startswith(VERSION[:5]):
                self.pieces.append(piece)
                try:
                    self.data += self.inflater.decompress(MAGIC + piece)
                except zlib.error:
                    yield None, self._reset()
                    return
                if self.inflater.eof:
                    data = self.data
                    self._reset()
                    yield data, None
                return
            yield None, self._reset()                # a new record begins: what was open is damaged
        opened = self._open(piece)
        if opened is None or opened[1] and not VERSION.startswith(opened[1][:5]):
            yield None, [piece]
        elif not opened[0].eof:
            self.inflater, self.data, self.pieces = opened[0], opened[1], [piece]
        elif opened[1]:                              # an empty member only ends a large record
            yield opened[1], None

    @staticmethod
    def _open(piece: bytes):
        inflater = zlib.decompressobj(31)
        try:
            return inflater, inflater.decompress(MAGIC + piece)
        except zlib.error:
            return None

    def _reset(self) -> list[bytes]:
        pieces, self.inflater, self.data, self.pieces = self.pieces, None, b"", []
        return pieces

    def rest(self) -> list[bytes]:
        return self._reset()


def parse(record: bytes) -> tuple:
    """The RECORD fields of one decoded record."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode(errors="replace").split("\r\n")[1:] if ": " in line)
    block = block[:int(fields.get("Content-Length", len(block)))]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = [x for x in http.decode("latin-1").split("\r\n") if x.lower().startswith("content-length:")]
    kind, digest = fields.get("WARC-Type", "damaged"), fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    size = int(stated[0].split(":")[1]) if stated else len(payload)
    if kind == "revisit":
        payload, ok = None, None
    else:
        own = base32_sha1(payload)
        digest, size, ok = own, len(payload), own == digest
    return (kind, fields.get("Page-ID"), fields.get("Refers-To-Page-ID"), fields.get("WARC-Target-URI"), digest, size,
            payload, ok)


def _batch(rows: list[tuple], loose: list[tuple]) -> pa.RecordBatch:
    """Records, then pieces left over: (file, range, place, piece)."""
    blank = [None] * len(loose)
    cols = [pa.array([r[i] for r in rows] + blank, k) for i, k in enumerate(_KINDS)]
    none = [None] * len(rows)
    cols += [pa.array(none + [x[i] for x in loose], k) for i, k in
             enumerate([pa.string(), pa.int64(), pa.int64(), pa.binary()])]
    return pa.RecordBatch.from_arrays(cols, names=[*_FIELDS, "file", "block", "place", "piece"])


def _scan(across_blocks: bool):
    """The task that turns pieces in file order into records. Pieces of one
    byte range follow each other; ``across_blocks``: those of a file do."""
    def run(batches):
        joiner, at, place = _Joiner(), None, 0
        for b in batches:
            rows, loose = [], []
            for file, block, raw in zip(*(b.column(c).to_pylist() for c in ("file", "block", "piece"))):
                here = (file, None if across_blocks else block)
                if here != at:
                    loose += [(*origin, place + i, p) for i, p in enumerate(joiner.rest())] if at else []
                    at, place = here, 0
                    if not across_blocks and block == 0:
                        continue                     # what stands before a file's first magic
                origin = (file, block)
                for record, left in joiner.feed(raw):
                    if record is not None:
                        rows.append(parse(record))
                    else:
                        loose += [(file, block, place + i, p) for i, p in enumerate(left)]
                        place += len(left)
            yield _batch(rows, loose)
        if at:
            left = joiner.rest()
            yield _batch([], [(*origin, place + i, p) for i, p in enumerate(left)])
    return run


_OUT = RECORD + ", file string, block bigint, place bigint, piece binary"


def _open_range(uri: str):
    """The file at a Hadoop path, for reads at any offset. Raises if pyarrow knows no
    such file system."""
    uri = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", uri))
    system, path = pyarrow.fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def cut_range(f, start: int, stop: int):
    """The pieces of one byte range of an open file: a range owns the magics that
    begin inside it, and a piece goes from a magic to the next one, wherever that
    is. The range from 0 gives what stands before its first magic too."""
    f.seek(start)
    held, base, search, inside = bytearray(), start, 0, start == 0
    while True:
        k = held.find(MAGIC, search)
        if k >= 0:
            if inside:
                yield bytes(held[:k])
            if base + k >= stop:
                return
            inside, search = True, 0
            base += k + len(MAGIC)
            del held[:k + len(MAGIC)]
            continue
        search = max(0, len(held) - len(MAGIC) + 1)
        if not inside:                                   # only a magic that has begun may matter
            base += search
            if base >= stop:
                return
            del held[:search]
            search = 0
        more = f.read(READ_BYTES)
        if not more:
            if inside:
                yield bytes(held)
            return
        held += more


def range_pieces(batches):
    """(file, block, piece) of (file, start, stop) byte ranges."""
    def record(file, start, pieces):
        return pa.RecordBatch.from_arrays([pa.array([file] * len(pieces), pa.string()), pa.array([start] * len(pieces), pa.int64()),
                                           pa.array(pieces, pa.binary())], names=["file", "block", "piece"])

    for batch in batches:
        for file, start, stop in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "stop"))):
            with _open_range(file) as f:
                out, size = [], 0
                for piece in cut_range(f, start, stop):
                    out.append(piece)
                    size += len(piece)
                    if size > READ_BYTES:
                        yield record(file, start, out)
                        out, size = [], 0
                yield record(file, start, out)


def _pieces(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    """(file, block, piece): what lies between the gzip magics of the files.

    Spark's text source cuts files at the magic by byte ranges, but it picks a codec
    by a file's name: of ``x.warc.gz`` it would give the inflated text, which has no
    magic. Such files are dealt as byte ranges, each read through the file system by
    a task; where pyarrow does not know the file system, they are read by the text
    source under Hadoop's pass-through codec, one task a file."""
    text = lambda reader, paths: (
        reader.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(paths)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                F.col("value").cast("binary").alias("piece")))
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    named = F.col("path").rlike(CODEC_NAMES)
    coded = files.filter(named).select("path").first()
    if coded is None:
        return text(spark.read, path)
    try:
        _open_range(coded.path).close()
        found = (files.filter(named & (F.col("length") > 0))
                 .select(F.col("path").alias("file"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
                 .withColumn("stop", F.col("start") + range_bytes).repartition("file", "start")
                 .mapInArrow(range_pieces, "file string, block bigint, piece binary"))
    except (OSError, pa.ArrowException):
        # file names, as Spark's own listing holds them too
        by_suffix: dict[str, list[str]] = {}
        for r in files.filter(named).select("path").collect():
            by_suffix.setdefault(r.path.rsplit(".", 1)[1].lower(), []).append(r.path)
        found = None
        for suffix, paths in by_suffix.items():
            reader = spark.read.option("io.compression.codecs", "org.apache.hadoop.io.compress.PassthroughCodec")
            for prefix in ("", "org.apache.hadoop.shaded."):         # the setting's name in Hadoop, and in its shaded client
                reader = reader.option(prefix + "io.compress.passthrough.extension", "." + suffix)
            part = text(reader, paths)
            found = part if found is None else found.unionByName(part)
    plain = [r.path for r in files.filter(~named).select("path").collect()]
    return found.unionByName(text(spark.read, plain)) if plain else found


def read_archive(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records under ``path``: RECORD's columns."""
    common.prepare(spark)
    found = _pieces(spark, path, range_bytes).mapInArrow(_scan(False), _OUT)
    whole = found.filter("piece is null").select(*_FIELDS)
    loose = found.filter("piece is not null").select("file", "block", "place", "piece")
    joined = (loose.repartition("file").sortWithinPartitions("file", "block", "place").mapInArrow(_scan(True), _OUT)
              .select(F.coalesce("record_type", F.lit("damaged")).alias("record_type"), *_FIELDS[1:]))
    return whole.unionByName(joined)


def archive_and_read(pages: DataFrame, **columns) -> DataFrame:
    """``pages`` written to a new archive in the shared folder and read back."""
    spark = pages.sparkSession
    common.prepare(spark)
    path = scratch_path(spark, f"llm-{spark.sparkContext.applicationId}-warc-{uuid.uuid4().hex}")
    write_archive(pages, path, **columns)
    return read_archive(spark, path)
