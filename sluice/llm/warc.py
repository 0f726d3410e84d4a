"""WARC archives with an embedded Zstandard dictionary.

Each page becomes one WARC/1.1 record whose block is an HTTP response with the HTML as payload. Of records with equal
payloads (SHA-256) of at least ``least`` bytes, the one with the smallest page_id is a response and the others revisit it
without their payload. Pages go to archives by a hash of their id, as many as their bytes call for. An archive begins
with a skippable frame that holds a dictionary trained on the archive's records; each record then is a Zstandard frame of
its own that needs this dictionary, so any record can be read alone.

The trainer sees a bounded sample: records in the order of a hash of their digest and id, the first ``piece`` bytes of
each, until ``sample`` bytes are reached. That bounds a fit and nothing else: every record is written whole.

Archives are kept as rows (archive, position, frame) of a table in the shared folder, so that any file system that
Spark knows will do; an archive's file is its frames one after the other, and ``export`` writes such files to a mounted
folder. Reading parses the frames only: what it returns comes from the records.

Null HTML is an empty payload. A null page_id is written as such and is never the record that others revisit. Rows that
repeat a page_id with an equal payload are responses all. Line breaks in URLs are percent-encoded. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import join_hot, prepare, stored

#: Format constants: the skippable frame that holds a dictionary, and a dictionary's own magic number.
SKIPPABLE, DICTIONARY = 0x184D2A5D, 0xEC30A437
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DICTIONARY_BYTES, LEVEL = 65536, 3
#: Bytes of records that a dictionary is trained on at most, and of one record.
SAMPLE_BYTES, PIECE_BYTES = 4 << 20, 65536


def _own(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest) with null HTML as empty."""
    text = F.coalesce("html", F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", text.alias("html"), F.sha2(text.cast("binary"), 256).alias("digest"))


def revisits(pages: DataFrame, least: int) -> DataFrame:
    """(page_id, url, digest, refers_to) of the records that revisit another; HTML goes no further than its digest."""
    rows = _own(pages).where(F.octet_length("html") >= least).select("page_id", "url", "digest")
    first = rows.where(F.col("page_id").isNotNull()).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("times"))
    again = join_hot(rows, first.where("times > 1"), "digest", "inner").where(F.col("page_id").isNull() | (F.col("page_id") > F.col("refers_to")))
    return again.select("page_id", "url", "digest", "refers_to").distinct()


def _name(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"null" if page_id is None else b"%d" % page_id)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = [b"WARC/1.1", b"WARC-Type: response" if refers_to is None else b"WARC-Type: revisit", b"WARC-Record-ID: " + _name(page_id), b"WARC-Date: " + date.encode()]
    if url is not None:
        head.append(b"WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A").encode())
    if refers_to is not None:
        head += [b"WARC-Refers-To: " + _name(refers_to), b"WARC-Profile: " + PROFILE.encode()]
    head += [b"WARC-Payload-Digest: sha256:" + digest.encode(), b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """A record's headers and block."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != b"WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(b": ", 1) for line in lines[1:])
    size = int(fields[b"Content-Length"])
    block = rest[:size]
    if rest[size:] != b"\r\n\r\n" or len(block) != size:
        raise ValueError("a record's length does not fit")
    return {"fields": fields, "block": block}


def dictionary(records: list[bytes], sample: int = SAMPLE_BYTES, piece: int = PIECE_BYTES) -> bytes:
    """A dictionary trained on a sample of records; for too few to train on, the shortest of them."""
    taken, size = [], 0
    for r in sorted(records, key=lambda r: hashlib.blake2b(r, digest_size=8).digest()):
        if size >= sample:
            break
        taken.append(r[:piece])
        size += len(taken[-1])
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, size // 8)), taken).as_bytes()
    except zstandard.ZstdError:
        return min(records, key=len)[:DICTIONARY_BYTES]


def _loaded(content: bytes) -> zstandard.ZstdCompressionDict:
    trained = content[:4] == struct.pack("<I", DICTIONARY)
    return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)


def archive_frames(records: list[bytes], sample: int = SAMPLE_BYTES, piece: int = PIECE_BYTES) -> Iterator[bytes]:
    """The frames of one archive: the dictionary's skippable frame, then one frame for each record."""
    content = dictionary(records, sample, piece)
    yield struct.pack("<II", SKIPPABLE, len(content)) + content
    d = _loaded(content)
    d.precompute_compress(level=LEVEL)
    c = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=True, write_checksum=True)
    for r in records:
        yield c.compress(r)


def read_frames(frames: list[bytes]) -> Iterator[bytes]:
    """The records of one archive's frames."""
    magic, size = struct.unpack_from("<II", frames[0])
    if magic != SKIPPABLE or len(frames[0]) != 8 + size:
        raise ValueError("an archive begins with its dictionary")
    d = zstandard.ZstdDecompressor(dict_data=_loaded(frames[0][8:]))
    for f in frames[1:]:
        yield d.decompress(f)


def _write(date: str, sample: int, piece: int):
    def run(pages: pa.Table, again: pa.Table) -> pa.Table:
        to = {(r["page_id"], r["digest"]): r["refers_to"] for r in again.to_pylist()}
        rows = pages.sort_by([("page_id", "ascending"), ("digest", "ascending")]).to_pylist()
        records = [record(r["page_id"], r["url"], r["html"].encode(), r["digest"], to.get((r["page_id"], r["digest"])), date) for r in rows]
        frames = list(archive_frames(records, sample, piece)) if records else []
        return pa.table({"archive": pa.array([r["archive"] for r in rows[:1]] * len(frames), pa.int32()), "position": pa.array(range(len(frames)), pa.int64()), "frame": pa.array(frames, pa.binary())})

    return run


def _read(table: pa.Table) -> pa.Table:
    out: dict[str, list] = {k: [] for k in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")}
    for raw in read_frames(table.sort_by("position").column("frame").to_pylist()):
        r = parse(raw)
        f = r["fields"]
        http, _, payload = r["block"].partition(b"\r\n\r\n")
        told = f[b"WARC-Payload-Digest"].removeprefix(b"sha256:").decode()
        n = int(http.rpartition(b"Content-Length: ")[2])
        kind = f[b"WARC-Type"].decode()
        if kind == "response" and (n != len(payload) or hashlib.sha256(payload).hexdigest() != told):
            raise ValueError("a payload differs from its digest")
        name = lambda x: None if x is None or x == b"<urn:page:null>" else int(x[10:-1])
        for k, v in zip(out, (name(f[b"WARC-Record-ID"]), n, told, kind, name(f.get(b"WARC-Refers-To"))), strict=True):
            out[k].append(v)
    return pa.table({"page_id": pa.array(out["page_id"], pa.int64()), "payload_bytes": pa.array(out["payload_bytes"], pa.int64()), "payload_digest": pa.array(out["payload_digest"], pa.string()), "record_type": pa.array(out["record_type"], pa.string()), "refers_to": pa.array(out["refers_to"], pa.int64())})


def write_archives(pages: DataFrame, *, least: int = 100, archive_bytes: int = 16 << 20, sample: int = SAMPLE_BYTES, piece: int = PIECE_BYTES, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """The written archives (archive, position, frame) of pages (page_id, url, html)."""
    prepare(pages.sparkSession)
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    archives = max(1, -(-total // archive_bytes))
    archive = F.pmod(F.xxhash64("page_id", "url"), F.lit(archives)).cast("int")
    rows = _own(pages).withColumn("archive", archive).repartition(archives, "archive")
    again = revisits(pages, least).toDF("page_id", "url", "digest", "refers_to").withColumn("archive", archive).repartition(archives, "archive")
    written = rows.groupBy("archive").cogroup(again.groupBy("archive")).applyInArrow(_write(date, sample, piece), "archive int, position long, frame binary")
    return stored(written, "warc")


def _by_archive(archives: DataFrame) -> DataFrame:
    """As many partitions as archives, so that a task holds few whatever the session's setting."""
    return archives.repartition((archives.agg(F.max("archive")).first()[0] or 0) + 1, "archive")


def read_archives(archives: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record."""
    prepare(archives.sparkSession)
    return _by_archive(archives).groupBy("archive").applyInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def _export(folder: str):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        name = f"{folder}/part-{table.column('archive')[0].as_py():06d}.warc.zst"
        with open(name, "wb") as f:
            for frame in table.column("frame").to_pylist():
                f.write(frame)
        return pa.table({"file": [name], "records": pa.array([table.num_rows - 1], pa.int64())})

    return run


def export(archives: DataFrame, folder: str) -> DataFrame:
    """Writes each archive as a .warc.zst file to a folder that all executors have mounted: (file, records)."""
    return _by_archive(archives).groupBy("archive").applyInArrow(_export(folder), "file string, records long")
