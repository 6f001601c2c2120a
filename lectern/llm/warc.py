"""WARC archives: a deduplicating writer and a salvage reader.

The writer makes a record per row: the first of equal payloads is a response,
the others are revisit records that refer to it. Each record is a gzip member of
its own, and members stand in ``.warc.gz`` files of about ``archive_bytes`` of
payload in a folder that the cluster shares. Spark's own text writer puts the
bytes there, so lost executors and repeated tasks leave no half files: a row is
a member without its last byte, and that byte, the high byte of the length, is
zero and serves as the line separator.

The reader walks an archive member by member (or, in plain archives, record by
record). A member passes if it inflates with the right checksum and holds whole
records: a version line, a header, a block of the stated length, and digests that
match the bytes. After a failure it searches for the next byte offset at which a
member or a version line starts that passes these checks, goes on from there, and
logs the bytes between as a quarantined gap. Lengths and digests that the reader
reports come from bytes: from the block of a response, and for a revisit from the
response that it refers to (``resolve``).

Defined results: a null payload counts as empty, a null URL is left out; equal
ids each get a record, and a null id gets one without a number; of equal payloads
of at least ``min_dedup_bytes`` bytes the smallest id is the response (rows that
repeat it are responses too); an empty archive gives no record; a gap at the end
runs to the last byte; a revisit whose response is missing or has another digest
has no length, and its ``resolved`` is false.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.llm.common import checkpoint, small_batches, tidy

VERSION = re.compile(rb"WARC/1\.[01]\r\n")
GZIP = b"\x1f\x8b\x08"
LENGTH = re.compile(r"[0-9]+")
#: A member of no bytes.
EMPTY = gzip.compress(b"", mtime=0)
#: Tasks that the revisits of one response are dealt to.
SALTS = 16
RECORD = "archive_id string, offset long, size long, record_type string, record_id string, refers_to string, uri string, payload_bytes long, payload_digest string, payload binary"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, key: int | None, uri: str | None, payload: bytes, refers_to: int | None = None, date: str = "2020-01-01T00:00:00Z") -> bytes:
    """One uncompressed record; a revisit holds the headers alone."""
    block = b"" if kind == "revisit" else payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if key is None else key}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"Content-Length: {len(block)}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if uri is not None:
        lines.append("WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member; one whose length has a high byte is followed by an empty one, so that the last byte is zero."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = pack.compress(data) + pack.flush()
    return out if out.endswith(b"\0") else out + EMPTY


def records_of(df: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", min_dedup_bytes: int = 0, archive_bytes: int = 1 << 27) -> DataFrame:
    """``member``: one gzip member per row of ``df``, dealt to as many partitions as archives are wanted."""
    small_batches(df)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = df.select(F.col(id_col).cast("long").alias("key"), F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"))
    digests = checkpoint(rows.select("key", F.sha1("payload").alias("digest"), F.length("payload").cast("long").alias("n")))
    # Counted before the shuffle: a payload with many copies is one row for each task. Ids are joined, not payloads.
    firsts = digests.filter((F.col("n") >= min_dedup_bytes) & F.col("key").isNotNull()).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    roles = digests.join(firsts.select("digest", "first"), "digest").filter("key is null or key <> first").select("key", "digest", "first").distinct()
    total = digests.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    archives = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // archive_bytes))
    # Rows without an id are dealt by their payload. The keys of the join are plain columns, so that it takes the rows as
    # they are dealt; a null-safe comparison would deal all payloads a second time.
    known, dealt_by = F.coalesce("key", F.lit(0).cast("long")), ["id", "none", "digest"]
    dealt = rows.select("*", known.alias("id"), F.col("key").isNull().alias("none"), F.sha1("payload").alias("digest")).repartition(archives, *dealt_by)
    joined = dealt.join(roles.select(known.alias("id"), F.col("key").isNull().alias("none"), "digest", "first").repartition(archives, *dealt_by), dealt_by, "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for key, uri, data, first in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                made.append(member(record("response" if first is None else "revisit", key, uri, data, first)))
            yield pa.RecordBatch.from_pydict({"member": pa.array(made, pa.binary())})

    return joined.select("key", "uri", "payload", "first").mapInArrow(tidy(write), "member binary")


def write_archives(df: DataFrame, folder: str, **options) -> None:
    """Write a record per row of ``df`` to ``.warc.gz`` files in the new ``folder``; options as for ``records_of``."""
    line = F.substring("member", 1, F.length("member") - 1).cast("string")  # the bytes as they are
    records_of(df, **options).select(line.alias("value")).write.option("lineSep", "\0").text(folder)
    # The writer's names are changed on the file system; a rename moves no bytes.
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.listStatus(path):
        name = found.getPath().getName()
        if name.endswith(".txt"):
            files.rename(found.getPath(), spark._jvm.org.apache.hadoop.fs.Path(path, name.removesuffix(".txt") + ".warc.gz"))


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """``archive_id`` (path) and ``content`` of the files in ``folder``."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder).select(F.col("path").alias("archive_id"), "content")


def parse_record(data: bytes, at: int = 0) -> tuple[dict, bytes, int] | None:
    """Header, block and end of the record that starts at ``at``; None if it is not whole and sound."""
    if not VERSION.match(data, at):
        return None
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return None
    try:
        lines = data[at:end].decode("utf-8").split("\r\n")[1:]
    except UnicodeDecodeError:
        return None
    head = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        head[name.strip().lower()] = value.strip()
    if not LENGTH.fullmatch(head.get("content-length", "")):
        return None
    start = end + 4
    stop = start + int(head["content-length"])
    block = data[start:stop]
    if data[stop : stop + 4] != b"\r\n\r\n" or len(block) != stop - start:
        return None
    if not _agrees(head.get("warc-block-digest", ""), block):
        return None
    if head.get("warc-type") != "revisit" and not _agrees(head.get("warc-payload-digest", ""), payload_of(head, block)):
        return None
    return head, block, stop + 4


def payload_of(head: dict, block: bytes) -> bytes:
    """The block, without the header of a message that it may hold."""
    if not head.get("content-type", "").lower().startswith("application/http"):
        return block
    return block.partition(b"\r\n\r\n")[2]


def _agrees(said: str, data: bytes) -> bool:
    return not said.startswith("sha1:") or said[5:] == base32_sha1(data)


def _inflated(content: bytes, at: int) -> tuple[bytes, int] | None:
    """The data of the gzip member at ``at`` and its end; zlib checks length and checksum."""
    unpack = zlib.decompressobj(31)
    out, step = [], 1 << 16
    for start in range(at, len(content), step):
        try:
            out.append(unpack.decompress(content[start : start + step]))
        except zlib.error:
            return None
        if unpack.eof:
            return b"".join(out), min(start + step, len(content)) - len(unpack.unused_data)
    return None


def _at(content: bytes, at: int) -> tuple[list[tuple[dict, bytes]], int] | None:
    """The records that start at ``at`` and their end."""
    if content.startswith(GZIP, at):
        got = _inflated(content, at)
        if got is None:
            return None
        data, end = got
        records, inner = [], 0
        while inner < len(data):
            one = parse_record(data, inner)
            if one is None:
                return None
            records.append(one[:2])
            inner = one[2]
        return records, end
    one = parse_record(content, at)
    return ([one[:2]], one[2]) if one else None


def _next(content: bytes, at: int) -> int:
    """The next offset from ``at`` on where a member or a version line begins."""
    zipped = content.find(GZIP, at)
    plain = VERSION.search(content, at)
    starts = [x for x in (zipped, plain.start() if plain else -1) if x >= 0]
    return min(starts, default=len(content))


def salvage(content: bytes) -> tuple[list[tuple[int, int, dict, bytes]], list[tuple[int, int]]]:
    """Sound records (offset, size, header, block) and quarantined gaps (start, end)."""
    records, gaps, at = [], [], 0
    while at < len(content):
        got, start = _at(content, at), at
        while got is None and at < len(content):
            at = _next(content, at + 1)
            got = _at(content, at) if at < len(content) else None
        if at > start:
            gaps.append((start, at))
        if got is None:
            break
        records += [(at, got[1] - at, head, block) for head, block in got[0]]
        at = got[1]
    return records, gaps


def _urn(text: str | None) -> str | None:
    return text.strip("<>") if text else None


def read_archives(archives: DataFrame) -> DataFrame:
    """Records and gaps of archives (``archive_id``, ``content``).

    A gap is a row of type ``quarantined`` with its offset, size and bytes.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                records, gaps = salvage(content or b"")
                rows = []
                for at, size, h, block in records:
                    revisit, payload = h.get("warc-type") == "revisit", payload_of(h, block)
                    said = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    known = (None, said) if revisit else (len(payload), base32_sha1(payload))
                    rows.append((name, at, size, h.get("warc-type"), _urn(h.get("warc-record-id")), _urn(h.get("warc-refers-to")), h.get("warc-target-uri"), *known, payload))
                rows += [(name, start, end - start, "quarantined", None, None, None, None, None, content[start:end]) for start, end in gaps]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

    small_batches(archives)
    return archives.select("archive_id", "content").mapInArrow(tidy(read, 1), RECORD)


def resolve(records: DataFrame) -> DataFrame:
    """Records with ``resolved``, and for revisits the length and digest of the response that they refer to."""
    responses = records.filter("record_type = 'response'").groupBy("record_id").agg(F.min("payload_bytes").alias("_bytes"), F.min("payload_digest").alias("_digest"))
    # A response with very many revisits meets them in several tasks.
    known = responses.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    revisits = records.filter("record_type = 'revisit'").withColumn("_salt", F.pmod(F.xxhash64("record_id", "offset"), F.lit(SALTS)).cast("int"))
    found = revisits.join(known.withColumnRenamed("record_id", "refers_to"), ["refers_to", "_salt"], "left").withColumn("resolved", F.coalesce(F.col("_digest") == F.col("payload_digest"), F.lit(False)))
    found = found.withColumn("payload_bytes", F.when(F.col("resolved"), F.col("_bytes"))).select(*records.columns, "resolved")
    return records.filter("record_type <> 'revisit' or record_type is null").withColumn("resolved", F.lit(True)).unionByName(found)


def page_key(urn: str):
    """The number in ``urn:page:N``."""
    return F.regexp_extract(urn, r"^urn:page:(-?\d+)$", 1).try_cast("long")
