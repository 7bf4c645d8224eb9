"""WARC archives: written by Spark's text writer, read by byte ranges.

Every record is a gzip member of its own. Of records with equal payloads the one with the smallest page_id (then url; nulls last) is
the response, the others revisit it and hold no payload. A digest that more than a thousandth of all copies
share is looked up by broadcast (at most a thousand such), all others by a join, so copies of a page never meet in one task.

Files are written through Spark's committer, on any file system Spark can write: the text writer ends each value with one
separator byte, which is zero here, and a gzip member ends with the high byte of its length, which is zero below 16 MB; a longer
record is followed by an empty member. A file is thus plain concatenated members. Spark unpacks files named `.gz` as one stream, so
archives keep other names while Spark reads them; `renamed` gives them the usual one and takes it away.

The reader splits files into byte ranges of Spark's choice. A task looks for the magic bytes of gzip in its range and owns the
members that start there, reading on past its end for the last one. Magic bytes may also occur by chance inside a member: a candidate
is one only if it unpacks to a WARC header, anything else continues the member before it. What a range
cannot resolve alone (its last member up to such bytes, and the rest at the start of the next range) is joined by file and read again.
Bytes that belong to no intact record are returned as a row with their number in `broken`.

Null html is an empty payload. Null ids and urls are left out of the record. Repeated rows are records each. White space and controls
in urls are percent-encoded. The table must be stored, not computed anew on each read, so that equal rows can be told apart.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm import text as X
from ledgerwatch.sources.tables import matching_paths, scratch, staged

MAGIC = b"\x1f\x8b\x08"
GZIP = 31
EMPTY = zlib.compressobj(wbits=GZIP).flush()
SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURED = "2024-01-01T00:00:00Z"
#: A digest that more than one in so many copies have is common.
COMMON = 1000
_FIELDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, intact boolean, payload binary, broken long"
_PLACED = f"{_FIELDS}, file string, block long, nth long, piece binary"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def decided(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload, size, digest, revisit, first_id, first_url of each page: revisits have no payload; those smaller than `least` bytes are none."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url", "row"))
    grouped = rows.where(F.col("size") >= least).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), first.alias("first"))
    copies = staged(grouped.where("n > 1").select("digest", "n", "first.page_id", "first.url", "first.row"), "copies")
    kept = F.struct(F.col("page_id").alias("id"), "url", "row")
    common = F.col("n") * COMMON > copies.agg(F.sum("n")).scalar()
    many = copies.where(common).select("digest", kept.alias("many"))
    few = copies.where(~common).select(F.col("digest").alias("key"), kept.alias("few"))
    # Rows that have theirs already are spread by a key that matches nothing.
    key = F.when(F.col("many").isNull(), F.col("digest")).otherwise(F.concat(F.lit("row "), F.col("row").cast("string")))
    found = rows.join(F.broadcast(many), "digest", "left").withColumn("key", key).join(few, "key", "left").withColumn("first", F.coalesce("many", "few"))
    revisit = F.coalesce((F.col("size") >= least) & (F.col("first.row") != F.col("row")), F.lit(False))
    own = found.withColumn("revisit", revisit)
    return own.select(
        "page_id", "url", F.when(~F.col("revisit"), F.col("payload")).alias("payload"), "size", "digest", "revisit",
        *[F.when(F.col("revisit"), F.col(f"first.{c}")).alias(f"first_{c}") for c in ("id", "url")],
    )


def _uri(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def _record_id(page) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"


def member(page: dict, captured: str) -> bytes:
    """One record as gzip bytes that end with a zero byte."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page['size']}\r\n\r\n".encode()
    body = http + (page["payload"] or b"")
    fields = {
        "WARC-Type": "revisit" if page["revisit"] else "response",
        "WARC-Record-ID": _record_id(page["page_id"]) if page["page_id"] is not None else f"<urn:uuid:{uuid.uuid4()}>",
        "WARC-Target-URI": None if page["url"] is None else _uri(page["url"]),
        "WARC-Date": captured,
        "WARC-Payload-Digest": "sha1:" + base32(bytes.fromhex(page["digest"])),
        "Page-Id": page["page_id"],
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(body),
    }
    if page["revisit"]:
        fields |= {
            "WARC-Profile": SAME,
            "WARC-Refers-To": None if page["first_id"] is None else _record_id(page["first_id"]),
            "WARC-Refers-To-Target-URI": None if page["first_url"] is None else _uri(page["first_url"]),
            "WARC-Refers-To-Date": captured,
            "Refers-To-Page-Id": page["first_id"],
        }
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value is not None) + "\r\n"
    pack = zlib.compressobj(wbits=GZIP)
    made = pack.compress(head.encode()) + pack.compress(body) + pack.compress(b"\r\n\r\n") + pack.flush()
    return made if made[-1] == 0 else made + EMPTY


def write(pages: DataFrame, folder: str, captured: str = CAPTURED, least: int = 0) -> None:
    """Writes a record for every row (page_id, url, html), one file per task."""
    into = X.arrow_schema("value binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in X.slices(batch, "payload"):
                # The writer adds the last byte.
                yield X.record({"value": [member(page, captured)[:-1] for page in part.to_pylist()]}, into)

    members = decided(pages, least).mapInArrow(run, "value binary")
    members.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").text(folder)


def renamed(spark: SparkSession, folder: str, old: str, new: str) -> None:
    """Changes the ending of the files of a folder, as `.txt` to `.warc.gz` and back."""
    for path in matching_paths(spark, f"{folder}/*{old}"):
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.getParent(), path.getName().removesuffix(old) + new)
        if not system.rename(path, target):
            raise OSError(f"{path} was not renamed")


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, colon, value in (line.partition(":") for line in lines) if colon}


def _number(value: str | None) -> int | None:
    try:
        return None if value is None else int(value)
    except ValueError:
        return None


def parsed(record: bytes, payload: bool = True) -> dict:
    """The columns of an unpacked record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _headers(head)
    size = _number(fields.get("content-length"))
    if size is None or not 0 <= size <= len(rest):
        return {"broken": len(record)}
    body, kind, http = rest[:size], fields.get("warc-type"), {}
    if fields.get("content-type", "").startswith("application/http"):
        http_head, _, body = body.partition(b"\r\n\r\n")
        http = _headers(http_head)
    told = fields.get("warc-payload-digest", "").rpartition(":")[2] or None
    if kind == "revisit":
        length, digest, body = _number(http.get("content-length")), told, None
    else:
        length, digest = len(body), base32(hashlib.sha1(body).digest())
    return {
        "page_id": _number(fields.get("page-id")), "url": fields.get("warc-target-uri"), "record_type": kind, "refers_to": _number(fields.get("refers-to-page-id")),
        "payload_bytes": length, "payload_digest": digest, "intact": digest == told if told else None, "payload": body if payload else None,
    }


class _Unpacked:
    """A member that grows by pieces, each of which follows magic bytes."""

    def __init__(self):
        self.pieces, self.made, self.stream, self.head, self.spare = [], [], zlib.decompressobj(GZIP), b"", b""

    def add(self, piece: bytes) -> bool:
        """False if the bytes are no member of an archive."""
        self.pieces.append(piece)
        try:
            self.made.append(self.stream.decompress(MAGIC + piece))
        except zlib.error:
            return False
        self.spare = self.stream.unused_data
        self.head = (self.head + self.made[-1][:5])[:5]
        return self.head in (b"WARC/", b"") if self.done else b"WARC/".startswith(self.head)

    @property
    def done(self) -> bool:
        return self.stream.eof

    def record(self) -> bytes:
        return b"".join(self.made)


def _members(pieces: Iterator[bytes]) -> Iterator[tuple[str, bytes]]:
    """('record', unpacked bytes), ('left', piece) for pieces that form none here, ('spare', bytes) behind a member; in order."""
    queue: list[bytes] = []
    while True:
        piece = queue.pop() if queue else next(pieces, None)
        if piece is None:
            return
        one = _Unpacked()
        good = one.add(piece)
        while good and not one.done:
            piece = queue.pop() if queue else next(pieces, None)
            if piece is None:
                break
            good = one.add(piece)
        if good and one.done:
            if one.record():
                yield "record", one.record()
            if one.spare.strip(b"\0"):
                yield "spare", one.spare
        elif good:
            for piece in one.pieces:  # the range ends inside it
                yield "left", piece
        else:
            # The first piece begins no member; those after it may.
            yield "left", one.pieces[0]
            queue.extend(reversed(one.pieces[1:]))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[bytes]]]:
    """(file, block, pieces) of the byte ranges of a task; the pieces of one are read before the next comes."""
    rows = ((f, b, v) for batch in batches for f, b, v in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value")), strict=True))
    row = next(rows, None)
    while row is not None:
        file, block = row[0], row[1]

        def own(file=file, block=block):
            nonlocal row
            while row is not None and (row[0], row[1]) == (file, block):
                value = row[2]
                row = next(rows, None)
                yield value

        yield file, block, own()


def _batches(rows: Iterator[dict], into: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 256 + len(row.get("payload") or b"") + len(row.get("piece") or b"")
        if size > X.SLICE_BYTES:
            yield pa.RecordBatch.from_pylist(held, into)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, into)


def records(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """All records of the archives in a folder, and a row with `broken` set for bytes that form none. Payloads are read in any case, and returned if asked for."""
    if matching_paths(spark, f"{folder}/*.gz"):
        raise ValueError(f"{folder} has files named .gz, which Spark unpacks as one stream: rename them (see `renamed`)")
    pieces = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(folder)
    value = F.col("value").cast("binary").alias("value")
    pieces = pieces.select(value, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    into, out = X.arrow_schema(_PLACED), X.arrow_schema(_FIELDS)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for file, block, own in _ranges(batches):
                if block == 0 and (before := next(own, b"")):
                    yield {"broken": len(before)}  # no gzip file, or one with something before its first member
                for nth, (kind, data) in enumerate(_members(own)):
                    if kind == "record":
                        yield parsed(data, payload)
                    elif kind == "spare":
                        yield {"broken": len(data)}
                    else:
                        yield {"file": file, "block": block, "nth": nth, "piece": data}

        yield from _batches(rows(), into)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for _, _, own in _ranges(batches):
                for kind, data in _members(own):
                    yield parsed(data, payload) if kind == "record" else {"broken": len(data) + len(MAGIC) * (kind == "left")}

        yield from _batches(rows(), out)

    found = staged(pieces.mapInArrow(first, _PLACED), "records")
    whole = found.where("piece is null").select(*out.names)
    rest = found.where("piece is not null").select("file", "block", "nth", F.col("piece").alias("value"))
    rest = rest.repartition("file").sortWithinPartitions("file", "block", "nth").select("file", F.lit(0).cast("long").alias("block"), "value")
    return whole.unionByName(rest.mapInArrow(again, _FIELDS))


def op11_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch(spark, "warc")
    write(spark.read.parquet(f"{folder}/pages.parquet"), archives)
    return records(spark, archives, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH hashed AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), placed AS (
  SELECT *, row_number() OVER w = 1 AS leads, first_value(page_id) OVER w AS lead_id FROM hashed
  WINDOW w AS (PARTITION BY h ORDER BY page_id NULLS LAST, url NULLS LAST)
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
    1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)]), 'string_agg', '') AS payload_digest,
  CASE WHEN leads THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN NOT leads THEN lead_id END AS refers_to
FROM placed
"""
