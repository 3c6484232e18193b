"""Web archives: a writer with revisit records, and a reader that salvages damaged files (operator 3).

Writing.  Of records with equal payloads of at least ``least_bytes``, the one with the smallest page id is a response that
carries the payload, the others are revisits that name it.  Every task writes its records, one gzip member each, to files of
about ``FILE_BYTES`` in a shared folder, under names of its own; only the files it reports are read, so what a lost task
leaves behind has no effect.

Reading.  A file is read in pieces, never whole.  Archives of others are read too: field names in any case, record ids of any
form, blocks that are HTTP messages, whose payload is what follows their head.  A member or record that fails a check (its gzip sums, its version line, its
length, its end mark, its block or payload digest) is not trusted: from the byte after its start the reader looks for the next valid
member, or the next version line in an archive without compression, recovers the records from there on and reports the bytes
between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from cartwheel.llm.spread import join_key, written
from cartwheel.session import work_dir

FILE_BYTES = 16 << 20
PIECE = 1 << 18
VERSION, MAGIC, END = b"WARC/1.1\r\n", b"\x1f\x8b\x08", b"\r\n\r\n"
HEAD_BYTES = 1 << 16
#: tasks that read; files are dealt out to them evenly
READERS = 20_000
_LENGTH, _PAGE = re.compile(r"[0-9]{1,18}"), re.compile(r"<urn:page:(-?[0-9]{1,18})>")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder named by a URI or a plain path."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """One record with its headers; a revisit carries no payload."""
    body = b"" if is_revisit else payload
    heads = [("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", _name(page)),
             ("WARC-Target-URI", " ".join((url or "").split())), ("WARC-Payload-Digest", digest(payload))]
    if is_revisit:
        heads.append(("WARC-Refers-To", _name(refers_to)))
    heads += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(body)))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in heads).encode() + b"\r\n" + body + END


def _name(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def _number(name: str | None) -> int | None:
    """The page id in a record id of our own form; null in any other."""
    found = _PAGE.fullmatch(name or "")
    return int(found[1]) if found else None


def roles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, sha and refers_to (null for responses), one row per distinct page id and payload."""
    spark = pages.sparkSession
    rows = written(spark, pages.select("page_id", _sha().alias("sha"), F.octet_length(_html()).alias("n")).distinct(),
                   "payloads")
    first = written(spark, rows.where(F.col("n") >= least_bytes).groupBy("sha").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1"), "first")
    again = join_key(rows, first, "sha", "copies").where("not (page_id <=> first)")
    return again.select("page_id", "sha", F.col("first").alias("refers_to"))


def _html() -> Column:
    return F.coalesce(F.col("html").cast("string"), F.lit(""))


def _sha() -> Column:
    return F.sha1(_html().cast("binary"))


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes one record per row of pages (page_id, url, html) and returns the files' paths, read from a table.

    A null html is an empty payload, a null url an empty one.  Of rows without a page id, and of repeated rows, each gets a
    record; rows with the smallest id of a payload are all responses.  A payload of any length is one record.  Other columns
    are not read, whatever their names.  An empty table gives no files.
    """
    spark = pages.sparkSession
    again = written(spark, roles(pages, least_bytes), "revisits")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        _html().alias("html"), _sha().alias("sha"))
    joined = rows.alias("p").join(again.withColumn("again", F.lit(True)).alias("r"), F.expr(
        "p.sha = r.sha and p.page_id <=> r.page_id"), "left").select("p.page_id", "url", "html", "refers_to", "again")

    def run(batches):
        store, path = place(folder)
        store.create_dir(path, recursive=True)
        out, files = None, []
        for part in batches:
            for row in part.to_pylist():
                if out is None or out.tell() > FILE_BYTES:
                    if out is not None:
                        out.close()
                    files.append(f"{path}/part-{uuid.uuid4().hex}.warc.gz")
                    out = store.open_output_stream(files[-1], compression=None)
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                out.write(packer.compress(record(row["page_id"], row["url"], row["html"].encode(), row["refers_to"],
                                                 bool(row["again"]))) + packer.flush())
        if out is not None:
            out.close()
        base = folder[:len(folder) - len(path)] if folder.endswith(path) else ""
        yield pa.RecordBatch.from_arrays([pa.array([base + f for f in files], pa.string())], ["path"])
    return written(spark, joined.mapInArrow(run, "path string"), "archives")


# ---- reading ---------------------------------------------------------------------------------------------------------
class _Bytes:
    """Random access to a file by pieces."""

    def __init__(self, file):
        self.file, self.size, self.at, self.piece = file, file.size(), 0, b""

    def read(self, at: int, n: int) -> bytes:
        if not (self.at <= at and at + n <= self.at + len(self.piece)):
            self.file.seek(at)
            self.at, self.piece = at, self.file.read(max(n, PIECE))
        return self.piece[at - self.at:at - self.at + n]

    def find(self, mark: bytes, at: int) -> int:
        """Where the mark next begins, or the file's size."""
        while at < self.size:
            piece = self.read(at, PIECE)
            found = piece.find(mark)
            if found >= 0:
                return at + found
            at += max(1, len(piece) - len(mark) + 1) if at + len(piece) < self.size else len(piece)
        return self.size


def _member(source: _Bytes, at: int) -> tuple[bytes, int] | str:
    """The content of the gzip member that begins here and where it ends, or what is wrong with it."""
    unpack, out, start = zlib.decompressobj(31), [], at
    try:
        while not unpack.eof:
            piece = source.read(at, PIECE)
            if not piece:
                return "truncated member"
            if at == start and not piece.startswith(MAGIC):
                return "no gzip member"
            out.append(unpack.decompress(piece))
            if out[0][:5] != VERSION[:5] and len(out[0]) >= 5:
                return "no version line"
            at += len(piece)
    except zlib.error:
        return "bad gzip member"
    return b"".join(out), at - len(unpack.unused_data)


def _parsed(head: bytes) -> dict[str, str] | None:
    """The fields by their names in lower case, or None without a version line or a sound length."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        return None
    pairs = (line.partition(":") for line in lines[1:])
    fields = {name.strip().lower(): value.strip() for name, mark, value in pairs if mark}
    return fields if _LENGTH.fullmatch(fields.get("content-length", "")) else None


def payload(fields: dict[str, str], block: bytes) -> bytes:
    """The block, or what follows the head of an HTTP message in it."""
    if not fields.get("content-type", "").lower().startswith("application/http"):
        return block
    _, mark, rest = block.partition(END)
    return rest if mark else block


def _differs(told: str | None, data: bytes) -> bool:
    """Whether a SHA-1 in base 32 or 16 is not that of the data; other digests are not judged."""
    kind, mark, value = (told or "").rpartition(":")
    if not value or (mark and kind.lower() != "sha1") or len(value) not in (32, 40):
        return False
    found = hashlib.sha1(data)
    return value.upper() != base64.b32encode(found.digest()).decode() and value.lower() != found.hexdigest()


def _checked(fields: dict[str, str], block: bytes) -> str | None:
    """What is wrong with a record, or None."""
    if _differs(fields.get("warc-block-digest"), block):
        return "block digest differs"
    # the payload of a revisit, or of a part of one, is elsewhere
    if fields.get("warc-type") == "response" and _differs(fields.get("warc-payload-digest"), payload(fields, block)):
        return "payload digest differs"
    return None


def _packed_record(source: _Bytes, at: int):
    member = _member(source, at)
    if isinstance(member, str):
        return member
    content, end = member
    cut = content.find(END)
    fields = _parsed(content[:cut]) if cut >= 0 else None
    if fields is None:
        return "bad header"
    size = int(fields["content-length"])
    body = content[cut + 4:cut + 4 + size]
    if content[cut + 4:] != body + END or len(body) != size:
        return "length differs"
    return _checked(fields, body) or (fields, body, end)


def _plain_record(source: _Bytes, at: int):
    head = source.read(at, min(HEAD_BYTES, source.size - at))
    cut = head.find(END)
    fields = _parsed(head[:cut]) if cut >= 0 and head.startswith(b"WARC/") else None
    if fields is None:
        return "bad header"
    size = int(fields["content-length"])
    if at + cut + 4 + size + 4 > source.size:
        return "truncated record"
    body = source.read(at + cut + 4, size)
    end = at + cut + 4 + size + 4
    if source.read(end - 4, 4) != END:
        return "length differs"
    return _checked(fields, body) or (fields, body, end)


def salvage(file) -> Iterator[tuple[int, int, str | None, dict[str, str], bytes]]:
    """(start, end, reason, fields, block) of every record, and of every gap (with its reason, without fields).

    Records and gaps together cover every byte of the file, whatever it holds.
    """
    source = _Bytes(file)
    packed = source.read(0, min(3, source.size)) == MAGIC
    if not packed and source.find(b"WARC/", 0) > source.find(MAGIC, 0):
        packed = True                             # damaged at its very start
    one, mark = (_packed_record, MAGIC) if packed else (_plain_record, b"WARC/")
    at = 0
    while at < source.size:
        got = one(source, at)
        if not isinstance(got, str):
            fields, body, end = got
            yield at, end, None, fields, body
            at = end
            continue
        after = source.find(mark, at + 1)
        while after < source.size and isinstance(one(source, after), str):
            after = source.find(mark, after + 1)
        yield at, after, got, {}, b""
        at = after


_READ = ("path string, start long, end long, reason string, type string, record_id string, page_id long, refers_to_id string, "
         "refers_to long, url string, payload_digest string, payload_bytes long")


def read(archives: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Per record or gap of the archives (column path): its place, and either a reason (a gap) or the record's fields.

    ``payload_bytes`` and ``payload_digest`` of a response are counted from the payload itself; a revisit tells the digest
    and gets the size of the response with that digest in ``resolved``.  ``record_id`` and ``refers_to_id`` are the names as
    they stand in the archive; ``page_id`` and ``refers_to`` are null where those are not of the form that ``write`` gives.
    No damage to a file makes the reader fail.  An empty file has neither records nor gaps.
    """
    names = [f.split()[0] for f in _READ.split(", ")] + ["payload"] * keep_payload

    def run(batches):
        for part in batches:
            for path in part.column("path").to_pylist():
                store, inner = place(path)
                rows: list[tuple] = []
                held = 0
                with store.open_input_file(inner) as file:
                    for start, end, reason, fields, body in salvage(file):
                        response, body = fields.get("warc-type") == "response", payload(fields, body)
                        name, refers = fields.get("warc-record-id"), fields.get("warc-refers-to")
                        rows.append((path, start, end, reason, fields.get("warc-type"), name, _number(name), refers,
                                     _number(refers), fields.get("warc-target-uri"),
                                     digest(body) if response else fields.get("warc-payload-digest"),
                                     len(body) if response else None, body)[:len(names)])
                        held += len(body) * keep_payload + 200
                        if held > PIECE * 16:
                            yield _batch(rows, names)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, names)
    # dealt one after the other, so no task gets two files before each has one
    spread = archives.select("path").repartition(max(1, min(archives.count(), READERS)))
    return spread.mapInArrow(run, _READ + ", payload binary" * keep_payload)


_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [f.split()[1] for f in _READ.split(", ")] + ["binary"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _TYPES[kinds[i]]) for i in range(len(names))], names)


def resolved(records: DataFrame) -> DataFrame:
    """The records (not the gaps) with the payload size of revisits taken from the response they share a payload with."""
    spark = records.sparkSession
    kept = written(spark, records.where("reason is null").drop("payload"), "records")
    sizes = written(spark, kept.groupBy("payload_digest").agg(F.max("payload_bytes").alias("full"),
                                                              F.count(F.lit(1)).alias("copies")), "sizes")
    both = join_key(kept, sizes, "payload_digest", "copies")
    return both.select(*[c for c in kept.columns if c != "payload_bytes"],
                       F.coalesce("payload_bytes", "full").alias("payload_bytes"))


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes the pages to archives below ``spark.checkpoint.dir`` and returns what the reader finds there."""
    return resolved(read(write(pages, work_dir(pages.sparkSession, "warc"), least_bytes)))
