"""WARC records in ZIP archives: writer and range reader.

An archive is a ZIP file of stored members: those under ``archive/`` hold the
records, each a gzip member of its own as usual for WARC, those under
``indexes/`` one line a record with a JSON object (filename, offset and length
inside that file).  The writer makes one of each and always adds ZIP64 records,
so archives and members may pass 4 GB.

The reader never extracts: it reads the file's tail for the end-of-directory
records (ZIP64 where given), then the central directory and every index member
it names (plain or ``.gz``), finds the archive members they point to by their
local headers, and then fetches records by byte ranges.  An index line for a
member that is not there, and an archive member that no index names, are errors.  One row
per run of neighbouring records is dealt out before records are read, so one
large archive is read by many tasks.

Archives lie under the folder the caller names (any store ``pyarrow.fs``
opens).  A task writes under a name of its own attempt and renames at the end,
so a lost or repeated task leaves no half-written archive in the result.

Edge cases: a null html is the empty payload; payloads under ``min_revisit``
bytes are responses always; of equal payloads, every row with the largest
page_id is a response (repeated rows too), the others revisit it; a null
page_id counts as smaller than any id, and is a response only if all rows of
its payload have none; an empty table writes no archive.
"""

from __future__ import annotations

import gzip
import json
import struct
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILES, INDEXES = "archive/", "indexes/"
DATA, INDEX = FILES + "data.warc.gz", INDEXES + "index.cdxj"


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


# ---- ZIP -----------------------------------------------------------------------------------------

def local_header(name: bytes, crc: int, size: int) -> bytes:
    """Local file header of a stored member, sizes in its ZIP64 field."""
    extra = struct.pack("<HHQQ", 1, 16, size, size)
    return struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0x800, 0, 0, 0x21, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra)) + name + extra


def directory(members: list[tuple[bytes, int, int, int]], at: int) -> bytes:
    """Central directory of (name, crc, size, offset) with ZIP64 fields, for a directory that starts at byte ``at``."""
    entries = b""
    for name, crc, size, offset in members:
        extra = struct.pack("<HHQQQ", 1, 24, size, size, offset)
        entries += struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0x800, 0, 0, 0x21, crc, 0xFFFFFFFF, 0xFFFFFFFF,
                               len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    n, end = len(members), at + len(entries)
    return (entries + struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, len(entries), at)
            + struct.pack("<IIQI", 0x07064B50, 0, end, 1)
            + struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, min(n, 0xFFFF), min(n, 0xFFFF), 0xFFFFFFFF, 0xFFFFFFFF, 0))


def central_directory(f, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (method, size, offset of the local header), from the end records and the central directory alone."""
    tail_at = max(0, size - 65_557)
    f.seek(tail_at)
    tail = f.read(size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    # The signature may also stand in the archive's comment: the record must end where the file ends.
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP archive, or a cut one")
    n, length, start = struct.unpack_from("<HII", tail, end + 10)
    if (n == 0xFFFF or 0xFFFFFFFF in (length, start)) and end >= 20 and tail[end - 20: end - 16] == b"PK\x06\x07":
        at = struct.unpack_from("<Q", tail, end - 12)[0]
        f.seek(at)
        record = f.read(56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("bad ZIP64 end of central directory")
        n, length, start = struct.unpack_from("<QQQ", record, 32)
    f.seek(start)
    raw, out, at = f.read(length), {}, 0
    for _ in range(n):
        if raw[at: at + 4] != b"PK\x01\x02":
            raise ValueError("bad central directory")
        method, packed, full, names, extras, notes = struct.unpack_from("<H8xIIHHH", raw, at + 10)
        offset = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46: at + 46 + names].decode()
        extra, k = raw[at + 46 + names: at + 46 + names + extras], 0
        while k + 4 <= len(extra):
            kind, width = struct.unpack_from("<HH", extra, k)
            if kind == 1:
                values = iter(struct.unpack_from(f"<{width // 8}Q", extra, k + 4))
                full = next(values) if full == 0xFFFFFFFF else full
                packed = next(values) if packed == 0xFFFFFFFF else packed
                offset = next(values) if offset == 0xFFFFFFFF else offset
            k += 4 + width
        out[name] = (method, full, offset)
        at += 46 + names + extras + notes
    return out


def member_start(f, offset: int) -> int:
    """Where a member's bytes begin: after its local header."""
    f.seek(offset)
    head = f.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("bad local header")
    names, extras = struct.unpack_from("<HH", head, 26)
    return offset + 30 + names + extras


# ---- WARC ----------------------------------------------------------------------------------------

def record(kind: str, page: int | None, url: str, digest: str, payload: bytes, length: int, refers_to: int | None) -> bytes:
    """One WARC record.  A revisit has no payload of its own; its full length stands in an extension field."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page is None else page}>"), ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")),
            ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(length))]
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (b"\r\n" if kind == "revisit" else b"Content-Length: %d\r\n\r\n" % length + payload)
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[: int(fields["content-length"])]
    if len(block) != int(fields["content-length"]):
        raise ValueError("cut WARC record")
    return fields, block.partition(b"\r\n\r\n")[2]


# ---- Spark ---------------------------------------------------------------------------------------

def with_revisits(pages: DataFrame, *, min_revisit: int) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest and refers_to (null for responses)."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).cast("binary").alias("payload")).select(
        "page_id", "url", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    many = p.select("page_id", "payload_bytes", "payload_digest").filter(F.col("payload_bytes") >= min_revisit).groupBy("payload_digest").agg(
        F.max("page_id").alias("keep"), F.count("*").alias("n")).filter("n > 1").select("payload_digest", "keep")
    return p.join(many, "payload_digest", "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("keep")), F.col("keep"))).drop("keep")


def write_archives(pages: DataFrame, folder: str, *, min_revisit: int = 1000, archive_bytes: int = 256 << 20) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives under ``folder``; lazily gives (path, records) of every archive."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = opened(folder)
        ctx, made = TaskContext.get(), 0
        data, lines, crc, size = [], [], 0, 0

        def close() -> pd.DataFrame:
            nonlocal data, lines, crc, size, made
            name = f"{root}/part-{ctx.partitionId():06d}-{made:04d}.wacz"
            own = f"{root}/_tmp-{ctx.taskAttemptId()}-{made}"
            index = "".join(lines).encode()
            members = [(DATA.encode(), crc, size, 0)]
            with fs.open_output_stream(own) as f:
                head = local_header(DATA.encode(), crc, size)
                f.write(head)
                for x in data:
                    f.write(x)
                at = len(head) + size
                ihead = local_header(INDEX.encode(), zlib.crc32(index), len(index))
                f.write(ihead + index)
                members.append((INDEX.encode(), zlib.crc32(index), len(index), at))
                f.write(directory(members, at + len(ihead) + len(index)))
            fs.move(own, name)
            out = pd.DataFrame({"path": [name], "records": [len(lines)]})
            made += 1
            data, lines, crc, size = [], [], 0, 0
            return out

        fs.create_dir(root, recursive=True)
        for pdf in batches:
            for page, url, payload, length, digest, refers in pdf.itertuples(index=False, name=None):
                page, refers = (None if x is None else int(x) for x in (page, refers))
                raw = record("response" if refers is None else "revisit", page, url, digest, bytes(payload), length, refers)
                raw = gzip.compress(raw, compresslevel=6, mtime=0)
                lines.append(json.dumps({"page": page, "filename": DATA.removeprefix(FILES), "offset": size, "length": len(raw)}) + "\n")
                data.append(raw)
                crc, size = zlib.crc32(raw, crc), size + len(raw)
                if size >= archive_bytes:
                    yield close()
        if data:
            yield close()

    p = with_revisits(pages, min_revisit=min_revisit).select(
        F.col("page_id").cast("string"), "url", "payload", "payload_bytes", "payload_digest", F.col("refers_to").cast("string"))
    return p.mapInPandas(write, "path string, records long")


def located(f, path: str) -> list[tuple[int, int, int]]:
    """(first byte of the member, offset in it, length) of every record that the indexes of an archive name, in order."""
    members = central_directory(f, f.size())
    files = {n: m for n, m in members.items() if n.startswith(FILES) and not n.endswith("/")}
    indexes = {n: m for n, m in members.items() if n.startswith(INDEXES) and not n.endswith("/")}
    if any(m[0] != 0 for m in (*files.values(), *indexes.values())):
        raise ValueError(f"{path}: members must be stored")
    base = {n: member_start(f, m[2]) for n, m in files.items()}
    out, named = set(), set()
    for n, (_, size, at) in sorted(indexes.items()):
        f.seek(member_start(f, at))
        raw = f.read(size)
        for line in (gzip.decompress(raw) if n.endswith(".gz") else raw).decode().splitlines():
            if "{" not in line:
                continue
            entry = json.loads(line[line.index("{"):])
            name = FILES + entry["filename"]
            if name not in files or int(entry["offset"]) + int(entry["length"]) > files[name][1]:
                raise ValueError(f"{path}: an index points outside the archive: {line[:200]}")
            named.add(name)
            out.add((base[name], int(entry["offset"]), int(entry["length"])))
    if missed := [n for n in files if n not in named and files[n][1]]:
        raise ValueError(f"{path}: no index names {missed[0]}")
    return sorted(out)


def read_archives(paths: DataFrame, folder: str, *, run_bytes: int = 4 << 20) -> DataFrame:
    """Records of the archives in ``paths`` (path): page_id, url, record_type, refers_to, payload_digest, payload_bytes, and the payload as stored."""
    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = opened(folder)
        for pdf in batches:
            for path in pdf["path"]:
                with fs.open_input_file(path) as f:
                    found = located(f, path)
                runs, cur = [], []
                for base, offset, length in found:
                    if cur and (base != cur[0][0] or offset != cur[-1][1] + cur[-1][2] or offset + length - cur[0][1] > run_bytes):
                        runs.append(cur)
                        cur = []
                    cur.append((base, offset, length))
                runs += [cur] if cur else []
                yield pd.DataFrame([(path, r[0][0] + r[0][1], [x[2] for x in r]) for r in runs], columns=["path", "start", "lengths"])

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = opened(folder)
        number = lambda x: int(x) if (x := x.removeprefix("<urn:page:").removesuffix(">")) else None
        for pdf in batches:
            for path, start, lengths in pdf.itertuples(index=False, name=None):
                with fs.open_input_file(path) as f:
                    f.seek(start)
                    raw, at, rows = f.read(int(sum(lengths))), 0, []
                for n in lengths:
                    h, payload = parsed(gzip.decompress(raw[at: at + n]))
                    at += n
                    revisit = h["warc-type"] == "revisit"
                    rows.append((number(h["warc-record-id"]), h["warc-target-uri"], h["warc-type"], number(h["warc-refers-to"]) if revisit else None,
                                 h["warc-payload-digest"].removeprefix("sha1:"), int(h["x-payload-length"]), None if revisit else payload))
                cols = dict(zip(["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"], map(list, zip(*rows, strict=True)), strict=True))
                yield pd.DataFrame(cols | {c: pd.array(cols[c], "Int64") for c in ("page_id", "refers_to")})  # never by way of floats

    runs = paths.select("path").mapInPandas(locate, "path string, start long, lengths array<long>")
    return runs.repartition("path", "start").mapInPandas(
        fetch, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary")
