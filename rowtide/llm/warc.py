"""Web archives with a two-level capture index.

``write`` puts one WARC record per page into compressed archives (one gzip
member per record) and returns the captures: where each record lies.
``build_index`` sorts the captures by reversed-host URL key and page and
writes them as compressed blocks; each block has one line in the sparse
directory of its shard, which closes the shard file. ``fetch`` answers
(key, page) look-ups: the shard by binary search in the shard list (one row
per file), the block by binary search in the shard's directory, the capture
by binary search in the block, then a range read of the record alone.
"""

from __future__ import annotations

import uuid
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.io import bounded_batches, filesystem, make_folder, scratch, settle

LEAST_REVISIT_BYTES = 100
BLOCK_CAPTURES = 512
_CAPTURE = "url_key string, page_id long, archive string, place long, length long"


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.a.example/x?y`` to ``example,a)/x?y``.
    The scheme, a leading ``www.``, a default port and the fragment are left
    out. A null, empty or unreadable URL is its own key behind ``)``."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").removeprefix("www.").rstrip(".")
        port = parts.port
    except ValueError:
        return ")" + (url or "")
    if not host:
        return ")" + (url or "")
    key = ",".join(reversed(host.split(".")))
    if port and (parts.scheme, port) not in (("http", 80), ("https", 443)):
        key += f":{port}"
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


#: pages carry no capture time; the header is mandatory
CAPTURED = "1970-01-01T00:00:00Z"
LOOKUPS_A_TASK = 4_096


def _record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC 1.1 record as a gzip member; a revisit has no payload, but
    keeps the headers of the response, with the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {CAPTURED}",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    raw = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers (lower-case names), HTTP headers and payload of a record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:] if ": " in x)
    warc = {k.lower(): v for k, v in fields.items()}
    http, _, payload = rest[:int(warc["content-length"])].partition(b"\r\n\r\n")
    inner = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    return warc, {k.lower(): v for k, v in inner.items()}, payload


def _first_of_digest(pages: DataFrame) -> DataFrame:
    """(page_id, refers_to) of the pages that repeat another's payload."""
    prints = settle(pages.where("page_id is not null").select(
        "page_id", F.sha2(F.encode(F.coalesce("html", F.lit("")), "utf-8"), 256).alias("digest"),
        F.octet_length(F.coalesce("html", F.lit(""))).alias("size")).where(F.col("size") >= LEAST_REVISIT_BYTES).select("page_id", "digest"), "warc-digests")
    shared = settle(prints.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-shared")
    again = prints.join(shared, "digest").where("page_id <> refers_to")
    return settle(again.groupBy("page_id").agg(F.min("refers_to").alias("refers_to")), "warc-revisits")


def write(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archive all ``pages`` (page_id, url, html) and return their captures:
    url_key, page_id, archive, place, length.

    Of equal payloads of at least 100 bytes that with the smallest page_id is
    the response, the others revisit it. A null html is an empty payload; a
    null page_id is always a response; rows that repeat a page_id are records
    of their own, all revisits or all responses alike. An empty table writes
    nothing.
    """
    spark = pages.sparkSession
    bounded_batches(spark, 200)
    folder = folder or scratch(spark, "warc")
    make_folder(folder)
    own = pages.select("page_id", "url", "html")
    rows = own.join(_first_of_digest(own), "page_id", "left")

    def archive(batches):
        import hashlib

        out = name = None
        place = 0
        for batch in batches:
            if out is None:
                name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                system, path = filesystem(name)
                out = system.open_output_stream(path, compression=None)
            found = []
            for page, url, html, first in zip(batch["page_id"].astype("Int64"), batch["url"], batch["html"], batch["refers_to"].astype("Int64"), strict=True):
                payload = (html or "").encode("utf-8", "surrogatepass")
                page = None if pd.isna(page) else int(page)
                member = _record(page, url, payload, hashlib.sha256(payload).hexdigest(), None if pd.isna(first) else int(first))
                out.write(member)
                found.append((url_key(url), page, name, place, len(member)))
                place += len(member)
            yield pd.DataFrame(found, columns=["url_key", "page_id", "archive", "place", "length"]).astype({"page_id": "Int64"})
        if out is not None:
            out.close()

    return settle(rows.mapInPandas(archive, _CAPTURE), "warc-captures")


def _line(key: str, page: int | None, n: int) -> tuple:
    """How captures sort: by key in UTF-8 order, null pages first, then their place."""
    return (key.encode("utf-8", "surrogatepass"), page is not None, page or 0, n)


def build_index(captures: DataFrame, folder: str | None = None, block: int = BLOCK_CAPTURES) -> DataFrame:
    """Sort the captures into shard files and list the shards: shard, file,
    directory_place, directory_length."""
    spark = captures.sparkSession
    folder = folder or scratch(spark, "warc-index")
    make_folder(folder)
    order = [F.col("url_key"), F.col("page_id").asc_nulls_first(), F.col("archive"), F.col("place")]

    def write_shard(batches):
        import json

        from pyspark import TaskContext

        name = f"{folder}/{uuid.uuid4().hex}.cdx"
        out, place, held, directory = None, 0, [], []

        def flush():
            nonlocal place
            body = zlib.compress(json.dumps(held).encode("utf-8"), 6)
            out.write(body)
            directory.append([held[0][:2], place, len(body)])
            place += len(body)
            held.clear()

        for batch in batches:
            if out is None and len(batch):
                system, path = filesystem(name)
                out = system.open_output_stream(path)
            pages = [None if pd.isna(p) else int(p) for p in batch["page_id"].astype("Int64")]
            for row in zip(batch["url_key"].tolist(), pages, batch["archive"].tolist(), batch["place"].tolist(), batch["length"].tolist(), strict=True):
                held.append(row)
                if len(held) >= block:
                    flush()
        if out is None:
            return
        if held:
            flush()
        body = zlib.compress(json.dumps(directory).encode("utf-8"), 6)
        out.write(body)
        out.close()
        first = directory[0][0]
        yield pd.DataFrame([(TaskContext.get().partitionId(), name, first[0], first[1], place, len(body))], columns=["shard", "file", "first_key", "first_page", "directory_place", "directory_length"]).astype({"first_page": "Int64"})

    ranged = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "shard long, file string, first_key string, first_page long, directory_place long, directory_length long"
    return settle(ranged.mapInPandas(write_shard, schema), "warc-shards")


class _Files:
    """Open files of a task, at most ``most`` at a time."""

    def __init__(self, most: int = 64):
        self.open, self.most = {}, most

    def read(self, uri: str, place: int, length: int) -> bytes:
        if uri not in self.open:
            if len(self.open) >= self.most:
                self.open.pop(next(iter(self.open))).close()
            system, path = filesystem(uri)
            self.open[uri] = system.open_input_file(path)
        return self.open[uri].read_at(length, place)


class CaptureIndex:
    """Look-ups in the shards; keeps the last directory and the last block."""

    def __init__(self, shards: list[tuple], files: _Files):
        import json

        self.files, self.load = files, lambda uri, place, length: json.loads(zlib.decompress(files.read(uri, place, length)))
        self.shards = sorted(shards)
        self.firsts = [_line(key, page, 0)[:3] for _, _, key, page, _, _ in self.shards]
        self.directories, self.blocks = {}, {}

    def _directory(self, shard: int):
        if shard not in self.directories:
            if len(self.directories) > 4:
                self.directories.clear()
            _, file, _, _, place, length = self.shards[shard]
            entries = self.load(file, place, length)
            self.directories[shard] = ([_line(key, page, 0)[:3] for (key, page), _, _ in entries], entries)
        return self.directories[shard]

    def _block(self, shard: int, number: int):
        if (shard, number) not in self.blocks:
            if len(self.blocks) > 8:
                self.blocks.clear()
            _, place, length = self._directory(shard)[1][number]
            rows = self.load(self.shards[shard][1], place, length)
            self.blocks[shard, number] = ([_line(r[0], r[1], 0)[:3] for r in rows], rows)
        return self.blocks[shard, number]

    def captures(self, key: str, page: int | None):
        """All captures (archive, place, length) of the key and page."""
        want = _line(key, page, 0)[:3]
        # equal lines may begin in the shard and block before the first that starts with them
        for shard in range(max(0, bisect_left(self.firsts, want) - 1), bisect_right(self.firsts, want)):
            firsts, _ = self._directory(shard)
            for number in range(max(0, bisect_left(firsts, want) - 1), bisect_right(firsts, want)):
                lines, rows = self._block(shard, number)
                for r in rows[bisect_left(lines, want):bisect_right(lines, want)]:
                    yield r[2], r[3], r[4]


def fetch(wanted: DataFrame, shards: DataFrame) -> DataFrame:
    """Records of the distinct (url_key, page_id) in ``wanted``: page_id,
    payload_bytes, payload_digest, record_type, refers_to, target_uri.

    The shard list has one row per file of the index. A response's size and
    digest are computed from the payload read; a revisit's are those that its
    record keeps. Captures that no archive holds give no row.
    """
    listing = [tuple(r) for r in shards.select("shard", "file", "first_key", "first_page", "directory_place", "directory_length").collect()]

    def look_up(batches):
        import hashlib

        files = _Files()
        index = CaptureIndex(listing, files)
        for batch in batches:
            found = []
            pages = [None if pd.isna(p) else int(p) for p in batch["page_id"].astype("Int64")]
            for key, page in zip(batch["url_key"], pages, strict=True):
                for archive, place, length in index.captures(key, page):
                    warc, http, payload = parse_record(files.read(archive, place, length))
                    if warc["warc-type"] == "response":
                        found.append((page, len(payload), hashlib.sha256(payload).hexdigest(), "response", None, warc["warc-target-uri"]))
                    else:
                        first = int(warc["warc-refers-to"].removeprefix("<urn:page:").rstrip(">"))
                        found.append((page, int(http["content-length"]), warc["warc-payload-digest"].removeprefix("sha256:"), "revisit", first, warc["warc-target-uri"]))
            out = pd.DataFrame(found, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"])
            yield out.astype({"page_id": "Int64", "payload_bytes": "int64", "refers_to": "Int64"})

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string"
    order = [F.col("url_key"), F.col("page_id").asc_nulls_first()]
    distinct = settle(wanted.select("url_key", "page_id").distinct(), "wanted")
    tasks = max(1, -(-distinct.count() // LOOKUPS_A_TASK))  # by rows: few bytes are much work here
    return distinct.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInPandas(look_up, schema)


def with_url_key(pages: DataFrame) -> DataFrame:
    """(page_id, url_key) of pages, for look-ups."""

    @F.pandas_udf("string")
    def key(urls: pd.Series) -> pd.Series:
        return pd.Series([url_key(u) for u in urls], dtype=object)

    return pages.select("page_id", key("url").alias("url_key"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive the pages, index the archives, and read each page's records back."""
    return fetch(with_url_key(pages), build_index(write(pages)))
