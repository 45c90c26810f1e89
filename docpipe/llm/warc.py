"""Web archives in which a repeated payload is a revisit of its first copy.

Only headers decide: payload digests are grouped, the newest page of each digest keeps its body,
and the others become revisit records that refer to it. Archives are written with fresh headers,
one gzip member per record, and read back into records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from docpipe.llm.files import new_file, open_file
from docpipe.llm.staging import new_folder, written

LEAST_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the WARC 1.1 standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"

MANIFEST = "uri string, records bigint"
RECORD = (
    "record_id string, record_type string, page_id bigint, url string, payload_digest string,"
    " payload_bytes bigint, refers_to_record string, html string"
)


def resolve(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``page_id, url, html, payload_bytes, payload_digest, record_type, refers_to`` per row.

    Of equal payloads of at least ``least_bytes`` the row with the largest ``page_id`` is the
    response and the others revisit it. Digests are counted before they are shuffled; only
    those that occur more than once meet the pages again, in a join whose large partitions
    Spark can split. NULL html is an empty payload. A row with NULL ``page_id`` is always a
    response, and so are all rows that share the largest id. Other columns are not read.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumns(
        {"payload_bytes": F.octet_length("html").cast("bigint"), "payload_digest": F.sha1(payload)}
    )
    first = (
        rows.where((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.max("page_id").alias("_original"), F.count("*").alias("_copies"))
        .where("_copies > 1")
    )
    revisits = (F.col("page_id") < F.col("_original")) & F.col("_original").isNotNull()
    return rows.join(first, F.col("payload_digest") == F.col("_digest"), "left").select(
        *rows.columns,
        F.when(revisits, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisits, F.col("_original")).alias("refers_to"),
    )


def record_id(page_id: int | None, digest: str) -> str:
    """The same in every run, so that a revisit can name its response before that is written.
    Pages without id get a random one; nothing refers to them."""
    name = uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}/{digest}")
    return f"<urn:uuid:{name}>"


def _digest_label(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def encoded_record(row) -> bytes:
    """One WARC record, uncompressed. Characters that a header cannot hold are percent-encoded."""
    revisit = row.record_type == "revisit"
    body = b"" if revisit else (row.html or "").encode("utf-8")
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row.payload_bytes}\r\n\r\n"
    ).encode()
    page_id = None if pd.isna(row.page_id) else int(row.page_id)
    headers = [
        ("WARC-Type", row.record_type),
        ("WARC-Record-ID", record_id(page_id, row.payload_digest)),
        ("WARC-Date", DATE),
        ("Content-Type", HTTP_TYPE),
        ("Content-Length", str(len(http) + len(body))),
        ("WARC-Payload-Digest", _digest_label(row.payload_digest)),
    ]
    if isinstance(row.url, str):
        headers.append(("WARC-Target-URI", quote(row.url, safe="!#$&'()*+,/:;=?@[]-._~")))
    if page_id is not None:
        headers.append(("Page-ID", str(page_id)))
    if revisit:
        original = record_id(int(row.refers_to), row.payload_digest)
        headers += [("WARC-Refers-To", original), ("WARC-Profile", PROFILE)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + http + body + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write resolved pages, one archive per task, and return the manifest ``uri, records``."""
    target = folder or new_folder(pages.sparkSession, "warc")
    # as text, since numbers beside NULLs would become floating point on the way
    ids = {c: F.col(c).cast("string") for c in ("page_id", "refers_to")}
    pages = pages.withColumns(ids)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = 0
        with new_file(target, ".warc.gz") as (uri, stream):
            for batch in batches:
                for row in batch.itertuples(index=False):
                    stream.write(gzip.compress(encoded_record(row), 1, mtime=0))
                    n += 1
        yield pd.DataFrame({"uri": [uri], "records": [n]})

    return written(pages.mapInPandas(write, MANIFEST), "warc-manifest")


def members(stream) -> Iterator[bytes]:
    """Uncompressed gzip members, one at a time."""
    rest = b""
    while True:
        plain, unzip = [], zlib.decompressobj(wbits=31)
        while not unzip.eof:
            rest = rest or stream.read(1 << 20)
            if not rest:
                if plain:
                    raise EOFError("archive ends inside a record")
                return
            plain.append(unzip.decompress(rest))
            rest = unzip.unused_data
        yield b"".join(plain)


def decoded_record(raw: bytes) -> tuple:
    """The columns of ``RECORD``; the payload's digest is checked where there is a payload."""
    head, _, block = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise ValueError(f"not a WARC record: {lines[0]!r}")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = block[: int(headers["content-length"])]
    revisit = headers["warc-type"] == "revisit"
    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
    _, _, payload = block.partition(b"\r\n\r\n")
    html = None if revisit else payload.decode("utf-8")
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {headers['warc-record-id']} is damaged")
    page, url = headers.get("page-id"), headers.get("warc-target-uri")
    return (
        headers["warc-record-id"], headers["warc-type"], None if page is None else int(page),
        None if url is None else unquote(url), digest, None if revisit else len(payload),
        headers.get("warc-refers-to"), html,
    )


def read_archives(spark: SparkSession, manifest: DataFrame, bodies: bool = True) -> DataFrame:
    """Records of the archives in ``manifest``, one row each (see ``RECORD``); ``html`` is NULL
    for revisits, and for all records without ``bodies``."""
    names = [f.partition(" ")[0] for f in RECORD.replace(", ", ",").split(",")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for uri in (u for batch in batches for u in batch["uri"]):
            rows, size = [], 0
            with open_file(uri) as stream:
                for raw in members(stream):
                    row = decoded_record(raw)
                    rows.append(row if bodies else (*row[:-1], None))
                    size += len(raw)
                    if size > 16 << 20:
                        yield _frame(rows, names)
                        rows, size = [], 0
            yield _frame(rows, names)

    return manifest.repartition(max(1, manifest.count())).mapInPandas(read, RECORD)


def _frame(rows, names) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names, dtype=object)
    return frame.astype({"page_id": "Int64", "payload_bytes": "Int64"})


def resolved_records(records: DataFrame) -> DataFrame:
    """Every record with the payload size of the response it stands for: revisits are joined to
    their responses by record id, headers only. The headers are written first, so that the
    archives are read once and Spark knows their size before it chooses a join."""
    kept = [c for c in records.columns if c not in ("html", "payload_bytes")]
    own = written(records.select(*kept, "payload_bytes"), "warc-headers")
    revisit = own.where("record_type = 'revisit'").drop("payload_bytes")
    named = (
        own.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("_id"))
        .agg(F.max("payload_bytes").alias("payload_bytes"), F.max("page_id").alias("refers_to"))
    )
    back = revisit.join(named, F.col("refers_to_record") == F.col("_id"), "left").drop("_id")
    first = own.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("bigint"))
    return first.unionByName(back)
