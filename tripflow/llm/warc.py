r"""WARC archives: writing with segments and revisits, and reassembly when reading.

Writing. A page becomes a ``response`` record, or a ``revisit`` of the page with the largest id that has the same
payload. Its block is an HTTP message whose body is sent in chunks. A block longer than
``segment_bytes`` is cut: the first segment keeps the record's type, the others are ``continuation`` records that name
the first one's id as their origin, each with its number, the last with the total length. Spark's text sink writes
the records' bytes as they are, so files come from committed tasks only, in any store Spark can write.

Reading. Each task parses whole files. Records without segments are decoded where they are read; segments
alone are shuffled, grouped by origin, ordered by number and joined after their numbers and total
length are checked. The HTTP header and the chunk framing are then taken off and the digest is checked.

Defined results: a null payload is empty. Pages that repeat an id are archived each, told apart by a number
in their order of payload; refers_to names the largest id, and of rows of that id the first one is the response. A null id is
smaller than any other. Null URLs are written as empty. Damaged groups (a segment missing, repeated with other bytes, or
lengths that do not add up) give a row with ``problem`` set and a null payload. No pages give no records.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm import common

VERSION = b"WARC/1.1"
DATE = "1970-01-01T00:00:00Z"  # pages carry no time
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Payload of a body in chunked transfer framing; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size
        if len(out[-1]) != size or body[at : at + 2] != b"\r\n":
            raise ValueError("chunk does not end where it says")
        at += 2


def record(fields: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode("utf-8", "surrogatepass")
    return b"%s\r\n%sContent-Length: %d\r\n\r\n%s\r\n\r\n" % (VERSION, head, len(block), block)


def records(batches: Iterator[pd.DataFrame], segment_bytes: int, chunk_bytes: int) -> Iterator[pd.DataFrame]:
    """The WARC records of rows (page_id, number, url, payload, refers_to, revisit); ids are texts."""
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            payload = bytes(row.payload)
            page = row.page_id or ""
            name = f"<urn:x-page:{page}:{int(row.number)}>"
            fields = {
                "WARC-Type": "response",
                "WARC-Record-ID": name,
                "WARC-Date": DATE,
                # A line break would end the field.
                "WARC-Target-URI": (row.url or "").replace("\r", "%0D").replace("\n", "%0A"),
                "WARC-Payload-Digest": f"sha1:{digest32(payload)}",
                "Content-Type": "application/http;msgtype=response",
            }
            message = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
            if row.revisit:
                fields |= {
                    "WARC-Type": "revisit",
                    "WARC-Profile": REVISIT_PROFILE,
                    "WARC-Refers-To": f"<urn:x-page:{row.refers_to or ''}:0>",
                    "X-Payload-Length": str(len(payload)),
                }
            else:
                message += chunked(payload, chunk_bytes)
            parts = [message[i : i + segment_bytes] for i in range(0, len(message), segment_bytes)]
            for k, part in enumerate(parts, 1):
                own = dict(fields)
                if len(parts) > 1:
                    own["WARC-Segment-Number"] = str(k)
                if k > 1:
                    own = {
                        "WARC-Type": "continuation",
                        "WARC-Record-ID": f"{name[:-1]}:{k}>",
                        "WARC-Date": DATE,
                        "WARC-Segment-Origin-ID": name,
                        "WARC-Segment-Number": str(k),
                    }
                    if k == len(parts):
                        own["WARC-Segment-Total-Length"] = str(len(message))
                out.append(record(own, part)[:-1])  # the sink adds the last line feed
        yield pd.DataFrame({"record": out})


def write(
    pages: DataFrame,
    path: str,
    least_revisit_bytes: int = 0,
    segment_bytes: int = 32_768,
    chunk_bytes: int = 8_192,
    records_per_file: int = 4_096,
) -> None:
    """Archive ``pages`` (page_id, url, html). A file holds at most records_per_file x segment_bytes and headers.

    Only payloads that occur twice are joined back, by digest; the table of these is written first,
    so the join broadcasts it only if it is small.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumns(
        {"sha": F.sha1("payload"), "bytes": F.length("payload")}
    )
    digests = common.stored(rows.select("page_id", "sha", "bytes", F.xxhash64("url").alias("u")), "warc-digests")
    repeated = digests.groupBy("sha", "bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies"))
    repeated = common.stored(
        repeated.where((F.col("copies") > 1) & (F.col("bytes") >= least_revisit_bytes)).drop("copies"), "warc-repeated"
    )
    # Rows that share an id are rare; they are numbered by payload and URL.
    twice = digests.groupBy("page_id").agg(F.count("*").alias("c")).where("c > 1").select("page_id")
    twice = common.stored(twice, "warc-twice")
    order = Window.partitionBy("page_id").orderBy("sha", F.xxhash64("url"))
    is_twice = F.broadcast(twice) if twice.count() < 10_000 else twice
    single = rows.join(is_twice, rows["page_id"].eqNullSafe(is_twice["page_id"]), "left_anti").withColumn("number", F.lit(0))
    several = rows.join(is_twice, rows["page_id"].eqNullSafe(is_twice["page_id"]), "left_semi")
    # The target of revisits must be number 0, whatever payload sorts first.
    several = several.join(repeated.select("sha", "refers_to"), "sha", "left").withColumn(
        "number",
        F.row_number().over(
            Window.partitionBy("page_id").orderBy(
                F.col("refers_to").eqNullSafe(F.col("page_id")).desc(), "sha", F.xxhash64("url")
            )
        ) - 1,
    ).drop("refers_to")
    numbered = single.unionByName(several.select(single.columns))
    linked = numbered.join(repeated, ["sha", "bytes"], "left").withColumn(
        "revisit",
        F.col("sha").isNotNull() & F.col("refers_to").isNotNull()
        & ~(F.col("refers_to").eqNullSafe(F.col("page_id")) & (F.col("number") == 0)),
    )
    ids = [common.as_text(c, c) for c in ("page_id", "refers_to")]
    linked.select(*ids, "number", "url", "payload", "revisit").mapInPandas(
        lambda batches: records(batches, segment_bytes, chunk_bytes), "record binary"
    ).select(F.col("record").cast("string")).write.option("lineSep", "\n").option("compression", "none").option(
        "maxRecordsPerFile", records_per_file
    ).text(path)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (names in lower case) and block of each record of a file."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        start = head_end + 4
        end = start + int(fields["content-length"])
        yield fields, data[start:end]
        at = end + 4


def decoded(fields: dict[str, str], block: bytes) -> tuple[bytes | None, str | None]:
    """Payload of a whole HTTP message, or what is wrong with it."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None, "no HTTP header"
    if fields["warc-type"] == "revisit":
        return None, None
    if b"transfer-encoding: chunked" in head.lower():
        try:
            body = unchunked(body)
        except ValueError as error:
            return None, str(error)
    claimed = fields.get("warc-payload-digest", "")
    if claimed.startswith("sha1:") and claimed[5:] != digest32(body):
        return None, "digest differs"
    return body, None


RECORD = (
    "record_id string, record_type string, url string, refers_to string, payload_digest string, payload_bytes long, "
    "payload binary, problem string"
)


def _row(fields: dict[str, str], block: bytes) -> tuple:
    payload, problem = decoded(fields, block)
    size = len(payload) if payload is not None else int(fields.get("x-payload-length", -1))
    return (
        fields["warc-record-id"], fields["warc-type"], fields.get("warc-target-uri"), fields.get("warc-refers-to"),
        fields.get("warc-payload-digest", "").removeprefix("sha1:"), size if size >= 0 else None, payload, problem,
    )


def whole_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in RECORD.split(", ")]
    for batch in batches:
        for content in batch["content"]:
            rows = [_row(f, b) for f, b in parsed(bytes(content)) if "warc-segment-number" not in f]
            yield _frame(rows, names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    frame["payload_bytes"] = frame["payload_bytes"].astype("Int64")
    return frame


SEGMENT = "origin string, segment int, total long, fields map<string,string>, block binary"


def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content in batch["content"]:
            rows = [
                (
                    f.get("warc-segment-origin-id", f["warc-record-id"]),
                    int(f["warc-segment-number"]),
                    int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None,
                    f,
                    b,
                )
                for f, b in parsed(bytes(content))
                if "warc-segment-number" in f
            ]
            frame = pd.DataFrame(rows, columns=["origin", "segment", "total", "fields", "block"])
            frame["total"] = frame["total"].astype("Int64")
            yield frame


def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records of rows (origin, parts), the parts in the order of their numbers."""
    names = [c.split()[0] for c in RECORD.split(", ")]
    for batch in batches:
        rows = []
        for origin, parts in zip(batch["origin"], batch["parts"], strict=True):
            numbers = [p["segment"] for p in parts]
            totals = {int(p["total"]) for p in parts if p["total"] is not None}
            block = b"".join(bytes(p["block"]) for p in parts)
            first = dict(parts[0]["fields"])
            if numbers != list(range(1, len(parts) + 1)):
                problem = "segments missing or repeated"
            elif totals != {len(block)}:
                problem = "segments do not add up to the total length"
            else:
                rows.append(_row(first, block))
                continue
            rows.append((origin, first["warc-type"], first.get("warc-target-uri"), None, None, None, None, problem))
        yield _frame(rows, names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived record, continuations joined to their origin."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    # Segments that were written twice alike count once.
    found = files.mapInPandas(segments, SEGMENT)
    whole = files.mapInPandas(whole_records, RECORD)
    parts = found.groupBy("origin").agg(
        F.array_sort(
            F.array_distinct(
                F.collect_list(F.struct("segment", "total", F.map_entries("fields").alias("fields"), "block"))
            )
        ).alias("parts")
    )
    plain = F.transform(
        "parts",
        lambda p: F.struct(
            p["segment"].alias("segment"), p["total"].alias("total"),
            F.map_from_entries(p["fields"]).alias("fields"), p["block"].alias("block"),
        ),
    )
    return whole.unionByName(parts.select("origin", plain.alias("parts")).mapInPandas(joined, RECORD))


def page_number(name: str):
    return F.regexp_extract(name, r"^<urn:x-page:(-?\d*):", 1)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.new_path(spark, "warc")
    write(common.table(spark, sf_dir, "pages"), path)
    number = lambda c: F.when(page_number(c) != "", page_number(c).cast("long"))
    return read(spark, path).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS sha FROM pages
), t AS (SELECT sha, payload_bytes, max(page_id) AS target FROM p GROUP BY ALL)
SELECT page_id, payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                              1 + (('0x' || substr(sha || '0000', 1 + (5 * i) // 4, 2))::INT
                                   >> (3 - (5 * i) % 4)) % 32, 1) FOR i IN range(32)], 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = target THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> target THEN target END AS refers_to
FROM p JOIN t USING (sha, payload_bytes)
"""
