"""Content-addressed WARC archive.

An archive is two tables in the shared folder. ``payloads`` holds each distinct
payload once under its SHA-256; ``headers`` holds, for each record, the exact
bytes that stand before the payload (WARC header and HTTP head) and the payload's
key. A payload's SHA-1 and length must be the same for all records of a key, or
the write fails; reading recomputes both digests and fails on a difference.
Records are put together by a join of the two tables.

Of records with equal payloads of at least ``min_bytes`` bytes, that with the
largest page_id is a response and the others are revisits that refer to it;
smaller payloads are always responses. Copies are collapsed before the shuffle,
so a payload that many pages share travels once for each task that reads it.

Defined results: null html is the empty payload. A null page_id is never the
largest; it is a response only if no page with its payload has an id. Repeated
rows of the largest page_id are all responses. A null url leaves its header line
out; line ends in a url are percent-encoded. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import materialize

END = "\r\n"
# Fixed values of the formats: RFC 4648 base32, the WARC revisit profile, an HTTP head.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=UTF-8{END}{END}"


@dataclass
class Archive:
    """``headers``: header binary, key. ``payloads``: key, payload."""

    headers: DataFrame
    payloads: DataFrame


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base32: 10 hex digits are 8 digits to the base 32."""
    digits = F.concat(*[F.lpad(F.conv(F.substring(F.sha1(payload), 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END))


def write_archive(pages: DataFrame, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> Archive:
    payload = F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit(b""))
    records = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).select(
        "page_id", "url", "payload", F.sha2("payload", 256).alias("key"),
        F.octet_length("payload").alias("size"), base32_sha1(F.col("payload")).alias("sha1"))
    store = materialize(
        records.groupBy("key").agg(
            F.first("payload").alias("payload"), F.max("page_id").alias("response_id"), F.min("size").alias("size"),
            F.min("sha1").alias("sha1"), ((F.min("sha1") == F.max("sha1")) & (F.min("size") == F.max("size"))).alias("same")),
        "warc-payloads")
    clash = store.where("NOT same").select("key").first()
    if clash:
        raise ValueError(f"different payloads share the digest {clash['key']}")
    marked = (records.select("page_id", "url", "key").join(store.select("key", "response_id", "size", "sha1"), "key")
              .withColumn("revisit", (F.col("size") >= min_bytes) & F.coalesce(F.col("page_id") != F.col("response_id"),
                                                                              F.col("response_id").isNotNull())))
    block = F.lit(len(HTTP_HEAD)) + F.when(F.col("revisit"), 0).otherwise(F.col("size"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    def urn(page_id: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page_id).cast("string"), F.lit("none")), F.lit(">"))

    header = F.concat(
        F.lit(f"WARC/1.1{END}"), _line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", urn("page_id")), _line("WARC-Date", F.lit(date)),
        F.when(F.col("revisit"), F.concat(_line("WARC-Refers-To", urn("response_id")), _line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        F.when(F.col("url").isNotNull(), _line("WARC-Target-URI", url)).otherwise(""),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.lit(f"Content-Type: application/http; msgtype=response{END}"), _line("Content-Length", block), F.lit(END + HTTP_HEAD))
    headers = materialize(marked.select(F.encode(header, "UTF-8").alias("header"), "key"), "warc-headers")
    return Archive(headers, store.select("key", "payload"))


def read_archive(archive: Archive) -> DataFrame:
    """One row a record: header, record_type, page_id, refers_to, payload (whole, of revisits too),
    payload_digest, and record: the record's bytes as a WARC file holds them."""
    digest = base32_sha1(F.col("payload"))
    payloads = archive.payloads.select(
        "payload", digest.alias("payload_digest"),
        F.when(F.sha2("payload", 256) == F.col("key"), F.col("key")).otherwise(
            F.raise_error(F.concat(F.lit("damaged payload "), F.col("key"))).cast("string")).alias("key"))
    text = F.decode("header", "UTF-8")

    def field(name: str, pattern: str = "([^\r]*)") -> Column:
        return F.nullif(F.regexp_extract(text, f"\r\n{name}: {pattern}\r\n", 1), F.lit(""))

    urn = "<urn:page:(-?[0-9]+)>"
    rows = archive.headers.join(payloads, "key").select(
        "header", field("WARC-Type").alias("record_type"), field("WARC-Record-ID", urn).cast("long").alias("page_id"),
        field("WARC-Refers-To", urn).cast("long").alias("refers_to"), "payload",
        F.when(field("WARC-Payload-Digest", "sha1:([A-Z2-7]*)") == F.col("payload_digest"), F.col("payload_digest")).otherwise(
            F.raise_error(F.lit("a record's digest differs from its payload's")).cast("string")).alias("payload_digest"))
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return rows.withColumn("record", F.concat("header", body, F.lit((END + END).encode())))


def query(pages: DataFrame) -> DataFrame:
    return read_archive(write_archive(pages)).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS response_id FROM p GROUP BY html),
d AS (SELECT html, response_id, sha1(html) AS hex FROM g)
SELECT p.page_id, octet_length(encode(p.html)) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}', 1 + CAST(
    ((('0x' || substr(d.hex, CAST(1 + 5 * (i // 4) AS INTEGER), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN p.page_id = d.response_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id <> d.response_id THEN d.response_id END AS refers_to
FROM p JOIN d ON p.html = d.html
"""
