"""Content-addressed WARC archive.

``write_archive`` keeps two tables in the shared folder: ``payloads`` holds the
bytes of each distinct payload once, under its SHA-256, and ``records`` holds the
exact header of every record with the key of its payload.  Of records with equal
payloads those of the smallest page id are ``response`` records, the others
``revisit`` records that refer to it.  ``read_records`` joins headers and payloads
to whole records again; payloads are verified against their keys and the digests
in the headers, and a payload that is missing or altered ends the job with an
error.  ``write_warc`` exports plain WARC files.  Built-in functions only.

A null html is an empty payload, a null url an empty target.  A null page id is
never the smallest, unless all ids of a payload are null; then all those records
are responses.  Rows repeated with one page id are responses (or revisits) alike.
CR and LF in a url are percent-encoded in the header.  An empty table gives an
empty archive; further columns are ignored.

A payload that many pages share is reduced to one row before it is shuffled, and
only narrow headers carry its key.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroute.session import ensure_checkpoint_dir

DATE = "2024-01-01T00:00:00Z"       # pages carry no time of their own
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"


@dataclass(frozen=True)
class Archive:
    """Folders of the payload and the record table."""
    payload_path: str
    record_path: str

    def payloads(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("key string, first_id long, payload binary").parquet(self.payload_path)

    def records(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("key string, header string").parquet(self.record_path)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: each five hex digits are four base-32 ones."""
    digits = F.concat(*[F.lpad(F.conv(F.substring(F.sha1(payload), 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _header(date: str) -> Column:
    """The exact header of a record, from version line to the last field's line end."""
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    common = F.concat(_line("WARC-Record-ID", _page_urn(F.col("page_id"))), _line("WARC-Target-URI", url),
                      _line("WARC-Date", F.lit(date)),
                      _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))))
    whole = F.concat(_line("WARC-Type", F.lit("response")), common,
                     _line("Content-Type", F.lit("text/html; charset=utf-8")),
                     _line("Content-Length", F.col("n_bytes").cast("string")))
    again = F.concat(_line("WARC-Type", F.lit("revisit")), common, _line("WARC-Profile", F.lit(PROFILE)),
                     _line("WARC-Refers-To", _page_urn(F.col("first_id"))), _line("Content-Length", F.lit("0")))
    return F.concat(F.lit("WARC/1.1" + CRLF), F.when(F.col("revisit"), again).otherwise(whole))


def write_archive(pages: DataFrame, path: str | None = None, least_bytes: int = 0, date: str = DATE) -> Archive:
    """Archive ``pages`` (page_id, url, html) below ``path`` (a fresh shared folder by default).

    Payloads of fewer than ``least_bytes`` bytes are stored once as well, but all
    their records are responses.
    """
    spark = pages.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    archive = Archive(f"{path}/payloads", f"{path}/records")
    payload = F.encode(F.coalesce(pages["html"], F.lit("")), "utf-8")
    src = pages.select("page_id", "url", payload.alias("payload")).withColumn("key", F.sha2("payload", 256))
    (src.groupBy("key").agg(F.min("page_id").cast("long").alias("first_id"), F.first("payload").alias("payload"))
     .write.parquet(archive.payload_path))
    narrow = src.select("page_id", "url", "key", base32_sha1(F.col("payload")).alias("sha1"),
                        F.octet_length("payload").cast("long").alias("n_bytes"))
    first = archive.payloads(spark).select("key", "first_id")
    revisit = (F.col("n_bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    (narrow.join(first, "key").withColumn("revisit", revisit).select("key", _header(date).alias("header"))
     .write.parquet(archive.record_path))
    return archive


def field(header: Column, name: str) -> Column:
    """Value of a header field, null where the record has none."""
    found = F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.contains(header, F.lit(f"{CRLF}{name}: ")), found)


def page_of(urn: Column) -> Column:
    return F.nullif(F.regexp_extract(urn, r"<urn:page:(-?\d*)>", 1), F.lit("")).cast("long")


def read_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """Whole records: page_id, record_type, refers_to, header, payload, payload_digest.

    Payloads are verified once each, before they meet their records.
    """
    stored = archive.payloads(spark).select(
        F.col("key"), base32_sha1(F.col("payload")).alias("sha1"),
        F.when(F.sha2("payload", 256) == F.col("key"), F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("altered payload "), F.col("key")))).alias("payload"))
    head = F.col("header")
    digest = F.substring(field(head, "WARC-Payload-Digest"), 6, 32)
    sound = F.when(F.col("payload").isNotNull() & (F.col("sha1") == F.col("payload_digest")), F.col("payload"))
    return (archive.records(spark).withColumn("payload_digest", digest).join(stored, "key", "left")
            .select(page_of(field(head, "WARC-Record-ID")).alias("page_id"),
                    field(head, "WARC-Type").alias("record_type"),
                    page_of(field(head, "WARC-Refers-To")).alias("refers_to"), "header",
                    sound.otherwise(F.raise_error(F.concat(F.lit("no payload for "), head))).alias("payload"),
                    "payload_digest"))


def write_warc(records: DataFrame, path: str, whole: bool = False) -> None:
    """Write records of ``read_records`` as WARC files (one a partition).

    Revisits are written without their payload; with ``whole`` each record is
    restored to a response that holds it.  A record ends with two line ends,
    which Spark's text writer sets between rows.
    """
    block = F.decode("payload", "utf-8")
    revisit = F.col("record_type") == "revisit"
    header = F.col("header")
    if whole:
        dropped = F.regexp_replace(header, r"\r\n(WARC-Profile|WARC-Refers-To|Content-Length): [^\r\n]*(?=\r\n)", "")
        restored = F.concat(F.replace(dropped, F.lit("WARC-Type: revisit"), F.lit("WARC-Type: response")),
                            _line("Content-Type", F.lit("text/html; charset=utf-8")),
                            _line("Content-Length", F.octet_length("payload").cast("string")))
        header = F.when(revisit, restored).otherwise(header)
    else:
        block = F.when(revisit, "").otherwise(block)
    (records.select(F.concat(header, F.lit(CRLF), block).alias("value"))
     .write.option("lineSep", CRLF + CRLF).text(path))
