"""Operator 5: a content-addressed WARC archive.

Payload bytes are stored once for each strong digest, the records' exact headers are stored separately, and records are
rebuilt by joining the two. All of it is column work: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import own_path

_END = "\r\n"
#: The date of every record: archives of equal pages are equal bytes.
_DATE = "2024-01-01T00:00:00Z"


#: What a revisit of an equal payload declares (fixed value of the WARC 1.1 format).
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page: Column, url: Column, digest: Column) -> Column:
    """A stable URN made from the page's id (null apart from an empty text), its address and its payload."""
    h = F.md5(F.concat_ws("|", F.when(page.isNull(), F.lit("null")).otherwise(F.concat(F.lit("page:"), page.cast("string"))), digest, url).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for x in (F.lit("-") if a > 1 else F.lit(""), F.substring(h, a, n))], F.lit(">"))


def write_archive(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 1000,
) -> None:
    """Write one WARC record per row of ``pages`` below ``path``: tables ``payloads`` and ``headers``.

    ``payloads`` holds each distinct payload once: ``(sha256, sha1, n_bytes, payload)``. ``headers`` holds for each
    record ``(page_id, sha256, header)``, the header being the record's exact bytes up to its blank line. Of the records
    with equal payloads of at least ``min_revisit_bytes``, that with the largest id is a response and the others are
    revisits that refer to it; all others are responses. Equality is by SHA-256 together with SHA-1 and length.

    A null payload is empty bytes, a null url an empty target. Every row is a record; record ids are made from id, url and
    payload, so only rows that agree in all three share one. A null id sorts first and is never a target unless all are null. Extra columns are ignored.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"").cast("binary"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload"))
    keyed = rows.select("page_id", "url", F.sha2("payload", 256).alias("sha256"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n_bytes"))
    key = ["sha256", "sha1", "n_bytes"]
    keepers = keyed.groupBy(*key).agg(F.max(F.struct("page_id", "url")).alias("kept"))
    records = keyed.join(keepers, key).withColumns({"keeper": F.col("kept.page_id"), "keeper_url": F.col("kept.url")})
    revisit = (F.col("n_bytes") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    stored = F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes"))
    fields = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("url"), F.col("sha256"))),
        F.lit(f"WARC-Date: {_DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", "")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.concat(F.lit("X-Payload-Length: "), F.col("n_bytes").cast("string")),
        F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("keeper"), F.col("keeper_url"), F.col("sha256")))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To-Target-URI: "), F.regexp_replace("keeper_url", r"[\r\n]", ""))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.when(revisit, F.concat(F.lit("X-Refers-To-Page: "), F.col("keeper").cast("string"))),
        F.concat(F.lit("Content-Length: "), stored.cast("string")),
    ]
    header = F.concat(F.concat_ws(_END, *fields), F.lit(_END * 2)).cast("binary")
    records.select("page_id", "sha256", header.alias("header")).write.parquet(f"{path}/headers")
    # partial aggregation drops copies before the shuffle
    kept = rows.groupBy(F.sha2("payload", 256).alias("sha256"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n_bytes"))
    kept.agg(F.first("payload").alias("payload")).write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Read an archive: ``(page_id, header, record_type, refers_to, payload_digest, payload_bytes, payload, verified, record)``.

    ``record`` is the rebuilt record (header, stored block, two line ends): a revisit has an empty block, while its
    ``payload`` is that of the record it refers to. ``payload_digest`` and ``payload_bytes`` are computed from the block
    of the rebuilt record, of a revisit from the joined payload; ``verified`` tells whether they, the SHA-256 and the
    block's length agree with what header and store state. A record whose payload is missing is returned unverified.
    """
    stored = spark.read.parquet(f"{path}/payloads")
    payloads = stored.select("sha256", "payload")
    text = F.col("header").cast("string")
    field = lambda name: F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)", 1)
    headers = spark.read.parquet(f"{path}/headers").select(
        "page_id",
        "header",
        "sha256",
        field("WARC-Type").alias("record_type"),
        F.expr("nullif(regexp_extract(cast(header as string), '\\r\\nX-Refers-To-Page: ([^\\r\\n]*)', 1), '')").alias("refers_to"),
        field("WARC-Payload-Digest").alias("stated"),
        field("X-Payload-Length").cast("long").alias("stated_bytes"),
        field("Content-Length").cast("long").alias("stated_block"),
    )
    page_type = headers.schema["page_id"].dataType
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, F.lit(b"").cast("binary")).otherwise(F.col("payload"))
    rebuilt = headers.join(payloads, "sha256", "left").withColumn("record", F.concat(F.col("header"), block, F.lit(b"\r\n\r\n").cast("binary")))
    held = F.expr("substring(record, octet_length(header) + 1, octet_length(record) - octet_length(header) - 4)")
    found = rebuilt.withColumn("block", held).withColumn("content", F.when(revisit, F.col("payload")).otherwise(F.col("block")))
    digest, n_bytes = F.sha1("content"), F.octet_length("content").cast("long")
    sound = (F.sha2("content", 256) == F.col("sha256")) & (F.octet_length("block") == F.col("stated_block"))
    return found.select(
        "page_id",
        "header",
        "record_type",
        F.col("refers_to").cast(page_type).alias("refers_to"),
        digest.alias("payload_digest"),
        n_bytes.alias("payload_bytes"),
        "payload",
        F.coalesce(sound & (F.concat(F.lit("sha1:"), digest) == F.col("stated")) & (n_bytes == F.col("stated_bytes")), F.lit(False)).alias("verified"),
        "record",
    )


def new_archive_path(spark: SparkSession) -> str:
    """A new folder for an archive below the shared folder."""
    return own_path(spark, "warc")
