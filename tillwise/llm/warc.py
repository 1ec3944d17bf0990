"""A content-addressed archive of web records: payloads once, headers apart."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.session import checkpoint_dir

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of binary data: 20 bits, four letters, at a time."""
    hexes = F.sha1(payload)
    letters = []
    for part in range(8):
        bits = F.conv(F.substring(hexes, 5 * part + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(31)
            letters.append(F.substring(F.lit(ALPHABET), at + 1, F.lit(1)))
    return F.concat(*letters)


def _one_line(value: Column) -> Column:
    """A header value: control characters would start another header."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"[\x00-\x1f\x7f]", " ")


def _header(kind: Column, page: Column, url: Column, sha1: Column, sha256: Column, length: Column,
            refers: Column, date: str) -> Column:
    record = F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))
    return F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), _one_line(url)),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), sha1),
        F.concat(F.lit("WARC-Payload-Digest-Strong: sha256:"), sha256),
        F.concat(F.lit("WARC-Payload-Length: "), length.cast("string")),
        F.when(kind == "revisit", F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(kind == "revisit", F.concat(F.lit("WARC-Refers-To: <urn:page:"), refers.cast("string"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(
            F.lit("Content-Length: "),
            (F.when(kind == "revisit", 0).otherwise(length) + len(HTTP_HEAD)).cast("string"),
        ),
    )


def write_archive(
    pages: DataFrame, folder: str | None = None, *, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
) -> str:
    """Write one record per row of ``pages`` and return the archive's folder.

    ``payloads`` holds each distinct payload (the html in UTF-8, null as empty) once, under
    its SHA-256; ``headers`` holds every record's header lines, which name that digest, and
    nothing else. Of records
    with equal payloads of at least ``min_bytes`` bytes, the one with the largest page_id is a
    response and the others revisit it; shorter ones are all responses. Rows that repeat the
    largest page_id are all responses. A null page_id is the smallest; where all of a
    payload's page_ids are null, the records are all responses. Other columns are not read.

    Only digests and ids are grouped, so payloads that a third of all rows share gather
    nowhere; the html moves once, by page_id, to pick the rows that hold a payload's copy.
    """
    spark = pages.sparkSession
    folder = folder or f"{checkpoint_dir(spark)}/archive-{uuid.uuid4().hex}"
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), body.alias("payload"))
    digested = rows.select(
        "page_id", "url", F.octet_length("payload").cast("long").alias("length"),
        base32_sha1(F.col("payload")).alias("sha1"), F.sha2("payload", 256).alias("sha256"),
    )
    digested.write.parquet(f"{folder}/digests")
    digested = spark.read.schema(digested.schema).parquet(f"{folder}/digests")
    owners = digested.groupBy(F.col("sha256").alias("_sha256")).agg(F.max("page_id").alias("_owner"))
    owned = digested.join(owners, F.col("sha256") == F.col("_sha256"))
    kind = F.when(
        (F.col("length") >= min_bytes) & F.col("_owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_owner")),
        "revisit",
    ).otherwise("response")
    refers = F.when(kind == "revisit", F.col("_owner"))
    owned.select(
        _header(kind, F.col("page_id"), F.col("url"), F.col("sha1"), F.col("sha256"), F.col("length"), refers, date)
        .alias("header"),
    ).write.parquet(f"{folder}/headers")
    # One row for a payload: the owner's page_id says which rows hold it, the digest which of them.
    holders = owners.select(F.coalesce("_owner", F.lit(-(1 << 63))).alias("_page"), "_sha256")
    copies = rows.select(
        F.coalesce("page_id", F.lit(-(1 << 63))).alias("_page"), F.sha2("payload", 256).alias("sha256"), "payload"
    )
    stored = copies.join(
        holders.hint("shuffle_hash"),
        (copies["_page"] == holders["_page"]) & (copies["sha256"] == holders["_sha256"]),
        "left_semi",
    )
    stored.select("sha256", "payload").write.parquet(f"{folder}/payloads")
    return folder


def _table(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/{name}")


def _field(name: str, form: str) -> Column:
    """The value of the header line ``name``, whole and of the given form, else null. Values hold
    no line ends, so no value is taken for another line."""
    line = F.regexp_extract("header", rf"(?:^|\r\n){name}: ({form})(?=\r\n|\z)", 1)
    return F.when(line != "", line)


def read_headers(spark: SparkSession, folder: str) -> DataFrame:
    """What the stored header lines say, nothing else being stored of a record: page_id,
    record_type, refers_to, sha1, sha256, length, content_length, and the lines. A line that is
    missing or damaged gives null; so does the page_id of a page that had none."""
    page = r"<urn:page:(?:-?\d{1,19}|none)>"

    def number(value: Column) -> Column:
        return F.regexp_extract(value, r"-?\d+", 0).try_cast("long")

    return _table(spark, folder, "headers", "header string").select(
        number(_field("WARC-Record-ID", page)).alias("page_id"),
        _field("WARC-Type", "response|revisit").alias("record_type"),
        number(_field("WARC-Refers-To", page)).alias("refers_to"),
        _field("WARC-Payload-Digest", "sha1:[A-Z2-7]{32}").substr(6, 32).alias("sha1"),
        _field("WARC-Payload-Digest-Strong", "sha256:[0-9a-f]{64}").substr(8, 64).alias("sha256"),
        number(_field("WARC-Payload-Length", r"\d{1,18}")).alias("length"),
        number(_field("Content-Length", r"\d{1,18}")).alias("content_length"),
        "header",
    )


def _body(payload: Column) -> Column:
    """The block of a record: a revisit's holds no payload."""
    own = F.when(F.col("record_type") == "response", payload).otherwise(F.lit(b""))
    return F.concat(F.lit(HTTP_HEAD.encode()), own)


def _agrees(length: Column, sha1: Column) -> Column:
    """Whether the header's lengths and digest are those of the stored payload."""
    block = F.when(F.col("record_type") == "revisit", 0).otherwise(length) + len(HTTP_HEAD)
    return (F.col("length") == length) & (F.col("sha1") == sha1) & (F.col("content_length") == block)


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads whose bytes have the digest they are stored under. Repeated rows of pages
    may have stored a payload twice; see ``read_digests`` and ``read_records``."""
    stored = _table(spark, folder, "payloads", "sha256 string, payload binary")
    return stored.filter(F.sha2("payload", 256) == F.col("sha256"))


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """What the archive's header lines say of every record, held against length and SHA-1
    taken anew from the stored payloads: page_id, payload_bytes, payload_digest, record_type,
    refers_to. Bytes and digest are null where the payload is missing or damaged or the header
    says otherwise; a damaged type or reference is null.

    Payloads are read and digested where they are stored; only their digests are joined."""
    payloads = read_payloads(spark, folder).select(
        F.col("sha256").alias("_sha256"),
        F.octet_length("payload").cast("long").alias("_bytes"),
        base32_sha1(F.col("payload")).alias("_sha1"),
    ).dropDuplicates(["_sha256"])
    both = read_headers(spark, folder).join(payloads, F.col("sha256") == F.col("_sha256"), "left")
    agrees = _agrees(F.col("_bytes"), F.col("_sha1"))
    return both.select(
        "page_id", F.when(agrees, F.col("_bytes")).alias("payload_bytes"),
        F.when(agrees, F.col("_sha1")).alias("payload_digest"), "record_type", "refers_to",
    )


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Whole records: (page_id, record, payload). ``record`` is the record's bytes as they
    would stand in a WARC file; a revisit's record has no payload, but ``payload`` gives
    that of the response it refers to. Both are null where the header and the payload do not
    agree."""
    payloads = read_payloads(spark, folder).withColumnRenamed("sha256", "_sha256").dropDuplicates(["_sha256"])
    both = read_headers(spark, folder).join(payloads, F.col("sha256") == F.col("_sha256"), "left")
    agrees = _agrees(F.octet_length("payload").cast("long"), base32_sha1(F.col("payload")))
    record = F.concat(F.encode("header", "UTF-8"), F.lit(b"\r\n\r\n"), _body(F.col("payload")), F.lit(b"\r\n\r\n"))
    return both.select(
        "page_id", F.when(agrees, record).alias("record"), F.when(agrees, F.col("payload")).alias("payload")
    )
