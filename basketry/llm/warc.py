"""A content-addressed web archive.

The archive is two tables. ``payloads`` holds the bytes of every distinct payload once, under its SHA-256;
``headers`` holds the exact header block of every record and the digest of its payload. A join puts the original
records together again. A payload is told apart by SHA-256, SHA-1 and length together, and its bytes are checked
against all three when they are read.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.llm.common import renamed, stage
from basketry.operators.staging import scratch_path

CRLF = "\r\n"
# Digits of base 32, as of Spark's conv and as of RFC 4648.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# End of fixed values.


@dataclass
class Archive:
    path: str

    def headers(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/headers")

    def payloads(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/payloads")


def base32_sha1(payload) -> "F.Column":
    """SHA-1 in bare upper-case base 32: forty bits at a time, as ten hex digits and eight of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.upper(F.concat(*parts)), CONV_DIGITS, BASE32_DIGITS)


def _digests(payload) -> list:
    return [F.unhex(F.sha2(payload, 256)).alias("sha256"), base32_sha1(payload).alias("sha1"),
            F.octet_length(payload).cast("long").alias("n")]


KEY = ["sha256", "sha1", "n"]


def _header(date: str) -> "F.Column":
    """The exact header block of a record, without the empty line that ends it."""
    name = lambda record, number: F.concat(
        F.lit("<urn:x-page:"), F.coalesce(F.col(record).cast("string"), F.lit("")), F.lit(":"), F.col(number), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit(CRLF))
    revisit, gone = F.col("record_type") == "revisit", F.lit("")
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.encode(F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", name("id", "seq")),
        line("WARC-Date", F.lit(date)), F.coalesce(line("WARC-Target-URI", uri), gone),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(
            line("WARC-Refers-To", name("first_id", "first_seq")),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(gone),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n").cast("string")))), "UTF-8")


def write_archive(pages: DataFrame, path: str = None, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", date: str = "2024-01-01T00:00:00Z", least_bytes: int = 0) -> Archive:
    """Write one record per row of ``pages``, by default to a new folder in the shared one.

    A null payload is empty. Of the records with equal payloads of at least ``least_bytes`` bytes, the one with
    the largest id is the response and the others revisit it; smaller payloads are always responses. A null id
    counts as smallest; of several rows with the largest id, the last written is the response. A null URL leaves
    its header out. Other columns are not read. An empty table gives an empty archive.
    """
    source = renamed(pages, id=id_col, url=url_col, html=html_col)
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    path = path or scratch_path(pages.sparkSession, "archive")
    source.select(*_digests(payload), payload.alias("payload")).groupBy(*KEY).agg(
        F.any_value("payload").alias("payload")).write.option("compression", "zstd").parquet(f"{path}/payloads")
    # Record numbers are fixed by writing them.
    rows = stage(source.select(F.monotonically_increasing_id().alias("seq"), "id", "url", *_digests(payload)), "records")
    first = rows.groupBy(*KEY).agg(F.max(F.struct(F.col("id").isNotNull(), "id", "seq")).alias("first")).select(
        *KEY, F.col("first.id").alias("first_id"), F.col("first.seq").alias("first_seq"))
    answers = (F.col("n") < least_bytes) | (F.col("seq") == F.col("first_seq"))
    rows.join(first, KEY).withColumn("record_type", F.when(answers, "response").otherwise("revisit")).select(
        "id", "seq", "sha256", _header(date).alias("header")).write.option("compression", "zstd").parquet(f"{path}/headers")
    return Archive(path)


def verified_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """The payload table, read with a check of each payload against its digests and length."""
    stored = archive.payloads(spark)
    sound = F.lit(True)
    for measured, name in zip(_digests(F.col("payload")), KEY):
        sound &= measured == F.col(name)
    return stored.withColumn("payload", F.when(sound, F.col("payload")).otherwise(
        F.raise_error(F.lit("a stored payload does not have its digest")).cast("binary")))


def _parsed(headers: DataFrame) -> DataFrame:
    text = F.decode("header", "UTF-8")
    value = lambda key, pattern: F.regexp_extract(text, f"\\r\\n{key}: {pattern}\\r\\n", 1)
    target = F.nullif(value("WARC-Refers-To", "<urn:x-page:(.*):[0-9]+>"), F.lit(""))
    return headers.select(
        "id", "seq", "sha256", "header", value("WARC-Type", "(.*?)").alias("record_type"),
        value("WARC-Payload-Digest", "sha1:(.*?)").alias("payload_digest"),
        target.cast(headers.schema["id"].dataType).alias("refers_to"))


def read_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to): headers joined with the facts of their payload.

    Length and digest are measured from the stored bytes before the join, so the bytes themselves stay in place.
    """
    measured = verified_payloads(spark, archive).select(
        "sha256", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("stored"))
    joined = _parsed(archive.headers(spark)).join(measured, "sha256")
    return joined.select("id", "payload_bytes", F.when(F.col("stored") == F.col("payload_digest"), F.col("stored")).otherwise(
        F.raise_error(F.lit("a header names another digest than its payload has"))).alias("payload_digest"),
        "record_type", "refers_to")


def reconstruct(spark: SparkSession, archive: Archive) -> DataFrame:
    """(id, record, payload): the exact bytes of every record, and its full payload also where it is a revisit."""
    joined = _parsed(archive.headers(spark)).join(verified_payloads(spark, archive).select("sha256", "payload"), "sha256")
    line = F.lit(CRLF.encode())
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return joined.select("id", F.concat("header", line, block, line, line).alias("record"), "payload")
