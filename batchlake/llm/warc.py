"""Content-addressed WARC archive: payloads once by digest, record headers apart.

The archive is two Parquet tables in the shared folder. ``headers`` has the exact header
block of every record; ``payloads`` has the bytes of every distinct payload under their
SHA-256. Records are rebuilt by joining the two, and each payload is checked against
both of its digests when it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlake.llm.base import landed
from batchlake.session import work_path

#: Payloads shorter than this are never revisits: the header would outweigh them.
LEAST_REVISIT_BYTES = 1000
WARC_DATE = "2024-01-01T00:00:00Z"
#: Fixed value of the WARC 1.1 standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _header_block() -> Column:
    """Header lines of one record, with the empty line that ends them."""
    revisit = F.col("revisit")

    def line(name: str, value: Column, only: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{name}: "), value, F.lit(EOL))
        return text if only is None else F.when(only, text).otherwise(F.lit(""))

    no_breaks = F.regexp_replace(F.col("url"), r"[\r\n]+", " ")
    return F.concat(
        F.lit(f"WARC/1.1{EOL}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.lit(WARC_DATE)),
        F.coalesce(line("WARC-Target-URI", no_breaks), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        # the block of a revisit is empty
        line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.when(revisit, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("digest")))),
        line("WARC-Profile", F.lit(REVISIT_PROFILE), revisit),
        F.coalesce(line("WARC-Refers-To", F.col("owner_record_id"), revisit), F.lit("")),
        F.coalesce(line("X-Refers-To-Page", F.col("owner").cast("string"), revisit), F.lit("")),
        F.coalesce(line("X-Page-ID", F.col("page_id").cast("string")), F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("length").cast("string"))),
        F.lit(EOL),
    )


def write_archive(pages: DataFrame, path: str | None = None, least: int = LEAST_REVISIT_BYTES) -> str:
    """One record for each row of (page_id, url, html); returns the archive's folder.

    Null html is an empty payload; other columns are ignored. The response among equal
    payloads is the row with the largest page_id (null is the smallest); of rows that
    share it, one. The owner of a digest comes from an aggregate of narrow rows that is
    combined ahead of its shuffle, and payloads are made distinct the same way, so a
    payload shared by a third of the pages costs a row for each task.
    """
    spark = pages.sparkSession
    path = path or work_path(spark, "warc")
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    payloads = pages.select(F.sha2(body, 256).alias("digest"), body.alias("payload"))
    payloads.groupBy("digest").agg(F.first("payload").alias("payload")).write.option("compression", "zstd").parquet(
        f"{path}/payloads"
    )
    # numbered once and written, so that rows repeated whole stay apart in every later read
    index = landed(
        pages.select(
            F.monotonically_increasing_id().alias("number"),
            "page_id",
            F.col("url").cast("string").alias("url"),
            F.octet_length(body).cast("long").alias("length"),
            F.sha1(body).alias("sha1"),
            F.sha2(body, 256).alias("digest"),
        ),
        "warc-index",
    )
    rank = F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "number")
    owners = (
        index.filter(F.col("length") >= least)
        .groupBy(F.col("digest").alias("of"))
        .agg(F.max(rank).alias("best"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select("of", F.col("best.page_id").alias("owner"), F.col("best.number").alias("owner_number"))
    )
    records = (
        index.join(owners, F.col("digest") == F.col("of"), "left")
        .withColumn("revisit", F.coalesce(F.col("number") != F.col("owner_number"), F.lit(False)))
        .withColumn("record_id", _uuid(F.col("number").cast("string"), F.col("digest")))
        .withColumn("owner_record_id", _uuid(F.col("owner_number").cast("string"), F.col("digest")))
    )
    records.select("record_id", "digest", _header_block().alias("header")).write.option("compression", "zstd").parquet(
        f"{path}/headers"
    )
    return path


def _field(name: str) -> Column:
    value = F.regexp_extract("header", rf"(?:^|\n){name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record with its parsed header and its full payload, checked by digest.

    Columns: record_id, header, page_id, url, record_type, refers_to, payload,
    payload_digest. A payload that is missing or fails a digest raises.
    """
    headers = spark.read.schema("record_id string, digest string, header string").parquet(f"{path}/headers")
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    parsed = headers.select(
        "record_id",
        "header",
        "digest",
        _field("X-Page-ID").cast("long").alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"),
        _field("X-Refers-To-Page").cast("long").alias("refers_to"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("written"),
    )
    sound = (F.sha1("payload") == F.col("written")) & (F.sha2("payload", 256) == F.col("digest"))
    checked = F.when(F.coalesce(sound, F.lit(False)), F.col("written")).otherwise(
        F.raise_error(F.concat(F.lit("payload lost or changed: "), F.col("record_id")))
    )
    return parsed.join(payloads, "digest", "left").select(
        "record_id", "header", "page_id", "url", "record_type", "refers_to", "payload", checked.alias("payload_digest")
    )


def original_records(archive: DataFrame) -> DataFrame:
    """The records as WARC bytes; a revisit's block is empty, as the standard has it."""
    block = F.when(F.col("record_type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    whole = F.concat(F.col("header").cast("binary"), block, F.lit(EOL * 2).cast("binary"))
    return archive.select("record_id", "page_id", whole.alias("record"))
