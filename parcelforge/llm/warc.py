"""Content-addressed WARC archive.

Payload bytes are stored once under a verified strong digest (SHA-256); the exact header block of every record is
stored apart; joining the two gives the original records back, byte for byte. Of records with equal payloads of at
least ``REVISIT_BYTES`` the one with the largest id is a ``response`` and the others are ``revisit`` records that
refer to it; shorter payloads always make ``response`` records.

Defined cases: a null payload is empty; a null url gives an empty target; a null id is written as ``null`` and read
back as null (such a record never is the one that others refer to unless none has an id); repeated rows give repeated
records; line breaks in a url are percent-encoded; payloads of any length are taken whole; empty input gives an empty
archive; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import materialise, new_path, released

REVISIT_BYTES = 1000
# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


@dataclass(frozen=True)
class Archive:
    """Where an archive's two tables lie."""

    path: str

    @property
    def headers(self) -> str:
        return f"{self.path}/headers"

    @property
    def payloads(self) -> str:
        return f"{self.path}/payloads"


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def _header_block(kind: Column, page: Column, url: Column, refers: Column, sha1: Column, size: Column, date: str) -> Column:
    """The record's bytes up to its payload: WARC headers, an empty line, then the HTTP headers and an empty line."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit(END))
    block = F.octet_length(http) + F.when(kind == "response", size).otherwise(F.lit(0))
    revisit = F.concat(F.lit("WARC-Refers-To: "), _record_id(refers), F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\n"))
    lines = [
        F.lit(f"{VERSION}\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: "), _record_id(page),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), sha1, F.lit("\r\n"), F.when(kind == "revisit", revisit).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), block.cast("string"), F.lit(END), http,
    ]
    return F.concat(*lines)


def _stored(source: DataFrame, groups: DataFrame) -> DataFrame:
    """``digest, payload``: of each group of equal payloads the one of its first record."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null")).alias("name")
    chosen = groups.select(name("first"), "digest")
    # Joined by both columns that group them afterwards: repeated rows lie together already, so payloads cross the network once.
    told = source.select(name("id"), F.unhex(F.sha2("payload", 256)).alias("digest"), "payload").join(chosen.hint("merge"), ["name", "digest"])
    return told.groupBy("name", "digest").agg(F.first("payload").alias("payload")).select("digest", "payload")


def write_archive(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "2000-01-01T00:00:00Z") -> Archive:
    """Write one record for each row of ``pages``. Payload bytes cross one shuffle, and only those stored."""
    spark = pages.sparkSession
    archive = Archive(path or new_path(spark, "warc"))
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    with released(spark):
        facts = materialise(
            source.select("id", "url", F.unhex(F.sha2("payload", 256)).alias("digest"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("size")),
            "warc-facts",
        )
        # Written, so that Spark can split a payload that a third of the pages have when it joins.
        groups = materialise(facts.groupBy("digest").agg(F.max("id").alias("first")), "warc-groups")
        big = F.col("size") >= REVISIT_BYTES
        rank = F.coalesce(F.col("id") == F.col("first"), F.col("first").isNull())
        records = facts.join(groups.hint("merge"), "digest").withColumn("kind", F.when(big & ~rank, "revisit").otherwise("response"))
        # Repeated ids with one payload: each is a response of its own, as a record can't refer to itself.
        header = _header_block(F.col("kind"), F.col("id"), F.col("url"), F.col("first"), F.col("sha1"), F.col("size"), date)
        records.select("digest", F.col("kind") == "response", header.cast("binary")).toDF("digest", "has_payload", "header").write.option("compression", "zstd").parquet(archive.headers)
        _stored(source, groups).write.option("compression", "zstd").parquet(archive.payloads)
    return archive


def read_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """``digest, payload``; a payload that no longer has its digest raises an error."""
    rows = spark.read.parquet(archive.payloads)
    intact = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    return rows.select("digest", F.when(intact, F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload doesn't have its digest")).cast("binary")).alias("payload"))


def read_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """The original records: ``header`` and ``payload`` (empty for revisits), joined by digest."""
    headers = spark.read.parquet(archive.headers)
    whole = headers.where("has_payload").join(read_payloads(spark, archive), "digest").select("header", "payload")
    return whole.unionByName(headers.where("NOT has_payload").select("header", F.lit("").cast("binary").alias("payload")))


def record_bytes(header: Column, payload: Column) -> Column:
    """A record as it stands in a .warc file."""
    return F.concat(header, payload, F.lit(END).cast("binary"))


def write_files(records: DataFrame, path: str) -> None:
    """The records as .warc content, a file for each partition, one record after the other."""
    whole = F.decode(F.concat("header", "payload"), "utf-8")
    records.select(whole.alias("value")).write.option("lineSep", END).text(path)


def parse_records(records: DataFrame) -> DataFrame:
    """``page_id, record_type, target_uri, digest_header, refers_to, content_length, payload`` from header bytes."""
    text = F.decode(F.col("header"), "utf-8")

    def field(name: str) -> Column:
        return F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)

    def page(name: str) -> Column:
        return F.expr(f"try_cast(regexp_extract({name}, 'page:(-?[0-9]+)>', 1) AS BIGINT)")

    found = records.select(
        field("WARC-Record-ID").alias("record_id"), field("WARC-Type").alias("record_type"), field("WARC-Target-URI").alias("target_uri"),
        F.regexp_extract(text, r"\r\nWARC-Payload-Digest: sha1:([0-9a-f]{40})\r\n", 1).alias("digest_header"),
        field("WARC-Refers-To").alias("refers"), field("Content-Length").cast("long").alias("content_length"), "payload",
    )
    return found.withColumn("page_id", page("record_id")).withColumn("refers_to", page("refers")).drop("record_id", "refers")
