"""Exact deduplication against a persistent digest index, with DataFrame operations alone.

The index lies in a folder of the caller's choice, bucketed and sorted by digest, and any later session that is given the folder
finds it there. A batch is reduced to one row for each digest (partial
aggregation, so a text that fills a third of the corpus is counted map-side), set against the index by a sort-merge
anti-join that leaves the index unshuffled, and the digests that are new are appended, with the batch's name. A batch
takes no notice of its own earlier rows, so one that is run again, after a failure at whatever point, keeps the same
rows and adds nothing twice. Where two batches that ran at once have both added a digest, the one of the least name has it.
``compact`` makes one sorted file of the many that appends leave in a bucket.

Groups of ``HOT`` rows or more, of which there can only be so many, are joined to their rows by broadcast while their
counted rows are few, so that no task gets a frequent text's rows together.

Defined cases: a null text counts as the empty text; rows without an id take part and lose to any row with one;
repeated rows (same id and text) are all returned; an empty batch gives no rows; further columns are ignored here and kept,
whatever their names, by ``keep_first_copies``; texts of any length count whole.
"""

from __future__ import annotations

import re
import string
import uuid
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .linking import small_side
from .scratch import materialise, new_path

#: Rows of one text from which on they are told apart from the others before the join.
HOT = 1000


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone. ``lower`` does just that where every character is ASCII, and is many times faster."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def text_digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text after A-Z are lower-cased; null counts as empty."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256))


class DigestIndex:
    """A folder of rows ``(digest, keep_id, batch)`` bucketed and sorted by digest, one for each text ever kept.

    Within the folder each version has a folder of its own, whose name tells its number and its buckets; the last one
    counts. Sessions know it as a table without owning its files.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = (path or new_path(spark, "digest-index")).rstrip("/")
        self._place = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._place.getFileSystem(spark._jsc.hadoopConfiguration())
        known = self._versions()
        self.version, self.buckets = max(known) if known else (0, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.table = self._registered(self._folder(self.version, self.buckets))

    def _versions(self) -> list[tuple[int, int]]:
        """Number and buckets of every version that is complete."""
        names = [f.getPath().getName() for f in self._files.listStatus(self._place)] if self._files.exists(self._place) else []
        return [(int(m[1]), int(m[2])) for m in (re.fullmatch(r"v(\d+)-(\d+)", n) for n in names) if m]

    def _folder(self, version: int, buckets: int) -> str:
        return f"{self.path}/v{version}-{buckets}"

    def _registered(self, folder: str) -> str:
        """The session's name of the table in a folder, which is made if it isn't there."""
        name = f"digest_index_{md5(folder.encode()).hexdigest()}"
        self._files.mkdirs(self.spark._jvm.org.apache.hadoop.fs.Path(folder))
        buckets = int(folder.rpartition("-")[2])
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{folder}'")
        self.spark.catalog.refreshTable(name)  # another session may have added to it
        return name

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def resolved(self, groups: DataFrame, batch: str) -> DataFrame:
        """The groups with ``is_new``, and ``keep_id`` as the index has it for those that aren't: digests of other
        batches are known, those of this batch are new and ``added`` already."""
        first = F.min(F.struct("batch", "keep_id"))["keep_id"].alias("known_id")  # buckets hold their digests whole
        other = self.read().where(F.col("batch") != batch).groupBy("digest").agg(first)
        own = self.read().where(F.col("batch") == batch).select("digest", F.lit(True).alias("added")).distinct()
        fresh = groups.join(other.hint("merge"), "digest", "left_anti").join(own.hint("merge"), "digest", "left")
        told = fresh.select("digest", "keep_id", "group_size", F.lit(True).alias("is_new"), F.coalesce("added", F.lit(False)).alias("added"))
        old = groups.join(other.hint("merge"), "digest").select("digest", F.col("known_id").alias("keep_id"), "group_size", F.lit(False).alias("is_new"), F.lit(True).alias("added"))
        return told.unionByName(old)

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add ``(digest, keep_id)`` rows: one file for each bucket, since rows are dealt out as buckets are."""
        groups.select("digest", "keep_id", F.lit(batch).alias("batch")).repartition(self.buckets, "digest").write.insertInto(self.table)

    def compact(self, buckets: int | None = None) -> None:
        """Write a new version, one sorted file for each bucket, of which there may be another number. It is written aside and
        gets its name when it is complete; the versions before it go after that."""
        buckets, old = buckets or self.buckets, self._versions()
        aside = self._registered(f"{self.path}/aside-{uuid.uuid4().hex}-{buckets}")
        self.read().repartition(buckets, "digest").write.insertInto(aside)
        place = lambda x: self.spark._jvm.org.apache.hadoop.fs.Path(x)
        written = self.spark.sql(f"DESCRIBE FORMATTED {aside}").where("col_name = 'Location'").head()["data_type"]
        self.spark.sql(f"DROP TABLE {aside}")
        version = self.version + 1
        if not self._files.rename(place(written), place(self._folder(version, buckets))):
            raise OSError(f"can't name version {version} of {self.path}")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        self.version, self.buckets = version, buckets
        self.table = self._registered(self._folder(version, buckets))
        for v in old:
            self._files.delete(place(self._folder(*v)), True)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        self._files.delete(self._place, True)


def deduplicate(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
    """Deduplicate a batch within itself and against ``index``; append what is new.

    Returns ``id_col, keep_id, group_size, kept, digest`` for every row. Among equal texts of the batch the largest
    id stands, unless the index has the text already, in which case the indexed id does and no row is kept.
    ``group_size`` counts rows of this batch. ``batch`` names it: a batch that failed is run again under its name.
    """
    batch = batch or uuid.uuid4().hex
    rows = materialise(docs.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest")), "digests")
    # Written before they are joined, as Spark would otherwise join first and gather a frequent text's rows in one task.
    groups = materialise(rows.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "digest-groups")
    resolved = materialise(index.resolved(groups, batch), "digests-resolved")
    index.append(resolved.where("NOT added"), batch)
    kept = F.col("is_new") & F.col("id").eqNullSafe(F.col("keep_id"))
    return with_groups(rows, resolved).select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "digest")


def with_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with the columns of their group, by ``digest``; every row has one. Large groups are joined first."""
    hot = groups.where(F.col("group_size") >= HOT)
    rest = [c for c in groups.columns if c != "digest"]
    tried = materialise(rows.join(small_side(materialise(hot.withColumn("hot", F.lit(True)), "hot-digests"), 128), "digest", "left"), "digests-tried")
    cold = tried.where("hot IS NULL").select(*rows.columns)
    return tried.where("hot").select(*rows.columns, *rest).unionByName(cold.join(groups.where(F.col("group_size") < HOT).hint("merge"), "digest").select(*rows.columns, *rest))


def deduplicate_in_batches(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batches: int = 2) -> DataFrame:
    """As ``deduplicate``, a range of ids after the other, the greatest first, so that of all equal texts the largest id
    stays; ``group_size`` counts the rows of all batches."""
    ends = docs.agg(F.min(id_col).alias("a"), F.max(id_col).alias("b")).head()
    c = F.col
    cuts = [] if ends["a"] is None else sorted({ends["a"] + (ends["b"] - ends["a"] + 1) * k // batches for k in range(1, batches)}, reverse=True)
    parts, above = [], None
    for cut in [*cuts, None]:  # rows without an id come last
        part = docs if cut is None else docs.where(c(id_col) >= cut)
        parts.append(part if above is None else part.where((c(id_col) < above) | c(id_col).isNull()))
        above = cut
    found = None
    for k, part in enumerate(parts):
        told = materialise(deduplicate(part, index, id_col, text_col, f"{k:06d}-{uuid.uuid4().hex}"), "batch")
        found = told if found is None else found.unionByName(told)
    # Texts of several batches are counted together.
    sizes = found.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max("group_size").alias("most"))
    several = materialise(sizes.where("group_size <> most").select("digest", c("group_size").alias("whole")), "several")
    joined = found.join(small_side(several, 128), "digest", "left")
    return joined.select(id_col, "keep_id", F.coalesce("whole", "group_size").alias("group_size"), "kept", "digest")


def keep_first_copies(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept; of repeated rows with one id and text one stays."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    winners = deduplicate(docs, index, id_col, text_col, batch).where("kept").select(name.alias("name"), "digest").distinct()
    own = {n: f"c{k}" for k, n in enumerate(docs.columns)}
    # Both steps deal rows out by the same two columns, so texts cross the network once.
    tagged = docs.select(*(F.col(n).alias(c) for n, c in own.items()), name.alias("name"), text_digest(F.col(text_col)).alias("digest"))
    found = tagged.join(materialise(winners, "winners").hint("merge"), ["name", "digest"], "left_semi").dropDuplicates(["name", "digest"])
    return found.select(*(F.col(c).alias(n) for n, c in own.items()))
