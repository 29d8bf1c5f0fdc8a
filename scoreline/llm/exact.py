"""Exact deduplication against a persistent index of digests.

The index is a Parquet table bucketed and sorted by digest. A batch is first
reduced to one row per digest (combined before the shuffle, so that a text with a
third of all copies costs a few rows per task), those rows are anti-joined with
the index by sort-merge, and what is new is appended in the same buckets. The
verdicts go back to the rows by a second join, whose skewed partitions adaptive
execution splits because both of its sides are ordinary shuffles.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, settle, workspace


_BUCKETS = "_buckets_"


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z in lower case; NULL counts as empty."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


class DigestIndex:
    """Digests of all texts accepted so far, kept in a folder that outlives the session.

    ``buckets`` is fixed when the folder is first used and stored there; choose it so
    that one bucket of the final index fits a task. The default is the stored number, or
    for a new folder the number of shuffle partitions of the session. Another number
    than the stored one is an error, as is a folder with files and no number.

    Every row carries the batch that brought it. One writer at a time may append.
    Each append adds a file per bucket, and a bucket of several files is sorted again
    when it is read: ``compact`` after some ten appends.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None) -> None:
        self.spark = spark
        self.buckets = self._stored(folder.rstrip("/"), buckets)
        self.name = "digests_" + hashlib.md5(folder.rstrip("/").encode()).hexdigest()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, keep_id BIGINT, group_size BIGINT, batch STRING) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{folder.rstrip('/')}'")

    def _stored(self, folder: str, wished: int | None) -> int:
        """The number of buckets, kept as the name of an empty file that readers of the table pass over."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in files.listStatus(path(folder))] if files.exists(path(folder)) else []
        stored = {int(n.removeprefix(_BUCKETS)) for n in names if n.startswith(_BUCKETS)}
        if len(stored) > 1 or not stored and any(n.endswith(".parquet") for n in names):
            raise ValueError(f"{folder} does not tell its number of buckets")
        if not stored:
            stored = {wished or int(self.spark.conf.get("spark.sql.shuffle.partitions"))}
            files.mkdirs(path(folder))
            files.createNewFile(path(f"{folder}/{_BUCKETS}{min(stored)}"))
        if wished and wished not in stored:
            raise ValueError(f"{folder} has {min(stored)} buckets, not {wished}")
        return min(stored)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame, batch: str | None = None) -> DataFrame:
        """The rows of ``groups`` (one per digest) whose digest the index lacks, or has from ``batch`` alone."""
        others = self.table() if batch is None else self.table().where(F.col("batch") != batch)
        return groups.join(others.select("digest").hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add those rows (digest, keep_id, group_size) that ``batch`` has not added yet; each bucket is written by one task."""
        # The files of other batches are passed over by their bounds.
        own = self.table().where(F.col("batch") == batch).select("digest").hint("merge")
        rows = groups.select("digest", "keep_id", "group_size", F.lit(batch).alias("batch")).join(own, "digest", "left_anti")
        rows.repartition(self.buckets, "digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def compact(self, folder: str) -> DigestIndex:
        """The same index in a new folder, with one sorted file per bucket; this one stays as it is."""
        made = DigestIndex(self.spark, folder, self.buckets)
        if made.table().limit(1).count():
            raise ValueError(f"{folder} is in use")
        self.table().repartition(self.buckets, "digest").write.insertInto(made.name)
        self.spark.catalog.refreshTable(made.name)
        return made

    def close(self) -> None:
        """Take the table out of the session's catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def deduplicate(docs: DataFrame, index: DigestIndex, key: str = "doc_id", text: str = "text", batch: str | None = None) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256, known.

    Equal texts (after lower-casing A-Z only; NULL is empty) form a group. Its row
    with the largest key stays unless another batch brought the digest (``known``);
    then none stays. Of repeated rows with one key a single one stays; a NULL key is
    smaller than any other. Columns besides key and text are not read. An empty
    input gives no rows and leaves the index as it is.

    ``batch`` names the rows of ``docs``. A job that died, whether before or after it
    added to the index, is run again under the same name and keeps what it would have
    kept. Without a name every call is a batch of its own.
    """
    batch = batch or uuid.uuid4().hex
    rows = settle(docs.select(F.col(key).alias("id"), text_digest(F.col(text)).alias("digest"),
                              F.monotonically_increasing_id().alias("row")), "digests")
    groups = rows.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    groups = settle(groups.select("digest", F.col("keep.id").alias("keep_id"), F.col("keep.row").alias("keep_row"), "group_size"), "groups")
    unseen = settle(index.unseen(groups, batch), "unseen")
    index.append(unseen, batch)
    verdicts = groups.join(unseen.select("digest", F.lit(False).alias("known")), "digest", "left")
    return rows.join(verdicts.hint("merge"), "digest").select(
        F.col("id").alias(key), "keep_id", "group_size",
        ((F.col("row") == F.col("keep_row")) & F.col("known").isNotNull()).alias("kept"),
        F.col("digest").alias("text_sha256"), F.col("known").isNull().alias("known"))


def op5_exact_dedup(docs: DataFrame) -> DataFrame:
    """All documents against a fresh index in the shared folder."""
    index = DigestIndex(docs.sparkSession, workspace(docs.sparkSession, "digest-index"))
    found = deduplicate(docs, index).drop("known")
    index.close()
    return found


OP5_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""
