"""Ingestion as a stream: documents arrive as files or messages; chunks, duplicates and states follow.

Three channels exist, each a folder: ``documents`` (new ones), ``rescans`` (the text of a document that changed) and ``retries`` (one
that failed). They are drained together, a bounded number of files a batch; a batch is acknowledged by the stream's checkpoint
when its tables are committed, and one that runs twice changes nothing. Cases: rows without id are dropped; an empty batch writes
nothing; of several rows of one id in a batch the newest counts, ties to the greater content; equal content is stored once, and its
other ids point to it; a blank text fails, and only a retry or rescan tries it again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators import chunking
from graphloom.operators.lifecycle import duplicates
from graphloom.sources.stores import Files, VersionedTable

DOCS = "id string, content string, content_hash string, created_at timestamp, state string, seq long"
MESSAGE = "id string, content string, created_at timestamp"
CHANNELS = ("documents", "rescans", "retries")


def source(spark: SparkSession, path: str, schema: str, kind: str = "parquet", files: int = 16) -> DataFrame:
    """A folder as a stream, a bounded number of files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(kind).load(path)


class Mailbox:
    """The three channels under a folder."""

    def __init__(self, spark: SparkSession, path: str, files: int = 16):
        self.spark, self.path, self.files = spark, path, files
        store = Files(spark, path)
        for c in CHANNELS:
            store.fs.mkdirs(store.at(c))

    def put(self, channel: str, messages: DataFrame) -> None:
        """Messages (id, content, created_at) into a channel; they are seen when their files are whole."""
        if channel not in CHANNELS:
            raise ValueError(f"no channel {channel}")
        store, name = Files(self.spark, self.path), f"m-{uuid.uuid4().hex}"
        messages.select("id", "content", "created_at").write.parquet(f"{self.path}/_{name}")
        for n in store.names(f"_{name}"):
            if n.endswith(".parquet"):
                store.fs.rename(store.at(f"_{name}/{n}"), store.at(f"{channel}/{name}-{n}"))
        store.remove(f"_{name}")

    def stream(self) -> DataFrame:
        """Messages of all channels, with their channel."""
        whole = None
        for c in CHANNELS:
            x = source(self.spark, f"{self.path}/{c}", MESSAGE, files=self.files).withColumn("channel", F.lit(c))
            whole = x if whole is None else whole.unionByName(x)
        return whole


def deduplicated(stream: DataFrame, text: str = "text", late: str | None = None, time: str | None = None) -> DataFrame:
    """The stream with each content once; with a time column the state is dropped after the watermark."""
    hashed = stream.withColumn("content_hash", F.md5(F.col(text)))
    if late and time:
        return hashed.withWatermark(time, late).dropDuplicatesWithinWatermark(["content_hash"])
    return hashed.dropDuplicates(["content_hash"])


class Ingest:
    """Writes each micro-batch of (id, content, created_at, and channel, if it has one) into tables of documents, their chunks, and ids
    that repeat another's content."""

    def __init__(self, spark: SparkSession, path: str, size: int = 400, overlap: int = 50, buckets: int = 64):
        self.docs = VersionedTable(spark, f"{path}/documents", DOCS, buckets=buckets)
        self.chunks = VersionedTable(spark, f"{path}/chunks", "id string, doc_id string, chunk_order_index int, tokens int, content string, seq long", "doc_id", buckets)
        self.copies = VersionedTable(spark, f"{path}/duplicates", "id string, original string, seq long", buckets=buckets)
        self.size, self.overlap = size, overlap

    def batch(self, df: DataFrame, number: int) -> None:
        channel = F.col("channel") if "channel" in df.columns else F.lit("documents")
        rows = df.where("id is not null").groupBy("id").agg(F.max(F.struct("created_at", "content", channel.alias("channel"))).alias("x")).select("id", "x.*")
        rows = rows.select("id", "content", "channel", F.md5("content").alias("content_hash"), "created_at", F.lit(number).cast("long").alias("seq")).persist()
        try:
            if not rows.isEmpty():
                self._write(rows)
        finally:
            rows.unpersist()

    def _write(self, rows: DataFrame) -> None:
        known = self.docs.read()
        # a batch that runs again finds its own rows, which are no duplicates of themselves
        old = known.select("id", F.col("state").alias("had"), F.col("content_hash").alias("had_hash"))
        x = rows.join(old, "id", "left")
        # a retry is for what failed, and a rescan for what changed or is new
        wanted = x.where((F.col("channel") == "documents") | ((F.col("channel") == "retries") & (F.col("had") == "failed")) | ((F.col("channel") == "rescans") & ~F.col("content_hash").eqNullSafe(F.col("had_hash"))))
        other = known.where("state = 'processed' and content_hash is not null").groupBy("content_hash").agg(F.min("id").alias("known"))
        wanted = wanted.join(other, "content_hash", "left")
        stored = wanted.where("known is not null and known <> id").select("id", F.col("known").alias("original"), "seq")
        fresh = wanted.where("known is null or known = id").drop("known", "had", "had_hash")
        again = duplicates(fresh.where("content is not null"), F.col("content_hash"))
        copies = stored.unionByName(again.join(fresh.select("id", "seq"), "id").select("id", "original", "seq"))
        fresh = fresh.join(again.select("id"), "id", "left_anti")
        blank = F.col("content").isNull() | (F.trim("content") == "")
        fresh = fresh.withColumn("state", F.when(blank, "failed").otherwise("processed"))
        windows = chunking.windows(fresh.where("state = 'processed'").select(F.col("id").alias("doc_id"), "content", "seq"), "content", self.size, self.overlap)
        chunks = chunking.chunk_ids(windows).select("id", "doc_id", "chunk_order_index", "tokens", "content", "seq")
        # chunks of a document are replaced as a whole
        ids = fresh.select(F.col("id").alias("doc_id"))
        self.chunks._change(ids, lambda held: held.join(ids, "doc_id", "left_anti").unionByName(chunks))
        self.copies.upsert(copies, "id", "seq")
        self.docs.upsert(fresh.select("id", "content", "content_hash", "created_at", "state", "seq"), "id", "seq")

    def run(self, stream: DataFrame, checkpoint: str):
        """All that is there now, then stop."""
        return stream.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, kind: str, every: str = "5 minutes", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Counts by kind in tumbling windows, or in windows that begin every ``slide``; rows later than the watermark are dropped."""
    return stream.withWatermark(time, late).groupBy(F.window(time, every, slide or every), kind).agg(F.count("*").alias("n"))


def session_counts(stream: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts by key in sessions that end after a gap; a session is given out once the watermark has passed its end."""
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap), key).agg(F.count("*").alias("n"))


def joined(left: DataFrame, right: DataFrame, key: str, time: str, within: str, late: str = "10 minutes") -> DataFrame:
    """Rows of two streams of one key, the right one at the left one's time or within an interval after it. State is dropped when the
    watermarks rule out further partners. Columns of the right side end in ``_r``."""
    a = left.withWatermark(time, late)
    b = right.select(*(F.col(c).alias(f"{c}_r") for c in right.columns)).withWatermark(f"{time}_r", late)
    return a.join(b, F.expr(f"{key} = {key}_r AND {time}_r >= {time} AND {time}_r <= {time} + INTERVAL {within}"))
