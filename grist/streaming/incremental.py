"""Structured Streaming paths (V1-V3): curation of newly arriving files.

As streaming plans, with state that Spark keeps and restores:

* V1 :func:`start_outcomes` — the funnel is narrow, so it runs on the stream
  itself; the file sink's own log makes its output exactly-once;
* V2 :func:`start_stage_counts` — a streaming aggregate (complete mode) over the
  outcomes: one state row an outcome;
* V3 :func:`start_keyed_dedup` — ``transformWithState`` by bucket: a batch reads
  and writes the state of its own buckets only, whatever came before.

The older ones run the batch plan through ``foreachBatch``: each micro-batch has models that are trained or loaded once. Exactly-once comes from the query checkpoint
plus idempotent writes: batch ``b`` always (over)writes the folder
``batch=b``, so a replayed batch replaces its own output.

* V1 :func:`start_curation` — kept records of every batch;
* V2 the same call writes per-batch stage counts; :func:`running_stats`
  sums them (the reference's ``Counter`` merge);
* V3 :func:`start_fuzzy_dedup` — new documents are checked against the
  bucket table of everything kept so far (a join on ``(band, key)``), and
  against each other (bucket minimum, as in the batch operator); the
  survivors' buckets are appended. First arrival wins across batches.

Drop-all exact dedup (A2/A3) cannot stream: a later copy would retract an
already emitted row. It stays batch only.
"""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from grist.operators import components as CC
from grist.operators import minhash, skew
from grist.plans import curate as X
from grist.session import cut_lineage


def _batch_path(root: str, batch_id: int) -> str:
    return os.path.join(root, f"batch={batch_id}")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, on whatever file system its path names."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def stream_documents(spark: SparkSession, path: str, schema, max_files: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
            .parquet(path))


def outcomes(documents: DataFrame, heads: X.Heads, id_col: str = "doc_id") -> DataFrame:
    """(id, outcome, text): what the funnel did with each record; the text (masked) of those that it kept."""
    f = X.funnel(documents, heads)
    return f.select(id_col, F.coalesce("drop_reason", F.lit("kept")).alias("outcome"),
                    F.when(F.col("drop_reason").isNull(), F.col("masked")).alias("text"))


def _started(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()


def start_outcomes(stream: DataFrame, heads: X.Heads, out_dir: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """V1: every arriving record's :func:`outcomes`, appended to a Parquet folder."""
    return _started(outcomes(stream, heads).writeStream.format("parquet").option("path", out_dir), checkpoint, available_now)


def start_stage_counts(spark: SparkSession, outcomes_dir: str, stats_dir: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """V2: records by outcome, kept as running state; ``stats_dir`` always holds the totals so far."""
    schema = spark.read.parquet(outcomes_dir).schema
    counts = spark.readStream.schema(schema).parquet(outcomes_dir).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(stats_dir)        # one row an outcome

    return _started(counts.writeStream.outputMode("complete").foreachBatch(replace), checkpoint, available_now)


class _Bucket(StatefulProcessor):
    """Per bucket the id that came first; every document that comes is linked to it."""

    def __init__(self, id_type: str):
        self.id_type = id_type

    def init(self, handle) -> None:
        self.first = handle.getValueState("first", f"id {self.id_type}")

    def handleInputRows(self, key, rows, timerValues):
        first = self.first.get()[0] if self.first.exists() else None
        earlier = first is not None
        for part in rows:
            if first is None:
                first = part["id"].min()
                first = first.item() if hasattr(first, "item") else first
                self.first.update((first,))
            yield pd.DataFrame({"id": part["id"], "first": first, "earlier": earlier})

    def close(self) -> None:
        pass


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def bucket_links(stream: DataFrame, params: minhash.MinHashParams, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, first, earlier) for each document and bucket of a stream: the bucket's
    first document, and whether that came in an earlier batch. Documents without
    a shingle have one row that links them to themselves."""
    # one narrow pass: a grouped signature would be state of its own
    sets = minhash.shingle_sets(stream, id_col, text_col, params.ngrams)
    signed = minhash._signatures_arrow(sets, id_col, minhash.hash_coefficients(params.num_hashes, params.seed))
    bands = minhash.lsh_bands(signed, params, id_col).select(
        F.col(id_col).alias("id"), F.concat_ws(":", F.col("band"), F.concat_ws(":", F.col("key").cast("array<string>"))).alias("bucket"))
    kind = stream.schema[id_col].dataType.simpleString()
    linked = bands.groupBy("bucket").transformWithStateInPandas(
        _Bucket(kind), f"id {kind}, first {kind}, earlier boolean", "Update", "None")
    alone = sets.filter(F.coalesce(F.size("shingles"), F.lit(0)) <= 0).select(
        F.col(id_col).alias("id"), F.col(id_col).alias("first"), F.lit(False).alias("earlier"))
    return linked.unionByName(alone)


def start_keyed_dedup(stream: DataFrame, params: minhash.MinHashParams, out_dir: str, checkpoint: str,
                      id_col: str = "doc_id", text_col: str = "text", available_now: bool = True) -> StreamingQuery:
    """V3: ids of the documents that stay, a folder a batch. A document goes if it
    shares a bucket with one of an earlier batch (kept or not), or if its
    component within its own batch does or has a smaller id. The state is one id a
    bucket; of earlier batches only the batch's own buckets are read."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)

    def run(batch: DataFrame, batch_id: int) -> None:
        links = cut_lineage(batch)
        edges = links.filter((F.col("id") != F.col("first")) & ~F.col("earlier")).select(F.col("first").alias("src"), F.col("id").alias("dst"))
        component = CC.connected_components(edges)
        own = links.groupBy("id").agg(F.max("earlier").alias("earlier")).join(component.withColumnRenamed("vertex", "id"), "id", "left")
        grouped = own.withColumn("component", F.coalesce("component", "id"))
        met = grouped.filter("earlier").select("component").distinct()
        stay = grouped.filter(F.col("id") == F.col("component")).join(met, "component", "left_anti")
        stay.select(F.col("id").alias(id_col)).write.mode("overwrite").parquet(_batch_path(out_dir, batch_id))

    writer = bucket_links(stream, params, id_col, text_col).writeStream.outputMode("update").foreachBatch(run)
    return _started(writer, checkpoint, available_now)


def start_curation(stream: DataFrame, heads: X.Heads, out_dir: str, stats_dir: str,
                   checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """V1 + V2: funnel every micro-batch; kept rows and stage counts per batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        done = cut_lineage(outcomes(batch, heads))          # read twice: written once
        (done.filter("outcome = 'kept'").drop("outcome").write.mode("overwrite").parquet(_batch_path(out_dir, batch_id)))
        stats = done.groupBy("outcome").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
        stats.write.mode("overwrite").parquet(_batch_path(stats_dir, batch_id))

    return _started(stream.writeStream.foreachBatch(run), checkpoint, available_now)


def running_stats(spark: SparkSession, stats_dir: str) -> DataFrame:
    """V2: stage counts summed over all finished batches."""
    return spark.read.parquet(stats_dir).groupBy("outcome").agg(F.sum("n").alias("n"))


def start_fuzzy_dedup(stream: DataFrame, params: minhash.MinHashParams, out_dir: str,
                      bands_dir: str, checkpoint: str, id_col: str = "doc_id",
                      text_col: str = "text") -> StreamingQuery:
    """V3: incremental near-duplicate removal against all earlier survivors."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bands = cut_lineage(minhash.lsh_bands(minhash.signatures(batch, params, id_col, text_col),
                                              params, id_col))
        if _exists(spark, bands_dir):
            seen = spark.read.parquet(bands_dir).filter(F.col("batch") < batch_id).select("band", "key").distinct()
            hit = cut_lineage(skew.split_join(bands, seen, ["band", "key"], "left_semi").select(id_col).distinct())
        else:       # no earlier batch; any other failure to read is an error
            hit = bands.limit(0).select(id_col)
        fresh = bands.join(hit, id_col, "left_anti")
        edges = minhash.bucket_edges(fresh, id_col)
        comp = CC.connected_components(edges)
        inner_dup = comp.filter(F.col("vertex") != F.col("component")).select(
            F.col("vertex").alias(id_col))
        kept = batch.join(hit, id_col, "left_anti").join(inner_dup, id_col, "left_anti")
        kept.write.mode("overwrite").parquet(_batch_path(out_dir, batch_id))
        # the folder name batch=<id> becomes the ``batch`` column on read
        (fresh.join(kept.select(id_col), id_col, "left_semi").select("band", "key")
         .write.mode("overwrite").parquet(_batch_path(bands_dir, batch_id)))

    return (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
