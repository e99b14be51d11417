"""Incremental upsert of arriving raw batches with Structured Streaming.

New JSON-lines files in a landing folder are read with an explicit schema;
every micro-batch is audited (the same one-pass audit as the batch pipeline),
its valid rows are cleaned and merged into the current warehouse version, and
the result is published.  The streaming checkpoint lives under the session's
``spark.checkpoint.dir``; together with the key-based upsert a replayed
micro-batch after a failure leaves the same table content (idempotent sink).

Rejected rows of each micro-batch go to their own ``epoch=<id>`` folder of the
quarantine (overwritten if the epoch is replayed).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from terrace.operators.clean import clean_clubs, clean_matches, clean_players
from terrace.operators.quality import RECORD_INDEX, audit_spec
from terrace.schemas import CLEAN_COLUMNS, RAW_SCHEMAS, league_audit_specs
from terrace.session import ensure_checkpoint_dir
from terrace.sources.sinks import stamp_record_index
from terrace.sources.warehouse import Warehouse

_CLEANERS = {"clubs": clean_clubs, "players": clean_players, "matches": clean_matches}


def micro_batch_upsert(dataset: str, warehouse: Warehouse, quarantine: str | None = None):
    """The foreachBatch function for one dataset."""
    def fn(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        # pinned once: all reads of the micro-batch see the same record index
        raw = stamp_record_index(batch.drop("_ingested_at", "_source", RECORD_INDEX)).persist()
        spec = league_audit_specs({n: raw.columns if n == dataset else [] for n in
                                   ("clubs", "players", "matches", "standings")})[dataset]
        res = audit_spec(raw, spec)
        try:
            if quarantine:
                # one folder per epoch, overwritten on replay: idempotent
                res.rejected.write.mode("overwrite") \
                    .parquet(f"{quarantine}/{dataset}/epoch={epoch_id}")
            clean = _CLEANERS[dataset](res.valid, checks="eager").select(*CLEAN_COLUMNS[dataset])
            warehouse.publish_upserts({dataset: clean})  # touched buckets only
        finally:
            res.unpersist()
            raw.unpersist()
    return fn


def start_incremental_load(spark: SparkSession, landing: str, dataset: str, warehouse: Warehouse,
                           quarantine: str | None = None, available_now: bool = True,
                           max_files_per_trigger: int | None = None, name: str | None = None):
    """Start the stream; ``available_now`` processes what has landed, then stops.

    The checkpoint folder bears ``name``, or else a digest of dataset and landing folder: a restart, also in
    another process, goes on where the stream stopped."""
    name = name or f"{dataset}-{hashlib.sha256(landing.rstrip('/').encode()).hexdigest()[:16]}"
    ckpt = ensure_checkpoint_dir(spark).rstrip("/")
    reader = spark.readStream.schema(RAW_SCHEMAS[dataset])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(landing)
    w = (stream.writeStream.foreachBatch(micro_batch_upsert(dataset, warehouse, quarantine))
         .option("checkpointLocation", f"{ckpt}/stream-{name}"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
