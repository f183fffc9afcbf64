"""H9: streaming request scoring.

``readStream`` over request files -> per micro-batch: feature extraction (F10),
names -> indices (P7), Bayes scoring (H1), CR step (H3) -> one output folder per
epoch. A batch is scored with the version of the model that is current when it starts; the
model is loaded again only when the version has changed (``sinks.versions``), and a version
published meanwhile takes effect with the next batch. The job is stateless, so no watermark is needed;
each epoch overwrites its own folder, so a batch replayed after a failure writes
the same result again (idempotent sink).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from goalcast.sinks.versions import Versioned


def start_scoring_stream(spark: SparkSession, source_path: str, schema, score_batch: Callable[[DataFrame, Any], DataFrame],
                         model: Versioned, sink_path: str, checkpoint_path: str, max_files_per_trigger: int = 8):
    """``score_batch(batch, value of the current model version)`` for every batch."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_path)

    def run(batch: DataFrame, epoch_id: int) -> None:
        score_batch(batch, model.get()).write.mode("overwrite").parquet(f"{sink_path}/epoch={epoch_id}")

    return (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True).start())


def run_to_completion(query) -> None:
    """Wait until the available input is scored, however long that takes; a failure of
    the stream is raised."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def read_sink(spark: SparkSession, sink_path: str) -> DataFrame:
    return spark.read.parquet(sink_path).drop("epoch")
