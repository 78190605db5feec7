"""Arriving documents: each micro-batch goes through the batch plan; documents are independent, so there is no state or watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vellum.config import Config
from vellum.plans import pipeline


def canonicalise_stream(docs: DataFrame, out: str, checkpoint: str, config: Config | None = None, **trigger) -> StreamingQuery:
    """docs: a streaming table (doc_id, text, source_format, source_edition, translation_layer). Results of batch n are in
    out/batch=n, overwritten if the batch runs again; the catalog log gets a file for each batch."""

    def one(batch: DataFrame, n: int) -> None:
        results = pipeline.run(batch, config, seq=n)
        results.write(f"{out}/batch={n}")
        results.catalog_entries.write.mode("overwrite").json(f"{out}/catalog/batch={n}")

    return docs.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
