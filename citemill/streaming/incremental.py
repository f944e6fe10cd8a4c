"""Detection over page files as they arrive. There is no event time and so no watermark; citations already saved are skipped."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.detect import detect
from ..sources.sinks import Table, save_citations

PAGES = "psmid string, pageid string, ocrtext string"


def detect_stream(spark: SparkSession, pages: str, table: Table, checkpoint: str, single_vol_abbrs: list[str] = ()) -> StreamingQuery:
    """Process the Parquet files of pages that haven't been, then stop."""
    return (
        spark.readStream.schema(PAGES)
        .parquet(pages)
        .writeStream.foreachBatch(lambda batch, _: save_citations(table, detect(batch, list(single_vol_abbrs))))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
