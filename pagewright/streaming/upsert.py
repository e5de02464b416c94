"""An optional streaming face: landed pages flow through the same sync, one micro-batch at a time.

The engine is a batch engine; this only drives it from a stream of page files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pagewright.operators.sync import run


def sync_stream(pages: DataFrame, read_target: Callable[[], DataFrame], write_target: Callable[[DataFrame], None], as_of, checkpoint: str, site: str = "") -> StreamingQuery:
    """Starts a query that takes all pages (url, status, html) there are and ends. write_target gets the new snapshot."""

    def batch(df: DataFrame, _: int) -> None:
        none = df.sparkSession.createDataFrame([], "url string, categories array<string>")
        write_target(run(df, none, read_target(), as_of, site)["target"])

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
