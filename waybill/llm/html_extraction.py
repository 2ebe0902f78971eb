"""Main text of web pages: every block of a page is labelled with the whole page in view."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from waybill.llm import block_labeller as L
from waybill.llm.html_blocks import leaf_blocks

#: Pages labelled together.
_TOGETHER = 128


def extract(pages: DataFrame, weights: L.Weights | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    text joins the blocks that the labeller takes for the article by line feeds, in page order, each with references decoded and white space as single
    spaces; an empty text if there are none. Null and empty html give that too; null ids and urls stay, repeated rows get equal results, other
    columns are ignored, an empty table gives no rows. weights: of a labeller, by default the one trained on made pages.
    """
    spark = pages.sparkSession
    # A few tens of thousands of numbers, whatever the input.
    held = spark.sparkContext.broadcast(weights or L.trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _TOGETHER):
                part = batch.slice(lo, _TOGETHER)
                found = [leaf_blocks(v.as_py() or "") for v in part.column("html")]
                scored = L.scores(held.value, [L.vectors(b) for b in found])
                texts = ["\n".join(b.text for b, s in zip(page, own) if s > 0.5) for page, own in zip(found, scored)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
                )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
