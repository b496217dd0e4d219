"""Streams of articles: keep-first by key within a watermark, and edges of cited references, on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import normalize_doi, valid_doi
from ..operators.references import wos_references


def first_by_doi(articles: DataFrame, event_time: str, delay: str = "1 day") -> DataFrame:
    """A stream without later rows of a DOI seen within the delay; rows without a valid DOI all pass. State is bounded by the watermark."""
    keyed = articles.withWatermark(event_time, delay).withColumn("_key", F.coalesce(F.when(valid_doi("doi"), normalize_doi("doi")), F.concat(F.lit("row:"), F.col("seq").cast("string"))))
    return keyed.dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def citation_edges(articles: DataFrame) -> DataFrame:
    """Edges of a stream of articles: stateless, so the same plan runs in batch."""
    return wos_references(articles)[1]
