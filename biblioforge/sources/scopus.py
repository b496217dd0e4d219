"""Reader of comma-separated bibliographic exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identifiers import record_key_scopus
from ..functions.parsing import address_countries
from ..functions.text import ascii_upper, snake_label
from .csv_rows import read_csv

# Columns folded to upper ASCII, names that change, and the columns kept, in order.
UPPER = (
    "authors", "author_full_names", "title", "source_title", "affiliations", "authors_with_affiliations", "abstract", "author_keywords",
    "index_keywords", "references", "editors", "publisher", "sponsors", "conference_name", "conference_date", "conference_location",
    "language_of_original_document", "abbreviated_source_title", "document_type", "publication_stage", "open_access", "source",
)
RENAMED = {
    "authors": "author", "art_no": "article_number", "art__no": "article_number", "language_of_original_document": "language",
    "open_access": "open_access_indicator", "source_title": "journal",
}
KEPT = (
    "author author_full_names authors_id title year journal source_title volume issue article_number page_start page_end page_count cited_by "
    "doi affiliations country authors_with_affiliations abstract author_keywords index_keywords funding_texts references editors publisher "
    "sponsors conference_name conference_date conference_location conference_code issn isbn coden pubmed_id language document_type "
    "publication_stage open_access_indicator source eid molecular_sequence_numbers link chemicals_cas tradenames manufacturers SR"
).split()


def normalise_scopus(raw: DataFrame, abbreviations: DataFrame | None = None) -> DataFrame:
    """A raw export (rows numbered as they come if it has no seq) -> seq, KEPT (those that exist) and ismainarticle. abbreviations: (journal, source_title) of matched journals, the least
    of several."""
    df = raw.toDF(*[snake_label(c) for c in raw.columns])
    df = df.select(*[ascii_upper(c, strip=False).alias(c) if c in UPPER or c.startswith("funding_text") else F.col(c) for c in df.columns])
    df = df.drop("abbreviated_source_title").withColumnsRenamed({a: b for a, b in RENAMED.items() if a in df.columns})
    if "seq" not in df.columns:
        df = df.withColumn("seq", F.monotonically_increasing_id())
    if abbreviations is not None:
        df = df.join(abbreviations.groupBy("journal").agg(F.min("source_title").alias("source_title")), "journal", "left")
    else:
        df = df.withColumn("source_title", F.lit(None).cast("string"))
    df = df.withColumn("source_title", F.coalesce(F.replace(F.trim("source_title"), F.lit("."), F.lit("")), F.lit("")))
    for needed in ("author_full_names", "year", "affiliations"):
        if needed not in df.columns:
            df = df.withColumn(needed, F.lit(None).cast("string"))
    df = df.withColumn("SR", record_key_scopus("author_full_names", "year", "source_title"))
    df = df.withColumn("country", F.array_join(address_countries("affiliations"), "; "))
    return df.select("seq", *[c for c in KEPT if c in df.columns]).where(F.coalesce(*[F.col(c) for c in KEPT if c in df.columns and c not in ("SR", "source_title", "country")]).isNotNull()).withColumn("ismainarticle", F.lit(True))


def read_scopus(spark: SparkSession, path: str, abbreviations: DataFrame | None = None) -> DataFrame:
    return normalise_scopus(read_csv(spark, path), abbreviations)
