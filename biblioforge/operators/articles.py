"""The Article entity of either source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import normalize_doi, valid_doi
from .relational import keep_first_or_unkeyed, project, require

# Columns of the two Article tables.
WOS_ARTICLE = (
    "SR title author author_full_names orcid abstract article_number year document_type language journal source_title country doi page_start "
    "page_end early_access_date author_keywords index_keywords web_of_science_categories subject_category document_delivery_number "
    "funding_agency funding_details ismainarticle cited_by open_access_indicator cited_reference_count usage_count_last_180_days "
    "usage_count_since_2013 accession_number"
).split()
SCOPUS_ARTICLE = (
    "SR title author author_full_names authors_id authors_with_affiliations affiliations orcid abstract article_number year document_type "
    "publication_stage language journal source_title country doi page_start page_end page_count author_keywords index_keywords issn isbn coden "
    "source publisher references chemicals_cas molecular_sequence_numbers funding_texts editors sponsors conference_name conference_date "
    "conference_location conference_code pubmed_id eid link ismainarticle cited_by open_access_indicator"
).split()


def distinct_by_doi(df: DataFrame, seq: str = "seq") -> DataFrame:
    """The first row of each normalised DOI; rows without a valid DOI all stay."""
    keyed = df.withColumn("_doi", F.when(valid_doi("doi"), normalize_doi("doi")))
    return keep_first_or_unkeyed(keyed, "_doi", seq).drop("_doi")


def wos_articles(df: DataFrame, seq: str = "seq") -> DataFrame:
    return distinct_by_doi(df, seq).select(seq, *[c for c in WOS_ARTICLE if c in df.columns])


def scopus_articles(df: DataFrame, seq: str = "seq", strict: bool = False) -> DataFrame:
    require(df, "doi")
    return project(distinct_by_doi(df, seq), [seq, *SCOPUS_ARTICLE], strict)
