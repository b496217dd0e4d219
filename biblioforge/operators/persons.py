"""Persons: one identity per author row by a priority cascade, unique attachment of nameless ids, rollup and conflicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import name_key, normalize_orcid, scopus_author_id, short_openalex
from ..functions.text import blank_to_null
from ..lineage import cut
from .relational import conflicts, distinct_concat, unique_attach, union_by_name


def person_ids(authors: DataFrame) -> DataFrame:
    """authors with PersonID: the first of ORCID, OpenAlex id, Scopus id, name key and e-mail, name key, the row's own id.

    Each step groups only rows that no earlier one claimed, on its own key, so the cascade is one coalesce per row."""
    email, key = blank_to_null(F.lower(F.trim("Email"))), name_key(F.coalesce(blank_to_null("AuthorFullName"), F.col("AuthorName")))
    scopus = F.col("scopus_author_id") if "scopus_author_id" in authors.columns else F.col("AuthorID")
    tag = lambda prefix, c: F.concat(F.lit(prefix), c)  # noqa: E731  NULL if c is
    out = authors.withColumns({"_orcid": normalize_orcid("Orcid"), "_oa": short_openalex("OpenAlexAuthorID"), "_email": email, "_key": key})
    return out.withColumn(
        "PersonID",
        F.coalesce(
            tag("ORCID:", F.col("_orcid")), tag("OA:", F.col("_oa")), tag("SCOPUS:", scopus_author_id(scopus)),
            F.concat(F.lit("NAMEEMAIL:"), F.col("_key"), F.lit("|"), F.col("_email")), tag("NAME:", F.col("_key")),
            tag("ROW:", F.coalesce("AuthorID", F.lit(""))),  # nothing to know them by: a person for each id
        ),
    )


def consolidate(authors: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(AuthorPerson, AuthorAlias, AuthorConflicts)."""
    a = cut(person_ids(authors))
    kind = F.substring_index("PersonID", ":", 1)
    # rows known by name alone join the only person with an ORCID, else an OpenAlex id, of that name; e-mail rows the only ORCID person
    a = unique_attach(a, "_key", "PersonID", kind == "NAME", kind == "ORCID")
    a = unique_attach(a, "_key", "PersonID", kind == "NAME", kind == "OA")
    a = a.withColumn("_ke", F.concat_ws("|", "_key", F.when(F.col("_email").isNotNull(), F.col("_email"))))
    a = unique_attach(a, "_ke", "PersonID", kind == "NAMEEMAIL", (kind == "ORCID") & F.col("_email").isNotNull())
    a = cut(a)
    alias = a.select("PersonID", "AuthorID", "AuthorFullName", "AuthorName", "Orcid", "Email", "OpenAlexAuthorID").distinct()
    person = a.groupBy("PersonID").agg(
        F.max_by("AuthorFullName", F.struct(F.length("AuthorFullName").alias("l"), F.col("AuthorFullName").alias("n"))).alias("CanonicalName"),
        F.min("_orcid").alias("Orcid"), distinct_concat("_oa").alias("OpenAlexIDs"), distinct_concat("AuthorID").alias("AuthorIDs"),
        distinct_concat("_email").alias("Emails"), distinct_concat("AuthorFullName").alias("NameVariants"), F.count(F.lit(1)).alias("AliasCount"),
    )
    by_oa = conflicts(a, "_oa", "_orcid", "openalex_id").where("_oa IS NOT NULL").select("type", F.col("_oa").alias("key"), F.col("_orcids").alias("orcids"))
    by_name = conflicts(a.where("_email IS NOT NULL AND _key IS NOT NULL"), "_ke", "_orcid", "name_email").select("type", F.col("_ke").alias("key"), F.col("_orcids").alias("orcids"))
    return person, alias, union_by_name(by_oa, by_name)


def attach_person(df: DataFrame, alias: DataFrame) -> DataFrame:
    """PersonID onto any table with AuthorID; the least one where an AuthorID has several."""
    return df.join(alias.groupBy("AuthorID").agg(F.min("PersonID").alias("PersonID")), "AuthorID", "left")
