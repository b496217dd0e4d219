"""Cited references: exploding, parsing, citation edges, enrichment from a works snapshot, union with main articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import normalize_doi, reference_key, valid_doi
from ..functions.parsing import reference_author, reference_doi, reference_journal, reference_year, scopus_reference, scopus_reference_fields, work_columns
from ..functions.text import ascii_upper, blank_to_null, upper_strings
from .relational import explode_list, keep_first, prefer, require, union_by_name

# Kinds of works that are not articles.
BOOK_TYPES = ("book", "edited-book", "monograph", "reference-book", "book-section", "reference-entry")


def wos_references(df: DataFrame, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(references, citation edges): one row per cited reference with author, year, journal, doi, SR_ref; edges (SR, SR_ref)."""
    require(df, "SR", "references")
    refs = explode_list(df.select(seq, "SR", "references"), "references", "CR_ref", "; ", position="position")
    refs = refs.select(
        seq, "position", "SR", "CR_ref", reference_author("CR_ref").alias("author"), reference_year("CR_ref").alias("year"),
        reference_journal("CR_ref").alias("journal"), reference_doi("CR_ref").alias("doi"),
    )
    # concat_ws drops missing parts; a reference without any part gives no edge
    refs = refs.withColumn("SR_ref", blank_to_null(F.concat_ws(", ", "author", "year", "journal")))
    return refs, refs.where("SR_ref IS NOT NULL").select("SR", "SR_ref")


def scopus_references(df: DataFrame, separator: str = ";", column: str = "references") -> DataFrame:
    """References with a bracketed year, by the grammar of functions.parsing.scopus_reference."""
    refs = explode_list(df, column, "CR_ref", separator)
    return refs.select(*[c for c in df.columns if c != column], *[v.alias(k if k != "year" else "ref_year") for k, v in scopus_reference("CR_ref").items()])


def scopus_reference_table(df: DataFrame, countries: list[str], column: str = "references") -> DataFrame:
    """References that begin with 'SURNAME A.B.' parts; rows without authors or title are dropped."""
    refs = explode_list(df.select("SR", column), column, "reference", ";")
    return refs.select("SR", "reference", *[v.alias(k) for k, v in scopus_reference_fields("reference", countries).items()]).where("author IS NOT NULL AND title IS NOT NULL")


def scopus_citations(df: DataFrame) -> DataFrame:
    """(SR, SR_ref) edges, each once, without missing references."""
    require(df, "SR_original", "SR_ref")
    return df.select(F.col("SR_original").alias("SR"), "SR_ref").where("SR_ref IS NOT NULL").distinct()


def enrich_with_works(df: DataFrame, works: DataFrame, replace: bool = True) -> DataFrame:
    """Author names, ORCIDs (by position) and ids of the work with the same DOI; rows without a match stay as they are."""
    require(df, "doi")
    c = work_columns()
    slim = works.where("doi_norm IS NOT NULL").groupBy("doi_norm").agg(F.min_by(F.struct("*"), "work_id").alias("w"))
    c = work_columns("w")
    slim = slim.select("doi_norm", c["authors"].alias("_names"), c["orcid"].alias("_orcid"), c["author_id_openalex"].alias("_ids"), F.col("w.work_id").alias("openalex_work_id"))
    out = df.withColumn("doi_norm", normalize_doi("doi")).join(slim, "doi_norm", "left")
    names = F.transform(F.split("_names", "; "), lambda n: ascii_upper(n))
    orcid = F.array_join(F.transform("_orcid", lambda o: F.coalesce(o, F.lit("NO ORCID"))), "; ")
    fresh = {"author_full_names": F.array_join(names, "; "), "orcid": orcid, "author_id_openalex": F.array_join(F.transform("_ids", lambda i: F.coalesce(i, F.lit(""))), "; ")}
    for name, value in fresh.items():
        own = F.col(name) if name in df.columns else F.lit(None).cast("string")
        out = out.withColumn(name, F.coalesce(value, own) if replace else F.coalesce(blank_to_null(own), value))
    return out.drop("_names", "_orcid", "_ids", "doi_norm")


def enrich_references(refs: DataFrame, works: DataFrame) -> DataFrame:
    """References with a work's title, authors, affiliations (a list per author) and abstract where their DOI has one."""
    c = work_columns("w")
    slim = works.where("doi_norm IS NOT NULL").groupBy("doi_norm").agg(F.min_by(F.struct("*"), "work_id").alias("w"))
    slim = slim.select("doi_norm", *[c[k].alias(f"work_{k}") for k in ("title", "authors", "journal", "abstract", "affiliation_lists", "orcid", "author_id_openalex")])
    return refs.withColumn("doi_norm", normalize_doi("doi")).join(slim, "doi_norm", "left").drop("doi_norm")


def referenced_works(df: DataFrame, works: DataFrame, exclude_books: bool = True) -> tuple[DataFrame, DataFrame]:
    """(references, dropped books): works that the main articles' works refer to, flattened, with SR_original and SR_ref."""
    require(df, "SR", "doi")
    kept = [F.col("seq").alias("seq_original")] if "seq" in df.columns else []
    main = df.select(*kept, F.col("SR").alias("SR_original"), F.col("doi").alias("doi_original"), normalize_doi("doi").alias("doi_norm")).where("doi_norm IS NOT NULL")
    listed = works.where("doi_norm IS NOT NULL").groupBy("doi_norm").agg(F.min_by("referenced_works", "work_id").alias("cited_references"))
    kept = [c for c in ("seq_original",) if c in main.columns]
    pairs = main.join(listed, "doi_norm").select(*kept, "SR_original", "doi_original", F.posexplode("cited_references").alias("position", "url"))
    pairs = pairs.withColumn("work_id", F.upper(F.substring_index("url", "/", -1)))
    columns = work_columns("w")
    by_id = works.groupBy("work_id").agg(F.min_by(F.struct("*"), F.coalesce("doi_norm", F.lit(""))).alias("w"))
    joined = pairs.join(by_id, "work_id", "left")
    book = F.coalesce(F.lower("w.type").isin(*BOOK_TYPES), F.lit(False)) & F.lit(exclude_books)
    flat = [v.alias(k) for k, v in columns.items()]
    refs = joined.where(~book).select(*kept, "SR_original", "doi_original", "position", "work_id", *flat)
    refs = refs.withColumn("source_title", F.col("journal")).withColumn("SR_ref", blank_to_null(reference_key("authors", "year", "source_title")))
    return refs, joined.where(book).select("SR_original", "doi_original", "work_id", F.lower("w.type").alias("type"), F.col("w.title").alias("title"))


def merge_wos_references(main: DataFrame, refs: DataFrame, seq: str = "seq") -> DataFrame:
    """Main articles and the references that are none of them, one per SR: with a valid DOI if any row of the SR has one."""
    refs = upper_strings(refs).withColumn("ismainarticle", F.lit(False))
    refs = refs.drop("SR").withColumnRenamed("SR_ref", "SR").where("SR IS NOT NULL")
    order = [seq, "position"] if "position" in refs.columns else [seq]
    best = prefer(refs, "SR", valid_doi("doi"), order)
    fresh = best.join(main.select("SR").distinct(), "SR", "left_anti")
    return union_by_name(main.withColumn("ismainarticle", F.lit(True)), fresh)


def merge_scopus_references(main: DataFrame, refs: DataFrame) -> DataFrame:
    """Main articles and all references, aligned by name; a reference's page_end is its first page, page_count 1."""
    refs = upper_strings(refs).withColumnsRenamed({"SR_ref": "SR", "authors": "author", "page": "page_start"})
    refs = refs.withColumn("page_end", F.col("page_start")).withColumn("page_count", F.lit("1")).withColumn("ismainarticle", F.lit(False))
    return union_by_name(main.withColumn("ismainarticle", F.lit(True)), refs.select(*[F.col(c).cast(dict(main.dtypes)[c]) if c in main.columns else F.col(c) for c in refs.columns]))


def distinct_references(df: DataFrame, seq: str = "seq") -> DataFrame:
    return keep_first(df, "SR", seq)
