"""Reader and writer of tagged bibliographic text: two-letter tags, continuation lines, records closed by ER."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.identifiers import record_key_wos
from ..functions.parsing import address_countries
from ..functions.text import ascii_upper, or_text
from ..lineage import cut, small_side

# Tags that repeat, tags that are folded to upper ASCII, and the column of each tag.
REPEATED = ("AU", "AF", "CR", "ID", "DE", "C1", "C3", "EM", "RI", "OI", "FX", "RP")
UPPER = (
    "AB", "AF", "AU", "C1", "CR", "DE", "DT", "EM", "FU", "FX", "JI", "J9", "LA", "OA", "OI", "PT", "RI", "RP", "SC", "SP", "TI", "WC", "WE",
)
COLUMNS = {
    "AU": "author", "AF": "author_full_names", "CR": "references", "AB": "abstract", "AR": "article_number", "BP": "page_start",
    "C1": "affiliations", "C3": "affiliation_2", "CL": "conference_location", "CT": "conference_title", "CY": "conference_year",
    "DA": "date", "DE": "author_keywords", "DI": "doi", "DT": "document_type", "EA": "early_access_date", "EI": "eissn",
    "EM": "email_address", "EP": "page_end", "FU": "funding_agency", "FX": "funding_details", "GA": "document_delivery_number",
    "HC": "highly_cited", "HO": "conference_host", "HP": "epub_date", "ID": "index_keywords", "IS": "issue", "J9": "source_title",
    "JI": "journal_abbreviation", "LA": "language", "MA": "meeting_abstract", "NR": "cited_reference_count",
    "OA": "open_access_indicator", "OI": "orcid", "PA": "publisher_address", "PD": "publication_date", "PG": "page_count",
    "PI": "city_publisher", "PM": "pubmed_id", "PN": "part_number", "PT": "publication_type", "PU": "publisher", "PY": "year",
    "RI": "researcher_id_number", "RP": "reprint_address", "SC": "subject_category", "SI": "special_issue", "SN": "issn",
    "SO": "journal", "SP": "conference_sponsor", "SU": "supplement", "TI": "title", "U1": "usage_count_last_180_days",
    "U2": "usage_count_since_2013", "UT": "accession_number", "VL": "volume", "WC": "web_of_science_categories",
    "WE": "web_of_science_entry", "Z9": "cited_by",
}


#: Where the reader cuts a file: a line that begins with ER, and must hold nothing else.
RECORD_END = "\nER"
WHOLE_END = r"(?m)^ER[ \t]*$"


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, block (the byte at which the split begins), id (counts rows within a split) and value, the text up to a RECORD_END.

    Files are split by bytes; a piece belongs to the split in which it begins."""
    return spark.read.text(paths, lineSep=RECORD_END).select(
        F.input_file_name().alias("file"), F.expr("input_file_block_start()").alias("block"), F.monotonically_increasing_id().alias("id"), "value"
    )


def read_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """seq (file number << 40 | record in the file) and value, the text of a record, of tagged files or folders of them (UTF-8, with or without
    byte order mark, any line ends).

    A first pass counts the pieces of each split; a piece's number is its place in its split after the pieces of the file's splits before, which takes a
    row per split. Files in which a piece does not end a record (a line that only begins with ER), or with bare carriage returns, are cut as
    a whole instead, one task a file. Raises for files without a head."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = [] if any(_foreign(p) for p in paths) else sorted(spark.read.text(paths).inputFiles())
    if bad := [p for p in paths + files if _foreign(p)]:
        raise ValueError(f"not .txt: {', '.join(bad)}")
    pieces = _pieces(spark, paths)
    bare = F.col("value").rlike(r"\r(?!\n|$)")
    cut_short = ~F.col("value").rlike(r"^[ \t]*(?:\r?\n|\r?$)")
    head = F.array_join(F.slice(F.split(F.regexp_replace(F.substring("value", 1, 2000), "\r\n?", "\n"), "\n"), 1, 5), "\n")
    splits = cut(
        pieces.groupBy("file", "block").agg(
            F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.min_by(head.rlike(r"(?m)^\ufeff?FN ") & head.rlike(r"(?m)^\ufeff?VR "), "id").alias("head"),
            F.count_if(cut_short).alias("short"), F.min_by(cut_short.cast("int"), "id").alias("first_short"), F.bool_or(bare).alias("bare"),
        )
    )
    # the first piece of a file follows no record, so its beginning says nothing
    judged = splits.groupBy("file").agg(
        F.min_by("head", "block").alias("head"), (F.bool_or("bare") | (F.sum("short") > F.min_by("first_short", "block"))).alias("odd")
    ).collect()  # a row per file
    heads, odd = {r["file"] for r in judged if r["head"]}, sorted(r["file"] for r in judged if r["odd"])
    if bad := [f for f in files if f not in heads]:
        raise ValueError(f"no FN and VR header in {', '.join(bad)}")
    numbers = spark.createDataFrame([(f, i) for i, f in enumerate(files, 1)], "file string, number long")
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = small_side(splits.where(~F.col("file").isin(odd)).select("file", "block", "low", earlier.alias("earlier")).join(numbers, "file"))
    records = pieces.join(bases, ["file", "block"]).select(_seq(F.col("earlier") + F.col("id") - F.col("low")), "value")
    if odd:
        whole = spark.read.text(odd, wholetext=True).select(F.input_file_name().alias("file"), "value").join(numbers, "file")
        bodies = F.posexplode(F.split(F.regexp_replace("value", "\r\n?", "\n"), WHOLE_END)).alias("at", "value")
        records = records.unionByName(whole.select("number", bodies).select(_seq(F.col("at").cast("long")), "value"))
    return records


def _foreign(path: str) -> bool:
    name = path.rstrip("/").rpartition("/")[2].lower()
    return "." in name and "*" not in name and not name.endswith(".txt")


def _seq(record: Column) -> Column:
    return (F.shiftleft(F.col("number"), 40) + record).alias("seq")


def fields_of(records: DataFrame) -> DataFrame:
    """seq, value -> seq and blocks, the record's (tag, lines) in order; records without a tag drop out.

    A block is a line that begins with a tag and the lines after it that do not, so no tag is carried from row to row."""
    body = F.regexp_replace(F.regexp_replace("value", "^\ufeff", ""), "\r\n?", "\n")
    body = F.concat(F.lit("\n"), F.regexp_replace(body, r"(?m)^(?:FN|VR) .*$", ""))
    kept = lambda line: (F.trim(line) != "") & ~line.rlike(r"^EF\s*$")
    lines = lambda block: F.transform(F.filter(F.split(block, "\n"), kept), lambda x: F.trim(x))
    blocks = F.filter(F.split(body, r"\n(?=[A-Z][A-Z0-9] )"), lambda b: b.rlike("^[A-Z][A-Z0-9] "))
    # the tag gives way to a blank of its own, so that an empty first line goes like any other
    found = F.transform(blocks, lambda b: F.struct(F.left(b, F.lit(2)).alias("tag"), lines(F.substr(b, F.lit(3))).alias("lines")))
    return records.select("seq", found.alias("blocks")).where(F.size("blocks") > 0)


def _author(x: Column) -> Column:
    parts = F.split(x, ", ")
    return F.when(F.size(parts) == 2, F.concat_ws(" ", ascii_upper(F.get(parts, F.lit(0))), ascii_upper(F.get(parts, F.lit(1))))).otherwise(ascii_upper(x))


def articles_of(fields: DataFrame) -> DataFrame:
    """One row per record: seq, the columns of COLUMNS (missing: ''), source, SR, country, ismainarticle.

    Tags of REPEATED gather the lines of all their blocks; of another tag the last block stands."""
    tags = F.transform(F.reverse("blocks"), lambda b: b["tag"])
    known = fields.withColumns({"tags": tags, "last": F.reverse("blocks")})

    def column(tag: str) -> Column:
        if tag in REPEATED:
            v = F.flatten(F.transform(F.filter("blocks", lambda b: b["tag"] == tag), lambda b: b["lines"]))
        else:
            v = F.get("last", F.nullif(F.array_position("tags", F.lit(tag)), F.lit(0)).cast("int") - 1)["lines"]
        if tag == "AU":
            return F.array_join(F.transform(v, _author), ";")
        if tag in UPPER:
            v = F.transform(v, lambda x: ascii_upper(x))
        return F.array_join(v, ";" if tag == "AF" else "; " if tag in REPEATED else " ")

    out = known.select("seq", *[column(t).alias(n) for t, n in COLUMNS.items()])
    out = out.withColumn("source", F.lit("WOS")).withColumn("SR", record_key_wos("author", "year", "source_title"))
    out = out.withColumn("country", F.array_join(address_countries("affiliations", bracketed=True), "; ")).withColumn("ismainarticle", F.lit(True))
    return out.select("seq", *[or_text(n).alias(n) for n in COLUMNS.values()], "source", "SR", or_text("country").alias("country"), "ismainarticle")


def read_wos(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Articles of tagged text files, in the order of the files' names and their records."""
    return articles_of(fields_of(read_records(spark, paths)))


def tagged_text(df: DataFrame) -> Column:
    """A record's text from the columns of COLUMNS that df has: lists a line per item, other values a line per line; blank lines go."""
    parts = []
    for tag, name in COLUMNS.items():
        if name in df.columns:
            value = F.col(f"`{name}`").cast("string")
            lines = F.split(value, r";\s*|\n" if tag in REPEATED else "\r\n?|\n")
            lines = F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != "")
            parts.append(F.when(F.size(lines) > 0, F.concat(F.lit(f"{tag} "), F.array_join(lines, "\n   "), F.lit("\n"))))
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts], F.lit("ER\n"))


def write_wos(df: DataFrame, folder: str, seq: str = "seq") -> None:
    """Tagged text files of a part of the rows each, in order of seq: the names sort as the parts do, and every file has a head."""
    ordered = df.repartitionByRange(seq).sortWithinPartitions(seq)
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of its part
    head = F.when(first, "FN biblioforge\nVR 1.0\n").otherwise("")
    ordered.select(F.concat(head, tagged_text(df)).alias("value")).write.mode("overwrite").text(folder)
