"""Queries of the text, identifier and parser functions over whole tables, each with SQL for the same rows.

Inputs are texts made from the tables' columns by the same expression on both sides (the views of INPUTS), with blank, missing and odd
values among them; the functions' own rules are written out in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import identifiers as I
from ..functions import parsing as P
from ..functions import text as T
from ..operators import geo
from ..operators.references import scopus_reference_table, scopus_references
from .registry import query, t


def _s(column: str):
    return F.col(column).cast("string")


def _cases(column: str, *values):
    """The i-th value where column modulo their number is i."""
    return F.get(F.array(*[F.lit(v) if isinstance(v, str) or v is None else v for v in values]), (F.col(column) % len(values)).cast("int"))


def _sql_cases(column: str, *values: str) -> str:
    return f"CASE {column} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


# --- identifiers ------------------------------------------------------------------------------------------------------

_DOIS = _sql_cases("o_orderkey", "' https://doi.org/10.1/A' || o_custkey || ' '", "'-'", "''", "NULL", "'10.2/b.' || o_custkey", "'NaN'", "'http://dx.doi.org/10.3/C' || o_custkey || '/full/x'")


def _dois(spark, sf):
    x = _cases("o_orderkey", F.concat(F.lit(" https://doi.org/10.1/A"), _s("o_custkey"), F.lit(" ")), "-", "", None, F.concat(F.lit("10.2/b."), _s("o_custkey")), "NaN", F.concat(F.lit("http://dx.doi.org/10.3/C"), _s("o_custkey"), F.lit("/full/x")))
    return t(spark, sf, "orders").select("o_orderkey", x.alias("x"))


@query(f"""WITH x AS (SELECT o_orderkey, {_DOIS} AS x FROM orders)
SELECT o_orderkey, CASE WHEN trim(x) NOT IN ('', '-') THEN replace(trim(x), 'https://doi.org/', '') END AS clean_doi,
  coalesce(lower(trim(x)) NOT IN ('', '-', 'nan', 'none', '<na>'), false) AS valid_doi,
  nullif(trim(regexp_replace(regexp_replace(lower(trim(x)), '^https?://(dx\\.)?doi\\.org/', ''), '/(full|pdf|html).*$', ''), ' .'), '') AS normal_doi FROM x""")
def doi_forms(spark, sf):
    return _dois(spark, sf).select("o_orderkey", I.clean_doi("x").alias("clean_doi"), I.valid_doi("x").alias("valid_doi"), I.normalize_doi("x").alias("normal_doi"))


@query("""WITH x AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'https://openalex.org/a' || c_custkey WHEN 1 THEN ' A' || c_custkey || ' ' WHEN 2 THEN '' END AS a,
  CASE c_custkey % 4 WHEN 0 THEN 'https://orcid.org/0000-0001-0000-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') WHEN 1 THEN 'NO ORCID' WHEN 2 THEN '0000-x' END AS o FROM customer)
SELECT c_custkey, nullif(upper(split_part(trim(a), '/', -1)), '') AS openalex, CASE WHEN upper(o) <> 'NO ORCID' THEN upper(split_part(o, '/', -1)) END AS orcid,
  CASE WHEN upper(trim(o)) <> 'NO ORCID' THEN o END AS kept FROM x""")
def short_ids(spark, sf):
    k = _s("c_custkey")
    a = _cases("c_custkey", F.concat(F.lit("https://openalex.org/a"), k), F.concat(F.lit(" A"), k, F.lit(" ")), "", None)
    o = _cases("c_custkey", F.concat(F.lit("https://orcid.org/0000-0001-0000-"), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0")), "NO ORCID", "0000-x", None)
    return t(spark, sf, "customer").select("c_custkey", I.short_openalex(a).alias("openalex"), I.normalize_orcid(o).alias("orcid"), T.missing_to_null(o).alias("kept"))


@query("""WITH x AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '0-' || (c_custkey % 50) END AS o, CASE WHEN c_custkey % 3 = 0 THEN 'x/a' || (c_custkey % 70) END AS a,
  'Li, B. ' || c_mktsegment AS n, c_custkey % 4 AS k FROM customer)
SELECT c_custkey, CASE WHEN o IS NOT NULL AND k > 1 AND a IS NOT NULL THEN 'OA:' || upper(split_part(a, '/', -1)) WHEN o IS NOT NULL THEN 'ORCID:' || o
  WHEN a IS NOT NULL THEN 'OA:' || upper(split_part(a, '/', -1)) ELSE 'NAME:' || upper(regexp_replace(trim(replace(replace(n, ',', ''), '.', '')), '\\s+', '_', 'g')) END AS author_id FROM x""")
def author_ids(spark, sf):
    k = F.col("c_custkey")
    o, a = F.when(k % 2 == 0, F.concat(F.lit("0-"), (k % 50).cast("string"))), F.when(k % 3 == 0, F.concat(F.lit("x/a"), (k % 70).cast("string")))
    return t(spark, sf, "customer").select("c_custkey", I.author_id(o, a, F.concat(F.lit("Li, B. "), "c_mktsegment"), k % 4).alias("author_id"))


# --- names ------------------------------------------------------------------------------------------------------------

_NAMES = _sql_cases("p_partkey", "upper(p_name)", "upper(replace(p_name, ' ', ', ')) || ' B'", "p_type", "'NO, NAME'", "'  ' || p_name || ' von x '", "'ANONYMOUS'")


def _names(spark, sf):
    x = _cases("p_partkey", F.upper("p_name"), F.concat(F.upper(F.replace("p_name", F.lit(" "), F.lit(", "))), F.lit(" B")), F.col("p_type"), "NO, NAME", F.concat(F.lit("  "), "p_name", F.lit(" von x ")), "ANONYMOUS")
    return t(spark, sf, "part").select("p_partkey", x.alias("x"))


@query(f"""WITH x AS (SELECT p_partkey, {_NAMES} AS x FROM part), y AS (SELECT *, trim(x) AS n, string_split_regex(trim(x), '\\s+') AS w FROM x)
SELECT p_partkey, CASE WHEN contains(n, ',') OR upper(n) IN ('NO, NAME', 'ANONYMOUS') THEN n ELSE regexp_replace(n, '^(\\S+)\\s+(.+)$', '\\1, \\2') END AS standard,
  regexp_replace(trim(lower(replace(x, ',', ''))), '\\s+', ' ', 'g') AS matching,
  lower(CASE WHEN contains(n, ',') THEN trim(split_part(n, ',', 1)) || ' ' || left(trim(split_part(n, ',', 2)), 1) ELSE w[1] || ' ' || coalesce(left(w[2], 1), '') END) AS last_first,
  CASE WHEN len(w) > 1 THEN w[-1] || ' ' || list_reduce(list_transform(w[:-2], lambda v: upper(left(v, 1)) || '.'), lambda a, b: a || b) ELSE w[1] END AS author FROM y""")
def name_forms(spark, sf):
    x = F.col("x")
    return _names(spark, sf).select("p_partkey", I.standard_fullname(x).alias("standard"), I.matching_name(x).alias("matching"), I.last_first_initial(x).alias("last_first"), I.author_from_fullname(x).alias("author"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'KEPT K' ELSE split_part(p_name, ' ', 2) || ' ' || upper(left(p_name, 1)) || '.; Plato' END AS authors,
  upper(split_part(p_name, ' ', 2)) || ' ' || upper(left(p_name, 1)) AS first_key FROM part""")
def author_lists(spark, sf):
    names = F.concat(F.lit(" "), "p_name", F.lit(" ; ;Plato"))
    return t(spark, sf, "part").select("p_partkey", I.authors_from_fullnames(F.when(F.col("p_partkey") % 3 == 0, "KEPT K").otherwise(" "), names).alias("authors"), I.first_author_key(F.concat("p_name", F.lit(" (12) ; x"))).alias("first_key"))


@query("""WITH x AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN c_name WHEN 1 THEN '*' || c_mktsegment WHEN 2 THEN ' (' || c_mktsegment WHEN 3 THEN c_mktsegment || ' A' WHEN 4 THEN '"X"' END AS x FROM customer)
SELECT c_custkey, coalesce(NOT regexp_matches(x, '[0-9]') AND left(ltrim(x), 1) NOT IN ('*', '.', '(', '"', '?'), false) AS usable FROM x""")
def usable_names(spark, sf):
    x = _cases("c_custkey", F.col("c_name"), F.concat(F.lit("*"), "c_mktsegment"), F.concat(F.lit(" ("), "c_mktsegment"), F.concat("c_mktsegment", F.lit(" A")), '"X"', None)
    return t(spark, sf, "customer").select("c_custkey", I.usable_author_name(x).alias("usable"))


# --- record keys ------------------------------------------------------------------------------------------------------


@query("""WITH x AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, nullif(p_size, 7) AS y, CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS s FROM part)
SELECT p_partkey, concat_ws(', ', CASE WHEN p_partkey % 2 = 0 THEN upper(a) || ' ' || upper(left(b, 1)) ELSE upper(b) || ' ' || upper(left(a, 1)) END, (1900 + y)::VARCHAR, upper(s)) AS scopus,
  CASE WHEN y IS NOT NULL AND s IS NOT NULL THEN a || ' ' || b || ', ' || (1900 + y) || ', ' || s ELSE '' END AS wos FROM x""")
def record_keys(spark, sf):
    a, b = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    y = (1900 + F.nullif("p_size", F.lit(7))).cast("string")
    s = F.when(F.col("p_partkey") % 5 != 0, F.col("p_type"))
    full = F.when(F.col("p_partkey") % 2 == 0, F.concat(a, F.lit(", "), b, F.lit(" (33); Z"))).otherwise(F.concat(a, F.lit(" "), b, F.lit("; Z")))
    return t(spark, sf, "part").select("p_partkey", I.record_key_scopus(full, y, s).alias("scopus"), I.record_key_wos(F.concat("p_name", F.lit(";Z")), y, s).alias("wos"))


@query("""WITH x AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN year(o_orderdate) || '.0' WHEN 1 THEN ' ' || year(o_orderdate) || ' ' WHEN 2 THEN 'n/a' WHEN 3 THEN '' END AS y,
  'Smith J' || o_custkey || ', ' || CASE WHEN o_orderkey % 3 = 0 THEN 'A, ' ELSE '' END || year(o_orderdate) || ', ' || o_orderpriority AS k FROM orders)
SELECT o_orderkey, CASE WHEN try_cast(trim(y) AS DOUBLE) IS NOT NULL THEN try_cast(trim(y) AS DOUBLE)::INT::VARCHAR END AS year, 'SMITH' AS family,
  nullif(regexp_extract(substr(k, strpos(k, ',') + 1), '\\b([0-9]{4})\\b', 1), '') AS key_year FROM x""")
def key_parts(spark, sf):
    year = F.year("o_orderdate").cast("string")
    y = _cases("o_orderkey", F.concat(year, F.lit(".0")), F.concat(F.lit(" "), year, F.lit(" ")), "n/a", "", None)
    k = F.concat(F.lit("Smith J"), _s("o_custkey"), F.lit(", "), F.when(F.col("o_orderkey") % 3 == 0, "A, ").otherwise(""), year, F.lit(", "), "o_orderpriority")
    family, key_year = I.sr_parts(k)
    return t(spark, sf, "orders").select("o_orderkey", I.year_text(y).alias("year"), family.alias("family"), key_year.alias("key_year"))


# --- small text rules --------------------------------------------------------------------------------------------------


@query("""WITH x AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN ' ' || p_name || '. ' WHEN 1 THEN '1234-' || p_size WHEN 2 THEN ' ' END AS x, CASE p_partkey % 4 WHEN 0 THEN 'true ' WHEN 1 THEN 'yes' WHEN 2 THEN 'TRUE' END AS b FROM part)
SELECT p_partkey, nullif(upper(trim(replace(x, '.', ''))), '') AS journal_key, nullif(upper(trim(replace(x, '-', ''))), '') AS issn_key, coalesce(upper(trim(b)) = 'TRUE', false) AS flag,
  nullif(trim(replace(replace(replace('[' || x || ']', '.', ''), '[', ''), ']', '')), '') AS cleaned, coalesce(nullif(trim(b), ''), '?') AS text_or, upper(x) AS upper_x,
  (x IS NOT NULL AND trim(x) <> '')::INT + (b IS NOT NULL)::INT AS filled FROM x""")
def small_rules(spark, sf):
    x = _cases("p_partkey", F.concat(F.lit(" "), "p_name", F.lit(". ")), F.concat(F.lit("1234-"), _s("p_size")), " ", None)
    df = t(spark, sf, "part").select("p_partkey", x.alias("x"), _cases("p_partkey", "true ", "yes", "TRUE", None).alias("b"))
    return T.upper_strings(df.select("p_partkey", "x")).select("p_partkey", F.col("x").alias("upper_x")).join(
        df.select(
            "p_partkey", T.journal_key("x").alias("journal_key"), T.issn_key("x").alias("issn_key"), T.is_true("b").alias("flag"), I.cleaned_reference_author(F.concat(F.lit("["), "x", F.lit("]"))).alias("cleaned"),
            F.trim(T.or_text(F.col("b"), "?")).alias("text_or"), I.filled_score("x", "b").alias("filled"),
        ), "p_partkey"
    )


@query("SELECT doc_id, trim(upper(strip_accents(replace(text, 'ß', 'SS'))), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS folded FROM documents")
def fold_texts(spark, sf):
    return t(spark, sf, "documents").select("doc_id", T.fold_upper("text").alias("folded"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus || '; ' ELSE '' END || o_orderpriority AS joined,
  [x FOR x IN [CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END, o_orderpriority] IF x IS NOT NULL] AS items FROM orders""")
def joined_lists(spark, sf):
    a = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus"))
    text = F.concat(F.lit(" ;"), F.coalesce(a, F.lit(" ")), F.lit("; "), "o_orderpriority", F.lit(";"))
    return t(spark, sf, "orders").select("o_orderkey", T.join_list(F.array(F.lit(" "), a, F.col("o_orderpriority"))).alias("joined"), T.split_list(text).alias("items"))


# --- parsers -----------------------------------------------------------------------------------------------------------


@query("""WITH x AS (SELECT o_orderkey, o_custkey, 'Li [B.], ' || CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate) || ', ' ELSE '' END || 'J ' || o_orderpriority || ', V' || o_custkey || CASE WHEN o_orderkey % 3 = 0 THEN ', DOI 10.1234/AB.' || o_custkey ELSE '' END AS r FROM orders)
SELECT o_orderkey, 'Li B' AS author, CASE WHEN o_orderkey % 2 = 0 THEN trim(split_part(r, ',', 2)) END AS year, CASE WHEN o_orderkey % 2 = 0 THEN trim(split_part(r, ',', 3)) ELSE trim(split_part(r, ',', 2)) END AS journal,
  CASE WHEN o_orderkey % 3 = 0 THEN '10.1234/ab.' || o_custkey END AS doi, 'Li [B.]' AS before, trim(split_part(r, ',', -1)) AS after FROM x""")
def reference_parts(spark, sf):
    r = F.concat(
        F.lit("Li [B.], "), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.year("o_orderdate").cast("string"), F.lit(", "))).otherwise(""), F.lit("J "), "o_orderpriority", F.lit(", V"), _s("o_custkey"),
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(", DOI 10.1234/AB."), _s("o_custkey"))).otherwise(""),
    )
    return t(spark, sf, "orders").select("o_orderkey", P.reference_author(r).alias("author"), P.reference_year(r).alias("year"), P.reference_journal(r).alias("journal"), P.reference_doi(r).alias("doi"), P.before_first_comma(r).alias("before"), P.after_last_comma(r).alias("after"))


@query("""WITH x AS (SELECT c_custkey, ['USA', 'CA 94305 USA', 'England', 'Peoples R China', 'México.', 'Norway'][c_custkey % 6 + 1] AS a, ['UNITED STATES', 'UNITED STATES', 'UNITED KINGDOM', 'CHINA', 'MEXICO', 'NORWAY'] AS c FROM customer)
SELECT c_custkey, ['FRANCE', c[c_custkey % 6 + 1], 'FRANCE'] AS plain, [c[c_custkey % 6 + 1], 'SPAIN'] AS bracketed, 'FRANCE; ' || upper(a) AS pieces FROM x""")
def address_forms(spark, sf):
    a = _cases("c_custkey", "USA", "CA 94305 USA", "England", "Peoples R China", "México.", "Norway")
    plain = F.concat(F.lit("Univ A, Paris, France; B Lab, "), a, F.lit(" ; ; X, France."))
    bracketed = F.concat(F.lit("[Li, B; Wu, C] U One, "), a, F.lit("; [Paz, A] U Two, Madrid, Spain"))
    return t(spark, sf, "customer").select("c_custkey", P.address_countries(plain).alias("plain"), P.address_countries(bracketed, True).alias("bracketed"), P.last_pieces(F.concat(F.lit("A, Paris, France; ; B, "), a)).alias("pieces"))


@query("""SELECT c_custkey, 'LI, ' || c_mktsegment || '=Univ ' || c_nationkey || '|WU, C=Univ ' || c_nationkey || '|PAZ, A=Lab, X' AS pairs, 'Univ ' || c_nationkey AS own,
  CASE c_custkey % 3 WHEN 0 THEN 'PAZ, A' WHEN 1 THEN 'PAZ, ANA' END AS corresponding FROM customer""")
def affiliation_blocks(spark, sf):
    pairs = P.bracketed_affiliations(F.concat(F.lit("[LI "), "c_mktsegment", F.lit("; WU, C] Univ "), _s("c_nationkey"), F.lit("; [PAZ, A] Lab, X")))
    reprint = _cases("c_custkey", "PAZ, A (corresponding author), Lab, X.", "PAZ ANA (x), Lab", None)
    return t(spark, sf, "customer").select(
        "c_custkey", F.array_join(F.transform(pairs, lambda p: F.concat_ws("=", p["name"], p["affiliation"])), "|").alias("pairs"),
        F.array_join(P.affiliations_of(F.concat(F.lit("Li  "), "c_mktsegment"), pairs), "|").alias("own"), P.corresponding_author(reprint).alias("corresponding"),
    )


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'b' || c_custkey END AS second, 'li b=R-' || c_custkey || '|wu=S/1' AS researchers, 'a@x.org|b' || c_custkey || '@y.org' AS emails,
  '0000-0001-0000-' || lpad((c_custkey % 1000)::VARCHAR, 3, '0') || 'X' AS first_orcid, CASE WHEN c_custkey % 2 = 1 THEN '0000-0002-0000-0001' END AS third_orcid,
  CASE WHEN c_custkey % 2 = 0 THEN 'Li, B' ELSE 'Li, B (x)' END AS bare, CASE WHEN c_custkey % 2 = 0 THEN c_custkey::VARCHAR END AS id, 'U' || c_custkey AS place FROM customer""")
def author_fields(spark, sf):
    k, even = _s("c_custkey"), F.col("c_custkey") % 2 == 0
    listed = F.concat(F.lit("a ;"), F.when(even, F.concat(F.lit(" b"), k)).otherwise(" "), F.lit("; c"))
    orcid = F.concat(F.lit("https://orcid.org/0000-0001-0000-"), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"), F.lit("x; none ;"), F.when(~even, "https://ORCID.org/0000-0002-0000-0001").otherwise(""))
    name = F.when(even, F.concat(F.lit("Li, B ("), k, F.lit(")"))).otherwise("Li, B (x)")
    researchers = P.researcher_ids(F.concat(F.lit("LI, B/R-"), k, F.lit("; no id; Wu/S/1")))
    keys = F.array(F.struct(F.lit("").alias("name"), F.lit("never").alias("at")), F.struct(F.lit("Li B").alias("name"), F.concat(F.lit("U"), k).alias("at")), F.struct(F.lit("Li Bo").alias("name"), F.lit("V").alias("at")))
    return t(spark, sf, "customer").select(
        "c_custkey", P.positional(listed, 1).alias("second"), F.array_join(F.transform(researchers, lambda r: F.concat_ws("=", r["name"], F.when(r["name"] == "wu", "S/1").otherwise(r["id"]))), "|").alias("researchers"),
        F.array_join(P.emails(F.concat(F.lit("a@x.org;; b"), k, F.lit("@y.org"))), "|").alias("emails"), F.get(P.orcid_urls(orcid), F.lit(0)).alias("first_orcid"), F.get(P.orcid_urls(orcid), F.lit(2)).alias("third_orcid"),
        P.name_without_id(name).alias("bare"), P.id_of_name(name).alias("id"), P.first_containing(F.lit("Li B"), keys, "at").alias("place"),
    )


@query("""WITH x AS (SELECT o_orderkey, o_custkey, year(o_orderdate)::VARCHAR AS y FROM orders)
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 2 END AS ref_type, CASE WHEN o_orderkey % 3 = 0 THEN 'Li B.' ELSE 'Li B., Wu C.' END AS authors, 'Title ' || o_custkey AS title,
  CASE o_orderkey % 3 WHEN 0 THEN 'J One' WHEN 1 THEN 'PP. 1-9' ELSE '5' END AS journal, y AS ref_year,
  CASE o_orderkey % 3 WHEN 0 THEN 'Li B., ' || y || ', J One' WHEN 1 THEN 'Li B., ' || y || ', PP. 1-9' ELSE 'Li B., ' || y || ', 5' END AS SR_ref FROM x""")
def scopus_reference_grammar(spark, sf):
    y, title = F.year("o_orderdate").cast("string"), F.concat(F.lit("Title "), _s("o_custkey"))
    ref = _cases(
        "o_orderkey", F.concat(F.lit("Li B., Wu C., "), title, F.lit(" ("), y, F.lit(") J One, 5, PP. 1-9")), F.concat(F.lit("Li B., Wu C., ("), y, F.lit(") "), title, F.lit(", J Two, PP. 1-9")),
        F.concat(F.lit("Li B., Wu C., ("), y, F.lit(") "), title, F.lit(", J Three, 5")),
    )
    out = scopus_references(t(spark, sf, "orders").select("o_orderkey", F.concat(ref, F.lit("; ")).alias("references")))
    return out.select("o_orderkey", "ref_type", "authors", "title", "journal", "ref_year", "SR_ref")


@query("""SELECT 'A' || o_orderkey AS SR, 'Li B.;Wu C.D.' AS author, 'DEEP ' || o_custkey || ': A STUDY' AS title, 'J One' AS source_title, year(o_orderdate)::VARCHAR AS year, (o_custkey % 90)::VARCHAR AS volume,
  '1-' || (9 + o_custkey % 9) AS pages, CASE WHEN o_orderkey % 2 = 0 THEN '10.1/a' || o_custkey END AS doi FROM orders""")
def scopus_reference_table_rows(spark, sf):
    k = _s("o_custkey")
    ref = F.concat(
        F.lit("Li B., Wu C.D., DEEP "), k, F.lit(": A STUDY, J One, "), (F.col("o_custkey") % 90).cast("string"), F.lit(", PP. 1-"), (9 + F.col("o_custkey") % 9).cast("string"), F.lit(", ("), F.year("o_orderdate").cast("string"), F.lit(")"),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(", DOI: 10.1/a"), k)).otherwise(""),
    )
    rows = scopus_reference_table(t(spark, sf, "orders").select(F.concat(F.lit("A"), _s("o_orderkey")).alias("SR"), ref.alias("references")), ["France"])
    return rows.select("SR", "author", "title", "source_title", "year", "volume", "pages", "doi")


@query("""SELECT p_partkey, 'Li B, Wu C.D.' AS authors, 'a ' || p_name AS title FROM part""")
def authors_and_title(spark, sf):
    authors, title = P.split_authors_title(F.concat(F.lit("Li B, Wu C.D., a "), "p_name"))
    return t(spark, sf, "part").select("p_partkey", authors.alias("authors"), title.alias("title"))


def works(spark, sf):
    """Orders as records of the works service: every third cites two others, some are books."""
    k = F.col("o_orderkey")
    url = lambda c: F.concat(F.lit("https://openalex.org/w"), c.cast("string"))
    institution = F.struct(F.concat(F.lit("U"), _s("o_custkey")).alias("display_name"), F.lit("fr").alias("country_code"))
    people = F.array(
        F.struct(F.struct(url(k + 1).alias("id"), F.concat(F.lit("Bo Li"), _s("o_custkey")).alias("display_name"), F.when(k % 2 == 0, F.concat(F.lit("https://orcid.org/0-"), _s("o_custkey"))).alias("orcid")).alias("author"), F.array(institution).alias("institutions")),
        F.struct(F.struct(url(k + 2).alias("id"), F.lit("Wu").alias("display_name"), F.lit(None).cast("string").alias("orcid")).alias("author"), F.array().cast("array<struct<display_name:string,country_code:string>>").alias("institutions")),
    )
    return t(spark, sf, "orders").select(
        url(k).alias("id"), F.concat(F.lit("W"), _s("o_orderkey")).alias("work_id"), F.when(k % 4 != 0, F.concat(F.lit("10.1/w"), _s("o_orderkey"))).alias("doi_norm"),
        F.when(k % 4 != 0, F.concat(F.lit("https://doi.org/10.1/W"), _s("o_orderkey"))).alias("doi"), F.concat(F.lit("T "), _s("o_custkey")).alias("title"), F.when(k % 7 == 0, "book").otherwise("article").alias("type"),
        F.year("o_orderdate").alias("publication_year"), F.lit(3).alias("cited_by_count"),
        F.struct(F.lit("1").alias("volume"), F.lit("2").alias("issue"), F.lit("3").alias("first_page"), F.lit("4").alias("last_page")).alias("biblio"),
        F.struct(F.struct(F.lit("J. One").alias("display_name")).alias("source")).alias("primary_location"), people.alias("authorships"),
        F.array(F.struct(F.lit("k1").alias("display_name")), F.struct(F.col("o_orderpriority").alias("display_name"))).alias("keywords"),
        F.create_map(F.lit("a"), F.array(F.lit(0), F.lit(2)), F.lit("b"), F.array(F.lit(1))).alias("abstract_inverted_index"),
        F.when(k % 3 == 0, F.array(url(k + 1), url(k + 2))).otherwise(F.array().cast("array<string>")).alias("referenced_works"),
    )


@query("""SELECT 'W' || o_orderkey AS work_id, 'T ' || o_custkey AS title, CASE WHEN o_orderkey % 4 <> 0 THEN '10.1/W' || o_orderkey END AS doi, 'J. One' AS journal, '1' AS volume, '2' AS issue, '3' AS page, 'a b a' AS abstract,
  year(o_orderdate)::INT AS year, 'Bo Li' || o_custkey || '; Wu' AS authors, 'LI' || o_custkey || ' B., U' || o_custkey || ', FR; WU, NO AFFILIATION' AS authors_with_affiliations,
  'w' || (o_orderkey + 1) || '|w' || (o_orderkey + 2) AS ids, 'k1; ' || o_orderpriority AS author_keywords, 3 AS cited_by FROM orders""")
def work_fields(spark, sf):
    c = P.work_columns()
    names = ("title", "doi", "journal", "volume", "issue", "page", "abstract", "year", "authors", "authors_with_affiliations", "author_keywords", "cited_by")
    return works(spark, sf).select("work_id", *[c[n].alias(n) for n in names], F.array_join(c["author_id_openalex"], "|").alias("ids"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'NO AFFILIATION' ELSE 'Univ, ' || c_mktsegment END AS \"Affiliation\" FROM customer")
def affiliation_gaps(spark, sf):
    a = _cases("c_custkey", " ", F.concat(F.lit("Univ, "), "c_mktsegment"), F.concat(F.lit("Univ, "), "c_mktsegment"))
    return geo.fill_missing_affiliations(t(spark, sf, "customer").select("c_custkey", a.alias("Affiliation")))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'FRANCE' WHEN 1 THEN 'NORWAY' WHEN 2 THEN 'NO COUNTRY' ELSE 'NORWAY; FRANCE' END AS "Country" FROM customer""")
def affiliation_countries(spark, sf):
    a = F.concat(F.lit("U"), _s("c_nationkey"), _cases("c_custkey", ", Paris, France", ", Oslo, NOR", ", Nowhere", ", Oslo, Norway; Lab, FRA"))
    countries = spark.createDataFrame([("FRANCE", "FR", "FRA"), ("NORWAY", "NO", "NOR")], "name string, alpha2 string, alpha3 string")
    return geo.extract_countries(t(spark, sf, "customer").select("c_custkey", a.alias("Affiliation")), countries).select("c_custkey", "Country")


