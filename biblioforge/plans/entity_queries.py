"""Queries of the entity operators (references, authors, journals, articles, merged tables) over whole tables, each with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import articles, authors, journals, merge, references
from ..operators import relational as R
from .function_queries import works
from .registry import query, t


def _s(column: str):
    return F.col(column).cast("string")


# --- references ---------------------------------------------------------------------------------------------------------


@query("""WITH r AS (SELECT 'S' || (o_custkey % 400) AS "SR", o_orderkey AS seq, CASE WHEN o_orderkey % 3 = 0 THEN '10.1/' || o_orderkey WHEN o_orderkey % 3 = 1 THEN '-' END AS doi FROM orders WHERE o_orderkey % 11 <> 0),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY "SR" ORDER BY CASE WHEN doi LIKE '10.%' THEN 0 ELSE 1 END, seq) = 1)
SELECT 'S' || (c_custkey * 2) AS "SR", c_custkey AS seq, 'x' AS doi, true AS ismainarticle FROM customer
UNION ALL SELECT "SR", seq, upper(doi), false FROM b WHERE "SR" NOT IN (SELECT 'S' || (c_custkey * 2) FROM customer)""")
def anti_join_refs(spark, sf):
    main = t(spark, sf, "customer").select(F.concat(F.lit("S"), (F.col("c_custkey") * 2).cast("string")).alias("SR"), F.col("c_custkey").alias("seq"), F.lit("x").alias("doi"))
    k = F.col("o_orderkey")
    doi = F.when(k % 3 == 0, F.concat(F.lit("10.1/"), _s("o_orderkey"))).when(k % 3 == 1, "-")
    sr = F.when(k % 11 != 0, F.concat(F.lit("s"), (F.col("o_custkey") % 400).cast("string")))
    refs = t(spark, sf, "orders").select(F.lit("own").alias("SR"), sr.alias("SR_ref"), k.alias("seq"), doi.alias("doi"))
    return references.merge_wos_references(main, refs)


@query("""SELECT 'A' || c_custkey AS "SR", c_name AS title, NULL::VARCHAR AS author, 1::BIGINT AS page_start, NULL AS page_end, true AS ismainarticle FROM customer
UNION ALL SELECT 'R' || o_orderkey, upper(o_orderpriority), 'BO LI', o_custkey, o_custkey::VARCHAR, false FROM orders""")
def union_scopus_references(spark, sf):
    main = t(spark, sf, "customer").select(F.concat(F.lit("A"), _s("c_custkey")).alias("SR"), F.col("c_name").alias("title"), F.lit(1).cast("long").alias("page_start"))
    refs = t(spark, sf, "orders").select(F.concat(F.lit("r"), _s("o_orderkey")).alias("SR_ref"), F.col("o_orderpriority").alias("title"), F.lit("Bo Li").alias("authors"), _s("o_custkey").alias("page"))
    return references.merge_scopus_references(main, refs).select("SR", "title", "author", "page_start", "page_end", "ismainarticle")


@query("SELECT DISTINCT 'A' || (o_custkey % 97) AS \"SR\", 'R' || (o_orderkey % 89) AS \"SR_ref\" FROM orders WHERE o_orderkey % 5 <> 0")
def scopus_citation_edges(spark, sf):
    o = t(spark, sf, "orders").select(
        F.concat(F.lit("A"), (F.col("o_custkey") % 97).cast("string")).alias("SR_original"), F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("R"), (F.col("o_orderkey") % 89).cast("string"))).alias("SR_ref")
    )
    return references.scopus_citations(o)


@query("SELECT o_custkey AS \"SR\", min(o_orderkey) AS seq, arg_min(o_orderpriority, o_orderkey) AS title FROM orders GROUP BY 1")
def first_reference_per_key(spark, sf):
    return references.distinct_references(t(spark, sf, "orders").select(F.col("o_custkey").alias("SR"), F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("title")))


@query("""WITH w AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders WHERE o_orderkey % 4 <> 0)
SELECT l_orderkey * 10 + l_linenumber AS seq, l_partkey AS part, count(*) OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS n, CASE WHEN k IS NULL THEN 'KEPT' ELSE 'BO LI' || c || '; WU' END AS author_full_names,
  CASE WHEN k IS NULL THEN NULL WHEN k % 2 = 0 THEN 'https://orcid.org/0-' || c || '; NO ORCID' ELSE 'NO ORCID; NO ORCID' END AS orcid, CASE WHEN k IS NOT NULL THEN 'W' || k END AS openalex_work_id
FROM lineitem LEFT JOIN w ON k = l_orderkey""")
def enrich_articles(spark, sf):
    l = t(spark, sf, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS seq", "l_partkey AS part", "count(*) OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS n", "'https://doi.org/10.1/W' || l_orderkey AS doi", "'KEPT' AS author_full_names")
    return references.enrich_with_works(l, works(spark, sf)).select("seq", "part", "n", "author_full_names", "orcid", "openalex_work_id")


@query("""SELECT p_partkey, CASE WHEN o_orderkey % 4 <> 0 THEN 'T ' || o_custkey END AS title, CASE WHEN o_orderkey % 4 <> 0 THEN 'a b a' END AS abstract, CASE WHEN o_orderkey % 4 <> 0 THEN 'U' || o_custkey END AS place
FROM part LEFT JOIN orders ON o_orderkey = p_partkey""")
def enrich_cited(spark, sf):
    refs = t(spark, sf, "part").select("p_partkey", F.concat(F.lit("10.1/w"), _s("p_partkey")).alias("doi"))
    out = references.enrich_references(refs, works(spark, sf))
    return out.select("p_partkey", F.col("work_title").alias("title"), F.col("work_abstract").alias("abstract"), F.get(F.get("work_affiliation_lists", F.lit(0)), F.lit(0)).alias("place"))


_CITED = """w AS (SELECT o_orderkey AS k, o_custkey AS c, year(o_orderdate) AS y FROM orders),
p AS (SELECT k, unnest([0, 1]) AS position FROM w WHERE k % 3 = 0 AND k % 4 <> 0), j AS (SELECT p.k AS main, position, w.* FROM p LEFT JOIN w ON w.k = p.k + 1 + position)"""


@query(f"""WITH {_CITED} SELECT 'A' || main AS "SR_original", position, 'W' || (main + 1 + position) AS work_id, CASE WHEN k % 4 <> 0 THEN '10.1/W' || k END AS doi,
  CASE WHEN k IS NOT NULL THEN 'LI' || c || ' B, ' || y || ', J ONE' END AS "SR_ref" FROM j WHERE k IS NULL OR k % 7 <> 0""")
def cited_works(spark, sf):
    main = t(spark, sf, "orders").select(F.concat(F.lit("A"), _s("o_orderkey")).alias("SR"), F.concat(F.lit("10.1/W"), _s("o_orderkey")).alias("doi"))
    return references.referenced_works(main, works(spark, sf))[0].select("SR_original", "position", "work_id", "doi", "SR_ref")


@query(f"""WITH {_CITED} SELECT 'A' || main AS "SR_original", 'W' || k AS work_id, 'book' AS type, 'T ' || c AS title FROM j WHERE k % 7 = 0""")
def cited_books(spark, sf):
    main = t(spark, sf, "orders").select(F.concat(F.lit("A"), _s("o_orderkey")).alias("SR"), F.concat(F.lit("10.1/W"), _s("o_orderkey")).alias("doi"))
    return references.referenced_works(main, works(spark, sf))[1].drop("doi_original")


@query("SELECT doc_id, i - 1 AS position, trim(string_split(text, ',')[i]) AS piece FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, ',')) + 1)) AS i FROM documents) WHERE trim(string_split(text, ',')[i]) <> ''")
def explode_positions(spark, sf):
    return R.explode_list(t(spark, sf, "documents").select("doc_id", "text"), "text", "piece", ",", position="position").select("doc_id", F.col("position").cast("long").alias("position"), "piece")


# --- authors -------------------------------------------------------------------------------------------------------------


@query("""WITH x AS (SELECT o_orderkey AS seq, o_custkey AS c, CASE WHEN o_orderkey % 2 = 0 THEN 'Li' || o_custkey || ' B' END AS two FROM orders),
p AS (SELECT seq, c, unnest([1, 2, 3]) AS i FROM x)
SELECT seq, i AS "AuthorOrder", ['LI B', 'WU C', 'PAZ A'][i] AS "AuthorName", ['LI, BO', 'WU, CAI', 'PAZ, ANA'][i] AS "AuthorFullName", [ 'U' || c || ', FRANCE', 'U' || c || ', FRANCE', 'LAB, SPAIN'][i] AS "Affiliation",
  i = 2 AS "CorrespondingAuthor", CASE WHEN i = 1 THEN '0-' || c WHEN i = 3 THEN '0-3' END AS "Orcid", CASE WHEN i = 3 THEN 'R-' || c END AS "ResearcherID", ['bo.li@x.org', 'c@y.org', 'a' || c || '@z.org'][i] AS "Email",
  CASE WHEN i = 2 THEN 'A' || c END AS "OpenAlexAuthorID" FROM p WHERE seq % 4 <> 3""")
def wos_author_rows(spark, sf):
    c = _s("o_custkey")
    df = t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderkey") % 4 == 3, "1999, 1999").otherwise(F.concat(F.lit("A"), _s("o_orderkey"))).alias("SR"), F.lit("LI B; WU C; PAZ A").alias("author"), F.lit("LI, BO; WU, CAI; PAZ ANA").alias("author_full_names"),
        F.concat(F.lit("[LI, BO; WU, CAI] U"), c, F.lit(", FRANCE; [PAZ, ANA] LAB, SPAIN")).alias("affiliations"), F.lit("WU, C (corresponding author), LAB.").alias("reprint_address"),
        F.concat(F.lit("0-"), c, F.lit("; ; https://orcid.org/0-3")).alias("orcid"), F.concat(F.lit("PAZ, ANA/R-"), c).alias("researcher_id_number"),
        F.concat(F.lit("bo.li@x.org; c@y.org; a"), c, F.lit("@z.org")).alias("email_address"), F.concat(F.lit(";A"), c, F.lit(";")).alias("author_id_openalex"),
    )
    return authors.wos_authors(df).select("seq", "AuthorOrder", "AuthorName", "AuthorFullName", "Affiliation", "CorrespondingAuthor", "Orcid", "ResearcherID", "Email", "OpenAlexAuthorID")


@query("""WITH p AS (SELECT o_orderkey AS seq, o_custkey AS c, unnest([1, 2]) AS i FROM orders WHERE o_orderkey % 6 <> 0)
SELECT seq, i AS "AuthorOrder", ['Li B.', 'Paz A.'][i] AS "AuthorName", ['Li, Bo', 'Paz, Ana'][i] AS "AuthorFullName", CASE WHEN i = 1 THEN 'U' || c || ', France' END AS "Affiliation",
  CASE WHEN i = 2 THEN '0000-0001-0000-0001' END AS "Orcid", CASE WHEN i = 1 THEN c::VARCHAR ELSE '7' END AS "ResearcherID", CASE WHEN i = 1 THEN 'A' || c END AS "OpenAlexAuthorID", [c::VARCHAR, '7'][i] AS scopus_author_id FROM p""")
def scopus_author_rows(spark, sf):
    c = _s("o_custkey")
    df = t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("seq"), F.concat(F.lit("A"), _s("o_orderkey")).alias("SR"), F.when(F.col("o_orderkey") % 6 != 0, "Li B.; Paz A.").alias("author"), F.concat(F.lit("Li, Bo ("), c, F.lit("); Paz, Ana (7)")).alias("author_full_names"),
        F.concat(c, F.lit("; 7")).alias("authors_id"), F.concat(F.lit("Li B., U"), c, F.lit(", France; no comma")).alias("authors_with_affiliations"), F.lit("; https://orcid.org/0000-0001-0000-0001").alias("orcid"),
        F.concat(F.lit("A"), c, F.lit(";")).alias("author_id_openalex"),
    )
    return authors.scopus_authors(df).select("seq", "AuthorOrder", "AuthorName", "AuthorFullName", "Affiliation", "Orcid", "ResearcherID", "OpenAlexAuthorID", "scopus_author_id")


_PEOPLE = """x AS (SELECT o_orderkey AS seq, 'A' || (o_custkey % 300) AS id, 'N' || (o_orderkey % 7) AS n, o_custkey % 3 AS place, o_orderpriority AS sr FROM orders)"""


def _people(spark, sf):
    none = F.lit(None).cast("string")
    return t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("SR"), none.alias("openalex_work_id"), F.concat(F.lit("A"), (F.col("o_custkey") % 300).cast("string")).alias("AuthorID"),
        F.concat(F.lit("N"), (F.col("o_orderkey") % 7).cast("string")).alias("AuthorName"), F.concat(F.lit("F"), _s("o_orderkey")).alias("AuthorFullName"), none.alias("Orcid"), none.alias("ResearcherID"), none.alias("Email"),
        none.alias("OpenAlexAuthorID"), none.alias("scopus_author_id"), (F.col("o_orderkey") % 3).alias("AuthorOrder"), F.lit(False).alias("CorrespondingAuthor"), F.concat(F.lit("P"), (F.col("o_custkey") % 3).cast("string")).alias("Affiliation"),
    )


@query(f"""WITH {_PEOPLE}, c AS (SELECT n, count(*) AS k FROM x GROUP BY 1)
SELECT id AS "AuthorID", n AS "AuthorName", 'F' || seq AS "AuthorFullName" FROM x JOIN c USING (n) QUALIFY row_number() OVER (PARTITION BY id ORDER BY k DESC, seq) = 1""")
def author_table(spark, sf):
    return authors.author_tables(_people(spark, sf))[0].select("AuthorID", "AuthorName", "AuthorFullName")


@query(f"""WITH {_PEOPLE} SELECT DISTINCT sr AS "SR", id AS "AuthorID", seq % 3 AS "AuthorOrder" FROM x""")
def article_author_links(spark, sf):
    return authors.author_tables(_people(spark, sf))[1].select("SR", "AuthorID", "AuthorOrder")


@query(f"""WITH {_PEOPLE} SELECT DISTINCT sr AS "SR", id AS "AuthorID", 'P' || place AS "Affiliation" FROM x""")
def affiliation_table(spark, sf):
    return authors.author_tables(_people(spark, sf))[2]


@query("""WITH x AS (SELECT o_orderkey AS seq, CASE o_orderkey % 5 WHEN 0 THEN 'ANONYMOUS' ELSE 'N' || (o_custkey % 50) END AS n FROM orders) SELECT seq, n AS "AuthorName" FROM x WHERE n <> 'ANONYMOUS'""")
def named_authors_only(spark, sf):
    name = F.when(F.col("o_orderkey") % 5 == 0, "ANONYMOUS").otherwise(F.concat(F.lit("N"), (F.col("o_custkey") % 50).cast("string")))
    df = t(spark, sf, "orders").select(F.col("o_orderkey").alias("seq"), name.alias("AuthorName"), name.alias("AuthorFullName"), F.lit(None).cast("string").alias("Orcid"))
    return authors.enrich_names(df, keep_anonymous=False).select("seq", "AuthorName")


# --- journals ------------------------------------------------------------------------------------------------------------


def _metrics(spark, sf):
    """Parts as journal metrics: title, abbreviation, identifiers and a year."""
    p = t(spark, sf, "part")
    return p.select(
        F.col("p_partkey").alias("sc_seq"), (F.col("p_partkey") % 500).alias("sc_sourceid"), F.upper("p_name").alias("sc_title"), F.concat(F.col("p_brand"), F.lit(".")).alias("sc_journal_abbr"),
        F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lpad((F.col("p_partkey") % 900).cast("string"), 4, "0"), F.lit("-1111"))).alias("sc_issn"), F.concat(F.lpad((F.col("p_partkey") % 700).cast("string"), 4, "0"), F.lit("2222")).alias("sc_eissn"),
        (F.lit(1990) + F.col("p_size") % 10).cast("int").alias("sc_year"), F.col("p_type").alias("sc_publisher"),
    )


_METRICS = """m AS (SELECT p_partkey AS s, p_partkey % 500 AS id, upper(p_name) AS title, upper(p_brand) AS abbr, CASE WHEN p_partkey % 3 <> 0 THEN lpad((p_partkey % 900)::VARCHAR, 4, '0') || '1111' END AS issn,
  lpad((p_partkey % 700)::VARCHAR, 4, '0') || '2222' AS eissn, (1990 + p_size % 10)::INT AS y, p_type AS publisher FROM part)"""


def _records(spark, sf):
    k, n = F.col("o_orderkey"), F.col("o_custkey")
    issn = F.when(k % 3 == 0, F.concat(F.lpad((n % 900).cast("string"), 4, "0"), F.lit("1111")))
    return t(spark, sf, "orders").select(
        k.alias("seq"), F.concat(F.lit("S"), _s("o_orderkey")).alias("SR"), F.concat(F.lit("BRAND#"), (n % 60).cast("string")).alias("source_title"), F.when(k % 4 != 0, F.concat(F.lit("J"), (k % 9).cast("string"))).alias("journal"), issn.alias("issn"), F.lit(None).cast("string").alias("eissn"),
    )


_RECORDS = """r AS (SELECT o_orderkey AS seq, 'S' || o_orderkey AS sr, 'BRAND#' || (o_custkey % 60) AS st, CASE WHEN o_orderkey % 4 <> 0 THEN 'J' || (o_orderkey % 9) END AS j,
  CASE WHEN o_orderkey % 3 = 0 THEN lpad((o_custkey % 900)::VARCHAR, 4, '0') || '1111' END AS issn FROM orders)"""


@query(f"""WITH {_METRICS}, {_RECORDS}, a AS (SELECT abbr, arg_min(issn, s) FILTER (WHERE issn IS NOT NULL) AS i, arg_min(eissn, s) AS e FROM m GROUP BY 1), b AS (SELECT title, arg_min(issn, s) FILTER (WHERE issn IS NOT NULL) AS i2, arg_min(eissn, s) AS e2 FROM m GROUP BY 1)
SELECT seq, coalesce(issn, i, i2) AS issn, coalesce(e, e2) AS eissn FROM r LEFT JOIN a ON abbr = st LEFT JOIN b ON title = j""")
def fill_issn(spark, sf):
    return journals.fill_issn(_records(spark, sf), _metrics(spark, sf)).select("seq", "issn", "eissn")


@query(f"""WITH {_METRICS}, {_RECORDS}, g AS (SELECT j, st, issn, string_agg(sr, '; ' ORDER BY seq) AS srs FROM r GROUP BY 1, 2, 3),
f AS (SELECT g.*, coalesce((SELECT arg_min(id, s) FROM m WHERE abbr = st), (SELECT arg_min(id, s) FROM m WHERE title = j), (SELECT arg_min(id, s) FROM m WHERE m.issn = g.issn)) AS id FROM g),
n AS (SELECT j, st, issn, row_number() OVER (ORDER BY j NULLS FIRST, st NULLS FIRST, issn NULLS FIRST) AS no FROM f WHERE id IS NULL)
SELECT f.j AS journal, f.st AS source_title, f.issn, srs AS "SR", coalesce(id, -no) AS sourceid FROM f LEFT JOIN n ON f.id IS NULL AND n.j IS NOT DISTINCT FROM f.j AND n.st = f.st AND n.issn IS NOT DISTINCT FROM f.issn""")
def journal_ids(spark, sf):
    return journals.attach_ids(_records(spark, sf), _metrics(spark, sf)).select("journal", "source_title", "issn", "SR", "sourceid")


@query("""WITH x AS (SELECT o_custkey % 200 AS id, o_orderkey AS seq, o_orderpriority AS st, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS j FROM orders),
a AS (SELECT id, st FROM x QUALIFY row_number() OVER (PARTITION BY id ORDER BY length(st), seq) = 1),
b AS (SELECT id, j FROM (SELECT id, j, count(*) AS n, min(seq) AS f FROM x WHERE j IS NOT NULL GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, f) = 1)
SELECT id AS journal_id, st AS source_title, j AS journal FROM a LEFT JOIN b USING (id)""")
def journal_names(spark, sf):
    members = t(spark, sf, "orders").select(
        (F.col("o_custkey") % 200).alias("sourceid"), F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("source_title"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("journal"), _s("o_orderkey").alias("SR")
    )
    return journals.resolve_ids(members.select("sourceid"), members)[0]


@query("""WITH d AS (SELECT p_partkey % 20 AS id, (1992 + p_size % 9)::INT AS y, p_brand || '/' || p_partkey AS pub FROM part QUALIFY row_number() OVER (PARTITION BY p_partkey % 20, p_size % 9 ORDER BY p_partkey) = 1)
SELECT o_orderkey % 30 AS journal_id, 'S' || o_orderkey AS "SR", year(o_orderdate)::INT AS year, pub AS sc_publisher
FROM orders LEFT JOIN d ON id = o_orderkey % 30 AND y = year(o_orderdate)""")
def composite_left_join(spark, sf):
    o = t(spark, sf, "orders")
    sr = F.concat(F.lit("S"), _s("o_orderkey"))
    year = (F.lit(1992) + F.col("p_size") % 9).cast("int")
    metrics = t(spark, sf, "part").select(
        F.col("p_partkey").alias("sc_seq"), (F.col("p_partkey") % 20).cast("string").alias("sc_sourceid"), year.alias("sc_year"), F.concat("p_brand", F.lit("/"), _s("p_partkey")).alias("sc_publisher")
    )
    dates = o.select(F.col("o_orderkey").alias("seq"), sr.alias("SR"), F.concat(F.year("o_orderdate").cast("string"), F.lit(".0")).alias("year"))
    return journals.add_metrics(o.select((F.col("o_orderkey") % 30).alias("journal_id"), sr.alias("SR")), dates, metrics).select("journal_id", "SR", "year", "sc_publisher")


@query("""WITH x AS (SELECT p_partkey AS seq, CASE WHEN p_partkey % 5 <> 0 THEN upper(p_brand) END AS st, CASE WHEN p_partkey % 4 <> 0 THEN upper(p_name) END AS j, CASE WHEN p_partkey % 3 = 0 THEN '0000' || (1000 + p_size)  END AS issn FROM part),
m1 AS (SELECT st, issn AS i FROM (SELECT st, issn, count(*) AS n FROM x WHERE issn IS NOT NULL AND st IS NOT NULL GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY st ORDER BY n DESC, issn) = 1),
y AS (SELECT seq, x.st, j, coalesce(issn, i) AS issn FROM x LEFT JOIN m1 ON m1.st = x.st),
m2 AS (SELECT j, issn AS i FROM (SELECT j, issn, count(*) AS n FROM y WHERE issn IS NOT NULL AND j IS NOT NULL GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY j ORDER BY n DESC, issn) = 1),
z AS (SELECT seq, st, y.j, coalesce(issn, i) AS issn FROM y LEFT JOIN m2 ON m2.j = y.j),
m3 AS (SELECT issn, j AS jm FROM (SELECT issn, j, count(*) AS n FROM z WHERE issn IS NOT NULL AND j IS NOT NULL GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY issn ORDER BY n DESC, j) = 1),
m4 AS (SELECT issn, st AS sm FROM (SELECT issn, st, count(*) AS n FROM z WHERE issn IS NOT NULL AND st IS NOT NULL GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY issn ORDER BY n DESC, st) = 1)
SELECT seq, coalesce(jm, j) AS journal, coalesce(sm, st) AS source_title, z.issn FROM z LEFT JOIN m3 ON m3.issn = z.issn LEFT JOIN m4 ON m4.issn = z.issn""")
def standard_journals(spark, sf):
    k = F.col("p_partkey")
    df = t(spark, sf, "part").select(
        k.alias("seq"), F.when(k % 5 != 0, F.concat(F.col("p_brand"), F.lit("."))).alias("source_title"), F.when(k % 4 != 0, F.concat(F.lit(" "), "p_name")).alias("journal"), F.when(k % 3 == 0, F.concat(F.lit("0000-"), (1000 + F.col("p_size")).cast("string"))).alias("issn"),
        F.lit(None).cast("string").alias("eissn"),
    )
    return journals.standardise(df).select("seq", "journal", "source_title", "issn")


@query("""SELECT p_partkey AS seq, coalesce((SELECT arg_max('AB ' || q.p_brand, q.p_partkey) FROM part q WHERE upper(q.p_name) = upper(p.p_name) AND p.p_partkey % 3 <> 0), '') AS source_title FROM part p""")
def fill_source_title(spark, sf):
    p = t(spark, sf, "part")
    scimago = p.select(F.col("p_partkey").alias("sc_seq"), F.col("p_name").alias("sc_title"), F.concat(F.lit("AB "), "p_brand").alias("sc_journal_abbr"))
    own = p.select(F.col("p_partkey").alias("seq"), F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit(" "), "p_name")).otherwise("0123456789").alias("journal"), F.lit("old").alias("source_title"))
    return journals.fill_source_title(own, scimago).select("seq", "source_title")


# --- articles and merged tables -------------------------------------------------------------------------------------------


def _two_sources(spark, sf):
    o = t(spark, sf, "orders")
    doi = F.when(F.col("o_orderkey") % 4 == 0, "-").when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit("https://doi.org/10.1/X"), (F.col("o_custkey") % 500).cast("string"))).otherwise(F.concat(F.lit("10.1/x"), (F.col("o_custkey") % 500).cast("string")))
    return o.select(F.col("o_orderkey").alias("seq"), F.concat(F.lit("A"), _s("o_orderkey")).alias("SR"), doi.alias("doi"), F.col("o_orderpriority").alias("title"))


_DISTINCT = """(SELECT o_orderkey AS seq, 'A' || o_orderkey AS sr, o_orderpriority AS title, CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey % 500 END AS d FROM orders QUALIFY d IS NULL OR row_number() OVER (PARTITION BY d ORDER BY o_orderkey) = 1)"""


@query(f'SELECT seq, sr AS "SR", title FROM {_DISTINCT}')
def wos_article_table(spark, sf):
    return articles.wos_articles(_two_sources(spark, sf)).select("seq", "SR", "title")


@query(f'SELECT seq, sr AS "SR", title, NULL::VARCHAR AS coden FROM {_DISTINCT}')
def scopus_article_table(spark, sf):
    return articles.scopus_articles(_two_sources(spark, sf)).select("seq", "SR", "title", "coden")


def _primary(spark, sf):
    return t(spark, sf, "orders").select(F.concat(F.lit("S"), _s("o_orderkey")).alias("SR_old"), F.concat(F.lit("W"), _s("o_orderkey")).alias("SR_primary")).withColumn("SR_old", F.when(F.col("SR_old").like("%3"), F.col("SR_old")))


def _author_rows(spark, sf, table, key, source):
    k = F.col(key)
    return t(spark, sf, table).select(
        F.concat(F.lit(source), k.cast("string")).alias("AuthorID"), F.when(k % 3 != 0, F.concat(F.lit("P"), (k % 70).cast("string"))).alias("PersonID"), F.when(k % 4 == 0, F.concat(F.lit("0-"), (k % 60).cast("string"))).alias("Orcid")
    )


_BOTH = """b AS (SELECT 0 AS s, 'W' || c_custkey AS a, CASE WHEN c_custkey % 3 <> 0 THEN 'P' || (c_custkey % 70) END AS p, CASE WHEN c_custkey % 4 = 0 THEN '0-' || (c_custkey % 60) END AS o FROM customer
  UNION ALL SELECT 1, 'S' || s_suppkey, CASE WHEN s_suppkey % 3 <> 0 THEN 'P' || (s_suppkey % 70) END, CASE WHEN s_suppkey % 4 = 0 THEN '0-' || (s_suppkey % 60) END FROM supplier)"""


@query(f"""WITH {_BOTH} SELECT a AS "AuthorID", p AS "PersonID", o AS "Orcid" FROM b QUALIFY row_number() OVER (PARTITION BY coalesce(p, a) ORDER BY o DESC NULLS LAST, s, a) = 1""")
def merged_authors(spark, sf):
    return _merged_authors(spark, sf)[0]


def _merged_authors(spark, sf):
    l = t(spark, sf, "lineitem")
    k = F.col("l_orderkey")

    def side(odd, sr):
        # the other side's rows have no key of their own: they are one more group of unmatched records
        own = F.when(k % 2 == odd, F.concat(*sr))
        return l.select(
            own.alias("SR"), F.lit(None).cast("string").alias("openalex_work_id"), F.concat(F.lit("A"), _s("l_partkey")).alias("AuthorID"), (F.col("l_linenumber") % 3).alias("AuthorOrder"), F.concat(F.lit("P"), (F.col("l_suppkey") % 40).cast("string")).alias("PersonID")
        )

    wos, scopus = side(0, [F.lit("W"), F.floor(k / 10).cast("string")]), side(1, [F.lit("S"), k.cast("string")])
    return merge.merge_authors(_author_rows(spark, sf, "customer", "c_custkey", "W"), _author_rows(spark, sf, "supplier", "s_suppkey", "S"), wos, scopus, _primary(spark, sf))


@query("""WITH x AS (SELECT *, s.s AS s FROM lineitem, (VALUES (0), (1)) s(s)),
l AS (SELECT s, CASE WHEN l_orderkey % 2 <> s THEN NULL WHEN s = 0 THEN 'W' || (l_orderkey // 10) WHEN l_orderkey % 10 = 3 AND EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey) THEN 'W' || l_orderkey ELSE 'S' || l_orderkey END AS sr,
  'P' || (l_suppkey % 40) AS p, l_linenumber % 3 AS n, 'A' || l_partkey AS a FROM x)
SELECT sr AS "SR", p AS "PersonID", n AS "AuthorOrder", arg_min(a, (s, a)) AS "AuthorID" FROM l GROUP BY 1, 2, 3""")
def merged_author_links(spark, sf):
    return _merged_authors(spark, sf)[1].select("SR", "PersonID", "AuthorOrder", "AuthorID")


@query("""WITH x AS (SELECT *, s.s AS s FROM lineitem, (VALUES (0), (1)) s(s)),
l AS (SELECT s, CASE WHEN s = 0 OR l_orderkey % 1000 % 10 = 3 THEN 'W' ELSE 'S' END || (l_orderkey % 1000) AS sr, 'P' || (l_suppkey % 40) AS p, 'U' || (l_linenumber % 3) AS f, 'A' || l_partkey AS a, CASE WHEN s = 0 THEN 'X' ELSE 'Y' END AS c FROM x)
SELECT sr AS "SR", p AS "PersonID", f AS "Affiliation", arg_min(a, (s, a)) AS "AuthorID", arg_min(c, (s, a)) AS "Country" FROM l GROUP BY 1, 2, 3""")
def merged_affiliations(spark, sf):
    l = t(spark, sf, "lineitem")
    k = F.col("l_orderkey") % 1000

    def side(letter, country):
        return l.select(
            F.concat(F.lit(letter), k.cast("string")).alias("SR"), F.concat(F.lit("P"), (F.col("l_suppkey") % 40).cast("string")).alias("PersonID"), F.concat(F.lit("U"), (F.col("l_linenumber") % 3).cast("string")).alias("Affiliation"),
            F.concat(F.lit("A"), _s("l_partkey")).alias("AuthorID"), F.lit(country).alias("Country"),
        )

    primary = l.select(F.when(k % 10 == 3, F.concat(F.lit("S"), k.cast("string"))).alias("SR_old"), F.concat(F.lit("W"), k.cast("string")).alias("SR_primary")).distinct()
    return merge.merge_affiliations(side("W", "X"), side("S", "Y"), primary).select("SR", "PersonID", "Affiliation", "AuthorID", "Country")


@query("""WITH b AS (SELECT 0 AS s, p_partkey AS id, CASE WHEN p_partkey % 3 <> 0 THEN p_name || ' ' || p_brand END AS st, CASE WHEN p_partkey % 2 = 0 THEN 'J ' || p_size END AS j FROM part UNION ALL SELECT 1, CASE WHEN p_partkey % 5 = 0 THEN p_partkey ELSE -p_partkey END, p_name || ' ' || p_brand, NULL FROM part),
a AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY id ORDER BY (st IS NOT NULL)::INT + (j IS NOT NULL)::INT DESC, s) = 1)
SELECT id AS journal_id, st AS source_title, j AS journal FROM a QUALIFY coalesce(st, j) IS NULL OR row_number() OVER (PARTITION BY upper(coalesce(st, j)) ORDER BY (st IS NOT NULL)::INT + (j IS NOT NULL)::INT DESC, s, id) = 1""")
def merged_journals(spark, sf):
    p, k = t(spark, sf, "part"), F.col("p_partkey")
    title = F.concat_ws(" ", "p_name", "p_brand")
    wos = p.select(k.alias("journal_id"), F.when(k % 3 != 0, title).alias("source_title"), F.when(k % 2 == 0, F.concat(F.lit("J "), _s("p_size"))).alias("journal"))
    scopus = p.select(F.when(k % 5 == 0, k).otherwise(-k).alias("journal_id"), title.alias("source_title"), F.lit(None).cast("string").alias("journal"))
    return merge.merge_journals(wos, scopus)


@query("""WITH m AS (SELECT s, p_partkey AS id, s || '/' || p_partkey AS sr, CASE WHEN p_partkey % 3 <> 0 THEN lpad((p_partkey % 90)::VARCHAR, 4, '0') || '-0000' END AS i, CASE WHEN p_partkey % 2 = 0 THEN lpad((p_partkey % 80)::VARCHAR, 4, '0') || '1111' END AS e, p_name AS title,
  CASE WHEN p_size % 5 <> s THEN p_brand || s END AS pub FROM part, (VALUES (0), (1)) t(s)),
k AS (SELECT *, coalesce('I' || i, 'E' || e, 'T' || upper(title)) AS k FROM m)
SELECT id AS journal_id, sr AS "SR", 2000 AS year, i AS sc_issn, e AS sc_eissn, title AS sc_title, pub AS sc_publisher FROM k
QUALIFY row_number() OVER (PARTITION BY k ORDER BY (i IS NOT NULL)::INT + (e IS NOT NULL)::INT + (pub IS NOT NULL)::INT DESC, s, id) = 1""")
def merged_metrics(spark, sf):
    k = F.col("p_partkey")
    four = lambda c: F.lpad(c.cast("string"), 4, "0")

    def side(s):
        return t(spark, sf, "part").select(
            k.alias("journal_id"), F.concat(F.lit(f"{s}/"), _s("p_partkey")).alias("SR"), F.lit(2000).alias("year"), F.when(k % 3 != 0, F.concat(four(k % 90), F.lit("-0000"))).alias("sc_issn"),
            F.when(k % 2 == 0, F.concat(four(k % 80), F.lit("1111"))).alias("sc_eissn"), F.col("p_name").alias("sc_title"), F.when(F.col("p_size") % 5 != s, F.concat("p_brand", F.lit(str(s)))).alias("sc_publisher"),
        )

    return merge.merge_scimago(side(0), side(1))


@query("""WITH k AS (SELECT DISTINCT 'L' || (o_custkey % 30) || ' B, ' || year(o_orderdate) || CASE WHEN o_orderkey % 3 <> 0 THEN ', ' || o_orderpriority ELSE '' END AS sr, CASE WHEN o_orderkey % 2 = 0 THEN 'wos' ELSE 'scopus' END AS source, 'L' || (o_custkey % 30) AS f, year(o_orderdate) AS y, o_orderkey % 3 <> 0 AS j FROM orders),
b AS (SELECT f, y, sr AS best FROM k QUALIFY row_number() OVER (PARTITION BY f, y ORDER BY j DESC, source = 'wos' DESC, length(sr) DESC, sr DESC) = 1)
SELECT DISTINCT sr AS "SR", best AS "SR_canonical" FROM k JOIN b USING (f, y)""")
def canonical_record_keys(spark, sf):
    k = F.col("o_orderkey")
    sr = F.concat(F.lit("L"), (F.col("o_custkey") % 30).cast("string"), F.lit(" B, "), F.year("o_orderdate").cast("string"), F.when(k % 3 != 0, F.concat(F.lit(", "), "o_orderpriority")).otherwise(""))
    keys = t(spark, sf, "orders").select(sr.alias("SR"), F.when(k % 2 == 0, "wos").otherwise("scopus").alias("source")).distinct()
    return merge.canonical_keys(keys).distinct()
