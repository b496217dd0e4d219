import json

import pytest
from pyspark.sql import functions as F

from biblioforge.operators import articles, authors, geo, journals, merge, persons, references
from biblioforge.operators import relational as R
from biblioforge.plans import pipeline
from biblioforge.sources import csv_rows, scopus, tables, wos
from biblioforge.streaming import incremental

WOS = """﻿FN Clarivate Analytics Web of Science
VR 1.0
PT J
AU Muñoz, A
   Øst, B
AF Muñoz, Ana
   Øst, Bo
TI A long
   title
SO Journal of Tests
J9 J TEST
PY 2020
DI 10.1000/ABC.1
SN 1234-5678
C1 [Muñoz, Ana; Øst, Bo] Univ A, Bogota, Colombia; [Øst, Bo] Inst B, Oslo, Norway.
RP Muñoz, A (corresponding author), Univ A, Bogota, Colombia.
EM ana.munoz@a.co; bo@b.no
OI https://orcid.org/0000-0001-0000-0001;
RI Øst, Bo/B-1234-2020
CR Smith J, 1999, J OLD, V1, P2, DOI 10.1000/old.1
   [Anonymous], 2001, BOOK X
ER\x20

PT J
AU Lee, C
TI No year
J9 J TEST
ER
PT J
AU Paz, D
TI Last record
J9 J OTHER
PY 2019
DI 10.1000/def
EF
"""
SCOPUS = """Authors,Author full names,Author(s) ID,Title,Year,Source title,DOI,Affiliations,Authors with affiliations,ISSN,Art. No.
"Muñoz A.; Paz D.","Muñoz, Ana (11); Paz, Dora (22)","11;22","A LONG
title",2020,Journal of Testz,10.1000/abc.1,"Univ A, Bogota, Colombia; X, Lima, Peru","Muñoz A., Univ A, Bogota, Colombia; Paz D., X, Lima, Peru",12345678,7
"Kim E.","Kim, Eun (33)",33,Other,2021,Nowhere,,"Y, Seoul, South Korea","Kim E., Y, Seoul, South Korea",,
"""
SCIMAGO = """Sourceid,Title,journal_abbr,Issn,eIssn,year,SJR,Publisher,Country
100,JOURNAL OF TESTS,J. TEST,12345678,,2020,1.5,Pub,Peru
100,JOURNAL OF TESTS,J. TEST,12345678,,2019,1.4,Pub,Peru
200,OTHER JOURNAL,J OTHER,87654321,,2019,0.5,Pub,Chile
"""
COUNTRY = """Name;Alpha-2;Alpha-3
Colombia;CO;COL
Norway;NO;NOR
Peru;PE;PER
Namibia;NA;NAM
South Korea;KR;KOR
Kosovo;;
"""
WORKS = [
    {"id": "https://openalex.org/W1", "doi": "https://doi.org/10.1000/abc.1", "title": "a", "type": "article", "publication_year": 2020,
     "authorships": [{"author": {"id": "https://openalex.org/A1", "display_name": "Ana Muñoz", "orcid": None}, "institutions": []},
                     {"author": {"id": "https://openalex.org/A2", "display_name": "Bo Øst", "orcid": "https://orcid.org/0000-0002-0000-0002"}, "institutions": [{"display_name": "Inst B", "country_code": "no"}]}],
     "referenced_works": ["https://openalex.org/W2", "https://openalex.org/W3", "https://openalex.org/W9"]},
    {"id": "https://openalex.org/W2", "doi": "https://doi.org/10.1000/old.1", "title": "old", "type": "article", "publication_year": 1999,
     "primary_location": {"source": {"display_name": "J. Old"}}, "authorships": [{"author": {"id": "https://openalex.org/A3", "display_name": "John Smith"}, "institutions": []}],
     "abstract_inverted_index": {"we": [0, 2], "go": [1]}},
    {"id": "https://openalex.org/W3", "doi": None, "title": "a book", "type": "book", "primary_location": {"source": None}},
]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("in")
    (d / "a.txt").write_bytes(WOS.encode())
    (d / "b.txt").write_bytes(WOS.replace("\n", "\r\n").encode())
    (d / "bad.txt").write_text("no header")
    (d / "s.csv").write_text(SCOPUS)
    (d / "scimago.csv").write_text(SCIMAGO)
    (d / "country.csv").write_text(COUNTRY)
    (d / "works.json").write_text("\n".join(map(json.dumps, WORKS)))
    return d


@pytest.fixture(scope="module")
def inputs(spark, files):
    return pipeline.Inputs(tables.read_scimago(spark, str(files / "scimago.csv")), tables.read_countries(spark, str(files / "country.csv")), tables.read_works(spark, str(files / "works.json")))


@pytest.mark.parametrize("name", ["a.txt", "b.txt"])
def test_wos_reader(spark, files, name):
    rows = wos.read_wos(spark, str(files / name)).orderBy("seq").collect()
    assert [r.SR for r in rows] == ["MUNOZ A, 2020, J TEST", "", "PAZ D, 2019, J OTHER"]
    r = rows[0]
    assert (r.author, r.author_full_names, r.title, r.journal) == ("MUNOZ A;OST B", "MUNOZ, ANA;OST, BO", "A LONG TITLE", "Journal of Tests")
    assert r.references == "SMITH J, 1999, J OLD, V1, P2, DOI 10.1000/OLD.1; [ANONYMOUS], 2001, BOOK X"
    assert (r.country, r.source, r.volume) == ("COLOMBIA; NORWAY", "WOS", "")


def test_wos_reader_refuses(spark, files):
    with pytest.raises(Exception, match="no FN and VR header"):
        wos.read_wos(spark, str(files / "bad.txt")).collect()
    with pytest.raises(ValueError):
        wos.read_wos(spark, "x.csv")


def test_scopus_reader(spark, files, inputs):
    raw = scopus.read_scopus(spark, str(files / "s.csv"))
    abbreviations = journals.journal_abbreviations(raw.select("journal"), inputs.scimago)
    rows = scopus.read_scopus(spark, str(files / "s.csv"), abbreviations).orderBy("year").collect()
    assert [r.SR for r in rows] == ["MUNOZ A, 2020, J TEST", "KIM E, 2021"]
    assert (rows[0].title, rows[0].source_title, rows[0].country, rows[0].article_number) == ("A LONG\nTITLE", "J TEST", "COLOMBIA; PERU", "7")


def test_references_and_works(spark, files, inputs):
    main = wos.read_wos(spark, str(files / "a.txt"))
    refs, edges = references.wos_references(main)
    assert {(r.SR, r.SR_ref) for r in edges.collect()} == {("MUNOZ A, 2020, J TEST", "SMITH J, 1999, J OLD"), ("MUNOZ A, 2020, J TEST", "ANONYMOUS, 2001, BOOK X")}
    rich = {r.SR_ref: r for r in references.enrich_references(refs, inputs.works).collect()}
    assert rich["SMITH J, 1999, J OLD"].work_abstract == "we go we" and rich["ANONYMOUS, 2001, BOOK X"].work_title is None
    merged = references.merge_wos_references(main, refs)
    assert merged.count() == 5 and merged.where("NOT ismainarticle").count() == 2
    found, books = references.referenced_works(main, inputs.works)
    assert {r.work_id: r.SR_ref for r in found.collect()} == {"W2": "SMITH J, 1999, J OLD", "W9": None} and [r.work_id for r in books.collect()] == ["W3"]
    assert references.scopus_citations(found).count() == 1
    enriched = {r.SR: r for r in references.enrich_with_works(main, inputs.works).collect()}
    assert enriched["MUNOZ A, 2020, J TEST"].orcid == "NO ORCID; https://orcid.org/0000-0002-0000-0002"
    assert enriched["PAZ D, 2019, J OTHER"].orcid == ""


def test_authors(spark, files):
    rows = {r.AuthorName: r for r in authors.wos_authors(wos.read_wos(spark, str(files / "a.txt"))).collect()}
    a, b = rows["MUNOZ A"], rows["OST B"]
    assert (a.AuthorOrder, a.AuthorFullName, a.Affiliation, a.CorrespondingAuthor, a.Email) == (1, "MUNOZ, ANA", "UNIV A, BOGOTA, COLOMBIA", True, "ANA.MUNOZ@A.CO")
    assert (b.AuthorOrder, b.Affiliations, b.CorrespondingAuthor, b.Orcid, b.ResearcherID) == (2, ["UNIV A, BOGOTA, COLOMBIA", "INST B, OSLO, NORWAY."], False, None, "B-1234-2020")
    s = {r.AuthorName: r for r in authors.scopus_authors(scopus.read_scopus(spark, str(files / "s.csv"))).collect()}
    assert (s["PAZ D."].AuthorFullName, s["PAZ D."].Affiliation, s["PAZ D."].ResearcherID, s["PAZ D."].scopus_author_id) == ("PAZ, DORA", "X, LIMA, PERU", "22", "22")


def test_journals(spark, files, inputs):
    df = spark.createDataFrame(
        [(1, "A", "Journal of Tests", "J. Test", None, None, True), (2, "B", "JOURNAL OF TESTS", "J TEST", None, None, False), (3, "C", "UNKNOWN", "UNK", None, None, True)],
        "seq long, SR string, journal string, source_title string, issn string, eissn string, ismainarticle boolean",
    )
    clean = journals.fill_issn(journals.standardise(df), inputs.scimago)
    assert {(r.SR, r.issn) for r in clean.collect()} == {("A", "12345678"), ("B", "12345678"), ("C", None)}
    found = {r.journal: (r.SR, r.sourceid) for r in journals.attach_ids(clean, inputs.scimago).collect()}
    assert found == {"JOURNAL OF TESTS": ("A; B", 100), "UNKNOWN": ("C", -1)}
    filled = {r.SR: r.source_title for r in journals.fill_source_title(df, inputs.scimago).collect()}
    assert filled == {"A": "J. TEST", "B": "J. TEST", "C": ""}


def test_persons(spark):
    rows = [("1", "A A", "LOPEZ, ANA", "0-1", None, "a@x"), ("2", "A A", "LOPEZ, ANA", None, None, "a@x"), ("3", "A A", "LOPEZ, ANA", None, None, None), ("4", "B", "KIM, B", None, "a9", None)]
    df = spark.createDataFrame([(*r, None) for r in rows], "AuthorID string, AuthorName string, AuthorFullName string, Orcid string, OpenAlexAuthorID string, Email string, scopus_author_id string")
    person, alias, clash = persons.consolidate(df)
    assert {r.AuthorID: r.PersonID for r in alias.collect()} == {"1": "ORCID:0-1", "2": "ORCID:0-1", "3": "ORCID:0-1", "4": "OA:A9"}
    assert {r.PersonID: r.AliasCount for r in person.collect()} == {"ORCID:0-1": 3, "OA:A9": 1} and clash.count() == 0


def test_merge_pairs_by_rank(spark):
    schema = "seq long, SR string, doi string, year string, ismainarticle boolean, issn string"
    w = spark.createDataFrame([(1, "W1", "10.1/D", "2020.0", True, None), (2, "W2", "10.1/d", "2020", True, None), (3, "W3", None, None, True, None)], schema)
    s = spark.createDataFrame([(1, "S1", "https://doi.org/10.1/d", "2021", True, "1"), (2, "S2", " ", None, False, None)], schema)
    out, primary = merge.merge_articles(w, s)
    assert {(r.SR, r.sources_merged) for r in out.collect()} == {("W1", "wos;scopus"), ("W2", "wos"), ("W3", "wos"), ("S2", "scopus")}
    assert [tuple(r) for r in primary.collect()] == [("S1", "W1")]
    filled, _ = merge.merge_articles(w, s, coalesce_fields=True)
    assert {r.SR: r.issn for r in filled.collect()}["W1"] == "1"
    edges = spark.createDataFrame([("S1", "SMITH J, 1999.0,  X"), ("S1", "-"), ("1999", "A, 1")], "SR string, SR_ref string")
    assert [tuple(r) for r in merge.merge_citations(edges.limit(0), edges, primary).collect()] == [("W1", "SMITH J, 1999, X")]
    keys = spark.createDataFrame([("SMITH J, 1999", "scopus"), ("SMITH J, 1999, J OLD", "wos")], "SR string, source string")
    assert {r.SR_canonical for r in merge.canonical_keys(keys).collect()} == {"SMITH J, 1999, J OLD"}


def test_duplicates_and_columns(spark):
    df = spark.createDataFrame([(1, "10.1", "A"), (2, "10.1", "A"), (3, None, None), (4, None, None)], "seq long, doi string, title string")
    out, removed = R.remove_duplicates(df)
    assert removed == 1 and sorted(r.seq for r in out.collect()) == [1, 3, 4]
    with pytest.raises(ValueError):
        R.remove_duplicates(df.drop("doi"))
    assert R.first_columns(df.select("seq", "doi", F.col("seq").alias("SEQ"))).columns == ["seq", "doi"]
    assert sorted(r.seq for r in articles.distinct_by_doi(df.withColumn("doi", F.upper("doi"))).collect()) == [1, 3, 4]
    assert {(r.g, r.v) for r in R.mode_by(spark.createDataFrame([(1, 1, "b"), (2, 1, "a"), (3, 1, "a"), (4, 1, "b")], "s long, g int, v string"), "g", "v", "s").collect()} == {(1, "b")}


def test_affiliation_countries(spark, inputs):
    df = geo.fill_missing_affiliations(spark.createDataFrame([("Univ, Windhoek, NA",), (" ",), ("Pristina, Kosovo",), (None,)], "Affiliation string"))
    assert sorted(r.Country for r in geo.extract_countries(df, inputs.countries).collect()) == ["KOSOVO", "NAMIBIA", "NO COUNTRY", "NO COUNTRY"]


def test_whole_pipeline(spark, files, tmp_path):
    paths = {"path_scimago": str(files / "scimago.csv"), "path_country": str(files / "country.csv"), "path_works": str(files / "works.json")}
    written = pipeline.preprocess(spark, str(tmp_path), str(files / "a.txt"), str(files / "s.csv"), **paths)
    assert set(written) == {"wos", "scopus", "all"} and len(written["all"]) == 7
    articles_ = spark.read.parquet(written["all"]["Article"])
    assert articles_.where("sources_merged = 'wos;scopus'").count() >= 1
    wos_n, scopus_n = (spark.read.parquet(written[s]["Article"]).count() for s in ("wos", "scopus"))
    assert articles_.count() == wos_n + scopus_n - articles_.where("sources_merged = 'wos;scopus'").count()
    person = spark.read.parquet(written["wos"]["AuthorPerson"])
    assert person.count() == person.select("PersonID").distinct().count()
    # the same merge from CSV folders, to CSV
    for side in ("wos", "scopus"):
        for name, path in written[side].items():
            tables.write_entity(spark.read.parquet(path), str(tmp_path / "csv" / side), name, "csv")
    merged = pipeline.merge_folders(spark, str(tmp_path / "csv" / "wos"), str(tmp_path / "csv" / "scopus"), str(tmp_path / "csv" / "all"), "csv")
    assert set(merged) == set(tables.ENTITY_COLUMNS) and all(p.endswith(".csv") for p in merged.values())
    for name, column in (("Article", "SR"), ("Citation", "SR_ref"), ("ArticleAuthor", "AuthorID"), ("Journal", "journal_id")):
        csv, parquet = (sorted(str(r[0] or "") for r in tables.read_entity(spark, str(folder), f"All_{name}").select(column).collect()) for folder in (tmp_path / "csv" / "all", tmp_path / "all"))
        assert csv == parquet, name
    tables.write_entity(spark.read.parquet(written["wos"]["Article"]), str(tmp_path), "Article", "csv")
    assert tables.read_entity(spark, str(tmp_path), "Citation").count() == 0


def test_stream_keeps_the_first(spark, tmp_path):
    schema = "seq long, doi string, at timestamp"
    rows = [(1, "10.1/A"), (2, "https://doi.org/10.1/a"), (3, None), (4, None)]
    spark.createDataFrame(rows, "seq long, doi string").withColumn("at", F.timestamp_seconds(F.col("seq"))).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = incremental.first_by_doi(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "at")
    q = stream.writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.seq for r in spark.table("firsts").collect()) == [1, 3, 4]


def test_rows_of_several_files_keep_their_order(spark, tmp_path):
    # the planner takes larger files first
    for i, rows in enumerate((3, 40, 7)):
        (tmp_path / f"f{i}.csv").write_text("k,t\n" + "".join(f'{i * 100 + j},"a\nb"\n' for j in range(rows)))
    got = [int(r.k) for r in csv_rows.read_csv(spark, str(tmp_path)).orderBy("seq").collect()]
    assert got == [i * 100 + j for i, rows in enumerate((3, 40, 7)) for j in range(rows)]


def test_citations_are_cleaned_in_one_pass(spark):
    """Edges are shuffled once, to be made distinct; joins on cleaned keys shuffled them three times more."""
    edges = spark.createDataFrame([("A1, 2001, J", "B, 1999 , K"), ("A1,2001.0,J", "b, 1999, K"), ("-", "C, 1, D"), ("A2", "1999"), ("A3", None), (None, "D, 1999")], "SR string, SR_ref string")
    primary = spark.createDataFrame([], "SR_old string, SR_primary string")
    out = merge.merge_citations(edges, edges, primary)
    assert {tuple(r) for r in out.collect()} == {("A1, 2001, J", "B, 1999, K")}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
