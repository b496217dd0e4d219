"""Parsers of references, addresses, names and work records as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .identifiers import cleaned_reference_author, matching_name, standard_fullname
from .text import _c, ascii_upper, blank_to_null, split_list

# Spellings of countries in addresses.
COUNTRY_SYNONYMS = {
    "USA": "UNITED STATES", "U S A": "UNITED STATES", "UNITED STATES OF AMERICA": "UNITED STATES",
    "U ARAB EMIR": "UNITED ARAB EMIRATES", "UNITED ARAB EMIR": "UNITED ARAB EMIRATES",
    "PEOPLES R CHINA": "CHINA", "PEOPLES REPUBLIC OF CHINA": "CHINA", "P R CHINA": "CHINA",
    "ENGLAND": "UNITED KINGDOM", "SCOTLAND": "UNITED KINGDOM", "WALES": "UNITED KINGDOM", "NORTHERN IRELAND": "UNITED KINGDOM",
}
# Fixed value: the shape of a DOI inside free text.
DOI = r"(?i)\b10\.\d{4,9}/[-._;()/:A-Z0-9]+\b"


def part(x: Column | str, i: int, separator: str = ",") -> Column:
    """The i-th (from 0) trimmed, non-blank part of a delimited text, else NULL."""
    return blank_to_null(F.trim(F.get(F.split(_c(x), separator), F.lit(i))))


def reference_author(x: Column | str) -> Column:
    """Text before the first comma, or all of it, cleaned."""
    return cleaned_reference_author(F.substring_index(F.trim(_c(x)), ",", 1))


def reference_year(x: Column | str) -> Column:
    """The first year outside the DOI, whose suffix may look like one."""
    return blank_to_null(F.regexp_extract(F.regexp_replace(_c(x), DOI, ""), r"\b(?:19|20)\d{2}\b", 0))


def reference_journal(x: Column | str) -> Column:
    """The third comma part if a year is known, else the second."""
    return F.when(reference_year(x).isNotNull(), part(x, 2)).otherwise(part(x, 1))


def reference_doi(x: Column | str) -> Column:
    return blank_to_null(F.lower(F.regexp_extract(_c(x), DOI, 0)))


def before_first_comma(x: Column | str) -> Column:
    return F.trim(F.substring_index(_c(x), ",", 1))


def after_last_comma(x: Column | str) -> Column:
    x = _c(x)
    return F.when(F.contains(x, F.lit(",")), F.trim(F.substring_index(x, ",", -1))).otherwise("")


def country_of_segment(x: Column) -> Column:
    """Country at the end of one address: USA suffix, then synonyms of the tail and of its last word, else the tail; blank is NULL."""
    tail = F.regexp_replace(F.rtrim(F.regexp_replace(ascii_upper(F.substring_index(x, ",", -1)), r"\.+$", "")), r"\s+", " ")
    name = F.coalesce(blank_to_null(F.trim(F.regexp_extract(tail, r"([A-Z][A-Z ]+)$", 1))), blank_to_null(tail))
    words = F.split(name, " ")
    last = F.get(words, F.size(words) - 1)
    known = F.create_map(*[F.lit(v) for kv in COUNTRY_SYNONYMS.items() for v in kv])
    return F.when(tail.rlike(r"\bUSA$"), F.lit("UNITED STATES")).otherwise(F.coalesce(F.try_element_at(known, name), F.try_element_at(known, last), name))


def address_countries(x: Column | str, bracketed: bool = False) -> Column:
    """Countries of all addresses in order, repeats kept. bracketed: '[names] address' blocks, if there are any."""
    x = F.trim(_c(x))
    plain = F.filter(F.split(x, ";"), lambda s: F.trim(s) != "")
    if bracketed:
        blocks = F.regexp_extract_all(x, F.lit(r"\[[^\]]+\][^;]*"), F.lit(0))
        plain = F.when(F.size(blocks) > 0, blocks).otherwise(plain)
    return F.filter(F.transform(plain, country_of_segment), lambda c: c.isNotNull())


def last_pieces(x: Column | str) -> Column:
    """Upper-cased text after the last comma of each ';' part, joined."""
    return F.array_join(F.transform(split_list(x), lambda s: F.upper(F.trim(F.substring_index(s, ",", -1)))), "; ")


def bracketed_affiliations(x: Column | str) -> Column:
    """'[A; B] address; [C] address' -> array of (name, affiliation), one per name."""
    x = _c(x)
    pattern = r"\[([^\]]+)\]\s*([^\[]*)"
    pairs = F.arrays_zip(F.regexp_extract_all(x, F.lit(pattern), F.lit(1)).alias("names"), F.regexp_extract_all(x, F.lit(pattern), F.lit(2)).alias("address"))
    return F.flatten(
        F.transform(
            pairs,
            lambda p: F.transform(split_list(p["names"]), lambda n: F.struct(standard_fullname(n).alias("name"), F.trim(p["address"], F.lit("; ")).alias("affiliation"))),
        )
    )


def affiliations_of(name: Column | str, pairs: Column | str) -> Column:
    """All affiliations in pairs whose name matches, in order; the first is the primary one."""
    key = matching_name(name)
    return F.transform(F.filter(_c(pairs), lambda p: matching_name(p["name"]) == key), lambda p: p["affiliation"])


def corresponding_author(x: Column | str) -> Column:
    """Name before the first bracket, or before the first comma, of a reprint address."""
    x = F.trim(_c(x))
    before = blank_to_null(F.trim(F.regexp_extract(x, r"^(.+?)\s*\(", 1)))
    return standard_fullname(F.coalesce(before, blank_to_null(F.trim(F.regexp_extract(x, r"^([^,]+)", 1)))))


def positional(x: Column | str, i: Column | int, separator: str = ";") -> Column:
    """The i-th (from 0) entry of a delimited text, blank entries counted; blank is NULL."""
    return blank_to_null(F.trim(F.get(F.split(_c(x), separator), i if isinstance(i, Column) else F.lit(i))))


def researcher_ids(x: Column | str) -> Column:
    """'NAME/ID; NAME/ID' -> array of (name, id)."""
    items = F.filter(split_list(x), lambda i: F.contains(i, F.lit("/")))
    return F.transform(items, lambda i: F.struct(matching_name(F.substring_index(i, "/", 1)).alias("name"), F.trim(F.substring_index(i, "/", -1)).alias("id")))


def emails(x: Column | str) -> Column:
    return split_list(F.replace(_c(x), F.lit(";;"), F.lit(";")))


def orcid_urls(x: Column | str) -> Column:
    """ORCIDs by position: an entry without one is NULL, so later authors keep theirs."""
    return F.transform(F.split(_c(x), ";"), lambda i: blank_to_null(F.upper(F.regexp_extract(F.lower(i), r"orcid\.org/(\d{4}-\d{4}-\d{4}-\d{3}[\dx])", 1))))


def name_without_id(x: Column) -> Column:
    return F.coalesce(blank_to_null(F.trim(F.regexp_extract(x, r"^([^(]+)\s*\(\d+\)", 1))), F.trim(x))


def id_of_name(x: Column) -> Column:
    return blank_to_null(F.regexp_extract(x, r"\((\d+)\)", 1))


def first_containing(name: Column, keys: Column, value: str) -> Column:
    """value of the first struct in keys whose name contains the name or lies in it; blank names match nothing."""
    found = F.filter(keys, lambda k: (k["name"] != "") & (name != "") & (F.contains(k["name"], name) | F.contains(name, k["name"])))
    return F.get(F.transform(found, lambda k: k[value]), F.lit(0))


def abstract_from_index(x: Column | str) -> Column:
    """Words of a map word -> positions, in order of position."""
    pairs = F.flatten(F.transform(F.map_entries(_c(x)), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("k")))))
    return F.when(_c(x).isNotNull(), F.array_join(F.transform(F.array_sort(pairs), lambda s: s["k"]), " "))


WORK_SCHEMA = """id string, doi string, title string, type string, publication_year int, cited_by_count int,
biblio struct<volume: string, issue: string, first_page: string, last_page: string>,
primary_location struct<source: struct<display_name: string>>,
authorships array<struct<author: struct<id: string, display_name: string, orcid: string>, institutions: array<struct<display_name: string, country_code: string>>>>,
keywords array<struct<display_name: string>>, abstract_inverted_index map<string, array<int>>, referenced_works array<string>"""


def work_columns(w: str | None = None) -> dict[str, Column]:
    """Flat columns of a work record (columns of WORK_SCHEMA, or fields of the struct column w)."""
    c = (lambda n: F.col(f"{w}.{n}")) if w else F.col
    people = F.filter(c("authorships"), lambda a: F.trim(a["author"]["display_name"]) != "")

    def short(name):
        words = F.split(F.trim(name), r"\s+")
        n = F.size(words)
        return F.when(n >= 2, F.concat(F.upper(F.get(words, n - 1)), F.lit(" "), F.upper(F.left(F.get(words, F.lit(0)), F.lit(1))), F.lit("."))).otherwise(F.upper(name))

    def place(a):
        named = F.filter(a["institutions"], lambda i: i["display_name"].isNotNull())
        texts = F.transform(named, lambda i: F.concat_ws(", ", i["display_name"], F.upper(i["country_code"])))
        return F.coalesce(blank_to_null(F.array_join(texts, "; ")), F.lit("NO AFFILIATION"))

    return {
        "title": c("title"),
        "doi": F.replace(c("doi"), F.lit("https://doi.org/"), F.lit("")),
        "journal": c("primary_location.source.display_name"),
        "volume": c("biblio.volume"),
        "issue": c("biblio.issue"),
        "page": c("biblio.first_page"),
        "abstract": abstract_from_index(c("abstract_inverted_index")),
        "year": c("publication_year"),
        "authors": blank_to_null(F.array_join(F.transform(people, lambda a: a["author"]["display_name"]), "; ")),
        "authors_with_affiliations": blank_to_null(F.array_join(F.transform(people, lambda a: F.concat_ws(", ", short(a["author"]["display_name"]), place(a))), "; ")),
        "orcid": F.transform(people, lambda a: a["author"]["orcid"]),
        "author_id_openalex": F.transform(people, lambda a: F.substring_index(a["author"]["id"], "/", -1)),
        "affiliation_lists": F.transform(people, lambda a: F.transform(a["institutions"], lambda i: i["display_name"])),
        "cited_by": c("cited_by_count"),
        "author_keywords": blank_to_null(F.array_join(F.transform(F.filter(c("keywords"), lambda k: k["display_name"].isNotNull()), lambda k: k["display_name"]), "; ")),
    }


def scopus_reference(x: Column | str) -> dict[str, Column]:
    """Grammar of references with the year in brackets, after the authors or after the title."""
    x = _c(x)
    upper = F.upper(x)
    url = upper.rlike(r"^(?!.*DOI\.ORG).*HTTPS://")
    early = x.rlike(r",\s*\(\d{4}\)")
    kind = (
        F.when(url, 5).when(early & upper.rlike("PROCEEDINGS OF.*CONFERENCE|INTERNATIONAL CONFERENCE"), 4)
        .when(early & ~F.contains(x, F.lit("PP.")), 2).when(early, 3).when(x.isNotNull(), 1)
    )
    after = blank_to_null(F.trim(F.regexp_extract(x, r"^[^)]*\)(.*)$", 1)))
    year = blank_to_null(F.regexp_extract(x, r"\((\d{4})\)", 1))
    authors = F.when(kind == 1, F.regexp_extract(x, r"^(.*?),", 1)).when(kind != 5, F.regexp_extract(x, r"^(.*?),\s*\(\d{4}\)", 1))
    title = F.when(kind == 1, F.trim(F.substring_index(F.regexp_replace(x, r"\(\d{4}\).*$", ""), ",", -1))).when(kind != 5, F.trim(F.substring_index(after, ",", 1)))
    commas = F.length(x) - F.length(F.replace(x, F.lit(","), F.lit("")))
    journal = F.when(kind == 1, F.trim(F.substring_index(after, ",", 1))).when((kind != 5) & (commas > 1), after_last_comma(x))
    authors, title, journal = (blank_to_null(F.trim(c)) for c in (authors, title, journal))
    year = F.when(kind != 5, year)
    key = F.when(authors.isNotNull() & year.isNotNull() & journal.isNotNull(), F.concat_ws(", ", before_first_comma(authors), year, journal))
    return {"SR_ref": key, "title": title, "authors": authors, "journal": journal, "year": year, "CR_ref": x, "ref_type": kind}


# Fixed value: 'SURNAME A.B.' as one comma part of a reference.
AUTHOR_PART = r"^[A-Z][A-Za-z'\-]+\s+(?:[A-Z]\.?)+$"
AUTHOR_BLOCK = r"^((?:[A-Z][A-Za-z'’\-]*(?:\s+[A-Z][A-Za-z'’\-]*)*\s+[A-Z][A-Z.\-]*,\s*)+)"


def _stepwise(x: Column, *steps: Callable[[Column], Column]) -> Column:
    """x taken through the steps one after another. A step may use its value often and still has it computed once; written out as one
    expression, the value would stand there, and be computed, for every use."""
    for step in steps:
        x = F.get(F.transform(F.array(x), step), F.lit(0))
    return x


def scopus_reference_fields(x: Column | str, countries: list[str]) -> dict[str, Column]:
    """Grammar of references that begin with 'SURNAME A.B.' parts: authors, doi, year, pages, volume, journal, title."""
    known = [c.upper() for c in countries]
    named = lambda **columns: F.struct(*[c.alias(n) for n, c in columns.items()])

    def stop(parts):
        hits = F.transform(parts, lambda p: p.rlike(AUTHOR_PART))
        return named(parts=parts, stop=F.array_position(hits, F.lit(False)).cast("int"))

    def split(s):
        parts, stop = s["parts"], s["stop"]
        # no stop: every part is an author, and the last one is left out; a stop at once: the first part is taken as it is
        n = F.when(stop == 0, F.size(parts) - 1).when(stop == 1, F.lit(1)).otherwise(stop - 1)
        rest_from = F.when(stop == 0, F.size(parts) + 1).when(stop == 1, F.lit(2)).otherwise(stop)
        return named(authors=F.array_join(F.slice(parts, F.lit(1), F.greatest(n, F.lit(0))), ";"), rest=F.array_join(F.slice(parts, rest_from, F.size(parts)), ", "))

    def find_doi(s):
        labelled = F.regexp_extract(s["rest"], r"(?i)DOI:\s*(10\.\S+)", 1)
        return named(authors=s["authors"], rest=s["rest"], raw=F.when(labelled != "", labelled).otherwise(F.regexp_extract(s["rest"], r"(10\.\S+)", 1)))

    def cut_doi(s):
        rest, raw = s["rest"], s["raw"]
        rest = F.trim(F.regexp_replace(F.when(raw != "", F.replace(rest, raw, F.lit(""))).otherwise(rest), r"(?i)DOI:\s*", ""), F.lit(" ,."))
        doi = F.rtrim(F.regexp_replace(F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw), r"[.,]+$", ""))
        return named(authors=s["authors"], doi=doi, rest=rest)

    def find_year(s):
        bare = F.regexp_extract(s["rest"], r"\b(\d{4})\b", 1)
        return named(authors=s["authors"], doi=s["doi"], rest=s["rest"], bracketed=F.regexp_extract(s["rest"], r"\((\d{4})\)", 1), bare=F.when(bare.try_cast("int").between(1800, 2030), bare))

    def cut_year(s):
        rest, bracketed, bare = s["rest"], s["bracketed"], s["bare"]
        rest = F.when(bracketed != "", F.regexp_replace(rest, r"\(\d{4}\)", "")).when(bare.isNotNull(), F.replace(rest, bare, F.lit(""))).otherwise(rest)
        return named(authors=s["authors"], doi=s["doi"], year=F.coalesce(blank_to_null(bracketed), bare), rest=rest)

    def cut_pages(s):
        pieces = F.split(F.regexp_replace(s["rest"], r"PP\.\s*[\d\-–]+", ""), ",")
        return named(
            authors=s["authors"], doi=s["doi"], year=s["year"], pages=F.regexp_extract(s["rest"], r"PP\.\s*([\d\-–]+)", 1),
            pieces=F.filter(F.transform(pieces, lambda p: F.trim(p, F.lit(" ."))), lambda p: p != ""),
        )

    def find_journal(s):
        tail = F.transform(s["pieces"], lambda p: p.rlike(r"^\d+([\-–]\d+)?$") | F.upper(p).isin(*known))
        # the journal is the last piece that is neither a number nor a country
        keep = F.coalesce(F.array_max(F.transform(tail, lambda t, i: F.when(~t, i + 1))), F.lit(0))
        return named(authors=s["authors"], doi=s["doi"], year=s["year"], pages=s["pages"], pieces=s["pieces"], keep=keep)

    def lists(s):
        pieces, keep = s["pieces"], s["keep"]
        numbers = F.filter(F.slice(pieces, keep + 1, F.greatest(F.size(pieces) - keep, F.lit(0))), lambda p: p.rlike(r"^\d+([\-–]\d+)?$"))
        titles = F.filter(F.slice(pieces, F.lit(1), F.greatest(keep - 1, F.lit(0))), lambda p: ((F.upper(p) == p) & p.rlike("[A-Z]")) | F.contains(p, F.lit(":")))
        return named(
            authors=s["authors"], doi=s["doi"], year=s["year"], pages=s["pages"], numbers=numbers, title=F.array_join(titles, ", "), source_title=F.get(pieces, keep - 1)
        )

    def fields(s):
        return named(
            author=blank_to_null(s["authors"]), title=blank_to_null(s["title"]), source_title=s["source_title"], year=s["year"],
            volume=F.get(s["numbers"], F.size(s["numbers"]) - 1), pages=blank_to_null(s["pages"]), doi=blank_to_null(s["doi"]),
        )

    parts = F.transform(F.split(_c(x), ","), lambda p: F.trim(p))
    found = _stepwise(parts, stop, split, find_doi, cut_doi, find_year, cut_year, cut_pages, find_journal, lists, fields)
    return {n: found[n] for n in ("author", "title", "source_title", "year", "volume", "pages", "doi")}


def split_authors_title(x: Column | str) -> tuple[Column, Column]:
    """(authors, title) of a text that begins with author blocks."""
    x = F.trim(_c(x))
    block = F.regexp_extract(x, AUTHOR_BLOCK, 1)
    title = F.trim(F.when(block != "", F.substring(x, F.length(block) + F.lit(1), F.length(x))).otherwise(x))
    return F.array_join(split_list(block, ","), ", "), F.trim(F.regexp_replace(title, AUTHOR_BLOCK, ""))
