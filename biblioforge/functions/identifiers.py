"""DOI, ISSN, ORCID, author and record keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, blank_to_null, fold_upper, or_text, strip_blank

# Names that stand for no author.
PLACEHOLDER_NAMES = ("NO, NAME", "NO NAME", "NO N", "NO, AUTHOR", "NO A")
ANONYMOUS = "ANONYMOUS"


def normalize_doi(x: Column | str) -> Column:
    """Lower case, without resolver, landing-page suffix, blanks and outer dots; blank is NULL."""
    out = F.regexp_replace(F.lower(F.trim(_c(x))), r"^https?://(?:dx\.)?doi\.org/", "")
    out = F.regexp_replace(out, r"/(?:full|pdf|html).*$", "")
    return blank_to_null(F.trim(out, F.lit(" .")))


def clean_doi(x: Column | str) -> Column:
    """Trimmed, without the https resolver; blank and '-' are NULL; case stays."""
    out = F.trim(_c(x))
    return F.replace(F.when(~out.isin("", "-"), out), F.lit("https://doi.org/"), F.lit(""))


def normalize_issn(x: Column | str) -> Column:
    """NNNN-NNNN from exactly eight digits, else NULL."""
    digits = F.regexp_replace(_c(x), "[^0-9]", "")
    return F.when(F.length(digits) == 8, F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 4)))


def normalize_orcid(x: Column | str) -> Column:
    text = F.trim(_c(x))
    return blank_to_null(F.when(F.upper(text) != "NO ORCID", F.upper(F.substring_index(text, "/", -1))))


def short_openalex(x: Column | str) -> Column:
    return blank_to_null(F.upper(F.substring_index(F.trim(_c(x)), "/", -1)))


def scopus_author_id(x: Column | str) -> Column:
    """The first listed id if it is all digits."""
    first = F.trim(F.substring_index(_c(x), ";", 1))
    return F.when(first.rlike("^[0-9]+$"), first)


def _words(x: Column, pattern: str = r"\s+") -> Column:
    return F.filter(F.split(x, pattern), lambda w: w != "")


def _initials(x: Column, pattern: str = r"\s+") -> Column:
    return F.array_join(F.transform(_words(x, pattern), lambda w: F.left(w, F.lit(1))), "")


def name_key(x: Column | str) -> Column:
    """FAMILY|INITIALS of 'Family, Given' or 'Given Family'; hyphens of the family become blanks; no name gives NULL."""
    name = fold_upper(x)
    comma = F.contains(name, F.lit(","))
    words = _words(name)
    family = F.when(comma, F.trim(F.substring_index(name, ",", 1))).otherwise(F.get(words, F.size(words) - 1))
    given = F.when(comma, F.substring(name, F.instr(name, ",") + F.lit(1), F.length(name))).otherwise(F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), " "))
    family = F.trim(F.regexp_replace(F.replace(family, F.lit("-"), F.lit(" ")), r"\s+", " "))
    return F.when(F.coalesce(name, F.lit("")) != "", F.concat(family, F.lit("|"), _initials(given, r"[-\s.]+")))


def _unquoted(x: Column | str) -> Column:
    return F.trim(F.translate(_c(x), "“”", ""))


def standard_fullname(x: Column | str) -> Column:
    """'LAST FIRST' becomes 'LAST, FIRST'; names with a comma, single words and placeholders stay."""
    name = _unquoted(x)
    keep = F.contains(name, F.lit(",")) | F.upper(name).isin(*PLACEHOLDER_NAMES, ANONYMOUS)
    return F.when(keep, name).otherwise(F.regexp_replace(name, r"^(\S+)\s+(.+)$", "$1, $2"))


def abbreviated_name(x: Column | str) -> Column:
    """'LAST, A B' and 'LAST A B' become 'LAST AB'; placeholders become ANONYMOUS; blank is NULL."""
    name = blank_to_null(_unquoted(x))
    comma = F.contains(name, F.lit(","))
    last = F.when(comma, F.trim(F.substring_index(name, ",", 1))).otherwise(F.regexp_extract(name, r"^(\S+)", 1))
    rest = F.when(comma, F.substring(name, F.instr(name, ",") + F.lit(1), F.length(name))).otherwise(F.regexp_replace(name, r"^\S+\s*", ""))
    return F.when(F.upper(name).isin(*PLACEHOLDER_NAMES), F.lit(ANONYMOUS)).otherwise(F.concat_ws(" ", last, _initials(rest)))


def matching_name(x: Column | str) -> Column:
    return F.regexp_replace(strip_blank(F.lower(F.replace(_c(x), F.lit(","), F.lit("")))), r"\s+", " ")


def last_first_initial(x: Column | str) -> Column:
    """'last f' key of a name in either form; blank is NULL."""
    name = F.lower(blank_to_null(_unquoted(x)))
    comma = F.contains(name, F.lit(","))
    last = F.when(comma, F.trim(F.substring_index(name, ",", 1))).otherwise(F.regexp_extract(name, r"^(\S+)", 1))
    rest = F.when(comma, F.trim(F.substring(name, F.instr(name, ",") + F.lit(1), F.length(name)))).otherwise(F.regexp_replace(name, r"^\S+\s*", ""))
    return F.concat(last, F.lit(" "), F.left(rest, F.lit(1)))


def author_from_fullname(x: Column | str) -> Column:
    """'FIRST M LAST' becomes 'LAST F.M.'; one word stays."""
    words = _words(F.trim(_c(x)))
    n = F.size(words)
    initials = F.array_join(F.transform(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lit("."))), "")
    return F.when(n >= 2, F.concat_ws(" ", F.get(words, n - 1), initials)).otherwise(F.get(words, F.lit(0)))


def authors_from_fullnames(author: Column | str, fullnames: Column | str) -> Column:
    """author where it is not blank, else the list of full names in author format."""
    names = F.filter(F.transform(F.split(_c(fullnames), ";"), lambda n: F.trim(n)), lambda n: n != "")
    return F.coalesce(blank_to_null(author), blank_to_null(F.array_join(F.transform(names, author_from_fullname), "; ")))


def first_author_key(x: Column | str) -> Column:
    """'LAST F' of the first listed name written given name first; bracketed ids and lone hyphens are ignored."""
    first = F.trim(F.substring_index(_c(x), ";", 1))
    first = F.trim(F.regexp_replace(F.regexp_replace(first, r"\(.*?\)", ""), r"[,\s]+", " "))
    words = F.filter(F.split(first, " "), lambda w: ~w.isin("", "-"))
    n = F.size(words)
    return F.when(n >= 2, F.concat_ws(" ", F.upper(F.get(words, n - 1)), F.upper(F.left(F.get(words, F.lit(0)), F.lit(1))))).otherwise(F.upper(F.get(words, F.lit(0))))


def year_text(x: Column | str) -> Column:
    """A year that may be a number, '2025' or '2025.0', as digits; else NULL."""
    return F.trim(_c(x).cast("string")).try_cast("double").try_cast("int").cast("string")


def reference_key(authors: Column | str, year: Column | str, source_title: Column | str) -> Column:
    """'LAST F, YEAR, SOURCE' of the parts that exist."""
    source = blank_to_null(F.upper(F.trim(F.replace(_c(source_title), F.lit("."), F.lit("")))))
    return F.regexp_replace(F.concat_ws(", ", blank_to_null(first_author_key(authors)), year_text(year), source), r"\s{2,}", " ")


def record_key_scopus(fullnames: Column | str, year: Column | str, source_title: Column | str) -> Column:
    """'LAST F, YEAR, SOURCE' of the first full name, 'Last, First (id)' or 'First Last'."""
    first = F.trim(F.regexp_replace(F.trim(F.substring_index(or_text(fullnames), ";", 1)), r"\(.*?\)", ""))
    comma = F.contains(first, F.lit(","))
    words = _words(first)
    n = F.size(words)
    with_comma = F.concat_ws(
        " ", F.upper(F.trim(F.substring_index(first, ",", 1))), blank_to_null(F.upper(F.left(F.trim(F.substring(first, F.instr(first, ",") + F.lit(1), F.length(first))), F.lit(1))))
    )
    without = F.when(n >= 2, F.concat_ws(" ", F.upper(F.get(words, n - 1)), F.upper(F.left(F.get(words, F.lit(0)), F.lit(1))))).otherwise(F.upper(F.get(words, F.lit(0))))
    key = F.concat_ws(", ", blank_to_null(F.when(comma, with_comma).otherwise(without)), blank_to_null(F.trim(_c(year).cast("string"))), blank_to_null(F.upper(F.trim(_c(source_title)))))
    return F.trim(F.regexp_replace(F.regexp_replace(key, r"\s+,", ", "), r",\s*,", ", "), F.lit(" ,"))


def record_key_wos(authors: Column | str, year: Column | str, source: Column | str) -> Column:
    """'FIRST AUTHOR, YEAR, SOURCE' if all parts exist, else ''."""
    a, y, s = (_c(x) for x in (authors, year, source))
    whole = a.isNotNull() & y.isNotNull() & s.isNotNull()
    return F.when(whole, F.concat_ws(", ", F.substring_index(a, ";", 1), y, s)).otherwise("")


def clean_sr(x: Column | str) -> Column:
    """A record key in one spelling: folded upper case, whole years, single blanks, no outer commas."""
    out = F.regexp_replace(F.regexp_replace(fold_upper(x), r",\s*(\d{4})\.0\b", ", $1"), r"\s+", " ")
    return F.trim(F.regexp_replace(out, r"\s*,\s*", ", "), F.lit(" ,"))


def sr_parts(x: Column | str) -> tuple[Column, Column]:
    """(family of the first author, first four-digit year of the later parts) of a record key."""
    parts = F.split(_c(x), ",")
    family = blank_to_null(F.upper(F.regexp_extract(F.get(parts, F.lit(0)), r"^\s*(\S+)", 1)))
    year = blank_to_null(F.regexp_extract(F.array_join(F.slice(parts, 2, 10), ","), r"\b(\d{4})\b", 1))
    return family, year


def cleaned_reference_author(x: Column | str) -> Column:
    return blank_to_null(F.trim(F.translate(_c(x), ".[]", "")))


def filled_score(*columns: Column | str) -> Column:
    """How many of the columns hold a non-blank value."""
    score = F.lit(0)
    for c in columns:
        score = score + F.when(F.trim(_c(c).cast("string")) != "", 1).otherwise(0)
    return score


def author_id(orcid: Column | str, openalex: Column | str, name: Column | str, openalex_ids_of_orcid: Column | str) -> Column:
    """ORCID: unless it goes with several OpenAlex ids and one is at hand; else OA:, else NAME: with underscores."""
    o, a, n = normalize_orcid(orcid), short_openalex(openalex), _c(openalex_ids_of_orcid)
    base = F.regexp_replace(F.trim(F.translate(or_text(name), ",.", "")), r"\s+", "_")
    return (
        F.when(o.isNotNull() & (n > 1) & a.isNotNull(), F.concat(F.lit("OA:"), a))
        .when(o.isNotNull(), F.concat(F.lit("ORCID:"), o))
        .when(a.isNotNull(), F.concat(F.lit("OA:"), a))
        .otherwise(F.concat(F.lit("NAME:"), F.upper(base)))
    )


# Record keys that name no author.
INVALID_SR = (
    "1999, 1999", "2013, 2013, V24", "2013, 2013", "2010, 2010", "2008, 2008, V73", "2006, 2006", "2005, 2005, P7",
    "2000, 2000", "1990, 1990, V55", "1981, 1981, V46", "1918, 1918",
)


def usable_author_name(x: Column | str) -> Column:
    return F.coalesce(~_c(x).rlike(r"\d") & ~F.ltrim(_c(x)).rlike(r'^[*.("?]'), F.lit(False))


def valid_sr(x: Column | str) -> Column:
    text = F.upper(F.trim(_c(x)))
    return F.coalesce(~text.isin("", "-", "NAN", "NONE") & ~text.rlike(r"^\d{4}$"), F.lit(False))


def valid_sr_ref(x: Column | str) -> Column:
    text = F.upper(F.trim(_c(x)))
    first = F.trim(F.substring_index(text, ",", 1))
    return F.coalesce(text.rlike("[A-Z]") & ~text.isin("", "-", "NAN", "NONE") & ~first.rlike(r"^[*.]|^\d{4}$|^$|^-$"), F.lit(False))


def valid_doi(x: Column | str) -> Column:
    return F.coalesce(~F.lower(F.trim(_c(x))).isin("", "-", "nan", "none", "<na>"), F.lit(False))
