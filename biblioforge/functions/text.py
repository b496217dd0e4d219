"""Text normalisation as column expressions. Sentinels are NULL inside the engine and come back at the sinks only."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters without a canonical decomposition and the ASCII text they stand for.
SPECIAL_LETTERS = {
    "Ø": "O", "ø": "o", "Æ": "AE", "æ": "ae", "Å": "A", "å": "a", "Ð": "D", "ð": "d", "Þ": "TH", "þ": "th", "ß": "SS",
}
# Texts that mean "missing".
MISSING = ("", "-", "nan", "NaN", "None", "<NA>", "NO ORCID", "NO AFFILIATION", "NO AFFILIATIONS", "NO COUNTRY")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _plain(char: str, form: str) -> str:
    kept = "".join(c for c in unicodedata.normalize(form, char) if not unicodedata.combining(c))
    return "".join(SPECIAL_LETTERS.get(c, c) for c in kept) if form == "NFD" else kept


@lru_cache(maxsize=2)
def _tables(form: str) -> tuple[str, str, dict[str, str]]:
    """Source and target letters that map one to one, and longer replacements, over the basic plane, from Unicode's own data."""
    ones, longer = {}, {}
    for code in range(0x80, 0x3000 if form == "NFD" else 0xFFFE):
        char = chr(code)
        if 0xD800 <= code < 0xE000 or 0xAC00 <= code < 0xD7A4 or not (char.isalpha() or form == "NFKD"):
            continue
        out = _plain(char, form)
        if form == "NFD":
            out = "".join(c for c in out if c.isascii())
        if out and out != char:
            (ones if len(out) == 1 else longer)[char] = out
    return "".join(ones), "".join(ones.values()), longer


def strip_blank(x: Column | str) -> Column:
    """Removes all white space at both ends, line breaks too."""
    return F.btrim(_c(x), F.lit(" \t\n\x0b\f\r"))


def blank_to_null(x: Column | str) -> Column:
    x = _c(x)
    return F.when(strip_blank(x) != "", x)


def missing_to_null(x: Column | str, extra: tuple[str, ...] = ()) -> Column:
    """Sentinels, compared without outer blanks and case, become NULL."""
    x = _c(x)
    return F.when(~F.upper(F.trim(x)).isin(*{m.upper() for m in (*MISSING, *extra)}), x)


def or_text(x: Column | str, text: str = "") -> Column:
    return F.coalesce(_c(x), F.lit(text))


def _unless_ascii(x: Column, folded: Column) -> Column:
    """Upper case of texts that are ASCII throughout; the folded text of others only, as folding takes many passes over a text."""
    return F.when(F.octet_length(x) == F.length(x), F.upper(x)).otherwise(folded)


def ascii_upper(x: Column | str, strip: bool = True) -> Column:
    """Canonical decomposition without marks, special letters spelt out, other characters dropped, upper case. NULL gives ''."""
    source, target, longer = _tables("NFD")
    out = _c(x)
    for char, text in longer.items():
        out = F.replace(out, F.lit(char), F.lit(text))
    out = _unless_ascii(_c(x), F.upper(F.regexp_replace(F.translate(out, source, target), r"[^\x00-\x7F]", "")))
    return or_text(strip_blank(out) if strip else out)


@lru_cache(maxsize=1)
def _marks() -> re.Pattern:
    return re.compile("[" + "".join(chr(c) for c in range(0x300, 0x110000) if unicodedata.combining(chr(c))) + "]+")


@F.arrow_udf(T.StringType())
def _fold_any(texts: pa.Array) -> pa.Array:
    """NFKD without combining marks, upper case, of the distinct texts of a batch."""
    coded, marks = texts.dictionary_encode(), _marks()
    folded = [None if t is None else marks.sub("", unicodedata.normalize("NFKD", t)).upper() for t in coded.dictionary.to_pylist()]
    return pa.array(folded, pa.string()).take(coded.indices)


def fold_upper(x: Column | str, strip: bool = True) -> Column:
    """Compatibility decomposition without combining marks, upper case; letters of other scripts stay. NULL stays NULL.

    ASCII texts stay in the JVM; only others go to Python, in Arrow batches, where a text takes one pass: native columns would need a pass
    for every letter of several, and a pattern of many hundred ranges looks at all of them for every character."""
    ascii_only = F.octet_length(_c(x)) == F.length(_c(x))
    out = F.when(ascii_only, F.upper(_c(x))).otherwise(_fold_any(F.when(~ascii_only, _c(x))))
    return strip_blank(out) if strip else out


def snake_label(label: str) -> str:
    """A column label in lower snake case."""
    out = re.sub(r"[()]", "", label.strip().lower()).replace(" ", "_")
    return re.sub(r"\W+", "_", out).strip("_")


def snake_labels(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_label(c) for c in df.columns])


def snake(x: Column | str) -> Column:
    out = F.replace(F.regexp_replace(F.lower(F.trim(_c(x))), "[()]", ""), F.lit(" "), F.lit("_"))
    return F.trim(F.regexp_replace(out, r"[^a-z0-9_]+", "_"), F.lit("_"))


def is_true(x: Column | str) -> Column:
    """'TRUE' in any case; everything else is false."""
    return F.coalesce(F.upper(F.trim(_c(x).cast("string"))) == "TRUE", F.lit(False))


def upper_strings(df: DataFrame) -> DataFrame:
    return df.select(*[F.upper(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema])


def journal_key(x: Column | str) -> Column:
    """Lookup key of a journal name: no dots, upper, trimmed; blank is NULL."""
    return blank_to_null(F.upper(F.trim(F.replace(_c(x), F.lit("."), F.lit("")))))


def issn_key(x: Column | str) -> Column:
    return blank_to_null(F.upper(F.trim(F.replace(_c(x), F.lit("-"), F.lit("")))))


def split_list(x: Column | str, separator: str = ";") -> Column:
    """The trimmed, non-blank items of a delimited text."""
    return F.filter(F.transform(F.split(_c(x), separator), lambda i: F.trim(i)), lambda i: i != "")


def join_list(x: Column | str, separator: str = "; ") -> Column:
    """Non-blank items joined; positions of blanks are lost, so this is for sinks."""
    return F.array_join(F.filter(_c(x), lambda i: i.isNotNull() & (F.trim(i) != "")), separator)
