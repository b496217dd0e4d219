"""Countries of affiliations, by dictionary."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null

NO_AFFILIATION, NO_COUNTRY = "NO AFFILIATION", "NO COUNTRY"
#: Rows of the country dictionary that tasks may hold.
MOST_COUNTRIES = 100_000


def fill_missing_affiliations(df: DataFrame) -> DataFrame:
    return df.withColumn("Affiliation", F.coalesce(blank_to_null("Affiliation"), F.lit(NO_AFFILIATION)))


class CountryMatcher:
    """Countries of one affiliation cell, by one automaton over all names and codes that walks a text once.

    Names as whole words, longest first; codes only where no name occurs. One part with several names: the right-most one. Several ';' parts:
    parts that are only a country are left out, the rest's countries in order of discovery, each once.

    inner=False leaves out names inside a longer one that stands there too (GUINEA in PAPUA NEW GUINEA); with it, as a rule, the right-most name wins."""

    def __init__(self, names: list[str], codes: dict[str, str], inner: bool = True):
        self.names = sorted(names, key=lambda n: (-len(n), n))
        self.codes = sorted(codes, key=lambda c: (-len(c), c))
        self.of_code, self.inner = codes, inner
        self.only = {*self.names, *self.codes}
        entries: dict[str, list[tuple[int, int]]] = {}
        for kind, words in enumerate((self.names, self.codes)):
            for i, word in enumerate(words):
                entries.setdefault(word, []).append((kind, i))
        self.automaton = ahocorasick.Automaton()
        for word, places in entries.items():
            if word:
                self.automaton.add_word(word, (len(word), places))
        if entries:
            self.automaton.make_automaton()

    def found(self, text: str) -> list[str]:
        """Countries of an upper-case part: those of the names in it, longest first; else those of the codes."""
        hits: tuple[set[int], set[int]] = (set(), set())
        spans = []
        for end, (size, places) in self.automaton.iter(text) if len(self.automaton) else ():
            start = end + 1 - size
            if _edge(text, start) and _edge(text, end + 1):
                spans.append((start, end + 1, places))
        if not self.inner:
            spans = [s for s in spans if not any(o[0] <= s[0] and s[1] <= o[1] and o[1] - o[0] > s[1] - s[0] for o in spans)]
        for _, _, places in spans:
            for kind, i in places:
                hits[kind].add(i)
        if hits[0]:
            return list(dict.fromkeys(self.names[i] for i in sorted(hits[0])))
        return list(dict.fromkeys(self.of_code[self.codes[i]] for i in sorted(hits[1])))

    def country(self, cell: str | None) -> str:
        if cell is None or cell.strip(" ").upper() == NO_AFFILIATION:
            return NO_COUNTRY
        if ";" in cell:
            parts = [p for p in re.split(r";\s*", cell, flags=re.ASCII) if p.strip(" ") and p.strip(" ").upper() not in self.only]
            some = "; ".join(dict.fromkeys(c for p in parts for c in self.found(p.upper())))
            return some if some.strip() else NO_COUNTRY
        text = cell.upper()
        some = self.found(text)
        if len(some) < 2:
            return some[0] if some else NO_COUNTRY
        # a country known by its code alone is taken to stand at the end
        return max(((text.rfind(n) - 1 if n in text else len(text) - len(n)), n) for n in some)[1]


def _word(char: str) -> bool:
    return char.isalpha() or char == "_" or unicodedata.category(char) in ("Nd", "Nl", "Mn", "Mc", "Me", "Pc") or char in "\u200c\u200d"


def _edge(text: str, at: int) -> bool:
    """Whether a word begins or ends at that place."""
    return (at > 0 and _word(text[at - 1])) != (at < len(text) and _word(text[at]))


def extract_countries(df: DataFrame, countries: DataFrame, inner: bool = True) -> DataFrame:
    """df with Country. The dictionary, of at most MOST_COUNTRIES rows, goes to the tasks as one automaton; each distinct affiliation is matched once."""
    rows = countries.select("name", "alpha2", "alpha3").limit(MOST_COUNTRIES + 1).collect()
    if len(rows) > MOST_COUNTRIES:
        raise ValueError(f"a dictionary of over {MOST_COUNTRIES} rows")
    codes = {c: r["name"] for r in rows for c in (r["alpha2"], r["alpha3"]) if c}
    names = [r["name"] for r in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = CountryMatcher(names, codes, inner)
        for batch in batches:
            found = [matcher.country(x) for x in batch.column("Affiliation").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("Affiliation"), pa.array(found, pa.string())], names=["Affiliation", "Country"])

    distinct = df.where("Affiliation IS NOT NULL").select("Affiliation").distinct()
    matched = distinct.mapInArrow(run, "Affiliation string, Country string")
    joined = df.drop("Country").join(matched, "Affiliation", "left")
    return joined.withColumn("Country", F.coalesce("Country", F.lit(NO_COUNTRY)))
