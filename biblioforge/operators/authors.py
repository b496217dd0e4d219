"""Authors of articles: exploding aligned lists, affiliations, e-mails, name and ORCID unification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parsing as P
from ..functions.identifiers import (
    ANONYMOUS,
    INVALID_SR,
    abbreviated_name,
    author_id,
    last_first_initial,
    matching_name,
    normalize_orcid,
    short_openalex,
    standard_fullname,
    usable_author_name,
)
from ..functions.text import blank_to_null, missing_to_null, or_text, split_list
from .relational import keep_first, mode_by, require

MAX_FULL_NAMES = 5


def _take_emails(users: list[str | None], lasts: list[str], initials: list[str], longs: list[str]) -> list[int | None]:
    """Index of the e-mail of each author of a row. What a text occurs in is looked up once a row, among distinct users, and an initial's e-mails are kept in
    order, so an author costs what the surname and name parts hit."""
    places: dict[str, list[int]] = {}  # of each user, the first left at the end
    for i in reversed(range(len(users))):
        if users[i] is not None:
            places.setdefault(users[i], []).append(i)
    hits: dict[str, list[str]] = {}
    queues: dict[str, list[int]] = {}
    taken, out = [False] * len(users), []

    def held(text: str) -> list[str]:
        if text not in hits:
            hits[text] = [u for u in places if text in u]
        return hits[text]

    for last, initial, long in zip(lasts, initials, longs):
        points: dict[str, int] = {}
        for text, worth in [(last, 3), *((w, 1) for w in long.split(" "))]:
            for u in held(text) if text else ():
                points[u] = points.get(u, 0) + worth
        best = max(((n + (2 if initial and initial in u else 0), -places[u][-1]) for u, n in points.items() if places[u]), default=(0, 0))
        if initial:
            if initial not in queues:
                queues[initial] = sorted((i for u in held(initial) for i in places[u]), reverse=True)
            queue = queues[initial]
            while queue and taken[queue[-1]]:
                queue.pop()
            best = max(best, (2, -queue[-1])) if queue else best
        out.append(-best[1] if best[0] else None)
        if best[0]:
            taken[-best[1]] = True
            places[users[-best[1]]].pop()
    left = iter([i for i, t in enumerate(taken) if not t])
    return [next(left, None) if o is None else o for o in out]


@F.arrow_udf(T.ArrayType(T.StringType()))
def _dealt_emails(emails: pa.Array, users: pa.Array, names: pa.Array) -> pa.Array:
    def rows(lists: pa.Array, values: pa.Array):
        """The lists of a batch, null as empty."""
        flat, ends = values.to_numpy(zero_copy_only=False).tolist(), np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
        return (flat[a:b] for a, b in zip([0, *ends], ends))

    parts = names.flatten()
    taken = (_take_emails(*row) for row in zip(rows(users, users.flatten()), *[rows(names, parts.field(f)) for f in ("last", "initial", "long")]))
    return pa.array([[None if i is None else own[i] for i in at] for own, at in zip(rows(emails, emails.flatten()), taken)], pa.list_(pa.string()))


def assign_emails(fullnames: Column, emails: Column) -> Column:
    """E-mail of each author (array of full names), by position.

    As many e-mails as authors: one each in order. Else each author in turn takes the best-scoring e-mail left, if any scores: 3 for the
    surname in the user part, 2 for the first initial, 1 for each name part over two letters; the first best wins. E-mails then left
    go to authors without one, in order. E-mails are taken by index, so equal ones stay apart. Names and users are read natively; a row's
    e-mails are dealt in Arrow batches, as a fold of columns looks at every e-mail left for every author."""
    users = F.transform(emails, lambda e: F.lower(F.substring_index(e, "@", 1)))

    def words_of(name: Column) -> Column:
        low = F.lower(or_text(name))
        return F.struct(low.alias("low"), F.split(F.trim(F.replace(low, F.lit(","), F.lit(" "))), r"\s+").alias("words"))

    def parts(name: Column) -> Column:
        low, words = name["low"], name["words"]
        comma = F.contains(low, F.lit(","))
        last = F.when(comma, F.trim(F.substring_index(low, ",", 1))).otherwise(F.get(words, F.lit(0)))
        given = F.when(comma, F.trim(F.substring(low, F.instr(low, ",") + F.lit(1), F.length(low)))).otherwise(or_text(F.get(words, F.lit(1))))
        long = F.array_join(F.filter(words, lambda w: F.length(w) > 2), " ")
        return F.struct(last.alias("last"), F.left(given, F.lit(1)).alias("initial"), long.alias("long"))

    # rows that need no matching go to Python empty
    needed = F.coalesce((F.size(emails) != 0) & (F.size(emails) != F.size(fullnames)), F.lit(True))
    dealt = _dealt_emails(*[F.when(needed, c) for c in (emails, users, F.transform(F.transform(fullnames, words_of), parts))])
    folded = F.when(fullnames.isNotNull(), dealt)
    positional = F.slice(emails, 1, F.greatest(F.size(fullnames), F.lit(1)))
    return F.when(F.size(emails) == 0, F.transform(fullnames, lambda n: F.lit(None).cast("string"))).when(F.size(emails) == F.size(fullnames), positional).otherwise(folded)


def wos_authors(df: DataFrame, seq: str = "seq") -> DataFrame:
    """One row per article and author: order, names, affiliations, corresponding flag, ORCID, ids, e-mail."""
    require(df, "SR", "author", "author_full_names")
    for c in ("affiliations", "reprint_address", "orcid", "researcher_id_number", "email_address", "author_id_openalex", "openalex_work_id"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    short, full = split_list("author"), split_list("author_full_names")
    alone = (F.size(short) == 1) & (F.upper(F.get(short, F.lit(0))) == ANONYMOUS) & (F.size(full) > 0) & (F.upper(F.get(full, F.lit(0))) != ANONYMOUS)
    short = F.when(alone, F.transform(full, abbreviated_name)).otherwise(F.coalesce(short, F.array().cast("array<string>")))
    full = F.coalesce(full, F.array().cast("array<string>"))
    people = F.transform(
        F.arrays_zip(short.alias("a"), full.alias("f")),
        lambda p, i: F.struct(
            (i + 1).alias("AuthorOrder"),
            F.trim(F.translate(F.coalesce(p["a"], abbreviated_name(p["f"])), "“”", "")).alias("AuthorName"),
            standard_fullname(F.coalesce(p["f"], p["a"])).alias("AuthorFullName"),
        ),
    )
    base = df.where(~F.coalesce(F.col("SR").isin(*INVALID_SR), F.lit(False))).withColumn("_people", F.filter(people, lambda p: usable_author_name(p["AuthorName"])))
    base = base.withColumns(
        {
            "_places": P.bracketed_affiliations("affiliations"),
            "_corresponding": last_first_initial(P.corresponding_author("reprint_address")),
            "_researchers": P.researcher_ids("researcher_id_number"),
            "_emails": F.coalesce(P.emails("email_address"), F.array().cast("array<string>")),
        }
    )
    base = base.withColumn("_emails", assign_emails(F.transform("_people", lambda p: p["AuthorFullName"]), F.col("_emails")))
    rows = base.select("*", F.posexplode("_people").alias("_i", "_p"))
    at = F.col("_p.AuthorOrder") - 1
    places = P.affiliations_of("_p.AuthorFullName", "_places")
    ids = F.filter("_researchers", lambda r: r["name"] == matching_name(F.col("_p.AuthorFullName")))
    return rows.select(
        seq, "SR", "openalex_work_id", "_p.AuthorOrder", "_p.AuthorName", "_p.AuthorFullName",
        F.get(places, F.lit(0)).alias("Affiliation"), places.alias("Affiliations"),
        F.coalesce(last_first_initial("_p.AuthorFullName") == F.col("_corresponding"), F.lit(False)).alias("CorrespondingAuthor"),
        normalize_orcid(P.positional("orcid", at)).alias("Orcid"),
        F.get(F.transform(ids, lambda r: r["id"]), F.lit(0)).alias("ResearcherID"),
        F.get("_emails", F.col("_i")).alias("Email"),
        P.positional("author_id_openalex", at).alias("OpenAlexAuthorID"),
        F.lit(None).cast("string").alias("scopus_author_id"),
    )


def scopus_authors(df: DataFrame, seq: str = "seq") -> DataFrame:
    """One row per article and author of an export that lists names, ids and 'name, affiliation' items."""
    require(df, "SR", "author")
    for c in ("author_full_names", "authors_id", "authors_with_affiliations", "orcid", "author_id_openalex", "openalex_work_id"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    full = F.split("author_full_names", ";")
    places = F.transform(F.filter(split_list("authors_with_affiliations"), lambda i: F.contains(i, F.lit(","))), lambda i: F.struct(F.trim(F.substring_index(i, ",", 1)).alias("name"), F.trim(F.regexp_replace(i, "^[^,]*,", "")).alias("affiliation")))
    ids = F.transform(full, lambda n: F.struct(P.name_without_id(n).alias("name"), P.id_of_name(n).alias("id")))
    base = df.where(blank_to_null("author").isNotNull()).withColumns({"_places": places, "_full": full, "_ids": F.filter(ids, lambda i: i["id"].isNotNull()), "_orcid": P.orcid_urls("orcid")})
    rows = base.select("*", F.posexplode(F.transform(F.split("author", ";"), lambda a: F.trim(a))).alias("_i", "AuthorName")).where("AuthorName <> ''")
    name = P.name_without_id(F.get("_full", F.col("_i")))
    return rows.select(
        seq, "SR", "openalex_work_id", (F.col("_i") + 1).alias("AuthorOrder"), "AuthorName", name.alias("AuthorFullName"),
        P.first_containing(F.col("AuthorName"), F.col("_places"), "affiliation").alias("Affiliation"),
        F.lit(False).alias("CorrespondingAuthor"), F.get("_orcid", F.col("_i")).alias("Orcid"),
        P.first_containing(name, F.col("_ids"), "id").alias("ResearcherID"), F.lit(None).cast("string").alias("Email"),
        P.positional("author_id_openalex", F.col("_i")).alias("OpenAlexAuthorID"), P.positional("authors_id", F.col("_i")).alias("scopus_author_id"),
    )


def enrich_names(df: DataFrame, seq: str = "seq", keep_anonymous: bool = True) -> DataFrame:
    """Per AuthorName: a full name that only repeats the short one becomes the commonest other full name; a missing ORCID the commonest ORCID.

    ANONYMOUS is left alone, or dropped."""
    known = df.where(F.col("AuthorName") != ANONYMOUS)
    names = mode_by(known.where(F.col("AuthorFullName") != F.col("AuthorName")), "AuthorName", "AuthorFullName", seq, "first", "_full")
    orcids = mode_by(known, "AuthorName", "Orcid", seq, "first", "_orcid")
    out = df.join(names, "AuthorName", "left").join(orcids, "AuthorName", "left")
    bare = blank_to_null("AuthorFullName").isNull() | (F.col("AuthorFullName") == F.col("AuthorName"))
    out = out.withColumn("AuthorFullName", F.when(bare, F.coalesce("_full", "AuthorFullName")).otherwise(F.col("AuthorFullName")))
    out = out.withColumn("Orcid", F.coalesce(missing_to_null("Orcid"), "_orcid")).select(*df.columns)
    return out if keep_anonymous else out.where(F.coalesce(F.col("AuthorName") != ANONYMOUS, F.lit(True)))


def unify_names(df: DataFrame, seq: str = "seq", max_full_names: int = MAX_FULL_NAMES) -> DataFrame:
    """Per AuthorName with at most max_full_names full names: one name per ORCID (longest, then commonest), one ORCID per such name.

    Rows without an ORCID of one AuthorName form one group. Adds AuthorID."""
    df = df.withColumn("AuthorFullName", F.regexp_replace("AuthorFullName", r"\.+$", "")).withColumn("Orcid", normalize_orcid("Orcid"))
    few = df.groupBy("AuthorName").agg((F.countDistinct("AuthorFullName") <= max_full_names).alias("_few"))
    keyed = df.join(few, "AuthorName", "left").withColumn("_orcid", F.coalesce("Orcid", F.lit("")))
    longest = mode_by(keyed.where("_few"), ["AuthorName", "_orcid"], "AuthorFullName", seq, "length_first", "_name")
    named = keyed.join(longest, ["AuthorName", "_orcid"], "left").withColumn("_name", F.coalesce("_name", "AuthorFullName"))
    commonest = mode_by(named.where("_few"), ["AuthorName", "_name"], "Orcid", seq, "first", "_common")
    out = named.join(commonest, ["AuthorName", "_name"], "left")
    out = out.withColumn("AuthorFullName", F.col("_name")).withColumn("Orcid", F.when(F.col("_few"), F.col("_common")).otherwise(F.col("Orcid")))
    out = out.select(*df.columns)
    several = out.where("Orcid IS NOT NULL").groupBy("Orcid").agg(F.countDistinct(short_openalex("OpenAlexAuthorID")).alias("_n"))
    out = out.join(several, "Orcid", "left")
    return out.withColumn("AuthorID", author_id("Orcid", "OpenAlexAuthorID", "AuthorFullName", F.coalesce("_n", F.lit(0)))).drop("_n")


def author_tables(df: DataFrame, seq: str = "seq") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(Author, ArticleAuthor, Affiliation). An author's row is that of the commonest AuthorName, then the first."""
    counts = df.groupBy("AuthorName").agg((-F.count(F.lit(1))).alias("_rare"))
    ranked = df.join(counts, "AuthorName", "left")
    author = keep_first(ranked.select("AuthorID", "AuthorName", "AuthorFullName", "Orcid", "ResearcherID", "Email", "OpenAlexAuthorID", "scopus_author_id", "_rare", seq), "AuthorID", ["_rare", seq])
    links = df.select("SR", "openalex_work_id", "AuthorID", "AuthorOrder", "CorrespondingAuthor", "OpenAlexAuthorID").distinct()
    return author.drop("_rare", seq), links, df.select("SR", "AuthorID", "Affiliation").distinct()
