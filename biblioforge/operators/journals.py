"""Journals: harmonising, identifiers from the metrics table, fuzzy titles, metrics by year."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import TitleIndex, ratio
from ..functions.text import blank_to_null, issn_key, journal_key
from ..lineage import cut
from .relational import fill_from, fill_group_mode, keep_first, lookup_cascade, mode_by, ordered_concat, require, shortest, surrogate_ids

#: Titles and values of one task of match_titles, where it compares blocks.
TITLE_BLOCK, VALUE_BLOCK = 20_000, 1_000
#: Least cutoff of plain scores from which titles are found by segments; below, segments get shorter than some four characters.
SEGMENT_CUTOFF = 90.0


def standardise(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Journal names and ISSNs made consistent: for references, the commonest (then longest) journal of a source_title; gaps from the
    modes of the source_title, then of the journal; names from the modes of the issn, then of the eissn."""
    require(df, "journal", "source_title", "issn", "eissn")
    df = df.withColumns({"source_title": journal_key("source_title"), "journal": journal_key("journal"), "issn": issn_key("issn"), "eissn": issn_key("eissn")})
    if "ismainarticle" in df.columns:
        names = mode_by(df.where("NOT ismainarticle AND source_title IS NOT NULL"), "source_title", "journal", seq, "longest", "_journal")
        df = df.join(names, "source_title", "left").withColumn("journal", F.when(~F.col("ismainarticle"), F.coalesce("_journal", "journal")).otherwise(F.col("journal"))).drop("_journal")
    df = cut(fill_group_mode(cut(df), ["source_title", "journal"], ["issn", "eissn"], seq))
    return fill_group_mode(df, ["issn", "eissn"], ["journal", "source_title"], seq, overwrite=True)


def fill_issn(df: DataFrame, scimago: DataFrame) -> DataFrame:
    """Missing issn and eissn from the metrics table by abbreviation, then by title; first non-null per key."""
    for own, key in (("source_title", "sc_journal_abbr"), ("journal", "sc_title")):
        table = scimago.withColumn("_key", journal_key(key))
        for column, metric in (("issn", "sc_issn"), ("eissn", "sc_eissn")):
            # first non-null per key: rows without a value drop out before the aggregate
            values = table.where(F.col(metric).isNotNull() & F.col("_key").isNotNull()).groupBy("_key").agg(F.min_by(issn_key(metric), "sc_seq").alias(column))
            df = fill_from(df.withColumn("_key", journal_key(own)), "_key", column, values).drop("_key")
    return df


def attach_ids(df: DataFrame, scimago: DataFrame, seq: str = "seq") -> DataFrame:
    """One row per (journal, source_title, issn, eissn) with its records and sourceid: by abbreviation, title, ISSN, else a negative surrogate."""
    keys = ["journal", "source_title", "issn", "eissn"]
    require(df, "SR", *keys)
    grouped = ordered_concat(df, keys, "SR", seq, "SR")
    table = scimago.select("sc_seq", F.col("sc_sourceid").cast("string").try_cast("long").alias("sourceid"), journal_key("sc_journal_abbr").alias("a"), journal_key("sc_title").alias("t"), issn_key("sc_issn").alias("i"))
    found = lookup_cascade(grouped, [(table, "a", "source_title"), (table, "t", "journal"), (table, "i", "issn")], "sourceid", "sc_seq")
    return surrogate_ids(cut(found), "sourceid", keys, "sourceid")


def resolve_ids(journals: DataFrame, members: DataFrame, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """One journal per sourceid: shortest source_title, commonest other names; and the (journal_id, SR) pairs.

    journals: sourceid and names; members: sourceid, SR, names, seq."""
    titles = shortest(members, "sourceid", "source_title", seq)
    names = mode_by(members, "sourceid", "journal", seq)
    journal = journals.select("sourceid").distinct().join(titles, "sourceid", "left").join(names, "sourceid", "left")
    pairs = members.where(blank_to_null("SR").isNotNull()).select(F.col("sourceid").alias("journal_id"), "SR").distinct()
    return journal.select(F.col("sourceid").alias("journal_id"), "source_title", "journal"), pairs


def add_metrics(pairs: DataFrame, articles: DataFrame, scimago: DataFrame, seq: str = "seq") -> DataFrame:
    """(journal_id, SR) with the record's year and the journal's metrics of that year; of several rows of a journal and year the first."""
    years = articles.groupBy("SR").agg(F.min_by(F.col("year").cast("string").try_cast("double").try_cast("int"), seq).alias("year"))
    table = keep_first(scimago.withColumn("_id", F.col("sc_sourceid").cast("string").try_cast("long")), ["_id", "sc_year"], "sc_seq")
    dated = pairs.join(years, "SR", "left")
    return dated.join(table, (dated["journal_id"] == table["_id"]) & (dated["year"] == table["sc_year"]), "left").drop("_id", "sc_seq", "sc_sourceid", "sc_year")


def match_titles(values: DataFrame, titles: DataFrame, cutoff: float, weighted: bool = False) -> DataFrame:
    """values (title), titles (title, target, seq) -> title, matched, target, score of the best match at or above cutoff; first best wins.

    Works on distinct values. Equal titles match at once. The rest are found by segments (title_candidates) for plain scores from SEGMENT_CUTOFF
    on. Else they meet all titles: values and titles are dealt into blocks, one task works on one pair of blocks, skips only pairs whose
    proven upper bound (functions.fuzzy: TitleIndex) cannot win, and returns one row per value at most, so that common words make no
    hot group and memory is fixed."""
    v = values.where(blank_to_null("title").isNotNull()).select(F.upper(F.trim("title")).alias("title")).distinct()
    t = titles.where(blank_to_null("title").isNotNull()).select(F.upper(F.trim("title")).alias("title"), "target", "seq").groupBy("title").agg(
        F.min_by("target", "seq").alias("target"), F.min("seq").alias("seq")
    )
    t = cut(t)
    same = v.join(t, "title").select("title", F.col("title").alias("matched"), "target", F.lit(100.0).alias("score"), "seq")
    rest = cut(v.join(t.select("title"), "title", "left_anti"))
    if not weighted and cutoff >= SEGMENT_CUTOFF:
        pairs = title_candidates(rest.select(F.col("title").alias("v")), t.select(F.col("title").alias("t")), cutoff).mapInPandas(_plain_scores(cutoff), "v string, t string, score double")
    else:
        pairs = _block_scores(rest, t, cutoff, weighted)
    found = pairs.join(t.withColumnRenamed("title", "t"), "t")
    near = found.select(F.col("v").alias("title"), F.col("t").alias("matched"), "target", "score", "seq")
    both = same.unionByName(near).groupBy("title").agg(F.max_by(F.struct("matched", "target", "score"), F.struct("score", (-F.col("seq")).alias("s"))).alias("b"))
    return both.select("title", "b.*")


def _spare(size: Column, cutoff: float) -> Column:
    """Most single-character insertions and deletions between texts of so many characters together whose ratio reaches the cutoff."""
    return F.floor(size * (1 - cutoff / 100) + 1e-6).cast("int")


def title_candidates(values: DataFrame, titles: DataFrame, cutoff: float) -> DataFrame:
    """Pairs (v, t) of distinct values and titles that may reach the plain ratio cutoff; none that does is left out.

    A ratio of at least cutoff allows some k insertions and deletions, in proportion to the lengths. A title is cut into one segment more
    than any partner of it may have; one segment then stands unchanged in the value, moved by no more characters than the rest of
    the edits explain. So pairs meet in an equi-join on (title length, segment, its text), as a hash of the three, and those whose Levenshtein
    distance exceeds k, which it never can, go within the join. Only a hash and a text travel, and each once: a value's equal keys are dropped in its row."""
    reach = (200 - cutoff) / cutoff  # of the longer text's length to the shorter's

    def segments(length: Column) -> Column:
        """How many, for titles of that length: one more than the edits to their longest partner."""
        return _spare(length + F.floor(length * reach + 1e-6), cutoff) + 1

    def bound(number: Column, length: Column) -> Column:
        return F.floor(number * length / segments(length)).cast("int")

    t = titles.select("t", F.length("t").alias("n")).withColumn("i", F.explode(F.sequence(F.lit(0), segments(F.col("n")) - 1)))
    t = t.withColumn("start", bound(F.col("i"), F.col("n"))).withColumn("size", bound(F.col("i") + 1, F.col("n")) - F.col("start"))
    t = t.select("t", F.xxhash64("n", "i", F.substr("t", F.col("start") + 1, "size")).alias("key"))

    v = values.select("v", F.length("v").alias("m"))
    v = v.withColumn("n", F.explode(F.sequence(F.greatest(F.lit(1), F.ceil(F.col("m") / reach - 1e-6).cast("int")), F.floor(F.col("m") * reach + 1e-6).cast("int"))))
    v = v.withColumn("k", _spare(F.col("m") + F.col("n"), cutoff)).where(F.abs(F.col("m") - F.col("n")) <= F.col("k"))
    v = v.withColumn("i", F.explode(F.sequence(F.lit(0), segments(F.col("n")) - 1)))
    v = v.withColumn("start", bound(F.col("i"), F.col("n"))).withColumn("size", bound(F.col("i") + 1, F.col("n")) - F.col("start"))
    # |shift| edits before the segment and |m - n - shift| after it are k at most
    low, high = F.ceil((F.col("m") - F.col("n") - F.col("k")) / 2).cast("int"), F.floor((F.col("m") - F.col("n") + F.col("k")) / 2).cast("int")
    v = v.select("v", "n", "i", "start", "size", F.greatest(low, -F.col("start")).alias("low"), F.least(high, F.col("m") - F.col("size") - F.col("start")).alias("high")).where("low <= high")
    key = lambda shift: F.xxhash64("n", "i", F.substr("v", F.col("start") + shift + 1, "size"))
    v = v.select("v", F.explode(F.array_distinct(F.transform(F.sequence("low", "high"), key))).alias("key"))
    met = v.join(t, "key").where(F.levenshtein("v", "t") <= _spare(F.length("v") + F.length("t"), cutoff))
    return met.select("v", "t").distinct()


def _plain_scores(cutoff: float):
    def run(batches):
        for b in batches:
            b = b.assign(score=pd.Series([ratio(v, t) for v, t in zip(b["v"], b["t"])], index=b.index, dtype=float))
            yield b[b["score"] >= cutoff]

    return run


def _block_scores(rest: DataFrame, t: DataFrame, cutoff: float, weighted: bool) -> DataFrame:
    """v, t, score: the best title of each value within each pair of blocks."""
    title_blocks, value_blocks = max(1, -(-t.count() // TITLE_BLOCK)), max(1, -(-rest.count() // VALUE_BLOCK))

    def block(column: str, blocks: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    asked = rest.select(F.col("title").alias("v"), block("title", value_blocks).alias("vb")).withColumn("tb", every(title_blocks))
    # without a seq a title comes last
    known = t.select(F.col("title").alias("t"), F.coalesce(F.col("seq").cast("long"), F.lit(2**62)).alias("o"), block("title", title_blocks).alias("tb")).withColumn("vb", every(value_blocks))

    def scored(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            index = TitleIndex(right["t"].tolist(), right["o"].to_numpy(), weighted)
            for value in left["v"]:
                hit = index.best(value, cutoff)
                if hit:
                    out.append((value, index.titles[hit[0]], hit[1]))
        return pd.DataFrame(out, columns=["v", "t", "score"]).astype({"v": object, "t": object, "score": float})

    return asked.groupBy("tb", "vb").cogroup(known.groupBy("tb", "vb")).applyInPandas(scored, "v string, t string, score double")


def fill_source_title(df: DataFrame, scimago: DataFrame, cutoff: float = 95.0) -> DataFrame:
    """source_title from the metrics table's abbreviation of the best matching title, else ''; the last abbreviation of a title wins."""
    titles = scimago.select(F.col("sc_title").alias("title"), F.col("sc_journal_abbr").alias("target"), (-F.col("sc_seq")).alias("seq"))
    found = match_titles(df.select(F.col("journal").alias("title")), titles, cutoff)
    joined = df.drop("source_title").withColumn("_t", F.upper(F.trim("journal"))).join(found.select(F.col("title").alias("_t"), F.col("target").alias("source_title")), "_t", "left")
    return joined.drop("_t").withColumn("source_title", F.coalesce("source_title", F.lit("")))


def journal_abbreviations(journals: DataFrame, scimago: DataFrame, cutoff: float = 85.0) -> DataFrame:
    """(journal, source_title) of the best weighted match, first abbreviation per title, without dots."""
    titles = scimago.select(F.col("sc_title").alias("title"), F.replace(F.trim("sc_journal_abbr"), F.lit("."), F.lit("")).alias("target"), F.col("sc_seq").alias("seq"))
    found = match_titles(journals.select(F.col("journal").alias("title")), titles, cutoff, weighted=True)
    own = journals.select("journal", F.upper(F.trim("journal")).alias("title")).distinct()
    return own.join(found, "title").select("journal", F.col("target").alias("source_title"))


__all__ = [
    "add_metrics", "attach_ids", "fill_issn", "fill_source_title", "journal_abbreviations", "match_titles", "resolve_ids", "standardise", "title_candidates",
]
