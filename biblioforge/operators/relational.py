"""Order-stable relational idioms. Row order is a column (seq); nothing depends on partition order.

Keep-first and mode operators are aggregates with an explicit tie rule (max_by / min_by over a struct), so they combine before
the shuffle and a hot key costs one partial row per task. Windows are used only where every row needs its rank.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identifiers import filled_score
from ..lineage import cut

Keys = str | Sequence[str]
#: Rows of a key above which its ranks are found by ranges; most keys that are broadcast.
HOT_ROWS, BROADCAST_KEYS = 1_000_000, 100_000


def _list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Raises ValueError for missing columns."""
    have = {c.lower() for c in df.columns}
    if missing := [c for c in columns if c.lower() not in have]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def _whole(df: DataFrame, grouped: DataFrame) -> DataFrame:
    return grouped.select("_row.*").select(*[f"`{c}`" for c in df.columns])


def keep_first(df: DataFrame, keys: Keys, seq: Keys, last: bool = False) -> DataFrame:
    """One whole row per key (a NULL key is a key): the first, or last, by seq. Partial aggregation instead of a window."""
    pick = F.max_by if last else F.min_by
    return _whole(df, df.groupBy(*_list(keys)).agg(pick(_row(df), F.struct(*_list(seq))).alias("_row")))


def keep_first_or_unkeyed(df: DataFrame, keys: Keys, seq: Keys, usable: Column | None = None) -> DataFrame:
    """keep_first over usable rows; all others stay. Unusable rows form groups of their own, so one aggregate does both."""
    keys, seq = _list(keys), _list(seq)
    usable = F.coalesce(usable if usable is not None else reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in keys]), F.lit(False))
    alone = F.when(~usable, F.struct(*[F.col(s) for s in seq]))
    group = [F.when(usable, F.col(k)).alias(f"_k{i}") for i, k in enumerate(keys)]
    return _whole(df, df.groupBy(*group, alone.alias("_alone")).agg(F.min_by(_row(df), F.struct(*seq)).alias("_row")))


def remove_duplicates(df: DataFrame, first: str = "doi", second: str = "title", seq: Keys = "seq") -> tuple[DataFrame, int]:
    """Keep-first on the pair, rows with both missing untouched; and how many rows went."""
    require(df, first, second)
    out = keep_first_or_unkeyed(df, [first, second], seq)
    return out, df.count() - out.count()


def prefer(df: DataFrame, keys: Keys, preferred: Column, seq: Keys) -> DataFrame:
    """Per key the first row for which preferred holds, else the first row."""
    order = F.struct(F.when(F.coalesce(preferred, F.lit(False)), 0).otherwise(1).alias("p"), *[F.col(s) for s in _list(seq)])
    return _whole(df, df.groupBy(*_list(keys)).agg(F.min_by(_row(df), order).alias("_row")))


def top1(df: DataFrame, keys: Keys, best: str, seq: Keys) -> DataFrame:
    """Per key the row with the greatest best (NULL last), then the first. Two combining aggregates: first row per value, then the greatest value."""
    keys, b = _list(keys), F.col(best)
    first = df.groupBy(*keys, b).agg(F.min_by(_row(df), F.struct(*_list(seq))).alias("_row"))
    return _whole(df, first.groupBy(*keys).agg(F.max_by("_row", F.struct(b.isNotNull().alias("some"), b.alias("b"))).alias("_row")))


def best_row(df: DataFrame, keys: Keys, fields: Sequence[str], seq: Keys) -> DataFrame:
    """Per key the row that fills most of the fields; ties go to the first by seq."""
    order = F.struct((-filled_score(*fields)).alias("_filled"), *[F.col(s) for s in _list(seq)])
    return _whole(df, df.groupBy(*_list(keys)).agg(F.min_by(_row(df), order).alias("_row")))


def total_order(df: DataFrame, *first: str) -> list[str]:
    """The columns of first that exist, then all others that can be ordered: rows that tie in it are equal in them."""
    have = [c for c in first if c in df.columns]
    return have + [c for c, kind in df.dtypes if c not in have and "map<" not in kind and kind != "variant"]


def _value_counts(df: DataFrame, keys: list[str], value: str, seq: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"), F.min(seq).alias("_first"))


def mode_by(df: DataFrame, keys: Keys, value: str, seq: str, ties: str = "first", name: str | None = None) -> DataFrame:
    """Most frequent non-null value per key. ties: 'first' seen, 'min' value, 'longest' (then first).
    ties='length_first' ranks by length before frequency."""
    keys, v = _list(keys), F.col(value)
    order = {
        "first": lambda: F.struct(F.col("_n"), (-F.col("_first")).alias("f")),
        "longest": lambda: F.struct(F.col("_n"), F.length(v).alias("l"), (-F.col("_first")).alias("f")),
        "length_first": lambda: F.struct(F.length(v).alias("l"), F.col("_n"), (-F.col("_first")).alias("f")),
    }
    if ties == "min":
        counts = _value_counts(df, keys, value, seq)
        return counts.groupBy(*keys).agg(F.min_by(v, F.struct((-F.col("_n")).alias("n"), v.alias("v"))).alias(name or value))
    return _value_counts(df, keys, value, seq).groupBy(*keys).agg(F.max_by(v, order[ties]()).alias(name or value))


def first_nonnull(df: DataFrame, keys: Keys, values: Sequence[str], seq: str) -> DataFrame:
    return df.groupBy(*_list(keys)).agg(*[F.min_by(v, F.when(F.col(v).isNotNull(), F.col(seq))).alias(v) for v in values])


def shortest(df: DataFrame, keys: Keys, value: str, seq: str, name: str | None = None, longest: bool = False) -> DataFrame:
    """Per key the shortest (or longest) non-null value, then the first."""
    v = F.col(value)
    order = F.struct((-F.length(v) if longest else F.length(v)).alias("l"), F.col(seq))
    return df.where(v.isNotNull()).groupBy(*_list(keys)).agg(F.min_by(v, order).alias(name or value))


def ordered_concat(df: DataFrame, keys: Keys, value: str, seq: Keys, name: str, separator: str = "; ") -> DataFrame:
    """Non-null values of a group joined in order of seq. The result is one text per group by contract."""
    pairs = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(*_list(seq), F.col(value).alias("_v")))))
    return df.groupBy(*_list(keys)).agg(F.array_join(F.transform(pairs, lambda p: p["_v"]), separator).alias(name))


def distinct_concat(column: str, separator: str = "; ") -> Column:
    """Aggregate: sorted distinct non-blank values joined."""
    return F.array_join(F.array_sort(F.collect_set(F.when(F.trim(column) != "", F.col(column)))), separator)


def fill_from(df: DataFrame, keys: Keys, value: str, filler: DataFrame, overwrite: bool = False) -> DataFrame:
    """value from filler (keys, value) where missing, or everywhere the filler has one. NULL keys match nothing."""
    keys = _list(keys)
    joined = df.join(filler.select(*keys, F.col(value).alias("_fill")), keys, "left")
    own, other = F.col(value), F.col("_fill")
    return joined.withColumn(value, F.coalesce(other, own) if overwrite else F.coalesce(own, other)).select(*[f"`{c}`" for c in df.columns])


def fill_group_mode(df: DataFrame, passes: Sequence[str], values: Sequence[str], seq: str, overwrite: bool = False) -> DataFrame:
    """Per grouping column in turn: values from the group's mode (smallest on ties); a later pass sees the earlier one's result."""
    for i, key in enumerate(passes):
        if i:
            df = cut(df)  # each pass reads its input twice
        pairs = df.where(F.col(key).isNotNull()).select(key, F.explode(F.array(*[F.struct(F.lit(v).alias("c"), F.col(v).alias("v")) for v in values])).alias("_p"))
        counts = pairs.where("_p.v IS NOT NULL").groupBy(key, "_p").agg((-F.count(F.lit(1))).alias("_n"))
        modes = counts.groupBy(key).agg(*[F.min_by("_p.v", F.when(F.col("_p.c") == v, F.struct("_n", F.col("_p.v").alias("v")))).alias(f"_{v}") for v in values])
        joined = df.join(modes, key, "left")
        for v in values:
            joined = joined.withColumn(v, F.coalesce(f"_{v}", v) if overwrite else F.coalesce(v, f"_{v}"))
        df = joined.select(*[f"`{c}`" for c in df.columns])
    return df


def lookup_cascade(df: DataFrame, steps: Sequence[tuple[DataFrame, str, str]], value: str, seq: str | None = None) -> DataFrame:
    """value of the first step that finds one. A step is (lookup, its key, df's key); the first row by seq wins per key.
    Spark broadcasts a lookup when its measured size allows."""
    out = df
    for i, (lookup, key, own) in enumerate(steps):
        slim = lookup.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_key{i}")).agg(
            (F.min_by(value, seq) if seq else F.min(value)).alias(f"_value{i}")
        )
        out = out.join(slim, out[own] == slim[f"_key{i}"], "left")
    found = F.coalesce(*[F.col(f"_value{i}") for i in range(len(steps))])
    return out.select(*[df[c] for c in df.columns if c != value], found.alias(value))


def rank_in_key(df: DataFrame, key: str, seq: Keys, name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """1-based rank of each row within its key by seq (a total order); rows without a key drop out.

    Keys of more than hot_rows rows, by count, are not sorted in one task: their rows are dealt into ranges of (key, seq), and a rank is the place
    in the range after the key's rows in the ranges before. Such keys are few, as each holds over hot_rows rows."""
    order, df = _list(seq), df.where(F.col(key).isNotNull())
    w = Window.partitionBy(key).orderBy(*order)
    hot = cut(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(key))
    n_hot = hot.count()
    if not n_hot:
        return df.withColumn(name, F.row_number().over(w))
    hot = F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot
    plain = df.join(hot, key, "left_anti").withColumn(name, F.row_number().over(w).cast("long"))
    large = cut(df.join(hot, key, "left_semi").repartitionByRange(key, *order).withColumn("_part", F.spark_partition_id()))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = large.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n")).select(key, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    ranked = large.withColumn("_at", F.row_number().over(Window.partitionBy("_part", key).orderBy(*order))).join(before, [key, "_part"])
    return plain.unionByName(ranked.withColumn(name, F.col("_before") + F.col("_at")).select(*plain.columns))


def rank_aligned_merge(
    left: DataFrame, right: DataFrame, key: str, seq: str, left_name: str = "left", right_name: str = "right", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Pairs the i-th left row of a key with the i-th right row; leftovers and rows without a key stay alone.

    Columns of the result: key, rank, left and right structs (NULL where alone), and sources."""

    def ranked(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(F.col(key).alias("_key"), F.col(seq).alias("_seq"), _row(df).alias(name))
        return rank_in_key(rows, "_key", "_seq", "_rank", hot_rows).withColumn("_rank", F.col("_rank").cast("int")).drop("_seq")

    pairs = ranked(left, left_name).join(ranked(right, right_name), ["_key", "_rank"], "full")
    none = F.lit(None)
    alone_left = left.where(F.col(key).isNull()).select(none.cast("string").alias("_key"), none.cast("int").alias("_rank"), _row(left).alias(left_name))
    alone_right = right.where(F.col(key).isNull()).select(none.cast("string").alias("_key"), none.cast("int").alias("_rank"), _row(right).alias(right_name))
    pairs = pairs.withColumn("_key", F.col("_key").cast("string"))
    out = pairs.unionByName(alone_left, allowMissingColumns=True).unionByName(alone_right, allowMissingColumns=True)
    sources = F.concat_ws(";", F.when(F.col(left_name).isNotNull(), left_name), F.when(F.col(right_name).isNotNull(), right_name))
    return out.withColumn("sources", sources)


def unique_attach(df: DataFrame, key: str, target: str, attach: Column, candidate: Column) -> DataFrame:
    """Rows with attach get the single target that candidate rows of their key have, if there is exactly one."""
    single = (
        df.where(candidate & F.col(key).isNotNull()).groupBy(key).agg(F.min(target).alias("_one"), F.max(target).alias("_other"))
        .where("_one = _other").select(key, "_one")
    )
    joined = df.join(single, key, "left")
    return joined.withColumn(target, F.when(attach & F.col("_one").isNotNull(), F.col("_one")).otherwise(F.col(target))).select(*[f"`{c}`" for c in df.columns])


def propagate(df: DataFrame, mapping: DataFrame, key: str, value: str, seq: str | None = None) -> DataFrame:
    """value joined on by key; of several in the mapping the first by seq, else the least."""
    pick = F.min_by(value, seq) if seq else F.min(value)
    return df.join(mapping.groupBy(key).agg(pick.alias(value)), key, "left")


def remap(df: DataFrame, column: str, mapping: DataFrame, old: str, new: str) -> DataFrame:
    """column replaced by mapping's new value where it has one."""
    slim = mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    out = df.join(slim, F.col(column) == F.col("_old"), "left")
    return out.withColumn(column, F.coalesce("_new", column)).select(*[f"`{c}`" for c in df.columns])


def conflicts(df: DataFrame, keys: Keys, value: str, kind: str) -> DataFrame:
    """Keys with more than one distinct value: type, keys, the sorted values joined."""
    sets = df.where(F.col(value).isNotNull()).groupBy(*_list(keys)).agg(F.array_sort(F.collect_set(value)).alias("_v"))
    return sets.where(F.size("_v") > 1).select(F.lit(kind).alias("type"), *_list(keys), F.array_join("_v", "; ").alias(f"{value}s"))


def surrogate_ids(df: DataFrame, missing: str, order: Sequence[str], name: str) -> DataFrame:
    """name for rows whose missing column is NULL: -1, -2, ... in order, so real ids are never met; others keep theirs.

    Only distinct unmatched keys are numbered. Ranges of the order are counted first, so no task sees all of them."""
    keys = df.where(F.col(missing).isNull()).select(*order).distinct()
    numbered = range_row_number(keys, order, "_no").select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(order)], "_no")
    match = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(order)]
    joined = df.join(numbered, reduce(lambda a, b: a & b, match), "left")
    value = F.when(F.col(missing).isNull(), -F.col("_no")).otherwise(F.col(missing))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != name], value.alias(name))


def range_row_number(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Global 1-based row number without a single-task window: sort by range, count per range, add the ranges before.

    The ranged rows are written once, so that numbers and counts see the same ranges."""
    ranged = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    local = ranged.withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per range
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return local.join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part").select(*df.columns, (F.col("_before") + F.col("_at")).alias(name))


def explode_list(df: DataFrame, column: str, name: str, separator: str = "; ", keep_empty: bool = False, position: str | None = None) -> DataFrame:
    """One row per non-blank item of a delimited column; keep_empty keeps rows without items once."""
    parts = F.split(column, separator)
    items = F.filter(F.transform(parts, lambda v, i: F.struct(i.alias("p"), F.trim(v).alias("v"))), lambda s: s["v"] != "")
    exploded = df.withColumn("_item", (F.explode_outer if keep_empty else F.explode)(items))
    out = exploded.withColumn(name, F.col("_item.v"))
    return (out.withColumn(position, F.col("_item.p")) if position else out).drop("_item")


def forward_fill(df: DataFrame, column: str, keys: Keys, seq: str) -> DataFrame:
    """NULLs of column take the last value before them within the key."""
    w = Window.partitionBy(*_list(keys)).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(column, F.last(column, ignorenulls=True).over(w))


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), variable, value)


def union_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_columns(df: DataFrame) -> DataFrame:
    """Of columns whose names are equal, case aside, only the first."""
    seen: dict[str, int] = {}
    for i, c in enumerate(df.columns):
        seen.setdefault(c.lower(), i)
    if len(seen) == len(df.columns):
        return df
    names = [df.columns[i] if seen[c.lower()] == i else f"_extra{i}" for i, c in enumerate(df.columns)]
    return df.toDF(*names).drop(*[n for n in names if n.startswith("_extra")])


def project(df: DataFrame, names: Sequence[str], strict: bool = False) -> DataFrame:
    """The named columns in order; missing ones are NULL, or an error when strict."""
    have = {c.lower() for c in df.columns}
    if strict:
        require(df, *names)
    return df.select(*[F.col(f"`{n}`") if n.lower() in have else F.lit(None).cast("string").alias(n) for n in names])
