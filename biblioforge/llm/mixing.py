"""Mixing sources to target weights by hierarchical budgeting.

Leaves are (domain, lang, source). A total token budget flows down the tree: at each node it is split among the children by
integer weight, but no child gets more than its subtree can give (its tokens times max_epochs). What a child cannot take goes to its siblings
by weight; only when all children of a node are full does the node itself count as full, so shortages reach cousins
through the ancestors last. A leaf's budget is met by whole epochs plus a prefix of the next one in that epoch's
seeded order: documents are taken while the tokens before them stay below the budget.

Everything is DataFrame functions and exact integers. Leaf totals are partial aggregates; the tree has one row per
leaf. A leaf may hold a third of all rows, so a prefix is never ordered in one task: documents fall in
RADIX ranges of their seeded order key, range totals find the range that the budget ends in, that range is split again in the
same way, and only the few documents of the last range are ordered.

The weights of the three levels are arguments (Weights), as is the column that gives a document's domain.

Rules for odd input: null lang or source form the leaf ''; null text counts as 0 tokens and such documents come and go with
the order like any other; a null doc_id sorts first and such rows of a leaf are one draw; a leaf without weight takes part with DEFAULT_WEIGHT; weights below 0 count as 0, and a node whose
children all weigh 0 gives them nothing; ties in the order key go to the smaller doc_id; rows repeated with the same doc_id
are one draw: each gets the same copies; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, small_side, stash

WORD, RADIX, SEED = r"[^\x20\x09-\x0D]+", 4096, 11
DEFAULT_WEIGHT = 1
#: Share of the corpus' tokens drawn, in hundredths, and how often a document may be drawn at most.
BUDGET_PERCENT, MAX_EPOCHS = 60, 4
LEAF = ["domain", "lang", "source"]


@dataclass(frozen=True)
class Weights:
    """Integer target weights by name on each level of the tree; names that are not listed have DEFAULT_WEIGHT, below 0 counts as 0."""

    domain: dict[str, int]
    lang: dict[str, int]
    source: dict[str, int]


#: Target weights of the query. Domains group sources by their number; a source of a name not listed has DEFAULT_WEIGHT.
WEIGHTS = Weights({"web": 3, "books": 2, "code": 2, "forums": 1}, {"en": 5, "de": 2, "fr": 2, "es": 1}, {"src0": 1, "src1": 4, "src2": 2, "src3": 2})


def domain_of(source: Column, domains: tuple[str, ...] = tuple(WEIGHTS.domain)) -> Column:
    """Domains by the source's number modulo their count; sources without a number are of the first."""
    number = F.coalesce(F.regexp_extract(source, "([0-9]{1,9})$", 1).try_cast("int"), F.lit(0))
    return F.get(F.array(*[F.lit(d) for d in domains]), number % len(domains))


def _weight(column: Column, weights: dict[str, int]) -> Column:
    out = F.lit(DEFAULT_WEIGHT)
    for name, w in weights.items():
        out = F.when(column == name, F.lit(max(0, w))).otherwise(out)
    return out.cast("long")


def order_key(seed: int, epoch: Column) -> Column:
    """60 uniform bits of (seed, epoch, doc_id) as a long."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col("doc_id").cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def split_budget(nodes: DataFrame, parents: list[str], child: str) -> DataFrame:
    """nodes: one row per child with budget (of its parent), cap, weight -> share: the child's part of the budget.

    Children sorted by cap/weight fill up in that order; the first k are full where the rest's level reaches cap k.
    All sums are of integers, the shares are floors."""
    by = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    ratio = F.when(F.col("weight") > 0, F.col("cap").cast("double") / F.col("weight")).otherwise(F.lit(float("inf")))
    before = by.orderBy(ratio, child).rowsBetween(Window.unboundedPreceding, -1)
    wide = "decimal(38,0)"
    staged = (
        nodes.withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0).cast("long")))
        .withColumn("rest", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("mass", F.sum("weight").over(by) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        # full: cap <= rest * weight / mass; once a child is not full, none after it is
        .withColumn("full", F.col("cap").cast(wide) * F.col("mass").cast(wide) <= F.col("rest").cast(wide) * F.col("weight").cast(wide))
    )
    open_rest = F.min(F.when(~F.col("full"), F.struct(ratio.alias("r"), F.col(child).alias("c"), "rest", "mass"))).over(by)
    staged = staged.withColumn("level", open_rest)
    share = F.when(F.col("full") | (F.col("weight") == 0), F.col("cap")).otherwise(
        F.floor(F.col("level.rest").cast(wide) * F.col("weight").cast(wide) / F.col("level.mass").cast(wide)).cast("long")
    )
    return staged.withColumn("share", F.greatest(F.least(share, F.col("cap")), F.lit(0).cast("long"))).drop("rest", "mass", "full", "level")


def leaf_budgets(leaves: DataFrame, total: Column | int, max_epochs: int = MAX_EPOCHS, weights: Weights = WEIGHTS) -> DataFrame:
    """leaves: domain, lang, source, tokens -> with budget and epochs (whole ones)."""
    l = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    domains = l.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(F.col("domain"), weights.domain))
    domains = split_budget(domains.withColumn("budget", total if isinstance(total, Column) else F.lit(total).cast("long")), [], "domain")
    langs = l.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(F.col("lang"), weights.lang))
    langs = split_budget(langs.join(domains.select("domain", F.col("share").alias("budget")), "domain"), ["domain"], "lang")
    sources = l.withColumn("weight", _weight(F.col("source"), weights.source))
    sources = split_budget(sources.join(langs.select("domain", "lang", F.col("share").alias("budget")), ["domain", "lang"]), ["domain", "lang"], "source")
    share = F.col("share")
    return sources.select(
        *LEAF, "tokens", share.alias("budget"), F.when(F.col("tokens") > 0, F.expr("share div tokens")).otherwise(F.lit(0)).cast("long").alias("epochs")
    ).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))


def _ranges(docs: DataFrame, keys: list[str], digit: str) -> DataFrame:
    """keys, digit -> tokens before the range within its group; a partial aggregate, then a window over at most RADIX rows a group."""
    sums = docs.groupBy(*keys, digit).agg(F.sum("n_tokens").alias("in_range"))
    before = Window.partitionBy(*keys).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("before", F.coalesce(F.sum("in_range").over(before), F.lit(0)))


def leaf_of(domain: Column | None = None) -> Column:
    """The leaf of a document as struct (domain, lang, source); domain: by the source's number if not given."""
    source, lang = F.coalesce(F.col("source"), F.lit("")), F.coalesce(F.col("lang"), F.lit(""))
    named = domain_of(source) if domain is None else F.coalesce(domain.cast("string"), F.lit(""))
    return F.struct(named.alias("domain"), lang.alias("lang"), source.alias("source"))


def drawing_plan(rows: DataFrame, percent: int, max_epochs: int, seed: int, weights: Weights = WEIGHTS) -> DataFrame:
    """rows: doc_id, leaf columns, n_tokens -> one row per leaf: epochs, and edge, the last (key, doc_id) of the prefix."""
    leaves = stash(rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    total = (leaves.agg(F.sum("tokens")).first()[0] or 0) * percent // 100
    budgets, n_leaves = small_side(leaf_budgets(leaves, total, max_epochs, weights), "mix-budgets")
    bits = RADIX.bit_length() - 1
    keyed = rows.join(budgets.select(*LEAF, "epochs", "rest"), LEAF).withColumn("key", order_key(seed, F.col("epochs")))
    keyed = keyed.withColumn("d1", F.shiftright("key", 60 - bits)).withColumn("d2", F.shiftright("key", 60 - 2 * bits).bitwiseAND(F.lit(RADIX - 1)))
    # the range in which each leaf's budget ends: the last one whose tokens before it are below the rest
    one = _ranges(keyed, [*LEAF, "rest"], "d1").where("before < rest")
    first, _ = small_side(one.groupBy(*LEAF).agg(F.max(F.struct("d1", "before")).alias("end1")), "mix-first")
    near = keyed.join(first, LEAF).where("d1 = end1.d1")
    two = _ranges(near, [*LEAF, "end1", "rest"], "d2").where("end1.before + before < rest")
    second, _ = small_side(two.groupBy(*LEAF).agg(F.max(F.struct("d2", "before")).alias("end2")), "mix-second")
    last = near.join(second, LEAF).where("d2 = end2.d2")
    # rows of one doc_id are one draw: added up first, so that the window sees some rows a leaf however often an id or a missing one repeats
    draws = last.groupBy(*LEAF, "rest", F.col("end1.before").alias("before1"), F.col("end2.before").alias("before2"), "key", "doc_id").agg(F.sum("n_tokens").alias("n_tokens"))
    before = F.coalesce(F.sum("n_tokens").over(Window.partitionBy(*LEAF).orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edges = (
        draws.withColumn("taken", F.col("before1") + F.col("before2") + before)
        .where("taken < rest").groupBy(*LEAF).agg(F.max(F.struct("key", "doc_id")).alias("edge"))
    )
    plan = stash(budgets.select(*LEAF, "epochs").join(edges, LEAF, "left"), "mix-plan")
    return F.broadcast(plan) if n_leaves <= BROADCAST_ROWS else plan


def copies(seed: int, epochs: str = "epochs", edge: str = "edge") -> Column:
    drawn = F.struct(order_key(seed, F.col(epochs)).alias("key"), F.col("doc_id").cast("long").alias("doc_id")) <= F.col(edge)
    return F.col(epochs) + F.coalesce(drawn, F.lit(False)).cast("long")


def _token_rows(docs: DataFrame, domain: Column | None = None) -> DataFrame:
    n = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), leaf_of(domain).alias("leaf"), n.alias("n_tokens"))
    return stash(rows.select("doc_id", "leaf.*", "n_tokens"), "mix-rows")


def mix(
    docs: DataFrame, percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED, weights: Weights = WEIGHTS, domain: Column | None = None
) -> DataFrame:
    """One row per input row: doc_id, domain, lang, source, n_tokens, copies (0: not drawn)."""
    rows = _token_rows(docs, domain)
    plan = drawing_plan(rows, percent, max_epochs, seed, weights)
    return rows.join(plan, LEAF).select("doc_id", *LEAF, "n_tokens", copies(seed).alias("copies"))


def drawn_documents(
    docs: DataFrame, percent: int, max_epochs: int, seed: int = SEED, weights: Weights = WEIGHTS, domain: Column | None = None
) -> DataFrame:
    """The documents themselves, each as often as it is drawn, with their own columns only."""
    plan = drawing_plan(_token_rows(docs, domain), percent, max_epochs, seed, weights)
    plan = plan.select(F.struct(*LEAF).alias("leaf"), "epochs", "edge")
    # a document travels as one struct, so that no name of its columns meets one of these
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), leaf_of(domain).alias("leaf"))
    drawn = rows.join(plan, "leaf").withColumn("copies", copies(seed)).where("copies > 0")
    if max_epochs > 1:
        drawn = drawn.withColumn("draw", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return drawn.select("row.*")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _case(column: str, weights: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {w}" for k, w in weights.items()) + f" ELSE {DEFAULT_WEIGHT} END"


def _split_sql(name: str, nodes: str, parents: list[str], child: str) -> str:
    """SQL of split_budget: CTEs {name}0 and {name} over {nodes} (parents, child, cap, weight, budget)."""
    by = "PARTITION BY " + ", ".join(parents) if parents else ""
    order = f"ORDER BY cap::DOUBLE / weight, {child}"
    keys = ", ".join([*parents, child])
    return f"""
{name}0 AS (SELECT *, budget - coalesce(sum(cap) OVER ({by} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(weight) OVER ({by}) - coalesce(sum(weight) OVER ({by} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS mass FROM {nodes}),
{name}1 AS (SELECT *, cap::HUGEINT * mass <= rest::HUGEINT * weight AS is_full, row_number() OVER ({by} {order}) AS rn FROM {name}0),
{name} AS (SELECT {keys}, cap, CASE WHEN is_full THEN cap ELSE least(cap,
  first_value(rest) OVER ({by} ORDER BY is_full, rn) * weight // first_value(mass) OVER ({by} ORDER BY is_full, rn)) END AS share FROM {name}1)"""


def oracle(percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED, weights: Weights = WEIGHTS) -> str:
    names = "[" + ", ".join(f"'{d}'" for d in weights.domain) + "]"
    return f"""
WITH r AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  {names}[coalesce(try_cast(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS INT), 0) % {len(weights.domain)} + 1] AS domain,
  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents),
l AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM r GROUP BY ALL),
total AS (SELECT (sum(tokens) * {percent} // 100)::BIGINT AS budget FROM l),
dn AS (SELECT domain, sum(tokens)::BIGINT * {max_epochs} AS cap, {_case('domain', weights.domain)} AS weight, (SELECT budget FROM total) AS budget FROM l GROUP BY domain),
{_split_sql('ds', 'dn', [], 'domain')},
ln AS (SELECT l.domain, lang, sum(tokens)::BIGINT * {max_epochs} AS cap, {_case('lang', weights.lang)} AS weight, any_value(ds.share) AS budget
  FROM l JOIN ds USING (domain) GROUP BY l.domain, lang),
{_split_sql('ls', 'ln', ['domain'], 'lang')},
sn AS (SELECT l.domain, l.lang, source, tokens * {max_epochs} AS cap, {_case('source', weights.source)} AS weight, ls.share AS budget
  FROM l JOIN ls USING (domain, lang)),
{_split_sql('ss', 'sn', ['domain', 'lang'], 'source')},
b AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN share // tokens ELSE 0 END AS epochs,
  share - CASE WHEN tokens > 0 THEN share // tokens ELSE 0 END * tokens AS rest FROM ss JOIN l USING (domain, lang, source)),
k AS (SELECT r.*, epochs, rest, ('0x' || substr(md5('{seed}:' || epochs::BIGINT || ':' || doc_id), 1, 15))::BIGINT AS key FROM r JOIN b USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, (epochs + CASE WHEN coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
  ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM k
"""
