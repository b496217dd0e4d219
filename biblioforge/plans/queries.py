"""Queries over the driver's tables that exercise the operators, each with SQL for the same rows where SQL can express it.

Null rules are exercised with nullif on both sides, as the tables hold no nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identifiers as I
from ..functions import parsing as P
from ..functions import text as T
from ..operators import authors, journals, merge, persons, references
from ..operators import relational as R
from ..operators.geo import extract_countries
from . import entity_queries, function_queries, source_queries  # noqa: F401  they register their queries
from .registry import LCS, ORACLES, QUERIES, query, t

__all__ = ["ORACLES", "QUERIES", "flagship"]


def _null(column: str, modulus: int):
    return F.nullif(F.col(column) % modulus, F.lit(0))


# --- dedup, top-1, set operations ------------------------------------------------------------------------------------


@query("SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) = 1")
def dedup_pair(spark, sf):
    return R.keep_first(t(spark, sf, "documents").select("doc_id", "lang", "source", "text"), ["text", "lang"], "doc_id").drop("text")


@query("""SELECT o_orderkey, o_custkey, k FROM (SELECT o_orderkey, o_custkey, nullif(o_custkey % 50, 0) AS k FROM orders)
QUALIFY k IS NULL OR row_number() OVER (PARTITION BY k ORDER BY o_orderkey) = 1""")
def dedup_keep_null(spark, sf):
    return R.keep_first_or_unkeyed(t(spark, sf, "orders").select("o_orderkey", "o_custkey", _null("o_custkey", 50).alias("k")), "k", "o_orderkey")


@query("""SELECT l_orderkey, l_suppkey, l_returnflag, l_linenumber, l_partkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_returnflag, l_linenumber ORDER BY l_orderkey, l_partkey) = 1""")
def dedup_composite(spark, sf):
    df = t(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_linenumber", "l_partkey")
    return R.keep_first(df, ["l_suppkey", "l_returnflag", "l_linenumber"], ["l_orderkey", "l_partkey"])


@query("SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem")
def distinct_edges(spark, sf):
    return t(spark, sf, "lineitem").select("l_orderkey", "l_suppkey").distinct()


@query("""SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, o_orderkey) = 1""")
def prefer_valid(spark, sf):
    return R.prefer(t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_custkey", F.col("o_orderstatus") == "F", "o_orderkey")


@query("""SELECT c_custkey, c_nationkey, v FROM (SELECT c_custkey, c_nationkey, nullif(c_custkey % 7, 0) AS v FROM customer)
QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY v DESC NULLS LAST, c_custkey) = 1""")
def top1_per_key(spark, sf):
    return R.top1(t(spark, sf, "customer").select("c_custkey", "c_nationkey", _null("c_custkey", 7).alias("v")), "c_nationkey", "v", "c_custkey")


@query("""WITH x AS (SELECT o_orderkey, o_custkey, nullif(o_orderkey % 2, 0) AS a, nullif(o_orderkey % 3, 0) AS b, nullif(o_orderkey % 5, 0) AS c FROM orders)
SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT DESC, o_orderkey) = 1""")
def best_row(spark, sf):
    df = t(spark, sf, "orders").select("o_orderkey", "o_custkey", _null("o_orderkey", 2).alias("a"), _null("o_orderkey", 3).alias("b"), _null("o_orderkey", 5).alias("c"))
    return R.best_row(df, "o_custkey", ["a", "b", "c"], "o_orderkey")


@query("SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders")
def intersect_keys(spark, sf):
    return t(spark, sf, "customer").select("c_custkey").intersect(t(spark, sf, "orders").select("o_custkey"))


@query("SELECT c_custkey FROM customer EXCEPT SELECT nullif(o_custkey % 500, 7) FROM orders")
def except_keys(spark, sf):
    return t(spark, sf, "customer").select("c_custkey").subtract(t(spark, sf, "orders").select(F.nullif(F.col("o_custkey") % 500, F.lit(7))))


@query("""SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def union_by_name(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return R.union_by_name(c, t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def semi_join_shared(spark, sf):
    # the whole table; misses come from keys made null
    returned = t(spark, sf, "lineitem").select(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey")).alias("o_orderkey"))
    return t(spark, sf, "orders").select("o_orderkey", "o_custkey").join(returned, "o_orderkey", "left_semi")


# --- modes and group values -------------------------------------------------------------------------------------------


def _mode_sql(table: str, key: str, value: str, seq: str, order: str, where: str = "true", name: str | None = None) -> str:
    return f"""WITH c AS (SELECT {key}, {value} AS v, count(*) AS n, min({seq}) AS f FROM {table} WHERE {where} AND {value} IS NOT NULL GROUP BY 1, 2)
SELECT {key}, v AS {name or value} FROM c QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"""


@query(_mode_sql("orders", "o_custkey", "o_orderpriority", "o_orderkey", "n DESC, f"))
def mode_first_seen(spark, sf):
    return R.mode_by(t(spark, sf, "orders"), "o_custkey", "o_orderpriority", "o_orderkey")


@query(_mode_sql("orders", "o_custkey", "o_orderpriority", "o_orderkey", "n DESC, v"))
def mode_min(spark, sf):
    return R.mode_by(t(spark, sf, "orders"), "o_custkey", "o_orderpriority", "o_orderkey", "min")


@query(_mode_sql("part", "p_brand", "p_name", "p_partkey", "n DESC, length(v) DESC, f"))
def mode_longest(spark, sf):
    return R.mode_by(t(spark, sf, "part"), "p_brand", "p_name", "p_partkey", "longest")


@query(_mode_sql("part", "p_brand", "p_name", "p_partkey", "length(v) DESC, n DESC, f"))
def longest_name(spark, sf):
    return R.mode_by(t(spark, sf, "part"), "p_brand", "p_name", "p_partkey", "length_first")


@query("SELECT p_brand, p_name FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name), p_partkey) = 1")
def shortest_title(spark, sf):
    return R.shortest(t(spark, sf, "part"), "p_brand", "p_name", "p_partkey")


@query("""SELECT o_custkey, arg_min(a, o_orderkey) FILTER (WHERE a IS NOT NULL) AS a, arg_min(b, o_orderkey) FILTER (WHERE b IS NOT NULL) AS b
FROM (SELECT o_custkey, o_orderkey, nullif(o_orderkey % 2, 0) AS a, nullif(o_orderkey % 3, 0) AS b FROM orders) GROUP BY 1""")
def first_nonnull(spark, sf):
    df = t(spark, sf, "orders").select("o_custkey", "o_orderkey", _null("o_orderkey", 2).alias("a"), _null("o_orderkey", 3).alias("b"))
    return R.first_nonnull(df, "o_custkey", ["a", "b"], "o_orderkey")


@query("""WITH x AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS p FROM orders),
m AS (SELECT o_custkey, p AS m FROM (SELECT o_custkey, p, count(*) AS n, min(o_orderkey) AS f FROM x WHERE p IS NOT NULL GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, f) = 1)
SELECT o_orderkey, o_custkey, coalesce(p, m) AS p FROM x LEFT JOIN m USING (o_custkey)""")
def mode_fill(spark, sf):
    df = t(spark, sf, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("p"))
    return R.fill_from(df, "o_custkey", "p", R.mode_by(df, "o_custkey", "p", "o_orderkey"))


def _part_modes(overwrite: bool) -> str:
    pick = "coalesce(m, s)" if overwrite else "coalesce(s, m)"
    step = """{m} AS (SELECT {k}, s AS m FROM (SELECT {k}, s, count(*) AS n FROM {x} WHERE s IS NOT NULL GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY n DESC, s) = 1),
{y} AS (SELECT p_partkey, p_brand, p_name, {pick} AS s FROM {x} LEFT JOIN {m} USING ({k}))"""
    return "WITH x AS (SELECT p_partkey, p_brand, p_name, CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS s FROM part),\n" + ",\n".join(
        step.format(m=m, k=k, x=x, y=y, pick=pick) for m, k, x, y in (("m1", "p_name", "x", "y"), ("m2", "p_brand", "y", "z"))
    ) + "\nSELECT p_partkey, p_brand, p_name, s FROM z"


def _part_types(spark, sf):
    return t(spark, sf, "part").select("p_partkey", "p_brand", "p_name", F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")).alias("s"))


@query(_part_modes(False))
def fill_group_mode(spark, sf):
    return R.fill_group_mode(_part_types(spark, sf), ["p_name", "p_brand"], ["s"], "p_partkey")


@query(_part_modes(True))
def harmonise_mode(spark, sf):
    return R.fill_group_mode(_part_types(spark, sf), ["p_name", "p_brand"], ["s"], "p_partkey", overwrite=True)


@query("SELECT l_orderkey, string_agg(l_partkey::VARCHAR, '; ' ORDER BY l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY 1")
def listagg_group(spark, sf):
    df = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_partkey").cast("string").alias("p"))
    return R.ordered_concat(df, "l_orderkey", "p", ["l_linenumber", "l_partkey"], "parts")


@query("""SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, '; ' ORDER BY c_mktsegment) AS segments, count(*) AS n,
arg_min(c_name, (-length(c_name), c_custkey)) AS longest FROM customer GROUP BY 1""")
def person_rollup(spark, sf):
    return t(spark, sf, "customer").groupBy("c_nationkey").agg(
        R.distinct_concat("c_mktsegment").alias("segments"), F.count(F.lit(1)).alias("n"),
        F.min_by("c_name", F.struct(-F.length("c_name"), "c_custkey")).alias("longest"),
    )


@query("SELECT l_suppkey, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def count_distinct_key(spark, sf):
    return t(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts"))


@query("""SELECT 'priority' AS type, o_custkey, string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) AS o_orderprioritys
FROM orders GROUP BY 2 HAVING count(DISTINCT o_orderpriority) > 1""")
def conflicts(spark, sf):
    return R.conflicts(t(spark, sf, "orders"), "o_custkey", "o_orderpriority", "priority")


@query("""SELECT count(*) AS n, count_if(o_orderstatus = 'F') AS n_final, count(DISTINCT o_custkey) AS customers FROM orders""")
def scalar_counts(spark, sf):
    return t(spark, sf, "orders").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("n_final"), F.countDistinct("o_custkey").alias("customers"))


# --- lookups and joins ------------------------------------------------------------------------------------------------


@query("""WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS a, CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS b, p_type AS c FROM part),
l AS (SELECT * FROM part WHERE p_partkey % 10 < 3)
SELECT p_partkey, a, b, c, coalesce(
  (SELECT arg_min(p_retailprice, p_partkey) FROM l WHERE l.p_name = p.a), (SELECT arg_min(p_retailprice, p_partkey) FROM l WHERE l.p_brand = p.b),
  (SELECT arg_min(p_retailprice, p_partkey) FROM l WHERE l.p_type = p.c)) AS p_retailprice FROM p""")
def lookup_cascade(spark, sf):
    part = t(spark, sf, "part")
    k = F.col("p_partkey")
    p = part.select("p_partkey", F.when(k % 2 == 0, F.col("p_name")).alias("a"), F.when(k % 3 == 0, F.col("p_brand")).alias("b"), F.col("p_type").alias("c"))
    keys = [F.when(k % 10 < 3, F.col(c)).alias(c) for c in ("p_name", "p_brand", "p_type")]  # the whole table; misses come from keys made null
    lookup = part.select(F.col("p_partkey").alias("l_seq"), *keys, "p_retailprice")
    return R.lookup_cascade(p, [(lookup, "p_name", "a"), (lookup, "p_brand", "b"), (lookup, "p_type", "c")], "p_retailprice", "l_seq")


@query("""WITH x AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment END AS s FROM customer),
a AS (SELECT c_nationkey, arg_min(s, c_custkey) AS f FROM x WHERE s IS NOT NULL GROUP BY 1)
SELECT c_custkey, c_nationkey, coalesce(s, f) AS s FROM x LEFT JOIN a USING (c_nationkey)""")
def two_pass_fill(spark, sf):
    x = t(spark, sf, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 3 == 1, F.col("c_mktsegment")).alias("s"))
    return R.fill_from(x, "c_nationkey", "s", R.first_nonnull(x, "c_nationkey", ["s"], "c_custkey"))


@query("""WITH y AS (SELECT o_custkey, year(min(o_orderdate)) AS y FROM orders GROUP BY 1)
SELECT c_custkey, c_nationkey, y FROM customer LEFT JOIN y ON o_custkey = c_custkey""")
def dim_year_join(spark, sf):
    y = t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.year(F.min("o_orderdate")).cast("long").alias("y"))
    return t(spark, sf, "customer").select("c_custkey", "c_nationkey").join(y, "c_custkey", "left")


@query("""WITH c AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY c_custkey) AS r FROM (SELECT c_custkey, nullif(c_nationkey, 0) AS k FROM customer) WHERE k IS NOT NULL),
s AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY s_suppkey) AS r FROM (SELECT s_suppkey, nullif(s_nationkey, 0) AS k FROM supplier) WHERE k IS NOT NULL)
SELECT coalesce(c.k, s.k)::BIGINT AS nation, c_custkey AS customer, s_suppkey AS supplier, concat_ws(';', CASE WHEN c_custkey IS NOT NULL THEN 'customer' END,
CASE WHEN s_suppkey IS NOT NULL THEN 'supplier' END) AS sources FROM c FULL JOIN s ON c.k = s.k AND c.r = s.r
UNION ALL SELECT NULL, c_custkey, NULL, 'customer' FROM customer WHERE c_nationkey = 0 UNION ALL SELECT NULL, NULL, s_suppkey, 'supplier' FROM supplier WHERE s_nationkey = 0""")
def rank_aligned_merge(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.nullif("c_nationkey", F.lit(0)).alias("k"))
    s = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.nullif("s_nationkey", F.lit(0)).alias("k"))
    m = R.rank_aligned_merge(c, s, "k", "id", "customer", "supplier")
    return m.select(F.col("_key").cast("long").alias("nation"), F.col("customer.id").alias("customer"), F.col("supplier.id").alias("supplier"), "sources")


@query("""WITH x AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 9 = 0 THEN 'B:' || p_brand ELSE 'N:' || p_name END AS id FROM part),
u AS (SELECT p_name, min(id) AS one FROM x WHERE id LIKE 'B:%' GROUP BY 1 HAVING min(id) = max(id))
SELECT p_partkey, p_name, CASE WHEN id LIKE 'N:%' AND one IS NOT NULL THEN one ELSE id END AS id FROM x LEFT JOIN u USING (p_name)""")
def unique_attach(spark, sf):
    p = t(spark, sf, "part")
    x = p.select("p_partkey", "p_name", F.when(F.col("p_partkey") % 9 == 0, F.concat(F.lit("B:"), "p_brand")).otherwise(F.concat(F.lit("N:"), "p_name")).alias("id"))
    return R.unique_attach(x, "p_name", "id", F.col("id").startswith("N:"), F.col("id").startswith("B:"))


@query("SELECT o_orderkey, o_custkey, c_nationkey FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def propagate_id(spark, sf):
    mapping = t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return R.propagate(t(spark, sf, "orders").select("o_orderkey", "o_custkey"), mapping, "o_custkey", "c_nationkey").select("o_orderkey", "o_custkey", "c_nationkey")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, coalesce(s_nationkey + 1000000, l_suppkey)::BIGINT AS l_suppkey FROM lineitem
LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_suppkey % 3 = 0""")
def remap_key(spark, sf):
    # the whole table; misses come from values made null
    s = t(spark, sf, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, F.col("s_nationkey") + 1000000).cast("long").alias("new"))
    return R.remap(t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "l_suppkey", s, "s_suppkey", "new")


# --- reshaping --------------------------------------------------------------------------------------------------------


@query("""WITH x AS (SELECT p_partkey, p_brand, p_type, CASE WHEN p_partkey % 2 = 0 THEN p_partkey END AS id FROM part),
k AS (SELECT p_brand, p_type, row_number() OVER (ORDER BY p_brand, p_type) AS n FROM (SELECT DISTINCT p_brand, p_type FROM x WHERE id IS NULL))
SELECT p_partkey, p_brand, p_type, CASE WHEN id IS NULL THEN -n ELSE id END AS id FROM x LEFT JOIN k USING (p_brand, p_type)""")
def surrogate_ids(spark, sf):
    x = t(spark, sf, "part").select("p_partkey", "p_brand", "p_type", F.when(F.col("p_partkey") % 2 == 0, F.col("p_partkey")).alias("id"))
    return R.surrogate_ids(x, "id", ["p_brand", "p_type"], "id")


@query("""SELECT doc_id, i AS position, string_split(text, '.')[i + 1] AS sentence
FROM (SELECT doc_id, text, unnest(range(len(string_split(text, '.')))) AS i FROM documents)""")
def posexplode_authors(spark, sf):
    return t(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", r"\.")).alias("p", "sentence")).select("doc_id", F.col("p").cast("long").alias("position"), "sentence")


@query("""SELECT n_nationkey, r_name, n_name, string_split(n_name, 'A')[n_regionkey + 1] AS part FROM nation JOIN region ON r_regionkey = n_regionkey""")
def positional_zip(spark, sf):
    df = t(spark, sf, "nation").join(t(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    return df.select("n_nationkey", "r_name", "n_name", F.get(F.split("n_name", "A"), F.col("n_regionkey")).alias("part"))


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn
ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS asked FROM conversations""")
def ffill_tag(spark, sf):
    c = t(spark, sf, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.col("turn")).alias("asked"))
    return R.forward_fill(c, "asked", "conv_id", "turn")


@query("SELECT doc_id, trim(x) AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents) WHERE trim(x) <> ''")
def explode_refs(spark, sf):
    return R.explode_list(t(spark, sf, "documents").select("doc_id", "text"), "text", "line", "\n").select("doc_id", "line")


@query("SELECT DISTINCT l_orderkey % 1000 AS journal_id, 'P' || l_partkey AS \"SR\" FROM lineitem")
def explode_sr(spark, sf):
    l = t(spark, sf, "lineitem")
    members = l.select((F.col("l_orderkey") % 1000).alias("sourceid"), F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("SR"), F.lit("t").alias("source_title"), F.lit("j").alias("journal"), F.col("l_orderkey").alias("seq"))
    return journals.resolve_ids(members.select("sourceid"), members)[1]


@query("""SELECT n_nationkey, 'name' AS kind, n_name AS code FROM nation UNION ALL SELECT n_nationkey, 'a2', substr(n_name, 1, 2) FROM nation
UNION ALL SELECT n_nationkey, 'a3', substr(n_name, 1, 3) FROM nation""")
def unpivot_codes(spark, sf):
    n = t(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("name"), F.substring("n_name", 1, 2).alias("a2"), F.substring("n_name", 1, 3).alias("a3"))
    return R.unpivot(n, ["n_nationkey"], ["name", "a2", "a3"], "kind", "code")


@query("SELECT s_suppkey AS supplier, s_name AS name, NULL::VARCHAR AS doi, 1 AS page_count FROM supplier")
def project_entity(spark, sf):
    s = t(spark, sf, "supplier").withColumnsRenamed({"s_suppkey": "supplier", "s_name": "name"})
    return R.project(s, ["supplier", "name", "doi"]).withColumn("page_count", F.lit(1))


# --- scalar functions -------------------------------------------------------------------------------------------------


@query("""SELECT doc_id, trim(upper(regexp_replace(strip_accents(replace(replace(replace(replace(replace(text, 'ß', 'SS'), 'ø', 'o'), 'æ', 'ae'), 'Ø', 'O'), 'Æ', 'AE')),
'[^\\x00-\\x7F]', '', 'g')), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS folded FROM documents""")
def ascii_upper(spark, sf):
    return t(spark, sf, "documents").select("doc_id", T.ascii_upper("text").alias("folded"))


@query("""SELECT page_id, trim(regexp_replace(lower(replace(replace(url, '(', ''), ')', '')), '[^a-z0-9_]+', '_', 'g'), '_') AS label FROM pages""")
def snake_labels(spark, sf):
    return t(spark, sf, "pages").select("page_id", T.snake("url").alias("label"))


@query("""SELECT page_id, nullif(trim(regexp_replace(regexp_replace(lower(trim(url)), '^https?://(?:dx\\.)?doi\\.org/', ''), '/(?:full|pdf|html).*$', ''), ' .'), '') AS doi_norm FROM pages""")
def doi_normalise(spark, sf):
    return t(spark, sf, "pages").select("page_id", I.normalize_doi("url").alias("doi_norm"))


@query("""SELECT o_orderkey, CASE WHEN length(d) = 8 THEN substr(d, 1, 4) || '-' || substr(d, 5, 4) END AS issn FROM
(SELECT o_orderkey, regexp_replace('X' || (o_orderkey * 7919)::VARCHAR || '-', '[^0-9]', '', 'g') AS d FROM orders)""")
def issn_normalise(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", I.normalize_issn(F.concat(F.lit("X"), (F.col("o_orderkey") * 7919).cast("string"), F.lit("-"))).alias("issn"))


@query("SELECT c_custkey, upper(regexp_extract(replace(c_name, '#', ' '), '(\\S+)$', 1)) || '|' || upper(substr(c_name, 1, 1)) AS key FROM customer")
def name_key(spark, sf):
    return t(spark, sf, "customer").select("c_custkey", I.name_key(F.replace("c_name", F.lit("#"), F.lit(" "))).alias("key"))


@query("SELECT p_partkey, regexp_extract(p_name, '^(\\S+)', 1) || CASE WHEN p_name LIKE '% %' THEN ' ' || list_aggregate(list_transform(string_split(p_name, ' ')[2:], lambda w: substr(w, 1, 1)), 'string_agg', '') ELSE ' ' END AS abbreviated FROM part")
def abbrev_name(spark, sf):
    return t(spark, sf, "part").select("p_partkey", I.abbreviated_name("p_name").alias("abbreviated"))


@query("""SELECT o_orderkey, 'CLERK ' || o_orderstatus || ', ' || year(o_orderdate)::VARCHAR || ', ' || upper(replace(o_orderpriority, '.', '')) AS sr FROM orders""")
def sr_key(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", I.reference_key(F.concat("o_orderstatus", F.lit(" clerk; x")), F.year("o_orderdate"), "o_orderpriority").alias("sr"))


@query("SELECT o_orderkey, nullif(regexp_extract('a ' || strftime(o_orderdate, '%Y') || ' b 1801', '\\b(?:19|20)\\d{2}\\b'), '') AS year FROM orders")
def year_parse(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", P.reference_year(F.concat(F.lit("a "), F.date_format("o_orderdate", "yyyy"), F.lit(" b 1801"))).alias("year"))


@query("SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '\\s+', ';', 'g'), ';'), lambda x: trim(x)), lambda x: contains(x, '@')) AS emails FROM documents")
def email_extract(spark, sf):
    d = t(spark, sf, "documents")
    return d.select("doc_id", F.filter(P.emails(F.regexp_replace("text", r"\s+", ";")), lambda e: F.contains(e, F.lit("@"))).alias("emails"))


@query("""SELECT event_id, 'k v' || (json_extract_string(props, '$.k')) || ' k' AS abstract FROM events""")
def json_inverted_index(spark, sf):
    k = F.get_json_object("props", "$.k")
    index = F.map_from_arrays(F.array(F.lit("k"), F.concat(F.lit("v"), k)), F.array(F.array(F.lit(0), F.lit(2)), F.array(F.lit(1))))
    index = F.when(k.isNotNull(), index)
    return t(spark, sf, "events").select("event_id", P.abstract_from_index(index).alias("abstract"))


@query("""SELECT n_nationkey, split_part('ORCID/' || n_name, '/', -1) AS orcid, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey::VARCHAR END AS scopus FROM nation""")
def id_normalise(spark, sf):
    scopus = F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey").cast("string")).otherwise("X1")
    return t(spark, sf, "nation").select("n_nationkey", I.normalize_orcid(F.concat(F.lit("ORCID/"), "n_name")).alias("orcid"), I.scopus_author_id(scopus).alias("scopus"))


@query("""WITH a AS (SELECT c_custkey, c_name || ', ' || n_name || CASE WHEN c_custkey % 3 = 0 THEN ', x' ELSE '' END AS address FROM customer JOIN nation ON n_nationkey = c_nationkey),
m AS (SELECT c_custkey, address, n_name, length(address) - strpos(reverse(upper(address)), reverse(n_name)) - length(n_name) AS p FROM a JOIN nation
  ON regexp_matches(upper(address), '\\b' || n_name || '\\b'))
SELECT c_custkey, address, arg_max(n_name, (p, n_name)) AS country FROM m GROUP BY 1, 2""")
def country_match(spark, sf):
    nation = t(spark, sf, "nation")
    countries = nation.select(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") == 0, "ZZZ").alias("alpha2"), F.lit(None).cast("string").alias("alpha3"))
    a = t(spark, sf, "customer").join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
    a = a.select("c_custkey", F.concat("c_name", F.lit(", "), "n_name", F.when(F.col("c_custkey") % 3 == 0, ", x").otherwise("")).alias("address"))
    return extract_countries(a.withColumn("Affiliation", F.col("address")), countries).select("c_custkey", "address", F.col("Country").alias("country"))


# --- entity operators -------------------------------------------------------------------------------------------------


def _sources(spark, sf):
    """Customers and suppliers as the author rows of two sources."""
    c = t(spark, sf, "customer").select(
        F.col("c_custkey").alias("seq"), F.concat(F.lit("C"), "c_custkey").alias("AuthorID"), F.lit("X").alias("AuthorName"),
        F.concat(F.substring("c_mktsegment", 1, 3), F.lit(", N"), (F.col("c_nationkey") % 5).cast("string")).alias("AuthorFullName"),
        F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("0-"), (F.col("c_custkey") % 40).cast("string"))).alias("Orcid"),
        F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("a"), (F.col("c_custkey") % 60).cast("string"))).alias("OpenAlexAuthorID"),
        F.when(F.col("c_custkey") % 11 == 0, F.concat((F.col("c_custkey") % 30).cast("string"), F.lit("@x"))).alias("Email"),
    )
    s = t(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("seq"), F.concat(F.lit("S"), "s_suppkey").alias("AuthorID"), F.lit("X").alias("AuthorName"),
        F.concat(F.lit("AUT, N"), (F.col("s_nationkey") % 5).cast("string")).alias("AuthorFullName"), F.lit(None).cast("string").alias("Orcid"),
        F.when(F.col("s_suppkey") % 7 == 0, F.concat(F.lit("a"), (F.col("s_suppkey") % 60).cast("string"))).alias("OpenAlexAuthorID"), F.lit(None).cast("string").alias("Email"),
    )
    return R.union_by_name(c, s)


_AUTHORS = """a AS (SELECT 'C' || c_custkey AS AuthorID, substr(c_mktsegment, 1, 3) || ', N' || (c_nationkey % 5) AS AuthorFullName,
  CASE WHEN c_custkey % 5 = 0 THEN '0-' || (c_custkey % 40) END AS o, CASE WHEN c_custkey % 7 = 0 THEN 'A' || (c_custkey % 60) END AS oa,
  CASE WHEN c_custkey % 11 = 0 THEN (c_custkey % 30) || '@x' END AS e FROM customer
  UNION ALL SELECT 'S' || s_suppkey, 'AUT, N' || (s_nationkey % 5), NULL, CASE WHEN s_suppkey % 7 = 0 THEN 'A' || (s_suppkey % 60) END, NULL FROM supplier),
k AS (SELECT *, upper(substr(AuthorFullName, 1, 3)) || '|N' AS nk FROM a),
p0 AS (SELECT *, CASE WHEN o IS NOT NULL THEN 'ORCID:' || o WHEN oa IS NOT NULL THEN 'OA:' || oa WHEN e IS NOT NULL THEN 'NAMEEMAIL:' || nk || '|' || e ELSE 'NAME:' || nk END AS pid FROM k),
u1 AS (SELECT nk, min(pid) AS one FROM p0 WHERE pid LIKE 'ORCID:%' GROUP BY 1 HAVING min(pid) = max(pid)),
p1 AS (SELECT p0.* REPLACE (CASE WHEN pid LIKE 'NAME:%' AND one IS NOT NULL THEN one ELSE pid END AS pid) FROM p0 LEFT JOIN u1 USING (nk)),
u2 AS (SELECT nk, min(pid) AS one FROM p1 WHERE pid LIKE 'OA:%' GROUP BY 1 HAVING min(pid) = max(pid)),
p2 AS (SELECT p1.* REPLACE (CASE WHEN pid LIKE 'NAME:%' AND one IS NOT NULL THEN one ELSE pid END AS pid) FROM p1 LEFT JOIN u2 USING (nk)),
u3 AS (SELECT nk, e, min(pid) AS one FROM p2 WHERE pid LIKE 'ORCID:%' AND e IS NOT NULL GROUP BY 1, 2 HAVING min(pid) = max(pid)),
p AS (SELECT p2.* REPLACE (CASE WHEN pid LIKE 'NAMEEMAIL:%' AND one IS NOT NULL THEN one ELSE pid END AS pid) FROM p2 LEFT JOIN u3 USING (nk, e))"""


@query(f"""WITH {_AUTHORS} SELECT pid AS PersonID, arg_max(AuthorFullName, (length(AuthorFullName), AuthorFullName)) AS CanonicalName, min(o) AS Orcid,
coalesce(string_agg(DISTINCT oa, '; ' ORDER BY oa), '') AS OpenAlexIDs, string_agg(DISTINCT AuthorID, '; ' ORDER BY AuthorID) AS AuthorIDs,
coalesce(string_agg(DISTINCT e, '; ' ORDER BY e), '') AS Emails, string_agg(DISTINCT AuthorFullName, '; ' ORDER BY AuthorFullName) AS NameVariants, count(*) AS AliasCount FROM p GROUP BY 1""")
def consolidate_persons(spark, sf):
    return persons.consolidate(_sources(spark, sf))[0]


@query(f"WITH {_AUTHORS} SELECT DISTINCT pid AS PersonID, AuthorID FROM p")
def author_alias(spark, sf):
    return persons.consolidate(_sources(spark, sf))[1].select("PersonID", "AuthorID")


@query(f"""WITH {_AUTHORS} SELECT 'openalex_id' AS type, oa AS key, string_agg(DISTINCT o, '; ' ORDER BY o) AS orcids FROM p WHERE oa IS NOT NULL GROUP BY oa HAVING count(DISTINCT o) > 1
UNION ALL SELECT 'name_email', nk || '|' || e, string_agg(DISTINCT o, '; ' ORDER BY o) FROM p WHERE e IS NOT NULL GROUP BY nk, e HAVING count(DISTINCT o) > 1""")
def author_conflicts(spark, sf):
    return persons.consolidate(_sources(spark, sf))[2]


def _articles(spark, sf):
    o = t(spark, sf, "orders")
    doi = F.when(F.col("o_custkey") % 4 != 0, F.concat(F.lit("10.1/"), (F.col("o_custkey") % 300).cast("string")))
    a = o.select(F.col("o_orderkey").alias("seq"), F.concat(F.lit("A"), "o_orderkey").alias("SR"), doi.alias("doi"), F.year("o_orderdate").cast("string").alias("year"), F.lit("TRUE").alias("ismainarticle"))
    return a.where("seq % 2 = 0"), a.where("seq % 2 = 1")


_PAIRS = """a AS (SELECT o_orderkey AS seq, 'A' || o_orderkey AS SR, CASE WHEN o_custkey % 4 <> 0 THEN '10.1/' || (o_custkey % 300) END AS doi FROM orders),
w AS (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY seq) AS r FROM a WHERE seq % 2 = 0), s AS (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY seq) AS r FROM a WHERE seq % 2 = 1),
m AS (SELECT w.SR AS w, s.SR AS s, coalesce(w.doi, s.doi) AS doi FROM w FULL JOIN s ON w.doi = s.doi AND w.r = s.r)"""


@query(f"WITH {_PAIRS} SELECT coalesce(w, s) AS SR, doi, concat_ws(';', CASE WHEN w IS NOT NULL THEN 'wos' END, CASE WHEN s IS NOT NULL THEN 'scopus' END) AS sources_merged FROM m")
def merge_articles(spark, sf):
    return merge.merge_articles(*_articles(spark, sf))[0].select("SR", "doi", "sources_merged")


@query(f"""WITH {_PAIRS}, e AS (SELECT 'A' || l_orderkey AS a, 'R' || l_partkey || ', 19' || (10 + l_suppkey % 90)::VARCHAR AS b, l_orderkey % 2 AS k FROM lineitem)
SELECT DISTINCT coalesce(w, a) AS SR, b AS SR_ref FROM e LEFT JOIN m ON k = 1 AND s = a AND w IS NOT NULL""")
def merge_citations(spark, sf):
    _, primary = merge.merge_articles(*_articles(spark, sf))
    edges = t(spark, sf, "lineitem").select("l_orderkey", F.concat(F.lit("A"), "l_orderkey").alias("SR"), F.concat(F.lit("R"), "l_partkey", F.lit(", 19"), (10 + F.col("l_suppkey") % 90).cast("string")).alias("SR_ref"))
    wos, scopus = edges.where("l_orderkey % 2 = 0").drop("l_orderkey"), edges.where("l_orderkey % 2 = 1").drop("l_orderkey")
    return merge.merge_citations(wos, scopus, primary)


@query("""WITH r AS (SELECT o_orderkey AS seq, unnest(['SMITH J, 1999, J OLD, DOI 10.1000/A.' || (o_orderkey % 50), 'PAZ A, J NEW']) AS c FROM orders WHERE o_orderkey % 3 = 0)
SELECT 'A' || seq AS SR, CASE WHEN c LIKE 'SMITH%' THEN 'SMITH J, 1999, J OLD' ELSE 'PAZ A, J NEW' END AS SR_ref FROM r""")
def wos_citations(spark, sf):
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("seq"), F.concat(F.lit("A"), "o_orderkey").alias("SR"))
    refs = F.when(F.col("seq") % 3 == 0, F.concat(F.lit("SMITH J, 1999, J OLD, DOI 10.1000/A."), (F.col("seq") % 50).cast("string"), F.lit("; PAZ A, J NEW")))
    return references.wos_references(o.withColumn("references", refs))[1]


def _names(spark, sf):
    return t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("seq"), F.concat(F.lit("N"), (F.col("o_custkey") % 200).cast("string")).alias("AuthorName"),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("N"), (F.col("o_custkey") % 200).cast("string"))).otherwise(F.col("o_orderpriority")).alias("AuthorFullName"),
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("0-"), (F.col("o_orderkey") % 4).cast("string"))).alias("Orcid"),
    )


@query("""WITH x AS (SELECT o_orderkey AS seq, 'N' || (o_custkey % 200) AS n, CASE WHEN o_orderkey % 2 = 0 THEN 'N' || (o_custkey % 200) ELSE o_orderpriority END AS f,
  CASE WHEN o_orderkey % 3 = 0 THEN '0-' || (o_orderkey % 4) END AS o FROM orders),
a AS (SELECT n, f AS mf FROM (SELECT n, f, count(*) AS c, min(seq) AS s FROM x WHERE f <> n GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY n ORDER BY c DESC, s) = 1),
b AS (SELECT n, o AS mo FROM (SELECT n, o, count(*) AS c, min(seq) AS s FROM x WHERE o IS NOT NULL GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY n ORDER BY c DESC, s) = 1)
SELECT seq, n AS AuthorName, CASE WHEN f = n THEN coalesce(mf, f) ELSE f END AS AuthorFullName, coalesce(o, mo) AS Orcid FROM x LEFT JOIN a USING (n) LEFT JOIN b USING (n)""")
def enrich_author_names(spark, sf):
    return authors.enrich_names(_names(spark, sf)).select("seq", "AuthorName", "AuthorFullName", "Orcid")


@query("""WITH x AS (SELECT o_orderkey AS seq, 'N' || (o_custkey % 200) AS n, CASE WHEN o_orderkey % 2 = 0 THEN 'N' || (o_custkey % 200) ELSE o_orderpriority END AS f,
  CASE WHEN o_orderkey % 3 = 0 THEN '0-' || (o_orderkey % 4) END AS o, CASE WHEN o_orderkey % 5 = 0 THEN 'A' || (o_orderkey % 9) END AS a FROM orders),
few AS (SELECT n, count(DISTINCT f) <= 5 AS few FROM x GROUP BY 1), k AS (SELECT x.*, few, coalesce(o, '') AS ok FROM x JOIN few USING (n)),
m AS (SELECT n, ok, f AS name FROM (SELECT n, ok, f, count(*) AS c, min(seq) AS s FROM k WHERE few GROUP BY 1, 2, 3) QUALIFY row_number() OVER (PARTITION BY n, ok ORDER BY length(f) DESC, c DESC, s) = 1),
d AS (SELECT k.*, coalesce(name, f) AS name FROM k LEFT JOIN m USING (n, ok)),
b AS (SELECT n, name, o AS common FROM (SELECT n, name, o, count(*) AS c, min(seq) AS s FROM d WHERE few AND o IS NOT NULL GROUP BY 1, 2, 3) QUALIFY row_number() OVER (PARTITION BY n, name ORDER BY c DESC, s) = 1),
u AS (SELECT seq, d.n, d.name, CASE WHEN few THEN common ELSE o END AS o, a FROM d LEFT JOIN b ON b.n = d.n AND b.name = d.name), v AS (SELECT o, count(DISTINCT a) AS ids FROM u WHERE o IS NOT NULL GROUP BY 1)
SELECT seq, n AS "AuthorName", name AS "AuthorFullName", u.o AS "Orcid", a AS "OpenAlexAuthorID", CASE WHEN u.o IS NOT NULL AND ids > 1 AND a IS NOT NULL THEN 'OA:' || a WHEN u.o IS NOT NULL THEN 'ORCID:' || u.o
  WHEN a IS NOT NULL THEN 'OA:' || a ELSE 'NAME:' || upper(regexp_replace(name, '\\s+', '_', 'g')) END AS "AuthorID" FROM u LEFT JOIN v ON v.o = u.o""")
def unify_author_names(spark, sf):
    df = _names(spark, sf).withColumn("OpenAlexAuthorID", F.when(F.col("seq") % 5 == 0, F.concat(F.lit("A"), (F.col("seq") % 9).cast("string"))))
    return authors.unify_names(df)


@query("""WITH RECURSIVE c AS MATERIALIZED (SELECT row_number() OVER () AS id, conv_id, turn, string_split_regex(text, '\\s+') AS w FROM conversations),
n AS MATERIALIZED (SELECT id, conv_id, turn, list_transform(list_reverse(w)[1:len(w) - 1], lambda x: lower(x) || '@x.org') AS mails,
  list_transform(list_reverse(w)[1:len(w) - 1], lambda x: split_part(lower(x) || '@x.org', '@', 1)) AS users, list_transform(w, lambda x: lower(replace(replace(upper(x), 'ß', 'SS'), 'ẞ', 'SS') || ', A')) AS low FROM c),
p AS MATERIALIZED (SELECT id, users, list_transform(low, lambda x: {'last': trim(split_part(x, ',', 1)), 'initial': left(trim(substr(x, strpos(x, ',') + 1)), 1),
  'long': list_filter(string_split_regex(trim(replace(x, ',', ' ')), '\\s+'), lambda y: length(y) > 2)}) AS names FROM n),
walk AS (SELECT id, 0 AS k, range(1, len(users) + 1) AS rest, []::BIGINT[] AS taken FROM p
  UNION ALL SELECT id, k + 1, CASE WHEN best IS NULL THEN rest ELSE list_filter(rest, lambda i: i <> -best.i) END, list_append(taken, -best.i) FROM
  (SELECT walk.*, list_max(list_filter(list_transform(rest, lambda i: {'p': CASE WHEN name.last <> '' AND contains(users[i], name.last) THEN 3 ELSE 0 END + CASE WHEN name.initial <> '' AND contains(users[i], name.initial) THEN 2 ELSE 0 END
    + len(list_filter(name.long, lambda y: contains(users[i], y))), 'i': -i}), lambda b: b.p > 0)) AS best FROM (SELECT walk.*, users, names[k + 1] AS name FROM walk JOIN p USING (id) WHERE k < len(names)) walk))
SELECT conv_id, turn, list_transform(range(1, len(taken) + 1), lambda j: CASE WHEN len(mails) = len(low) THEN mails[j] WHEN taken[j] IS NOT NULL THEN mails[taken[j]]
  ELSE mails[rest[len(list_filter(taken[1:j], lambda o: o IS NULL))]] END) AS emails FROM walk JOIN n USING (id) WHERE k = len(low)""")
def email_assign(spark, sf):
    c = t(spark, sf, "conversations").select("conv_id", "turn", F.split("text", r"\s+").alias("w"))
    names = F.transform("w", lambda w: F.concat(F.upper(w), F.lit(", A")))
    mails = F.transform(F.slice(F.reverse("w"), F.lit(1), F.size("w") - 1), lambda w: F.concat(F.lower(w), F.lit("@x.org")))
    return c.select("conv_id", "turn", authors.assign_emails(names, mails).alias("emails"))


def _points(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda c: unicode(c)::INT)"


@query(f"""WITH t AS (SELECT upper(trim(p_name)) AS t, arg_min(b, s) AS target, min(s) AS seq FROM (SELECT p_name, min(p_brand) AS b, min(p_partkey) AS s FROM part WHERE p_partkey % 2 = 0 GROUP BY 1) GROUP BY 1),
v AS (SELECT DISTINCT upper(trim(replace(p_name, 'e', 'é'))) AS v FROM part WHERE p_partkey % 2 = 1),
c AS (SELECT *, CASE WHEN v = t THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * {LCS} / (len(v) + len(t)) END AS score FROM (SELECT *, {_points('v')} AS x, {_points('t')} AS y FROM v, t))
SELECT v AS title, t AS matched, target, score FROM c WHERE score >= 85 QUALIFY row_number() OVER (PARTITION BY v ORDER BY score DESC, seq) = 1""")
def fuzzy_title(spark, sf):
    p = t(spark, sf, "part")
    titles = p.where("p_partkey % 2 = 0").groupBy(F.col("p_name").alias("title")).agg(F.min("p_brand").alias("target"), F.min("p_partkey").alias("seq"))
    values = p.where("p_partkey % 2 = 1").select(F.concat(F.regexp_replace("p_name", "e", "é"), F.lit("")).alias("title")).distinct()
    return journals.match_titles(values, titles, 85.0)


def _windows(kind: str, a: str, b: str, where: str) -> str:
    """SQL: the shorter text beside every window of its length over the longer one, cut short at both ends, that begins or ends with one of its characters."""
    return f"""SELECT v, t, '{kind}' AS k, a, w AS b FROM (SELECT v, t, a, unnest(list_transform(range(1, len(lo) + len(a)), lambda e: lo[greatest(0, e - len(a)) + 1:e])) AS w
  FROM (SELECT v, t, CASE WHEN len({a}) <= len({b}) THEN {a} ELSE {b} END AS a, CASE WHEN len({a}) <= len({b}) THEN {b} ELSE {a} END AS lo FROM s WHERE {where})) WHERE w <> '' AND (contains(a, left(w, 1)) OR contains(a, right(w, 1)))"""


@query(f"""WITH tt AS (SELECT upper(trim(p_name)) AS t, arg_min(b, q) AS target, min(q) AS seq FROM (SELECT p_name, min(p_brand) AS b, min(p_partkey) AS q FROM part GROUP BY 1) GROUP BY 1),
p AS (SELECT v, t, target, seq, list_filter(string_split(v, ' '), lambda x: x <> '') AS vw, list_filter(string_split(t, ' '), lambda x: x <> '') AS tw FROM (SELECT DISTINCT upper(trim(p_name || ' extra')) AS v FROM part), tt),
s AS (SELECT *, greatest(len(v), len(t))::DOUBLE / least(len(v), len(t)) AS lengths, array_to_string(list_sort(vw), ' ') AS vs, array_to_string(list_sort(tw), ' ') AS ts, array_to_string(list_sort(list_distinct(vw)), ' ') AS vu,
  array_to_string(list_sort(list_distinct(tw)), ' ') AS tu, array_to_string(cw, ' ') AS both_, concat_ws(' ', nullif(array_to_string(cw, ' '), ''), nullif(array_to_string(dv, ' '), '')) AS l, concat_ws(' ', nullif(array_to_string(cw, ' '), ''), nullif(array_to_string(dt, ' '), '')) AS r,
  cw <> [] AND (dv = [] OR dt = []) AS covered FROM (SELECT *, list_sort(list_distinct(list_filter(vw, lambda x: list_contains(tw, x)))) AS cw, list_sort(list_distinct(list_filter(vw, lambda x: NOT list_contains(tw, x)))) AS dv,
  list_sort(list_distinct(list_filter(tw, lambda x: NOT list_contains(vw, x)))) AS dt FROM p)),
need AS (SELECT v, t, 'whole' AS k, v AS a, t AS b FROM s UNION ALL SELECT v, t, 'sort', vs, ts FROM s WHERE lengths < 1.5 UNION ALL SELECT v, t, 'set', l, r FROM s WHERE lengths < 1.5
  UNION ALL SELECT v, t, 'set', both_, l FROM s WHERE lengths < 1.5 AND both_ <> '' UNION ALL SELECT v, t, 'set', both_, r FROM s WHERE lengths < 1.5 AND both_ <> ''
  UNION ALL {_windows('part', 'v', 't', 'lengths >= 1.5')} UNION ALL {_windows('words', 'vs', 'ts', 'lengths >= 1.5')} UNION ALL {_windows('words', 'vu', 'tu', "lengths >= 1.5 AND both_ = ''")}),
d AS (SELECT a, b, 200.0::DOUBLE * {LCS} / (len(a) + len(b)) AS score FROM (SELECT a, b, {_points('a')} AS x, {_points('b')} AS y FROM (SELECT DISTINCT a, b FROM need))),
g AS (SELECT v, t, max(score) FILTER (k = 'whole') AS whole, coalesce(max(score) FILTER (k = 'sort'), 0) AS sort, coalesce(max(score) FILTER (k = 'set'), 0) AS set_, coalesce(max(score) FILTER (k = 'part'), 0) AS part, coalesce(max(score) FILTER (k = 'words'), 0) AS words
  FROM need JOIN d USING (a, b) GROUP BY 1, 2),
c AS (SELECT v, t, target, seq, CASE WHEN v = t THEN 100.0 WHEN lengths < 1.5 THEN greatest(whole, 0.95::DOUBLE * sort, 0.95::DOUBLE * CASE WHEN covered THEN 100 ELSE set_ END)
  ELSE greatest(whole, scale * part, 0.95::DOUBLE * scale * greatest(words, CASE WHEN both_ <> '' THEN 100 ELSE 0 END)) END AS score FROM (SELECT *, CASE WHEN lengths <= 8 THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END AS scale FROM s JOIN g USING (v, t)))
SELECT v AS title, t AS matched, target, score FROM c WHERE score >= 85 QUALIFY row_number() OVER (PARTITION BY v ORDER BY score DESC, seq) = 1""")
def fuzzy_title_weighted(spark, sf):
    p = t(spark, sf, "part")
    titles = p.groupBy(F.col("p_name").alias("title")).agg(F.min("p_brand").alias("target"), F.min("p_partkey").alias("seq"))
    return journals.match_titles(p.select(F.concat("p_name", F.lit(" extra")).alias("title")).distinct(), titles, 85.0, weighted=True)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers as authors of two sources, consolidated to persons."""
    return consolidate_persons(spark, sf)
