"""Operator 8: mixing sources to target weights by hierarchical budgeting, in DataFrame operations.

The token budget runs down the tree domain - language - source. At each node it is shared among
the children by weight; a child that can't use its share (its documents hold too few tokens, even
over EPOCHS readings) keeps what it can and its siblings share the rest. A subtree's capacity
bounds what it gets, so only what no sibling can take is left to its ancestor's other children.

A leaf then reads whole epochs of its documents, and of one further epoch, in an order seeded by
epoch and doc_id, the longest prefix that fits its tokens. Prefix sums go by ranges of the order
first, so no task ever holds a leaf.

Defined cases: null language or source is 'none', null text has no tokens; rows of one doc_id
in a leaf are taken or left together; a null doc_id counts as one id; fractions of a token that
rounding leaves over go to nobody; extra columns are kept, but
one with the output's name is replaced; no rows give no rows. Weights are
whole numbers of at least 1 that sum to at most 10,000 among siblings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staygrid.llm.common import materialize

SEED, EPOCHS, SHARE = "mix-1", 2, (1, 2)
DOMAIN_WEIGHTS = {"web": 5, "books": 3, "forum": 2, "other": 1}
LANG_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}
WORD = r"[^\x20\x09-\x0D]+"
_LEAF = ["_mix_domain", "_mix_lang", "_mix_source"]


def domain_of(source: Column) -> Column:
    """The domain of a source, by the last digit of its name."""
    digit = F.regexp_extract(source, "([0-9])$", 1)
    return F.when(digit.isin("0", "3", "6", "9"), "web").when(digit.isin("1", "4", "7"), "books").when(digit.isin("2", "5", "8"), "forum").otherwise("other")


def _weight(name: Column, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for key, weight in weights.items():
        out = F.when(name == key, weight).otherwise(out)
    return out.cast("long")


def share_out(nodes: DataFrame, parent: list[str], name: str, budget: str) -> DataFrame:
    """Add `got` to nodes that have weight and capacity: their part of the parent's `budget`.

    In order of capacity for each unit of weight, a node is filled if its share of what the ones
    before it leave is at least its capacity; the others share the rest by weight.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), name)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    filled = nodes.withColumn("full", F.col("capacity") * weights <= F.col("weight") * (F.col(budget) - before))
    group = Window.partitionBy(*parent)
    taken = F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(group)
    open_weight = F.sum(F.when(F.col("full"), F.lit(0)).otherwise(F.col("weight"))).over(group)
    part = filled.withColumns({"_taken": taken, "_open": open_weight})
    got = F.when(F.col("full"), F.col("capacity")).otherwise(F.expr(f"weight * ({budget} - _taken) div _open"))
    return part.withColumn("got", got).drop("_taken", "_open", "full")


def leaf_budgets(leaves: DataFrame, share: tuple[int, int] = SHARE, epochs: int = EPOCHS, domains: dict[str, int] | None = None, langs: dict[str, int] | None = None) -> DataFrame:
    """Tokens for each leaf of `leaves` (_mix_domain, _mix_lang, _mix_source, tokens): `got`."""
    domain, lang = _weight(F.col("_mix_domain"), domains or DOMAIN_WEIGHTS), _weight(F.col("_mix_lang"), langs or LANG_WEIGHTS)
    leaves = leaves.withColumn("capacity", F.col("tokens") * epochs)
    langs_of = leaves.groupBy("_mix_domain", "_mix_lang").agg(F.sum("capacity").alias("capacity"))
    top = langs_of.groupBy("_mix_domain").agg(F.sum("capacity").alias("capacity"))
    top = top.withColumns({"weight": domain, "every": F.lit(1)})  # a row for each domain
    top = top.withColumn("budget", F.expr(f"sum(capacity) over (partition by every) div {epochs} * {share[0]} div {share[1]}"))
    top = share_out(top, ["every"], "_mix_domain", "budget")
    middle = langs_of.join(top.select("_mix_domain", F.col("got").alias("budget")), "_mix_domain").withColumn("weight", lang)
    middle = share_out(middle, ["_mix_domain"], "_mix_lang", "budget")
    bottom = leaves.join(middle.select("_mix_domain", "_mix_lang", F.col("got").alias("budget")), ["_mix_domain", "_mix_lang"]).withColumn("weight", F.lit(1).cast("long"))
    return share_out(bottom, ["_mix_domain", "_mix_lang"], "_mix_source", "budget").select(*_LEAF, "tokens", "got")


def _order(epoch: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(SEED), F.col(epoch).cast("string"), F.coalesce(F.col("_mix_id"), F.lit(""))))


def _cuts(units: DataFrame, plan: DataFrame) -> DataFrame:
    """The last place in the order that each leaf's further epoch takes."""
    seeded = units.join(plan.where("rest > 0").select(*_LEAF, "epochs", "rest"), _LEAF).withColumn("place", _order("epochs"))
    ranges = seeded.groupBy(*_LEAF, F.substring("place", 1, 3).alias("range")).agg(F.sum("tokens").alias("sum"), F.max("place").alias("last"), F.first("rest").alias("rest"))
    along = Window.partitionBy(*_LEAF).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)  # at most 4,096 rows
    ranges = ranges.withColumn("upto", F.sum("sum").over(along))
    whole = ranges.where("upto <= rest").select(*_LEAF, "last")
    edge = ranges.where("upto > rest and upto - sum <= rest").select(*_LEAF, "range", (F.col("upto") - F.col("sum")).alias("base"))
    inside = seeded.withColumn("range", F.substring("place", 1, 3)).join(edge, [*_LEAF, "range"])
    within = Window.partitionBy(*_LEAF, "range").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("upto", F.col("base") + F.sum("tokens").over(within)).where("upto <= rest").select(*_LEAF, F.col("place").alias("last"))
    return whole.unionByName(inside).groupBy(*_LEAF).agg(F.max("last").alias("cut"))


def mix(docs: DataFrame, share: tuple[int, int] = SHARE, epochs: int = EPOCHS, domains: dict[str, int] | None = None, langs: dict[str, int] | None = None, output: str = "mixed") -> DataFrame:
    """`docs` (doc_id, text, lang, source) with a struct `output`: domain, n_tokens and n_selected."""
    text, source = F.col("text").cast("string"), F.coalesce(F.col("source").cast("string"), F.lit("none"))
    named = docs.withColumns({
        "_mix_id": F.col("doc_id").cast("string"), "_mix_domain": domain_of(source), "_mix_lang": F.coalesce(F.col("lang").cast("string"), F.lit("none")),
        "_mix_source": source, "_mix_tokens": F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"),
    })
    units = materialize(named.groupBy(*_LEAF, "_mix_id").agg(F.sum("_mix_tokens").alias("tokens")), "units")
    plan = leaf_budgets(units.groupBy(*_LEAF).agg(F.sum("tokens").alias("tokens")), share, epochs, domains, langs)
    plan = plan.withColumn("epochs", F.expr("if(tokens = 0, 0, got div tokens)")).withColumn("rest", F.expr("got - epochs * tokens"))
    plan = materialize(plan, "plan")
    plan = materialize(plan.join(_cuts(units, plan), _LEAF, "left"), "cuts").select(*_LEAF, F.col("epochs").alias("_mix_epochs"), F.col("cut").alias("_mix_cut"))
    joined = named.join(plan, _LEAF)
    more = F.coalesce((_order("_mix_epochs") <= F.col("_mix_cut")).cast("long"), F.lit(0))
    mixed = F.struct(F.col("_mix_domain").alias("domain"), F.col("_mix_tokens").alias("n_tokens"), (F.col("_mix_epochs") + more).alias("n_selected"))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns if c != output], mixed.alias(output))


_SHARE_SQL = """
SELECT *, CASE WHEN filled THEN capacity ELSE (weight * (budget - CAST(sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER (PARTITION BY {parent}) AS BIGINT)))
  // CAST(sum(CASE WHEN filled THEN 0 ELSE weight END) OVER (PARTITION BY {parent}) AS BIGINT) END AS got
FROM (SELECT *, capacity * sum(weight) OVER (PARTITION BY {parent} ORDER BY capacity / weight, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
  <= weight * (budget - coalesce(sum(capacity) OVER (PARTITION BY {parent} ORDER BY capacity / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled FROM {nodes})
"""
ORACLE = rf"""
WITH named AS (SELECT doc_id, coalesce(lang, 'none') AS lang0, coalesce(source, 'none') AS source0, lang, source,
    CASE WHEN regexp_extract(source, '([0-9])$', 1) IN ('0', '3', '6', '9') THEN 'web' WHEN regexp_extract(source, '([0-9])$', 1) IN ('1', '4', '7') THEN 'books'
         WHEN regexp_extract(source, '([0-9])$', 1) IN ('2', '5', '8') THEN 'forum' ELSE 'other' END AS domain,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang0, source0, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) AS BIGINT) * {EPOCHS} AS capacity FROM named GROUP BY ALL),
top0 AS (SELECT 1 AS every, domain, CAST(sum(capacity) AS BIGINT) AS capacity, CAST((SELECT sum(tokens) FROM leaves) AS BIGINT) * {SHARE[0]} // {SHARE[1]} AS budget,
    CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'forum' THEN 2 ELSE 1 END AS weight FROM leaves GROUP BY domain),
top AS ({_SHARE_SQL.format(parent="every", name="domain", nodes="top0")}),
middle0 AS (SELECT domain, lang0, CAST(sum(leaves.capacity) AS BIGINT) AS capacity, any_value(top.got) AS budget,
    CASE lang0 WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS weight FROM leaves JOIN top USING (domain) GROUP BY domain, lang0),
middle AS ({_SHARE_SQL.format(parent="domain", name="lang0", nodes="middle0")}),
bottom0 AS (SELECT leaves.*, middle.got AS budget, 1 AS weight FROM leaves JOIN middle USING (domain, lang0)),
bottom AS ({_SHARE_SQL.format(parent="domain, lang0", name="source0", nodes="bottom0")}),
plan AS (SELECT domain, lang0, source0, CASE WHEN tokens = 0 THEN 0 ELSE got // tokens END AS epochs, got - CASE WHEN tokens = 0 THEN 0 ELSE got // tokens END * tokens AS rest FROM bottom),
seeded AS (SELECT named.*, epochs, rest, sum(n_tokens) OVER (PARTITION BY domain, lang0, source0
    ORDER BY md5('{SEED}:' || epochs || ':' || doc_id) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM named JOIN plan USING (domain, lang0, source0))
SELECT doc_id, domain, lang, source, n_tokens, CAST(epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS n_selected FROM seeded
"""
