"""Mixing sources to target weights with a hierarchical token budget.

Documents form a tree domain -> language -> source. A token budget flows from the root
down by integer weights. A node never gets more than it can supply, ``max_epochs`` times
the tokens below it; what a node cannot take goes to its siblings by weight, and only if
all siblings are full is it missing at their parent, where it had been taken from the
parent's siblings in the same way. Each leaf then takes whole seeded epochs of its
documents and, of the next epoch, the longest prefix in seeded order that fits.

Only column expressions, joins and aggregates are used. A prefix sum over a hot leaf is
never one task: documents are cut into ranges of their order key, ranges are summed, and
only the range in which the quota ends is ordered row by row.

Defined results: null language or source count as ``unknown``; null texts have no tokens
and go with the documents around them; rows with the same id (repeated rows, null ids)
share an order key and are taken or left together; leaves without tokens give nothing; an
empty table gives an empty table. Other columns are kept, and columns with the names
``domain``, ``language``, ``origin``, ``epoch`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclewise.llm.common import prepare, stored

LEVELS = ["domain", "language", "origin"]

#: Production weights; names that are not listed weigh ``DEFAULT_WEIGHT``.
WEIGHTS = {
    "domain": {"d0": 40, "d1": 30, "d2": 20, "d3": 10},
    "language": {"en": 50, "fr": 20, "de": 20, "es": 10},
    "origin": {},
}
DEFAULT_WEIGHT = 10
BUDGET_PERCENT = 70
MAX_EPOCHS = 2
SEED = 7
DOMAINS = 4

#: Hex digits of the order key (60 bits) and rows aimed at in one range of keys.
KEY_DIGITS = 15
RANGE_ROWS = 20_000
#: A plan of at most so many leaves (about 100 bytes each) is sent to every task.
SMALL_PLAN = 50_000
#: Non-blank runs count as tokens.
TOKEN = r"[^ \t\n\r]+"


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def _hex_number(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def tree_columns() -> dict[str, Column]:
    """Domain (a fixed hash of the source), language and source, never null."""
    source = F.coalesce("source", F.lit("unknown"))
    return {
        "domain": F.concat(F.lit("d"), (_hex_number(F.md5(source.cast("binary")), 4) % DOMAINS).cast("string")),
        "language": F.coalesce("lang", F.lit("unknown")),
        "origin": source,
    }


def order_key(doc_id: Column, epoch: Column, seed: int = SEED) -> Column:
    """60-bit key of a document in an epoch; the same on every engine with MD5."""
    name = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return _hex_number(F.md5(name.cast("binary")), KEY_DIGITS)


def _weight(level: str, weights: dict) -> Column:
    known = weights.get(level) or {}
    case = F.lit(DEFAULT_WEIGHT)
    for name, w in known.items():
        case = F.when(F.col(level) == name, w).otherwise(case)
    return case.cast("long")


def _share(nodes: DataFrame, parent: list[str], level: str) -> DataFrame:
    """Spread ``given`` of each parent over its children; adds ``alloc``.

    In ascending order of capacity by weight the full children form a prefix: child i is
    full if its fair share of what the earlier ones leave covers its capacity.
    """
    family = Window.partitionBy(*(parent or [F.lit(0)]))
    ranked = family.orderBy(F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(1e300)), level)
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
    nodes = nodes.withColumn(
        "weight_left", F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    nodes = nodes.withColumn(
        "full", F.col("cap") * F.col("weight_left") <= F.col("weight") * (F.col("given") - F.col("cap_before"))
    )
    spent = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(family), F.lit(0))
    open_weight = F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(family), F.lit(0))
    nodes = nodes.withColumns({"rest": F.col("given") - spent, "open_weight": open_weight})
    alloc = (
        F.when(F.col("full"), F.col("cap"))
        .when(F.col("open_weight") == 0, F.lit(0))
        .otherwise(F.expr("weight * rest div open_weight"))
    )
    return nodes.withColumn("alloc", alloc.cast("long")).drop("cap_before", "weight_left", "full", "rest", "open_weight")


def plan_quotas(
    leaves: DataFrame,
    weights: dict = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """Leaves (``domain, language, origin, tokens, docs``) with their token ``quota``."""
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    root = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total"))
    given = root.select(F.expr(f"total * {budget_percent} div 100").cast("long").alias("given"))
    for depth, level in enumerate(LEVELS):
        path = LEVELS[: depth + 1]
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(level, weights))
        nodes = nodes.join(given, LEVELS[:depth]) if depth else nodes.join(F.broadcast(given))  # one row
        given = _share(nodes, LEVELS[:depth], level).select(*path, F.col("alloc").alias("given"))
    return leaves.drop("cap").join(given.withColumnRenamed("given", "quota"), LEVELS)


def plan_mix(
    rows: DataFrame,
    weights: dict = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """Leaves with ``whole_epochs`` and the last order key ``cutoff`` of the next epoch.

    ``rows`` holds ``doc_id``, the tree columns and ``n_tokens``.
    """
    leaves = stored(
        plan_quotas(
            rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")),
            weights, budget_percent, max_epochs,
        )
        .withColumn("whole_epochs", F.when(F.col("tokens") > 0, F.expr("quota div tokens")).otherwise(0).cast("long"))
        .withColumn("rest", F.when(F.col("tokens") > 0, F.expr("quota % tokens")).otherwise(0).cast("long")),
        "mix-leaves",
    )
    largest = leaves.agg(F.max("docs")).first()[0] or 0
    small = leaves.count() <= SMALL_PLAN
    shift = 4 * KEY_DIGITS - max(4, min(20, (largest // RANGE_ROWS).bit_length()))
    part = leaves.filter("rest > 0").select(*LEVELS, "whole_epochs", "rest")
    keyed = rows.join(F.broadcast(part) if small else part, LEVELS).select(
        *LEVELS, "n_tokens", "rest", order_key(F.col("doc_id"), F.col("whole_epochs"), seed).alias("key")
    )
    keyed = keyed.withColumn("key_range", F.shiftright("key", shift))
    summed = keyed.groupBy(*LEVELS, "key_range").agg(F.sum("n_tokens").alias("tokens"), F.first("rest").alias("rest"))
    upto = Window.partitionBy(*LEVELS).orderBy("key_range").rowsBetween(Window.unboundedPreceding, 0)
    summed = summed.withColumn("upto", F.sum("tokens").over(upto))
    last = (
        summed.filter("upto > rest")
        .groupBy(*LEVELS)
        .agg(F.min_by(F.struct("key_range", (F.col("upto") - F.col("tokens")).alias("before")), "key_range").alias("at"))
        .select(*LEVELS, "at.key_range", "at.before")
    )
    near = keyed.join(last, [*LEVELS, "key_range"]).groupBy(*LEVELS, "key").agg(
        F.sum("n_tokens").alias("tokens"), F.first("rest").alias("rest"), F.first("before").alias("before")
    )
    within = Window.partitionBy(*LEVELS).orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("fits", F.col("before") + F.sum("tokens").over(within) <= F.col("rest"))
    inside = near.groupBy(*LEVELS).agg(F.max(F.when(F.col("fits"), F.col("key"))).alias("inside"))
    cutoffs = last.join(inside, LEVELS).select(
        *LEVELS, F.coalesce("inside", F.shiftleft("key_range", shift) - 1).alias("cutoff")
    )
    plan = leaves.join(cutoffs, LEVELS, "left").withColumn("cutoff", F.coalesce("cutoff", F.lit(-1)))
    return F.broadcast(plan) if small else plan


def take_mix(rows: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """Rows the plan selects, once per ``epoch``; ``rows`` has ``doc_id`` and the tree columns."""
    kept = [c for c in rows.columns if c != "epoch"]
    leaf = plan.select(
        *LEVELS, F.col("whole_epochs").alias("_mix_whole"), F.col("cutoff").alias("_mix_cutoff")
    )
    chosen = rows.select(*kept).join(leaf, LEVELS)
    extra = order_key(F.col("doc_id"), F.col("_mix_whole"), seed) <= F.col("_mix_cutoff")
    chosen = chosen.withColumn("_mix_copies", (F.col("_mix_whole") + extra.cast("long")).cast("int"))
    chosen = chosen.filter("_mix_copies > 0")
    return chosen.select(*kept, F.explode(F.sequence(F.lit(0), F.col("_mix_copies") - 1)).alias("epoch"))


def counted(docs: DataFrame) -> DataFrame:
    """Narrow rows (id, tree columns, tokens) kept for the passes over the tree."""
    return stored(
        docs.select("doc_id", *[c.alias(n) for n, c in tree_columns().items()], n_tokens(F.col("text")).alias("n_tokens")),
        "mix-rows",
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The selected documents with their columns, tree columns and ``epoch``."""
    prepare(docs.sparkSession)
    plan = plan_mix(counted(docs), **options)
    return take_mix(docs.withColumns(tree_columns()), plan, options.get("seed", SEED))


def _sql_weight(level: str) -> str:
    cases = " ".join(f"WHEN {level} = '{n}' THEN {w}" for n, w in WEIGHTS[level].items())
    return f"CAST(CASE {cases} ELSE {DEFAULT_WEIGHT} END AS BIGINT)" if cases else f"CAST({DEFAULT_WEIGHT} AS BIGINT)"


def mix_sql() -> str:
    """The same selection over ``documents`` for DuckDB."""
    steps, given = [], "root"
    for depth, level in enumerate(LEVELS):
        path, up = ", ".join(LEVELS[: depth + 1]), LEVELS[:depth]
        family = f"PARTITION BY {', '.join(up)}" if up else ""
        nodes = f"SELECT {path}, CAST(sum(tokens) * {MAX_EPOCHS} AS BIGINT) AS cap FROM leaves GROUP BY {path}"
        join = f"JOIN {given} USING ({', '.join(up)})" if up else f"CROSS JOIN {given}"
        before = (
            f"OVER ({family} ORDER BY CASE WHEN weight > 0 THEN cap / weight ELSE 1e300 END, {level} "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        )
        steps.append(f"""
n{depth} AS (SELECT nodes.*, given, {_sql_weight(level)} AS weight FROM ({nodes}) nodes {join}),
o{depth} AS (SELECT *, coalesce(sum(cap) {before}, 0) AS cap_before,
       sum(weight) OVER ({family}) - coalesce(sum(weight) {before}, 0) AS weight_left FROM n{depth}),
f{depth} AS (SELECT *, cap * weight_left <= weight * (given - cap_before) AS is_full FROM o{depth}),
r{depth} AS (SELECT *, given - coalesce(sum(cap) FILTER (WHERE is_full) OVER ({family}), 0) AS rest,
       coalesce(sum(weight) FILTER (WHERE NOT is_full) OVER ({family}), 0) AS open_weight FROM f{depth}),
g{depth} AS (SELECT {path}, CAST(CASE WHEN is_full THEN cap WHEN open_weight = 0 THEN 0
       ELSE (weight * rest) // open_weight END AS BIGINT) AS given FROM r{depth})""")
        given = f"g{depth}"
    tree = ", ".join(LEVELS)
    return f"""
WITH rows_ AS (
  SELECT doc_id, coalesce(lang, 'unknown') AS language, coalesce(source, 'unknown') AS origin,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{TOKEN}')) AS BIGINT) AS n_tokens,
         'd' || CAST('0x' || substr(md5(coalesce(source, 'unknown')), 1, 4) AS BIGINT) % {DOMAINS} AS domain
  FROM documents),
leaves AS (SELECT {tree}, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM rows_ GROUP BY {tree}),
root AS (SELECT CAST(coalesce(sum(tokens), 0) * {BUDGET_PERCENT} // 100 AS BIGINT) AS given FROM leaves),
{','.join(s.strip() for s in steps)},
planned AS (
  SELECT leaves.*, CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS whole_epochs,
         CASE WHEN tokens > 0 THEN given % tokens ELSE 0 END AS rest
  FROM leaves JOIN {given} USING ({tree})),
keyed AS (
  SELECT rows_.*, whole_epochs, rest,
         CAST('0x' || substr(md5('{SEED}:' || whole_epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, {KEY_DIGITS}) AS BIGINT) AS key
  FROM rows_ JOIN planned USING ({tree})),
taken AS (
  SELECT *, whole_epochs + CAST(rest > 0 AND upto <= rest AS BIGINT) AS copies
  FROM (SELECT *, sum(n_tokens) OVER (PARTITION BY {tree} ORDER BY key) AS upto FROM keyed) summed)
SELECT doc_id, domain, language, origin, n_tokens, CAST(unnest(range(copies)) AS INTEGER) AS epoch FROM taken
"""
