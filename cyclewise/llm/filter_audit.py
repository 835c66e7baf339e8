"""How document filters interact: order effects and exact Shapley values.

A filter removes the documents that fail its condition, so a set of filters (a coalition)
removes the documents that fail any of them. The removals of all coalitions (32 for five
filters) are tabulated per part of the corpus, once for all documents and once for every
marked kind (labelled good, labelled toxic). Everything else follows from that table:

* what a filter removes at a step of an order is the difference of two coalitions;
* the Shapley values are the constrained least squares fit of an additive game to the
  table: squared errors are weighed by the Shapley kernel and the values have to add up
  to the removal of all filters. The normal equations with that constraint do not depend
  on the data, so they are solved once, in rationals, for every unit table; the solution
  times ``n!`` is whole, and a part's values are one whole combination of its table.

Only column expressions, one join with the labels and aggregates are used. Texts are read
once, as a digest and four failed conditions. Repeated texts, also one text shared by a
third of all rows, are combined before they meet in one task; the join that brings the
smallest id of a text back is a plain equi-join on digests, one row per text and part.

Defined results: a null text counts as empty, so null and empty texts are equal; a null
part counts as the empty string; a null id is neither smaller nor larger than another, so
such rows never fail the comparison with smaller ids, and no label belongs to them;
repeated rows count as often as they come, and rows of one id do not repeat each other;
an id counts as good or toxic if any of its label rows says so; an empty table gives an
empty table. Extra columns are not read.
"""

from __future__ import annotations

import math
from fractions import Fraction
from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclewise.llm.common import prepare

FILTERS = "ABCDE"
#: Words are separated by blanks and the control characters tab to carriage return.
WORD_BREAK = r"[\x20\x09-\x0D]+"
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_UPPER_PERCENT = 2
SYMBOL = r"[#$%&*|]"
#: Bit of the filter that needs the other texts.
REPEAT = FILTERS.index("E")
KINDS = ("all", "good", "toxic")


def shapley_operator(n: int) -> list[list[Fraction]]:
    """Row ``i`` holds the weight of every coalition's worth in the Shapley value of player ``i``.

    Minimises the kernel-weighted squared error over proper coalitions under the efficiency
    constraint: the normal equations are bordered by the constraint and solved for the unit
    worth of each coalition by elimination in rationals.
    """
    everyone = (1 << n) - 1
    members = [[i for i in range(n) if s >> i & 1] for s in range(1 << n)]

    def kernel(s: int) -> Fraction:
        k = len(members[s])
        return Fraction(n - 1, math.comb(n, k) * k * (n - k))

    proper = range(1, everyone)
    rows = [[Fraction(0)] * (n + 1 + (1 << n)) for _ in range(n + 1)]
    for s in proper:
        weight = kernel(s)
        for i in members[s]:
            for j in members[s]:
                rows[i][j] += weight
            rows[i][n + 1 + s] += weight
    for i in range(n):
        rows[i][n] = rows[n][i] = Fraction(1)
    rows[n][n + 1 + everyone] = Fraction(1)
    for at in range(n + 1):
        pivot = next(r for r in range(at, n + 1) if rows[r][at] != 0)
        rows[at], rows[pivot] = rows[pivot], rows[at]
        lead = rows[at][at]
        rows[at] = [v / lead for v in rows[at]]
        for r in range(n + 1):
            factor = rows[r][at]
            if r != at and factor != 0:
                rows[r] = [a - factor * b for a, b in zip(rows[r], rows[at])]
    return [rows[i][n + 1 :] for i in range(n)]


def failures(text: Column) -> Column:
    """Bits of the conditions that a text fails by itself."""
    words = F.array_remove(F.split(text, WORD_BREAK), "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    tests = [
        n_words < LEAST_WORDS,
        n_distinct.cast("long") * 100 < n_words.cast("long") * LEAST_DISTINCT_PERCENT,
        upper * 100 > F.length(text).cast("long") * MOST_UPPER_PERCENT,
        text.rlike(SYMBOL),
    ]
    mask = F.lit(0)
    for bit, test in enumerate(tests):
        mask = mask + F.when(test, 1 << bit).otherwise(0)
    return mask


def _marked(labels: DataFrame) -> DataFrame:
    """Ids that some label row calls good or toxic."""
    marks = labels.groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    return marks.filter("good OR toxic")


def failure_counts(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """``part, mask, good, toxic, n``: documents by the exact set of filters that they fail."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        failures(text).alias("mask"),
    )
    of_text = ["digest", "part", "mask", "good", "toxic"]
    once = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    known = once.join(_marked(labels), "doc_id", "left").fillna(False, ["good", "toxic"])
    has_id = F.col("doc_id").isNotNull()
    texts = known.groupBy(*of_text).agg(
        F.sum("n").alias("n"),
        F.min(F.when(has_id, F.struct("doc_id", "n"))).alias("smallest"),
        F.coalesce(F.sum(F.when(~has_id, F.col("n"))), F.lit(0)).alias("without_id"),
    )
    first = texts.groupBy("digest").agg(F.min("smallest.doc_id").alias("first"))
    is_first = F.col("smallest.doc_id") == F.col("first")
    passing = F.col("without_id") + F.when(is_first, F.col("smallest.n")).otherwise(0)
    split = F.array(
        F.struct(F.col("mask").alias("mask"), passing.alias("n")),
        F.struct((F.col("mask") + (1 << REPEAT)).alias("mask"), (F.col("n") - passing).alias("n")),
    )
    by_text = texts.join(first, "digest").select("part", "good", "toxic", F.inline(split))
    counts = by_text.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    return counts.filter("n > 0")


def coalition_table(counts: DataFrame, n_filters: int = len(FILTERS)) -> DataFrame:
    """Per part, the documents and what every coalition removes of each kind.

    ``total`` counts documents; the arrays ``all``, ``good`` and ``toxic`` hold at place
    ``s`` what the filters in the bits of ``s`` remove together.
    """
    of_kind = {"all": F.lit(True), "good": F.col("good"), "toxic": F.col("toxic")}

    def removed(kind: str, coalition: int) -> Column:
        hit = of_kind[kind] & (F.col("mask").bitwiseAND(F.lit(coalition)) != 0)
        return F.sum(F.when(hit, F.col("n")).otherwise(0))

    return counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        *[F.array(*[removed(k, s) for s in range(1 << n_filters)]).alias(k) for k in KINDS],
    )


def _steps(letters: str) -> Column:
    """Every order and step as ``(filter_order, step, bit, alone, before, after)``, coalitions as bits."""
    rows = []
    for order in permutations(range(len(letters))):
        before = 0
        for step, bit in enumerate(order, 1):
            after = before | 1 << bit
            name = "".join(letters[i] for i in order)
            rows.append(f"struct('{name}', {step}, {bit}, {1 << bit}, {before}, {after})")
            before = after
    kind = "array<struct<filter_order:string,step:int,bit:int,alone:int,before:int,after:int>>"
    return F.expr(f"CAST(array({', '.join(rows)}) AS {kind})")


def interactions(table: DataFrame, letters: str = FILTERS) -> DataFrame:
    """One row per part, order and step from the coalitions' removals."""
    n = len(letters)
    everyone = (1 << n) - 1
    whole = math.factorial(n)
    values = []
    for row in shapley_operator(n):
        value = F.lit(0).cast("long")
        for s, weight in enumerate(row):
            if weight * whole != 0:
                assert (weight * whole).denominator == 1
                value = value + F.get("all", F.lit(s)) * F.lit(int(weight * whole))
        values.append(value)

    def worth(kind: str, coalition: Column) -> Column:
        return F.get(kind, coalition)

    before, after, alone = F.col("before"), F.col("after"), F.col("alone")
    others = F.lit(everyone) - alone
    removed = worth("all", after) - worth("all", before)
    stepped = table.withColumn("shapleys", F.array(*values)).select("*", F.inline(_steps(letters)))
    return stepped.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - worth("all", after)).alias("kept"),
        removed.alias("removed"),
        (worth("all", alone) - removed).alias("redundant"),
        (worth("all", F.lit(everyone)) - worth("all", others)).alias("unique_fails"),
        (worth("good", after) - worth("good", before)).alias("good_lost"),
        (worth("toxic", after) - worth("toxic", before)).alias("toxic_lost"),
        F.get("shapleys", F.col("bit")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The five filters over every document, in all orders, per value of ``part``."""
    prepare(docs.sparkSession)
    return interactions(coalition_table(failure_counts(docs, labels, part)))


def audit_sql() -> str:
    """The same rows by applying the filters step by step, without coalitions."""
    space = "chr(32) || chr(9) || '-' || chr(13)"
    return f"""
    WITH words AS (
      SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
             list_filter(string_split_regex(coalesce(text, ''), '[' || {space} || ']+'),
                         lambda w: w <> '') AS w
      FROM documents),
    firsts AS (SELECT body, min(doc_id) AS first_id FROM words GROUP BY body),
    marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                     max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
    failed AS (
      SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        concat(
          CASE WHEN len(w) < {LEAST_WORDS} THEN 'A' ELSE '' END,
          CASE WHEN 100 * len(list_distinct(w)) < {LEAST_DISTINCT_PERCENT} * len(w) THEN 'B' ELSE '' END,
          CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]+', '', 'g')) > {MOST_UPPER_PERCENT} * length(body)
               THEN 'C' ELSE '' END,
          CASE WHEN regexp_matches(body, '{SYMBOL}') THEN 'D' ELSE '' END,
          CASE WHEN doc_id > first_id THEN 'E' ELSE '' END) AS fails
      FROM words JOIN firsts USING (body) LEFT JOIN marks USING (doc_id)),
    grouped AS (SELECT part, fails, good, toxic, count(*) AS n FROM failed GROUP BY ALL),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (
      SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
      FROM letters a, letters b, letters c, letters d, letters e
      WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x)
        AND e.x NOT IN (a.x, b.x, c.x, d.x)),
    steps AS (
      SELECT filter_order, step, substr(filter_order, step, 1) AS letter,
             substr(filter_order, 1, step - 1) AS earlier
      FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
    played AS (
      SELECT part, filter_order, step, letter, n, good, toxic, fails,
             contains(fails, letter) AS hit,
             earlier <> '' AND len(list_intersect(string_split(fails, ''), string_split(earlier, ''))) > 0 AS gone
      FROM grouped, steps),
    summed AS (
      SELECT part, filter_order, step, letter,
        sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN gone AND hit THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN NOT gone AND hit AND good = 1 THEN n ELSE 0 END) AS good_lost,
        sum(CASE WHEN NOT gone AND hit AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
      FROM played GROUP BY part, filter_order, step, letter)
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
      CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
      CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
      CAST(toxic_lost AS BIGINT) AS toxic_lost,
      CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
    FROM summed"""
