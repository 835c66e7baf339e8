"""Text quality by a sparse rule ensemble.

Statistics of the whole text are built-in column expressions. A forest of shallow trees is
fitted on labelled rows; every path from a root to one of its nodes becomes a conjunctive
rule (bounds on statistics). A logistic regression with an L1 penalty weighs the rules, and
those with a weight are compiled into one column expression, so scoring needs no model
object and no Python.

The texts are read once: statistics go, with the id, to a narrow table that both the fit and
the scoring read. The fit is distributed and sees all labelled rows outside the held-out
fold.

Defined results: a null text counts as empty, and an empty text has a score like any other;
labels other than 0 and 1, null labels and labels of unknown documents teach nothing;
repeated rows count as often as they come; without labels every score is 0.5, with one class
only it is that class; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclewise.llm.common import fold_of, prepare, stored

FOLDS = 5
HELD_OUT = 0
CUT = 0.3
TREES = 24
DEPTH = 3
SEED = 11
#: Strength of the L1 penalty.
LASSO = 0.0005
SYMBOLS = r"[^#$%&*!|@^~<>{}\[\]=+_\\/]+"


@dataclass(frozen=True)
class Rule:
    """Bounds ``low < statistic <= high``, sorted by statistic."""

    bounds: tuple[tuple[str, float | None, float | None], ...]

    def column(self) -> Column:
        test = F.lit(True)
        for name, low, high in self.bounds:
            if low is not None:
                test = test & (F.col(name) > low)
            if high is not None:
                test = test & (F.col(name) <= high)
        return test


def statistics(text: Column) -> dict[str, Column]:
    """Counts over the whole text; ``ratios`` turns them into the statistics of the rules."""
    text = F.coalesce(text, F.lit(""))

    def kept(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, "")).cast("double")

    words = F.filter(F.split(text, r"[ \n\t]+"), lambda w: w != "")
    return {
        "c_chars": F.length(text).cast("double"),
        "c_letters": kept(r"[^\p{L}]+"),
        "c_upper": kept(r"[^\p{Lu}]+"),
        "c_digits": kept(r"[^0-9]+"),
        "c_symbols": kept(SYMBOLS),
        "c_stops": kept(r"[^.,;:?]+"),
        "c_lines": kept(r"[^\n]+"),
        "c_words": F.size(words).cast("double"),
        "c_distinct": F.size(F.array_distinct(words)).cast("double"),
    }


def ratios() -> dict[str, Column]:
    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)

    return {
        "words": F.log1p("c_words"),
        "word_length": share("c_letters", "c_words"),
        "letter_share": share("c_letters", "c_chars"),
        "upper_share": share("c_upper", "c_letters"),
        "digit_share": share("c_digits", "c_chars"),
        "symbol_share": share("c_symbols", "c_words"),
        "stop_share": share("c_stops", "c_words"),
        "line_words": F.log1p(F.col("c_words") / (F.col("c_lines") + 1)),
        "distinct_share": share("c_distinct", "c_words"),
        "distinct_growth": F.log1p("c_distinct") - 0.5 * F.log1p("c_words"),
    }


STATISTICS = [
    "words", "word_length", "letter_share", "upper_share", "digit_share", "symbol_share", "stop_share", "line_words",
    "distinct_share", "distinct_growth",
]
NODE = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([-\d.eE]+|Infinity|-Infinity)\)$")


def rules_of(forest_text: str, names: list[str]) -> list[Rule]:
    """Rules of all tree nodes below the roots, from a forest's printed trees."""
    rules: dict[Rule, None] = {}
    path: list[tuple[int, str, str, float]] = []
    for line in forest_text.split("\n"):
        found = NODE.match(line)
        if not found:
            continue
        depth = len(found[1])
        path = [p for p in path if p[0] < depth]
        path.append((depth, names[int(found[3])], found[4], float(found[5])))
        bounds: dict[str, list[float | None]] = {}
        for _, name, sign, value in path:
            low, high = bounds.get(name, [None, None])
            if sign == ">":
                low = value if low is None else max(low, value)
            else:
                high = value if high is None else min(high, value)
            bounds[name] = [low, high]
        rules.setdefault(Rule(tuple((n, *b) for n, b in sorted(bounds.items()))))
    return list(rules)


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules and an intercept; ``constant`` replaces them where nothing could be learned."""

    intercept: float
    weighted: tuple[tuple[Rule, float], ...]
    constant: float | None = None

    def score(self) -> Column:
        if self.constant is not None:
            return F.lit(float(self.constant))
        total = F.lit(self.intercept)
        for rule, weight in self.weighted:
            total = total + F.when(rule.column(), weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def fit(rows: DataFrame, label: str = "label") -> RuleModel:
    """Fit on rows of statistics and a label of 0 or 1."""
    seen = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(seen) < 2:
        return RuleModel(0.0, (), float(next(iter(seen), 0.5)))
    rows = rows.select(F.col(label).cast("double").alias("label"), *STATISTICS)
    stats = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(rows).select("label", "features")
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.7, featureSubsetStrategy="onethird"
    ).fit(stats)
    rules = rules_of(forest.toDebugString, STATISTICS)
    if not rules:
        return RuleModel(0.0, (), seen.get(1, 0) / sum(seen.values()))
    fired = rows.select("label", *[r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    fired = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(fired)
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60).fit(fired.select("label", "features"))
    weights = lasso.coefficients.toArray()
    return RuleModel(
        float(lasso.intercept), tuple((r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-9)
    )


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every text, kept for fit and scoring."""
    counts = docs.select("doc_id", *[c.alias(n) for n, c in statistics(F.col("text")).items()])
    return stored(counts.select("doc_id", *[c.alias(n) for n, c in ratios().items()]), "text-statistics")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    prepare(docs.sparkSession)
    stats = measured(docs)
    known = labels.filter(F.col(label).isin(0, 1) & (fold_of("doc_id", FOLDS) != HELD_OUT))
    taught = stats.join(known.select("doc_id", F.col(label).alias("label")), "doc_id").drop("doc_id")
    model = fit(stored(taught, "labelled-statistics"))  # every level of the trees reads these rows
    return stats.select(
        "doc_id",
        F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        model.score().alias("score"),
    ).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
