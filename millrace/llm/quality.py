"""Quality rules as a learned decision list.

Each document gets integer statistics and a few ratios.  Sequential covering
learns an ordered list of rules from labelled statistics: a rule is a
conjunction of thresholds, grown on two thirds of the labelled rows condition
by condition with the largest information gain, cut back to its best beginning
on the other third, and taken if it is precise enough there.  The rows that a
rule covers leave the data and the next rule is learned; of a rule that is not
taken only the bad rows it was grown on leave.  The base rule stands first, so
the rows it covers teach nothing.  All counting is
grouped aggregation in Spark over all labelled rows; a step brings at most one
row per feature and threshold to the driver.  The list is one conditional
expression: the first rule that holds rejects the document, none keeps it.

Defined cases: null and empty texts have no words and fail the base rule;
labels without quality or without document teach nothing, a document labelled
twice teaches with its lowest quality; without labels no rule is learned;
repeated rows get a row each; other columns are not read.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.text import BLANKS, blank_words, count_of, covered, let, read, stored, whole, without
from millrace.session import materialized

REPEAT_WINDOW = 5
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Params:
    thresholds: int = 32          # cut points tried per feature
    rules: int = 12               # rules tried
    conditions: int = 4           # longest conjunction
    precision: float = 0.8        # of a rule on the rows it was not grown on
    support: int = 3              # bad rows that a rule must cover while it is grown


def _repeated_words(w: Column, size: int) -> Column:
    """Words inside windows of ``size`` words that stand twice or more in the text, the first one included."""
    n = F.size(w)

    def starts(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def equal(s: Column) -> Column:
            near = F.filter(s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]))
            return covered(F.sort_array(F.transform(near, lambda x: x["i"])), size)

        return let(placed, lambda s: F.coalesce(equal(s), F.lit(0)))

    hashes = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(size)]))
    # few texts repeat a window; only those are sorted
    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), starts(h)).otherwise(F.lit(0)))
    return F.when(n >= size, some).otherwise(F.lit(0))


def statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns (prefixed ``c_``) and the statistics of the whole text.

    Write the result before filtering on it: a condition would be pushed down
    and compute the statistics once per use.
    """
    t, w = F.col("_t"), F.col("_w")
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    base = docs.select(*[F.col(c).alias(f"c_{c}") for c in keep], whole(F.col(text)).alias("_t"))
    base = base.withColumn("_w", blank_words(t)).withColumn("_l", lines)
    counts = {
        "n_words": F.size(w),
        "word_chars": F.length(F.translate(t, BLANKS, "")),
        "n_symbols": count_of(t, SYMBOLS),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_repeat_words": _repeated_words(w, REPEAT_WINDOW),
        "n_lines": F.size("_l"),
        "n_distinct": F.size(F.array_distinct(w)),
        "n_upper": count_of(t, string.ascii_uppercase),
        "n_digits": count_of(t, string.digits),
        "n_marks": count_of(t, "!?"),
        "n_stops": count_of(t, ".,;:"),
    }
    return base.select(*[F.col(f"c_{c}") for c in keep], *[v.cast("bigint").alias(k) for k, v in counts.items()])


def _ratio(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


FEATURES = {
    "words": None, "symbol_ratio": ("n_symbols", "n_words"), "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "repeat_ratio": ("n_repeat_words", "n_words"), "distinct_ratio": ("n_distinct", "n_words"),
    "upper_ratio": ("n_upper", "word_chars"), "digit_ratio": ("n_digits", "word_chars"),
    "mark_ratio": ("n_marks", "n_words"), "stop_ratio": ("n_stops", "n_words"), "word_length": ("word_chars", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


def features() -> dict[str, Column]:
    return {k: F.col("n_words").cast("double") if k == "words" else _ratio(*v) for k, v in FEATURES.items()}


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self) -> Column:
        value = features()[self.feature]
        return value >= F.lit(self.threshold) if self.at_least else value < F.lit(self.threshold)


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [c.holds() for c in rule])


def _thresholds(rows: DataFrame, p: Params) -> dict[str, list[float]]:
    shares = [(i + 0.5) / p.thresholds for i in range(p.thresholds)]
    # quantiles of both classes, since the bad one may be rare
    found = rows.groupBy("bad").agg(*[F.percentile_approx(v, shares, 100 * p.thresholds).alias(k)
                                      for k, v in features().items()]).collect()
    return {k: sorted({t for r in found for t in r[k] or []}) for k in FEATURES}


def _gain(p0: int, n0: int, p1: int, n1: int) -> float:
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0))) if p1 and p0 else 0.0


def _best(rows: DataFrame, cuts: dict[str, list[float]], p: Params) -> tuple[float, Condition | None]:
    """Condition with the largest gain over rows with ``bad`` and one ``bin_`` column per feature."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), F.col(f"bin_{k}").alias("bin")) for k in FEATURES]))
    counts = rows.select("bad", each.alias("x")).groupBy("x.feature", "x.bin").agg(
        F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
    best: tuple[float, Condition | None] = (0.0, None)
    for k in FEATURES:
        own = sorted((r["bin"], r["p"], r["n"]) for r in counts if r["feature"] == k)
        p0, n0 = sum(x[1] for x in own), sum(x[2] for x in own)
        for i, t in enumerate(cuts[k]):  # bin b: the value is at least the first b thresholds
            above = [x for x in own if x[0] > i]
            pa, na = sum(x[1] for x in above), sum(x[2] for x in above)
            for up, a, b in ((True, pa, na), (False, p0 - pa, n0 - na)):
                if a >= p.support and (g := _gain(p0, n0, a, b)) > best[0] + 1e-9:
                    best = (g, Condition(k, up, t))
    return best


def learn(stats: DataFrame, labels: DataFrame, doc_id: str = "c_doc_id", label_id: str = "doc_id",
          label: str = "quality", params: Params = Params()) -> list[Rule]:
    """Ordered rules that reject; label 0 marks bad documents."""
    marks = labels.where(F.col(label).isNotNull() & F.col(label_id).isNotNull()).groupBy(
        F.col(label_id).alias("_id")).agg((F.min(label) == 0).cast("int").alias("bad"))
    rows = stats.join(marks, F.col(doc_id) == F.col("_id")).select(
        "bad", (F.pmod(F.xxhash64("_id"), F.lit(3)) == 0).alias("held"), *[c for c in stats.columns if c.startswith(("n_", "word_"))])
    rows = materialized(rows.where(~base_failed()))
    cuts = _thresholds(rows, params)
    bins = [F.aggregate(F.array(*[F.lit(float(t)) for t in cuts[k]]).cast("array<double>"), F.lit(0),
                        _counter(v)).alias(f"bin_{k}") for k, v in features().items()]
    rows = materialized(rows.select("*", *bins))
    rules: list[Rule] = []
    for _ in range(params.rules):
        grown, left = (), rows.where(~F.col("held"))
        while len(grown) < params.conditions:
            gain, condition = _best(left, cuts, params)
            if condition is None:
                break
            grown += (condition,)
            left = left.where(condition.holds())
        if not grown:
            break
        held = rows.where("held")
        begins = [holds(grown[:i + 1]) for i in range(len(grown))]
        seen = held.agg(*[F.sum(F.when(b, 1 - F.col("bad"))).alias(f"n{i}") for i, b in enumerate(begins)],
                        *[F.sum(F.when(b, F.col("bad"))).alias(f"p{i}") for i, b in enumerate(begins)]).first()
        worth = [((seen[f"p{i}"] or 0) + 1) / ((seen[f"p{i}"] or 0) + (seen[f"n{i}"] or 0) + 2) for i in range(len(grown))]
        at = max(range(len(grown)), key=lambda i: (round(worth[i], 9), -i))
        p, n = seen[f"p{at}"] or 0, seen[f"n{at}"] or 0
        rule = grown[:at + 1]
        if p and p / (p + n) >= params.precision:
            rules.append(rule)
            rows = rows.where(~holds(rule))
        else:
            rows = rows.where(~holds(rule) | F.col("held") | (F.col("bad") == 0))
    return rules


def _counter(value: Column):
    return lambda acc, t: acc + F.when(value >= t, 1).otherwise(0)


def rejects(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, null if none does."""
    out = F.lit(None).cast("int")
    for i in reversed(range(len(rules))):
        out = F.when(holds(rules[i]), F.lit(i)).otherwise(out)
    return out


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    stats = materialized(statistics(read(spark, sf_dir, "documents")))
    rules = learn(stats, read(spark, sf_dir, "labels"))
    return stats.select(F.col("c_doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        base_failed().alias("base_failed"), (~base_failed() & rejects(rules).isNull()).alias("kept"),
                        rejects(rules).alias("rule"))


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that pass the base rule and every learned rule, all columns kept.

    Only statistics are stored, not the texts.
    """
    key = F.xxhash64("doc_id", "text")
    judged = stored(statistics(docs.select("doc_id", "text", key.alias("key")), keep=("doc_id", "key")), "quality")
    rules = learn(judged, labels)
    return without(docs, judged.where(base_failed() | rejects(rules).isNotNull()).select("c_key", "c_doc_id"))
