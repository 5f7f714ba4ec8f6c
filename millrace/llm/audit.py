"""Interaction of five filters: what each would remove, in every order.

``A`` under 200 words, ``B`` fewer than half of the words distinct, ``C`` more than 3 % capitals ``A-Z``, ``D`` holds one
of ``#$%&*|``, ``E`` the text of a smaller document id.  The first four are conditions on the text.  ``E`` is an existential
self-join: a row stays in a left-semi join on hash, exact text and a smaller id.  Only texts whose hash stands under
several ids take part, and the other side holds one row per text, its smallest id, so a group of copies of any size
costs a row per copy.  The ids that ``E`` marks are united with the ids and conditions of all documents, a document's
bits are put together, and documents are counted by part and combination.  Orders, steps and shares follow from the at
most 32 counts of a part.

Defined cases: null and empty texts are the same text (they fail ``A``); a row without id is no copy and nobody's
original; rows that repeat id and text count once each and are not copies of each other; a null language is the part
``''``; a label counts when any of the rows of an id has it; no documents give no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.text import blank_words, read, stored, whole

FILTERS = "ABCDE"
#: fixed values of the conditions
WORDS, MARKS = 200, "[#$%&*|]"


def conditions(text: Column) -> Column:
    """Bits of the conditions A to D of a text."""
    words = blank_words(text)
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < WORDS, 100 * F.size(F.array_distinct(words)) < 50 * n, 100 * capitals > 3 * F.length(text), text.rlike(MARKS)]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def copies(docs: DataFrame) -> DataFrame:
    """Rows ``id, text, hash, …`` whose text a row of a smaller id has."""
    repeated = stored(docs.groupBy("hash").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("hash"),
                      "audit-hashes")
    rows = stored(docs.join(repeated, "hash", "left_semi"), "audit-copies")
    first = stored(rows.groupBy(F.col("hash").alias("h"), F.col("text").alias("t")).agg(F.min("id").alias("first")), "audit-first")
    return rows.join(first, (F.col("hash") == F.col("h")) & (F.col("text") == F.col("t")) & (F.col("first") < F.col("id")), "left_semi")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by ``part`` and bits of failed filters (``mask``): all, with quality 1, with toxic 1."""
    rows = docs.select(F.col("doc_id").alias("id"), whole(F.col("lang")).alias("part"), whole(F.col("text")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    own = rows.select("id", "hash", "part", conditions(F.col("text")).alias("bits"), F.lit(1).alias("rows"))
    marked = copies(rows).select("id", "hash", "part", F.lit(1 << FILTERS.index("E")).alias("bits"), F.lit(0).alias("rows"))
    failed = own.unionByName(marked).groupBy("id", "hash", "part").agg(F.bit_or("bits").alias("mask"), F.sum("rows").alias("n"))
    failed = failed.groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))  # rows without id come down to a few
    has = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c)
    known = labels.groupBy(F.col("doc_id").alias("id")).agg(has("quality"), has("toxic"))
    counted = lambda c: F.coalesce(F.sum(F.when(F.col(c), F.col("n"))), F.lit(0)).alias(c)
    return failed.join(known, "id", "left").groupBy("part", "mask").agg(F.sum("n").alias("n"), counted("quality"), counted("toxic"))


def by_order(counts: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step of :func:`combinations`."""
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "quality", "toxic")).alias("cells"))  # 32 at most
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    rows = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bits = F.create_map(*[F.lit(x) for i, f in enumerate(FILTERS) for x in (f, 1 << i)])
    letter = lambda i: F.element_at(bits, F.substring("filter_order", i, F.lit(1)))
    earlier = F.aggregate(F.sequence(F.lit(0), F.col("step") - 1), F.lit(0), lambda acc, i: acc + F.when(i > 0, letter(i)).otherwise(0))
    rows = rows.withColumns({"own": letter(F.col("step")), "before": earlier})

    def total(where, value):
        return F.aggregate(F.filter("cells", where), F.lit(0).cast("bigint"), lambda acc, x: acc + value(x))

    own, before = F.col("own"), F.col("before")
    hit, gone = (lambda x: x["mask"].bitwiseAND(own) > 0), (lambda x: x["mask"].bitwiseAND(before) > 0)
    removed = lambda x: hit(x) & ~gone(x)
    n_orders = len(list(permutations(FILTERS)))
    return rows.select(
        "part", "filter_order", "step",
        total(lambda x: ~hit(x) & ~gone(x), lambda x: x["n"]).alias("kept"),
        total(removed, lambda x: x["n"]).alias("removed"),
        total(lambda x: hit(x) & gone(x), lambda x: x["n"]).alias("redundant"),
        total(lambda x: x["mask"] == own, lambda x: x["n"]).alias("unique_fails"),
        total(removed, lambda x: x["quality"]).alias("good_lost"),
        total(removed, lambda x: x["toxic"]).alias("toxic_lost"),
        # of the filters a document fails, each comes first in the same number of orders
        total(hit, lambda x: x["n"] * (n_orders / F.bit_count(x["mask"])).cast("bigint")).alias("shapley"))


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    """All orders and steps of the five filters, by language."""
    return by_order(combinations(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


SQL_op11 = r"""
with d as (select doc_id, coalesce(lang, '') part, coalesce(text, '') x from documents),
w as (select *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') ws, min(doc_id) over (partition by x) low from d),
l as (select doc_id, bool_or(quality = 1) good, bool_or(toxic = 1) bad from labels group by doc_id),
m as (select part, list_concat(
        case when len(ws) < 200 then ['A'] else [] end,
        case when 100 * list_unique(ws) < 50 * len(ws) then ['B'] else [] end,
        case when 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 3 * length(x) then ['C'] else [] end,
        case when regexp_matches(x, '[#$%&*|]') then ['D'] else [] end,
        case when low < w.doc_id then ['E'] else [] end) f, coalesce(good, false) good, coalesce(bad, false) bad
      from w left join l on l.doc_id = w.doc_id),
c as (select part, f, count(*) n, count(*) filter (good) good, count(*) filter (bad) bad from m group by all),
e as (select unnest(['A', 'B', 'C', 'D', 'E']) v),
o as (select [a.v, b.v, c.v, d.v, e.v] fs from e a, e b, e c, e d, e
      where len(list_distinct([a.v, b.v, c.v, d.v, e.v])) = 5),
s as (select array_to_string(fs, '') filter_order, i::int step, fs[i] own, list_slice(fs, 1, i - 1) before from o, range(1, 6) r(i)),
g as (select part, filter_order, step, own,
        coalesce(sum(n) filter (not list_contains(f, own) and not list_has_any(f, before)), 0)::bigint kept,
        coalesce(sum(n) filter (list_contains(f, own) and not list_has_any(f, before)), 0)::bigint removed,
        coalesce(sum(n) filter (list_contains(f, own) and list_has_any(f, before)), 0)::bigint redundant,
        coalesce(sum(n) filter (f = [own]), 0)::bigint unique_fails,
        coalesce(sum(good) filter (list_contains(f, own) and not list_has_any(f, before)), 0)::bigint good_lost,
        coalesce(sum(bad) filter (list_contains(f, own) and not list_has_any(f, before)), 0)::bigint toxic_lost
      from c, s group by part, filter_order, step, own)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, own))::bigint shapley
from g
"""
