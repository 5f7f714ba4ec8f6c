"""Mixing sources to target weights by Poisson replication.

Each source gets the mean repetition rate that brings its characters to its
share of the budget.  A document's number of copies inverts the Poisson
distribution of that rate at a number hashed from seed, id and text, so it is
the same in every run and on every executor.  Copies are dealt out by a second
hash and sorted by it: every part of the output is a random sample in random
order.

Defined cases: null texts have no characters; documents without source are a
source of their own; sources without characters or with weight 0 get rate 0 and
no copy; repeated rows get equal numbers of copies; an empty table gives no
rows; other columns are carried along, but for ones named ``copy`` and ``place``,
which the copy number and the place replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.text import read, whole
from millrace.session import materialized

SEED = 20240607
#: bytes of a table of rates that is broadcast; a larger one is joined by a shuffle
SMALL = 8 << 20


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, budget: int | None = None, source: str = "source",
          text: str = "text") -> DataFrame:
    """Rows ``_source, rate, below``: mean repetitions of a source, and its distribution function from 0 up to a share of 1 - 1e-16.

    ``weights`` are shares of the result by source (default: equal), ``budget``
    its characters (default: those of the input).
    """
    sizes = docs.groupBy(F.col(source).alias("_source")).agg(F.sum(F.length(whole(F.col(text)))).alias("size"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, share in weights.items():
            weight = F.when(F.col("_source").eqNullSafe(F.lit(name)), F.lit(float(share))).otherwise(weight)
    sizes = sizes.withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(0.0))
    total = sizes.agg(F.sum("weight").alias("w"), F.sum("size").alias("s"))
    whole_budget = total.select("s").scalar() if budget is None else F.lit(budget)
    share = F.col("weight") / F.nullif(total.select("w").scalar(), F.lit(0.0))
    rate = F.coalesce(share * whole_budget / F.nullif(F.col("size"), F.lit(0)), F.lit(0.0))
    sizes = sizes.withColumn("rate", rate)
    top = F.ceil(F.col("rate") + 10 * F.sqrt("rate") + 20).cast("int")

    def step(acc: Column, j: Column) -> Column:
        log = acc["log"] + F.ln(F.col("rate") / j)
        p = acc["p"] + F.exp(log)
        return F.struct(log.alias("log"), p.alias("p"), F.concat(acc["all"], F.array(p)).alias("all"))

    none = F.exp(-F.col("rate"))
    start = F.struct((-F.col("rate")).alias("log"), none.alias("p"), F.array(none).alias("all"))
    table = F.aggregate(F.sequence(F.lit(1), top), start, step, lambda acc: acc["all"])
    return sizes.select("_source", "rate", F.when(F.col("rate") > 0, table).otherwise(F.array(F.lit(1.0))).alias("below"))


def _uniform(hashed: Column) -> Column:
    """The first 13 hex digits as a number from 0 to below 1."""
    return F.conv(F.substring(hashed, 1, 13), 16, 10).cast("double") / float(16**13)


def replicated(docs: DataFrame, weights: dict[str | None, float] | None = None, budget: int | None = None, seed: int = SEED,
               source: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Copies of the documents, all columns, with ``copy`` (from 1) and ``place``, the hash by which they are shuffled."""
    names = [c for c in docs.columns if c not in ("copy", "place")]
    docs = docs.select(*names)
    table = materialized(rates(docs, weights, budget, source, text).withColumnRenamed("_source", "of"))
    # a row per source: when they are few, the texts need not be shuffled by source
    size = table.agg(F.coalesce(F.sum(8 * F.size("below") + F.coalesce(F.octet_length(F.col("of").cast("string")), F.lit(0)) + 64), F.lit(0))).first()[0]
    table = F.broadcast(table) if size <= SMALL else table
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(whole(F.col(text)))))
    drawn = docs.select(key.alias("key"), F.struct(*names).alias("d"))
    drawn = drawn.join(table, F.col(f"d.`{source}`").eqNullSafe(F.col("of")))
    copies = F.size(F.filter("below", lambda p: p <= _uniform(F.col("key"))))
    drawn = drawn.withColumn("n", copies).where("n > 0").select("key", "d", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    drawn = drawn.select("d", "copy", F.md5(F.concat_ws(":", "key", "copy")).alias("place"))
    return drawn.repartition("place").sortWithinPartitions("place", "copy").select(*[F.col("d").getField(c).alias(c) for c in names], "copy", "place")


def op9_mix_sources(spark, sf_dir: str) -> DataFrame:
    """All documents, their sources mixed to equal shares of characters."""
    return replicated(read(spark, sf_dir, "documents"))


SQL_op9 = f"""
with sizes as (select source, sum(length(coalesce(text, ''))) size from documents group by source),
r as (select source, coalesce((case when size > 0 then 1.0::double else 0.0 end) / (select sum(case when size > 0 then 1 else 0 end) from sizes)
      * (select sum(size) from sizes) / nullif(size, 0), 0.0) rate from sizes),
steps as (select source, rate, unnest(range(0, ceil(rate + 10 * sqrt(rate) + 20)::bigint + 1)) j from r where rate > 0),
p as (select source, j, exp(-rate + coalesce(sum(case when j > 0 then ln(rate / j) end) over (partition by source order by j), 0)) p from steps),
cdf as (select source, j, sum(p) over (partition by source order by j) c from p),
d as (select *, md5('{SEED}:' || coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))) k from documents),
n as (select k, count(*) n from (select distinct k, source from d) d join cdf on d.source is not distinct from cdf.source
      and cdf.c <= ('0x' || substr(k, 1, 13))::bigint::double / {16**13}::double group by k)
select doc_id, text, lang, source, n_chars, copy::int copy, md5(k || ':' || copy) place
from (select d.*, unnest(range(1, n.n + 1)) copy from d join n using (k))
"""
