"""Benchmark decontamination as a prefix-filtered set join.

Every item is cut into windows of ``window`` consecutive words (a shorter item
is one window).  A window is a set of word shingles, and a document contains
the window only if it contains all of them, so one shingle is a necessary
prefix: the one that is rarest in the documents.  Documents' shingles are
joined with these prefixes only; the place of the shingle in the window bounds
where the window may begin, and the words there are compared exactly.

Defined cases: null and empty texts have no words and no hit; rows that are
repeated get a row each; an item id of null is no item, its windows still hit;
no items or no documents give no hits or no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.text import covered, let, lowered, read, whole, without
from millrace.session import materialized

WINDOW, SHINGLE = 10, 5
#: bits of the filter that keeps most positions out of the join; its size is fixed, a fuller one only lets more through
FILTER_BITS = 1 << 20


def words(text: Column) -> Column:
    return F.array_remove(F.split(lowered(whole(text)), r"[\x00-/:-`{-\x7F]+"), "")


def _shingle(w: Column, i: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(w, i + j) for j in range(size)])


def _starts(n: Column, size: Column | int) -> Column:
    """0 .. n - size."""
    return F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))


def windows(items: DataFrame, window: int, item_id: str, text: str) -> DataFrame:
    """Rows ``item, passage, length``: the distinct windows of each item, words joined by one blank."""
    w = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    w = w.withColumn("length", F.least(F.size("w"), F.lit(window)))
    w = w.select("item", "w", "length", F.explode(_starts(F.size("w"), F.col("length"))).alias("start"))
    return w.select("item", F.array_join(F.slice("w", F.col("start") + 1, F.col("length")), " ").alias("passage"),
                    "length").distinct()


def _filter_bits(hashes: DataFrame, bits: int) -> Column:
    """Array of longs, bit ``h mod bits`` set for each hash ``h``; at most ``bits / 64`` rows come to the driver."""
    slot = F.pmod("h", F.lit(bits))
    rows = hashes.select((slot / 64).cast("int").alias("at"), (slot % 64).cast("int").alias("bit")).groupBy("at").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")).collect()
    masks = [0] * (bits // 64)
    for r in rows:
        masks[r["at"]] = r["mask"]
    return F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>")


def _may_hold(bits: int, masks: Column, h: Column) -> Column:
    return let(F.pmod(h, F.lit(bits)), lambda slot: F.getbit(
        F.get(masks, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(F.lit(63)).cast("int")) == 1)


def hits(docs: DataFrame, items: DataFrame, *, text: str = "text", item_text: str = "text", item_id: str = "item_id",
         window: int = WINDOW, shingle: int = SHINGLE, filter_bits: int = FILTER_BITS,
         carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A row per document: the carried columns, ``n_words``, ``n_hit`` words inside occurring windows, ``item_ids`` (sorted)."""
    wins = materialized(windows(items, window, item_id, item_text))
    # the shingle of a window shorter than a shingle is the window
    grams = wins.select("passage", "length").distinct().withColumn("w", F.split("passage", " "))
    sizes = sorted(r[0] for r in grams.select(F.least("length", F.lit(shingle))).distinct().collect())
    grams = grams.withColumn("size", F.least("length", F.lit(shingle)))
    grams = grams.withColumn("offset", F.explode(_starts(F.col("length"), F.col("size"))))
    by_size = F.lit(None).cast("bigint")
    for s in sizes:
        by_size = F.when(F.col("size") == s, _shingle(F.col("w"), F.col("offset"), s)).otherwise(by_size)
    grams = materialized(grams.select("passage", "length", "offset", by_size.alias("h")))
    masks = _filter_bits(grams.select("h").distinct(), filter_bits)

    before = window - min(sizes, default=shingle)  # words of a window that may stand before its shingle
    w, n = F.col("_w"), F.size("_w")

    def places_of(size: int) -> Column:
        def place(i: Column) -> Column:
            first = F.greatest(i - before, F.lit(0))
            return F.struct(_shingle(w, i, size).alias("h"), i.alias("at"), first.alias("first"),
                            F.slice(w, first + 1, 2 * window).alias("near"))

        return F.transform(F.filter(_starts(n, size), lambda i: _may_hold(filter_bits, masks, _shingle(w, i, size))), place)

    places = [places_of(s) for s in sizes]
    none = F.array().cast("array<struct<h:bigint,at:int,first:int,near:array<string>>>")
    scanned = docs.select(*[F.col(c).alias(f"c_{c}") for c in carry], words(F.col(text)).alias("_w"))
    scanned = materialized(scanned.select(F.monotonically_increasing_id().alias("row"), *[f"c_{c}" for c in carry],
                                          n.cast("bigint").alias("n_words"), F.concat(none, *places).alias("places")))
    found = scanned.where(F.size("places") > 0).select("row", F.explode("places").alias("p")).select("row", "p.*")

    # rarest shingle of each window; a window that has a shingle without occurrence does not occur
    rarity = found.groupBy("h").agg(F.count("*").alias("n"))
    ordered = grams.join(rarity, "h", "left").groupBy("passage", "length").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "offset")).alias("first"))
    prefix = ordered.where(F.col("first.n") > 0).select("passage", "length", "first.h", "first.offset")

    tried = found.join(prefix, "h").withColumn("start", F.col("at") - F.col("offset")).where("start >= 0")
    real = F.array_join(F.slice("near", F.col("start") - F.col("first") + 1, F.col("length")), " ") == F.col("passage")
    occurs = materialized(tried.where(real).select("row", "passage", "start", "length"))
    spans = occurs.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"))
    spans = spans.select("row", covered(F.col("spans"), lambda x: x["length"], lambda x: x["start"]).cast("bigint").alias("n_hit"))
    named = occurs.select("row", "passage").distinct().join(wins.select("item", "passage"), "passage").groupBy("row").agg(
        F.sort_array(F.collect_set("item")).alias("item_ids"))
    out = scanned.drop("places").join(spans.join(named, "row", "left"), "row", "left")
    return out.select(*[F.col(f"c_{c}").alias(c) for c in carry], "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                      F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Words of every document that stand inside a benchmark window."""
    found = hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents without any occurring window, all columns kept; repeated rows stay repeated."""
    key = F.xxhash64("doc_id", "text")
    bad = hits(docs.select("doc_id", "text", key.alias("key")), items, carry=("doc_id", "key")).where("n_hit > 0")
    return without(docs, bad.select("key", "doc_id"))


SQL_op6 = r"""
with d as (select row_number() over () r, doc_id,
             list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w from documents),
i as (select cast(item_id as varchar) item,
             list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w from benchmark),
iw as (select distinct item, least(len(w), 10) n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') p
       from (select item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) s from i where len(w) > 0)),
sizes as (select distinct n from iw),
dw as (select r, s, n, array_to_string(w[s:s + n - 1], ' ') p
       from (select r, w, n, unnest(range(1, len(w) - n + 2)) s from d, sizes where len(w) >= n)),
hit as (select distinct r, s, n, item from dw join iw using (n, p)),
pos as (select r, count(distinct x) n_hit from (select r, unnest(range(s, s + n)) x from hit) group by r),
its as (select r, count(*) n_items, string_agg(item, ',' order by item) ids from (select distinct r, item from hit where item is not null) group by r)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
       sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join pos using (r) left join its using (r)
"""
