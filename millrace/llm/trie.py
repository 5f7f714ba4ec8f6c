"""Prefix trie of conversations, with totals of subtrees by bands of depth.

Conversations are ordered by turn and rebuilt: the first ``h`` turns of the conversation that starts a block of five
ids, then the own turns after the first ``h``.  A node is a distinct sequence of first turns.  It is known by its depth
and 128 bits that add up the hashes of (depth, role, text) of its turns, so a conversation of any length is
hashed in segments, and positions come from one distributed sort.

Totals of subtrees go up in bands of fixed height.  A node is exploded only to its ancestors in its own band.  The nodes
at the top of the bands form a trie again, lower by the height of a band, whose totals come the same way; completed, they go
to the ancestors in the band above.  So an explosion is bounded by the height, and the number of rounds by the
logarithm of the depth.

Defined cases: null roles and texts are empty; turns without number come first; equal turns go by role, then text, and rows
that repeat are turns of their own; rows without conversation id are left out; the remainder of a
negative id is not positive (-7 builds on -5); no conversations give no nodes, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.llm.text import read, stored, whole
from millrace.session import shuffle_parts

#: fixed values: conversations in a block, and remainders that give the number of shared turns
FAMILY, SHARED = 5, 9
#: levels that one explosion covers
BAND = 16
#: turns of a conversation that are summed in one group, and ids of one piece of a list
SEGMENT, LISTED = 1024, 1000
#: a node: its depth and the 128 bits of its turns
KEY = ["d", "k1", "k2"]
PARENT = ["pd", "p1", "p2"]
_LOW = (1 << 32) - 1


def _on(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x) == F.col(y) for x, y in zip(left, right)])


def numbered(rows: DataFrame) -> DataFrame:
    """Turns ``conv, pos, t1, t2, size``: position from 1, hash of role and text, bytes of the text."""
    rows = rows.select(F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
                       whole(F.col("role")).alias("role"), whole(F.col("text")).alias("text")).where("conv is not null")
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    half = lambda i: F.unhex(F.substring(digest, i, 16))
    rows = rows.repartitionByRange(shuffle_parts(rows.sparkSession), *order).sortWithinPartitions(*order).select(
        "conv", F.monotonically_increasing_id().alias("at"), F.xxhash64(half(1)).alias("t1"), F.xxhash64(half(17)).alias("t2"),
        F.octet_length("text").cast("bigint").alias("size"))
    # the numbers grow along the sort; a conversation is one run of them in each partition that it reaches
    rows = stored(rows.withColumn("part", F.shiftright("at", 33)), "trie-turns")
    runs = rows.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    runs = runs.withColumn("base", F.coalesce(before, F.lit(0))).drop("n")
    return rows.join(runs, ["conv", "part"]).select("conv", (F.col("at") - F.col("first") + F.col("base") + 1).alias("pos"), "t1", "t2", "size")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Turns ``c, d, last, t1, t2, size`` of rebuilt conversations, with a textless turn 0 each; ``last`` is their length."""
    convs = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    convs = stored(convs.select("conv", "n", (F.col("conv") - F.col("conv") % FAMILY).alias("base"),
                                (F.crc32(F.col("conv").cast("string")) % SHARED).alias("h")), "trie-conversations")
    heads = convs.select(F.col("conv").alias("base"), F.col("n").alias("of"))
    taken = F.least("h", F.coalesce("of", F.lit(0)))
    convs = stored(convs.join(heads, "base", "left").select(
        "conv", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("last")), "trie-conversations")
    own = turns.join(convs, "conv").where("pos > h").select(
        F.col("conv").alias("c"), (F.col("pos") - F.col("h") + F.col("taken")).alias("d"), "last", "t1", "t2", "size")
    first = turns.where(f"pos < {SHARED}").withColumnRenamed("conv", "base").join(convs, "base").where("pos <= h").select(
        F.col("conv").alias("c"), F.col("pos").alias("d"), "last", "t1", "t2", "size")
    zero = F.lit(0).cast("bigint")
    roots = convs.select(F.col("conv").alias("c"), zero.alias("d"), "last", zero.alias("t1"), zero.alias("t2"), zero.alias("size"))
    return own.unionByName(first).unionByName(roots)


def steps(turns: DataFrame) -> DataFrame:
    """Rows of :func:`rebuilt` with the node of the turn (``k1, k2``) and of the turn before (``p1, p2``)."""
    both = [F.xxhash64(F.lit(i), "d", "t1", "t2") for i in (1, 2)]
    pieces = [p for b in both for p in (F.shiftrightunsigned(b, 32), b.bitwiseAND(F.lit(_LOW)))]
    names = [f"s{i}" for i in range(4)]
    rows = turns.select("*", *[F.when(F.col("d") > 0, p).otherwise(0).alias(n) for n, p in zip(names, pieces)])
    rows = stored(rows.select("c", "d", "last", "size", *names, F.floor(F.col("d") / SEGMENT).alias("segment")), "trie-rebuilt")
    sums = rows.groupBy("c", "segment").agg(*[F.sum(n).alias("e" + n) for n in names])
    earlier = W.partitionBy("c").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("c", "segment", *[F.coalesce(F.sum("e" + n).over(earlier), F.lit(0)).alias("e" + n) for n in names])
    so_far = W.partitionBy("c", "segment").orderBy("d").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({"r" + n: F.sum(n).over(so_far) for n in names}).join(sums, ["c", "segment"])
    here = [F.col("r" + n) + F.col("e" + n) for n in names]
    above = [x - F.col(n) for x, n in zip(here, names)]
    packed = lambda hi, lo: F.shiftleft(hi, 32).bitwiseOR(lo.bitwiseAND(F.lit(_LOW)))
    return rows.select("c", "d", "last", "size", packed(*here[:2]).alias("k1"), packed(*here[2:]).alias("k2"),
                       (F.col("d") - 1).alias("pd"), packed(*above[:2]).alias("p1"), packed(*above[2:]).alias("p2"))


def subtree_totals(paths: DataFrame, nodes: DataFrame, values: list[str], band: int = BAND) -> DataFrame:
    """``d, k1, k2`` and the sums of ``values`` over the subtree of every node.

    ``nodes`` have a member conversation ``c``; ``paths`` hold ``c, d, k1, k2`` of every node above a member.
    """
    lists = paths.groupBy("c", F.floor(F.col("d") / band).alias("band")).agg(
        F.sort_array(F.collect_list(F.struct("d", "k1", "k2"))).alias("path"))  # as many as a band has levels

    def summed(rows: DataFrame, path: Column) -> DataFrame:
        up = rows.select(F.explode(path).alias("at"), *values)
        return up.groupBy(F.col("at.d").alias("d"), F.col("at.k1").alias("k1"), F.col("at.k2").alias("k2")).agg(*[F.sum(v).alias(v) for v in values])

    own = nodes.select("c", "d", *values, F.floor(F.col("d") / band).alias("band")).join(lists, ["c", "band"])
    inside = stored(summed(own, F.slice("path", 1, (F.col("d") % band + 1).cast("int"))), "trie-band")
    tops = nodes.where(F.col("d") % band == 0).select("c", *KEY)
    if tops.where("d > 0").isEmpty():
        return inside
    level = (F.col("d") / band).cast("bigint")
    tops = stored(tops.join(inside, KEY).withColumn("d", level), "trie-tops")
    completed = subtree_totals(stored(paths.where(F.col("d") % band == 0).withColumn("d", level), "trie-paths"), tops, values, band)
    below = completed.join(tops.select("c", *KEY), KEY).where("d > 0").withColumn("band", F.col("d") - 1)
    carried = summed(below.join(lists, ["c", "band"]), F.col("path"))
    return inside.unionByName(carried).groupBy(*KEY).agg(*[F.sum(v).alias(v) for v in values])


def id_digests(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """SHA-256 of the ascending numbers of each key, joined by commas, as ``ends_sha256``.

    Sorted ranges are packed into pieces of a thousand numbers, so the one task that
    hashes a key, whatever its size, reads few rows and holds one of them.
    """
    names, packed = [*keys, "low", "listed"], ", ".join(f"{k} bigint" for k in keys) + ", low bigint, listed string"
    rows = rows.select(*[F.col(k).cast("bigint") for k in keys], F.col(value).cast("bigint").alias(value))
    rows = rows.repartitionByRange(shuffle_parts(rows.sparkSession), *keys, value).sortWithinPartitions(*keys, value)

    def table(found: list[tuple], columns: list[str]) -> pa.RecordBatch:
        kinds = [pa.string() if c in ("listed", "ends_sha256") else pa.int64() for c in columns]
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)], columns)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            out = []
            for *key, v in zip(*(c.to_pylist() for c in batch.columns)):
                if key != at or len(held) >= LISTED:
                    if held:
                        out.append((*at, held[0], ",".join(map(str, held))))
                    at, held = key, []
                held.append(v)
            yield table(out, names)
        if held:
            yield table([(*at, held[0], ",".join(map(str, held)))], names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            out = []
            for *key, _, listed in zip(*(c.to_pylist() for c in batch.columns)):
                if key != at:
                    if at is not None:
                        out.append((*at, state.hexdigest()))
                    at, state = key, hashlib.sha256(listed.encode())
                else:
                    state.update(b"," + listed.encode())
            yield table(out, [*keys, "ends_sha256"])
        if at is not None:
            yield table([(*at, state.hexdigest())], [*keys, "ends_sha256"])

    pieces = rows.mapInArrow(pack, packed).repartition(*keys).sortWithinPartitions(*keys, "low")
    return pieces.mapInArrow(digest, ", ".join(f"{k} bigint" for k in keys) + ", ends_sha256 string")


def prefix_trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """A row per node of the trie of rebuilt conversations."""
    paths = stored(steps(rebuilt(numbered(conversations))), "trie-steps")
    nodes = stored(paths.groupBy(*KEY).agg(F.min("c").alias("c"), F.count("*").alias("n_convs"), F.min("size").alias("size"),
                                           *[F.min(p).alias(p) for p in PARENT]), "trie-nodes")
    children = nodes.where("d > 0").groupBy(*PARENT).agg(F.count("*").alias("n_children")).toDF(*KEY, "n_children")
    counted = stored(nodes.join(children, KEY, "left").select(
        *KEY, "c", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.when(F.col("n_children").isNull(), 1).otherwise(0).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens")), "trie-children")
    totals = subtree_totals(paths.select("c", *KEY), counted, ["n_leaves", "saved_tokens"], band)
    ends = id_digests(paths.where("d = last").select(*KEY, "c"), KEY, "c")
    parents = nodes.select(F.col("c").alias("parent_conv_id"), *[F.col(k).alias("u_" + k) for k in KEY])
    out = nodes.join(parents, _on(PARENT, ["u_" + k for k in KEY]), "left").select(*KEY, "c", "n_convs", "parent_conv_id")
    out = out.join(counted.select(*KEY, "n_children"), KEY).join(totals, KEY).join(ends, KEY, "left")
    return out.select(F.col("c").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
                      "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """All nodes of the trie of all rebuilt conversations."""
    return prefix_trie(read(spark, sf_dir, "conversations"))


SQL_op13 = r"""
with t as (select conv_id c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) p,
             {'r': coalesce(role, ''), 'x': coalesce(text, '')} v from conversations where conv_id is not null),
o as (select c, list(v order by p) vs from t group by c),
k as (select c, vs, c - c % 5 b, xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(c::varchar, ''),
             lambda s: [ascii(s)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda a, s: case when s >= 0 then xor(a, s) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end), 4294967295) % 9 h from o),
u as (select k.c, list_concat(list_slice(coalesce(f.vs, []), 1, k.h), list_slice(k.vs, k.h + 1, len(k.vs))) vs
      from k left join o f on f.c = k.b),
m as (select c, len(vs) z, d, list_slice(vs, 1, d) s from u, unnest(range(0, len(vs) + 1)) r(d)),
n as (select d, s, min(c) c, count(*) n_convs, (count(*) - 1) * case when d > 0 then octet_length(encode(s[d].x)) else 0 end own,
        sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (z = d), '')) ends_sha256 from m group by d, s),
g as (select n.*, f.c parent_conv_id from n left join n f on f.d = n.d - 1 and f.s = list_slice(n.s, 1, n.d - 1)),
h as (select d - 1 d, list_slice(s, 1, d - 1) s, count(*) n from n where d > 0 group by all),
w as (select n.d, n.s, n.own, coalesce(h.n, 0) n_children from n left join h on h.d = n.d and h.s = n.s),
a as (select k.d::bigint d, list_slice(w.s, 1, k.d) s, sum(own)::bigint saved_tokens, count(*) filter (n_children = 0) n_leaves
      from w, unnest(range(0, w.d + 1)) k(d) group by all)
select g.c conv_id, g.d depth, g.parent_conv_id, g.n_convs, w.n_children, a.n_leaves, a.saved_tokens, g.ends_sha256
from g join w on w.d = g.d and w.s = g.s join a on a.d = g.d and a.s = g.s
"""
