"""Near-duplicates: MinHash bands propose pairs, sequential Bayesian tests prune them, full sets decide.

Documents with the same set are one class first, represented by its smallest
id, so copies cost nothing later.  Each class gets a signature; classes that
agree in a band share a bucket.  The pairs of a bucket are not listed: its
members are compared with the smallest one, and links join components.  What
is still apart in a bucket goes to new buckets by its rarest shingles, as many
as a link must share one of, where the members outside the largest component
are held in blocks and the others stream past them.  So every proposed pair is
compared, already connected or shown to share too little.

A pair is compared batch by batch of its signatures: it is dropped as soon as
the posterior probability that the similarity reaches the limit, given the
agreeing hashes so far and a uniform prior, is below ``miss``.  Survivors are
verified on the words of both whole texts.  At similarity 0.8 the bands miss a
pair with probability (1 - 0.8^5)^32 = 3e-6, less above.

Defined cases: null and empty texts, and texts without words, have no shingle
and are linked with nothing; a text with fewer words than a shingle has its
whole sequence as one; rows without id are linked with nothing; an id names one
text, so rows that repeat an id repeat its result; other columns are not read;
empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.llm.components import roots
from millrace.llm.text import read, stored, whole
from millrace.llm.tokens import mix, pieces, shingles
from millrace.session import materialized


@dataclass(frozen=True)
class Params:
    shingle: int = 5
    percent: int = 80      # link if 100 * intersection >= percent * union
    bands: int = 32
    rows: int = 5
    batch: int = 32        # hashes compared between two tests
    miss: float = 1e-6     # posterior probability below which a pair is dropped
    block: int = 64        # members of a bucket that are held while the others stream past
    salts: int = 16        # parts of the pairs of one document in verification


def _signer(p: Params):
    rng = np.random.Generator(np.random.PCG64(7))
    n = p.bands * p.rows
    a = (rng.integers(0, 1 << 31, n) * 2 + 1).astype(np.uint32)[:, None]
    b = rng.integers(0, 1 << 32, n).astype(np.uint32)[:, None]
    salt = rng.integers(0, 1 << 63, p.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    band = np.arange(p.bands, dtype=np.uint64)

    def sign(found: np.ndarray) -> tuple[np.ndarray, bytes]:
        """Band keys, and one byte of each hash (equal hashes have equal bytes, so similarity is never underrated)."""
        x = (found >> np.uint64(32)).astype(np.uint32)
        low = np.full(n, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 512):
            h = a * x[None, i:i + 512]
            h += b
            np.minimum(low, h.min(1), out=low)
        keys = mix((low.reshape(p.bands, p.rows).astype(np.uint64) * salt).sum(1, dtype=np.uint64) + band)
        return keys.view(np.int64), ((low * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()

    return sign


def sketches(docs: DataFrame, p: Params) -> DataFrame:
    """Rows ``id, n_shingles, same`` (digest of the set), ``keys, bytes``; keys are null for texts without words."""
    schema = "id bigint, n_shingles bigint, same binary, keys array<bigint>, bytes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = _signer(p)
        for batch in batches:
            ids, at = batch.column(0), 0
            for piece in pieces(batch.column(1)):
                out: list[list] = [[], [], [], []]
                for r in range(len(piece)):
                    found = shingles(piece.words[piece.bounds[r]:piece.bounds[r + 1]], p.shingle)
                    keys, small = sign(found) if len(found) else (None, None)
                    for column, v in zip(out, (len(found), hashlib.blake2b(found.tobytes(), digest_size=16).digest(), keys, small)):
                        column.append(v)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(piece)), pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()),
                     pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.binary())],
                    ["id", "n_shingles", "same", "keys", "bytes"])
                at += len(piece)

    return docs.mapInArrow(run, schema)


def least_matches(p: Params) -> list[tuple[int, int]]:
    """After n hashes, the fewest agreeing ones with which a pair goes on."""
    total, t, out = p.bands * p.rows, p.percent / 100, []
    for n in range(p.batch, total + 1, p.batch):
        # P(s >= t | m of n agree, uniform prior) = P(Binomial(n + 1, t) <= m)
        sum_, m = 0.0, 0
        while m <= n:
            sum_ += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if sum_ >= p.miss:
                break
            m += 1
        out.append((n, m))
    return out


def _plausible(pairs: DataFrame, p: Params) -> DataFrame:
    """Pairs ``a, b`` that pass all sequential tests; reads the columns ``x, y`` with their signatures."""
    tests = least_matches(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3)]
            alive, agreed, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int32), 0
            for n, least in tests:
                agreed[alive] += (sides[0][alive, done:n] == sides[1][alive, done:n]).sum(1, dtype=np.int32)
                alive, done = alive[agreed[alive] >= least], n
            yield batch.select([0, 1]).take(pa.array(alive))

    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def word_set(text: str, size: int) -> set:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: lower-cases A-Z, splits at the six blanks
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(size)]))


def _verified(pairs: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """Pairs ``a, b`` whose full sets are similar enough.

    The texts of all b's of an a stream past the set of a; the b's are dealt to
    ``salts`` parts, so a document with very many pairs is several groups.
    """
    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(p.salts)))
    left = dealt.select("a", "salt").distinct().join(texts, F.col("a") == F.col("id")).select(
        "a", "salt", F.lit(None).cast("bigint").alias("b"), "text")
    right = dealt.join(texts, F.col("b") == F.col("id")).select("a", "salt", "b", "text")
    rows = left.unionByName(right).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: set = set()
        for batch in batches:
            out_a, out_b = [], []
            for a, b, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                other = word_set(text, p.shingle)
                if b is None:
                    own = other
                    continue
                both = len(own & other)
                if both and 100 * both >= p.percent * (len(own) + len(other) - both):
                    out_a.append(a)
                    out_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint")


def _open(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component."""
    mixed = members.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    return members.join(mixed, "key")


def _sets(texts: DataFrame, p: Params) -> DataFrame:
    """Rows ``id, n_set, hashes``: the shingles of texts as sorted 32-bit hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for piece in pieces(batch.column(1)):
                found = [np.unique((shingles(piece.words[piece.bounds[r]:piece.bounds[r + 1]], p.shingle) >> np.uint64(32))
                                   .astype(np.uint32)) for r in range(len(piece))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(piece)), pa.array([len(f) for f in found], pa.int64()),
                     pa.array([f.tobytes() for f in found], pa.binary())], ["id", "n_set", "hashes"])
                at += len(piece)

    return texts.select("id", "text").mapInArrow(run, "id bigint, n_set bigint, hashes binary")


def _exploded(sets: DataFrame) -> DataFrame:
    """Rows ``id, c, h`` of the sets of ``id, c, hashes``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [np.frombuffer(x, np.uint32) for x in batch.column(2).to_pylist()]
            if not hashes:
                continue
            times = [len(x) for x in hashes]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(i).to_numpy(), times)) for i in (0, 1)]
                + [pa.array(np.concatenate(hashes).astype(np.int64))], ["id", "c", "h"])

    return sets.select("id", "c", "hashes").mapInArrow(run, "id bigint, c bigint, h bigint")


def _prefixes(now: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """Buckets ``key, id, n`` of the members that are still apart, by their rarest shingles.

    A link of x and y needs (100 + percent) * intersection >= percent * (|x| + |y|),
    and y is no smaller than the smallest member of a shared bucket, nor than
    percent of x.  So x and y share one of the first |x| - intersection + 1
    shingles of x, in any order of all shingles.  Those that one component alone
    holds come first, since they make no pairs, then the rare ones.
    """
    least = now.groupBy("key").agg(F.min("n").alias("low"))
    ids = now.join(least, "key").groupBy("id", "c", "n").agg(F.min("low").alias("low"))
    # the set of 32-bit hashes may be a little smaller than the real one: its size, less two, keeps every link
    ids = ids.join(sets, "id").withColumn("n", F.col("n_set"))
    rows = materialized(_exploded(ids))
    mixed = rows.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("df")).where("lo < hi")
    held = rows.join(mixed.select("h", "df"), "h").select("id", "h", "df")
    own = W.partitionBy("id")
    held = held.withColumn("place", F.row_number().over(own.orderBy("df", "h"))).withColumn("held", F.count("*").over(own))
    partner = F.greatest("low", F.ceil(F.col("n") * p.percent / 100))
    needed = F.ceil(p.percent * (F.col("n") + partner) / (100 + p.percent)) - 2
    # the n - held shingles that only one component holds stand before the first place
    return held.join(ids.drop("hashes"), "id").where(F.col("place") + F.col("n") - F.col("held") <= F.col("n") - needed + 1).select(
        F.col("h").alias("key"), "id")


def _block_pairs(members: DataFrame, tokens: DataFrame, p: Params) -> DataFrame:
    """Pairs ``a, b`` of different components that share a bucket and enough shingles.

    In a bucket all members outside its largest component are pivots.  They are
    dealt to blocks of about ``block``, and the members of the bucket stream
    past each block; the shingles that a member shares with the pivots are
    counted at once.  Shingles are 32-bit hashes here, so two may fall together:
    pairs may be two short of the limit, and full sets decide afterwards.
    """
    heads = members.groupBy("key").agg(F.max_by("c", F.struct("size", "c")).alias("main"), F.count("*").alias("m"))
    split = members.join(heads, "key").withColumn("pivot", F.col("c") != F.col("main"))
    blocks = split.where("pivot").groupBy("key").agg(F.ceil(F.count("*") / p.block).cast("int").alias("blocks"))
    split = split.join(blocks, "key").select("key", "id", "c", "pivot", "blocks")
    own = split.where("pivot").select("key", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "id", "c", F.lit(0).alias("role"))
    met = split.select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "c", F.lit(1).alias("role"))
    rows = own.unionByName(met).join(tokens, "id").select("key", "block", "role", "id", "c", "n", "hashes")
    rows = rows.repartition("key", "block").sortWithinPartitions("key", "block", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pivots, table = None, [], None
        for batch in batches:
            out_a, out_b = [], []
            for key, block, role, i, c, n, raw in zip(*(x.to_pylist() for x in batch.columns)):
                if (key, block) != at:
                    at, pivots, table = (key, block), [], None
                hashes = np.frombuffer(raw, np.uint32)
                if role == 0:
                    pivots.append((i, c, n, hashes))
                    continue
                if table is None:
                    known, place = np.unique(np.concatenate([x[3] for x in pivots]), return_inverse=True)
                    table = np.zeros((len(known), len(pivots)), np.uint8)
                    table[place, np.repeat(np.arange(len(pivots)), [len(x[3]) for x in pivots])] = 1
                    ids, cs, ns = (np.array([x[j] for x in pivots]) for j in range(3))
                found = np.searchsorted(known, hashes)
                found[found == len(known)] = 0
                both = table[found[known[found] == hashes]].sum(0, dtype=np.int64) + 2
                for x in ids[(cs != c) & ((100 + p.percent) * both >= p.percent * (ns + n))]:
                    out_a.append(min(i, int(x)))
                    out_b.append(max(i, int(x)))
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def _hooked(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Rows ``id, c, size``: each node hung twice on its smallest linked one; equal labels are always connected."""
    up = links.groupBy(F.greatest("a", "b").alias("c")).agg(F.min(F.least("a", "b")).alias("up"))
    label = nodes.select("id", F.col("id").alias("c"))
    for _ in range(2):
        label = label.join(up, "c", "left").select("id", F.coalesce("up", "c").alias("c"))
    return label.join(label.groupBy("c").agg(F.count("*").alias("size")), "c").select("id", "c", "size")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """A row per row of ``docs``: ``id, n_shingles, component``; the component is its smallest id."""
    p = params
    docs = docs.select(F.col(doc_id).cast("bigint").alias("id"), whole(F.col(text)).alias("text"))
    sketched = materialized(sketches(docs, p))
    linked = sketched.where(F.col("id").isNotNull() & F.col("keys").isNotNull())
    classes = materialized(linked.groupBy("same").agg(F.min("id").alias("rep")))
    # a row that repeats an id may belong to another class; signatures go with the set
    reps = linked.join(classes, "same").where("id = rep").dropDuplicates(["same"])
    reps = materialized(reps.select(F.col("rep").alias("id"), F.col("n_shingles").alias("n"), "keys", "bytes"))
    every = reps.select("id", "n", F.explode("keys").alias("key"))
    shared = every.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key")
    members = materialized(every.join(shared, "key").select("key", "id", "n"))
    tried = materialized(members.select("id").distinct())
    texts = stored(docs.join(tried, "id", "left_semi").dropDuplicates(["id"]), "near-duplicates")
    small = reps.join(tried, "id", "left_semi").select("id", "bytes")

    # first pass: every member of a bucket with the smallest one
    first = members.groupBy("key").agg(F.min("id").alias("a"))
    pairs = members.join(first, "key").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    pairs = pairs.join(small.toDF("a", "x"), "a").join(small.toDF("b", "y"), "b")
    links = materialized(_verified(materialized(_plausible(pairs, p)), texts, p))
    state = materialized(_hooked(tried, links))

    # second pass: what is still apart in a bucket, by its rarest shingles
    apart = materialized(_open(members.join(state, "id")))
    rows = materialized(_sets(texts.join(apart.select("id").distinct(), "id", "left_semi"), p))
    close = materialized(_open(_prefixes(apart, rows, p).join(state, "id")))
    more = _block_pairs(close, rows.select("id", F.col("n_set").alias("n"), "hashes"), p)
    links = links.unionByName(_verified(materialized(more), texts, p))

    root = roots(links.toDF("u", "v")).toDF("rep", "root")
    found = classes.join(root, "rep", "left").select("same", F.coalesce("root", "rep").alias("component"))
    alone = F.when(F.col("keys").isNull(), F.lit(None)).otherwise(F.col("same"))
    return sketched.select("id", "n_shingles", alone.alias("same")).join(found, "same", "left").select(
        "id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))


def op2_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Component of every document under two-word shingles."""
    found = groups(read(spark, sf_dir, "documents"), params=Params(shingle=2))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                        (F.col("id") == F.col("component")).alias("kept"))


def _named(docs: DataFrame) -> DataFrame:
    """Rows ``id, text, d``: ids that stand for several texts are replaced by new ones below all others, one per text."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("h"), F.struct("*").alias("d"))
    several = rows.where("id is not null").groupBy("id").agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.min("id").alias("low")).where("lo < hi").select("id")
    several = materialized(several)
    if several.isEmpty():
        return rows.select("id", F.col("d.text").alias("text"), "d")
    least = F.least(rows.agg(F.min("id")).scalar(), F.lit(0))
    pairs = rows.join(several, "id", "left_semi").select("id", "h").distinct()
    pairs = materialized(pairs.select(F.col("id").alias("old"), F.col("h").alias("oh"), (least - 1 - F.monotonically_increasing_id()).alias("new")))
    renamed = rows.join(pairs, (F.col("id") == F.col("old")) & (F.col("h") == F.col("oh")), "left")
    return renamed.select(F.coalesce("new", "id").alias("id"), F.col("d.text").alias("text"), "d")


def representatives(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """One document of each group, all columns kept, whatever their names.

    Rows with one id and one text are one document: the first of them in the
    order of their JSON form stays.  Rows with one id and different texts are
    different documents.  Rows without id stay.
    """
    rows = _named(docs)
    found = materialized(groups(rows, "id", "text", params=params))
    dropped = found.where("id <> component").select(F.col("id").alias("other")).distinct()
    repeated = materialized(found.where("id is not null").groupBy("id").count().where("count > 1").select(F.col("id").alias("again")))
    left = rows.select("id", "d").join(dropped, F.col("id") == F.col("other"), "left_anti")
    single = left.join(repeated, F.col("id") == F.col("again"), "left_anti").select("d")
    several = left.join(repeated, F.col("id") == F.col("again"), "left_semi")
    several = several.groupBy("id").agg(F.min_by("d", F.to_json("d")).alias("d")).select("d")
    return single.unionByName(several).select(*[F.col("d").getField(c).alias(c) for c in docs.columns])


SQL_op2 = r"""
with recursive d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
s as (select doc_id, case when len(w) = 0 then []::varchar[] when len(w) = 1 then w
        else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end g from d),
e as (select doc_id, unnest(g) x from s),
n as (select doc_id, len(g) n from s),
inter as (select a.doc_id a, b.doc_id b, count(*) i from e a join e b on a.x = b.x and a.doc_id < b.doc_id group by all),
l as (select a, b from inter join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * i >= 80 * (na.n + nb.n - i)),
both_ways as (select a, b from l union all select b, a from l),
reach as (select doc_id a, doc_id b from d union select r.a, l.b from reach r join both_ways l on r.b = l.a),
c as (select a, min(b) c from reach group by a)
select n.doc_id, n.n::bigint n_shingles, c component_id, n.doc_id = c kept from n join c on c.a = n.doc_id
"""
