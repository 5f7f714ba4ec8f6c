"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

The fixed patterns give e-mail addresses, IPv4 addresses, card and telephone
numbers.  They seed the bootstrap, and so do tokens that are shaped like a key
or a password: long, of letters and digits in short runs, of many different
characters.  Tokens that hold a digit or an @ are instances, the words around them are their lexical patterns (two words
before, or one word before and one after).  A shape alone is no span: it takes a
context that it shares with others.  The graph of patterns and instances
is scored in turns: a pattern is as good as the share of its distinct
instances that are believed, given enough of them and damped for rare patterns; an instance is as
good as its patterns together.  Instances whose score passes a limit are
believed in the next turn.  What stands in a good pattern in the end is a span
of kind ``other`` if no fixed span covers it.

Positions are code points, ends are exclusive.  Defined cases: null and empty
texts have no span; repeated rows get a row each; texts without digit and
without @ are never searched; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.llm.text import let, lowered, read, whole
from millrace.session import materialized

# possessive where a greedy repeat can't be continued otherwise: same matches, no deep recursion
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]*?[0-9@][^\x20\x09-\x0D]*+"
KINDS = ("email", "ip", "card", "phone")
#: code points around a token in which its context words are looked for
NEAR = 64


@dataclass(frozen=True)
class Params:
    turns: int = 3
    seeds: int = 5               # distinct believed instances that a pattern needs
    pattern_score: float = 0.8   # share of believed instances that makes a pattern good
    instance_score: float = 0.8
    secret_length: int = 16      # of a token that is a seed by its shape: characters, runs of letters or digits, different characters
    secret_runs: int = 6
    secret_variety: int = 8


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum of the digits, every second one from the right doubled and cast out by nines, divides by ten."""
    def summed(d: Column) -> Column:
        value = lambda x, i: F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x)
        return F.aggregate(F.transform(d, value), F.lit(0), lambda a, x: a + x) % 10 == 0

    each = F.filter(F.split(F.reverse(digits), ""), lambda x: x != "").cast("array<int>")
    return let(each, summed)


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = lambda x: (F.length(F.ltrim(F.lit("0"), x)) <= 3) & (F.right(x, F.lit(3)).cast("int") <= 255)
        return F.forall(F.split(m, r"\."), part)
    if kind == "card":
        return let(_digits(m), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def _secret(core: Column, p: Params) -> Column:
    """Whether a token is shaped like a key: long, letters and digits in short runs, many different characters."""
    runs = F.length(F.regexp_replace(F.regexp_replace(core, "[A-Za-z]+", "x"), "[0-9]+", "0"))
    varied = F.size(F.array_distinct(F.split(core, "")))
    return F.when(F.length(core) >= p.secret_length, core.rlike(r"\A[A-Za-z0-9+/_=-]+\z") & (runs >= p.secret_runs) & (varied >= p.secret_variety)).otherwise(False)


def _matches(text: Column, kind: str, pattern: str, where: Column) -> Column:
    """Array of ``kind, i, gap, hit``: the text before each match and the match; the last one is the rest of the text."""
    both = lambda group: F.regexp_extract_all(text, F.lit(f"(?s)(.*?)({pattern}|\\z)"), F.lit(group))
    found = F.zip_with(both(1), both(2), lambda g, h: F.struct(
        F.lit(kind).alias("kind"), F.length(g).alias("skip"), F.left(g, F.lit(NEAR)).alias("after"),
        F.right(g, F.lit(NEAR)).alias("before"), h.alias("hit")))
    return F.when(where, found).otherwise(F.array().cast("array<struct<kind:string,skip:int,after:string,before:string,hit:string>>"))


def scan(docs: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """A row per document with all matches; written to the shared folder, so that the row numbers stay."""
    t = F.col("_t")
    digit = t.rlike("[0-9]")
    at = t.contains("@")
    tried = {"email": (EMAIL, at), "ip": (IP, digit & t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")),
             "card": (CARD, digit & t.rlike(r"(?:[0-9][\x20-]?){15}[0-9]")),
             "phone": (PHONE, t.contains("+") & t.rlike(r"\+[0-9]")), "token": (TOKEN, digit | at)}
    base = docs.select(*[F.col(c).alias(f"c_{c}") for c in keep], whole(F.col(text)).alias("_t"))
    found = F.concat(*[_matches(t, k, p, w) for k, (p, w) in tried.items()])
    return materialized(base.select(F.monotonically_increasing_id().alias("row"), *[f"c_{c}" for c in keep], found.alias("found")))


def placed(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Base spans ``row, kind, start, end``, and tokens with position, core, context words."""
    each = scanned.where(F.size("found") > 0).select("row", F.posexplode("found").alias("i", "m")).select("row", "i", "m.*")
    order = W.partitionBy("row", "kind").orderBy("i")
    length = F.length("hit")
    each = each.select("*", (F.sum(F.col("skip") + length).over(order)).alias("end"),
                       F.lag("hit").over(order).alias("left_hit"), F.lead("hit").over(order).alias("right_hit"),
                       F.lead("after").over(order).alias("right"), F.lead("skip").over(order).alias("right_skip")).where(length > 0)
    each = each.withColumn("start", F.col("end") - length)
    ok = F.lit(False)
    for kind in KINDS:
        ok = F.when(F.col("kind") == kind, _valid(kind, F.col("hit"))).otherwise(ok)
    spans = each.where((F.col("kind") != "token") & ok).select("row", "kind", "start", "end")

    edge = r"^[^A-Za-z0-9+]*"
    core = F.regexp_replace(F.regexp_replace("hit", edge, ""), r"[^A-Za-z0-9]*$", "")
    lead = F.length("hit") - F.length(F.regexp_replace("hit", edge, ""))
    # of a long gap only the whole words near the token are context
    before = F.when(F.col("skip") > NEAR, F.regexp_replace("before", r"\A[^ \t-\r]+", "")).otherwise(F.concat(F.coalesce("left_hit", F.lit("")), F.col("before")))
    after = F.when(F.col("right_skip") > NEAR, F.regexp_replace("right", r"[^ \t-\r]+\z", "")).otherwise(F.concat("right", F.coalesce("right_hit", F.lit(""))))
    tokens = each.where("kind = 'token'").select(
        "row", core.alias("core"), (F.col("start") + lead).alias("start"),
        F.slice(F.split(lowered(before), r"[ \t-\r]+"), -3, 3).alias("l"), F.split(lowered(after), r"[ \t-\r]+").alias("r"))
    words = lambda c: F.array_remove(c, "")
    tokens = tokens.where(F.length("core") > 0).select(
        "row", "core", "start", (F.col("start") + F.length("core")).alias("end"), words(F.col("l")).alias("l"),
        F.get(words(F.col("r")), F.lit(0)).alias("r1"))
    l1, l2 = F.element_at("l", -1), F.get("l", F.size("l") - 2)
    ahead = F.when(F.size("l") >= 2, F.concat_ws(" ", l2, l1, F.lit("_")))
    around = F.when((F.size("l") >= 1) & F.col("r1").isNotNull(), F.concat_ws(" ", l1, F.lit("_"), F.col("r1")))
    return spans, tokens.select("row", "core", "start", "end", F.array_compact(F.array(ahead, around)).alias("patterns"))


def good_patterns(spans: DataFrame, tokens: DataFrame, params: Params) -> DataFrame:
    """Patterns (column ``pattern``) that hold believed instances after the last turn."""
    instance = F.xxhash64("core")
    inside = (spans["row"] == tokens["row"]) & (spans["start"] < tokens["end"]) & (tokens["start"] < spans["end"])
    shaped = tokens.where(_secret(F.col("core"), params)).select(instance.alias("instance"))
    seeds = tokens.join(spans, inside, "left_semi").select(instance.alias("instance")).union(shaped).distinct()
    edges = materialized(tokens.select(instance.alias("instance"), F.explode("patterns").alias("pattern")).distinct())
    belief = seeds.select("instance", F.lit(1.0).alias("score"))
    good = None
    for _ in range(params.turns):
        seen = edges.join(belief, "instance", "left")
        sums = seen.groupBy("pattern").agg(F.count("*").alias("n"), F.sum(F.coalesce("score", F.lit(0.0))).alias("sum"))
        # each pattern is damped as if half an instance more were not believed
        good = materialized(sums.where(F.col("sum") >= params.seeds).select(
            "pattern", (F.col("sum") / (F.col("n") + 0.5)).alias("score")).where(F.col("score") >= params.pattern_score))
        reached = edges.join(good, "pattern").groupBy("instance").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))).alias("new"))
        reached = reached.where(F.col("new") >= params.instance_score)
        belief = materialized(seeds.withColumn("seed", F.lit(1.0)).join(reached, "instance", "full").select(
            "instance", F.coalesce("seed", "new").alias("score")))
    return good.select("pattern")


def found_spans(scanned: DataFrame, params: Params = Params()) -> DataFrame:
    """Rows ``row, kind, start, end`` of all spans; found ones overlap no base span."""
    spans, tokens = (materialized(x) for x in placed(scanned))
    good = good_patterns(spans, tokens, params)
    hit = tokens.select("row", "start", "end", F.explode("patterns").alias("pattern")).join(good, "pattern").select(
        "row", "start", "end").distinct()
    clash = (spans["row"] == hit["row"]) & (spans["start"] < hit["end"]) & (hit["start"] < spans["end"])
    new = hit.join(spans, clash, "left_anti").select("row", F.lit("other").alias("kind"), "start", "end")
    return spans.unionByName(new)


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in (*KINDS, "other")]), kind).cast("int")


def personal_data(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), params: Params = Params()) -> DataFrame:
    """The kept columns and ``spans``: an array of ``rank, start, end, kind`` in order."""
    scanned = scan(docs, text, keep)
    spans = found_spans(scanned, params).groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        _rank(F.col("kind")).alias("rank"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"),
        "kind"))).alias("spans"))
    none = F.array().cast("array<struct<rank:int,start:int,end:int,kind:string>>")
    return scanned.drop("found").join(spans, "row", "left").select(
        *[F.col(f"c_{c}").alias(c) for c in keep], F.coalesce("spans", none).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op10_personal_data(spark, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    s = F.col("spans")
    count = lambda kind: F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("bigint")
    return personal_data(read(spark, sf_dir, "documents")).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(F.filter(s, lambda x: x["kind"] != "other")), 256).alias("base_sha256"), _listed(s).alias("spans"))


def redacted(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """Documents with every span replaced by its kind in brackets; all columns kept, whatever their names."""
    key = F.xxhash64("doc_id", "text")
    found = personal_data(docs.select("doc_id", "text", key.alias("key")), keep=("doc_id", "key"), params=params)
    found = found.where(F.size("spans") > 0).groupBy("key", "doc_id").agg(F.first("spans").alias("spans"))
    rows = docs.select(key.alias("own_key"), F.struct("*").alias("d"))
    rows = rows.join(found, (F.col("own_key") == F.col("key")) & F.col("d.doc_id").eqNullSafe(F.col("doc_id")), "left")
    text = F.col("d.text")

    def rebuilt(spans: Column) -> Column:
        """Spans by start; what an earlier one covers is skipped."""
        def piece(x: Column, i: Column) -> Column:
            done = F.coalesce(F.array_max(F.transform(F.slice(spans, 1, i), lambda y: y["end"])), F.lit(0))
            mark = F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))
            return F.when(x["start"] >= done, F.concat(F.substring(text, done + 1, x["start"] - done), mark)).otherwise("")

        end = F.array_max(F.transform(spans, lambda y: y["end"]))
        return F.concat(F.array_join(F.transform(spans, piece), ""), F.substring(text, end + 1, F.length(text)))

    by_start = F.sort_array(F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    new = F.when(F.col("spans").isNotNull(), let(by_start, rebuilt)).otherwise(text)
    return rows.select(*[new.alias(c) if c == "text" else F.col("d").getField(c).alias(c) for c in docs.columns])
