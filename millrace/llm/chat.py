"""Chat formatting from an event log.

A conversation is a log of events in sequence: ``message`` opens the message of
a turn, ``delta`` adds text to it, ``edit`` replaces its text, ``regenerate``
empties it.  An edit or a regeneration also drops the later turns that were
there before it.  Folding keeps, per message, the text since the last event
that set it, and the messages that no later change of an earlier turn dropped.
The work is dealt out by message, so a conversation of any length is many
groups; only the last step, which reads a finished conversation in order, goes
by conversation, and streams.

A turn is rendered as ``### role: text</turn>`` and a line end.  Inside roles and
texts a backslash becomes two, and ``###`` and ``</turn>`` are broken by ``\\h``
and ``\\l``; a role's colon and line end become ``\\c`` and ``\\n``.  So control
strings stand only where turns begin and end, and the texts can be read back.

Defined cases: null texts and roles are empty; turns without number come first;
equal turns go by role, then text, and rows that are repeated are turns of
their own; rows without conversation id are one conversation without id; a
conversation with no event has no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.llm.text import read, whole

SETS = ("message", "edit", "regenerate")
CUTS = ("edit", "regenerate")
#: code points of one streamed delta in the log of a stored conversation
DELTA = 1000
ROLE = "assistant"

_TURN = re.compile(r"### ([^:]*): (.*)</turn>\n", re.S)
_CODES = {"\\": "\\", "h": "#", "l": "<", "c": ":", "n": "\n"}


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``conv, at, role, text`` of a log ``conv, seq, kind, at, role, text``.

    ``at`` orders the turns of a conversation and ``seq`` its events; both may
    be of any type that can be sorted.
    """
    own = W.partitionBy("conv", "at")
    e = events.withColumn("base", F.max(F.when(F.col("kind").isin(*SETS), F.col("seq"))).over(own))
    e = e.withColumn("cut", F.max(F.when(F.col("kind").isin(*CUTS), F.col("seq"))).over(own))
    e = e.withColumn("named", F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).over(own))
    e = e.where(F.col("base").isNull() | (F.col("seq") >= F.col("base")))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("seq", whole(F.col("text")).alias("text")))), lambda x: x["text"])
    folded = e.groupBy("conv", "at").agg(F.first("named").alias("role"), F.array_join(parts, "").alias("text"))

    heads = e.groupBy("conv", "at").agg(F.coalesce(F.first("base"), F.min("seq")).alias("opened"), F.first("cut").alias("cut"))
    changed = heads.where(F.col("cut").isNotNull()).select(F.col("conv").alias("k")).distinct()
    heads = heads.join(changed, F.col("conv").eqNullSafe(F.col("k")), "left_semi")
    earlier = W.partitionBy("conv").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    dead = heads.withColumn("cuts", F.max("cut").over(earlier)).where(F.col("cuts") > F.col("opened"))
    dead = dead.select(F.col("conv").alias("dc"), F.col("at").alias("da"))
    return folded.join(dead, F.col("conv").eqNullSafe(F.col("dc")) & F.col("at").eqNullSafe(F.col("da")), "left_anti")


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.regexp_replace(text, "#(?=##)", r"\\h"), "<(?=/turn>)", r"\\l")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _CODES[m[1]], text, flags=re.S)


def parse(rendered: str) -> tuple[str, str]:
    """Role and text of one rendered turn."""
    role, text = _TURN.fullmatch(rendered).groups()
    return unescape(role), unescape(text)


def render(messages: DataFrame, trained_role: str = ROLE) -> DataFrame:
    """Rows ``conv, at, turn, mask_start, mask_end``: a rendered turn and the code points of it that are under the loss mask."""
    role = F.replace(F.replace(escaped(whole(F.col("role"))), F.lit(":"), F.lit("\\c")), F.lit("\n"), F.lit("\\n"))
    head, text = F.concat(F.lit("### "), role, F.lit(": ")), escaped(F.col("text"))
    trained = F.coalesce(F.col("role") == trained_role, F.lit(False))
    start = F.when(trained, F.length(head)).otherwise(0)
    return messages.select("conv", "at", F.concat(head, text, F.lit("</turn>\n")).alias("turn"), start.alias("mask_start"),
                           F.when(trained, start + F.length(text)).otherwise(0).alias("mask_end"))


def as_log(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           delta: int = DELTA) -> DataFrame:
    """Stored turns as a log: each message is opened and its text streams in."""
    rows = rows.select(F.col(conv).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"),
                       F.col(role).alias("role"), whole(F.col(text)).alias("text"))
    copy = F.row_number().over(W.partitionBy("conv", "turn").orderBy("role", "text"))
    rows = rows.withColumn("at", F.struct("turn", copy.alias("copy")))
    last = F.floor(F.greatest(F.length("text") - 1, F.lit(0)) / delta).cast("int")
    rows = rows.select("conv", "at", "role", "text", F.explode(F.sequence(F.lit(-1), last)).alias("part"))
    opens = F.col("part") < 0
    return rows.select("conv", F.struct("at.turn", "at.copy", "part").alias("seq"),
                       F.when(opens, "message").otherwise("delta").alias("kind"), "at", F.when(opens, F.col("role")).alias("role"),
                       F.when(opens, "").otherwise(F.substring("text", F.col("part") * delta + 1, F.lit(delta))).alias("text"))


def digests(rendered: DataFrame) -> DataFrame:
    """A row per conversation, read back from the rendered turns in order; only hashes and counts are held."""
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    names = schema.replace(" bigint", "").replace(" string", "").split(", ")
    types = [pa.string() if "sha" in n else pa.int64() for n in names]
    ordered = rendered.repartition("conv").sortWithinPartitions("conv", "at").select("conv", "turn", "mask_start", "mask_end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def close():
            conv, n, turns, chars, loss, size = state
            return (conv, n, turns.hexdigest(), chars, loss.hexdigest(), size)

        for batch in batches:
            done = []
            for conv, turn, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(close())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(turn)
                under = unescape(turn[start:end])
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(under)
                state[4].update(under.encode())
                state[5] += len(turn)
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(close(), types)], names)

    return ordered.mapInArrow(run, schema)


def op1_chat_format(spark, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations and of conversation -7, whose texts hold control strings."""
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return digests(render(fold(as_log(rows))))


SQL_op1 = r"""
with t as (select conv_id, turn, coalesce(role, '') r, coalesce(text, '') x from conversations
           union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f as (select *, 4 + length(r) + 2 + length(x) + (length(x) - length(replace(x, '\', '')))
             + coalesce(list_sum(list_transform(regexp_extract_all(x, '#{3,}'), lambda h: length(h) - 2)), 0)
             + (length(x) - length(replace(x, '</turn>', ''))) // 7 + 8 n from t)
select conv_id, count(*) n_turns,
       sha256(string_agg(r || chr(10) || x || chr(10), '' order by turn nulls first, r, x)) turns_sha256,
       sum(case when r = 'assistant' then length(x) else 0 end)::bigint loss_chars,
       sha256(coalesce(string_agg(case when r = 'assistant' then x end, '' order by turn nulls first, r, x), '')) loss_sha256,
       sum(n)::bigint formatted_chars
from f group by conv_id
"""
