"""The trie against plain dictionaries of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from millrace.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole, members = {}, defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 * (1 if c >= 0 else -1))
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = {}
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(out[k]["saved"] for k in children[p])
        leaves = sum(out[k]["leaves"] for k in children[p]) or 1
        ends = ",".join(str(c) for c in sorted(members[p]) if len(whole[c]) == len(p))
        out[p] = {"saved": saved, "leaves": leaves, "row": (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves, saved,
                                                            hashlib.sha256(ends.encode()).hexdigest())}
    return sorted((v["row"] for v in out.values()), key=str)


def got(df):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(r[n] for n in names) for r in df.select(*names).collect()), key=str)


def odd():
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["yes", "no", "é"])) for c in range(-12, 60) if c % 7 for t in range(rng.randint(1, 12))]
    rows += [(100, t, "user", "same") for t in range(90)] + [(101, t, "user", "same") for t in range(70)]
    rows += [(200, None, None, None), (200, 3, "user", "tie"), (200, 3, "user", "tie"), (200, 3, "assistant", "tie"), (201, 5, "user", ""), (202, 5, None, "x"),
             (None, 1, "user", "no id"), (204, 1, "user", "a" * 100_000), (301, 0, "user", "alone")]
    return rows


@pytest.mark.parametrize("band", [2, 16])
def test_equals_plain_prefixes(spark, wide, monkeypatch, band):
    if band == 2:  # several segments, pieces and rounds
        monkeypatch.setattr(trie, "SEGMENT", 3)
        monkeypatch.setattr(trie, "LISTED", 2)
    rows = odd()
    assert got(trie.prefix_trie(wide(spark.createDataFrame(rows, SCHEMA)), band)) == brute(rows)


def test_one_text_in_many_conversations(spark):
    rows = [(c, t, "user", "hi") for c in range(300) for t in range(2)]
    assert got(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_no_conversations(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
