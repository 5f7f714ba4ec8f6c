"""The filter audit against a plain count in every order."""

import re
from collections import Counter
from itertools import permutations

from millrace.llm import audit

LABELS = "doc_id bigint, quality int, toxic int"


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    fails = []
    for doc_id, text, lang, _ in rows:
        x = text or ""
        words = re.findall("[^\x20\x09-\x0D]+", x)
        f = set()
        if len(words) < 200:
            f.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            f.add("B")
        if 100 * len(re.findall("[A-Z]", x)) > 3 * len(x):
            f.add("C")
        if re.search("[#$%&*|]", x):
            f.add("D")
        if doc_id is not None and any(o is not None and o < doc_id and (t or "") == x for o, t, _, _ in rows):
            f.add("E")
        fails.append((lang or "", f, doc_id in good, doc_id in toxic))
    out, shapley = {}, Counter()
    for part in {p for p, *_ in fails}:
        for order in permutations("ABCDE"):
            left, gone = [x[1:] for x in fails if x[0] == part], []
            for step, own in enumerate(order, 1):
                hit, left = [x for x in left if own in x[0]], [x for x in left if own not in x[0]]
                shapley[part, own] += len(hit)
                out[part, "".join(order), step] = [len(left), len(hit), sum(own in x[0] for x in gone), sum(p == part and f == {own} for p, f, _, _ in fails),
                                                   sum(x[1] for x in hit), sum(x[2] for x in hit)]
                gone += hit
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def test_equals_a_plain_count(spark, docs, wide):
    varied = " ".join(f"word{i}" for i in range(250))
    same = " ".join(["a", "b"] * 150)
    rows = [(1, varied, "en", "s"), (2, varied, "de", "s"), (3, varied + " #", "en", "s"), (4, same, "en", "s"), (5, same, "en", "s"),
            (6, None, None, None), (7, "", "", "s"), (8, "SHOUT 50%", "en", "s"), (8, "SHOUT 50%", "en", "s"), (8, "SHOUT 50%", "fr", "s"),
            (9, "SHOUT 50%", "en", "s"), (None, varied, "en", "s"), (None, varied, "en", "s"), (10, " \t\n", "en", "s"),
            (11, "é" * 30 + "A", "en", "s"), (12, "x\xa0y " * 300, "fr", "s"), (13, varied * 400, "fr", "s"), (14, varied * 400, "fr", "s")]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, None), (3, 1, 0), (4, 0, 1), (8, 1, 1), (9, None, 1), (99, 1, 1), (None, 1, 1)]
    counts = audit.combinations(wide(docs(rows)), wide(spark.createDataFrame(labels, LABELS)))
    assert got(audit.by_order(counts)) == brute(rows, labels)


def test_many_copies_leave_the_first(spark, docs):
    rows = [(i, "one text", "en", "s") for i in range(500, 0, -1)]
    out = got(audit.by_order(audit.combinations(docs(rows), spark.createDataFrame([], LABELS))))
    assert out["en", "EABCD", 1][:3] == (1, 499, 0)


def test_no_documents(spark, docs):
    assert audit.by_order(audit.combinations(docs([]), spark.createDataFrame([], LABELS))).collect() == []
