import re

from millrace.llm import decontaminate
from tests.llm.conftest import by_id

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            n = min(len(v), 10)
            for s in range(len(v) - n + 1 if v else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == v[s:s + n]:
                        hit.update(range(p, p + n))
                        if item is not None:
                            found.add(str(item))
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=lambda x: (x[0] is not None, x))


LONG = " ".join(f"q{i}" for i in range(40))
ITEMS = [(0, LONG), (1, "Short ITEM here"), (2, "one"), (3, None), (4, "..."), (5, "a a a a a a a a a a a a"), (10, LONG + " more"), (None, "null id item"),
         (1, "Short ITEM here"), (7, "b c d e f g")]
DOCS = [(1, "x " + " ".join(f"Q{i}" for i in range(5, 18)) + " y"), (2, "short-item.HERE, and one"), (3, None), (4, ""), (5, "a " * 50),
        (6, " ".join(f"q{i}" for i in range(9))), (7, "null id item é"), (8, ("pad " * 20000) + LONG), (None, "one one"), (2, "short-item.HERE, and one"),
        (9, "b c d e f g b c d e f"), (11, "q0 q1 q2 q3 q4 q5 q6 q7 q8 q9 q9 q8 q5 q6 q7 q8 q9 q10 q11 q12 q13 q14")]


def test_hits_equal_brute_force(spark, docs, wide):
    items = wide(spark.createDataFrame(ITEMS, "item_id bigint, text string"))
    found = by_id(decontaminate.hits(wide(docs(DOCS)), items))
    assert [(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found] == brute(DOCS, ITEMS)


def test_a_full_filter_lets_through_but_changes_nothing(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = by_id(decontaminate.hits(docs(DOCS), items, filter_bits=64))
    assert [(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found] == brute(DOCS, ITEMS)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert [(r.n_words, r.n_hit, r.item_ids) for r in decontaminate.hits(docs([(1, "a b")]), none).collect()] == [(2, 0, [])]
    assert decontaminate.hits(docs([]), none).collect() == []


def test_clean_keeps_the_rest_whole(spark, docs, wide):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    kept = decontaminate.clean(wide(docs(DOCS + [(3, None)])), items)
    clean = [i for i, n, hit, _ in brute(DOCS, ITEMS) if not hit] + [3]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(clean)
    assert kept.columns == wide(docs([])).columns
