import collections
import math

from millrace.llm import mixing
from tests.llm.conftest import by_id


def test_counts_follow_the_distribution(docs, wide):
    rows = [(i, "x" * 10, "en", "big") for i in range(3000)] + [(i, "x" * 10, "en", "small") for i in range(3000, 3600)]
    out = mixing.replicated(wide(docs(rows)), weights={"big": 1, "small": 1}).collect()
    n = collections.Counter(r.source for r in out)
    assert abs(n["big"] - 1800) < 150 and abs(n["small"] - 1800) < 150
    copies = collections.Counter(collections.Counter(r.doc_id for r in out if r.source == "small").values())
    for k in range(1, 6):
        want = 600 * math.exp(-3) * 3**k / math.factorial(k)
        assert abs(copies[k] - want) < 5 * math.sqrt(want) + 3
    assert {r.copy for r in out if r.doc_id == out[0].doc_id} == set(range(1, 1 + sum(r.doc_id == out[0].doc_id for r in out)))


def test_large_rates_and_weights_of_zero(docs):
    rows = [(i, "abc", "en", "rare") for i in range(20)] + [(99, "abc", "en", "off"), (98, None, "en", "empty"), (97, "abc", "en", None)]
    out = mixing.replicated(docs(rows), weights={"rare": 1.0, "off": 0.0}, budget=3 * 20 * 900)
    n = collections.Counter(r.doc_id for r in out.select("doc_id").collect())
    assert set(n) == set(range(20)) and abs(sum(n.values()) / 20 - 900) < 40


def test_same_result_in_any_order_and_repeated_rows(docs):
    rows = [(i, f"text {i}", "en", "ab"[i % 2]) for i in range(50)] + [(None, "t", "en", "a"), (None, "t", "en", "a")]
    first, second = (mixing.replicated(docs(x).repartition(n)) for x, n in ((rows, 1), (rows[::-1], 5)))
    key = lambda df: sorted((str(r.doc_id), r.copy, r.place) for r in df.collect())
    assert key(first) == key(second)


def test_empty_table(docs):
    assert mixing.replicated(docs([])).collect() == [] and by_id(mixing.replicated(docs([(1, "", "en", "s")]))) == []
