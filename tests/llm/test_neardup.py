import random

import pytest

from millrace.llm import neardup
from tests.llm.conftest import by_id


def brute(rows, size, percent=80):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    sets = {r[0]: neardup.word_set(r[1] or "", size) for r in rows if r[0] is not None}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ids:
        for j in ids:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(seed, n=60, copies=14):
    """Texts, exact copies and copies with more and more words changed: chains and groups that are just not similar."""
    rng, rows = random.Random(seed), []
    for b in range(5):
        base = [f"w{rng.randrange(400)}" for _ in range(n + 20 * b)]
        rows.append(" ".join(base))
        for k in range(copies):
            new = list(base)
            for _ in range(k // 2):
                new[rng.randrange(len(new))] = f"v{rng.randrange(60)}"
            rows.append(("  " if k % 2 else "\t\n").join(new).upper() if k % 3 == 0 else " ".join(new))
            if k % 4 == 0:
                base = new if k % 8 == 0 else base  # a chain
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_brute_force(docs, wide, size):
    rows = family(size) + [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "a " * 30000), (8, "a " * 29999)]
    found = neardup.groups(wide(docs(rows)), params=neardup.Params(shingle=size))
    assert {r.id: (r.n_shingles, r.component) for r in found.collect()} == brute(rows, size)


def test_repeated_rows_and_rows_without_id(docs):
    rows = [(9, "a b c d e f"), (9, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (4, "x y z")]
    found = sorted((r.id is not None, r.id, r.component) for r in neardup.groups(docs(rows)).collect())
    assert found == [(False, None, None), (True, 3, 3), (True, 4, 4), (True, 9, 3), (True, 9, 3)]
    kept = by_id(neardup.representatives(docs(rows + [(4, "x y z")])))
    assert [r.doc_id for r in kept] == [None, 3, 4]


def test_an_id_with_several_texts_keeps_them_all(docs, wide):
    words = [" ".join(f"{w}{i}" for i in range(60)) for w in "abc"]
    rows = [(5, words[0]), (5, words[1]), (7, words[1] + " more"), (7, words[2]), (8, words[0]), (9, None), (9, ""), (9, ""), (None, words[0])]
    kept = sorted((str(r.doc_id), r.text or "") for r in neardup.representatives(wide(docs(rows))).collect())
    assert [x for x in kept if x[0] in ("9", "None")] == [("9", ""), ("9", ""), ("None", words[0])]
    texts = [t for i, t in kept if i in ("5", "7", "8")]
    # one of each group of texts that are alike, and nothing else is lost
    assert len(texts) == 3 and words[2] in texts and words[0] in texts and (words[1] in texts) != (words[1] + " more" in texts)


def test_no_documents(docs):
    assert neardup.groups(docs([])).collect() == []


def test_tests_keep_pairs_at_the_limit():
    """The chance that a pair of similarity 0.8 is dropped is small."""
    p = neardup.Params()
    limits = dict(neardup.least_matches(p))
    rng, lost = random.Random(1), 0
    for _ in range(2000):
        agreed = 0
        for n in range(1, p.bands * p.rows + 1):
            agreed += rng.random() < 0.8
            if n in limits and agreed < limits[n]:
                lost += 1
                break
    assert lost == 0 and limits[32] > 5 and limits[160] > 95
