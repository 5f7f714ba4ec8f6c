"""Models: exact parts against brute force, learned parts by held-out results."""

import collections
import math
import random
import zlib

import numpy as np

from millrace.llm import language, suffix_tree, toxicity
from tests.llm.conftest import by_id


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def test_base_scores_equal_brute_force(docs, wide):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "cat", "dogs", "É", f"r{i}", "\U0001F600"]) for _ in range(rng.randrange(30)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "long " * 20000), (None, "no id"), (5, rows[5][1]), (204, "A" * 3000)]
    counts = collections.Counter(x for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 10 for x in tokens(t))
    n, v = sum(counts.values()), len(counts)
    got = by_id(suffix_tree.scores(wide(docs(rows))))
    for r, (i, t) in zip(got, sorted(rows, key=lambda x: (x[0] is not None, x[0])), strict=True):
        w = tokens(t)
        base = sum(math.log10((counts.get(x, 0) + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == (i, len(w), sum(x in counts for x in w), n)
        assert r.held_out == (i is None or zlib.crc32(str(i).encode()) % 10 == 0)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)


def test_tree_is_a_distribution_and_uses_long_contexts(spark):
    text = "abcabcabd" * 400 + "xyz" * 50
    codes = collections.Counter()
    padded = b"     " + text.encode()
    p = suffix_tree.Params(divergence=5.0)
    for i in range(5, len(padded)):
        codes[int.from_bytes(padded[i - 5:i + 1], "big")] += 1
    tree = suffix_tree.grown(spark.createDataFrame(list(codes.items()), "code bigint, n bigint"), p)
    seen = len(tree.logp[0]) - 1
    total = (10.0 ** tree.logp[:-1, :seen]).sum(1) + (256 - seen) * 10.0 ** tree.logp[:-1, seen]
    assert np.allclose(total, 1, atol=1e-3) and len(tree.child) > 5
    after = lambda s: tree.word_logp(np.frombuffer(b"     " + s, np.uint8), np.array([5 + len(s) - 1]))[0]
    assert after(b"abcabd") > after(b"abd")  # two letters before tell c from d less than five do


def test_no_texts_to_learn_from(docs):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = suffix_tree.scores(docs([(held, "a b")])).collect()[0]
    assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (3, 0, 0, True) and math.isfinite(r.score)
    assert suffix_tree.scores(docs([])).collect() == []


def test_toxicity_on_held_out_rows(spark, docs, wide):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        words = [f"w{rng.randrange(500)}" for _ in range(40)]
        if i % 3 == 0:
            for _ in range(4):
                words[rng.randrange(40)] = rng.choice(["nasty", "NASTY!", "awful", "awfullest", "bad,"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    rows += [(1000, None), (1001, ""), (None, "nasty awful nasty awful"), (1002, "w1 " * 30000), (3, rows[3][1])]
    marks = wide(spark.createDataFrame(labels + [(7, None), (None, 1), (6, 1)], "doc_id bigint, toxic int"))
    got = by_id(toxicity.scores(wide(docs(rows)), marks, params=toxicity.Params(l1=2.0)))
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = dict(labels)
    held = [r for r in got if r.doc_id in truth and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None) and got[0].held_out
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    empty = {r.score for r in got if r.doc_id in (1000, 1001)}
    assert len(empty) == 1


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r.score for r in toxicity.scores(docs([(1, "a")]), none).collect()] == [0.5]
    assert toxicity.scores(docs([]), none).collect() == []


def test_network_gradients_are_right():
    p = language.Params(hidden=3, window=5)
    net, rng = language.Network(2, p), np.random.default_rng(0)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    data, used, y = rng.integers(97, 101, (5, 4)).astype(np.uint8), np.ones((5, 4)), np.array([0, 1, 1, 0])
    used[3:, 2] = 0

    def loss():
        fwd, bwd = net.read("f", data), net.read("b", data[::-1])
        each = [-np.log(net.probabilities(fwd[t], bwd[4 - t])[y, np.arange(4)]) * used[t] for t in range(5)]
        return np.sum(each) / used.sum()

    g = net.gradients(data, used, y)
    for k, v in net.w.items():
        for at in [tuple(rng.integers(0, n) for n in v.shape) for _ in range(4)] + ([(1, 98)] if k[0] == "x" else []):
            old = v[at]
            v[at] = old + 1e-5
            up = loss()
            v[at] = old - 1e-5
            down = loss()
            v[at] = old
            assert abs((up - down) / 2e-5 - g[k][at]) < 1e-4, k


def test_language_on_held_out_rows(docs, wide):
    rng = random.Random(8)
    parts = {"aa": ["the", "ing", "and", "tion"], "bb": ["der", "sch", "keit", "ung"], "cc": ["ñó", "ción", "que", "los"]}
    rows = [(i, " ".join("".join(rng.choice(parts[la]) for _ in range(rng.randrange(1, 4))) for _ in range(30)), la, "s")
            for i in range(240) for la in [list(parts)[i % 3]]]
    rows += [(900, None, "aa", "s"), (901, "", "bb", "s"), (902, "12 34 ...", "cc", "s"), (903, "the ing", None, "s"), (None, "the and", "aa", "s"),
             (904, "ción que " * 20000, "cc", "s"), rows[0]]
    got = by_id(language.predictions(wide(docs(rows)), params=language.Params(steps=80, batch=64)))
    truth = {r[0]: r[2] for r in rows}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {900, 901, 902}
    held = [r for r in got if r.held_out and r.lang_pred != "und" and r.doc_id is not None]
    assert len(held) > 50 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_without_rows_to_learn_from(docs):
    assert [r.lang_pred for r in language.predictions(docs([(1, "abc", None, "s")])).collect()] == ["und"]
    assert language.predictions(docs([])).collect() == []


def test_tree_grows_with_the_input(spark, docs):
    """A context keeps its state however much other text there is, and the distributed tree equals the one of one process."""
    def runs_of(text):
        padded = b"     " + text.encode()
        return collections.Counter(int.from_bytes(padded[i - 5:i + 1], "big") for i in range(5, len(padded)))

    p = suffix_tree.Params()
    rng = random.Random(3)
    codes = runs_of("qxqxz " * 60 + "".join(rng.choice("abcdefgh ") for _ in range(3000)))
    codes[int.from_bytes(b"aaaaaa", "big")] += 50_000_000  # the rare contexts are less than 1e-5 of all positions
    codes[int.from_bytes(b"qxqxqy", "big")] += 0
    table = spark.createDataFrame(list(codes.items()), "code bigint, n bigint")
    got = {r.code: r.q for r in suffix_tree.predicted(table, p).collect()}
    assert got.keys() == codes.keys() and 10 ** got[int.from_bytes(b"qxqxz ", "big")] > 0.8
    tree = suffix_tree.grown(table.where("n > 0"), p)
    for code, q in got.items():
        symbols = np.frombuffer(code.to_bytes(6, "big"), np.uint8)
        assert math.isclose(tree.word_logp(symbols, np.array([5]))[0], q, abs_tol=1e-3), symbols.tobytes()


def test_ftrl_equals_a_plain_loop():
    """The update rule coordinate by coordinate, in plain Python."""
    import math
    import random
    p = toxicity.Params(bits=6, passes=3, l1=0.4, l2=0.7, alpha=0.2, beta=1.5)
    rng, bias = random.Random(8), 1 << 6
    rows = [(np.array(sorted(rng.sample(range(64), 5)) + [bias]), rng.randint(0, 1)) for _ in range(40)]
    z, n = [0.0] * (bias + 1), [0.0] * (bias + 1)

    def weight(i):
        l1 = 0.0 if i == bias else p.l1
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((p.beta + math.sqrt(n[i])) / p.alpha + p.l2)

    order = np.random.Generator(np.random.PCG64(3))
    for _ in range(p.passes):
        for r in order.permutation(len(rows)):
            at, y = rows[r]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i in at:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / p.alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    got = toxicity.fit(iter(rows), p)
    assert np.allclose(got, [weight(i) for i in range(bias + 1)]) and 0 < np.count_nonzero(got) < bias
