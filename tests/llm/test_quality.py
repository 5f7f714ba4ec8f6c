import random
import re

from millrace.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    places = {}
    for i in range(len(w) - 4):
        places.setdefault(tuple(w[i:i + 5]), []).append(i)
    repeated = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))


def test_statistics_equal_brute_force(docs, wide):
    rng = random.Random(2)
    rows = ["", None, " \t\n", "a b c d", "a b c d e a b c d e", "a " * 20000, "x\n\nx\n \nx", "a b é# <|>", "\U0001F600 " * 30, "a b c d e f " * 3,
            "\x0ba\x0c b\r\nb\r\n"]
    rows += [" ".join(rng.choice("abc\n") for _ in range(rng.randrange(40))) for _ in range(60)]
    rows = list(enumerate(rows)) + [(None, "no id"), (3, "a b c d")]
    got = quality.statistics(wide(docs(rows))).collect()
    assert sorted((str(r.c_doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted(
        (str(i), *brute(t)) for i, t in rows)


def corpus():
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        words = [f"{rng.choice('abcdefgh')}{rng.randrange(300)}" for _ in range(60)]
        bad = i % 4
        text = " ".join(words) + "."
        if bad == 0:
            text = " ".join(w + rng.choice(["***", "$$$"]) for w in words)
        elif bad == 1:
            text = text.upper() + "!!" if i % 8 == 1 else text
        rows.append((i, text))
        labels.append((i, 0 if bad == 0 or i % 8 == 1 else 1))
    return rows, labels


def test_rules_are_learned_and_hold_on_other_rows(spark, docs):
    rows, labels = corpus()
    half = spark.createDataFrame([x for x in labels if x[0] < 240] + [(5, None), (None, 0), (9999, 0)], "doc_id bigint, quality int")
    stats = quality.statistics(docs(rows))
    rules = quality.learn(stats, half)
    assert rules
    truth = dict(labels)
    judged = stats.select("c_doc_id", quality.rejects(rules).isNull().alias("ok")).collect()
    assert all(r.ok == bool(truth[r.c_doc_id]) for r in judged)


def test_filter_keeps_clean_rows_whole(spark, docs, wide):
    rows, labels = corpus()
    extra = [(1000, None), (1001, ""), (1002, "too short")]
    out = quality.kept(wide(docs(rows + extra + [rows[2]])), spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert out.columns == wide(docs([])).columns
    assert sorted(r.doc_id for r in out.collect()) == sorted([i for i, q in labels if q] + [2])


def test_no_labels_and_no_documents(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.learn(quality.statistics(docs([(1, "a b")])), none) == []
    assert [r.doc_id for r in quality.kept(docs([(1, "a b c d e f g h i j k"), (2, "a")]), none).collect()] == [1]
    assert quality.kept(docs([]), none).collect() == []
