import random
import re
import time

from millrace.llm import private
from tests.llm.conftest import by_id

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")) or kind == "phone" and 8 <= len(digits) <= 15
                    or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)):
                out.append((kind, *m.span()))
    return out


def texts():
    rng = random.Random(4)
    rows = ["", None, "a@b", "a@b.c d@e.f.g-h. x@y..z", "a@b.c_d@e.f", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.0255 99999999999999999999.1.1.1",
            "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 5", "+1 (017) 555-7713. +12 +1234567 +123456789012345 +1234567890123456",
            "\U0001F600é +49 30 1234567 \U0001F600 a@b.cd", "1 " * 9000, "9" * 20000, "x" * 30000 + "@", "@" * 200, "+1" + "(" * 3000,
            "a@b" + ".c" * 9000]
    for _ in range(150):
        rows.append("".join(rng.choice(["a", "@", ".", "1", "23", "4111111111111111", " ", "-", "+", "+1 ", "(", ")", "é", "\n", "255", "_"]) for _ in range(rng.randrange(60))))
    return list(enumerate(rows))


def test_base_spans_equal_brute_force(docs, wide):
    rows = texts()
    got = by_id(private.personal_data(wide(docs(rows + [(None, "a@b.c"), (0, "")]))))
    want = sorted([(i, base(t)) for i, t in rows] + [(None, base("a@b.c")), (0, [])], key=lambda x: (x[0] is not None, x[0]))
    for r, (i, spans) in zip(got, want, strict=True):
        assert (r.doc_id, [(s.kind, s.start, s.end) for s in r.spans if s.kind != "other"]) == (i, spans)


def test_patterns_find_identifiers_that_no_fixed_pattern_has(docs):
    known = [(i, f"word filler my address is user{i}@mail.example.com thanks filler{i}") for i in range(12)]
    new = [(100, "some text my address is user55(at)mail thanks more"), (101, "unrelated number 12345 stays here")]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in private.personal_data(docs(known + new)).collect()}
    start = new[0][1].index("user55")
    assert got[100] == [("other", start, start + len("user55(at)mail"))]
    assert got[101] == [] and all(len(got[i]) == 1 for i in range(12))


def test_keys_in_a_shared_context_are_found(docs):
    """Tokens shaped like keys believe in a context, which then finds a plainer one; a lone one is no span."""
    import hashlib
    keys = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(30)]
    rows = [(i, f'filler{i} some words token = "{k}" then more{i}') for i, k in enumerate(keys)]
    rows += [(100, 'others say token = "correct-horse-7" instead'), (101, f"only once beside {keys[0][::-1]} nothing"), (102, "page 12 of 345678901234567890123456")]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in private.personal_data(docs(rows)).collect()}
    for i, text in rows[:30]:
        assert got[i] == [("other", text.index(keys[i]), text.index(keys[i]) + 40)]
    assert got[100] == [("other", rows[30][1].index("correct"), rows[30][1].index("correct") + len("correct-horse-7"))]
    assert got[101] == got[102] == []


def test_very_long_runs_of_digits_take_seconds(docs):
    rows = [(1, "7" * 1_000_000 + " 1.2.3.4"), (2, "1." * 20_000 + "9" * 200_000 + ".1.2.3 x@y.zz")]
    began = time.time()
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in private.personal_data(docs(rows)).collect()}
    assert time.time() - began < 60
    assert got[1] == [("ip", 1_000_001, 1_000_008)]
    # four parts each, the last ones before the long run
    assert len(got[2]) == 5_001 and got[2][0] == ("email", 240_007, 240_013) and got[2][1] == ("ip", 0, 7)


def test_redaction_keeps_all_else(docs, wide):
    rows = [(1, "a \U0001F600 x@y.zz b 1.2.3.4"), (2, "nothing"), (3, None), (None, "+1 234 567 8901"), (1, "a \U0001F600 x@y.zz b 1.2.3.4")]
    out = private.redacted(wide(docs(rows)))
    assert out.columns == wide(docs([])).columns
    assert [(r.doc_id, r.text) for r in by_id(out)] == [(None, "[PHONE]"), (1, "a \U0001F600 [EMAIL] b [IP]"), (1, "a \U0001F600 [EMAIL] b [IP]"),
                                                       (2, "nothing"), (3, None)]


def test_no_documents(docs):
    assert private.personal_data(docs([])).collect() == [] and private.redacted(docs([])).collect() == []
