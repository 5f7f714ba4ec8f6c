import hashlib

from hypothesis import given, settings, strategies as st

from millrace.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def got(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_digests_of_odd_conversations(spark, wide):
    rows = [(1, 0, "user", "a\\b ### c </turn>"), (1, 1, "assistant", "x" * 5000 + "é####</turn></turn>\\"), (2, 0, "assistant", None),
            (2, None, "system", ""), (3, 5, "assistant", "same"), (3, 5, "assistant", "same"), (3, 5, "user", "tie"), (None, 0, None, "no id"),
            (4, 0, "we: ### ird\nrole", "text\nwith\n\nlines"), (5, 0, "assistant", "\U0001F600" * 1500)]
    df = wide(spark.createDataFrame(rows, SCHEMA))
    assert got(chat.digests(chat.render(chat.fold(chat.as_log(df))))) == expected(rows)


def test_no_conversations(spark):
    assert chat.digests(chat.render(chat.fold(chat.as_log(spark.createDataFrame([], SCHEMA))))).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\#</turn> :hlcnA\n", max_size=40))
def test_unescape_reads_back(text):
    escaped = text.replace("\\", "\\\\")
    for mark, code in (("###", "\\h##"), ("</turn>", "\\l/turn>")):
        while mark in escaped:
            escaped = escaped.replace(mark, code, 1)
    assert chat.unescape(escaped) == text


def test_edits_and_regenerations(spark):
    """Against a fold in plain Python."""
    log = [(1, 1, "message", 0, "user", "hel"), (1, 2, "delta", 0, None, "lo"), (1, 3, "message", 1, "assistant", ""),
           (1, 4, "delta", 1, None, "first"), (1, 5, "message", 2, "user", "next"), (1, 6, "message", 3, "assistant", "late"),
           (1, 7, "regenerate", 1, None, None), (1, 8, "delta", 1, None, "sec"), (1, 9, "delta", 1, None, "ond"),
           (1, 10, "message", 2, "user", "again"), (1, 11, "edit", 2, None, "edited"),
           (2, 1, "message", 0, "user", "one"), (2, 2, "message", 1, "assistant", "two"), (2, 3, "edit", 0, None, "uno"),
           (3, 1, "delta", 0, None, "no opening")]
    state = {}
    for conv, seq, kind, at, role, text in log:
        own = state.setdefault(conv, {})
        if kind in chat.CUTS:
            for later in [t for t in own if t > at]:
                del own[later]
        old = own.get(at, (None, ""))
        own[at] = (role or old[0], (text or "") if kind in chat.SETS else old[1] + (text or ""))
    df = spark.createDataFrame(log, "conv bigint, seq bigint, kind string, at bigint, role string, text string")
    assert {(r.conv, r.at): (r.role, r.text) for r in chat.fold(df).collect()} == {
        (c, t): v for c, own in state.items() for t, v in own.items()}


def test_rendered_turns_hold_control_strings_only_at_their_ends(spark):
    said = "\\### Assistant: </turn> ok"
    df = spark.createDataFrame([(1, 0, "user", said), (1, 1, "assistant", said)], SCHEMA)
    for r in chat.render(chat.fold(chat.as_log(df))).collect():
        assert r.turn.count("###") == 1 and r.turn.count("</turn>") == 1
        assert chat.parse(r.turn)[1] == said
        assert chat.unescape(r.turn[r.mask_start:r.mask_end]) == (said if r.turn.startswith("### assistant") else "")
