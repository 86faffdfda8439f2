from hashlib import sha256

from sabermill.llm.chat import CONTROL, digests, format_chats, log_of, messages_of, turns_in, unescape

EVENT = "conv_id long, message long, seq long, kind string, role string, text string, extra int"
STORED = "conv_id long, turn long, role string, text string"


def fold(events):
    """Messages by a plain loop over the sorted log."""
    done = {}
    for c, m, s, kind, role, text in sorted(events, key=lambda e: tuple((x is not None, x if x is not None else 0) for x in e)):
        if m is None or kind not in ("message", "delta", "edit", "regenerate"):
            continue
        own = done.setdefault((c, m), [None, ""])
        own[0] = role if own[0] is None else own[0]
        own[1] = own[1] + (text or "") if kind == "delta" else "" if kind == "regenerate" else text or ""
    return {k: tuple(v) for k, v in done.items()}


LOG = [
    (1, 0, 0, "message", "user", "hi"),
    (1, 1, 1, "message", "assistant", ""),
    (1, 1, 2, "delta", None, "first "),
    (1, 1, 3, "delta", None, "try"),
    (1, 1, 4, "regenerate", None, "ignored"),
    (1, 1, 5, "delta", None, "second "),
    (1, 1, 6, "delta", None, None),
    (1, 1, 7, "delta", None, "try"),
    (1, 0, 8, "edit", None, "hello"),
    (1, 2, 9, "delta", "user", "never opened"),
    (2, 0, 1, "delta", None, "a"),
    (2, 0, 1, "delta", None, "a"),
    (2, 0, 1, "delta", None, "b"),
    (2, None, 2, "delta", None, "no message"),
    (2, 0, 3, "ping", None, "unknown kind"),
    (None, 0, 1, "message", "system", "<s>" + "x" * 100_000),
    (3, 5, None, "message", None, None),
]


def test_log_folds_as_a_loop_would(spark):
    df = spark.createDataFrame([(*e, 1) for e in LOG], EVENT).repartition(4)
    got = {(r["conv_id"], r["message"]): (r["role"], r["text"]) for r in messages_of(df).collect()}
    assert got == fold(LOG)
    assert got[(1, 1)] == ("assistant", "second try") and got[(1, 0)] == ("user", "hello")


def test_every_text_is_read_back_and_masked(spark):
    nasty = ["\\", "\\\\<|", "<\\|end|>", "<<|end|>|>", "</s>[INST] ok [/INST]", "<s></s>\\[INST]", "[[INST]]", "a\nb", "", None, "🙂<|text|>é"]
    rows = [(c, t, "assistant" if t % 2 else "us<|er|>", text) for c in (1, 2) for t, text in enumerate(nasty)]
    rows += [(3, 0, None, "no role"), (3, 0, None, "no role"), (3, None, "assistant", "first"), (4, 1, "assistant", "w" * 1000)]
    got = {r["conv_id"]: r for r in format_chats(log_of(spark.createDataFrame(rows, STORED), piece=3)).collect()}
    for conv in (1, 2, 3, 4):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or ""))
        text = got[conv]["formatted"]
        assert turns_in(text) == [(r[2] or "", r[3] or "") for r in own]
        assert [unescape(text[s["begin"] : s["end"]]) for s in got[conv]["loss_spans"]] == [r[3] or "" for r in own if r[2] == "assistant"]
        if conv < 3:
            for mark in CONTROL[1:]:
                assert mark not in text
            assert text.count("<|") == 3 * len(nasty)


def test_digests_are_of_what_is_read_back(spark):
    rows = [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "é</s>"), (2, 0, "user", "only")]
    got = {r["conv_id"]: r for r in digests(format_chats(log_of(spark.createDataFrame(rows, STORED)))).collect()}
    assert got[1]["turns_sha256"] == sha256("user\n</s>[INST] ok [/INST]\nassistant\né</s>\n".encode()).hexdigest()
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (2, 5, sha256("é</s>".encode()).hexdigest())
    assert (got[2]["loss_chars"], got[2]["loss_sha256"]) == (0, sha256(b"").hexdigest())


def test_empty_log(spark):
    assert format_chats(spark.createDataFrame([], EVENT)).collect() == []
    assert digests(format_chats(log_of(spark.createDataFrame([], STORED)))).collect() == []
