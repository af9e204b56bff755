import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from tidewatch.llm import chat

T = chat.Template()
PIECES = st.lists(st.sampled_from([*T.control, "\\", "<", "[", "|", "im_end|>", "s>", "INST]", " ", "\n", "a", "é😀"]), max_size=12).map("".join)


@settings(max_examples=500, deadline=None)
@given(PIECES)
def test_escape_is_reversible_and_complete(text):
    hidden = T.escape(text)
    assert T.unescape(hidden) == text and not any(c in hidden for c in T.control)
    head = T.head(text)
    name = head[len(T.open):-1]
    assert "\n" not in name and T.role(name) == text


def test_overlapping_controls_are_refused():
    for control in (("<a>", "<a>b"), ("ab", "bc"), ("x",), ("a\\b",)):
        with pytest.raises(ValueError):
            chat.Template(control=control)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", True) for r in rows], "conv_id long, turn long, role string, text string, conv string, loss boolean")
    segments = chat.format_segments(df, T)
    return segments, {r.conv: r for r in chat.read_back(segments, T).collect()}


def test_read_back_and_loss(spark):
    rows = [(1, 1, "assistant", "b</s>"), (1, 0, "user", "a[INST]"), (1, 2, "user", None), (2, 0, "system", ""), (2, 1, "user", "q"),
            (2, 2, "assistant", "é😀"), (None, 0, "user", "x"), (None, 0, None, None)]
    segments, found = run(spark, rows)
    one = found["1"]
    assert (one.n_turns, one.loss_chars, one.valid) == (3, 5, True)
    assert one.turns_sha256 == hashlib.sha256("user\na[INST]\nassistant\nb</s>\nuser\n\n".encode()).hexdigest()
    assert one.loss_sha256 == hashlib.sha256(b"b</s>").hexdigest()
    assert found["2"].loss_sha256 == hashlib.sha256("é😀".encode()).hexdigest()
    assert found[None].n_turns == 2 and found[None].loss_sha256 == hashlib.sha256(b"").hexdigest()
    whole = {r.conv: r for r in chat.formatted(segments).collect()}
    assert len(whole["1"].text) == one.formatted_chars
    assert [whole["1"].text[s.start:s.end] for s in whole["1"].loss_spans] == [T.escape("b</s>")]


@pytest.mark.parametrize("roles,bad", [
    ("system user assistant user", None), ("user assistant tool assistant", None), ("assistant user", 0), ("user user", 1),
    ("user system assistant", 1), ("user assistant nobody user", 2), ("system", None)])
def test_turn_order(spark, roles, bad):
    _, found = run(spark, [(1, i, r, "t") for i, r in enumerate(roles.split())])
    assert found["1"].first_bad_turn == bad and found["1"].valid == (bad is None) and found["1"].n_turns == len(roles.split())


def test_long_conversation_and_empty_table(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(30_000)] + [(2, 0, "user", "y" * 2_000_000)]
    _, found = run(spark, rows)
    assert found["1"].n_turns == 30_000 and found["1"].valid
    body = "".join(f"{r}\n{t}\n" for _, _, r, t in rows[:-1])
    assert found["1"].turns_sha256 == hashlib.sha256(body.encode()).hexdigest()
    assert found["2"].formatted_chars == 2_000_000 + len(T.head("user")) + len(T.close)
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_segments(df, T), T).count() == 0
