import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from pricegrid.llm import chat

TEXT = st.text(alphabet="a<|\\>im_startend\n é", max_size=40)


@given(TEXT)
def test_escape_is_reversible_and_leaves_no_mark(text):
    out = chat.escape(text)
    assert "<|" not in out and chat.unescape(out) == text


@given(TEXT)
def test_roles_stay_on_their_line(role):
    out = chat.escape_role(role)
    assert "\n" not in out and "<|" not in out and chat.unescape_role(out) == role


ROWS = [
    (1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", "a<|im_start|>b"),
    (2, 5, None, None), (2, 5, "assistant", "x"), (2, None, "user", "first"),
    (3, 0, "assistant", "é" * 50_000), (None, 0, "user", ""),
    (4, 0, "odd\nrole", "t"), (4, 0, "odd\nrole", "t"),
]


def expected(turns):
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or ""))
    turns = [(r or "", t or "") for _, r, t in turns]
    loss = "".join(t for r, t in turns if r == "assistant")
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(whole), len(loss), sha(loss)


@pytest.mark.parametrize("in_order", [True, False])
def test_round_trip(spark, in_order):
    shape = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(ROWS, shape).selectExpr("*", "'x' AS loss", "1 AS seg_no")
    segments = chat.format_conversations(df)
    if not in_order:
        segments = spark.createDataFrame(segments.collect(), chat.SEGMENTS).orderBy("text")
    got = {r.conv_id: r for r in chat.read_back(segments, in_order=in_order).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv, r in got.items():
        want = expected([x[1:] for x in ROWS if x[0] == conv])
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want
    assert got[1].valid and not got[2].valid and not got[3].valid


def test_loss_is_on_assistant_texts_only(spark):
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")], "conv_id long, turn long, role string, text string")
    rows = chat.format_conversations(df).orderBy("seg_no").collect()
    assert "".join(r.text for r in rows) == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    assert [r.text for r in rows if r.loss] == ["a"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(df)).count() == 0


def test_broken_frame_is_an_error(spark):
    bad = spark.createDataFrame([(1, 0, 0, "<|im_start|>user\nno end", False, True)], chat.SEGMENTS)
    with pytest.raises(Exception, match="no end"):
        chat.read_back(bad).collect()


def test_template_has_to_be_separable():
    with pytest.raises(ValueError):
        chat.Template(start="[", end="]")


def test_order_of_turns_decides_validity(spark):
    orders = {
        1: "system user assistant", 2: "user assistant user assistant", 3: "user assistant user",
        4: "assistant user", 5: "user user assistant", 6: "user system assistant", 7: "system", 8: "user assistant tool assistant",
    }
    rows = [(c, k, role, "t") for c, o in orders.items() for k, role in enumerate(o.split())]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    segments = chat.format_conversations(df)
    assert {r.conv_id for r in chat.read_back(segments, in_order=True).collect() if r.valid} == {1, 2}
    bad = {r.conv_id for r in segments.where("not order_ok").collect()}
    assert bad == {4, 5, 6, 8}
