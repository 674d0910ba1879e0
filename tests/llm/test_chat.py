import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from chronolode.llm import chat

SCHEMA = "conv_id long, turn int, role string, text string"
TRICKY = st.text(alphabet="\\#</turn>: ab\n", max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TRICKY, TRICKY), max_size=4))
def test_any_text_comes_back(turns):
    assert chat.read_turns("".join(chat.format_turn(r, t)[0] for r, t in turns)) == turns


@settings(max_examples=200, deadline=None)
@given(TRICKY, TRICKY)
def test_mask_is_the_text(role, text):
    formatted, begin, end = chat.format_turn(role, text)
    assert chat.unescape(formatted[begin:end]) == text


def expected(rows):
    """Digests by conversation, straight from the rows."""
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        said = [t for r, t in turns if r == "assistant"]
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out[conv] = (len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), sum(map(len, said)), digest("".join(said)), len(said))
    return out


def test_read_back_equals_rows(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART", 4)  # several parts in a conversation
    own = r"\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", own), (-7, 1, "assistant", own), (1, 0, "user", "only asked"), (2, 0, "assistant", None), (2, 1, None, "x")]
    rows += [(3, i, ["system", "user", "assistant"][i % 3], f"t{i} ") for i in range(23)]
    rows += [(4, 0, "user", "same"), (4, 0, "user", "same"), (4, 9, "assistant", "a"), (4, 9, "assistant", "a")]
    rows += [(None, None, "assistant", "no ids"), (None, 2, "user", "ß" * 5000), (5, None, "user", ""), (5, 3, "assistant", "after null")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "2 AS total", "'x' AS parts")
    examples = chat.prefix_target_examples(df).collect()
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.n_examples) for r in chat.read_back(chat.prefix_target_examples(df)).collect()}
    assert found == expected(rows)
    third = sorted((r for r in examples if r.conv_id == 3), key=lambda r: r.example)
    assert [r.target_turn for r in third] == [*range(2, 23, 3), None]
    for r in third[:-1]:
        turns = chat.read_turns(r.text)
        assert turns[-1] == ("assistant", f"t{r.target_turn} ") and len(turns) == r.target_turn + 1
        assert chat.unescape(r.text[r.loss_start : r.loss_end]) == f"t{r.target_turn} "


def test_empty(spark):
    assert chat.read_back(chat.prefix_target_examples(spark.createDataFrame([], SCHEMA))).collect() == []
