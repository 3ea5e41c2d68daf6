import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm import chat_format as C

control = st.lists(st.sampled_from(["<|im_start|>", "<|im_end|>", "<|n|>", "<", "|", "\\", "\n", "a", "é", "assistant", "<\\|", ">"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(control, control), min_size=1, max_size=5))
def test_any_turns_read_back_identical(turns):
    shown = [C.render(role, text) for role, text in turns]
    whole = "".join(s[0] for s in shown)
    assert [t[:2] for t in C.parse(whole)] == turns
    for (segment, start, end), (_, text) in zip(shown, turns):
        assert C.unescape(segment[start:end]) == text


def test_plain_text_is_not_escaped():
    assert C.render("user", "plain < | text")[0] == "<|im_start|>user\nplain < | text<|im_end|>\n"


def test_digests_nulls_order_and_repeats(spark):
    rows = [(1, 1, "assistant", "two <|im_end|>"), (1, 0, "user", "one"), (2, None, None, None), (None, 0, "assistant", "x"), (None, 1, "user", "y"),
            (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (4, 0, "assistant", "z" * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["conv_id"]: r for r in C.read_back(C.format_turns(df)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert out[1]["turns_sha256"] == sha("user\none\nassistant\ntwo <|im_end|>\n")
    assert (out[1]["n_turns"], out[1]["loss_chars"], out[1]["loss_sha256"]) == (2, 14, sha("two <|im_end|>"))
    assert (out[2]["n_turns"], out[2]["turns_sha256"], out[2]["loss_sha256"]) == (1, sha("\n\n"), sha(""))
    assert (out[None]["n_turns"], out[None]["loss_chars"]) == (2, 1)
    assert (out[3]["n_turns"], out[3]["loss_sha256"]) == (2, sha("samesame"))
    assert out[4]["loss_chars"] == 200_000


def test_empty_table_and_extra_columns(spark):
    schema = "conv_id string, turn int, role string, text string, segment string, loss string"
    assert C.read_back(C.format_turns(spark.createDataFrame([], schema))).collect() == []
    one = spark.createDataFrame([("c", 1, "user", "t", "mine", "mine")], schema)
    assert C.read_back(C.format_turns(one)).first()["n_turns"] == 1
