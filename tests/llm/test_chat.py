import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyfold.llm import chat

PIECES = st.lists(st.sampled_from([*chat.TEMPLATE.controls, "\\", "\\\\", " ", "x", "<", "[", "/", "\n", "é", "s>"]), max_size=10).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(["user", "assistant", "system", "tool", "", "[INST]"]), PIECES, st.booleans())
def test_every_turn_is_read_back(role, text, first):
    pattern = chat.escaper(chat.TEMPLATE)
    whole = "".join(s["text"] for s in chat.segments(role, text, first, chat.TEMPLATE, pattern))
    name, mark, body = chat.reader(chat.TEMPLATE).fullmatch(whole).groups()
    known = {t.open: r for r, t in chat.TEMPLATE.turns.items()}
    assert (known.get(mark, chat.unescape(name or "")), chat.unescape(body)) == (role, text)


def test_conversations(spark):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "assistant", "x"), (3, 0, "user", None), (3, 1, None, "y"),
        (None, 0, "user", "z"), (4, 0, "user", "q"), (4, 0, "assistant", "same turn"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS position", "2 AS valid")
    out = {r.conv_id: r for r in chat.read_back(chat.format_turns(df)).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert out[1].turns_sha256 == digest("user\na\nassistant\nb\n") and out[1].valid and out[1].loss_sha256 == digest("b")
    assert not out[2].valid and out[2].loss_chars == 1
    assert out[3].turns_sha256 == digest("user\n\n\ny\n") and not out[3].valid
    assert out[4].turns_sha256 == digest("assistant\nsame turn\nuser\nq\n")
    assert out[None].n_turns == 1 and len(out) == 5
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_query_against_the_table(spark, sf_dir):
    from tallyfold.llm.queries import QUERIES

    turns = {}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    turns[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    rows = QUERIES["op8_chat_format"](spark, sf_dir).collect()
    assert len(rows) == len(turns)
    for r in rows:
        said = "".join(t for role, t in turns[r.conv_id] if role == "assistant")
        text = "".join(f"{role}\n{t}\n" for role, t in turns[r.conv_id])
        assert r.turns_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.n_turns == len(turns[r.conv_id])
        assert (r.loss_chars, r.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert r.formatted_chars > len(text) - 2 * r.n_turns
