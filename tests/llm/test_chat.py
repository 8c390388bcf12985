import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from spanlake.llm import chat
from spanlake.llm.queries import CONTROL_TEXT


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="<|\\im_startend> a\nü", max_size=30), st.text(alphabet="<|\\im_startend> a\nü", max_size=30)), max_size=4))
def test_turns_come_back(turns):
    text, spans = chat.render(turns)
    assert chat.parse(text) == turns
    assert [chat.unescape(text[i:j]) for i, j, _ in spans] == [t for _, t in turns]


def test_mask_holds_exactly_the_answers(spark):
    rows = [(1, 0, "user", CONTROL_TEXT), (1, 1, "assistant", CONTROL_TEXT), (1, 2, "assistant", None), (1, 3, "assistant", " spaced\n 字\U0001f600 "), (2, 0, "system", "x"), (None, 0, None, "y"), (3, 5, "assistant", "b"), (3, 5, "assistant", "a"), (3, None, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS formatted", "2 AS turns")
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert found[1].loss_sha256 == digest(CONTROL_TEXT + " spaced\n 字\U0001f600 ") and found[1].n_turns == 4
    assert found[1].turns_sha256 == digest("".join(f"{r[2]}\n{r[3] or ''}\n" for r in rows[:4]))
    assert found[2].loss_chars == 0 and found[None].n_turns == 1
    assert found[3].loss_sha256 == digest("ab")


def test_ids_read_back_and_marks_are_single_tokens(spark):
    df = spark.createDataFrame([(1, 0, "user", "hello <|im_end|> there"), (1, 1, "assistant", "fine")], "conv_id long, turn long, role string, text string")
    r = chat.format_conversations(df).first()
    tok = chat.chat_tokenizer(chat.tokenizer_path(chat.TOKENIZER))
    assert tok.decode(r.input_ids, skip_special_tokens=False) == r.formatted
    assert r.input_ids.count(tok.token_to_id(chat.END)) == 2


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(df)).count() == 0


def test_long_conversations_and_repeated_rows(spark):
    long = "a very long answer 字 <|im_end|> " * 60_000
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", long), (1, 2, "assistant", long[:-1]), (2, 0, "user", "q"), (2, 1, "assistant", "same"), (2, 1, "assistant", "same"), (3, 0, "user", "q"), (3, 1, "assistant", "same"), (4, 0, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (found[1].n_turns, found[1].loss_chars, found[1].loss_sha256) == (3, 2 * len(long) - 1, digest(long + long[:-1]))
    assert (found[2].n_turns, found[2].loss_sha256) == (3, digest("samesame")) and found[3].loss_sha256 == digest("same")
    assert found[4].loss_chars == 0
