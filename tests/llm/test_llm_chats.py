import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from prosewell.llm import chat_events as ce
from prosewell.llm.chat_queries import conversation_log
from prosewell.sources.store import fresh_path

TEXT = st.lists(
    st.sampled_from([*ce.CONTROL, "\\", "<", "[", "/", " ", "a", "INST]", "s>", "\n", "é"]), max_size=12
).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.sampled_from([*ce.MARKS, "", "tool"]) | TEXT, TEXT)
def test_render_is_reversible(role, text):
    formatted, start, end = ce.render(role, text)
    assert ce.parse(formatted) == (role, text)
    assert ce.unescape(formatted[start:end]) == text
    assert not any(c in ce.escape(text) for c in ce.CONTROL)


def folded(*events):
    return [(role, text) for _, role, text in ce.fold((1, *e) for e in events)]


def test_fold():
    assert folded(
        (0, "open", "assistant", None), (1, "delta", None, "a"), (2, "delta", None, "b")
    ) == [("assistant", "ab")]
    assert folded((0, "open", "user", "draft"), (1, "edit", None, "x"), (2, "delta", None, "y")) == [("user", "xy")]
    assert folded(
        (0, "open", "assistant", None), (1, "delta", None, "a"), (2, "regenerate", None, "never"), (3, "delta", None, "z")
    ) == [("assistant", "z")]
    twice = (1, "delta", None, "a")
    assert folded((0, "open", "user", None), twice, twice) == [("user", "a")]
    assert folded((None, "delta", None, "a"), (None, "delta", None, "a")) == [("", "aa")]
    assert folded((0, None, None, None)) == [("", "")]


LOG = "conv_id long, turn long, copy int, seq long, kind string, role string, text string, size int"


def chats(spark, log):
    path = fresh_path(spark, "chats")
    ce.format_chats(log).write.parquet(path)
    return {r.conv_id: r for r in ce.read_chats(spark, path).collect()}


def test_odd_logs(spark):
    rows = [
        (1, 0, 1, 0, "open", "user", None, 5),
        (1, 0, 1, 1, "delta", None, "hi", 5),
        (1, 0, 1, 1, "delta", None, "hi", 5),
        (1, 1, 1, 0, "open", "assistant", None, 5),
        (1, 1, 1, 2, "delta", None, "</s>", 5),
        (1, 1, 1, 1, "delta", None, "x", 5),
        (None, None, None, None, None, None, None, None),
    ]
    found = chats(spark, spark.createDataFrame(rows, LOG))
    assert set(found) == {1, None}
    turns = hashlib.sha256(b"user\nhi\nassistant\nx</s>\n").hexdigest()
    assert (found[1].n_turns, found[1].turns_sha256, found[1].loss_chars) == (2, turns, 5)
    assert found[1].loss_sha256 == hashlib.sha256(b"x</s>").hexdigest()
    assert (found[None].n_turns, found[None].loss_chars) == (1, 0)
    assert chats(spark, spark.createDataFrame([], LOG)) == {}


def test_log_gives_the_turns_back(spark):
    long = "0123456789" * 350
    rows = [(1, 0, "user", long), (1, 1, "assistant", long + "é"), (1, 1, "assistant", None), (2, None, None, "a"), (2, None, None, "a")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chats(spark, conversation_log(turns))
    want = f"user\n{long}\nassistant\n\nassistant\n{long}é\n"
    assert found[1].turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert found[1].loss_chars == 3501
    assert found[2].n_turns == 2 and found[2].turns_sha256 == hashlib.sha256(b"\na\n\na\n").hexdigest()
