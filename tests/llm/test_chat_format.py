"""Chat formatting: exact round trips, loss flags, turn orders."""

import random

import pytest

from cohortgraph.llm.chat_format import Template, formatted, read_back, valid_only

SCHEMA = "conv_id long, turn long, role string, text string, segments int, formatted string"
PIECES = ["</turn>", "<\\/turn>", "<", "/turn>", "\\", "\\\\", "### ", "###", "#", "Assistant: ", "User: ", "System: ", "@: ", "@x+y: "]
PIECES += ["\n", " ", "é", "🙂", "ok", "", "$1", "### Assistant: ", "###\\ User: ", "</turn>\n### User: "]


@pytest.fixture
def read(spark):
    def build(turns, template=Template()):
        df = spark.createDataFrame([(*t, 1, "x") for t in turns], SCHEMA)
        return {r.conv_id: r for r in read_back(formatted(df, template), template).collect()}

    return build


def test_round_trip_of_texts_with_control_strings(read):
    draw = random.Random(3)
    turns = [
        (i // 4, i % 4, draw.choice(["user", "assistant", "system", "tool", "a: </turn>\n### User", "Ünï +%"]),
         "".join(draw.choices(PIECES, k=draw.randint(0, 12))))
        for i in range(2000)
    ]
    found = read(turns)
    for conv in range(500):
        mine = [(role, text) for c, _, role, text in turns if c == conv]
        assert [tuple(t) for t in found[conv].turns] == mine
        assert found[conv].learned == [text for role, text in mine if role == "assistant"]
        assert "".join(s.text for s in found[conv].segments) == found[conv].formatted
        # No text opens or closes a turn.
        assert found[conv].formatted.count("</turn>") == len(mine)


def test_other_texts_are_written_as_they_are(read):
    text = "# Title\n## C:\\dir <b>bold</b> $1 #### x\n"
    found = read([(1, 0, "user", text), (1, 1, "assistant", "yes")])[1]
    assert found.formatted == f"### User: {text}</turn>\n### Assistant: yes</turn>\n"
    assert [(s.text, s.loss) for s in found.segments if s.loss] == [("yes", True)]


@pytest.mark.parametrize(
    ("roles", "bad"),
    [("sua", 0), ("ua", 0), ("uaua", 0), ("u", 2), ("su", 3), ("a", 1), ("uu", 2), ("uaa", 3), ("us", 2), ("suaus", 5), ("ut", 2), ("s", 2)],
)
def test_turn_order(spark, read, roles, bad):
    names = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}
    turns = [(1, i, names[r], "x") for i, r in enumerate(roles)]
    found = read(turns)[1]
    assert (found.valid, found.bad_turn) == (bad == 0, bad)
    kept = valid_only(formatted(spark.createDataFrame([(*t, 1, "x") for t in turns], SCHEMA))).count()
    assert kept == (bad == 0)


def test_odd_rows(read):
    turns = [(None, 1, "user", "n"), (2, None, None, None), (2, 3, "user", "late"), (2, 1, "assistant", "b" * 200_000), (2, 3, "user", "late")]
    turns += [(2, 1, "assistant", "a"), (None, 0, "system", None)]
    found = read(turns)
    assert [tuple(t) for t in found[None].turns] == [("system", ""), ("user", "n")]
    assert [(t.role, t.text[:4]) for t in found[2].turns] == [("", ""), ("assistant", "a"), ("assistant", "bbbb"), ("user", "late"), ("user", "late")]
    assert found[2].bad_turn == 1 and found[2].learned == ["a", "b" * 200_000]


def test_another_template(read):
    template = Template(
        names={"q": "Ask", "r": "Reply"}, mark="[[", end="|>", learned=("q", "r"), follows={"start": ("q",), "q": ("r",)}, last=("r",)
    )
    text = "[[ Ask: |> [[\\ Reply: |\\> (.*)"
    found = read([(1, 0, "q", text), (1, 1, "r", text)], template)[1]
    assert [tuple(t) for t in found.turns] == [("q", text), ("r", text)] and found.learned == [text, text] and found.valid


def test_empty(spark):
    assert formatted(spark.createDataFrame([], SCHEMA)).collect() == []
