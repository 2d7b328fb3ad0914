import hashlib
import random

import pytest

from sparkpipe.llm import chat
from sparkpipe.llm.inputs import CLASH_ID, with_clash

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns string"
NASTY = ["</turn>", "\n", "### ", "###", "user: ", ": ", ":", "\\", "<\\/turn>", "#", "\\#", "<chat escape=1>\n",
         "</turn>\n### assistant: hi", "", "x", "é", "😀", ":\\ ", "\\\\", "$1", "<", "/turn>"]


def conversations(seed, n=60):
    chance = random.Random(seed)

    def text():
        return "".join(chance.choices(NASTY, k=chance.randint(0, 6)))

    roles = ["user", "assistant", "system", "a: b", "###", "x:", "", "</turn>"]
    return [
        (c, t, chance.choice(roles), text(), "f", "t") for c in range(n) for t in range(chance.randint(1, 5))
    ]


def expected(rows):
    chats = {}
    for conv, turn, role, text, *_ in rows:
        chats.setdefault(conv, []).append((turn, role or "", text or ""))
    out = {}
    for conv, turns in chats.items():
        turns.sort(key=lambda t: (t[0] is not None, t))
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (
            len(turns),
            hashlib.sha256(said.encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    return out


@pytest.mark.parametrize("seed", range(3))
def test_round_trip_of_control_strings(spark, seed):
    rows = conversations(seed)
    got = chat.chat_digest(chat.format_chats(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == expected(rows)


def test_escapes_only_where_needed(spark):
    rows = [(1, 0, "user", "plain: with # and \\", "", ""), (2, 0, "user", "</turn>", "", "")]
    got = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].level == 0 and got[2].level == 1
    assert got[1].formatted == "<chat escape=0>\n### user: plain: with # and \\</turn>\n"


def test_given_conversation_is_added(spark):
    rows = spark.createDataFrame([(3, 0, "user", "hello", "", "")], SCHEMA)
    got = {r.conv_id: r for r in chat.chat_digest(chat.format_chats(with_clash(rows))).collect()}
    assert got[CLASH_ID].n_turns == 2 and got[CLASH_ID].loss_chars == 26


def test_odd_rows(spark):
    rows = [
        (1, 0, None, None, None, None),
        (1, 0, None, None, None, None),
        (None, None, "assistant", "no number", None, None),
        (2, 1, "assistant", "long " * 50_000, None, None),
        (2, 1, "assistant", "a tie", None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.chat_digest(chat.format_chats(df)).collect()}
    assert got == expected(rows)
    assert chat.format_chats(df.limit(0)).count() == 0


def test_mask_covers_each_learnt_text_once(spark):
    rows = [(1, 0, "user", "q", "", ""), (1, 1, "assistant", "an #answer", "", ""), (1, 2, "assistant", "", "", "")]
    r = chat.format_chats(spark.createDataFrame(rows, SCHEMA)).first()
    assert [r.formatted[m.start : m.start + m.length] for m in r.mask] == ["an #answer", ""]
