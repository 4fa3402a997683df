from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import chat

PARTS = st.lists(st.sampled_from(["<", "|", "\\", "<|", "<|im_end|>", "a", "é", "\n", "n", " "]), max_size=12).map("".join)


@given(PARTS)
@settings(max_examples=300, deadline=None)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)
    assert chat._role_of(chat._role_line(text)) == text and chat._role_line(text).count("\n") == 1


SCHEMA = "conv_id long, turn long, role string, text string, ids int, mask string"
ROWS = [
    (1, 2, "assistant", chat.TRICK), (1, 0, "system", None), (1, 1, "user", "Hi <\\|there|>\n"), (2, 0, "assistant", ""),
    (None, 1, None, "lost"), (None, None, "user", "first"), (3, 0, "user", "same"), (3, 0, "user", "same"),
    (4, 0, "assistant", "x" * 50000 + " 😀 " + "word " * 5000), (4, 1, "role\nwith line", "<|im_start|>"), (4, 2, "assistant", "é"),
]


def want(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for c, turns in convs.items():
        turns.sort()
        loss = [x for _, r, x in turns if r == "assistant"]
        shown = sum(len(f"<|im_start|>{chat._role_line(r)}{chat.escape(x)}<|im_end|>\n") for _, r, x in turns)
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len("".join(loss)), sha("".join(loss)), shown))
    return sorted(out, key=str)


def test_what_is_read_back(spark):
    rows = spark.createDataFrame([(*r, 1, "m") for r in ROWS], SCHEMA)
    got = chat.read_back(chat.format_turns(rows))
    assert sorted(map(tuple, got.collect()), key=str) == want(ROWS)


def test_offsets_are_prefix_sums_and_masks_cover_learned_text_alone(spark):
    rows = chat.format_turns(spark.createDataFrame([(*r, 1, "m") for r in ROWS], SCHEMA)).filter("conv_id = 4").orderBy("place")
    at = 0
    for r in rows.collect():
        assert r.offset == at and r.ids[0] == chat.START and r.ids.count(chat.END) == 1
        assert len(r.learned) == (0 if r.place == 1 else 2)
        if r.learned:
            start, end = r.learned
            said = chat.encoder(chat.VOCABULARY).decode(r.ids[start:end])
            assert chat.unescape(said) == ROWS[8 + r.place][3] and r.ids[end] == chat.END
        at += len(r.ids)


def test_trick_conversation_and_empty_table(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_turns(rows)).count() == 0
    got = chat.read_back(chat.format_turns(chat.with_trick(rows))).first()
    assert (got.conv_id, got.n_turns, got.loss_chars) == (-1, 2, len(chat.TRICK))
