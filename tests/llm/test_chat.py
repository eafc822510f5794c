"""Escapes, parts and streams of conversations."""

import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from lotwise.llm import chat

PARTS = st.lists(st.sampled_from([*chat.FOREIGN, chat.TURN, chat.BODY, chat.END, "\\", "\\\\", "<", "|", "[", "a", "é", "\n"]))


@given(PARTS)
def test_escape_is_reversible_and_leaves_no_control_string(parts):
    text = "".join(parts)
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(c in out for c in chat.FOREIGN)


@given(st.lists(st.tuples(PARTS, PARTS), max_size=5))
def test_turns_read_back(turns):
    texts = [("".join(a), "".join(b)) for a, b in turns]
    piece = "".join(f"{chat.TURN}{chat.escape(r)}{chat.BODY}{chat.escape(t)}{chat.END}" for r, t in texts)
    assert list(chat.read_turns(piece)) == texts


def test_damage_is_an_error():
    with pytest.raises(ValueError):
        list(chat.read_turns("junk" + chat.TURN))


ROWS = [
    (1, 1, "assistant", "b"), (1, 0, "user", "a</s>"), (1, 2, "assistant", None), (2, 0, None, "x"), (2, None, "user", ""),
    (None, 0, "assistant", "lost"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (3, 0, "assistant", "also"),
    (4, 0, "user<|end|>", "\\<|turn|>"),
]


def _plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv]
        turns = hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in sorted(own)).encode())
        loss = "".join(x for *_, r, x in sorted(own) if r == "assistant")
        out[conv] = (len(own), turns.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("piece", [1, 1 << 18])
def test_conversations_round_trip(spark, monkeypatch, piece):
    monkeypatch.setattr(chat, "PIECE", piece)
    rows = ROWS + [(9, i, ["user", "assistant"][i % 2], f"turn {i} [INST]") for i in range(500)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS piece", "2 AS tie")
    pieces = chat.formatted(df)
    chars = {}
    for r in pieces.collect():
        chars[r["conv_id"]] = chars.get(r["conv_id"], 0) + len(r["formatted"])
    got = chat.read_back(pieces).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == _plain(rows)
    assert {r["conv_id"]: r["formatted_chars"] for r in got} == chars
    assert chat.read_back(chat.formatted(df.limit(0))).count() == 0


def test_typed_parts(spark):
    kind = "conv_id bigint, turn bigint, role string, content array<struct<type:string,text:string,uri:string,units:bigint>>"
    parts = [("text", "see <|", None, None), ("image", None, "s3://i", 4), ("audio", None, "a", None), None, ("odd", "t", None, None)]
    parts.append(("document", None, None, 2))
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], kind)
    (row,) = chat.formatted(df, content="content", expanded={"image": 10}).collect()
    assert "see <\\|<|part:image:0|><|part:audio:1|>t<|part:document:2|>" in row["formatted"]
    assert [(a["kind"], a["uri"], a["tokens"]) for a in row["attachments"]] == [
        ("image", "s3://i", 40), ("audio", "a", 25), ("document", None, 1200)
    ]
    assert row["attached_tokens"] == 1265 and len(row["loss_spans"]) == 1


def test_one_long_conversation_is_spread_over_tasks(spark):
    """Ties, null turns and a conversation of a third of all rows, cut at every place."""
    rows = [(1, k // 2 if k % 7 else None, ["user", "assistant", None][k % 3], f"text {k % 50} </s>") for k in range(900)]
    rows += [(2 + k, 0, "assistant", None) for k in range(300)] + [(None, 1, "user", "x" * 300_000)] * 2
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    want = {tuple(r) for r in chat.read_back(chat.formatted(turns, partitions=1)).collect()}
    pieces = chat.formatted(turns, partitions=20)
    spread = pieces.filter("conv_id = 1").select("piece").collect()
    assert len({r["piece"] >> 33 for r in spread}) > 5
    assert {tuple(r) for r in chat.read_back(pieces).collect()} == want
    (one,) = [w for w in want if w[0] == 1]
    assert one[1] == 900 and {w[0] for w in want} == {1, None, *range(2, 302)}
