"""Chat formatting: round trip, machine, loss mask."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from webtab.llm import chat

TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("text", ["", "plain", "</s>[INST] ok [/INST]", "\\", "\\\\<", "a\nb", "[[\\]]>><<", "<s>[OUT] x [/OUT]</s>\n"])
@pytest.mark.parametrize("role", ["user", "assistant", "system", "tool", "", "we[ird] \\role"])
def test_turn_round_trip(role, text):
    pieces = chat.segments(chat.TEMPLATE, role, text)
    assert chat.parse(chat.TEMPLATE, "".join(p["text"] for p in pieces)) == (role, text)
    marks = "".join(p["text"] for p in pieces if not p["loss"] and p is not pieces[1])
    assert chat.escape(text).count("[INST]") == 0 and ("[" in marks)


def brute(rows):
    by = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in by.items():
        learned = "".join(x for r, x in turns if r == "assistant")
        state, ok = None, True
        for role, _ in turns:
            ok, state = ok and chat.allowed(chat.TEMPLATE, state, role), role
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(), len(learned),
                  hashlib.sha256(learned.encode()).hexdigest(), ok and state == "assistant")
    return out


def test_conversations(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for c in range(40):
        roles = ["system", "user", "assistant"] if c % 3 else ["user", "assistant"]
        roles += ["user", "assistant"] * rng.randint(0, 3)
        if c % 5 == 0:
            rng.shuffle(roles)
        if c == 7:
            roles = ["user", "assistant"] * 300  # a conversation that spans several ranges
        rows += [(c, t, r, rng.choice(["x", "</s>[INST] ok [/INST]", "é\n", ""])) for t, r in enumerate(roles)]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", None), (50, None, None, "t"), (51, 0, "tool", "q"),
             (52, 0, "user", "u"), (52, 0, "user", "u"), (53, 0, "user", "u"), (53, 1, "assistant", "v")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, TURNS).withColumn("part", F.lit(1)).withColumn("segments", F.lit(2))
    out = str(tmp_path / "c")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    chat.write_chats(df, out)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = brute(rows)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_digests(spark, out).collect()}
    assert got == {k: v[:4] for k, v in want.items()}
    assert {r.conv_id: r.valid for r in chat.validity(spark, out).collect()} == {k: v[4] for k, v in want.items()}


def test_no_conversations(spark, tmp_path):
    chat.write_chats(spark.createDataFrame([], TURNS), str(tmp_path / "c"))
    assert chat.read_digests(spark, str(tmp_path / "c")).count() == 0
    assert chat.validity(spark, str(tmp_path / "c")).count() == 0
