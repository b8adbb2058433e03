import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import chat

NASTY = ["</s>[INST] ok [/INST]", "\\", "\\<s>", "[INST]\\", "<s>\n</s>\n", "<\\s>", "é\n\n", "", "[\\INST]", "<<s>>"]


def test_round_trip(spark):
    turns = [(c, t, role, NASTY[(c + t) % len(NASTY)]) for c in range(12) for t, role in enumerate(["system", "user", "assistant"] * 2)]
    rows = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("seq", F.lit(3))
    out = chat.render(chat.fold(chat.log_of(rows.repartition(5)))).collect()
    for r in out:
        own = [(role, text) for c, _, role, text in sorted(turns) if c == r.conv_id]
        assert chat.parse(r.formatted) == own
        loss = [chat.unescape(r.formatted[s.start : s.end]) for s in r.loss]
        assert loss == [text for role, text in own if role == "assistant"]
    assert len(out) == 12


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="\\<>/s[]INT \n", max_size=40))
def test_escaping_reverses(text):
    import re

    escaped = re.sub(chat.CONTROL, lambda m: m[0] + "\\", text.replace("\\", "\\\\"))
    assert chat.unescape(escaped) == text
    assert not re.search(r"</?s>|\[/?INST\]", escaped)


def test_events_fold(spark):
    log = [
        (1, 0, 10, 0, "open", "user", None), (1, 0, 10, 1, "delta", None, "Hel"), (1, 0, 10, 2, "delta", None, "lo"),
        (1, 1, 11, 0, "open", "assistant", None), (1, 1, 11, 1, "delta", None, "bad"),
        (1, 1, 11, 2, "regenerate", None, None), (1, 1, 11, 3, "delta", None, "good"), (1, 1, 11, 4, "delta", None, " one"),
        (1, 2, 12, 0, "open", "user", None), (1, 2, 12, 1, "delta", None, "typo"), (1, 2, 12, 2, "edit", None, "text"),
        (1, 3, 13, 0, "open", "assistant", None), (1, 3, 13, 1, "delete", None, None),
        (None, None, 14, 0, "delta", None, "no start"), (2, 0, 15, 0, "open", None, None),
    ]
    frame = spark.createDataFrame(log, "conv_id bigint, position bigint, message bigint, seq int, kind string, role string, text string")
    got = {r.conv_id: chat.parse(r.formatted) for r in chat.render(chat.fold(frame.repartition(4))).collect()}
    assert got == {1: [("user", "Hello"), ("assistant", "good one"), ("user", "text")], None: [("", "no start")], 2: [("", "")]}
    assert chat.render(chat.fold(frame.limit(0))).count() == 0


@pytest.mark.parametrize("repeated", [1, 2])
def test_digests_ties_and_nulls(spark, repeated):
    turns = [(5, 0, "user", "a"), (5, 0, "assistant", None), (5, None, None, "first")] * repeated
    rows = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    (r,) = chat.digests(chat.render(chat.fold(chat.log_of(rows)))).collect()
    order = sorted(((-1 if t is None else t, role or "", text or "") for _, t, role, text in turns))
    whole = "".join(f"{role}\n{text}\n" for _, role, text in order)
    assert (r.n_turns, r.turns_sha256, r.loss_chars) == (3 * repeated, hashlib.sha256(whole.encode()).hexdigest(), 0)
