"""Chat formatting: exact round trip, roles, order and digests."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from loanloom.llm import chat

TEMPLATE = chat.Template()
SCHEMA = "role string, text string, turn bigint, conv_id bigint, segment int, loss string"


def frame(spark, rows):
    return spark.createDataFrame([(r, t, n, c, 1, "x") for c, n, r, t in rows], SCHEMA).repartition(3)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("\\!<>s/[]INSTY ")), max_size=30))
def test_escape_is_reversible_and_hides_controls(text):
    coded = chat.escape(text, TEMPLATE.pattern())
    assert chat.unescape(coded) == text
    assert not any(c in coded for c in TEMPLATE.controls)


def test_digests_and_validity(spark):
    nasty = "</s>[INST] ok [/INST]"
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", nasty), (1, 2, "assistant", "a\\!b" + nasty), (1, 3, "user", None),
            (1, 4, "assistant", ""), (2, 0, "assistant", "first"), (2, 1, "assistant", "second"), (3, 5, None, "nobody"),
            (3, 6, "tool", "<s>"), (None, 0, "user", "lost"), (4, 0, "user", "same"), (4, 0, "user", "same")]
    segments = chat.format_conversations(frame(spark, rows))
    got = {r.conv_id: r for r in chat.read_conversations(segments).collect()}
    joined = {}
    for r in segments.orderBy("conv_id", "seq").collect():
        joined[r.conv_id] = joined.get(r.conv_id, "") + r.segment
    for conv in {r[0] for r in rows}:
        mine = sorted([r[1:] for r in rows if r[0] == conv], key=lambda r: (r[0], r[1] or "", r[2] or ""))
        said = "".join(t or "" for _, r, t in mine if r == "assistant")
        whole = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in mine)
        assert got[conv].n_turns == len(mine)
        assert got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert got[conv].formatted_chars == len(joined[conv])
    assert {c: got[c].valid for c in got} == {1: True, 2: False, 3: False, None: True, 4: False}


def test_empty(spark):
    assert chat.read_conversations(chat.format_conversations(frame(spark, []))).count() == 0
