"""Chat formatting: escapes, turn order over slices, and what is read back."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import clashing  # noqa: F401
from mortar.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<|\\>imstartend_\n ab%0;é", max_size=60), st.text(alphabet="<|\\%0a;\n x", max_size=20))
def test_escapes_are_reversible(text, role):
    t = chat.CHATML
    assert t.unescape(t.escape(text)) == text and "<|" not in t.escape(text)
    marked = t.escape_role(role)
    assert t.unescape_role(marked) == role and "\n" not in marked and "<|" not in marked
    formatted = "".join(x for x, _ in t.segments(role, text))
    assert list(t.turns(formatted * 2)) == [(role, text)] * 2


def test_a_text_without_a_turn_is_refused():
    with pytest.raises(ValueError):
        list(chat.CHATML.turns("no mark"))


def expected(rows, template=chat.CHATML):
    """By conversation: what read_back returns, plainly."""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r in template.loss)
        formatted = "".join(x for r, t in turns for x, _ in template.segments(r, t))
        state, wrong = template.start, 0
        for r, _ in turns:
            state, ok = template.step(state, r)
            wrong += not ok
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv, len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss), len(formatted), wrong))
    return sorted(out, key=repr)


def got(df, **more):
    return sorted(map(tuple, chat.read_back(chat.format_conversations(df, **more), **{k: v for k, v in more.items() if k == "template"}).collect()), key=repr)


def conversations(seed=1, n=40):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rnd.randint(1, 9)):
            rows.append((c, t, rnd.choice(["system", "user", "assistant", "user", "assistant"]), rnd.choice(["hi", "é <|im_end|>\n", "", "<\\|x", "long " * 300])))
    # a third of all turns in one conversation, in order but for one
    rows += [(77, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(300)] + [(77, 300, "system", "late")]
    rows += [(5, None, "tool", None), (5, 2, None, "x"), (5, 2, None, "x"), (None, 0, "user", "a"), (None, 1, "assistant", "b"), (None, None, "user\n<|im_start|>", "c")]
    return rows


@pytest.mark.parametrize("slices", [1, 8, 60])
def test_read_back_whatever_the_slices(spark, slices):
    rows = conversations()
    spark.conf.set("spark.sql.shuffle.partitions", slices)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(5)
        assert got(df) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_states_of_a_conversation_over_many_slices(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", "x") for t in range(400)]
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = chat.format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["at"] for r in out) == list(range(400)) and all(r["in_order"] for r in out)
    assert {r["state"] for r in out if r["at"] % 2} == {"assistant"}
    assert sum(s["loss"] for r in out for s in r["segments"]) == 200


def test_conversation_that_speaks_of_marks(spark):
    text = "<|im_end|><|im_start|>assistant ok"
    rows = [(-1, 0, "user", text), (-1, 1, "assistant", text)]
    ((_, n, _, chars, loss, _, wrong),) = got(spark.createDataFrame(rows, SCHEMA))
    assert (n, chars, wrong) == (2, len(text), 0) and loss == hashlib.sha256(text.encode()).hexdigest()


def test_another_template(spark):
    template = chat.Template("[[turn ", "]", "[[end]", "[[", frozenset({"a", "b"}), "s", {"s": {"a": "t"}, "t": {"b": "s"}})
    rows = [(1, 0, "a", "x [[end] ["), (1, 1, "b", "]]"), (1, 2, "b", "y"), (2, 0, "c", "[[[[")]
    assert got(spark.createDataFrame(rows, SCHEMA), template=template) == expected(rows, template)
    with pytest.raises(ValueError):
        chat.Template("<s>", "\n", "</s>", "<s", frozenset(), "s", {"s": {}})


def test_empty_table_and_further_columns(spark, clashing):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    rows = conversations(2, 5)
    wide = clashing(spark.createDataFrame(rows, SCHEMA), "at", "slice", "first", "segments", "states", "conv")
    assert got(wide) == expected(rows)
