import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyfold.llm import chat as C

PARTS = ["</s>", "<s>", "[INST]", "[/INST]", "\\", " ", "<<SYS>>", "<</SYS>>", "<<ROLE", "/ROLE>>", "<", "s>", "/", "[", "I", "\n", "é", "0:"]
TEXT = st.lists(st.sampled_from(PARTS), max_size=8).map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), min_size=1, max_size=5))
def test_texts_and_roles_come_back(turns):
    out = C.instruction_template(turns)
    assert C.read_turns(out) == turns
    for i, turn in enumerate(turns):
        span = C.locate(C.instruction_template, turns[max(0, i - 1) : i], turn)
        assert C.unescape(span.added[span.start : span.end]) == turn[1]
        assert not span.rewrites


def forgetful(turns):
    """Drops what the user said before the last turn."""
    return "".join(f"<{r}>{'' if r == 'user' and i < len(turns) - 1 else t}" for i, (r, t) in enumerate(turns))


def numbered(turns):
    return "".join(f"({i}:{r}) {t.strip()}\n" for i, (r, t) in enumerate(turns))


def test_rewriting_is_noticed():
    assert C.locate(forgetful, [("user", "hi")], ("assistant", "x")).rewrites
    assert not C.locate(forgetful, [("user", "")], ("assistant", "x")).rewrites


def test_whole_prefixes_for_templates_that_count():
    span = C.locate(numbered, [("user", "a"), ("assistant", "b")], ("user", "c d"))
    assert span.added == "(2:user) c d\n" and span.added[span.start : span.end] == "c d"


SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        turns = [(r or "", t or "") for _, _, r, t in own]
        every = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out[conv] = (len(turns), sha(every), len(loss), sha(loss), len(C.instruction_template(turns)))
    return out


@pytest.mark.parametrize("context", [0, 1, None])
def test_digests_equal_brute_force(spark, context):
    said = "</s>[INST] ok [/INST]"
    rows = [
        (-7, 0, "user", said), (-7, 1, "assistant", said),
        (1, 2, "assistant", None), (1, 1, "user", ""), (1, 1, "assistant", "tie"), (1, 1, "assistant", "tie"),
        (None, 0, None, "lost"), (None, None, "tool", "\\<s> x"), (3, 0, "system", "be brief"),
        (4, 0, "assistant", "long " * 50_000),
    ]
    rows += [(5, i, ("user", "assistant")[i % 2], f"[INST{i}] \\[/INST] {i}") for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as formatted", "1 as rewrites")
    got = C.digest_conversations(C.format_turns(frame, context=context)).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == brute(rows)
    assert len(got) == 6


def test_rewritten_turns_are_marked(spark):
    frame = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yes")], SCHEMA)
    rows = C.format_turns(frame, forgetful, context=None).orderBy("turn").collect()
    assert [r["rewrites"] for r in rows] == [False, True] and not rows[1]["trained"]


def last_four(turns):
    return "".join(f"<{r}>{t}" for r, t in turns[-4:])


@pytest.mark.parametrize("template", [numbered, forgetful, last_four])
def test_templates_that_look_back_get_whole_prefixes(spark, template):
    turns = [(("user", "assistant")[i % 2], f"said {i}") for i in range(7)]
    frame = spark.createDataFrame([(1, i, *turn) for i, turn in enumerate(turns)], SCHEMA)
    rows = C.format_turns(frame, template).orderBy("turn").collect()
    want = [C.locate(template, turns[:i], turn) for i, turn in enumerate(turns)]
    assert [(r["formatted"], r["text_start"], r["text_end"], r["rewrites"]) for r in rows] == [tuple(x) for x in want]
    if template is numbered:
        assert "".join(r["formatted"] for r in rows) == numbered(turns)
    if template is last_four:
        assert [r["rewrites"] for r in rows] == [False] * 4 + [True] * 3


def test_a_context_needs_a_declared_template(spark):
    frame = spark.createDataFrame([(1, 0, "user", "hi")], SCHEMA)
    for template, context in ((numbered, 1), (C.looks_back(2)(lambda turns: numbered(turns[-3:])), 1)):
        with pytest.raises(ValueError):
            C.format_turns(frame, template, context=context)


def test_no_rows(spark):
    assert C.digest_conversations(C.format_turns(spark.createDataFrame([], SCHEMA))).count() == 0
