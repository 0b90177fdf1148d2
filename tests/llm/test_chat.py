"""Chat formatting: spans, loss mask, escapes, templates that rewrite history."""

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkkit.llm import chat
from sparkkit.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
texts = st.lists(st.sampled_from(["<", ">", "/", "s", "[", "]", "INST", "</s>", "[INST]", "[/INST]", "\\", " ", "\n", "<<SYS>>", "<</SYS>>", "[ROLE]", "x", "é", "😀"]), max_size=12).map("".join)
roles = st.sampled_from(["user", "assistant", "system", "tool", "", "a\nb", "[/ROLE]", "\\"])


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=6))
def test_any_turns_can_be_read_back(turns):
    formatted = chat.inst_template(turns)
    assert chat.read_back(formatted) == turns
    renderer, spans = chat.Renderer(chat.inst_template), []
    for role, text in turns:
        span, a, b = renderer.add(role, text)
        spans.append(span)
        assert chat.unescape(span[a:b]) == text
    assert "".join(spans) == formatted


@settings(max_examples=300, deadline=None)
@given(texts)
def test_no_control_string_survives_escaping(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"))


def expected(rows):
    out, by_conv = {}, defaultdict(list)
    for r in rows:
        by_conv[r[0]].append((-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
    for conv, turns in by_conv.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        every = "".join(f"{role}\n{t}\n" for _, role, t in turns)
        formatted = chat.inst_template([(role, t) for _, role, t in turns])
        out[conv] = (len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted))
    return out


def found(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in df.collect()}


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a\\b </s>"), (1, 1, "assistant", "a\\b </s>"), (2, None, None, "x"), (2, 0, "tool", ""), (None, 0, "user", "q"), (3, 0, "assistant", "é😀 ")]
    rows += [(4, k, "user" if k % 2 == 0 else "assistant", f"turn {k} [INST]") for k in range(300)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, start string").repartition(3)
    assert found(chat.digests(chat.format_turns(df))) == expected(rows)


def test_no_rows(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_turns(df).collect() == [] and chat.digests(chat.format_turns(df)).collect() == []


def test_starts_and_loss_mask(spark):
    df = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a")], "conv_id long, turn long, role string, text string")
    rows = chat.format_turns(df).orderBy("position").collect()
    whole = chat.inst_template([("system", "s"), ("user", "u"), ("assistant", "a")])
    assert [whole[r.start : r.start + len(r.rendered)] for r in rows] == [r.rendered for r in rows]
    assert [r.in_loss for r in rows] == [False, False, True]


def test_rewritten_history_is_seen(spark):
    def rewriting(turns):
        """Drops all but the last assistant text."""
        last = max((k for k, (role, _) in enumerate(turns) if role == "assistant"), default=-1)
        return "".join(f"<{role}>{text if role != 'assistant' or k == last else ''};" for k, (role, text) in enumerate(turns))

    df = spark.createDataFrame([(c, k, "user" if k % 2 == 0 else "assistant", f"t{k}") for c, n in ((1, 2), (2, 6)) for k in range(n)], "conv_id long, turn long, role string, text string")
    rows = chat.format_turns(df, rewriting).orderBy("conv_id", "position").collect()
    assert [r.rewrites_history for r in rows] == [False] * 2 + [False] * 3 + [True] * 3
    assert all((r.rendered is None) == r.rewrites_history for r in rows)


def late_templates():
    """Each with the number of turns after which it rewrites history, of 60. They stand inside, as workers can't import this file."""

    def plain(turns):
        return "".join(f"<{role}>{text};" for role, text in turns)

    return {
        "numbering": (lambda turns: "".join(f"<{k}:{role}>{text};" for k, (role, text) in enumerate(turns)), 60),
        "looking 20 back": (lambda turns: "".join(f"<{turns[k - 20][1] if k >= 20 else ''}>{text};" for k, (_, text) in enumerate(turns)), 60),
        "late truncating": (lambda turns: plain(turns[-40:]), 40),
        "late rewriting": (lambda turns: plain([(role, "" if k == 1 and len(turns) >= 45 else text) for k, (role, text) in enumerate(turns)]), 44),
    }


@pytest.mark.parametrize("name", list(late_templates()))
def test_whole_prefixes_of_long_conversations(spark, name):
    template, whole = late_templates()[name]
    turns = [("user" if k % 2 == 0 else "assistant", f"t{k}") for k in range(60)]
    df = spark.createDataFrame([(1, k, *turn) for k, turn in enumerate(turns)], "conv_id long, turn long, role string, text string")
    rows = chat.format_turns(df, template).orderBy("position").collect()
    assert [r.rewrites_history for r in rows] == [False] * whole + [True] * (60 - whole)
    expected = template(turns[:whole])
    assert "".join(r.rendered for r in rows[:whole]) == expected
    assert [expected[r.start + r.text_start : r.start + r.text_end] for r in rows[:whole]] == [text for _, text in turns[:whole]]
    assert all(r.rendered is None and r.start is None for r in rows[whole:])


def test_turn_local_templates_give_the_same_without_prefixes(spark):
    df = spark.createDataFrame([(c, k, "user" if k % 2 == 0 else "assistant", f"t{k} [INST]") for c, n in ((1, 3), (2, 50)) for k in range(n)], "conv_id long, turn long, role string, text string")
    whole, local = (chat.format_turns(df, turn_local=flag).orderBy("conv_id", "position").collect() for flag in (False, True))
    assert whole == local


def test_query(spark):
    try:
        given_rows = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    except Exception:  # noqa: BLE001
        pytest.skip("no test tables")
    said = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in given_rows] + [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    assert found(QUERIES["op2_chat"](spark, SMALL)) == expected(rows)
