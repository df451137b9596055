"""Template compiler and chat formatting by exact round trips."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tempoflow.llm import chat
from tempoflow.llm.templates import Const, If, Name, TemplateError, Text, compile_template

PIECES = st.lists(st.one_of(st.sampled_from([*chat.CONTROLS, "\\", "\n", "<", "|", "im_end|>", "[", "/", "é"]), st.text(max_size=3)), max_size=9).map("".join)


@settings(max_examples=200, deadline=None)
@given(PIECES)
def test_guard_is_undone_and_hides_control_strings(text):
    guarded = chat.guard(text)
    assert chat.unguard(guarded) == text
    assert not any(c in guarded for c in chat.CONTROLS)
    assert chat.unguard(chat.guard_line(text)) == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), max_size=4), st.integers(1, 40))
def test_turns_are_read_back_from_any_cut(turns, step):
    compiled = compile_template(chat.TEMPLATE, {"guard": chat.guard, "line": chat.guard_line})
    out = "".join(t for t, _ in compiled.render({"messages": iter([{"role": r, "text": t} for r, t in turns])}))
    assert list(chat.read_turns(out[k : k + step] for k in range(0, len(out), step))) == turns


def shown(source, **scope):
    return "".join(t for t, _ in compile_template(source).render(scope))


def test_constants_are_folded():
    tree = compile_template("a{{ 'b' + 'c' }}{% if 1 == 2 %}x{% elif y %}Y{% else %}N{% endif %}{{ 1 + 2 }}z").tree
    assert tree == (Text("abc"), If(((Name("y"), (Text("Y"),)), (Const(True), (Text("N"),)))), Text("3z"))
    assert compile_template("{% if true %}a{% endif %}{% if false %}b{% endif %}c").tree == (Text("ac"),)


def test_language():
    people = [{"n": "a", "k": 1}, {"n": "b", "k": 2}]
    assert shown("{% for p in ps %}{{ loop.index }}{{ p['n'] | upper }}{% if not loop.last %}, {% endif %}{% endfor %}", ps=people) == "1A, 2B"
    assert shown("{% set x = 'q' %}{{ x }} {%- if x == 'q' and not y -%} ! {%- endif %}") == "q!"
    assert shown("{{ 'a' in s or 'z' }}{{ none }}", s="bc") == "z"
    parts = list(compile_template("p{% generation %}{{ x }}{% endgeneration %}s").render({"x": "t"}))
    assert parts == [("p", False), ("t", True), ("s", False)]


@pytest.mark.parametrize("source", ["{{ }}", "{% if x %}", "{% for x %}{% endfor %}", "{{ x | nothing }}", "{% import os %}", "{{ x( ) }}", "{% endif %}", "{{ 'a' + 1 }}", "{% if a %}{% else %}{% else %}{% endif %}"])
def test_bad_templates_are_refused(source):
    with pytest.raises(TemplateError):
        compile_template(source)


@pytest.mark.parametrize("source", ["{{ x.__class__ }}", "{{ x['__class__'] }}", "{{ y }}"])
def test_only_items_of_mappings_can_be_reached(source):
    with pytest.raises(TemplateError):
        shown(source, x="text", y=[1])


def test_conversations(spark):
    probe = "</s>[INST] ok [/INST]"
    turns = [
        (1, 2, "assistant", "b\\"), (1, 1, "user", probe), (1, 3, "assistant", "c"), (2, 0, None, None), (3, 0, "assistant", None),
        (None, 0, "user", "x"), (4, 0, "sys\ntem", "é" * 5), (4, None, "assistant", "first"), (5, 0, "user", "same"), (5, 0, "user", "same"),
        *((6, k, "assistant" if k % 2 else "user", f"turn {k} " * 50) for k in range(300)),
    ]
    df = spark.createDataFrame([(*t, "other", 1) for t in turns], "conv_id long, turn long, role string, text string, part string, spans int")
    got = {r.conv_id: r for r in chat.digest(chat.render(df, part=200)).collect()}
    groups = {}
    for conv, turn, role, text in turns:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert got.keys() == groups.keys()
    for conv, group in groups.items():
        group.sort()
        learned = "".join(t for _, _, r, t in group if r == "assistant")
        r = got[conv]
        assert r.n_turns == len(group)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{t}\n" for _, _, role, t in group).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        want = "".join(f"<|im_start|>{chat.guard_line(role)}\n{chat.guard(t)}<|im_end|>\n" for _, _, role, t in group)
        assert r.formatted_chars == len(want)
    assert chat.digest(chat.render(df.limit(0))).count() == 0
