"""The template compiler: results, folding and the sandbox."""
import pytest

from sevscope.llm import template as T


def out(source, messages=(), **more):
    return "".join(t for t, _ in T.compile_template(source, {"up": str.upper})(messages, **more))


def test_expressions():
    assert out("{{ 'a' ~ 1 + 2 }}|{{ 1 + 2 }}|{{ not false and 'x' == 'x' }}|{{ none }}|{{ 'q' | up }}") == "a12|3|True||Q"
    assert out("{% if x.a == 'b' %}1{% elif x['c'] %}2{% else %}3{% endif %}", x={"a": 1, "c": 0}) == "3"


def test_loops():
    assert out("{% for m in messages %}{{ loop.index }}{{ m.t }}{% if loop.last %}.{% else %},{% endif %}{% endfor %}", [{"t": c} for c in "abc"]) == "1a,2b,3c."
    assert out("{% for m in messages %}x{% endfor %}") == ""


def test_generation_marks():
    pieces = list(T.compile_template("a{% generation %}b{{ x }}{% endgeneration %}c")([], x="y"))
    assert pieces == [("a", False), ("b", True), ("y", True), ("c", False)]


def test_constants_fold():
    tree = T.fold(T.parse("a{{ 'b' ~ 'c' }}{% if 1 == 2 %}no{% else %}d{% endif %}{{ x }}"), {})
    assert tree == ("block", [("text", "abcd"), ("print", ("name", "x"))])


def test_sandbox():
    assert out("{{ x.__class__ }}{{ x.upper }}", x="s") == ""
    for bad in ("{{ x() }}", "{% import os %}", "{{ x | nope }}", "{{ 1 + }}", "{% if x %}", "{{ x; y }}", "{% endfor %}"):
        with pytest.raises(T.TemplateError):
            T.compile_template(bad)
