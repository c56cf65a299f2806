"""Blanks that marks take away, and comments."""

from quizmill.llm.template import compile_template


def render(source, **names):
    return "".join(x for x in compile_template(source, {})(**names) if isinstance(x, str))


def test_blanks_and_comments():
    assert render("a  {%- if true -%}  b  {% endif %}c") == "ab  c"
    assert render("a {# {{ x }} {% no %} #} b") == "a  b"
    assert render("a {#- gone -#} b") == "ab"
    assert render("a \n{{- x -}}\t b", x="-") == "a-b"
    assert render("{{ '-' }} {{ x }} ", x=1) == "- 1 "
    assert render("{% for m in ms -%}\n {{ m }}\n{%- endfor %}", ms=["a", "b"]) == "ab"
