"""Only an attribute named hidden hides, and formulas are text of their block."""

import time

import pytest

from groundswell.llm import main_text


@pytest.mark.parametrize("attribute", ['title="The hidden coast"', 'data-hidden="false"', 'data-overflow="hidden"', "title='a hidden=1 b'", "alt=hidden"])
def test_not_hidden(attribute):
    assert main_text.extract(f"<article {attribute}><p>Text of the page.</p></article>", main_text.trained()) == "Text of the page."


@pytest.mark.parametrize("attribute", ["hidden", 'hidden=""', "HIDDEN", 'aria-hidden="true"', 'style="display: none"', 'title="x" hidden'])
def test_hidden(attribute):
    page = f"<article><p>Text of the page.</p><p {attribute}>Not this one.</p></article>"
    assert main_text.extract(page, main_text.trained()) == "Text of the page."


def test_formulas():
    page = "<article><p>We know <math><mi>E</mi><mo>=</mo><msup><mi>mc</mi><mn>2</mn></msup></math> by now.</p></article>"
    assert main_text.extract(page, main_text.trained()) == "We know E=mc2 by now."


def test_names():
    assert main_text._names(' class="a b" data-class="c" id=d') == {".a", ".b", ".d"}


PARAGRAPHS = ("A first paragraph of plain text, long enough.", "And a second one with some more words in it.")


@pytest.mark.parametrize("page", [
    "<div><p>{0}</p><p>{1}</p></div>", "<section><p>{0}</p><p>{1}</p></section>", "<p>{0}</p><p>{1}</p>", "<body><div>{0}</div><div>{1}</div>",
    "<nav><a href=x>Home</a></nav><div><p>{0}</p><p>{1}</p></div><footer>© 2020 Someone</footer>",
    "<div class=wrapper><div class=foo><p>{0}</p><p>{1}</p></div></div><div class=sidebar><ul><li><a href=a>x</a></li></ul></div>",
    "<html><head><title>t</title></head><body>" + "<div>" * 60 + "<p>{0}</p><p>{1}"])
def test_articles_without_a_name_stay(page):
    assert main_text.extract(page.format(*PARAGRAPHS), main_text.trained()) == "\n".join(PARAGRAPHS)


@pytest.mark.parametrize("piece", ["<a ", "<a '>' ", "<a \"'>", "<a href=\"x>", "<script></script ", "<", "<!--", "<![CDATA[", "<p x='", "</p", "<b>", "&lt;<x y=z "])
def test_broken_markup_takes_time_in_step_with_its_length(piece):
    start = time.perf_counter()
    main_text.blocks(piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - start < 5


@pytest.mark.parametrize("page, want", [
    ("<p title='a > b'>one</p><p title=\"c>\">two</p>", ["one", "two"]), ("<p>1 < 2 and 3 > 2</p>", ["1 < 2 and 3 > 2"]),
    ("<p>a<!-- <p>no</p> -->b</p>", ["ab"]), ("<p>a<![CDATA[<p>no]]>b</p>", ["ab"]), ("<script>if (a < b) '</p>'</script><p>x</p>", ["x"]),
    ("<SCRIPT>x</SCRIPT ><p>y", ["y"]), ("<p>z</p><!-- open", ["z"]), ("<p>q <b unclosed", ["q <b unclosed"]), ("", []), ("<>", ["<>"])])
def test_markup(page, want):
    assert [b.text for b in main_text.blocks(page)] == want
