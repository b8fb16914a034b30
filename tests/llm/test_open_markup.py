"""Pages whose end tags are left out, and embedded elements with words."""

import pytest

from fieldwatch.llm import html_text

BODY = "<article><h1>Head line</h1><p>Real words of it</p></article>"
WANT = "Head line\nReal words of it"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<!doctype html><html><head><title>No</title><style>p{{}}</style><body>{BODY}", WANT),
        (f"<html><head><meta charset=utf-8><title>No</title>{BODY}", WANT),
        (f"<html><head><title>No<body>{BODY}", WANT),
        ("<html><head><title>No</title>Real words and nothing else", "Real words and nothing else"),
        (f"<head><noscript><div>no</div></noscript><template><p>no</p></template><title>no</title></head>{BODY}", WANT),
        (f"<head><title>How to use <div> well</title></head>{BODY}", WANT),
        ("<article><p>One two <button class=share>Send</p><p>three four</p></article>", "One two\nthree four"),
        ("<article><p>One two</p><noscript>no<p>three four</p><svg><path d=x><p>five six</p></article>", "One two\nthree four\nfive six"),
        ("<article><noscript><p>no</p></noscript><p><button><div>no</div></button>yes words</p></article>", "yes words"),
        ("<article><p>Sum <math><mi>x</mi><mo>+</mo><mn>1</mn></math> ends</p></article>", "Sum x+1 ends"),
        ("<article><p>See <svg><title>no</title><desc>no</desc><text>label one</text><text>two</text></svg> there</p></article>", "See label one two there"),
        ("<article><p>First words</p><object data=x><p>fallback words</p></object></article>", "First words\nfallback words"),
    ],
)
def test_words_are_found(page, want):
    assert html_text.main_text(page, html_text.fitted()) == want
