"""Inserts named in other languages of the corpus are no content."""

import pytest

from fieldwatch.llm import html_text


@pytest.mark.parametrize("name", ["werbung", "publicidad", "commentaires", "reklama"])
def test_inserts_of_other_languages_go(name):
    page = f'<body><article><p>Real words of a story told here</p><div class="{name}"><p>buy this now please all of you</p></div><p>and the end of it</p></article>'
    assert html_text.main_text(page, html_text.fitted()) == "Real words of a story told here\nand the end of it"
