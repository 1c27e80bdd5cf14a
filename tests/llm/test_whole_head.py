"""An unclosed head ends where a browser ends it."""

import pytest

from storelens.llm import mincut_html


def blocks(page):
    reader = mincut_html.BlockReader()
    reader.feed(page)
    reader.close()
    return [b.text for b in reader.blocks]


@pytest.mark.parametrize("tag", ["h1", "h3", "h6", "ol", "pre", "blockquote", "aside", "figure", "dl", "span", "a", "p", "br"])
def test_element_ends_head(tag):
    page = f"<html><head><title>T</title><meta charset=x><script>var a;</script><style>b{{}}</style>\n<{tag}>First words here.<p>Then more."
    assert " ".join(blocks(page)) == "First words here. Then more."


def test_text_ends_head():
    assert blocks("<head><title>T</title>\n Bare text <b>goes</b> on<p>Then more.") == ["Bare text goes on", "Then more."]
    assert blocks("<head><title>T</title><noscript>no</noscript></head><body><p>Text.") == ["Text."]
    assert blocks("<head><head><title>T</title><h3>Text.") == ["Text."]
