"""Damaged markup ends no job, and what isn't damaged is still read."""

import random

import pytest

from storelens.llm import mincut_html


@pytest.mark.parametrize(
    "html,texts",
    [
        ("<p>a</p><![foo[x]]><p>b</p>", ["a", "b"]),
        ("<p>a</p><![ x", ["a"]),
        ("<p>a <![CDATA[ hidden ]]> b</p>", ["a b"]),
        ("<p>a<![endif]-->b</p>", ["ab"]),
        ("<!--[if IE]><p>old</p><![endif]--><p>new</p>", ["new"]),
        ("<![", []),
        ("<p>x</p><!DOCTYPE [ <!ENTITY a 'b'> ]>", None),
        ("&#x110000; &#99999999999999999999; &bogus; &amp", None),
    ],
)
def test_sections_are_comments(html, texts):
    found = [b.text for b in mincut_html.read_blocks(html)]
    assert texts is None or found == texts


def test_random_damage():
    rng = random.Random(6)
    parts = ["<", ">", "</", "/>", "<!", "<!--", "-->", "--!>", "<![", "[", "]]>", "<?", "&", "&#", "&#x", ";", '"', "'", "=", "p", "div",
             "a href", "script", "style", "title", "svg", "table", "tr", "td", "br", " ", "text", "é", "\x00", "CDATA[", "DOCTYPE", "if IE"]
    for _ in range(20_000):
        html = "".join(rng.choices(parts, k=rng.randrange(40)))
        for block in mincut_html.read_blocks(html):
            assert block.text == " ".join(block.text.split()) != ""


def test_cut_off_pages(spark):
    page = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").first()["html"]
    whole = [b.text for b in mincut_html.read_blocks(page)]
    assert whole
    for cut in range(0, len(page), max(1, len(page) // 300)):
        mincut_html.read_blocks(page[:cut])
