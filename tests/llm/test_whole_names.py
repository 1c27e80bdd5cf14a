"""Pages whose containers say nothing, and pages wrapped in one form."""

import re
from collections import Counter

import pytest

from storelens.llm import mincut_html as html

GIVEN = "/root/testdata/sf0.1/pages.parquet"


@pytest.fixture(scope="module")
def pages(spark):
    rows = spark.read.parquet(GIVEN).where("html is not null").orderBy("page_id").limit(900)
    return rows.select("page_id", "url", "html")


@pytest.fixture(scope="module")
def weights(spark, pages):
    return html.train(pages.where("page_id % 2 = 0"))


def without_names(page):
    page = re.sub(r"\s(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", "", page)
    return re.sub(r"(?i)(</?)(nav|footer|aside|form|header|main|article|section)\b", r"\1div", page)


def test_shape_and_links_carry_where_names_say_nothing(pages, weights):
    both = kept = wanted = 0
    for row in pages.where("page_id % 2 = 1").limit(200).collect():
        named = Counter(html.main_text(row["html"], weights).split())
        bare = Counter(html.main_text(without_names(row["html"]), weights).split())
        both += sum((named & bare).values())
        kept += sum(bare.values())
        wanted += sum(named.values())
    assert both >= 0.99 * kept and both >= 0.99 * wanted > 0


def test_a_form_around_the_page_is_no_form(pages, weights):
    changed = 0
    for row in pages.limit(100).collect():
        page = row["html"]
        wrapped = re.sub(r"(?is)(<body[^>]*>)(.*)(</body>)", r"\1<form id='aspnetForm' method='post'>\2</form>\3", page)
        changed += wrapped != page
        assert html.main_text(wrapped, weights) == html.main_text(page, weights)
    assert changed > 50
    text = "Some words of the article that go on for a while, as they do. " * 5
    small = f"<form><p>Your name and address here</p></form><article><p>{text}</p><p>{text}</p></article>"
    whole = f"<form action='x'><article><p>{text}</p><p>{text}</p></article></form>"
    for own in (weights, html.prior()):
        assert html.main_text(small, own) == " ".join(f"{text} {text}".split())
        assert html.main_text(whole, own) == " ".join(f"{text} {text}".split())
