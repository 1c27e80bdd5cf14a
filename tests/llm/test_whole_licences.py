"""Licence notices wrapped over lines, with and without comment signs."""

import textwrap

import pytest

from storelens.llm import license_families

GPL = (
    "This program is free software: you can redistribute it and/or modify\n"
    "it under the terms of the GNU General Public License as published by\n"
    "the Free Software Foundation, either version 3 of the License, or\n"
    "(at your option) any later version."
)


@pytest.fixture(scope="module")
def licences(spark):
    return license_families.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def scanned(spark, licences, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = license_families.scan(frame, licences).collect()
    return [sorted((r["start_byte"], r["end_byte"], r["family"]) for r in rows if r["doc_id"] == i) for i in range(len(texts))]


def test_wrapped_notices(spark, licences):
    lines = GPL.split("\n")
    end = len("\n".join(lines[:2])) + 1
    texts = [GPL, f"Some tool.\n\n{GPL}\n\nMore text here."]
    got = scanned(spark, licences, texts)
    assert got == [[(0, end, "GPL")], [(12, 12 + end, "GPL")]]
    for sign in ("# ", " * ", "// ", "-- ", "rem "):
        text = "\n".join(sign + line for line in lines)
        assert [f for _, _, f in scanned(spark, licences, [text])[0]] == ["GPL"], sign
    lesser = GPL.replace("GNU General", "GNU Lesser General").replace("Public License as", "Public\nLicense as")
    assert [f for _, _, f in scanned(spark, licences, [lesser])[0]] == ["LGPL"]


def test_every_template_wrapped(spark, licences):
    """Each notice at every width from one word a line on."""
    texts, families = [], []
    for family, notices in license_families.TEMPLATES.items():
        for notice in notices:
            if [f for _, _, f in scanned(spark, licences, [notice])[0]] != [family]:
                continue
            for width in (1, 12, 20, 30, 45):
                wrapped = textwrap.fill(notice, width, break_long_words=False)
                texts.append(f"a first line of other words\n{wrapped}\nand a last one")
                families.append(family)
    got = scanned(spark, licences, texts)
    missed = [t for t, f, g in zip(texts, families, got) if f not in {x for _, _, x in g}]
    assert not missed and len(texts) > 100


def test_borders(spark, licences):
    got = scanned(spark, licences, [
        "Licensed under the\n\nMIT License", "Licensed under the\r\nMIT License",
        "Licensed under the MIT\nLicense. All\nrights reserved.", "a licence is\nno matter here",
    ])
    assert [sorted(f for _, _, f in g) for g in got] == [[], ["MIT"], ["MIT", "Proprietary"], []]
