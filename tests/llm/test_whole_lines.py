"""Licence notices inside long lines, several in a line, wrapped and behind comment signs."""

import textwrap

import pytest

from storelens.llm import license_families as lf

FILL = "the river was long and the people of the town went to the market every day in the summer because it was warm and bright there"


@pytest.fixture(scope="module")
def classifier():
    return lf.fit([FILL])


def found(spark, classifier, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {i: set() for i in range(len(texts))}
    spans = {}
    for r in lf.scan(df, classifier).collect():
        assert r["family"] not in out[r["doc_id"]] or r["start_byte"] != spans[r["doc_id"], r["family"]][0]
        out[r["doc_id"]].add(r["family"])
        spans[r["doc_id"], r["family"]] = (r["start_byte"], r["end_byte"])
    return out, spans


def test_every_notice_alone_in_long_lines_wrapped_and_commented(spark, classifier):
    notices = [(family, n) for family, own in lf.TEMPLATES.items() for n in own]
    shapes = {
        "alone": lambda n: n,
        "long": lambda n: f"{FILL} {FILL} {n} {FILL} {FILL}",
        "wrapped": lambda n: "\n".join(textwrap.wrap(n, 40)),
        "commented": lambda n: "\n".join(f"// {line}" for line in textwrap.wrap(n, 40)),
    }
    texts = [shape(n) for shape in shapes.values() for _, n in notices]
    out, _ = found(spark, classifier, texts)
    missed = []
    for i, text in enumerate(texts):
        if notices[i % len(notices)][0] not in out[i]:
            missed.append(text)
    assert len(missed) <= 0.02 * len(texts), missed
    other = sum(len(own - {notices[i % len(notices)][0]}) for i, own in out.items())
    assert other <= 0.02 * len(texts)


def test_the_grant_on_one_line(spark, classifier):
    grant = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, subject to the following conditions:"
    )
    out, spans = found(spark, classifier, [grant, f"{FILL} {FILL}. {grant} {FILL}"])
    assert out == {0: {"MIT"}, 1: {"MIT"}}
    start, end = spans[1, "MIT"]
    assert (f"{FILL} {FILL}. {grant} {FILL}".encode()[start:end].decode()).startswith("Permission is hereby granted")


def test_several_families_in_a_line(spark, classifier):
    texts = [
        "Dual licensed under the MIT License and the Apache License, Version 2.0",
        f"Licensed under the BSD 3-Clause License {FILL} Licensed under the Mozilla Public License, version 2.0",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "/* SPDX-License-Identifier: ISC */ int main",
    ]
    out, _ = found(spark, classifier, texts)
    assert out == {0: {"MIT", "Apache-2.0"}, 1: {"BSD", "MPL-2.0"}, 2: {"GPL"}, 3: {"ISC"}}


def test_other_senses(spark, classifier):
    texts = [*lf.OTHER, FILL, f"{FILL} " * 20, "the SPDX license identifier list is long", "rights reserved seats all over the hall", ""]
    out, _ = found(spark, classifier, texts)
    assert not any(out.values())
