"""The trained operators: held-out accuracy, exact parts, edge rows."""

import hashlib
import re

import numpy as np
import pytest

from storelens.llm import attention_quality, license_families, mincut_html, secret_cnn

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_quality_held_out(spark, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = attention_quality.train(docs, labels)
    rows = attention_quality.score(docs, model).join(labels, "doc_id").where(attention_quality.held_out()).collect()
    assert len(rows) > 80 and sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    good = np.mean([r["score"] for r in rows if r["quality"] == 1])
    assert good > 0.8 > 0.4 > np.mean([r["score"] for r in rows if r["quality"] == 0])
    again = attention_quality.train(docs.repartition(5), labels.repartition(3))
    assert all(np.allclose(model.weights[k], again.weights[k]) for k in model.weights)

    edge = spark.createDataFrame([(1, None, 0.1), (None, "", 0.2), (3, "a b " * 9000, 0.3)], "doc_id long, text string, score double")
    got = attention_quality.score(edge, model).collect()
    assert len(got) == 3 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    kept = attention_quality.keep_good(edge, model)
    assert kept.columns == edge.columns and kept.count() == sum(r["predicted"] for r in got)


def test_quality_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = attention_quality.train(docs, none)
    assert {r["score"] for r in attention_quality.score(docs.limit(5), model).collect()} == {0.5}


def test_attention_gradient():
    """A good passage among bad ones decides, wherever it stands."""
    rng = np.random.default_rng(1)
    bags, labels = [], []
    for i in range(600):
        bag = rng.normal(0, 1, (rng.integers(1, 6), attention_quality.FEATURES))
        bag[:, 0] = -1
        if i % 2:
            bag[rng.integers(len(bag)), 0] = 3
        bags.append(bag)
        labels.append(i % 2)
    model = attention_quality.fit(bags[:400], np.array(labels[:400], dtype=float))
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags[400:]])])
    found = model.score(np.concatenate(bags[400:]), first) >= 0.5
    assert (found == np.array(labels[400:])).mean() > 0.95


@pytest.fixture(scope="module")
def network(docs):
    return secret_cnn.train(docs)


def spans_by_hand(text):
    patterns = {
        "assign": r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        "access": r"AKIA[A-Z0-9]+",
        "hex": r"[0-9a-f]+",
    }
    found = []
    for order, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text, re.ASCII):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def test_secret_rules_and_model(spark, network):
    rng = np.random.default_rng(2)
    key = "".join(rng.choice(list("ABCdef0123456789xyzQRS"), 40))
    texts = [
        None, "", "token = abc secret=token:abcdef", 'é API_KEY: "abcd_efgh" x', "apikey=''x password :  hunter22",
        "AKIA" + "Z" * 16 + " AKIA12", "0123456789abcdef01234567 and 0123456789ABCDEF01234567",
        'token="' + "ab12" * 10 + '"', f"unknown words then {key} and the end", "PASSWD=ſecret tOkEn=abcdef",
        "plain words without any number at all, only long-hyphenated-words-of-a-kind",
    ]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    rows = {r["doc_id"]: r for r in secret_cnn.find_secrets(frame, network).collect()}
    for i, text in enumerate(texts):
        base = spans_by_hand(text or "")
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        kept = [s for s in rows[i]["spans"].split(",") if s and not s.startswith("model")]
        assert kept == base
        assert rows[i]["n_assign"] == sum(s.startswith("assign") for s in base)
    assert rows[8]["n_model"] == 1 and rows[10]["n_model"] == 0
    clean = {r["doc_id"]: r["text"] for r in secret_cnn.redact(frame, network).collect()}
    assert clean[0] is None and clean[10] == texts[10] and key not in clean[8]
    assert clean[8] == "unknown words then [SECRET] and the end"


def test_secret_network_held_out(network):
    made, labels = secret_cnn.generated(600, seed=77)
    scores = network.score(np.stack([secret_cnn.window(t, at) for t, at in made]))
    labels = np.array(labels)
    assert (scores[labels == 1] >= network.threshold).mean() > 0.9
    assert (scores[labels == 0] >= network.threshold).mean() < 0.05


@pytest.fixture(scope="module")
def licences(docs):
    return license_families.train(docs)


def test_licences(spark, docs, licences):
    found = license_families.scan(docs, licences).collect()
    lines = {r["doc_id"]: r["text"] for r in docs.collect()}
    grants = re.compile(r"(?i)licen[sc]ed? under|released under|rights reserved")
    assert {r["doc_id"] for r in found} == {i for i, t in lines.items() if grants.search(t)}
    for r in found:
        line = lines[r["doc_id"]].encode()[r["start_byte"] : r["end_byte"]].decode()
        for part, family in (("MIT", "MIT"), ("Apache", "Apache-2.0"), ("GNU General", "GPL"), ("BY-NC", "CC-BY-NC")):
            if part in line:
                assert r["family"] == family
    rows = [
        (1, None), (2, ""), (3, "The driver license must be renewed.\nReleased under the GPL version 3.\n"),
        (None, "Licensed under CC BY-SA 4.0."), (4, "licensed under license under"), (5, "no notice\n\n\nat all"),
        (3, "x\nAll rights reserved."),
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, family string")
    got = sorted((r["doc_id"] or 0, r["family"]) for r in license_families.scan(frame, licences).collect())
    assert got == [(0, "CC-BY-SA"), (3, "GPL"), (3, "Proprietary")]


def test_licence_classifier_held_out(licences):
    lines, labels = license_families._examples([], seed=99)
    row, _, _, runs = license_families._of_lines(lines)
    best = licences.probabilities(len(lines), runs).argmax(axis=1)
    assert (best == labels).mean() > 0.93


def cut_by_hand(gain, edges):
    """The least cut by trying all labellings."""
    n, best = len(gain), None
    for code in range(1 << n):
        kept = [code >> i & 1 for i in range(n)]
        cost = sum(g * (1 - k) if g > 0 else -g * k for g, k in zip(gain, kept))
        cost += sum(w for a, b, w in edges if kept[a] != kept[b])
        best = cost if best is None else min(best, cost)
    return best


def test_minimum_cut_is_least():
    rng = np.random.default_rng(3)
    for _ in range(150):
        n = int(rng.integers(1, 9))
        gain = rng.normal(0, 2, n).tolist()
        edges = [(a, b, float(rng.random() * 2)) for a in range(n) for b in range(a) if rng.random() < 0.5]
        kept = mincut_html.min_cut(gain, edges)
        cost = sum(g * (not k) if g > 0 else -g * k for g, k in zip(gain, kept))
        cost += sum(w for a, b, w in edges if kept[a] != kept[b])
        assert cost == pytest.approx(cut_by_hand(gain, edges))


def test_main_text(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    weights = mincut_html.train(pages)
    import html

    got = {r["page_id"]: r["text"] for r in mincut_html.extract(pages, weights).collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*)</article>", page["html"], re.S)[1]
        spaced = re.sub(r"</?(p|h1|br)[^>]*>", " ", article)
        assert got[page["page_id"]] == " ".join(html.unescape(re.sub(r"<[^>]+>", "", spaced)).split())
    page = (
        "<div id='top-menu'><a href=x>Home</a><a href=y>News</a></div><div class=story><h2>Title</h2>"
        "<p>First paragraph &lt;1&gt;,\n with words. It goes<br>on.<p>Second &amp; last, which ends here.</p>"
        "<script>var t='</p>';</script><div class='ad'>Buy now</div></div>"
        "<div id=comments><p>I liked this a lot.</p></div><div class='cookie-notice'>We use cookies</div>"
    )
    assert mincut_html.main_text(page, weights) == (
        "Title First paragraph <1>, with words. It goes on. Second & last, which ends here."
    )
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>Just one paragraph here, with a text."), (3, "u", "<nav>Menu"), (3, "u", "<nav>Menu")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    out = mincut_html.extract(frame, weights).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in out) == [
        (0, "Just one paragraph here, with a text.", 37), (1, "", 0), (2, "", 0), (3, "", 0), (3, "", 0)
    ]
    assert mincut_html.extract(spark.createDataFrame([], "page_id long, url string, html string"), weights).collect() == []
