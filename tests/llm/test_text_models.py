"""Main text, language and quality: brute force on small inputs, held-out accuracy, edge rows."""

from __future__ import annotations

import html
import itertools
import re
import time

import numpy as np
import pytest

from cyclewise.llm import langid, rule_quality, tag_paths
from cyclewise.llm.queries import QUERIES
from tests.llm.edge import SCHEMA, edge_docs


def test_main_text_equals_marked_article(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op6_main_text"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        inner = re.sub(r"</?(p|h1)>", "\0", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
        blocks = (" ".join(html.unescape(x).split()) for x in inner.split("\0"))
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_article_is_found_without_its_tags(spark, sf_dir, monkeypatch):
    """Element names that tell the parts apart become div: paths and lengths decide alone."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    plain = {k: re.sub(r"<(/?)(article|nav|header|footer|aside|main)\b", r"<\1div", h) for k, h in pages.items()}
    right = {k: tag_paths.main_text(plain[k]) == tag_paths.main_text(pages[k]) for k in pages}
    assert sum(right.values()) >= 0.9 * len(pages)
    assert all(right[k] for k in pages if len(tag_paths.main_text(pages[k])) > 300)
    monkeypatch.setattr(tag_paths, "PATH_SHARE", 0.0)
    assert sum(tag_paths.main_text(plain[k]) != tag_paths.main_text(pages[k]) for k in pages) > 0.9 * len(pages)


LONG = "A long story, told in full; with many words, and signs. It goes on, and on, and it does not end here."


@pytest.mark.parametrize(
    "page",
    [
        "<article class=a><h1>Title</h1><p>{0}</p><p>{0}</p></article><article class=a><p>Other story teaser.</p></article>",
        "<div><a href=x>Home</a></div><div><h1>Title</h1><p>{0}</p><p>{0}</p></div><div><a>About</a></div>",
        "<body><div><ul><li><a>One</a><li><a>Two</a></ul></div><div><h1>Title</h1><section><p>{0}</p></section>"
        "<section><p>{0}</p></section></div><div>&copy; somebody, 2020. All rights, reserved.</div>",
        "<div><h1>Title</h1><div class=share>Share this, now.</div><p>{0}</p><p>{0}</p></div><div>Short end.</div>",
        "<b><i><h1>Title</h1></i></b><p>{0}<p>{0}<div class='comment'><p>{0}</p></div>",
    ],
)
def test_parts_beside_the_article(page):
    assert tag_paths.main_text(page.format(LONG)) == f"Title\n\n{LONG}\n\n{LONG}"


def test_short_parts_of_an_article_stay():
    page = f"<div><h1>T</h1><p>{LONG}</p><ul><li>x</li><li>y</li></ul><section><p>Yes.</p></section><p>{LONG}</p></div><div>No.</div>"
    assert tag_paths.main_text(page) == f"T\n\n{LONG}\n\nx\n\ny\n\nYes.\n\n{LONG}"


def _naive_scores(page):
    """The five steps on paths as strings, with ancestors walked for every block."""
    blocks = tag_paths.blocks_of(page)

    def line(e):
        return [] if e is None else [*line(e.parent), e]

    def path(e):
        return tuple(x.path for x in line(e) if x.block is x)

    paths = [b.path for b in blocks]
    marks = [len(re.findall(r"[.,;:!?…。，；：！？¿¡]", b.text)) for b in blocks]

    def mean(values, p):
        own = [v for v, q in zip(values, paths) if q == p]
        return sum(own) / len(own)

    final = []
    own = []
    for i, b in enumerate(blocks):
        near = [(j, np.exp(-((i - j) ** 2) / 2)) for j in range(len(blocks)) if abs(i - j) <= 2]
        weight = [
            w * (1 if paths[i] == paths[j] else 0.5 if blocks[j].element.above == b.element.above else 0.1) for j, w in near
        ]
        length = sum(w * mean([len(x.text) for x in blocks], paths[j]) for w, (j, _) in zip(weight, near)) / sum(weight)
        signs = sum(w * mean(marks, paths[j]) for w, (j, _) in zip(weight, near)) / sum(weight)
        links = sum(x.linked for x, q in zip(blocks, paths) if q == paths[i])
        chars = sum(len(x.text) for x, q in zip(blocks, paths) if q == paths[i])
        factor = 0.0 if b.element.aside else 1 - (1 - tag_paths.LINK_FACTOR) * links / chars
        own.append(factor * min(length * (1 + signs), len(b.text) * (1 + marks[i])))

    def node(e):
        inside = [(len(b.text), o) for b, o in zip(blocks, own) if e in line(b.element) and not b.element.aside]
        score = 0.0
        if inside and e.tag not in ("", "html", "body"):
            score = sum(n * o for n, o in inside) / sum(n for n, _ in inside)
        if e.parent is not None and not e.aside and e.tag != "article":
            score = max(score, 0.5 * node(e.parent))
        return score

    for b, o in zip(blocks, own):
        final.append(max(o, node(b.element)) if not b.element.aside else o)
    for i in reversed(range(len(blocks) - 1)):
        a, b = blocks[i].element, blocks[i + 1].element
        if a.tag in ("h1", "h2") and not a.aside and a.above == b.above:
            final[i] = max(final[i], 0.5 * final[i + 1])
    return final


def test_node_scores_equal_naive_ones():
    rng = np.random.default_rng(2)
    for _ in range(60):
        page, open_tags = "", []
        for _ in range(int(rng.integers(5, 40))):
            kind = rng.integers(0, 4)
            if kind == 0:
                tag = str(rng.choice(["div", "p", "ul", "li", "section", "article", "h1", "h2", "div class=ad", "div class=x", "a", "b"]))
                page += f"<{tag}>"
                open_tags.append(tag.split()[0])
            elif kind == 1 and open_tags:
                page += f"</{open_tags.pop()}>"
            else:
                page += " ".join(rng.choice(["one", "two,", "three.", "four!"], int(rng.integers(1, 12)))) + " "
        elements, blocks = tag_paths._read(page)
        assert tag_paths.node_scores(elements, blocks)[0] == pytest.approx(_naive_scores(page))


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "deep, text.", "<div><p>" * 50_000 + "x", "<span>" * 50_000 + "<p></p>" * 50_000,
        "<div>" * 50_000 + "</span>" * 100_000, "<p><table><td>" + "<b>" * 50_000 + "<p>x</p>" * 50_000,
        "<a '" * 100_000, "<!--" * 100_000, "<li>" * 100_000, "<" * 300_000, "<p>" + "word, " * 300_000,
    ],
)
def test_hostile_pages_take_linear_time(page):
    started = time.perf_counter()
    tag_paths.main_text(page)
    assert time.perf_counter() - started < 5


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("<script>if(a<b){}</script><p></p>", ""), ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b<ul><li>x<li>y</ul>", "a\n\nb\n\nx\n\ny"), ("<div>1 < 2<br>next&nbsp;one</div>", "1 < 2 next one"),
        (
            "<body><header><h1>Site</h1></header><nav><a>Home, page</a></nav><div id=content><h2>Title</h2>"
            "<p>One, two.</p><p>Three <i>four</i> &lt;b&gt;.</p><div class='user-comments'><p>Nice, really nice!</p></div>"
            "</div><aside>Side, side.</aside><form><p>Name, please.</p></form><div class='cookie-notice'>Cookies, ok.</div>",
            "Title\n\nOne, two.\n\nThree four <b>.",
        ),
        ("<main><header><h1>T</h1><p>By me</p></header><p>Body.</p><footer>f</footer></main>", "T\n\nBody."),
    ],
)
def test_main_text_of_odd_pages(page, text):
    assert tag_paths.main_text(page) == text


def test_main_text_edge_rows(spark):
    rows = [(None, None, None), (1, "u", "<p>x</p>"), (1, "u", "<p>x</p>"), (2, None, "<p>" * 3_000 + "deep")]
    got = tag_paths.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in got) == [
        ("1", "x", 1), ("1", "x", 1), ("2", "deep", 4), ("None", "", 0)
    ]
    assert tag_paths.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_best_paths_equal_exhaustive_search():
    rng = np.random.default_rng(1)
    for _ in range(60):
        sizes = rng.integers(0, 7, 4)
        first = np.concatenate([[0], np.cumsum(sizes)])
        scores = rng.normal(0, 4, (first[-1], 3)).astype(np.float32)
        states = langid.best_paths(scores, first, 5.0)
        for lo, hi in zip(first[:-1], first[1:]):
            def value(path):
                return sum(scores[lo + i][s] for i, s in enumerate(path)) - 5.0 * sum(a != b for a, b in zip(path, path[1:]))

            best = max(value(p) for p in itertools.product(range(3), repeat=int(hi - lo)))
            assert value(tuple(states[lo:hi])) == pytest.approx(best, abs=1e-3)


@pytest.mark.parametrize("text", ["\U0001f600 \U0001f680", "\u2764\ufe0f", "\u0301", "1\ufe0f\u20e3 23", "\U000e0101"])
def test_signs_and_lone_marks_are_no_words(text):
    words = langid.Words([text, "a\u0301b " + text + " c", "\U00020000"])
    assert list(words.first_word) == [0, 0, 2, 3]
    assert list(words.end - words.begin) == [3, 1, 1]


def test_language_of_held_out_texts(spark, sf_dir):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op8_language"](spark, sf_dir).collect() if r["held_out"]]
    assert rows and np.mean([lang[r["doc_id"]] == r["lang_pred"] for r in rows]) > 0.95


def test_mixed_text_has_spans(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.learn(docs)
    en, de = (docs.filter(f"lang = '{x}' AND n_chars > 800").first()["text"][:600] for x in ("en", "de"))
    (lang, score, spans), = model.label([en + " " + de])
    assert {s[2] for s in spans} == {"en", "de"} and 0.4 < score < 0.7
    assert abs(spans[0][1] - 600) < 60


def test_scripts_narrow():
    import pandas as pd

    counts = pd.concat([
        f.assign(lang=lang) for lang, text in (("el", "ένα δύο τρία " * 20), ("ru", "один два три " * 20))
        for f in langid._count(iter([pd.DataFrame({"lang": [lang], "text": [text]})]))
    ])
    model = langid.LanguageModel(counts)
    assert [x[0] for x in model.label(["два", "δύο ένα", "12 !!", "両方"])][:3] == ["ru", "el", "und"]


def test_language_edge_rows(spark):
    docs = edge_docs(spark)
    rows = langid.identify(docs).collect()
    assert len(rows) == docs.count()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 4, 6)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert langid.identify(spark.createDataFrame([], SCHEMA)).count() == 0
    nobody = docs.withColumn("lang", docs["lang"].substr(9, 1)).selectExpr("*", "nullif(lang, '') AS l").drop("lang").withColumnRenamed("l", "lang")
    assert {r["lang_pred"] for r in langid.identify(nobody).collect()} == {"und"}


def test_quality_on_held_out_labels(spark, sf_dir):
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op10_quality"](spark, sf_dir).collect() if r["held_out"] and r["doc_id"] in label]
    assert np.mean([r["predicted"] == label[r["doc_id"]] for r in rows]) > 0.9
    good = [r["score"] for r in rows if label[r["doc_id"]] == 1]
    poor = [r["score"] for r in rows if label[r["doc_id"]] == 0]
    assert good and poor and np.mean([g > b for g in good for b in poor]) > 0.95  # area under the curve
    assert np.mean([s < rule_quality.CUT for s in poor]) > 0.5
    assert all((r["score"] >= 0.3) == (r["predicted"] == 1) for r in rows)


def test_rules_are_tree_paths():
    text = (
        "Model\n  Tree 0 (weight 1.0):\n    If (feature 0 <= 0.5)\n     If (feature 1 <= 2.0)\n      Predict: 0.0\n"
        "     Else (feature 1 > 2.0)\n      Predict: 1.0\n    Else (feature 0 > 0.5)\n     Predict: 1.0\n"
    )
    rules = rule_quality.rules_of(text, ["a", "b"])
    assert [r.bounds for r in rules] == [
        (("a", None, 0.5),), (("a", None, 0.5), ("b", None, 2.0)), (("a", None, 0.5), ("b", 2.0, None)), (("a", 0.5, None),)
    ]


def test_quality_edge_rows(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (5, None, 0), (6, 0, 0), (7, 1, 1), (99, 0, 0), (None, 0, 0), (8, 7, 0)],
        "doc_id long, quality int, toxic int",
    )
    rows = rule_quality.classify(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    same = rule_quality.classify(docs, labels.filter("quality = 1")).collect()
    assert {r["score"] for r in same} == {1.0}
    none = rule_quality.classify(docs, labels.filter("doc_id = 99")).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.5, 1)}
    assert rule_quality.classify(spark.createDataFrame([], SCHEMA), labels).count() == 0
