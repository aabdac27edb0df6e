"""Vector operators against all pairs, page extraction against pages with known articles."""

import numpy as np
import pytest

from sparkassay.llm import capfilters, graph, kdtree, tagpaths

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector int"


def vectors(spark, extra=()):
    rng = np.random.default_rng(5)
    rows = rng.standard_normal((260, 16))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    for i in range(200, 260):
        rows[i] = rows[i % 20] + rng.standard_normal(16) * 0.07
    rows[250:256] = rows[7]
    data = [(int(i), [float(np.float32(x)) for x in row], 1, "x", 0) for i, row in enumerate(rows)]
    odd = [(300, None), (301, [0.0] * 16), (302, [None] + [0.1] * 15), (400, [float("nan")] * 16), (304, [float("inf")] * 16), (305, []), (306, [0.5] * 3)]
    data += [(i, v, 1, "x", 0) for i, v in odd] + list(extra)
    return spark.createDataFrame(data, SCHEMA).repartition(4), data


def test_top_k_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(kdtree, "LEAF", 4)
    table, data = vectors(spark)
    got = kdtree.top_k(table, table.where("vec_id % 20 = 0"), k=10, shard_rows=50, block_queries=5).collect()
    good = [(i, np.floor(1024 * np.array(v, float)).astype(np.int64)) for i, v, *_ in data if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q, v in good:
        if q % 20:
            continue
        best = sorted(((-int(v @ w), i) for i, w in good if i != q and len(w) == len(v)))[:10]
        assert by.pop(q, []) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert not by


def test_huge_components_do_not_overflow(spark):
    data = [(i, [1e30 * (i - 2), 1.0], 0, "", 0) for i in range(5)]
    table = spark.createDataFrame(data, SCHEMA)
    got = kdtree.top_k(table, table.where("vec_id = 0")).collect()
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])][0] == 1


def test_links_and_components_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(capfilters, "PART", 8)
    table, data = vectors(spark)
    got = {r["vec_id"]: r for r in capfilters.near_vectors(table).collect()}
    assert len(got) == len(data)
    good = [(i, np.array(v, float)) for i, v, *_ in data if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: [] for i, *_ in data}
    for i, v in good:
        for j, w in good:
            if i != j and len(v) == len(w) and v @ w >= 0.9 * np.linalg.norm(v) * np.linalg.norm(w):
                links[i].append(j)
    assert sum(map(len, links.values())) > 100
    for i, own in links.items():
        reach, todo = {i}, [i]
        while todo:
            new = [j for j in links[todo.pop()] if j not in reach]
            reach.update(new)
            todo += new
        r = got[i]
        assert (r["n_links"], r["component_id"], r["kept"]) == (len(own), min(reach), min(reach) == i)


def test_components_of_long_paths(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (200, None)]
    table = spark.createDataFrame(pairs, "a long, b long")
    got = {r["id"]: r["component"] for r in graph.components(table).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_vector_operators_on_an_empty_table(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert kdtree.top_k(table, table).count() == 0 and capfilters.near_vectors(table).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1><nav><ul><li><a href="/">Home</a></ul></nav></header><div class="cookie-notice">We use cookies, ok?</div>
<div id="sidebar"><p>Popular posts, many words here, really.</p></div>%s<form><p>Your name</p><input></form>
<div class="comments"><article class="comment"><p>First! I like it a lot, truly.</p></article></div>
<footer>&copy; 2020 &middot; Site</footer></body></html>"""
ARTICLE = "<h2>A   title</h2><p>One &amp; two,\n three.<p><b>Four<br>five <a href='x'>six</a>.</b></p><div class='ad'>Buy!</div><p>Short.</p>"
BLOCKS = ["A title", "One & two, three.", "Four five six.", "Short."]


@pytest.mark.parametrize("body", [f"<article>{ARTICLE}</article>", f"<main><div>{ARTICLE}</div></main>", f"<article>{ARTICLE}"])
def test_article_is_found(body):
    got = tagpaths.main_blocks(PAGE % body) if body.endswith(">") and "</" in body[-10:] else tagpaths.main_blocks(PAGE % body)
    assert got[:4] == BLOCKS


def test_paths_decide_without_an_article_element():
    text = "".join(f"<p>Sentence {i}, with some words, and more of them, as prose has.</p>" for i in range(8))
    links = "".join(f"<li><a href='/{i}'>Link number {i} of a long list of links</a></li>" for i in range(8))
    got = tagpaths.main_blocks(f"<body><div><ul>{links}</ul></div><div><section>{text}</section></div></body>")
    assert got == [f"Sentence {i}, with some words, and more of them, as prose has." for i in range(8)]


def test_pages_with_odd_rows(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "plain text, no markup.", "x"), (3, "u", "<article><p>a</p><p>a</p></article>", "x"), (None, "u", "<script>x", "x")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = tagpaths.extract_main_text(table).collect()
    assert sorted(r["text"] for r in got) == ["", "", "", "a\n\na", "plain text, no markup."]
    assert tagpaths.extract_main_text(table.limit(0)).count() == 0
