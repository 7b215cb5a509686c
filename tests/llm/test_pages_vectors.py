from __future__ import annotations

import collections
import html
import random

import numpy as np
import pytest

from edops.llm import html_extract as H, nn_descent
from llm_helpers import prose


def page(seed):
    draw = random.Random(seed)
    blocks = [prose(seed * 10 + i, draw.randint(1, 40)) + draw.choice([".", " &", " <x>"]) for i in range(draw.randint(1, 6))]
    title = prose(seed + 9000, 5)
    nav = "".join(f"<li><a href='/{i}'>{prose(seed + i, 1)}</a></li>" for i in range(5))
    body = "".join(f"<p>{html.escape(b)}</p>\n" for b in blocks)
    parts = [
        f"<html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>",
        f"<nav><ul>{nav}</ul></nav>",
        f"<div class='ad'>{prose(seed + 7000, 9)}</div><!-- note <p>no</p> -->",
        f"<article><h1>{title}</h1>{body}</article>",
        f"<div class='comments'><p>{prose(seed + 8000, 12)}</p></div><footer>{prose(seed + 6000, 6)}</footer></body></html>",
    ]
    return "".join(parts), "\n".join([title, *blocks])


def test_articles_of_marked_and_of_plain_pages(spark):
    pages = [(i, f"u{i}", page(i)[0]) for i in range(80)]
    plain = [(100 + i, f"u{i}", page(i)[0].replace("article>", "div>").replace("nav>", "div>")) for i in range(80, 120)]
    got = {r["key"]: (r["text"], r["n_chars"]) for r in run(spark, pages + plain)}
    right = sum(got[i][0] == page(i)[1] for i in range(80)) + sum(got[100 + i][0] == page(i)[1] for i in range(80, 120))
    assert right >= 114  # of 120
    assert all(n == len(text) for text, n in got.values())


def run(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    if extra:
        df = df.selectExpr("*", "'x' as text", "1 as key", "2 as n_chars")
    return H.extract(df, sample=60).collect()


@pytest.mark.parametrize("extra", [False, True])
def test_odd_pages(spark, extra):
    odd = ["", None, "just text", "<p>a &lt; b\n c<p>d", "<article>cut <b>off", "<script>never closed", "<<>< a='", "</p></div>x" * 3000]
    rows = [(i, None if i % 2 else "u", h) for i, h in enumerate(odd)] + [(3, "u", odd[3]), (None, "u", page(1)[0])]
    got = run(spark, rows, extra)
    assert collections.Counter(r["key"] for r in got) == collections.Counter(r[0] for r in rows)
    by_key = collections.defaultdict(set)
    for r in got:
        by_key[r["key"]].add(r["text"])
    assert by_key[0] == by_key[1] == {""} and len(by_key[3]) == 1


def test_no_pages_and_no_article_to_learn_from(spark):
    assert run(spark, []) == []
    got = run(spark, [(1, "u", "<nav><a>m</a></nav><p>one</p><p>two <a>l</a> words</p>")])
    assert got[0]["text"] == "one\ntwo l words"


DROPPED_CASES = {
    "svg closed in its tag": '<svg class="i"/>',
    "svg": "<svg><title>logo</title><path d='M0>1'/><text>no</text></svg>",
    "unclosed svg": "<svg class=i><path/>",
    "unclosed iframe": "<iframe src='x'>",
    "unclosed object": "<object data='x'><param name=a>",
    "unclosed canvas": "<canvas id=c>",
    "unclosed title": "<title>",
    "unclosed template": "<template>",
    "unclosed, then a closed one": "<iframe src=x><iframe src=y>no</iframe>",
    "nested objects": "<object><object>no</object>no</object>",
    "nested select": "<select><option>no<select><option>no</select></select>",
    "select without end": "<select><option>no<option>no",
    "close tag in a comment": "<iframe src=x><!-- </iframe> -->",
    "close tag in a script": "<canvas><script>var a = '</canvas>';</script>",
}


@pytest.fixture(scope="module")
def fitted():
    """Pages, trees fitted on them, and what the trees take."""
    rows = [page(i)[0] for i in range(60)]
    nodes, labels = H.sample_nodes(rows)
    x = H.features(nodes)
    model = H.fit_trees(x, labels.astype(float), x[:, len(H._GROUPS) + 1] + 0.1)
    plain = H.extract_batch(rows, model)
    assert sum(text == page(i)[1] for i, text in enumerate(plain)) >= 57
    return rows, model, plain


@pytest.mark.parametrize("case", DROPPED_CASES)
def test_no_text_is_lost_after_a_dropped_element(fitted, case):
    """The same article with the element at its start, and both sides of it inside a line."""
    rows, model, plain = fitted
    odd = H.extract_batch([r.replace("<article>", "<article>" + DROPPED_CASES[case]) for r in rows], model)
    assert sum(a == b for a, b in zip(odd, plain)) >= 57
    inside = H.extract_batch([r.replace("</h1>", f"</h1><p>before {DROPPED_CASES[case]} <b>after</b></p>") for r in rows], model)
    assert sum({"before", "after"} <= set(t.split()) and "no" not in t.split() for t in inside) >= 57


def test_a_head_that_never_ends_keeps_the_page():
    for source in ("<head><title>t</title><p>one two</p>", "<head><title>t<body><p>one two</p>", "<title>t</head><p>one two</p>"):
        nodes = H.Nodes()
        H.parse(source, nodes, 0)
        assert [t for t in nodes.text if t] == ["one two"]


def test_a_page_above_the_slice_size(spark):
    """The longest page is read whole: its article comes out to the last word."""
    blocks = [prose(i, 200) for i in range(1200)]
    long = "<html><body><article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article></body></html>"
    assert len(long) > 1 << 20
    got = {r["key"]: r["text"] for r in run(spark, [(i, f"u{i}", page(i)[0]) for i in range(80)] + [(999, "u", long)])}
    assert got[999] == "\n".join(blocks)


def test_decoding_never_keeps_below_a_dropped_node():
    nodes = H.Nodes()
    H.parse(page(3)[0], nodes, 0)
    for seed in range(20):
        odds = np.random.default_rng(seed).normal(size=len(nodes.tag)) * 3
        keep = H.decode(nodes, odds)
        for i, p in enumerate(nodes.parent):
            assert not keep[i] or p < 0 or keep[p]


def test_parser_closes_like_a_browser():
    nodes = H.Nodes()
    H.parse("<p>a<b>b<p>c<ul><li>d<li>e<ul><li>f</ul></ul><table><tr><td>g<td>h</table>i", nodes, 0)
    where = {t: nodes.tag[nodes.parent[i]] + str(nodes.depth[i]) for i, t in enumerate(nodes.text) if t}
    assert where == {"a": "p2", "b": "b3", "c": "p2", "d": "li3", "e": "li3", "f": "li5", "g": "td4", "h": "td4", "i": "html1"}


def brute_links(rows, threshold=0.95):
    """(key, links, component) of every row."""
    vectors = []
    for _, v in rows:
        v = np.array([np.nan if x is None else x for x in v or []], float)
        vectors.append(v / np.linalg.norm(v) if len(v) and np.isfinite(v).all() and v.any() else None)
    links = [[j for j, w in enumerate(vectors) if j != i and v is not None and w is not None and len(v) == len(w) and v @ w >= threshold] for i, v in enumerate(vectors)]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            todo = [j for j in {j for t in todo for j in links[t]} if j not in seen]
            seen.update(todo)
        out.append((rows[i][0], len(links[i]), min(rows[j][0] for j in seen)))
    return sorted(out)


def near(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "1 as id", "'x' as key")
    return sorted((r["key"], r["n_links"], r["component"]) for r in nn_descent.near_duplicates(df).collect())


def test_links_of_groups_pairs_and_odd_vectors(spark):
    draw = np.random.default_rng(2)
    rows, key = [], 0
    for size in (1, 1, 2, 2, 3, 12, 90):
        for _ in range(6 if size < 12 else 1):
            centre = draw.normal(size=24)
            for _ in range(size):
                rows.append((1000 - key, [float(np.float32(x)) for x in centre + 0.1 * draw.normal(size=24)]))
                key += 1
    rows += [(2000 + i, rows[0][1]) for i in range(5)] + [(3000, None), (3001, []), (3002, [0.0] * 24), (3003, [1.0] * 23 + [None])]
    rows += [(3004, [float("nan")] + [1.0] * 23), (3005, [float("inf")] + [1.0] * 23), (3006, [1.0, 2.0]), (3007, [2.0, 4.0])]
    draw.shuffle(rows)
    rows = [(int(k), None if v is None else [None if x is None else float(x) for x in v]) for k, v in rows]
    assert near(spark, rows) == brute_links(rows)


def crowd(draw, centre, n, spread):
    """Distinct near copies of a unit vector."""
    return [[float(x) for x in centre + spread * draw.normal(size=len(centre))] for _ in range(n)]


def test_groups_that_fill_their_lists_and_touch(spark):
    """Groups of over 100 whose lists hold nothing of each other: two linked, one too far from both."""
    draw, axes = np.random.default_rng(3), np.eye(24)
    at = lambda cosine, axis: cosine * axes[0] + np.sqrt(1 - cosine**2) * axes[axis]
    vectors = crowd(draw, axes[0], 110, 0.003) + crowd(draw, at(0.96, 1), 110, 0.003) + crowd(draw, at(0.90, 2), 110, 0.003)
    rows = list(enumerate(vectors))
    want = brute_links(rows)
    assert {c for _, _, c in want} == {0, 220} and {n for _, n, _ in want} == {219, 109}
    assert near(spark, rows) == want


def test_links_that_the_rounds_miss_are_found(spark, monkeypatch):
    """Without any round and with a single start table, fresh tables still bring the recall."""
    draw, rows = np.random.default_rng(4), []
    for pair in range(500):
        centre = draw.normal(size=24)
        rows += [(2 * pair + i, [float(x) for x in centre + 0.12 * draw.normal(size=24)]) for i in range(2)]
    want = brute_links(rows)
    monkeypatch.setattr(nn_descent, "ROUNDS", 0)
    monkeypatch.setattr(nn_descent, "TABLES", 1)
    monkeypatch.setattr(nn_descent, "MEETING", 0.3, raising=False)
    got = near(spark, rows)
    linked = sum(n for _, n, _ in want)
    assert linked > 900 and sum(n for _, n, _ in got) >= 0.99 * linked


def test_more_tables_for_more_rows():
    for n in (0, 10**3, 10**6, 10**7, 10**9):
        tables, bits = nn_descent._tables(n, 0.95)
        assert 1 - (1 - (1 - np.arccos(0.95) / np.pi) ** bits) ** tables >= 0.9


def test_no_vectors(spark):
    assert near(spark, []) == []
    assert near(spark, [(1, None)]) == [(1, 0, 1)]
