"""Set join, embeddings, components, pages and the pipeline on small fixtures."""

import random
import zlib  # noqa: F401

import numpy as np
import pytest

from cohortry.llm import embed, html_extract, ngram_join
from cohortry.llm.graph import components

SCHEMA = "doc_id long, text string, node string"


def roots(pairs, nodes):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_components(spark):
    rng = random.Random(3)
    for n, m in ((30, 20), (200, 150), (60, 300)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(1000, 1040)]
        want = roots(edges, {x for e in edges for x in e})
        got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert all(got.get(x, x) == c for x, c in want.items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, k=4):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def test_set_join_against_brute_force(spark):
    rng = random.Random(4)
    base = [[rng.choice("abcdefghij") + str(rng.randrange(50)) for _ in range(rng.randint(1, 120))] for _ in range(12)]
    rows = []
    for i in range(220):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice("xyz") + str(rng.randrange(9))
        rows.append((i, " ".join(w) if i % 3 else "\n".join(w).upper(), "x"))
    rows += [(500, None, "x"), (501, "", "x"), (502, " \t", "x"), (503, "a b", "x"), (504, "A  b", "x"), (3, rows[3][1], "x")]
    got = ngram_join.join(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    sets = {i: shingles(t) for i, t, _ in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = roots(links, ids)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(i, len(sets[i]), want[i]) for i in ids}
    assert ngram_join.join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_link_of_the_set_join(spark):
    rng = random.Random(9)
    base = [[f"{c}{i}" for i in range(60)] for c in "abc"]
    texts = []
    for i in range(60):
        w = list(base[i % 3])
        w[57 + rng.randrange(3)] = f"z{rng.randrange(9)}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame([*((i, t, "x") for i, t in enumerate([*texts, texts[0]])), (None, "a b", "x"), (None, None, "x")], SCHEMA)
    rows = ngram_join.members(docs).collect()
    of = {r.doc_id: r.node for r in rows if r.doc_id is not None}
    assert len(rows) == 63 and of[60] == of[0] and sum(r.node == 0 for r in rows) == 1
    sets = {of[i]: shingles(t) for i, t in enumerate(texts)}
    want = {(a, b, len(sets[a] & sets[b]), len(sets[a]), len(sets[b])) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    got = [tuple(r) for r in ngram_join.links(docs).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert len(want) > len(sets)  # more links than components need


def test_set_join_of_tiles_large_sets_and_few_rows(spark, monkeypatch):
    rng = random.Random(12)
    common = [f"c{i}" for i in range(700)]
    rows = []
    for i in range(90):  # sets of several hundred shingles, most pairs under the bound, long lists
        w = list(common)
        for a in range(i % 7):
            w[100 * a : 100 * a + 20] = [f"u{i % 13}_{a}_{j}" for j in range(20)]
        rows.append((i, " ".join(w[: rng.choice([300, 650, 700])]), "x"))
    monkeypatch.setattr(ngram_join, "LONG_LIST", 7)
    monkeypatch.setattr(ngram_join, "PER_TASK", 3)
    sets = {i: shingles(t) for i, t, _ in rows}
    near = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = roots(near, sets)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {r.doc_id: r.component_id for r in ngram_join.join(docs).collect()} == want and len(set(want.values())) > 3
    of = {r.doc_id: r.node for r in ngram_join.members(docs).collect()}
    assert {(r.x, r.y) for r in ngram_join.links(docs).collect()} == {(min(of[a], of[b]), max(of[a], of[b])) for a, b in near if of[a] != of[b]}
    few = spark.createDataFrame([(1, None, "x"), (2, "", "x")], SCHEMA).coalesce(1)
    assert sorted(map(tuple, ngram_join.join(few).collect())) == [(1, 0, 1), (2, 0, 2)]
    assert [tuple(r) for r in ngram_join.join(docs.filter("doc_id = 1")).collect()] == [(1, len(sets[1]), 1)]


def test_pairs_across_groups_follow_the_entries(spark, monkeypatch):
    rng = random.Random(21)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(50):  # copies of copies: all are links, but each node's likeliest pair is within its two
        w = list(base)
        w[rng.randrange(100)] = f"e{i}"
        rows += [(2 * i, " ".join(w), "x"), (2 * i + 1, " ".join([*w, f"f{i}"]), "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    made, drop = [], type(docs).dropDuplicates

    def counted(df, columns=None):
        if df.columns == ["x", "y", "differ", "size"]:
            made.append(df.count())
        return drop(df, columns)

    monkeypatch.setattr(type(docs), "dropDuplicates", counted)
    got = {r.doc_id: r.component_id for r in ngram_join.join(docs, k=5, percent=80).collect()}
    sets = {i: shingles(t, 5) for i, t, _ in rows}
    near = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert got == roots(near, sets) and len(near) > 2000
    assert made and max(made) <= 20 * len(rows)  # prefixes have 20 entries; 24,837 rows before


def test_near_duplicates_with_clashing_columns(spark):
    import corpus_pipeline

    text = " ".join(f"w{i}" for i in range(90))
    names = ["print", "_print", "node", "id_of", "Row_of", "n_chars"]
    docs = spark.createDataFrame([(1, text, *range(6)), (2, text + " x", *range(6)), (3, text, *range(6)), (7, text[:200], *range(6)), (7, text[:200], *range(1, 7))], "doc_id long, text string, " + ", ".join(f"{c} long" for c in names))
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [1, 7]
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), "").count() == 0
    four = spark.createDataFrame([(i, ["a b", None, "", "a b c"][i], "s") for i in range(4)], "doc_id long, text string, source string").repartition(4)
    assert corpus_pipeline.drop_near_duplicates(spark, four, "").count() == 4


def test_near_duplicates_go_by_row(spark):
    import corpus_pipeline

    base = [[f"{c}{i}" for i in range(80)] for c in "abcd"]
    near = lambda i, *more: " ".join([*base[i], *more])
    rows = [(1, near(0)), (2, near(0, "x")), (2, near(1)), (3, near(2)), (3, near(2, "y")), (None, near(3)), (None, near(3, "z")), (None, near(1, "u")), (None, None), (None, None), (4, ""), (3, near(2))]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string")
    got = sorted(((r.doc_id, (r.text or "")[:2]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, "a0"), (2, "b0"), (3, "c0"), (None, "d0"), (None, ""), (None, ""), (4, "")], key=str)


def test_parity_never_rules_out_a_match():
    rng = np.random.default_rng(5)
    for _ in range(200):
        x = rng.integers(0, 2**62, 100, dtype=np.uint64)
        y = x.copy()
        y[: rng.integers(0, 9)] = rng.integers(0, 2**62, 1, dtype=np.uint64)[0]
        both = np.concatenate([x, np.unique(y)])
        bits = ngram_join._parity(both, np.array([0, len(x), len(both)]))
        n, m = np.array([len(x)]), np.array([len(both) - len(x)])
        inter = len(set(x.tolist()) & set(y.tolist()))
        if 100 * inter >= 85 * (n[0] + m[0] - inter):
            assert ngram_join._may_match(n, m, ngram_join._differ(bits[:1], bits[1:]), 85)[0]


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((40, 32))
    x = np.concatenate([rng.standard_normal((300, 32)), np.repeat(centres, 8, axis=0) + 0.25 * rng.standard_normal((320, 32)), np.repeat(centres[:1], 700, axis=0) + 0.05 * rng.standard_normal((700, 32))]).astype(np.float32)
    x = np.concatenate([x, x[:5]])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5001, []), (5002, [0.0] * 32), (5003, [float("nan")] * 32), (5004, [None] + [1.0] * 31), (5005, [1.0, 2.0])]
    got = {r.vec_id: r for r in embed.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= link.sum(axis=1)).all() and found.sum() >= 0.98 * link.sum()
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(5000, 5006)) and got[len(x) - 1].component_id == 4
    assert embed.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    clash = spark.createDataFrame([(i, [1.0, float(i)], "x", 7) for i in (1, 1, 2)], "vec_id long, embedding array<double>, node string, filters int")
    assert sorted(map(tuple, embed.near_duplicates(clash).collect())) == [(1, 2, 1, True)] * 2 + [(2, 2, 1, False)]


@pytest.mark.parametrize(("n", "least"), [(1000, 16), (1_000_000, 128)])
def test_more_filters_for_more_vectors(n, least):
    words, alpha = embed.plan(n, 0.9)
    assert words >= least and alpha > 1


def page(k, paragraphs, extra=""):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return f'<!DOCTYPE html><html><head><title>T{k}</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">M{k}</a></li></ul></nav><div class="ad">Buy {k}</div><article><h1>Title {k}</h1>{body}{extra}</article><footer>&copy; {k}</footer></body></html>'


def test_main_texts(spark):
    rows = [(i, f"https://a.example.org/{i}", page(i, [f"One &amp; {i}", f"two  \n{i}"][: 1 + i % 2], '<div class="comments"><p>nice</p></div>' if i % 3 == 0 else "")) for i in range(12)]
    plain = '<html><body><div id="menu"><a href="/">Home</a></div><div class="content"><p>First <b>long</b> text here<p>Second<br>line</div><form><input>Search</form></body>'
    rows += [(50, "http://b.example.org/", plain), (51, None, "bare &lt;text&gt;"), (52, "x", None), (53, "http://c/", ""), (53, "http://c/", "<p>cut</p><a hr")]
    got = {}
    for r in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        got.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    for i in range(12):
        assert got[i] == ["\n".join([f"Title {i}", f"One & {i}", f"two {i}"][: 2 + i % 2])]
    assert got[50] == ["First long text here\nSecond line"] and got[51] == ["bare <text>"] and got[52] == [""] and sorted(got[53]) == ["", "cut"]


def read_by_host(pages):
    wrapper = None
    for p in map(html_extract.parse, pages):
        wrapper = html_extract.wrapper_of(p) if wrapper is None else html_extract.align(wrapper, html_extract.wrapper_of(p))
    return [html_extract.extract(p, html_extract.reading(wrapper)) for p in pages]


def test_constant_text_of_a_host_is_template():
    inner = lambda i: f'<h1>T{i}</h1><div class="xq">Get our <b>free</b> app today<ul><li>safe</li><li>fast</li></ul></div><p>By <i>writer {i}</i></p>' + ("<blockquote>once</blockquote>" if i == 2 else "")
    want = [f"T{i}\nBy writer {i}" + "\nonce" * (i == 2) for i in range(4)]
    pages = [f"<html><body><nav>N{i}</nav><article>{inner(i)}</article></body></html>" for i in (0, 1, 2, 2, 3)]
    pages[3] = pages[3].replace("N2", "N9")  # the same page with another menu
    assert read_by_host(pages) == [want[i] for i in (0, 1, 2, 2, 3)]
    assert read_by_host([pages[2], pages[3]]) == ["T2\nGet our free app today\nsafe\nfast\nBy writer 2\nonce"] * 2  # nothing differs
    plain = [f'<html><body class="no-sidebar right-sidebar"><header>Site {i}</header><div class="w with-sidebar">{inner(i)}</div><div class="foo">Imprint and so on</div></body></html>' for i in range(4)]
    assert read_by_host(plain) == want
    heads = [f"<html><body><header>Site {i}</header><p>a{i} one</p><ul><li>b{i} two</li></ul></body></html>" for i in range(3)]
    assert read_by_host(heads) == [f"a{i} one\nb{i} two" for i in range(3)]


def test_names_alone_never_rule_out_an_article():
    long = lambda i: f"<h1>T{i}</h1><p>{'long text ' * 9}{i}</p>"
    text = lambda i: f"T{i}\n{('long text ' * 9)}{i}"
    assert read_by_host([f'<body class="share"><article class="post related">{long(i)}</article></body>' for i in range(3)]) == [text(i) for i in range(3)]
    comment = '<article class="comment"><p>well {}</p></article>'
    assert read_by_host([f'<body><main class="popup">{long(i)}{comment.format(i)}</main></body>' for i in range(3)]) == [text(i) for i in range(3)]
    assert read_by_host([f"<body><article>{long(i)}{comment.format(i)}</article></body>" for i in range(3)]) == [text(i) for i in range(3)]


def test_wrapper_is_union_free_and_order_independent():
    pages = [html_extract.wrapper_of(html_extract.parse(page(i, [f"p{j} {i}" for j in range(i % 4)], "<ul><li>x" if i % 2 else ""))) for i in range(8)]
    one = two = None
    for p in pages:
        one = p if one is None else html_extract.align(one, p)
    for p in reversed(pages):
        two = p if two is None else html_extract.align(two, p)
    text = html_extract.expression(one)
    assert "(<p> #PCDATA </p>)*" in text and "(<ul> <li> text </li> </ul>)?" in text and html_extract.places(one) == html_extract.places(two) == [["html", "body", "article"]]


def test_menus_below_any_depth_hidden_parts_and_inner_class_words():
    deep = "<div>" * 200 + "<nav><ul><li><a>Menu</a></li></ul><p>more</p></nav><p>text</p>" + "</div>" * 200
    assert html_extract.extract(f"<article>{deep}</article>", None) == "text"
    assert html_extract.extract('<article><p hidden>no</p><p aria-hidden="false" data-hidden>yes</p><div class="a b c d cookie-notice">no</div></article>', None) == "yes"
    assert html_extract.extract('<article><h2 class="share-of-gdp">Share</h2><p class="notice-board">Board</p></article>', None) == "Share\nBoard"


def test_names_with_other_parts_are_only_hints():
    parts = '<section class="related-work"><p>Before {0}</p></section><table class="share-prices"><tr><td>Oil {0}</td></tr></table><ul class="social-sciences"><li>Law {0}</li></ul><p><label>Set</label> to ten {0}.</p>'
    junk = '<div class="related-posts"><p>x {0}</p></div><ul class="related-reading"><li><a href="/{0}">Other {0}</a></li><li><a>More {0}</a></li></ul><section class="responses"><p>Nice {0}</p></section><div class="rail"><p>Buy {0}</p></div><p style="display: none">a {0}</p><p aria-hidden="true">b {0}</p>'
    wrapper, pages = None, [html_extract.parse(f"<body><article><h1>T {i}</h1>{parts.format(i)}{junk.format(i)}</article></body>") for i in range(4)]
    for p in pages:
        own = html_extract.wrapper_of(p)
        wrapper = own if wrapper is None else html_extract.align(wrapper, own)
    for i, p in enumerate(pages):
        wanted = [f"T {i}", f"Before {i}", f"Oil {i}", f"Law {i}", f"Set to ten {i}."]
        assert html_extract.slot_texts(p, html_extract.reading(wrapper)) == wanted  # by the host's wrapper
        assert html_extract.slot_texts(p, html_extract.reading(html_extract.wrapper_of(p))) == wanted  # by its own


def test_values_of_attributes_are_not_names():
    assert html_extract.extract("""<article><p title="a hidden class=menu">one</p><p data-hidden=1 data-class='ad' alt='id="nav"'>two</p><p CLASS = 'ad'>no</p><p hidden=hidden>no</p><p style="color:red">three</p></article>""", None) == "one\ntwo\nthree"


def test_deep_and_odd_html():
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    assert html_extract.extract(deep, None) == "deep"
    assert html_extract.extract("a < b and c > d <", None).startswith("a < b")


def test_pipeline(spark):
    import corpus_pipeline
    from cohortry.llm.common import saved, table

    sf = "/root/testdata/sf0.001"
    docs, before = table(spark, sf, "documents"), None
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, saved(stage(spark, docs, sf), name)
        if name != "best_fit_packing":
            assert docs.columns == names and docs.count() <= before.count()
    ids = {r.doc_id for r in before.select("doc_id").collect()}
    assert ids == {r.doc_id for r in docs.select("doc_id").collect()} and docs.filter("offset + length > 1024").count() == 0


def test_pipeline_on_odd_rows(spark):
    import corpus_pipeline
    from cohortry.llm.common import saved

    sf = "/root/testdata/sf0.001"
    words = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    rows = [(1, words("a", 90)), (2, words("a", 90) + " end"), (3, None), (3, ""), (None, None), (None, words("b", 80)), (7, words("c", 70)), (7, words("d", 70)), (7, words("d", 70)), (8, words("e", 30) + " " + words("c", 60)), (9, 'my password = "Xk29fjQ2pz88"'), (10, words("long", 60_000))]
    names = ["key", "print", "spans", "salt", "n_chars"]
    docs = spark.createDataFrame([(*x, *[i] * 5) for i, x in enumerate(rows)], "doc_id long, text string, " + ", ".join(f"{c} long" for c in names))
    columns, texts = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        if name == "best_fit_packing":
            texts = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
        docs = saved(stage(spark, docs, sf), name)
        assert name == "best_fit_packing" or docs.columns == columns
    want = [(1, words("a", 90)), (3, None), (3, ""), (None, None), (None, words("b", 80)), (7, words("c", 70)), (7, words("d", 70)), (8, words("e", 30)), (9, "my [SECRET]\""), (10, words("long", 60_000))]
    assert texts == sorted(want, key=str)
    got = docs.collect()
    assert sum(r.doc_id == 3 and r.length == 1 for r in got) == 2 and max(r.length for r in got) == 1024
    none = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        none = saved(stage(spark, none, sf), name)
    assert none.count() == 0
