import numpy as np
import pytest

from cairn.llm import boosting, html_extract, html_pages
from cairn.llm.html_dom import parse


@pytest.fixture(scope="module")
def models():
    return html_extract.trained(pages=250)


def texts(source):
    nodes = parse(source)
    return html_extract.blocks(nodes, np.ones(len(nodes), int))


def test_reader():
    assert texts("<p>a<b>b</b> c<br>d<p>e &amp;amp; f<script>'<p>x</p>'</script>g</p><!-- <p>no --> tail") == ["ab c d", "e &amp; fg", "tail"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e</table>") == ["a", "b", "c", "d", "e"]
    assert texts("<TITLE>t</TITLE><STYLE>p{}</STYLE><div>x  \n y&nbsp;z</div") == ["x y z"]
    assert texts("") == [] and texts("plain & text < 3") == ["plain & text < 3"] and texts("<p>un<em>closed") == ["unclosed"]


def test_held_out_pages(models):
    right = wrong = missed = 0
    pages = [s for s, _ in html_pages.labelled_pages(120, 77)]
    for source, found in zip(pages, html_extract.extract_many(pages, models)):
        nodes = parse(source)
        want = set(html_extract.blocks(nodes, np.array([int(html_pages.SIGN in n.text) for n in nodes])))
        right += sum(len(x) for x in set(found) & want)
        wrong += sum(len(x) for x in set(found) - want)
        missed += sum(len(x) for x in want - set(found))
    assert right / (right + wrong) > 0.9 and right / (right + missed) > 0.9


def test_decoding_never_contradicts_itself():
    rng = np.random.default_rng(0)
    for source, _ in html_pages.labelled_pages(30, 5):
        nodes = parse(source)
        state = html_extract.decode(nodes, rng.random(len(nodes)), rng.random(len(nodes)))
        for node, s in list(zip(nodes, state))[1:]:
            assert state[node.parent] in (s, html_extract.MIXED)
            assert node.tag != "#text" or s != html_extract.MIXED


def test_decoding_is_the_best():
    from itertools import product

    nodes = parse("<div><p>a</p><p>b</p></div>c")
    rng = np.random.default_rng(1)
    some, pure = rng.random((2, len(nodes)))

    def value(states):
        total = 0.0
        for i, (n, s) in enumerate(zip(nodes, states)):
            if i and states[n.parent] not in (s, html_extract.MIXED):
                return -np.inf
            if n.tag == "#text":
                total += -np.inf if s == 2 else np.log((1 - some[i], some[i])[s])
            else:
                total += np.log((1 - some[i], some[i] * pure[i], some[i] * (1 - pure[i]))[s])
        return total

    best = max(value(s) for s in product(range(3), repeat=len(nodes)))
    assert value(html_extract.decode(nodes, some, pure)) == pytest.approx(best)


def test_trees_learn():
    rng = np.random.default_rng(2)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    model = boosting.fit(x[:1500], y[:1500], np.ones(1500))
    assert ((model.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


def test_rows(spark, models):
    page = "<html><body><nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>A title of words</h1><p>" + "Some prose of a page, with marks. " * 9
    rows = [(1, "u", page + "</p></article><footer>&copy; x</footer>", "k"), (2, None, None, "k"), (None, "u", "", "k"), (1, "u", page, "k")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, source string")
    found = html_extract.extract(table, models=models).collect()
    assert len(found) == 4 and sorted(len(r.text) == 0 for r in found) == [False, False, True, True]
    assert all("Some prose" in r.text and "Home" not in r.text for r in found if r.text)
    assert html_extract.extract(table.limit(0), models=models).count() == 0


def test_marks_after_inline_ends_stay_with_their_block():
    assert texts("<p>Yes, <b>indeed</b>!</p><p>See <a class='x'>this page</a>.") == ["Yes, indeed!", "See this page."]
    assert len([n for n in parse("<p>a <b>b</b> c <i>d</i>.</p>") if n.tag == "#text"]) == 1


def test_only_what_is_no_text_is_skipped_by_tag():
    assert texts("<p>x <math><mi>m</mi><mo>=</mo><mn>2</mn><annotation>m=2</annotation></math> y</p>") == ["x m=2 y"]
    assert texts("<svg><title>t</title><text>label</text><path d='M0'/></svg><p>a</p>") == ["label", "a"]
    assert texts("<noscript><p>shown</p></noscript><object><p>also</p></object>") == ["shown", "also"]


def test_elements_that_are_not_closed_lose_nothing():
    assert texts("<html><head><title>t</title><meta charset=x><div><p>all of it</div>") == ["all of it"]
    assert texts("<div><select><option>a</div><p>after") == ["after"]
    assert texts("<p>b</p><section><video><p>no</p></section>c") == ["b", "c"]
    assert texts("<template><div>x</div></template>y") == ["y"]
    assert texts("<table><tr><td><b>one<td>two</b> three</table>four") == ["one", "two three", "four"]


def test_deep_nesting_is_linear():
    import time

    deep = "".join(f"<div class='n{k % 7}'>" if k % 3 else "<b><ul><li>" for k in range(20_000)) + "words"
    began = time.perf_counter()
    nodes = parse(deep)
    x = html_extract.node_features(nodes)
    assert time.perf_counter() - began < 5 and len(x) == len(nodes) > 20_000
    assert texts(deep) == ["words"]


def test_features_by_their_definitions():
    for source in [*(s for s, _ in html_pages.labelled_pages(6, 3)), "", "<p>x", "<div class='nav ad'><p hidden>a, b<a>c</a></p></div>"]:
        nodes = parse(source)
        x = html_extract.node_features(nodes)
        rest = x[:, -20:]

        def below(i):
            return [i, *(j for c in nodes[i].children for j in below(c))]

        def chars(i):
            return sum(len(" ".join(nodes[j].text.split())) for j in below(i) if nodes[j].tag == "#text")

        for i, node in enumerate(nodes):
            inside = below(i)
            tags = sum(nodes[j].tag != "#text" for j in inside)
            assert rest[i, 0] == node.depth and rest[i, 1] == pytest.approx(np.log1p(chars(i))) and rest[i, 3] == pytest.approx(np.log1p(tags))
            assert rest[i, 7] == pytest.approx(np.log1p(sum(nodes[j].tag == "p" for j in inside)))
            assert rest[i, 17] == pytest.approx(np.log1p(max((chars(j) for j in inside if nodes[j].tag == "#text"), default=0)))
            if i:
                brothers = nodes[node.parent].children
                assert rest[i, 10] == pytest.approx(np.log1p(len(brothers))) and rest[i, 11] == pytest.approx(brothers.index(i) / len(brothers))
                assert rest[i, 12] == pytest.approx(np.log1p(sum(nodes[b].tag == node.tag for b in brothers)))
                others = sum(chars(b) for b in brothers if b != i)
                assert rest[i, 13] == pytest.approx(np.log1p(others / max(1, len(brothers) - 1)))
                assert rest[i, 14] == pytest.approx(chars(i) / max(1, others + chars(i)))
                up, hidden = i, False
                while up >= 0:
                    hidden |= nodes[up].hidden
                    up = nodes[up].parent
                assert rest[i, 18] == hidden


def test_first_tree_takes_the_best_split():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, (300, 3)).astype(float)
    y = ((x[:, 1] > 2) ^ (rng.random(300) < 0.1)).astype(float)
    weight = rng.uniform(0.5, 2, 300)
    model = boosting.fit(x, y, weight, trees=1, depth=1, ridge=2.0)
    p = np.average(y, weights=weight)
    g, h = weight * (y - p), weight * p * (1 - p)

    def gain(k, cut):
        left = x[:, k] <= cut
        return sum(g[s].sum() ** 2 / (h[s].sum() + 2.0) for s in (left, ~left))

    best = max(((k, c) for k in range(3) for c in range(5)), key=lambda s: gain(*s))
    left = x[:, best[0]] <= best[1]
    want = np.where(left, g[left].sum() / (h[left].sum() + 2.0), g[~left].sum() / (h[~left].sum() + 2.0)) * 0.2 + np.log(p / (1 - p))
    assert model.probability(x) == pytest.approx(1 / (1 + np.exp(-want)))


def test_short_pages(models):
    base = "<html><body><nav><a href=/>Home</a> <a href=/b>News</a></nav><article><h1>The old bridge</h1>"
    page = base + "<p>Type this to begin:</p><pre>make all\nrun it</pre></article><footer>&copy; 2020 site</footer>"
    assert html_extract.extract_many([page], models)[0][-2:] == ["Type this to begin:", "make all run it"]


def test_extra_columns_and_long_pages(spark, models):
    prose = "Some prose of a page, with marks and more words. "
    page = "<html><body><article><h1>A title of words</h1>" + "".join(f"<p>{k} {prose * 4}</p>" for k in range(3000)) + "</article>"
    rows = [(1, "u", page, "x", ["y"], "t")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, source string, blocks array<string>, text string")
    found = html_extract.extract(table, models=models).collect()
    assert len(found) == 1 and len(found[0].blocks) >= 3000 and found[0].text == "\n\n".join(found[0].blocks)
