import itertools
import re
from html import unescape

import numpy as np
import pytest

from granary.llm import extract, treemodel
from granary.llm.common import table
from granary.llm.dom import blocks

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return extract.fit(extract.labelled_sample(table(spark, SF, "pages")))


def texts(html):
    return [n.text for n in blocks(html) if n.text]


def test_broken_markup():
    assert texts("<p>a<p>b <b>c<br>d<div>e</p>f") == ["a", "b c d", "e", "f"]
    assert texts('<script>var x="</p>";</script><style>p{}</style><!-- <p>no</p> -->yes<!-- open') == ["yes"]
    assert texts("a &amp; b &lt;p&gt; &eacute; &am &#x41;\xa0 \n c") == ["a & b <p> é &am A c"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e") == ["a", "b", "c", "d", "e"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("1 < 2 <a href='x>y'>z</a> <a title=\"it's>\">w</a><p q\"r>s</p><h2>t</h3>u<i") == ["1 < 2 z w", "s", "t", "u"]
    assert texts("") == [] and texts("<div>" * 3000 + "deep") == ["deep"] and texts("</p></div>x") == ["x"]


def test_messages_give_the_marginals_of_brute_force():
    rng = np.random.default_rng(0)
    nodes = blocks("<div class=a><p>x</p><ul><li>y</li></ul></div>")
    model = treemodel.Model(rng.normal(0, 1, treemodel.FEATURES), rng.normal(0, 1, (treemodel.KINDS, 2, 2)))
    f = treemodel.forest([nodes])
    own = np.bincount(f.owner, weights=model.own[f.feature], minlength=len(nodes))
    total, sums = 0.0, np.zeros(len(nodes))
    for values in itertools.product((0, 1), repeat=len(nodes)):
        energy = sum(own[k] * v for k, v in enumerate(values))
        energy += sum(model.edge[f.kind[k], values[f.parent[k]], v] for k, v in enumerate(values) if f.parent[k] >= 0)
        total += np.exp(energy)
        sums += np.exp(energy) * np.array(values)
    assert np.allclose(model.marginals(f)[0][:, 1], sums / total)


def expected(html):
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    found = [" ".join(unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(x for x in found if x)


def test_given_pages(spark, model):
    pages = [r.html for r in table(spark, SF, "pages").collect()]
    assert extract.extract(model, pages) == [expected(p) for p in pages]


def test_layouts_never_seen(model):
    layouts, right, total = extract.Layouts(["Words of another text, with a stop.", "More of them.", "Short"], seed=123), 0, 0
    for _ in range(150):
        nodes = blocks(layouts.page())
        guess = model.marginals(treemodel.forest([nodes]))[0][:, 1] > 0.5
        leaves = [k for k, n in enumerate(nodes) if n.text]
        right += sum(guess[k] == nodes[k].label for k in leaves)
        total += len(leaves)
    assert right / total > 0.95


def test_page_without_article(model):
    html = ("<html><body><div id=header><a href=/>Home</a></div><div class=cookie-notice>We use cookies.</div><div class=post><h1>Title here</h1>"
            "<p>First paragraph of the text.</p><form class=newsletter><p>Sign up</p></form><p>Second one, longer than the first one is.</p></div>"
            "<div id=comments><p>I do not agree with any of this text at all.</p></div><footer>&copy; someone</footer></body></html>")
    assert extract.extract(model, [html]) == ["Title here\n\nFirst paragraph of the text.\n\nSecond one, longer than the first one is."]


def test_odd_rows(spark, model):
    rows = [(1, "u", None), (None, None, ""), (2, "v", "<article><p>Text of it, in a block." + "<p>a b" * 20_000), (3, "w", "plain"), (3, "w", "plain")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "'y' as n_chars", "0 as h")
    out = extract.main_text(df, model).collect()
    assert [r.page_id for r in out] == [1, None, 2, 3, 3] and out[0].text == out[1].text == "" and out[3] == out[4]
    assert out[2].n_chars == len(out[2].text) > 100_000
    assert extract.main_text(df.limit(0)).count() == 0


def test_unclosed_elements_do_not_swallow_the_page():
    assert texts('<div><svg viewBox="0 0 1 1"/>icon<p>a</p></div><math/>b') == ["icon", "a", "b"]
    assert texts("<div><svg><path d='M0'/><title>t</title><p>a</div>b") == ["a", "b"]
    assert texts("<div><button>Menu</div><article><p>a</article>") == ["a"]
    for tag in "select object video audio canvas datalist template noscript button".split():
        assert texts(f"<nav><{tag}><div>no<b>no</nav><p>yes</p>") == ["yes"], tag
        assert texts(f"<p>x <{tag}>no<div>no</div><p>no</p></{tag}> y</p>") == ["x y"], tag
    assert texts("<table><tr><td><button>no<td>yes</table>") == ["yes"]
    assert texts("<p>x <svg><g><text>no</text><path/></g></svg> y") == ["x y"]
    assert texts("a<textarea><p>no") == ["a"] == texts("a<title>no</p>")


def test_labels_of_the_page_itself(model):
    html = '<article><p>Some text of it.</p><table><tr><td data-label="Price">12 euro</td><td data-granary-label="x">a</td></tr></table></article>'
    assert [n.label for n in blocks(html)] == [0] * len(blocks(html))
    assert extract.extract(model, [html])[0].startswith("Some text of it.")


def test_ids_beyond_doubles_beside_a_null(spark, model):
    df = spark.createDataFrame([(2**60 + 1, "u", "a"), (None, "v", "b"), (2**60 + 2, "w", "c")], "page_id long, url string, html string").coalesce(1)
    assert [r.page_id for r in extract.main_text(df, model).collect()] == [2**60 + 1, None, 2**60 + 2]
