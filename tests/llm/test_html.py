import html as escapes
import itertools
import math
import re
import time
from random import Random

import pytest

from monthmill.llm import html


@pytest.fixture(scope="module")
def pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()
    return [r.html for r in rows]


@pytest.fixture(scope="module")
def model(pages):
    return html.train(pages[:120])


def article(page):
    """The blocks of the article element, by its marks."""
    text = page.split("<article>")[1].split("</article>")[0].split("<footer>")[0]
    text = re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\n", text)))
    lines = (re.sub(r"\s+", " ", line).strip() for line in escapes.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def test_held_out_pages(pages, model):
    right = sum(html.main_text(page, model) == article(page) for page in pages[120:])
    assert right >= 0.98 * len(pages[120:])


PROSE = ["The sun is very strong today. Many people go to the park to rest.", "A second paragraph has several words. It ends here.",
         "The third one is shorter, but long enough."]


@pytest.mark.parametrize("shape", [
    '<html><body><div id="header"><a href="/">Site</a></div><div class="menu"><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></div>'
    '<div class="content"><p>{0}<p>{1}</p><p>{2}</p><div class="comments"><p>I really like this. Thanks!</p></div></div>'
    '<div class="sidebar"><p>Most read articles of this week are here.</p></div><div id=footer>© 2024 All rights reserved.</div></body></html>',
    '<main><p>{0}</p><p>{1}</p><p>{2}</p></main><aside><p>Subscribe to our letter now. It is free.</p></aside><form><p>Name</p><input></form>',
    '<article><div class="ad">Buy it now. It is very cheap.</div><p>{0}</p><p>{1}</p><p>{2}</p></article><footer>Imprint</footer>'
    '<section id="comments"><p>First comment. It is long enough to look like text.</p></section>',
])
def test_other_markup(model, shape):
    assert html.main_text(shape.format(*PROSE), model) == "\n".join(PROSE)


def test_parsing():
    nodes = html.parse('<!-- <p>no --><p>a &amp; <b>b\n  c<p>d<br>e<script>x="</p><p>"</script>f<ul><li>1<li>2</ul><p title="a>b">g</p><textarea>t</textarea>h')
    assert [n.text for n in nodes if n.text is not None] == ["a & b c", "d ef", "1", "2", "g", "h"]
    assert [n.text for n in html.parse("a < b <3 <")if n.text is not None] == ["a < b <3 <"]
    for odd in ("", "<", "<p", "</p>", "<!--", "<script>", "<p class='x>y", "</b></i><td>x", "<p " * 2000, "<div>" * 5000 + "x"):
        html.parse(odd)


def texts(page):
    return [n.text for n in html.parse(page) if n.text is not None]


@pytest.mark.parametrize("head", [
    "<head><title>t</title><body>", "<head><meta charset=x><link href=y><style>a</style><script>b</script> <!-- c -->", "<head></body>",
    "<head><title>t</title></head><body>", "<head>\n<base href=x><bgsound src=y><noscript><p>n</p></noscript><noframes><p>f</p></noframes><body>",
])
def test_head_without_end(model, head):
    page = f"<html>{head}<article><p>{PROSE[0]}</p><p>{PROSE[1]}</p></article><nav><a href=x>Home</a></nav></html>"
    assert texts(page) == [*PROSE[:2], "Home"]
    assert html.main_text(page, model) == "\n".join(PROSE[:2])


def test_head_ends_at_text_and_other_tags():
    assert texts("<head><title>t</title>Words of the body.") == ["Words of the body."]
    assert texts("<head><svg><title>s</title><p>no</p></svg><p>a</p>") == ["a"]
    assert texts("<p>a</p><head><p>b</p>") == ["a", "b"]
    assert texts("<head><title>t</title></p> <meta name=x><script>s</script>") == []


def test_formulas(model):
    formula = "<math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math>"
    page = f"<body><article><p>{PROSE[0]} {formula} is known.</p><p>{PROSE[1]}</p></article></body>"
    assert html.main_text(page, model) == f"{PROSE[0]} E=mc2 is known.\n{PROSE[1]}"


@pytest.mark.parametrize("own", ['data-x="1.5" data-y="2.5"', 'data-y="10px"', 'data-y=""', "data-y", 'data-y="7"', "DATA-Y='0'", "data-y=1"])
def test_data_attributes_of_a_page(model, own):
    shape = "<body><article{0}><p{0}>{1}</p><p>{2}</p></article><footer{0}>Imprint</footer></body>"
    page, plain = shape.format(" " + own, *PROSE), shape.format("", *PROSE)
    assert html.main_text(page, model) == html.main_text(plain, model) == "\n".join(PROSE[:2])
    assert all(node.label is None for node in html.parse(page))
    # nor are they labels in training
    assert html.train([page] * 3) == html.train([plain] * 3)


def test_marginals_by_enumeration():
    random = Random(2)
    for _ in range(40):
        n = random.randint(1, 8)
        nodes = [html.Node("#page", -1)]
        nodes += [html.Node("div", random.randrange(k + 1), text="x" if random.random() < 0.4 else None) for k in range(n - 1)]
        for k, node in enumerate(nodes):
            node.features = [f"f{k}"]
        model = html.Model({f"f{k}": random.uniform(-2, 2) for k in range(n)},
                           {kind: tuple(random.uniform(-1, 1) for _ in range(4)) for kind in ("text", "element")})
        weight = [[0.0, 0.0] for _ in range(n)]
        for states in itertools.product((0, 1), repeat=n):
            energy = sum(model.weights[f"f{k}"] * states[k] for k in range(n))
            energy += sum(model.edges[html.kind_of(nodes[k])][2 * states[nodes[k].parent] + states[k]] for k in range(1, n))
            for k in range(n):
                weight[k][states[k]] += math.exp(energy)
        for (zero, one), odds in zip(weight, html.marginals(nodes, model), strict=True):
            assert math.log(one / zero) == pytest.approx(odds, abs=1e-9)


def test_table(spark, given, model):
    extra = [(10**6, None, None), (10**6, None, None), (10**6 + 1, "u", ""), (None, "u", "<p>" + "word and word. " * 100_000 + "</p>")]
    pages = given("pages").unionByName(spark.createDataFrame(extra, "page_id bigint, url string, html string"))
    rows = html.extract(pages, model).collect()
    assert len(rows) == pages.count() and all(r.n_chars == len(r.text) for r in rows)
    assert [r.text for r in rows if r.page_id is not None and r.page_id >= 10**6] == ["", "", ""]
    assert html.extract(pages.limit(0), model).count() == 0
    found = html.training_pages(pages, 20)
    assert len(found) == 20 and found == html.training_pages(pages.repartition(3), 20)
    assert html.train([]) is html.PRIOR and html.train(["<p>no label</p>"]) is html.PRIOR


@pytest.mark.parametrize("page", [
    "<i>" * 200_000 + "</x>" * 200_000,
    "<p><table>" + "<i>" * 100_000 + "<div>" * 100_000,
    "<li>" + "<i>" * 100_000 + "<li>" * 100_000,
    "<head>" + "<title>x" + "</title></b>" * 100_000,
])
def test_a_page_costs_its_length(page):
    started = time.process_time()
    html.parse(page)
    assert time.process_time() - started < 8


def test_end_tags_close_the_innermost_of_their_kind():
    blocks = [n.text for n in html.parse("<div><p>a<b>b</x></b><div>c</p>d</div>e</div></div>f") if n.text]
    assert blocks == ["ab", "cd", "e", "f"]
