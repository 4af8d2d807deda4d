import html
import random
import re
import time

import pytest

from ledgerleaf.llm import html_extraction as dom


@pytest.fixture(scope="module")
def model():
    return dom.train()


def plain(source):
    """The marked article of the standard pages, by patterns."""
    inside = re.search(r"<article>(.*?)</article>", source, re.DOTALL)[1].replace("<br>", " ")
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(b for b in blocks if b)


def test_every_standard_page(spark, tmp_path):
    got = dom.op2_html_extraction(spark, "/root/testdata/sf0.01").collect()
    want = {r.page_id: plain(r.html) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_held_out_made_pages(model):
    rng = random.Random(4321)
    right = total = 0
    for _ in range(120):
        page, label = dom._labelled(dom.sample_page(rng))
        kept = dom.decode(page, model.probability(dom.node_features(page)))
        for tag, k, y in zip(page.tag, kept, label, strict=True):
            right, total = right + (tag == dom.LEAF and k == bool(y)), total + (tag == dom.LEAF)
    assert right / total > 0.97


def test_decoding_is_consistent_and_best():
    """Against every consistent labelling of small trees."""
    rng = random.Random(2)
    for _ in range(60):
        page = dom.Page()
        page.add("html", -1)
        for _ in range(rng.randrange(1, 7)):
            inner = [i for i, t in enumerate(page.tag) if t != dom.LEAF]
            page.add(rng.choice((dom.LEAF, "div")), rng.choice(inner), text="x")
        n = len(page.tag)
        p = dom.np.array([rng.random() for _ in range(n)])
        logs = lambda bits: sum(dom.np.log(q if b else 1 - q) for q, b in zip(p, bits, strict=True))  # noqa: B023, E731
        best = None
        for mask in range(2**n):
            bits = [mask >> i & 1 for i in range(n)]
            if any(b and i and not bits[page.parent[i]] for i, b in enumerate(bits)):
                continue
            if any(b and page.tag[i] != dom.LEAF and not any(bits[j] for j in range(n) if page.parent[j] == i) for i, b in enumerate(bits)):
                continue
            best = max(best, logs(bits)) if best is not None else logs(bits)
        assert logs(dom.decode(page, p)) == pytest.approx(best)


@pytest.mark.parametrize(
    "source,text",
    [
        ("", ""), (" \n", ""), ("<p>", ""), ("just some plain words here.", "just some plain words here."),
        ("<article><p>One &amp;amp; two<p>Three<br>four <b>fi</b>ve</article>", "One &amp; two\nThree four five"),
        ("<article><p>Kept words of the article.</p><script>var t='</p>';</script><p>More of them.</p></article>", "Kept words of the article.\nMore of them."),
        ("<head><title>T</title></head><body><nav><a href=x>menu</a></nav><article><p>Body text of this page.</p></article><footer>&copy; foot</footer>", "Body text of this page."),
        ("<article><p>a < b and c</p></article>", "a < b and c"),
        ("<ARTICLE><P>Upper tags of a page.</P></ARTICLE><!-- <p>gone</p>", "Upper tags of a page."),
    ],
)
def test_cases(model, source, text):
    assert dom.extract([source], model) == [text]


def test_long_and_deep_pages(model):
    deep = "<div>" * 3000 + "<p>Deep words stand here.</p>"
    assert len(dom.extract([deep], model)) == 1
    long = "<article>" + "<p>Some words of a long page.</p>" * 20_000 + "</article>"
    assert dom.extract([long], model)[0].count("\n") == 19_999


def test_table(spark, model):
    rows = [(1, "u", None, "x"), (2, None, "<article><p>Words of the page.</p></article>", "y"), (2, None, "<article><p>Words of the page.</p></article>", "y")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = dom.extract_column(pages, ["page_id", "url"], model=model).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in got) == [(1, "", 0), (2, "Words of the page.", 18), (2, "Words of the page.", 18)]
    assert dom.extract_column(pages.limit(0), ["page_id"], model=model).count() == 0


@pytest.mark.parametrize("n", [5, 198, 199, 200, 3000])
def test_share_of_equal_siblings_at_every_size(n):
    page = dom.parse("<article><h1>Title</h1>" + "<p>Words here.</p>" * n + "</article>")
    alike = dom.node_features(page)[:, 14]
    assert alike[page.tag.index("h1")] == pytest.approx(1 / (n + 1)) and alike[page.tag.index("p")] == pytest.approx(n / (n + 1))


def test_copyright_mark_anywhere_in_a_leaf():
    for mark in ("©", "(C)"):
        page = dom.parse(f"<footer>{'many words come first ' * 5}{mark} somebody</footer><p>none</p>")
        assert dom.node_features(page)[:, 21].tolist() == [float(mark.lower() in t.lower()) for t in page.text]


@pytest.mark.parametrize(
    "source,text",
    [
        ("<article><p>Energy is E = <math><mi>m</mi><msup>c</msup></math> holds here.</p></article>", "Energy is E = mc holds here."),
        ("<article><p>The drawing <svg><title>no</title><text>of a cat</text></svg> stands here.</p></article>", "The drawing of a cat stands here."),
        ("<article><p>The film <object data=x><param name=y>in other words</object> stands here.</p></article>", "The film in other words stands here."),
        ("<article><p>Words of this page.</p><noscript><p>More words of this page.</p></noscript></article>", "Words of this page.\nMore words of this page."),
        ("<head><noscript>gone</noscript></head><body><article><p>Words of this page.</p><template>gone</template></article>", "Words of this page."),
    ],
)
def test_formulas_drawings_and_fallbacks_are_text(model, source, text):
    assert dom.extract([source], model) == [text]


def leaves(source):
    return [t for t in dom.parse(source).text if t]


@pytest.mark.parametrize(
    "source,texts",
    [
        ("<p class=\"a\"\">Hello there</p><p>b", ["Hello there", "b"]),
        ("<p data-x=it's>Hello <b>you</b></p><p class='x''>c", ["Hello you", "c"]),
        ("<p class=\"a\"b='c'd=>one</p><p =x ==y \"\">two", ["one", "two"]),
        ("<a href=\"x>y\">in</a> <img alt='a>b' src=q/>side", ["in side"]),
        ("a<!-->b<!--->c<!-- x --!>d<!-- y -->e<!-- z", ["abcde"]),
        ("<p>x < y and 3<4", ["x < y and 3<4"]),
    ],
)
def test_stray_quotes_and_short_comments_lose_nothing(source, texts):
    assert leaves(source) == texts


@pytest.mark.parametrize(
    "source,texts",
    [
        ("<p>one <label>two <b>x</b></label> three <button><div>no</div></button> four</p>", ["one three four"]),
        ("<p>one <select><option>A<option>B</select> two <datalist><option>C</datalist> three", ["one two three"]),
        ("<p>a <label>open<p>next</div><div>z</div>", ["a", "next", "z"]),
        ("<ul><li>a <label>open<li>b</ul>c", ["a", "b", "c"]),
        ("<div><label>x<p>y</p></div><p>back</p>", ["back"]),
        ("<p>a <button>b</p>c</button><p>d", ["a", "c", "d"]),
        ("<p>a</button> b</label>c", ["a bc"]),
    ],
)
def test_controls_inside_a_paragraph_do_not_divide_it(source, texts):
    assert leaves(source) == texts


def test_time_grows_with_the_page_alone():
    """Depth, attributes and stray signs in great numbers."""
    def seconds(source):
        start = time.perf_counter()
        dom.parse(source)
        return time.perf_counter() - start

    page = dom.parse("<div>" * 200_000 + "deep")
    assert page.text[-1] == "deep" and len(page.tag) == 200_002
    for source in ("<div>" * 200_000, "<p " + "a " * 300_000 + ">", "<p " + "=" * 300_000, "<p a= " + " " * 300_000, "<" * 300_000, "<label>" * 100_000 + "<p>x" * 50_000):
        assert seconds(source) < 6
