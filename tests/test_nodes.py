import random
import time

from pyspark.sql import functions as F

from vitrine.functions import nodes
from vitrine.functions.nodes import (
    PageNodes, Sel, all_attrs, all_texts, box, exists, first_attr, first_inner_text, first_list, first_of, first_outer_or_text,
    first_text, outer_html, parse_nodes, select,
)


def parsed(spark, html, used=None, **kw):
    return spark.createDataFrame([(html,)], "html string").coalesce(1).select("html", parse_nodes(F.col("html"), used, **kw).alias("nodes"))


def value(df, sql):
    return df.select(F.expr(sql).alias("r")).first()["r"]


def shape(df):
    return [(n["tag"], n["parent"]) for n in df.first()["nodes"]]


def tree(spark, html):
    nodes = parsed(spark, html).first()["nodes"]
    tags = {n["idx"]: n["tag"] for n in nodes}
    return [(n["tag"], tags.get(n["parent"])) for n in nodes[1:]]


def test_unclosed_elements(spark):
    assert tree(spark, "<div><p>a<b>x<p>c<ul><li>1<li>2</ul><table><tr><td>k<td>v<tr><td>q</table></div>") == [
        ("div", "#page"), ("p", "div"), ("b", "p"), ("p", "div"), ("ul", "div"), ("li", "ul"), ("li", "ul"),
        ("table", "div"), ("tr", "table"), ("td", "tr"), ("td", "tr"), ("tr", "table"), ("td", "tr")]
    assert tree(spark, "<ul><li>a<ul><li>b</ul><li>c</ul>") == [
        ("ul", "#page"), ("li", "ul"), ("ul", "li"), ("li", "ul"), ("li", "ul")]
    assert tree(spark, "<select><option>a<option>b</select><dl><dt>k<dd>v<dt>l</dl>") == [
        ("select", "#page"), ("option", "select"), ("option", "select"), ("dl", "#page"), ("dt", "dl"), ("dd", "dl"), ("dt", "dl")]
    assert tree(spark, "<b>a<br>b<img src=x>c</b></i><u>d") == [
        ("b", "#page"), ("br", "b"), ("img", "b"), ("u", "#page")]


def test_attributes_and_text(spark):
    df = parsed(spark, """<a HREF='/x?a=1&amp;b=2' data-n disabled=1 class="p  q" title="a>b">A &lt; B<!-- c --> D</a>
      <script>if (a<b) { t="</p>" }</script><p title="it's" rel=x/>e</p><br/>""")
    a = df.first()["nodes"][1]
    assert a["attrs"] == {"href": "/x?a=1&b=2", "data-n": "", "disabled": "1", "class": "p  q", "title": "a>b"}
    assert a["cls"] == " p q " and [t["text"] for t in a["texts"]] == ["A < B", " D"] and a["alltext"] == "A < B D"
    assert value(df, first_text(select("nodes", Sel("script")))) == 'if (a<b) { t="</p>" }'
    assert value(df, first_attr(select("nodes", Sel("p")), "title")) == "it's"


def test_broken_markup_ends(spark):
    for html in ("", "<", "<a", "<a href='x", "a<b", "<!-- open", "<script>x", "</p></p>", "<p <b>x</b>", "<a b='1\"<c>'>"):
        assert parsed(spark, html).first()["nodes"][0]["tag"] == "#page"
    assert parsed(spark, None).first()["nodes"] is None


def test_selectors(spark):
    df = parsed(spark, """<div class="box main-box"><a rel="next" href="/n">N<i>x</i></a><a class="b">M</a></div>
      <a href="/o">O</a><div id="e" data-kind="my-kind"><p>t1<b>t2</b>t3</p></div>""")
    hrefs = lambda *s: value(df, all_attrs(select("nodes", s), "href"))
    assert hrefs(Sel("a")) == ["/n", "/o"]
    assert hrefs(Sel("a", within=Sel(cls="box"))) == ["/n"]
    assert hrefs(Sel("a", attr="rel", eq="next")) == ["/n"]
    assert hrefs(Sel("a", contains="Nx")) == ["/n"]
    assert hrefs(Sel("a", within=Sel(cls="none"))) == []
    assert value(df, f"size({select('nodes', Sel(cls_has=('ain-b',)))})") == 1
    assert value(df, f"size({select('nodes', Sel(attr='data-kind', has='kind'))})") == 1
    assert value(df, all_texts(select("nodes", (Sel("b"), Sel("p"))))) == ["t1", "t2", "t3"]
    assert value(df, first_text(select("nodes", Sel("a", is_last=True)))) == "M"
    assert value(df, first_text(select("nodes", (Sel("a", is_first=True),)))) == "N"
    assert value(df, first_inner_text(select("nodes", Sel(attr="id", eq="e")))) == "t1"
    assert value(df, exists("nodes", Sel("p"))) and not value(df, exists("nodes", Sel("h1")))
    mixed = (Sel("a", within=Sel(cls="box")), Sel("b"))
    assert value(df, f"transform({select('nodes', mixed)}, n -> n.tag)") == ["a", "a", "b"]


def test_outer_html_and_fallbacks(spark):
    df = parsed(spark, '<i class="k">K</i><u class="l">L</u><b title="">B</b>')
    assert value(df, outer_html(f"try_element_at({select('nodes', Sel(cls='k'))}, 1)", "html")) == '<i class="k">K</i>'
    first = lambda a, b: value(df, first_outer_or_text(select("nodes", a), select("nodes", b), "html"))
    assert first(Sel(cls="k"), Sel(cls="l")) == '<i class="k">K</i>'
    assert first(Sel("b"), Sel(cls="l")) == "L"
    assert value(df, first_of(first_attr(select("nodes", Sel("b")), "title"), first_text(select("nodes", Sel("u"))))) == "L"
    assert value(df, first_list(all_texts(select("nodes", Sel("p"))), all_texts(select("nodes", Sel("u"))))) == ["L"]


def test_pruned_nodes_give_the_same_answers(spark):
    html = '<div class="a&#98;"><p>x</p></div>' + '<div><span class="price">1</span><a href="/x">y</a></div>' * 20
    sels = [Sel("a", within=Sel("div")), Sel(cls="price"), Sel(cls="ab"), Sel(attr="HREF".lower())]
    full, pruned = parsed(spark, html), parsed(spark, html, sels)
    assert len(pruned.first()["nodes"]) < len(full.first()["nodes"])
    for s in sels:
        ids = f"transform({select('nodes', s)}, n -> n.idx)"
        assert value(full, ids) == value(pruned, ids) != []


def test_index_gives_what_a_walk_over_the_nodes_gives(spark):
    rng = random.Random(4)
    tags = ["<div class='box'>", "<div class=' main box-wide'>", "<a href='/x' rel=next>", "<a class=box>go", "<span data-k='one two'>",
            "<li>", "<i>", "<b class=\"a&#98;\">t", "<img class='box' src=s>", "</div>", "</a>", "</span>", "</li>", "</i>", " x "]
    pages = ["".join(rng.choices(tags, k=rng.randrange(60))) for _ in range(60)] + ["", None]
    sels = [
        Sel("a"), Sel(cls="box"), Sel(cls="ab"), Sel(cls_has=("ox-", "main")), Sel(attr="data-k", has="two"), Sel("a", attr="rel", eq="next"),
        Sel("li", is_first=True), Sel("li", is_last=True), Sel("a", contains="go"), Sel("i", within=Sel("div")), Sel("img", attr="src"),
        Sel("i", within=(Sel(cls="box"), Sel("span", attr="data-k"))), Sel("i", within=Sel("a", within=Sel("div", cls="box"))),
        Sel("b", within=Sel("li", is_first=True)), Sel("h1"),
    ]
    some = [(sels[0], sels[1]), (sels[9], sels[5], sels[6]), (sels[-1],)]
    df = spark.createDataFrame([(h,) for h in pages], "html string").coalesce(2)
    numbers = lambda found: F.expr(f"transform({found}, n -> n.idx)")
    for used, index in ((sels, None), (None, sels)):
        nodes = df.select(parse_nodes(F.col("html"), used, index=index).alias("nodes"))
        columns = [(numbers(select("nodes", s)), numbers(select(PageNodes("nodes"), s))) for s in [*sels, *some]]
        columns += [(F.coalesce(F.expr(exists("nodes", s)), F.lit(False)), F.expr(exists(PageNodes("nodes"), s))) for s in [*sels, *some]]
        inner = "filter(nodes, n -> n.idx >= {0}.idx AND n.idx <= {0}.last)"
        columns += [(F.expr(f"transform(nodes, o -> transform({inner.format('o')}, n -> n.idx))"),
                     F.expr(f"transform(nodes, o -> transform({box('nodes', 'o')}, n -> n.idx))"))]
        got = nodes.select(*[c.alias(f"c{i}_{k}") for i, pair in enumerate(columns) for k, c in enumerate(pair)]).collect()
        assert len(got) == len(pages)
        for page, r in zip(pages, got):
            assert not [(i, r[f"c{i}_0"], r[f"c{i}_1"], page) for i in range(len(columns)) if r[f"c{i}_0"] != r[f"c{i}_1"]]
        for i in range(len(sels) - 1):
            assert any(r[f"c{i}_1"] for r in got), sels[i]


def test_index_of_deep_pages_takes_linear_time():
    n = 20_000
    index = nodes._Index([Sel("i", within=Sel("div", within=Sel(cls="top"))), Sel("p")])
    read = nodes._StartTags(nodes._Keep.of([Sel("i"), Sel("div"), Sel("p"), Sel(cls="top")]), index)
    began = time.perf_counter()
    page = nodes._read_page("<div class=top>" + "<div><u>" * n + "<i>x</i>" * n, frozenset(), read)
    found = index.hits(page)
    assert time.perf_counter() - began < 3
    assert sorted(len(v) for v in found.values()) == [0, n]


def test_many_pages_in_one_batch(spark):
    pages = spark.range(3000).selectExpr("id", "repeat(concat('<p class=\"c\">', id, '</p>'), 40) AS html").repartition(2)
    nodes = pages.select("id", parse_nodes(F.col("html")).alias("nodes"))
    bad = nodes.where(F.expr(f"size({select('nodes', Sel(cls='c'))}) <> 40 OR {first_text(select('nodes', Sel('p')))} <> id"))
    assert bad.count() == 0


def test_broken_pages_take_linear_time(spark):
    n = 20_000
    pages = {
        "stray": "<div>" * n + "</b>" * n, "spans": "<span>" * n + "<p>x" * n,
        "links": "".join(f'<a href="/{i}">word {i} ' for i in range(n)),
    }
    for page in pages.values():
        began = time.perf_counter()
        found = nodes._read_page(page, frozenset(("a",)))
        assert time.perf_counter() - began < 1
        assert sum(len(t) for f in found[1:] for t in f.deep or ()) <= len(page)
    links = nodes._read_page(pages["links"], frozenset(("a",)))[1:]
    assert [f.attrs["href"] for f in links[:2]] == ["/0", "/1"] and "".join(links[0].deep) == "word 0 "


def test_start_tags_close_up_to_the_nearest_fence():
    found = nodes._read_page("<ul><li>a<ul><li>b<li>c</ul><li>d</ul><p>x<div>y<p>z</div><a>1<div><a>2</a></div></a>", frozenset())
    shown = [(f.tag, f.parent.tag) for f in found[1:]]
    assert shown == [("ul", "#page"), ("li", "ul"), ("ul", "li"), ("li", "ul"), ("li", "ul"), ("li", "ul"),
                     ("p", "#page"), ("div", "#page"), ("p", "div"), ("a", "#page"), ("div", "a"), ("a", "div")]


def _read(pages, sels, shortest=None):
    """Pages read one after the other; ``shortest`` 0 has every tag read by pattern."""
    index = nodes._Index(sels)
    tags = nodes._StartTags(nodes._Keep.of(sels), index)
    if shortest is not None:
        tags._SHORT = shortest
    read = [nodes._read_page(p, frozenset(("a",)), tags) for p in pages]
    return read, nodes._to_arrow(read, index)


def test_tags_known_by_their_text_are_read_as_by_pattern():
    rng = random.Random(7)
    bits = [
        "<a href='/x' rel=next>", "<a class=box>go", "<a href=/x/>", "<b class=\"a&#98;\">t", "</a>", "</b>", "</ b>", "</b \"x>", "<P/>",
        " x ", "<", "<<", ">", "< a", "<a b=\"1>", "<a b='", "\"", "'", "<p <b>", "<p =x>", "<p a=x\"y c=\"z>", "<p a=\"x\"b=y>", "<p a= >",
        "<p a=\"<\">", "<p a=\">\">", "<p a='1\">", "<x\"y>", "<script>", "</script>", "<!-- c -->", "<!--", "<?x>", "<li>", "<td>",
        "<table>", "</table>", "<label>A&amp;b</label>", f"<p {'z ' * 120}>", "\n",
    ]
    pages = ["".join(rng.choices(bits, k=rng.randrange(60))) for _ in range(2000)]
    sels = [Sel("a"), Sel(cls="box"), Sel(cls="ab"), Sel("p"), Sel("li", is_last=True), Sel("label", within=Sel("p")), Sel(attr="b"), Sel("a", contains="go")]
    assert _read(pages, sels)[1].equals(_read(pages, sels, shortest=0)[1])


def test_tags_met_before_are_not_looked_at_by_pattern(monkeypatch):
    class Counting:
        looks = 0

        def search(self, html, at):
            Counting.looks += 1
            return token.search(html, at)

    token = nodes._TOKEN
    monkeypatch.setattr(nodes, "_TOKEN", Counting())
    page = "<div class='a'><p>x</p><img src=y></div>" * 20
    read, _ = _read([page] * 50, [Sel(cls="a"), Sel("p")])
    assert [len(r) for r in read] == [41] * 50 and Counting.looks <= 1


def test_signs_that_open_no_tag_take_linear_time():
    for page in ("< " * 200_000 + ">", "<1" * 200_000, "<" * 200_000, "</ " * 200_000 + ">"):
        began = time.perf_counter()
        nodes._read_page(page, frozenset())
        assert time.perf_counter() - began < 3


def test_elements_that_are_not_wanted_take_up_little():
    page = ("<div><i>x</i><u class=b>1</u><br><img src=q><u class=b>2<i>y</i></u><div>SKU<label class=b>k</label>v</div></div>"
            "<p><u class=b>3</p><u class=b>4</i></u></div>")
    keep = nodes._Keep.of([Sel(cls="b")])
    found = nodes._read_page(page, frozenset(("a",)), nodes._StartTags(keep, None))
    whole = [n for n in nodes._read_page(page, frozenset(("a",))) if n.tag == "#page" or n.cls == " b "]
    told = ("idx", "last", "tag", "cls", "attrs", "first", "is_last", "pieces", "inner", "start", "stop")
    assert [[getattr(n, t) for t in told] for n in found] == [[getattr(n, t) for t in told] for n in whole]
    assert [n.parent and (n.parent.idx, n.parent.pieces) for n in found] == [n.parent and (n.parent.idx, n.parent.pieces) for n in whole]
    assert not any(hasattr(n.parent, "attrs") for n in found if n.parent is not None and n.parent.tag != "#page")
