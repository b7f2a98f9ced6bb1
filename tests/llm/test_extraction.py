import random

from factweave.llm import wrappers

PAGES = "page_id long, url string, html string, text string, Html string"


def page(title, body, extra=""):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/a'>menu {title}</a></li></ul></nav>{body}{extra}<footer>&copy; foot</footer></body></html>"


def alone(html):
    """The main text of a host's only page."""
    return of_host([html])[0]


def of_host(pages):
    rule = wrappers.Rule.load(wrappers.rule_of(wrappers.load(wrappers.dump(wrappers.wrapper([wrappers.parse(p) for p in pages])))).dump())
    return [wrappers.main_text(p, rule) for p in pages]


def test_article_without_surroundings():
    html = page("T", '<div class="ad">Buy</div><article><h1>Head &amp; more</h1><p><b>First\n  part<br>line<p>Second &lt;p&gt; <i>it</i>alic</p><ul><li>one<li>two</ul><div class="comments"><p>me too</p></div><form>in<input></form><aside>by</aside></article>', "<section id=comments><p>reader</p></section>")
    assert alone(html) == "Head & more\n\nFirst part line\n\nSecond <p> italic\n\none\n\ntwo"


def test_odd_markup():
    assert alone("a < b <3 <!-- x --> c") == "a < b <3 c"
    assert alone("<article>x<script>if (a</b) '</article>'</script>y</article>") == "xy"
    assert alone("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"
    assert alone("<article><p title='a>b'>q</p><!-- never closed") == "q"
    assert alone("<p " * 2000 + "'").startswith("<p")
    assert alone("<article>" + "<p>word</p>" * 20000 + "</article>").count("word") == 20000


def test_only_true_marks_leave_out():
    for html in ['<article style="overflow:hidden"><p>a</p></article>', '<article><p title="hidden gem">a</p></article>', "<article><a href=/hidden-valley>a</a></article>", '<body class="no-sidebar"><article>a</article></body>', '<div class="has-sidebar"><article>a</article></div>', '<article><h1 class="entry-header">a</h1></article>']:
        assert alone(html) == "a", html
    for html in ["<article hidden>a</article>", "<article><div aria-hidden=true>a</div></article>", '<article><div class="x site-sidebar">a</div></article>', "<article><div role='navigation'>a</div></article>"]:
        assert alone(html) == "", html


def test_text_after_and_in_deep_elements():
    deep = "<div>" * 200 + "<p>x</p><aside>by<b>e</b></aside><p>y" + "</div>" * 200
    assert alone(f"<div><article>{deep}<p>after</p></article>out</div>") == "x\n\ny\n\nafter"


def test_wrapper_finds_groups_optionals_and_slots():
    pages = [page(str(i), "<div id=main><h1>t%d</h1>%s%s</div><div class=x>Always here</div>" % (i, "<h2>o</h2>" if i % 2 else "", "<p>text %d, and some more of it</p>" % i * (i + 1))) for i in range(4)]
    out = wrappers.wrapper([wrappers.parse(p) for p in pages])
    body = next(c for c in out.kids if c.key == "body")
    main = next(c for c in body.kids if c.key == "div id=main")
    kinds = {c.key: c for c in main.kids}
    assert kinds["h2"].o and not kinds["h1"].o and kinds["p"].r and kinds["h1"].kids[0].h is None and kinds["h1"].n == 4 and kinds["h2"].n == 2
    assert next(c for c in body.kids if c.key == "div class=x").kids[0].h is not None
    step = wrappers.wrapper([wrappers.wrapper([wrappers.parse(p) for p in pages[:2]]), wrappers.load(wrappers.dump(wrappers.wrapper([wrappers.parse(p) for p in pages[2:]])))])
    assert wrappers.dump(step) == wrappers.dump(out)
    assert wrappers.rule_of(out).path[-1] == "div id=main"
    assert of_host(pages)[2] == "\n\n".join(["t2"] + ["text 2, and some more of it"] * 3)


def test_tandem_groups_fold():
    items = [wrappers.Group(k, 0, wrappers.Part(k)) for k in ["dt", "dd", "dt", "dd", "dt", "dd"]]
    assert [(x.key, len(x.sides[0])) for x in wrappers.fold(items)] == [("dt", 3), ("dd", 3)]


def test_the_wrapper_decides():
    """The same page gives another text when its host's other pages, and so its wrapper, are others."""
    story = "<article><p>Share this story</p><h1>Title {0}</h1><p>Text number {0} is told here.</p></article>"
    mine = page("a", story.format(0))
    same = of_host([mine] + [page(str(i), story.format(i)) for i in range(1, 4)])[0]
    other = of_host([mine] + [page(str(i), f"<article><p>Opening {i}</p><h1>Title {i}</h1></article>") for i in range(1, 4)])[0]
    assert same == "Title 0\n\nText number 0 is told here." and other == "Share this story\n\n" + same
    # The region too: a teaser in an article, the text in an element without a name.
    split = "<article><p>One line {0}</p></article><section><h2>Part {0}</h2>" + "<p>A long text, number {0}, that goes on for a while.</p>" * 40 + "</section>"
    assert of_host([page(str(i), split.format(i)) for i in range(3)])[1].startswith("Part 1\n\nA long text, number 1")
    # Without the wrapper's rule everything that no mark leaves out is taken.
    assert wrappers.main_text(mine, wrappers.Rule([], [])).startswith("Share this story")


def test_menus_without_marks_are_left_out_by_their_links():
    menu = "<div class=rail><ul>" + "".join(f"<li><a href=/{i}>Entry {i} of {{0}}</a></li>" for i in range(30)) + "</ul></div>"
    pages = [page(str(i), menu.format(i) + f"<div class=text><h2>Head {i}</h2><p>Some words {i} with <a href=x>a link</a> in them.</p></div>") for i in range(4)]
    assert of_host(pages)[3] == "Head 3\n\nSome words 3 with a link in them."


def test_any_depth():
    for n in (119, 125, 130, 20000):
        for tag in ("div", "span"):
            html = page("d", f"<{tag}>" * n + "<article><p>in</p><aside>by</aside><div class=comments>no</div></article>" + f"</{tag}>" * n)
            assert alone(html) == "in", (n, tag)
    assert alone("<p>" + "<b>x" * 30000 + "</i>" * 30000).startswith("xxx")


def test_attributes_as_browsers_read_them():
    assert alone("<article class=o'neil><p>one</p><p>two's</p><p title='a\"b>c'>three</p></article>") == "one\n\ntwo's\n\nthree"
    assert alone('<article><p class="x" class=y data-a=1/2>q</p><p title="never closed>r</p></article>').startswith("q")
    assert alone("<article><p>kept</p><div class=") == "kept"
    assert alone("<title>t</title><p>no head, no body") == "no head, no body"
    assert alone("<article>x</><!--> y <!-- --!> z</ p></article>") == "x y z"


def test_wrappers_stay_small():
    """Thousands of pages with classes, ids and orders of their own."""
    r = random.Random(5)
    key = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    sizes = []
    top = None
    for batch in range(8):
        pages = [page(key(), "<article>" + "".join(f"<{t} class={key()}>{key()}</{t}>" for t in r.choices(["p", "h2", "ul", "pre", "section"], k=60)) + "</article>") for _ in range(40)]
        top = wrappers.wrapper([*([top] if top else []), *map(wrappers.parse, pages)])
        sizes.append(len(wrappers.dump(top)))
    assert sizes[-1] < 1.2 * sizes[1] and sizes[-1] < 100_000
    assert wrappers.main_text(pages[0], wrappers.rule_of(top)).count("\n\n") == 59


def site(r):
    """A host's template: a maker of (page, main text) pairs."""
    word = lambda: "".join(r.choice("abcdefghijklmno") for _ in range(r.randint(2, 9)))
    line = lambda a=6, b=30: " ".join(word() for _ in range(r.randint(a, b)))
    opening, closing = r.choice([("<article>", "</article>"), ("<main><article class=post>", "</article></main>"), ("<div id=content>", "</div>"), ("<div class='col wide'><div class=story>", "</div></div>"), ("<table><tr><td class=left>", "</td></tr></table>"), ("<main>", "</main>")])
    name, legal, share = line(2, 4), line(20, 60), line(2, 4)
    above = r.choice(["", f"<header><h1>{name}</h1></header>", f"<div class=top>{name}</div>"])
    below = r.choice(["", f"<div class=small>{legal}</div>", f"<footer>{legal}</footer>"])
    menu = "<div class=links><ul>" + "".join(f"<li><a href=/{i}>{line(1, 3)}</a></li>" for i in range(12)) + "</ul></div>"
    inside = r.choice(["", f"<div class=tools>{share}</div>", f"<p>{share}</p>"])

    def make():
        blocks, out = [line(3, 8)], []
        out.append(f"<h1>{blocks[0]}</h1>")
        for _ in range(r.randint(2, 9)):
            kind = r.choice(["p", "p", "p", "h2", "ul", "blockquote"])
            if kind == "ul":
                items = [line(2, 6) for _ in range(r.randint(2, 4))]
                blocks += items
                out.append("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>")
            else:
                blocks.append(line())
                out.append(f"<{kind}>{blocks[-1]}</{kind}>" if kind != "p" or r.random() < 0.7 else f"<p>{blocks[-1]}")
        out.insert(1, inside)
        comments = "<section class=comments>" + "".join(f"<div><b>{word()}</b><p>{line()}</p></div>" for _ in range(r.randint(0, 5))) + "</section>"
        advert = f"<div class=ad>{line()}</div>" if r.random() < 0.5 else ""
        extra = "".join(f"<li><a href=/x>{line(3, 9)}</a></li>" for _ in range(8))
        text = f"<html><head><title>{line(2, 5)}</title></head><body>{above}{menu}{advert}{opening}{''.join(out)}{advert}{closing}<div class=more><ul>{extra}</ul></div>{comments}{below}</body></html>"
        return text, "\n\n".join(blocks)

    return make


def test_generated_hosts_give_their_texts_back():
    r = random.Random(11)
    right = pages = 0
    for _ in range(40):
        make = site(r)
        made = [make() for _ in range(12)]
        got = of_host([p for p, _ in made])
        pages += len(made)
        right += sum(g == t for g, (_, t) in zip(got, made))
    assert right >= 0.98 * pages, (right, pages)


def test_rows(spark):
    rows = [(i, f"http://h{i % 2}.example.com/{i}", page(str(i), f"<article><p>text {i}</p></article>"), "c", "c") for i in range(6)]
    rows += [(6, None, page("n", "<main><p>null url</p></main>"), "c", "c"), (7, "no host", None, "c", "c"), (8, "http://h0.example.com", "", "c", "c"), (0, *rows[0][1:]), (None, "http://h0.example.com/x", "<p>no id</p>", "c", "c")]
    frame = spark.createDataFrame(rows, PAGES)
    got = wrappers.extract(frame).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    text = {r["page_id"]: r["text"] for r in got}
    assert [text[i] for i in range(6)] == [f"text {i}" for i in range(6)]
    assert text[6] == "null url" and text[7] == text[8] == "" and text[None] == "no id"
    assert wrappers.extract(frame.where("page_id < 0")).count() == 0
