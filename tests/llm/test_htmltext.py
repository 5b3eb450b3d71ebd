import random

from pyspark.sql import functions as F

from gleanery.llm import htmltext as H


def page(rng, k, article, site="a"):
    nav = "".join(f"<li><a href='/{x}'>menu{x}</a></li>" for x in range(rng.randrange(1, 6)))
    paragraphs = "".join(rng.choice(["<p>{}</p>", "<p><b>{}<br>", "<p class=x>{}</p>\n"]).format(p) for p in article[1:])
    extras = rng.choice(["", "<aside class='sidebar'>side note</aside>", "<div class='cookie-notice'>We use cookies</div>", "<form><label>Mail</label><input><button>Go</button></form>", "<div id='comments'><p>reader says hi</p></div>"])
    inner = f"<h1>{article[0]}</h1>{paragraphs}"
    body = f"<article>{inner}{extras}</article>" if site == "a" else f"<div class='post content'>{inner}</div>{extras}" if site == "b" else f"<main>{inner}</main>{extras}"
    return f"<!DOCTYPE html><html><head><title>t{k}</title><script>var a='</p><article>';</script><style>p{{}}</style></head><body><header>Site {site}</header><nav><ul>{nav}</ul></nav><div class='ad'>Buy {k}</div>{body}<footer>&copy; {k}" + rng.choice(["</footer></body></html>", "</footer>", ""])


def test_main_text_of_three_layouts(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for k in range(90):
        site = "abc"[k % 3]
        raw = [f"Head {k} &amp; co", *[f"par{k} <i>in</i>line  {x}\n &eacute;&nbsp;&#233; 1 &lt; 2" for x in range(rng.randrange(1, 5))]]
        rows.append((k, f"http://{site}.example.org/{k}", page(rng, k, raw, site)))
        want[k] = " ".join([f"Head {k} & co", *[f"par{k} inline {x} é é 1 < 2" for x in range(len(raw) - 1)]])
    odd = [(900, None, None), (901, "nonsense", ""), (902, "http://a.example.org/x", "plain text only"), (903, "http://z.org", "<p>unclosed <b>bold"), (904, "http://z.org", "<" * 3000), (905, "http://a.example.org/", "<nav><article><p>inside</p></article></nav>"), (906, "http://q.org", "<div " * 500), (907, "http://q.org", '<p title="unclosed>text')]
    df = spark.createDataFrame(rows + odd, "page_id long, url string, html string").withColumns({"text": F.lit("clash"), "host": F.lit("h"), "_place": F.lit("p")}).drop("_place")
    out = {r.page_id: r.text for r in H.main_text(df.repartition(6)).collect()}
    assert len(out) == len(rows) + len(odd) and all(t is not None for t in out.values())
    assert {k: out[k] for k in want} == want
    assert out[900] == out[901] == "" and out[902] == "plain text only" and out[903] == "unclosed bold"
    assert H.main_text(df.limit(0)).count() == 0


def wrapper_of(pages):
    whole = {}
    for p in pages:
        whole = H.merge(whole, H.infer(p))
    return whole


def test_wrapper_has_slots_options_and_repeats():
    pages = ["<div><h1>A</h1><p>x</p><p>y</p><p>z</p></div>", "<div><h1>B</h1><p>x</p></div>", "<div><h1>A</h1><p>x</p><p>q</p><ul><li>i</ul></div>"]
    assert H.expression(wrapper_of(pages)) == "(div(h1(#) p(#)+ ul(li(#))?))"
    stamped = [f"<div><h1>Title {k}</h1><b>Printed</b><p>longest text {k}</p></div>" for k in range(H.CONSTANT_PAGES)]
    assert H.expression(wrapper_of(stamped)) == "(div(b(=) h1(#) p(#)))"
    rng = random.Random(3)
    for _ in range(5):  # the order of pages doesn't matter
        rng.shuffle(pages)
        halves = H.merge(wrapper_of(pages[:1]), H._loads(H._dumps(wrapper_of(pages[1:]))))
        assert H.expression(halves) == "(div(h1(#) p(#)+ ul(li(#))?))"


def test_template_texts_inside_the_article_are_dropped():
    rule = H.reading(wrapper_of([f"<article><h1>Title {k}</h1><div><span>Printed by robots</span></div><p>a text {k}<div class=x>Share this</div><p>more {k}</article>" for k in range(8)]))
    assert H.extract("<article><h1>T</h1><div><span>Printed by robots</span></div><p>u<div class=x>Share this</div></article>", H.Rule.loads(rule.dumps())) == "T u"
    assert H.extract("<article><h1>T</h1><p>Printed by robots</article>", rule) == "T Printed by robots"  # not at that position
    # pages that are all alike keep their text, and so do copies of one page among others
    alike = "<article><h1>Same</h1><p>same text</p><pre>quoted</pre></article>"
    assert H.extract(alike, H.reading(wrapper_of([alike] * 8))) == "Same same text quoted"
    assert H.extract(alike, H.reading(wrapper_of([alike] * 8 + [f"<article><h1>Other {k}</h1><p>text {k}</article>" for k in range(8)]))) == "Same same text quoted"


def test_the_wrapper_finds_articles_that_no_name_tells():
    page = lambda k: (
        f"<body><div id=lead>Daily News<ul><li><a href=/>home</a><li><a href=/{k}>page {k}</a></ul></div><div id=x><div id=y><h2>Head {k}</h2><p>first paragraph {k} with "
        f"<a href=/>a link</a> in it</p><p>second one {k}</p><ul><li><a href=/a>older piece {k}</a><li><a href=/b>newer piece {k}</a></ul></div></div><div id=foot>All rights reserved</div></body>"
    )
    rule = H.reading(wrapper_of([page(k) for k in range(20)]))
    assert H.extract(page(77), rule) == "Head 77 first paragraph 77 with a link in it second one 77"
    assert H.extract(page(77)) != H.extract(page(77), rule) and "All rights" in H.extract(page(77))


def test_recurring_prose_stays():
    recipes = [f"<body><header>Site</header><article><h1>Cake {k}</h1><h2>Ingredients</h2><ul><li>Salt<li>{k} eggs</ul><h2>Method</h2><p>Mix {k} times.<p>Serve.</article><footer>x</footer></body>" for k in range(6)]
    rule = H.reading(wrapper_of(recipes))
    assert [H.extract(p, rule) for p in recipes] == [f"Cake {k} Ingredients Salt {k} eggs Method Mix {k} times. Serve." for k in range(6)]
    minutes = [f"<article><h1>Minutes {k}</h1><p>The meeting was opened.</p><p>Point {k}</p><p>The meeting was closed.</p></article>" for k in range(6)]
    assert [H.extract(p, H.reading(wrapper_of(minutes))) for p in minutes] == [f"Minutes {k} The meeting was opened. Point {k} The meeting was closed." for k in range(6)]


def test_words_cut_inside_an_article_only_with_the_wrapper():
    page = lambda k: (
        f"<article class='post {'sports politics'.split()[k % 2]}'><h1>T {k}</h1><div class='social history'>A social history {k}</div><p class=search>The search {k}</p>"
        f"<table class=alerts><tr><td>alert {k}</table><div class='share now'>Share it now</div><div class='related reading'><a href=/>more {k}</a></div><div class=comments><p>hello {k}</div><div class=y>Share this now.</div></article>"
    )
    for n in (1, 12):
        rule = H.reading(wrapper_of([page(k) for k in range(n)]))
        assert H.extract(page(0), rule) == "T 0 A social history 0 The search 0 alert 0" + (" Share it now Share this now." if n == 1 else "")


def test_depth_does_not_matter():
    for depth in (50, 21_000):
        page = lambda k: f"<body><article><p>text {k}</p>" + "<div>" * depth + "the same notice" + "</div>" * depth + f"<p>end {k}</article></body>"  # noqa: E731, B023
        wrapper = wrapper_of([page(k) for k in range(6)])
        assert H.extract(page(3), H.reading(wrapper)) == "text 3 end 3" and len(wrapper) <= H.DEEP + 10


def test_positions_over_the_bound_go_in_any_order_alike(monkeypatch):
    monkeypatch.setattr(H, "POSITIONS", 30)
    rng = random.Random(1)
    pages = ["<body><article><p>a</p>" + "".join(f"<div class='{''.join(rng.choices('abcdefgh', k=3))}'><b>x{rng.random()}</b></div>" for _ in range(12)) + "</article></body>" for _ in range(40)]
    found = set()
    for _ in range(6):
        rng.shuffle(pages)
        k = rng.randrange(1, 39)
        found.add(str(sorted(H._trimmed(H.merge(wrapper_of(pages[:k]), wrapper_of(pages[k:]))).items())))
    assert len(found) == 1 and len(H._trimmed(wrapper_of(pages))) == 30


def test_alignment_matches_a_plain_statement():
    """Positions, pages, repetition and constant texts restated from the paths of all pages at once."""
    rng = random.Random(11)
    names = ["div", "section", "div class=u", "b", "p"]

    def tree(depth):
        return [rng.choice(["alpha", "beta", "gamma"]) if depth > 2 or rng.random() < 0.4 else (rng.choice(names), tree(depth + 1)) for _ in range(rng.randrange(1, 4))]

    def write(nodes):
        return "".join(f"<i>{x}</i>" if isinstance(x, str) else f"<{x[0]}>{write(x[1])}</{x[0].split()[0]}>" for x in nodes)

    def paths(nodes, above, out, seen):
        for x in nodes:
            name = "i" if isinstance(x, str) else x[0].replace(" class=", ".")
            at = (*above[0], name)
            node = out.setdefault(at, [False, set()])
            node[0] |= seen.get(at) == above[1]
            seen[at] = above[1]
            if isinstance(x, str):
                node[1].add(x)
            else:
                paths(x[1], (at, object()), out, seen)
        return out

    for _ in range(30):
        trees = [[("section", tree(0))] for _ in range(5)]
        wrapper = wrapper_of([write(t) for t in trees])
        by_path = {}
        for at, x in wrapper.items():
            path, up = (), at
            while up != H.ROOT:
                path, up = (wrapper[up][H.NAME], *path), wrapper[up][H.ABOVE]
            by_path[path] = x
        each = [paths(t, ((), 0), {}, {}) for t in trees]
        want = {}
        for own in each:
            for path, (again, texts) in own.items():
                n, r, sets = want.get(path, (0, False, []))
                want[path] = (n + 1, r or again, [*sets, frozenset(texts)])
        assert set(by_path) - {()} == set(want)
        for path, (n, again, sets) in want.items():
            x = by_path[path]
            assert (x[H.PAGES], x[H.REPEATED], x[H.VARY]) == (n, again, len(set(sets)) > 1)
            assert x[H.SAME] == sorted(H._crc(t) for t in frozenset.intersection(*sets))


def test_deep_and_long_pages(spark):
    deep = "<section>" * 1200 + "<p>deep text</p>" + "</section>" * 1200
    long = "<body>" + "".join(f"<div>block {k}</div><p>par {k}" for k in range(50_000)) + "</body>"
    odd = "".join(f"<div class='{'abcdefghij'[k % 10]}{chr(97 + k // 10 % 26)}{chr(97 + k // 260 % 26)}{chr(97 + k // 6760)}'>d{k}</div>" for k in range(30_000))
    df = spark.createDataFrame([(k, "http://h.org/", p) for k, p in enumerate([deep, deep, long, odd, odd, None])], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in H.main_text(df).collect()}
    assert got[0] == got[1] == "deep text" and got[5] == ""
    assert got[2] == " ".join(f"block {k} par {k}" for k in range(50_000))
    assert got[3] == got[4] == " ".join(f"d{k}" for k in range(30_000))
    assert len(H._trimmed(wrapper_of([odd, deep]))) == H.POSITIONS


def test_rules_too_large_to_broadcast_meet_hot_hosts_where_they_are(spark, monkeypatch):
    rows = [(k, f"http://{'hot' if k % 3 else f'h{k % 11}'}.org/", f"<body><article><h1>T {k}</h1><div>Share</div><p>text {k}</article>") for k in range(900)]
    df = spark.createDataFrame([*rows, (900, None, None)], "page_id long, url string, html string")
    whole = sorted(map(tuple, H.main_text(df).select("page_id", "text").collect()))
    assert whole[1] == (1, "T 1 text 1")
    monkeypatch.setattr(H, "BROADCAST_BYTES", 0)
    parted = H.main_text(df)
    assert sorted(map(tuple, parted.select("page_id", "text").collect())) == whole


def test_clashing_names_stay(spark):
    names = ["at", "host", "rule", "whole", "_host", "_place", "at_", "path"]
    df = spark.createDataFrame([(1, "http://h.org/", "<p>t", *names)], "page_id long, url string, html string, " + ", ".join(f"{n} string" for n in names))
    row = H.main_text(df).first()
    assert row.text == "t" and [row[n] for n in names] == names and H.main_text(df).columns == [*df.columns, "text"]


def test_long_containers_of_unclosed_elements_end():
    for n in (5, 198, 199, 3000):
        menu = "<ul class='menu'>" + "<li>entry" * n + "</ul>"
        assert H.extract(f"<article><p>start{menu}<p>rest</article>after") == "start rest"
        text = "<article>" + "<p>word" * n + "</article>"
        assert H.extract(f"<body>{text}<div>unlabelled</div></body>") == " ".join(["word"] * n)
        stream = H.tokens(menu)
        assert H.pairs(stream)[0] == len(stream) - 1
    assert H.extract("<article><p class='ad'>buy<p>text<table><tr><td class='ad'>buy<td>cell<tr><td>more</table></article>") == "text cell more"
