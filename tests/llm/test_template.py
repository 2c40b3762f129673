import random

from dcflow.llm import template as T


def test_parse_keeps_article_text_only():
    page = ("<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t='</p>';</script></head><body>"
            "<header>site</header><nav><ul><li><a>m</a></li></ul></nav><div class=ad>buy</div><div id='cookie-notice'>ok?</div>"
            "<article class='post x'><header><h1>A &amp;  B</h1></header><p><b>one<br><p>t<i>w</i>o&nbsp;3 &copy;</p>"
            "<form><input>f</form><div class=\"comments\"><p>troll</p></div><!-- x --><aside>side</aside>end</article><footer>foot</footer></body></html>")
    assert [t for _, t in T.parse(page)[1]] == ["A & B", "one", "two 3 ©", "end"]
    assert [t for _, t in T.parse("<article><p>cut &am</p><p>x &amp")[1]] == ["cut &am", "x &"]
    assert [t for _, t in T.parse("<article>one<p cla")[1]] == ["one"]
    assert T.parse("")[1] == T.parse("<script>never closed <p>x")[1] == []
    assert len(T.parse("<div>" * 5000 + "deep")[1]) == 1


def test_template_text_goes_and_slots_stay(spark):
    rnd = random.Random(1)
    rows, want = [], {}
    for i in range(60):
        body = " ".join(rnd.choice("abcdefgh") * 3 for _ in range(30))
        rows.append((i, f"http://a.example/{i}", f"<body><div class=top>Fixed line</div><div class='c{i}'><p>Same on all.</p><p>{body} {i}</p></div></body>"))
        want[i] = f"{body} {i}"
    for i in range(100, 104):  # too few distinct pages to know template text
        rows.append((i, "http://b.example/x", f"<main><p>Twice.</p><p>own {i}</p></main>"))
        want[i] = f"Twice. own {i}"
    rows += [(200, None, "<article>no host</article>"), (201, "http://a.example/odd", "<article>other layout</article>"), (202, "u", None), (203, "u", ""),
             (None, "http://c.example/", "x"), (None, "http://c.example/", "x")]
    want |= {200: "no host", 201: "other layout", 202: "", 203: "", None: "x"}
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, host string")
    got = T.main_text(pages).collect()
    assert len(got) == len(rows)
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert T.main_text(pages.limit(0)).count() == 0


def test_given_pages_equal_a_plain_reading(spark):
    """The given pages have one layout: what stands in the article, block by block."""
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in T.main_text(pages).collect()}
    for r in pages.collect():
        m = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S)
        inner = re.sub(r"<[^>]*\Z", "", m[1]) if m else ""
        parts = re.split(r"</?(?:h1|p|br|article)>", inner)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts]
        assert got[r["page_id"]] == " ".join(x for x in parts if x), r["page_id"]


def test_classes_decide_the_slot(spark):
    """Chrome that no word list names lies outside the slot; equal text between slots stays."""
    rows = [(i, "http://c.example/", f"<div class=zork><p>Fixed top</p></div><div class=quux><p>first {i} {'x' * i} word</p><p>In between.</p>"
             f"<p>last {i} text</p></div><div class=blub><p>Fixed end</p></div>") for i in range(1, 6)]
    rows += [(10 + i, "http://d.example/", "<div><p>Up</p><p>Down</p></div>".replace("Up", "Down" if i % 2 else "Up", 1)
              .replace("Down</p></div>", "Up</p></div>" if i % 2 else "Down</p></div>") + f"<p>own {i} words</p>") for i in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in T.main_text(pages).collect()}
    assert all(got[i] == f"first {i} {'x' * i} word In between. last {i} text" for i in range(1, 6))
    # members without one order are no template
    assert got[10] == "Up Down own 0 words" and got[11] == "Down Up own 1 words"
    members = T.classes(T.parsed(pages)).where("host = 'c.example'").first()["members"]
    assert len({(m["v1"], m["v2"]) for m in members}) == 1 and len(members) == 4 + 3


def test_copies_of_one_article_keep_their_text(spark):
    """Frequency alone drops nothing of the slot, and no count of pages switches the rule."""
    paras = [f"Paragraph {k} " + " ".join(f"word{k}x{j}" for j in range(40)) for k in range(6)]
    story = "".join(f"<p>{x}</p>" for x in paras)
    rows, want = [], {}
    for n in (9, 10, 30):
        for i in range(n):
            for tag in ("article", "div"):
                rows.append((len(rows), f"http://{tag}{n}.example/", f"<section><p>Menu {i}</p></section><{tag} class=s><p>{paras[0]}</p>{story}<p>copy {i}</p></{tag}>"))
                want[len(rows) - 1] = " ".join([paras[0], *paras, f"copy {i}"])
    for i in range(12):  # equal paragraphs inside articles that differ
        rows.append((len(rows), "http://equal.example/", f"<article><p>{paras[1]}</p><p>{' '.join(f'own{i}y{j}' for j in range(20))}</p></article>"))
        want[len(rows) - 1] = f"{paras[1]} {' '.join(f'own{i}y{j}' for j in range(20))}"
    got = T.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


def test_listed_words_empty_no_page(spark):
    pages = {"<body class='home has-sidebar'><p>one</p></body>": "one", "<article class='post comments-open'>two</article>": "two",
             "<main id='search'>three</main>": "three", "<div class='content no-ads'>four</div>": "four", "<body id=menu><p>five</p>": "five",
             "<div class='sidebar'><p>side</p><article>six<div class=comments><article>troll</article></div></article></div>": "six",
             "<div class='widget'>seven</div>": "seven", "<div id=content>eight</div><div class='ad-banner x'>buy</div>": "eight",
             "<div class=ad>" * 60 + "nine": "nine", "<article></article><div>ten</div>": "ten", "<nav>menu</nav>": ""}
    rows = [(k, f"http://h{k}.example/", html) for k, html in enumerate(pages)]
    got = {r["page_id"]: r["text"] for r in T.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in range(len(rows))] == [*pages.values()]
    nodes, blocks, places, spare = T.parse("a<div class=ads>b</div><div class=promo><p>c</p><main>d</main></div>")
    assert [t for _, t in blocks] == ["a", "c", "d"] and spare == ["b"] and nodes[0][3] == 3 and places == sorted(places)


def test_one_long_page_does_not_decide_for_all(spark):
    words = lambda tag, n: " ".join(f"{tag}{j}" for j in range(n))
    page = lambda i, a, b: f"<div class=a><p>{words(f'a{i}x', a)}</p></div><div class=b><p>{words(f'b{i}x', b)}</p></div>"
    rows = [(0, "http://a.example/", page(0, 20000, 1))] + [(i, "http://a.example/", page(i, 2, 20)) for i in range(1, 8)]
    want = {0: words("a0x", 20000) + " " + words("b0x", 1)} | {i: words(f"b{i}x", 20) for i in range(1, 8)}
    # most pages have their text in div.b, one has it beside it
    rows += [(10 + i, "http://b.example/", page(i, 1, 50)) for i in range(6)] + [(20, "http://b.example/", page(9, 50, 5))]
    want |= {10 + i: words(f"b{i}x", 50) for i in range(6)} | {20: words("a9x", 50) + " " + words("b9x", 5)}
    got = {r["page_id"]: r["text"] for r in T.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_no_page_loses_its_body(spark):
    body = " ".join(f"body{i}" for i in range(60))
    deep = "<div>" * 70
    pages = {f"<body><form action=x><input type=hidden name=v><h1>Head</h1><p>{body}</p><button>Go</button></form></body>": f"Head {body}",
             f"<body><p title=it's>{body}</p><p>isn't it</p></body>": f"{body} isn't it",
             f"<body><div class=top><p>chrome top</p></div>{deep}<article><p>{body}</p></article>{'</div>' * 70}<p>chrome below</p></body>": body,
             f"<body><nav><a href=x>menu</a><article><p>{body}</p></article></body>": body,
             f"<body><div>Intro <button>Go<p>{body}</p><p>end</p></div></body>": f"Intro Go {body} end",
             f'<body><p ""x"">{body}</p><p class="a>b">more</p></body>': f"{body} more",
             f"<body><article><p>{body}</p><form><p>Leave a reply now</p><input><input></form></article></body>": body,
             f"<body><aside><article>teaser</article></aside><article>{body}</article></body>": body,
             f"<body><noscript>no script<p>{body}</p></body>": f"no script {body}",
             "<body><nav><ul><li><a href=x>one</a><li><a href=y>two</a>": "", "<form><label>Name</label><input></form>": ""}
    rows = [(k, f"http://h{k}.example/", html) for k, html in enumerate(pages)]
    got = {r["page_id"]: r["text"] for r in T.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k, want in enumerate(pages.values()):
        assert got[k] == want, (rows[k][2][:80], got[k][:80])


def test_parsing_is_linear():
    import time
    for page in (lambda n: "<div>" * n + "x" + "</p></section>" * n, lambda n: '<a "' * n, lambda n: "<div class=a><p>t</p>" * n, lambda n: '<a ="' * n + "<script " * n,
                 lambda n: "<nav><p>x" * n + "</nav>" * n):
        took = []
        for n in (10000, 40000):
            start = time.process_time()
            T.parse(page(n))
            took.append(time.process_time() - start)
        assert took[1] < 10 * took[0] + 0.2


def test_classes_equal_brute_force(spark):
    """The classes of a small host: tokens with equal counts on every distinct page, at most once a
    page, on half of the pages, two or more together."""
    rnd = random.Random(4)
    for trial in range(3):
        rows = []
        for i in range(8):
            parts = [f"<div class={c}><p>{c * 3}</p></div>" for c in "abcd" if rnd.random() < (0.9 if c < "c" else 0.4)]
            parts += ["<p>Always here</p>"] * rnd.randint(1, 2) + [f"<div class=own><p>own {trial} {i} {'w ' * rnd.randint(1, 9)}</p></div>"]
            rows.append((i, "http://x.example/", "<body>" + "".join(parts) + "</body>"))
        pages = T.parsed(spark.createDataFrame(rows, "page_id long, url string, html string"))
        vectors, content = {}, {}
        for r in pages.collect():
            content.setdefault(r["content"], r)
            if content[r["content"]]["page"] > r["page"]:
                content[r["content"]] = r
        for r in content.values():
            for x in r["tokens"]:
                vectors.setdefault(x["token"], {})[r["content"]] = (x["n"], x["rank"])
        groups = {}
        for token, seen in vectors.items():
            if all(n == 1 for n, _ in seen.values()) and 2 * len(seen) >= len(content) and (len(seen) > 1 or max(rank for _, rank in seen.values()) >= 0):
                groups.setdefault(frozenset(seen), set()).add(token)
        want = sorted(sorted(g) for g in groups.values() if len(g) > 1)
        told = {}
        for m in T.classes(pages).first()["members"]:
            told.setdefault((m["v1"], m["v2"]), []).append(m["token"])
        assert sorted(sorted(v) for v in told.values()) == want
