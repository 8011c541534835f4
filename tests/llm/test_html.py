"""HTML extraction: the given pages against their markup, and odd pages."""

import re
from html import unescape

from pyspark.sql import functions as F

from cumulus.llm import html as H

LOREM = ("The house by the river was old and it was not in the best shape, but all of us had been "
         "there for so long that we would not have moved for the world, as far as I can tell. ")


def test_regions():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head>
    <body class="has-sidebar"><header>Site</header><nav><a href=x>Home</a></nav>
    <div class="cookie-notice">We use cookies and {LOREM}</div><div id=sideBar>{LOREM}</div>
    <article><h1>Ti&shy;tle &amp; more</h1><p>{LOREM}<b>bo</b>ld<br>x<p>Short.
    <ul><li>one</li><li>two &lt;3&nbsp; x</li></ul><form><p>{LOREM}</form>
    <script>var a = "</p><article>";</script><div class="ad">{LOREM}</div>
    <div class="comments"><article class="comment">{LOREM}</article></div></article>
    <aside>{LOREM}</aside><footer>{LOREM}</footer><!-- {LOREM} --></body>"""
    assert H.main_text(page) == f"Ti\xadtle & more {LOREM}bold x Short. one two <3 x"


def test_page_without_article():
    page = (f"<div>Home</div><ul><li><a href=/a>{LOREM}</a></ul><p>{LOREM * 2}</p><p>Yes.</p>"
            f"<p>{LOREM * 2}</p><div>Imprint</div><p><a>more</a></p>")
    got = [(b.text[:6], b.label) for b in H.label(H.blocks(page))]
    assert got == [("Home", "bad"), ("The ho", "bad"), ("The ho", "good"), ("Yes.", "good"),
                   ("The ho", "good"), ("Imprin", "bad"), ("more", "bad")]


def test_main_element_holds_the_text_where_there_is_no_article():
    page = f"<p>{LOREM}{LOREM}</p><main><h1>A</h1><p>{LOREM}</p><nav>x</nav></main><p>b</p>"
    assert H.main_text(page) == f"A {LOREM.strip()}"
    assert H.main_text(f"<main><p>{LOREM}</p><article>B c.</article></main>") == "B c."


def test_article_of_short_blocks_stays():
    assert H.main_text("<nav>x</nav><article><h1>A</h1><p>B c.</p></article><p>d</p>") == "A B c."


def test_names_are_no_veto():
    long = f"<p>{LOREM * 3}</p>"
    for start in ("<div class='layout has-sidebar'>", "<div class='no-sidebar'>", "<div class=sidebar>",
                  "<div class='elementor-widget-container'>", "<div id=header class=banner>"):
        for page in (f"{start}<article><h1>A</h1>{long}</article></div>",
                     f"{start}<h1>A</h1>{long}{long}</div><div class=ad>{LOREM * 2}</div>"):
            got = H.main_text(page)
            assert got.startswith("A The house") and got.count("by the river") % 3 == 0, (start, got)
    page = (f"<article><h2 id='sharing-data'>S</h2>{long}<section id='social-impact'><p>{LOREM}</p>"
            f"<h2 class=share id=related>R</h2>{long}</section><div class='share-buttons'>x {LOREM}</div>"
            f"<div class='cookie-notice'>{LOREM}</div></article>")
    got = H.main_text(page)
    assert got.startswith("S The") and " R The" in got and got.count("by the river") == 7


def test_teasers_in_articles_are_not_the_text():
    cards = "".join(f"<article><h3><a href=/{i}>Card {i}</a></h3><p>Read of the card {i}.</p></article>"
                    for i in range(6))
    body = f"<h1>A</h1><p>{LOREM * 3}</p><p>{LOREM * 2}</p>"
    for page in (f"<main>{body}</main><div>{cards}</div>", f"<main>{body}{cards}</main>",
                 f"<div>{body}</div><ul><li><a href=/a>{LOREM}</a></ul>{cards}"):
        got = H.main_text(page)
        assert got.count("by the river") == 5, got
    assert "Card" not in H.main_text(f"<main>{body}</main><div>{cards}</div>")
    page = f"<article>{body}</article><div>{cards}</div><p>{LOREM * 3}</p>"
    assert H.main_text(page).count("by the river") == 5


def test_stop_words_decide_inside_an_article():
    codes = " ".join(f"SKU{i}-{i * 7} stock {i}" for i in range(40))
    links = "".join(f"<a href=/{i}>{LOREM[:60]}</a> or " for i in range(9))
    got = [(b.text[:3], b.label) for b in H.label(H.blocks(
        f"<article><p>{LOREM * 2}</p><p>{LOREM * 2}</p><div><a>x</a></div><p>{codes}</p>"
        f"<div><a>{'y ' * 60}</a></div><p>{links}</p><div><a>z</a></div></article>"))]
    assert got == [("The", "good"), ("The", "good"), ("x", "bad"), ("SKU", "bad"), ("y y", "bad"),
                   ("The", "bad"), ("z", "bad")]
    foreign = "ŝipo maro vento nubo " * 12
    assert H.main_text(f"<article><p>{foreign}</p><p><a>x</a></p><p>{foreign}</p></article>").count("maro") == 24


MENU = "<div><a href=/1>{0}</a> <a href=/2>{1}</a></div><ul><li><a href=/3>{2}</a></li></ul>"
FOREIGN = {
    "ru": (MENU.format("Главная", "Новости", "О нас"), "Старый дом у реки",
           ["Дом у реки был старый, и в нём давно не жили, но мы не хотели уезжать, потому что в этом доме "
            "прошло всё наше детство, и каждый из нас помнил, как по вечерам на веранде пили чай и говорили о том, "
            "что будет с ним, когда мы вырастем и уедем в город.",
            "По утрам мы шли к реке, и отец брал с собой удочки, а мать давала нам хлеб и молоко, и мы не "
            "возвращались до обеда, потому что на реке было хорошо и тихо, и никто не звал нас домой, как это было в "
            "городе."], "© 2021 Все права"),
    "it": (MENU.format("Inizio", "Notizie", "Contatti"), "La casa sul fiume",
           ["La casa sul fiume era vecchia e non era in buono stato, ma per noi era il posto di tutta la vita, "
            "e non ci saremmo mossi per niente al mondo, perché nelle sere di estate si stava di fuori a parlare di "
            "quello che sarebbe stato di noi e della casa.",
            "Di mattina si andava al fiume, e il padre portava le canne, e la madre ci dava il pane e il latte, e non "
            "si tornava che a mezzogiorno, perché al fiume si stava bene e non ci chiamava nessuno, come in città."],
           "Tutti i diritti riservati"),
    "zh": (MENU.format("首页", "新闻", "关于我们"), "河边的房子",
           ["河边的房子已经很旧了，也不是很好看，可是我们在那里住了很久，谁也不想离开，因为那是我们长大的地方，"
            "每天晚上大家都在院子里喝茶，说着以后的事，说着我们长大以后要去的地方。",
            "早上我们去河边，父亲带着鱼竿，母亲给我们带了面包和牛奶，我们不到中午是不回家的，因为在河边很安静，"
            "也没有人叫我们回家，不像在城里的时候那样，我们都很喜欢那里。"], "版权所有"),
}


def test_pages_in_other_languages_without_an_article():
    for menu, title, parts, end in FOREIGN.values():
        body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in parts)
        want = " ".join([title, *parts])
        page = f"<body>{menu}<div>{body}</div><div><a href=/4>{end}</a></div></body>"
        assert H.main_text(page) == want
        assert H.main_text(f"<nav>{menu}</nav><article>{body}</article><footer>{end}</footer>") == want


def test_a_form_around_the_page():
    long = f"<p>{LOREM * 2}</p>"
    page = (f"<body><form id=aspnetForm method=post><div class=nav><a href=/>Home</a></div><input name=q>"
            f"{{}}<footer>{LOREM}</footer></form></body>")
    for body in (f"<article><h1>A</h1>{long}<p>B c.</p></article>", f"<div><h1>A</h1>{long}<p>B c.</p>{long}</div>"):
        got = H.main_text(page.format(body))
        assert got.startswith("A The house") and "B c." in got and got.count("by the river") in (2, 4), got
    short = page.format("<article><h1>A</h1><p>B c.</p></article>")
    assert H.main_text(short) == "A B c."
    contact = f"<h1>A</h1>{long}{long}<form><h2>Write to us</h2>{long}{long}<button>Send</button></form>"
    assert "Write" not in H.main_text(contact) and H.main_text(contact).count("by the river") == 4
    assert "Write" not in H.main_text(f"<article><h1>A</h1><p>B</p><form><p>Write {LOREM * 9}</form></article>")


def test_regions_that_are_never_closed():
    long = f"<p>{LOREM * 2}</p>"
    for start in ("<header>Site", "<nav><a href=/>Home</a>", "<div><nav><a href=/>Home</a><aside>"):
        for body in (f"<article><h1>A</h1>{long}</article>", f"<h1>A</h1>{long}<p>B c.</p>{long}",
                     "<main><p>B c.</p></main>"):
            got = H.main_text(f"<body>{start}{body}</body>")
            assert "B c." in got if "B c." in body else got.count("by the river") == 2, (start, got)
            assert "Home" not in got
    # Closed by what is around it: the menu stays a menu.
    page = f"<div><nav><a href=/>Home</a><p>{LOREM * 2}</div><article><h1>A</h1>{long}</article>"
    assert H.main_text(page) == f"A {(LOREM * 2).strip()}"
    page = f"<article><h1>A</h1>{long}<aside>{LOREM}</article><p>x</p>"
    assert H.main_text(page) == f"A {(LOREM * 2).strip()}"


def test_ties_between_neighbours():
    """Nearest good and bad block equally far: bad without an article, good in one."""
    good, bad = f"<p>{LOREM * 2}</p>", f"<p><a href=/>{'link' * 30}</a></p>"
    got = [b.label for b in H.label(H.blocks(f"{good}<p>tie</p>{bad}<p>tie</p>{good}"))]
    assert got == ["good", "bad", "bad", "bad", "good"]
    got = [b.label for b in H.label(H.blocks(f"<article>{good}<p>tie</p>{bad}</article>"))]
    assert got == ["good", "good", "bad"]


def test_odd_pages():
    for page, want in [(None, ""), ("", ""), ("<", ""), ("<!--", ""), ("a < b", "a < b"),
                       ("<article>x", "x"), ("<article>x</article", "x"), ("</p></article>", ""),
                       ("<article><p title='a>b'>y</p>", "y"), ("<article>&#x41;&#66;&amp;lt;", "AB&lt;"),
                       ("<article><script>x", ""), ("<article>x<script/>y", "x"), ("<article>x<div/>y", "x y"),
                       ("<article><p a=\"1>x</p>", None), ("<article>" + "<b>" * 5000 + "z", "z")]:
        got = H.main_text(page)
        assert want is None or got in (want, ""), page
    assert H.main_text("<article><p>" + "word " * 300_000) == ("word " * 300_000).strip()


def plain(html):
    """The given pages have one article element; its text, by substitution."""
    body = re.search(r"<article>(.*)</article>", html, re.S)[1]
    body = re.sub(r"</?(?:p|br|h1|h2|li|ul)>", " ", body)
    return " ".join(unescape(re.sub(r"<[^>]*>", "", body)).split())


def test_given_pages(spark):
    from cumulus.llm.queries import op1_html_extraction
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op1_html_extraction(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == plain(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"])
        assert r["url"] == pages[r["page_id"]]["url"]


def test_frame(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<article>é x"), (3, "u", "<article>é x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = [tuple(r["e"]) for r in df.select(H.extracted("html").alias("e")).collect()]
    assert got == [("", 0), ("", 0), ("é x", 3), ("é x", 3)]
    assert df.limit(0).select(H.extracted("html")).count() == 0
