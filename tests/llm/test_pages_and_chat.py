"""Main text of pages and repair of conversations."""

import html
import itertools
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from keelson.llm import chat, html_main

SF = "/root/testdata/sf0.01"
LONG = "This is a long paragraph of the article with a good number of plain words in it, enough to be dense. "


def test_given_pages_give_their_article(spark):
    rows = html_main.extract(spark.read.parquet(f"{SF}/pages.parquet")).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect()
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b)


def test_furniture_goes_and_the_article_stays_whole():
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body class="comment-page"><header><a href="/">Site</a></header>
      <nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav><div class="cookie-notice">{LONG * 5}</div>
      <main><article><header><h1>Short &amp; sweet</h1></header><p>{LONG}<p>One<b>two</b> three<br>four &lt;five&gt;<div class="ad">{LONG}</div>
      <ul><li>x<li>y</ul><table><tr><td>c1<td>c2</table><form><input><button>Go</button></form><script>if (a < b) {{ "</p>" }}</script>
      <section id="comments"><p>{LONG * 9}</p></section><aside>{LONG}</aside></article></main><footer>&copy; us</footer></body></html>"""
    assert html_main.main_text(page) == f"Short & sweet\n{LONG.strip()}\nOnetwo three four <five>\nx\ny\nc1\nc2"


def test_density_finds_unmarked_content():
    links = "".join(f"<li><a href='/{i}'>link number {i}</a></li>" for i in range(40))
    page = f"<div><ul>{links}</ul></div><div><div>{''.join(f'<p>{LONG}{i}</p>' for i in range(6))}</div></div><div>tiny</div>"
    assert html_main.main_text(page) == "\n".join(f"{LONG}{i}" for i in range(6))


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "plain text"), (4, "u", "<p>a<"), (5, "u", "<script>never closed <p>x"), (6, "u", "<p " * 2000), (7, "u", "<div>" * 3000 + "deep"), (8, "u", "<p>a</p>" * 20000), (8, "u", "a < b && c > d <3"), (9, "u", "<p>x</p></div></b></p><!-- <p>no</p>"), (10, "u", "<a title='>'>q</a>&nbsp;&#65;&#x42;&bogus;")]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = html_main.extract(pages).collect()
    assert len(got) == len(rows) and html_main.extract(pages.limit(0)).count() == 0
    texts = {(r["page_id"], r["_text"]) for r in got}
    assert {(1, ""), (2, ""), (None, "plain text"), (5, ""), (6, ""), (7, "deep"), (8, "a < b && c > d <3"), (9, "x"), (10, "q AB&bogus;")} <= texts
    assert (8, "\n".join(["a"] * 20000)) in texts


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(list("<>/pabdiv =\"'&;!- x")), max_size=60))
def test_any_page_can_be_read(page):
    assert isinstance(html_main.main_text(page), str)


def brute_cost(roles):
    """Least cost over every sequence of moves."""
    best = None
    for moves in itertools.product(range(len(chat._MOVES)), repeat=len(roles)):
        state, cost = "start", 0
        for number, role in zip(moves, roles):
            before, read, after, action = chat._MOVES[number]
            if before != state:
                break
            state, cost = after, cost + chat._ACTION_COST[action] + (chat.RELABEL if read != chat.known_role(role) else 0)
        else:
            best = cost if best is None else min(best, cost)
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["system", "user", "assistant", "human", "tool", None]), min_size=1, max_size=4))
def test_repair_is_cheapest(roles):
    ways = chat.best_ways(roles, "start")[-1]
    cost = min(c for c, _ in ways.values())
    assert cost == brute_cost(roles)


def is_legal(roles):
    rest = roles[1:] if roles[:1] == ["system"] else roles
    return all(r == ("user", "assistant")[i % 2] for i, r in enumerate(rest))


def test_conversations(spark, monkeypatch):
    kinds = ["system", "user", "assistant", "GPT ", "tool", None]
    rows = [(c, t, kinds[(c * 7 + t * t + c * t) % 6], f"text {c} {t}") for c in range(30) for t in range(c % 9 + 1)]
    rows += [(50, t, "user" if t % 2 == 0 else "assistant", "x") for t in range(1000)]
    rows += [(60, 1, "user", None), (60, 1, "user", None), (60, None, "assistant", "last <|im_end|>"), (None, 1, "user", "a"), (None, 2, "assistant", "b"), (None, 2, "assistant", "b"), (61, 5, None, None)]
    turns = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, piece string")
    got = chat.render(chat.repair(turns)).collect()
    assert sum(r["n_turns"] for r in got) == len(rows)
    for r in got:
        roles = re.findall(r"<\|im_start\|>(\w+)\n", r["rendered"])
        assert is_legal(roles) and len(roles) == r["n_out"]
        assert r["cost"] == chat.MERGE * r["n_merged"] + chat.RELABEL * r["n_relabelled"] + chat.INSERT * r["n_inserted"]
        own = sorted(((t is None, t or 0, role or "", text or "") for c, t, role, text in rows if c == r["conv_id"]))
        if r["conv_id"] is not None:
            order = sorted((x for x in rows if x[0] == r["conv_id"]), key=lambda x: (x[1] is None, x[1] or 0, x[2] is None, x[2] or "", x[3] or ""))
            assert r["cost"] == min(c for c, _ in chat.best_ways([x[2] for x in order], "start")[-1].values())
            assert all(text.replace("<|", "< |") in r["rendered"] for *_, text in own)
    long = next(r for r in got if r["conv_id"] == 50)
    assert long["cost"] == 0 and long["n_turns"] == long["n_out"] == 1000
    assert sorted(r["n_turns"] for r in got if r["conv_id"] is None) == [1, 2]
    assert chat.render(chat.repair(turns.limit(0))).count() == 0
    monkeypatch.setattr(chat, "STRETCH", 3)
    small = {(r["conv_id"], r["rendered"]) for r in chat.render(chat.repair(turns.where("conv_id = 50"))).collect()}
    assert small == {(50, long["rendered"])}


def test_turns_of_one_or_no_number(spark, monkeypatch):
    """Thousands of turns with one number, no number, or all alike are cut into stretches by rows."""
    monkeypatch.setattr(chat, "STRETCH", 20)
    monkeypatch.setattr(chat, "FAN", 4)
    kinds = ["user", "assistant", None]
    rows = [(1, 5, kinds[i % 3], f"t{i}") for i in range(2000)] + [(1, None, "user", "same")] * 300 + [(1, 900 + t, kinds[t % 2], "x") for t in range(60)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    repaired = chat.repair(turns).cache()
    sizes = [r["count"] for r in repaired.groupBy("stretch").count().collect()]
    assert sum(sizes) == len(rows) and len(sizes) > 40 and max(sizes) <= 80
    (whole,) = chat.render(repaired).collect()
    order = sorted(rows, key=lambda x: (x[1] is None, x[1] or 0, x[2] is None, x[2] or ""))
    assert whole["cost"] == min(c for c, _ in chat.best_ways([x[2] for x in order], "start")[-1].values())
    assert whole["cost"] == chat.MERGE * whole["n_merged"] + chat.RELABEL * whole["n_relabelled"] + chat.INSERT * whole["n_inserted"]
    parts = sorted(chat.render_parts(repaired).collect(), key=lambda r: r["part"])
    assert [r["part"] for r in parts] == list(range(len(parts)))
    assert "".join(r["rendered"] for r in parts) == whole["rendered"] and sum(r["n_out"] for r in parts) == whole["n_out"]
    roles = re.findall(r"<\|im_start\|>(\w+)\n", whole["rendered"])
    assert is_legal(roles) and len(roles) == whole["n_out"]


def test_content_is_found_before_it_is_widened_to_its_article():
    text = [f"{LONG}{LONG}number {i}" for i in range(6)]
    paragraphs = "".join(f"<p>{x}</p>" for x in text)
    teaser = "<article><h2>Also</h2><p>Short teaser</p></article>"
    for tag in ("main", "div"):
        assert html_main.main_text(f"<body><{tag}>{paragraphs}</{tag}><div>{teaser}</div></body>") == "\n".join(text)
    first, second = ("".join(f"<p>{x}</p>" for x in part) for part in (text[:3], text[3:]))
    page = f"<body><div><article><h2>One</h2>{first}</article><article><h2>Two</h2>{second}</article></div></body>"
    assert html_main.main_text(page) == "\n".join(["One", *text[:3], "Two", *text[3:]])


def test_headings_and_closing_lines_join_unmarked_content():
    text = [f"{LONG}{LONG}number {i}" for i in range(5)]
    paragraphs = "".join(f"<p>{x}</p>" for x in text)
    body = f"<h1>Title</h1><div>{paragraphs}</div><div><p>Closing line of the text.</p></div>"
    whole = "\n".join(["Title", *text, "Closing line of the text."])
    assert html_main.main_text(f"<body>{body}</body>") == whole
    menu = "<ul>" + "".join(f"<li><a href='/{i}'>Go to {i}</a></li>" for i in range(5)) + "</ul>"
    advert = f"<div class='ad'>{LONG}</div>"
    around = f"<div>{menu}</div>{body}{advert}<p>Last.</p><div>{menu}<p>Rights reserved.</p></div><footer><p>Us</p></footer><p>Below</p>"
    assert html_main.main_text(f"<body><p>Skip</p>{around}</body>") == f"{whole}\nLast."
    halves = f"<div><div>{paragraphs}</div><h2>Two</h2>short<div>{paragraphs}</div></div>"
    assert html_main.main_text(f"<body>{halves}</body>") == "\n".join([*text, "Two", "short", *text])


def test_a_part_of_a_name_is_a_weak_sign():
    links = "".join(f"<a href='/{i}'>A story with a name {i}</a>, " for i in range(4))
    for name, kept in (("related-work", True), ("social-history", True), ("adult-comments-policy", True), ("comments", False), ("comment-list", False), ("ad_slot-3", False)):
        page = f"<article><h1>T</h1><p>{LONG}</p><section class='{name}'><p>{LONG * 2}</p></section><p>{LONG}</p></article>"
        assert html_main.main_text(page).split("\n") == ["T", LONG.strip(), *[(LONG * 2).strip()][:kept], LONG.strip()], name
    page = f"<article><h1>T</h1><p>{LONG}</p><div class='related-stories'>{links}</div><p>{LONG}</p></article>"
    assert html_main.main_text(page) == "\n".join(["T", LONG.strip(), LONG.strip()])
    page = f"<body><div class='widget'><main><h1>T</h1><p>{LONG}</p></main></div><p>Rights.</p></body>"
    assert html_main.main_text(page) == f"T\n{LONG.strip()}"


def test_slash_does_not_close_a_block():
    assert html_main.main_text(f"<article><p>{LONG}</p><aside/>gone<p>gone too</p></aside><p>kept</p></article>") == f"{LONG.strip()}\nkept"


def test_time_grows_with_the_page():
    """Pages of megabytes that make a careless parser quadratic are read in seconds."""
    n = 1_500_000
    pages = ["<p><div>" * (4 * n // 16) + "</b></q></x>" * (4 * n // 24), "<!" * (n // 2), "<a =\">\"" * (n // 7), "<p><table><tr><td>" + "<div>" * (n // 5),
             "<li>x<ul>" * (n // 9), "<p title=\"" * (n // 10), "<div class='ad'>" * (n // 20) + "x", "<p>" + "<i>" * (n // 6) + "y</p>" * (n // 10)]
    for page in pages:
        begin = time.process_time()
        html_main.main_text(page)
        assert time.process_time() - begin < 20, page[:20]
