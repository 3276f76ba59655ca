"""Pages built from known blocks, blocks without an article element, and broken markup."""

import html
import random

from tests.llm.brute import prose
from txnflow.llm.html_text import extract_text, inherit, main_text
from txnflow.llm.queries import QUERIES

BOILERPLATE = [
    "<nav><ul><li><a href='/a'>Menu</a></li></ul></nav>",
    "<header><h1>Site</h1></header>",
    "<aside><p>The side bar of the site and all that is in it</p></aside>",
    "<form><label>Name</label><input name=q><button>Go</button></form>",
    '<div class="ad">Buy it</div>',
    '<div id="cookie-notice"><p>We use cookies</p></div>',
    '<section class="comments"><p>The first reader comment is this one and it is long</p><div><p>reply</p></div></section>',
    "<script>var a = '</p><p>no';</script>",
    "<style>p { margin: 0 }</style>",
    "<!-- <p>hidden</p> -->",
    "<footer>&copy; all</footer>",
    '<div role="navigation">more</div>',
    "<noscript>turn it on</noscript>",
]


def test_articles_between_boilerplate():
    rng = random.Random(4)
    for n in range(200):
        blocks = [prose(rng.choice([1, 3, 20, 60]), n * 50 + i) + rng.choice(["", " & <é>", "\xa0x", " «q»"]) for i in range(rng.randrange(1, 7))]
        body = []
        for b in blocks:
            words = html.escape(b).split(" ")
            inner = rng.choice([" ", "\n  ", "\t"]).join(words)
            tag = rng.choice(["p", "p", "h2", "li", "div", "blockquote"])
            body.append(f"<{tag}>{rng.choice(['', '<b>', '<em>'])}{inner}" + (f"</{tag}>" if tag not in ("p", "li") or rng.random() < 0.6 else ""))
            if rng.random() < 0.4:
                body.append(rng.choice(BOILERPLATE))
        around = [rng.choice(BOILERPLATE) for _ in range(4)]
        box = rng.choice(["article", "main"])
        end = rng.choice(["</body></html>", "", "</body>"])
        page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{around[0]}{around[1]}<{box}>{''.join(body)}</{box}>{around[2]}{around[3]}{end}"
        assert main_text(page) == "\n\n".join(" ".join(b.split()) for b in blocks), page


def test_without_an_article_density_and_neighbours_decide():
    long_ = "The cat and the dog were in the house and it was not on the way to the end of this"
    links = "<a href=1>more links are here to be seen by all of you now and again</a>"
    page = f"<div><a href=x>Home</a> <a href=y>News</a></div><div>{long_}</div><div>Short.</div><div>{long_}</div><div>{links}</div><div>tail</div>"
    assert main_text(page) == f"{long_}\n\nShort.\n\n{long_}"
    assert inherit([None, True, None, None, False, None]) == [True, True, True, False, False, False]
    assert inherit([None, None]) == [False, False] and inherit([True, None, False]) == [True, False, False]


def test_broken_and_empty_pages():
    for page in (None, "", "<", "<p", "<!--", "<script>", "</p></div>", "<a <b> <c", "&", "<article"):
        assert main_text(page) == ""
    assert main_text("<article><p title='a>b'>x</p>1 < 2 &lt; 3 &amp;amp; &unknown;") == "x\n\n1 < 2 < 3 &amp; &unknown;"
    assert main_text("<article>a<br>b<hr>c</article><p>" + "x " * 50) == "a b\n\nc"
    assert len(main_text("<article>" + "<div>" * 20000 + "deep")) == 4


def test_rows_and_query(spark):
    rows = [(1, "u", "<main><p>a</main>", "own"), (1, "u", "<main><p>a</main>", "own"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_text(pages)
    assert sorted(((r["page_id"], r["text"]) for r in got.collect()), key=repr) == [(1, "a"), (1, "a"), (None, "")]
    assert extract_text(pages.limit(0)).count() == 0
    out = QUERIES["op10_html_text"](spark, "/root/testdata/sf0.001")
    assert out.where("n_chars <> length(text) or text = ''").count() == 0


LONG = "The cat and the dog were in the house and it was not on the way to the end of this"


def test_an_article_does_not_switch_the_rest_of_the_page():
    card = "<article><h3><a href=/n>Next</a></h3><p>Short card</p></article>"
    page = f"<div>{LONG}</div><div>Short.</div><div>{LONG}</div><hr>{card}<p>tail of the site</p>"
    assert main_text(page).startswith(f"{LONG}\n\nShort.\n\n{LONG}\n\nNext\n\nShort card")
    links = "".join(f"<li><a href=/{i}>link number {i} of this list</a></li>" for i in range(9))
    assert main_text(f"<p>by the site</p><article><p>One.</p><ul>{links}</ul><p>{LONG}</p></article><p>end</p>") == f"One.\n\n{LONG}"


def test_marks_do_not_empty_the_page():
    for name in ("page has-sidebar", "no-header", "with-sidebar", "search-results", "content social", "comments", "ad"):
        assert main_text(f"<div class='{name}'><article><p>{LONG}</p></article><p>x</p></div>").startswith(LONG), name
    for name in ("page has-sidebar", "no-header", "search-results", "content social"):
        body = f"<div class='{name}'>" + f"<div>{LONG}</div>" * 3 + "</div>"
        assert main_text(f"<nav>menu</nav>{body}<div class='sidebar'>{LONG}</div>") == "\n\n".join([LONG] * 3), name
    for name in ("comments", "ad", "cookie-notice"):  # however long they are
        assert main_text(f"<article><p>One.</p></article><div class='{name}'>" + f"<p>{LONG}</p>" * 9 + "</div>") == "One."
    assert main_text(f"<article><p>One.</p><div class='social'>" + f"<p>{LONG}</p>" * 9 + "</div></article>") == "One."


def test_omitted_end_tags_end_a_marked_element():
    assert main_text("<article><p class='byline'>By A<p>One.<p>Two.</article>") == "One.\n\nTwo."
    assert main_text("<article><ul><li class=ad>Buy<ul><li>it</ul><li>One.</ul><p>Two.</article>") == "One.\n\nTwo."
    assert main_text("<article><table><tr><td class=share>S<td>One.<tr class=ad><td>A<td>B<tr><td>Two.</table>") == "One.\n\nTwo."
    assert main_text("<article><p class=ad>Buy <span class=share>it<p>One.</article>") == "One."


def test_other_languages_and_scripts_outside_an_article():
    polish = "Wczoraj wieczorem nad jeziorem zebrali się mieszkańcy całej okolicy, żeby wspólnie obejrzeć pierwsze wiosenne przedstawienie teatralne."
    finnish = "Kaupunginvaltuusto hyväksyi maanantaina rakennuslautakunnan valmisteleman asemakaavamuutosehdotuksen yksimielisesti."
    chinese = "昨天晚上湖边聚集了来自附近各个村庄的居民,大家一起观看了今年春天的第一场露天戏剧演出,直到深夜才陆续回家。"
    japanese = "昨日の夜、湖のほとりに近くの村々から多くの人が集まり、今年最初の野外劇を最後まで一緒に楽しみました。"
    thai = "เมื่อวานนี้ชาวบ้านจากหมู่บ้านใกล้เคียงมารวมตัวกันที่ริมทะเลสาบเพื่อชมการแสดงละครกลางแจ้งครั้งแรกของปีนี้ด้วยกัน"
    links = "<div><a href=1>" + "</a> <a href=2>".join("jeden dwa trzy cztery pięć sześć siedem".split()) + "</a></div>"
    for text in (polish, finnish, chinese, japanese, thai):
        assert main_text(f"{links}<div>{text}</div><p>{text}</p>{links}") == f"{text}\n\n{text}", text
    assert main_text(f"<p>{LONG}</p><p>{chinese}</p>") == f"{LONG}\n\n{chinese}"
    listed = "Shoes Shirts Trousers Hats Gloves Scarves Belts Socks Boots Coats Jackets Skirts Dresses"
    assert main_text(f"<p>{LONG}</p><p>{listed}</p><p>{LONG}</p>") == f"{LONG}\n\n{LONG}"  # a known language
    assert main_text("<p>" + "x " * 90) == ""
