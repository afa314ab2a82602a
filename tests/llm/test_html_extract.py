import html
import os
import random
import re
import time

from pyspark.sql import functions as F

from barlake.llm.html_extract import extract_main_text, main_text, op12_html_extract

SF01 = "/root/testdata/sf0.01"
PROSE = ["The river rose in the night, and by morning the lower road was gone, as the old people had said it would be.",
         "Nobody in the valley had seen such water before, though some spoke of a flood, long ago, that took the mill.",
         "“Fish & chips” cost £3 < £4, they said; it's all one.", "Short.", "By noon, the rain had stopped."]


def test_pages_of_the_tables_give_their_article(spark):
    """The article element of each page, its tags taken out by pattern: blocks and line breaks are spaces, references are decoded."""
    rows = op12_html_extract(spark, SF01).collect()
    pages = {r.page_id: r for r in spark.read.parquet(os.path.join(SF01, "pages.parquet")).collect()}
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        plain = html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<(?:/?(?:p|h1)|br)\b[^>]*>", " ", article)))
        assert r.text == " ".join(plain.split()) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def page(rnd, prose):
    """A page whose article is ``prose``, with all that the contract leaves out around and inside it."""
    say = lambda k: " ".join(rnd.choice("click here for more, see our offers now and then".split()) for _ in range(k))
    link = lambda: f"<a href='/{rnd.randrange(99)}'>{say(2)}</a>"
    around = [f"<nav><ul>{''.join(f'<li>{link()}</li>' for _ in range(9))}</ul></nav>", f"<header class=top><p>{say(60)}</p></header>",
              f"<div id='cookie-notice'><p>{say(80)}, {say(30)}</p></div>", f"<aside><p>{say(90)}</p></aside>", f"<div class=\"Ad-Slot\">{say(70)}</div>",
              f"<form action=x><p>{say(60)}</p><input name=q><select><option>a<option>b</select></form>", f"<div class=sidebar>{say(40)} {link()}</div>",
              f"<script>if (a < b) document.write('<p>{say(50)}</p>')</script>", f"<!-- <p>{say(50)}</p> -->", f"<div hidden>{say(40)}</div>",
              f"<ul>{''.join(f'<li>{link()}' for _ in range(7))}</ul>", f"<div style='display: none'>{say(30)}</div>", f"<div role=banner>{say(30)}</div>"]
    rnd.shuffle(around)
    k = rnd.randrange(len(around))
    blocks = [html.escape(p, quote=rnd.random() < 0.5) for p in prose]
    body = "".join(rnd.choice([f"<p>{b}</p>", f"<p>{b}\n", f"<P class='t'><b>{b}</b></p >"]) for b in blocks)
    wrap = rnd.choice([("<article>", "</article>"), ("<div class='post-content'>", "</div>"), ("<main><div>", "</div></main>"), ("<div><section>", "</section></div>")])
    inside = rnd.choice(["", f"<div class='ads'><p>{say(40)}</p></div>", f"<script>x = '</p>'</script><style>p {{}}</style>", "<!-- x -->"])
    comments = f"<section id=comments><h3>2 comments</h3>{''.join(f'<div class=comment><p>{say(60)}, {say(20)}.</p></div>' for _ in range(4))}</section>"
    return (f"<!DOCTYPE html><html><head><title>{say(5)}</title><style>p {{ }}</style></head><body class='has-sidebar'>" + "".join(around[:k])
            + wrap[0] + body + inside + wrap[1] + comments + "".join(around[k:]) + f"<footer><p>&copy; {say(40)}, {say(9)}</p></footer>" + rnd.choice(["</body></html>", ""]))


def test_all_but_the_article_goes(spark):
    rnd = random.Random(6)
    for _ in range(300):
        prose = [rnd.choice(PROSE[:2])] + [rnd.choice(PROSE) for _ in range(rnd.randrange(1, 6))]
        assert main_text(page(rnd, prose)) == " ".join(prose)


def test_white_space_references_and_broken_markup():
    assert main_text("<p>a&nbsp;b\n\t c<br>d &amp;amp; &lt;p&gt; &#233;&#x1F642; &nosuch; x&ltd") == "a b c d &amp; <p> é🙂 &nosuch; x<d"
    assert main_text("<p>on<b>e</b> <i>two</i><p>three</div></em><p>fo<!-- x -->ur < five") == "one two three four < five"
    assert main_text("just text, no tags") == "just text, no tags"
    assert main_text("<p title=\"a > b\" it's>kept</p><p x='") == "kept"
    assert main_text("<script>never ends <p>x</p>") == "" == main_text("") == main_text(None) == main_text("<nav><p>menu</p></nav>")
    assert main_text("<p>a</p><!-- open <p>b</p>") == "a"


def test_lists_inside_the_article_stay_and_menus_go():
    items = "".join(f"<li>point {i}, with reasons, of its own</li>" for i in range(4))
    menu = "".join(f"<li><a href=x>topic {i}</a></li>" for i in range(6))
    got = main_text(f"<article><p>{PROSE[0]}</p><ul>{items}</ul><ul>{menu}</ul><p>{PROSE[1]}</p></article>")
    assert "point 3, with reasons" in got and "topic" not in got and got.endswith(PROSE[1])


def test_a_form_around_the_whole_page_is_no_form_to_drop():
    assert main_text(f"<form id=aspnet><h1>T</h1><div><p>{PROSE[0]}</p></div></form>").endswith(PROSE[0])


def test_siblings_of_the_container_stay_if_they_read_like_it():
    part = "".join(f"<p>{PROSE[k % 2]}</p>" for k in range(6))
    got = main_text(f"<body><div><p>{PROSE[1]}</p><div>{part}</div><p>{PROSE[0]}</p><p><a href=x>{PROSE[1]}</a></p><p>More</p></div></body>")
    assert got == " ".join([PROSE[1], *[PROSE[k % 2] for k in range(6)], PROSE[0]])


def test_time_follows_length():
    """Deep, unclosed and unbalanced markup of a fifth of a megabyte."""
    for one in ("<div>", "<b>x", "</i><b><div>", "<p>a, b", "<a href='", "<!--", "<x y=\"", "<", "&", "<table><tr><td>x", "</p>", "<li>x<ul>"):
        t = time.process_time()
        main_text(one * (200_000 // len(one)))
        assert time.process_time() - t < 10, one


def test_odd_rows_and_columns(spark):
    rows = [(1, None, "u", 1, 2), (None, "", None, None, None), (2, "<p>Same.</p>", "u", 3, 4), (2, "<p>Same.</p>", "u", 3, 4)]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string, _page int, `c0.x` int")
    out = extract_main_text(pages)
    assert out.columns == ["page_id", "url", "_page", "c0.x", "text"]
    assert sorted(map(str, out.collect())) == sorted(str(r) for r in spark.createDataFrame(
        [(1, "u", 1, 2, ""), (None, None, None, None, ""), (2, "u", 3, 4, "Same."), (2, "u", 3, 4, "Same.")], out.schema).collect())
    assert extract_main_text(pages.where(F.lit(False))).collect() == []
