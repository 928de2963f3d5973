"""Pages of many shapes with known main text, a second extractor, broken and very long pages."""

import html
import random
import time
from html.parser import HTMLParser

import pytest

from tradeloom.llm import html_text

TREE = html_text.trained_tree()
VOWELS, CONSONANTS = "aeiou", "bcdfglmnprst"


def words(rng, n):
    return " ".join("".join(rng.choice(CONSONANTS) + rng.choice(VOWELS) for _ in range(rng.randint(1, 4))) for _ in range(n))


def plain_page(seed):
    """A page without an article tag or a telling name: (html, blocks of the main text)."""
    rng = random.Random(seed)
    link = lambda n: f'<a href="/{rng.randint(1, 99)}">{words(rng, n)}</a>'
    box = lambda inner: f'<{rng.choice(["div", "section"])} class="c{rng.randint(10, 99)}">{inner}</div>'
    menu = "".join(f"<li>{link(rng.randint(1, 3))}</li>" for _ in range(rng.randint(4, 9)))
    side = "".join(f"<li>{link(rng.randint(4, 9))}</li>" for _ in range(rng.randint(4, 8)))
    story = [words(rng, rng.randint(25, 90)) for _ in range(rng.randint(3, 8))]
    linked = [p if rng.random() < 0.7 else f"{p[: p.rindex(' ')]} <a href=x>{p[p.rindex(' ') + 1 :]}</a>" for p in story]
    body = "".join(rng.choice(["<p>{}</p>", "<div>{}</div>", "<p>{}"]).format(p) for p in linked)
    foot = rng.choice(["<div>{} {}</div>".format(link(1), link(1)), f"<ul><li>{link(2)}</li><li>{link(1)}</li></ul>"])
    parts = [box(f"<ul>{menu}</ul>"), box(body), box(f"<ul>{side}</ul>"), box(foot)]
    if rng.random() < 0.3:
        parts[1], parts[2] = parts[2], parts[1]
    return f"<html><head><title>{words(rng, 5)}</title></head><body>{''.join(parts)}</body></html>", story


def test_words_and_link_density_decide_where_nothing_else_does():
    right = wrong = missed = 0
    for seed in range(200):
        page, story = plain_page(seed)
        found = html_text.main_text(page, TREE).split("\n")
        right += len(set(found) & set(story))
        wrong += len(set(found) - set(story) - {""})
        missed += len(set(story) - set(found))
    assert right / (right + missed) >= 0.95 and right / (right + wrong) >= 0.95


def test_density_is_what_the_tree_looks_at():
    """The same words, once as text and once as links, get different answers."""
    long, n = words(random.Random(4), 60), 6
    text = "".join(f"<div>{long}</div>" for _ in range(n))
    links = "".join(f"<div><a href=x>{long}</a></div>" for _ in range(n))
    assert html_text.main_text(text, TREE) == "\n".join([long] * n) and html_text.main_text(links, TREE) == ""


class Second(HTMLParser):
    """Main text by another way: inside article or main, outside boilerplate tags; well-formed pages only."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.found, self.parts = [], [], []

    def flush(self):
        text = " ".join("".join(self.parts).split())
        good = {"article", "main"} & set(self.open) and not {"nav", "footer", "aside", "form", "ad"} & set(self.open)
        if text and good:
            self.found.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.parts.append(" ")
        elif tag not in ("b", "i", "a", "span"):
            self.flush()
            self.open.append("ad" if dict(attrs).get("class") == "ad" else tag)

    def handle_endtag(self, tag):
        if tag not in ("b", "i", "a", "span", "br"):
            self.flush()
            self.open.pop()

    def handle_data(self, data):
        if not {"script", "style", "title"} & set(self.open):
            self.parts.append(data)


def marked_page(seed):
    rng = random.Random(seed)
    inline = lambda n: rng.choice(["{}", "<b>{}</b>", "{} &amp; <i>more</i>", "{} <a href='a>b'>see it</a> and so on it goes", "{}<br>rest"]).format(words(rng, n))
    inner = [f"<p>{inline(rng.randint(4, 40))}</p>" for _ in range(rng.randint(2, 6))]
    inner.insert(rng.randint(0, len(inner)), f'<div class="ad"><p>{words(rng, 12)}</p></div>')
    inner.insert(rng.randint(0, len(inner)), f"<aside><p>{words(rng, 30)}</p></aside>")
    inner.insert(0, f"<h1>{words(rng, 6)}</h1>")
    main = rng.choice(["article", "main"])
    script = "<script>if (a < b) document.write('</p><p>no')</script><style>p > a {}</style>"
    return (
        f"<html><head><title>{words(rng, 4)}</title>{script}</head><body><nav><ul><li><a href=x>{words(rng, 2)}</a></li></ul></nav>"
        f"<{main}>{''.join(inner)}</{main}><form><p>{words(rng, 20)}</p></form><footer><p>{words(rng, 25)}</p></footer></body></html>"
    )


@pytest.mark.parametrize("seed", range(60))
def test_marked_pages_equal_a_second_extractor(seed):
    page, second = marked_page(seed), Second()
    second.feed(page)
    second.close()
    assert html_text.main_text(page, TREE) == "\n".join(second.found)


@pytest.mark.parametrize(
    "piece, times",
    [("<div x='", 300_000), ('<div x="\'>', 200_000), ("<div>x", 200_000), ("<a ", 500_000), ("<p class=ad>x", 100_000), ("<!--", 500_000),
     ("<li><div>x</li>", 100_000), ("&amp", 400_000), ("<", 400_000), ("<script>", 200_000), ("<b a=\"'", 200_000)],
)
def test_broken_markup_takes_linear_time(piece, times):
    def spent(n):
        start = time.process_time()
        html_text.main_text(piece * n, TREE)
        return time.process_time() - start

    spent(1000)
    assert spent(times) < 20 + 0.0
    assert spent(times // 4) * 16 + 1 > spent(times)  # far from the square


def test_an_unclosed_quote_keeps_the_text_behind_it():
    page = "<article><p>One first paragraph of text</p><p class='lead>Two second paragraph of text</p><p>Three third paragraph</p></article>"
    assert html_text.main_text(page, TREE).split("\n") == ["One first paragraph of text", "Two second paragraph of text", "Three third paragraph"]


def test_operator_on_empty_repeated_and_long_pages(spark):
    long = f"<article>{'<p>' + 'some words of text ' * 20 + '</p>'}{'<p>x</p>' * 100_000}</article>"
    rows = [(1, "u", long), (1, "u", long), (2, None, None), (None, "v", "<article><p>a b c</p></article>"), (3, "w", html.escape("<p>only text</p>"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as n_chars", "'x' as words")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in html_text.extract_text(pages).collect()}
    assert got[1, "u"][0].count("\n") == 100_000 and got[2, None] == ("", 0) and got[None, "v"] == ("a b c", 5)
    assert html_text.extract_text(pages).count() == 5
    assert html_text.extract_text(pages.limit(0)).count() == 0
