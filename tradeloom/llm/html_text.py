"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into flat blocks of text at its block-level tags. Each block is described by its
number of words and link density, those of its neighbours, and what it stands in. A decision
tree, grown here from the small labelled table below, keeps the blocks of the article.
"""

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEATURES = [
    "words", "links", "words_before", "links_before", "words_after", "links_after", "article", "boiler_tag", "boiler_name", "heading",
]

# Labelled blocks. The columns are FEATURES, then 1 for main text.
LABELLED = """
 60 0.00  40 0.00  55 0.00 1 0 0 0 1
 25 0.00  80 0.00   5 0.10 1 0 0 0 1
 12 0.00   9 0.00  70 0.00 1 0 0 0 1
  3 0.00  40 0.00  60 0.00 1 0 0 0 1
  2 0.00   7 0.00   0 0.00 1 0 0 0 1
  1 0.00   1 0.00   1 0.00 1 0 0 0 1
 40 0.30  30 0.10  20 0.00 1 0 0 0 1
  8 0.00   7 0.00  45 0.00 1 0 0 1 1
  5 0.00   0 0.00   3 0.00 1 0 0 1 1
  6 0.00  50 0.00  30 0.00 1 0 0 1 1
 18 0.50  30 0.00  40 0.00 1 0 0 0 1
 10 0.95  60 0.00  12 0.90 1 0 0 0 0
  4 1.00  30 0.00   4 1.00 1 0 0 0 0
  3 1.00   4 1.00   3 1.00 1 0 0 0 0
  2 1.00  30 0.00  40 0.00 1 0 0 0 0
  9 0.00  70 0.00  60 0.00 1 0 1 0 0
 40 0.00  70 0.00  60 0.00 1 0 1 0 0
 15 0.00   5 0.00  20 0.00 1 0 1 0 0
  4 0.00  10 0.00   5 0.00 1 0 1 1 0
 30 0.00  40 0.00   5 0.10 1 1 0 0 0
  6 0.40  40 0.00   8 0.00 1 1 0 0 0
  3 0.00  20 0.00  10 0.00 1 1 0 1 0
 12 0.00   9 0.00  10 0.00 1 1 1 0 0
  1 1.00   0 0.00   1 1.00 0 1 0 0 0
  1 1.00   1 1.00   1 1.00 0 1 0 0 0
  6 1.00   1 1.00   7 0.00 0 1 0 0 0
 12 0.10  60 0.00   0 0.00 0 1 0 0 0
 25 0.00  40 0.00   0 0.00 0 1 0 0 0
 50 0.00  30 0.00  20 0.00 0 1 0 0 0
  8 0.00   1 1.00   9 0.00 0 1 0 1 0
 10 0.00   1 1.00  12 0.00 0 0 1 0 0
 30 0.00   1 1.00  40 0.00 0 0 1 0 0
 45 0.00  60 0.00  30 0.00 0 0 1 0 0
  5 0.00   3 0.00   9 0.00 0 0 1 1 0
 20 0.20  30 0.10  10 0.00 0 1 1 0 0
 55 0.00  60 0.00  40 0.00 0 0 0 0 1
 30 0.05   8 0.00  60 0.00 0 0 0 0 1
 22 0.10  35 0.00  12 0.10 0 0 0 0 1
 70 0.20   2 0.00   3 0.50 0 0 0 0 1
 18 0.00   6 0.00  30 0.00 0 0 0 0 1
 12 0.00  45 0.00  50 0.00 0 0 0 0 1
  6 0.00  50 0.00  60 0.00 0 0 0 0 1
  8 0.00   3 1.00  60 0.00 0 0 0 1 1
  7 0.00  40 0.00  35 0.00 0 0 0 1 1
  5 0.00   4 0.00  22 0.00 0 0 0 1 1
  3 0.00   2 1.00   3 1.00 0 0 0 0 0
  5 0.00   4 0.50   6 0.20 0 0 0 0 0
  9 0.00   5 0.00   4 0.00 0 0 0 0 0
  4 0.00   0 0.00   3 1.00 0 0 0 0 0
 14 0.80  10 0.90  12 0.90 0 0 0 0 0
 30 0.90  20 0.90   9 1.00 0 0 0 0 0
  2 1.00  60 0.00   3 1.00 0 0 0 0 0
  6 0.60   9 0.00   7 0.70 0 0 0 0 0
  4 0.00   3 1.00   2 1.00 0 0 0 1 0
  3 1.00   2 1.00   4 1.00 0 0 0 1 0
"""

# Tag and name lists.
BLOCK_TAGS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
SKIPPED_TAGS = "script|style|noscript|template|svg|iframe|select|textarea|button|title|object|math"
BOILER_TAGS = set("nav footer aside form menu dialog fieldset".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
BOILER_NAMES = set(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus"
    " footer gdpr hidden legal login masthead menu modal nav navbar navigation newsletter notice notices notification overlay"
    " pager pagination popup promo promotion recommended related replies reply search share sharing sidebar signup skip social"
    " sponsor sponsored subscribe subscription toolbar topbar tracking widget widgets copyright disclaimer alert teaser".split()
)
MAIN_NAMES = {"article", "main", "content", "post", "entry", "story"}

SKIPPED = re.compile(rf"(?i)<({SKIPPED_TAGS})\b")
# Possessive: what a tag has taken is not tried again.
TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)>")
# A name with one of these words says what an element has or does, not what it is.
MODIFIERS = set("has have no not with without is are overflow backface show shows hide hides enable enabled disable disabled layout template".split())
ATTRIBUTE = re.compile(r"""(?s)([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
UNSEEN = re.compile(r"(?i)(?:^|[;\s])(?:display\s*:\s*none|visibility\s*:\s*hidden)")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())


def _attributes(text):
    """Attributes by lower-case name; the first of a name counts, quotes are taken off."""
    out = {}
    for name, value in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), value[1:-1] if value[:1] in ('"', "'") else value)
    return out


def _names(attributes):
    """Words of the names that say what the element is; 'hidden' counts as a whole name only."""
    out = set()
    for name in " ".join(attributes.get(x, "") for x in ("class", "id", "role", "itemprop")).split():
        name = name.split("--")[0]  # what follows is a modifier
        words = set(re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()))
        if ":" not in name and not words & MODIFIERS:
            out |= words if name.lower() == "hidden" else words - {"hidden"}
    return out


def _hidden(attributes):
    aria = attributes.get("aria-hidden", "").strip().lower() == "true"
    return "hidden" in attributes or aria or bool(UNSEEN.search(attributes.get("style", "")))


def tokens(page):
    """(text, None) for text, and (tag, match) for tags, in one pass over the page.

    Comments, declarations and elements that show no text are left out. A tag whose quotes never
    close would take the rest of the page: from there on, tags end at their first >. What no > follows is text.
    """
    at, end, last, tag_pattern = 0, len(page), page.rfind(">"), TAG
    while at < end:
        if page[at] != "<":
            stop = page.find("<", at)
            stop = end if stop < 0 else stop
            yield page[at:stop], None
            at = stop
            continue
        if page.startswith("<!--", at):
            stop = page.find("-->", at + 4)
            at = end if stop < 0 else stop + 3
            continue
        found = None
        if at <= last:
            if page.startswith(("<!", "<?"), at):
                at = page.find(">", at) + 1
                continue
            found = tag_pattern.match(page, at)
            if found is None and tag_pattern is TAG and PLAIN_TAG.match(page, at):
                tag_pattern = PLAIN_TAG
                found = tag_pattern.match(page, at)
        if found is None:
            yield "<", None
            at += 1
            continue
        at = found.end()
        if skipped := SKIPPED.match(found.group(0)):
            close = re.compile(rf"(?i)</{skipped.group(1)}\s*>").search(page, at)
            at = close.end() if close else end
            continue
        yield found.group(2).lower(), found


def blocks(page):
    """Flat blocks of a page, in order: (text, words, link words, article, boiler_tag, boiler_name, heading)."""
    out, parts, linked, heading = [], [], [], False
    # Open containers: (tag, within an article, within a boiler tag, within a boiler name); each
    # row holds what its ancestors are too. The number of open containers by tag is kept beside it.
    stack, open_tags = [(None, False, False, False)], Counter()
    anchors, paragraph = 0, False  # paragraph: an open <p> that is boilerplate by its name

    def flush():
        nonlocal parts, linked
        text = re.sub(r"\s+", " ", "".join(parts)).strip()
        if text:
            _, article, boiler, named = stack[-1]
            out.append((text, len(text.split()), len("".join(linked).split()), article, boiler, named or paragraph, heading))
        parts, linked = [], []

    for tag, found in tokens(page):
        if found is None:
            piece = html.unescape(tag)
            parts.append(piece)
            if anchors:
                linked.append(piece + " ")
            continue
        closing, attributes = bool(found.group(1)), found.group(3)
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            anchors = max(anchors - 1, 0) if closing else anchors + 1
        elif tag in BLOCK_TAGS:
            flush()
            anchors, paragraph = 0, False
            heading = tag in HEADINGS and not closing
            if tag == "p":
                if not closing:
                    given = _attributes(attributes)
                    paragraph = bool(_names(given) & BOILER_NAMES) or _hidden(given)
                continue
            if tag in VOID or tag in HEADINGS or attributes.rstrip().endswith("/"):
                continue
            if closing:
                while open_tags[tag]:
                    top = stack.pop()[0]
                    open_tags[top] -= 1
                    if top == tag:
                        break
                continue
            given = _attributes(attributes)
            names = _names(given)
            _, inside, in_boiler, in_named = stack[-1]
            main = tag in ("article", "main") or bool(names & MAIN_NAMES and not names & BOILER_NAMES)
            boiler = tag in BOILER_TAGS or (tag == "header" and not inside)
            named = bool(names & (BOILER_NAMES if inside else BOILER_NAMES | {"header"})) and tag not in ("html", "body", "article", "main")
            stack.append((tag, inside or main, in_boiler or boiler, in_named or named or _hidden(given)))
            open_tags[tag] += 1
    flush()
    return out


def block_features(found):
    """(blocks, FEATURES) array; a missing neighbour has no words and no links."""
    words = np.array([x[1] for x in found], float)
    links = np.array([min(1.0, x[2] / x[1]) if x[1] else 0.0 for x in found])
    pad = lambda x, k: np.concatenate(([0.0], x, [0.0]))[1 + k : 1 + k + len(x)]
    flags = np.array([x[3:7] for x in found], float).reshape(len(found), 4)
    near = [words, links, pad(words, -1), pad(links, -1), pad(words, 1), pad(links, 1)]
    return np.column_stack([*near, flags])


def grow(rows, labels, depth=8):
    """Decision tree by Gini impurity: a label, or (feature, threshold, tree if at most, tree if above)."""
    positive = labels.mean()
    if depth == 0 or positive in (0.0, 1.0):
        return int(positive >= 0.5)
    best = None
    for k in range(rows.shape[1]):
        values = np.unique(rows[:, k])
        for cut in (values[1:] + values[:-1]) / 2:
            low = rows[:, k] <= cut
            impurity = sum(m.sum() * labels[m].mean() * (1 - labels[m].mean()) for m in (low, ~low))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, k, cut, low)
    if best is None:
        return int(positive >= 0.5)
    _, k, cut, low = best
    return (k, float(cut), grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1))


def decide(tree, row):
    while isinstance(tree, tuple):
        feature, cut, low, high = tree
        tree = low if row[feature] <= cut else high
    return tree


def labelled_blocks():
    """The labelled table, and blocks in varied neighbourhoods whose place, or whose words and links, tell what they are."""
    rows = [[float(x) for x in line.split()] for line in LABELLED.strip().splitlines()]
    neighbours = [(0, 3), (5, 60), (60, 5), (60, 60), (3, 0), (20, 20)]
    for before, after in neighbours:
        for words in (1, 2, 4, 7, 15, 40, 90):
            rows.append([words, 0.0, before, 0.0, after, 0.0, 1, 0, 0, 0, 1])
            if words >= 15:
                rows.append([words, 0.0, before, 0.0, after, 0.0, 0, 0, 0, 0, 1])
                rows.append([words, 0.9, before, 0.5, after, 0.5, 0, 0, 0, 0, 0])
            else:
                rows.append([words, 0.0, before, 0.0, after, 0.0, 0, 0, 0, 0, int(min(before, after) >= 20)])
        # Where no tag or name tells: prose has few links whatever stands beside it, lists of links have many.
        for before_links in (0.0, 0.2, 1.0):
            for after_links in (0.0, 0.2, 1.0):
                for words in (2, 5, 9, 20, 45):
                    rows += [[words, links, before, before_links, after, after_links, 0, 0, 0, 0, 0] for links in (0.6, 1.0)]
                    if words >= 20:
                        rows += [[words, links, before, before_links, after, after_links, 0, 0, 0, 0, 1] for links in (0.0, 0.1, 0.3)]
        for words in (2, 6, 15, 40):
            for article in (0, 1):
                for tag, name in ((1, 0), (0, 1), (1, 1)):
                    rows.append([words, 0.0, before, 0.0, after, 0.0, article, tag, name, 0, 0])
    return np.array(rows, float)


def trained_tree():
    table = labelled_blocks()
    return grow(table[:, :-1], table[:, -1])


def main_text(page, tree):
    found = blocks(page or "")
    return "\n".join(x[0] for x, row in zip(found, block_features(found)) if decide(tree, row))


def extract_text(pages, html_column="html"):
    """`pages` with text (main text, blocks joined by line feeds) and n_chars (its characters).

    The whole page is read, whatever its length. Null and empty pages, and pages without main
    text, give an empty text and 0. Unclosed tags end with the page, unknown ones are inline.
    All columns stay; text and n_chars replace columns of that name. Rows that repeat get equal
    results. An empty table gives an empty result.
    """
    tree = trained_tree()
    kept = pages.drop("text", "n_chars")

    def rows_of(part):
        for batch in part:
            texts = [main_text(page.as_py(), tree) for page in batch.column(html_column)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    found = kept.mapInArrow(rows_of, T.StructType([*kept.schema.fields, T.StructField("text", T.StringType())]))
    return found.withColumn("n_chars", F.length("text").cast("long"))
