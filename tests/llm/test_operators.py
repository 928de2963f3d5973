"""Every operator against a brute-force version on a small corpus with edge cases."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradeloom import session
from tradeloom.llm import (
    decontaminate, fingerprints, html_text, line_dedup, linking, mixing, near_dedup, quality, suffix_dedup, tokens, toxicity,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text):
    w = words_of(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def table(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_tokens_equal_greedy_longest_match(docs, rows, empty):
    pieces = (b" on", b" o", b"ne", b"e", b"abd", b"abde", b"bdeil", b"il", b" two", b"lm", b"lmno", b"mnorst")

    def greedy(word):
        n, at = 0, 0
        while at < len(word):
            at += max((len(p) for p in pieces if word.startswith(p, at)), default=1)
            n += 1
        return n

    got = table(tokens.count_tokens(docs, pieces).select("doc_id", "n_words", "n_tokens"))
    want = collections.Counter(
        (i, len(WORD.findall(t or "")), sum(greedy(b" " + w.encode()) for w in WORD.findall(t or ""))) for i, t, *_ in rows
    )
    assert got == want
    assert tokens.count_tokens(empty, pieces).count() == 0


def test_near_duplicates_equal_all_pairs(docs, rows, empty):
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    nodes = {i for i, _ in sets if i is not None}
    links = [
        (a, b)
        for x, (a, s) in enumerate(sets)
        for b, u in sets[:x]
        if None not in (a, b) and s and u and 100 * len(s & u) >= 75 * len(s | u)
    ]
    root = union_find(nodes, links)
    want = collections.Counter((i, len(s), root.get(i), i is None or root[i] == i) for i, s in sets)
    assert table(near_dedup.near_duplicates(docs)) == want
    assert near_dedup.near_duplicates(empty).count() == 0


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(1)
    both, one, two = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (300, 100, 100))
    elements = np.concatenate((both, one, both, two))
    signature = near_dedup.super_minhash(elements, np.array([400, 400, 0]), 512)
    assert abs((signature[0] == signature[1]).mean() - 0.6) < 0.08
    assert (signature[2] == np.iinfo(np.uint64).max).all()


def test_blocks_find_links_that_centres_miss(spark):
    pairs = {(2, 1), (4, 3), (4, 2), (9, 8)}
    members = spark.createDataFrame([(7, n) for n in (1, 2, 3, 4, 8)] + [(5, 8), (5, 9)], "bucket long, node long")
    links = spark.createDataFrame(sorted(pairs), "x long, y long")

    def verify(found):
        return found.join(links, (F.col("a.node") == F.col("x")) & (F.col("b.node") == F.col("y"))).select("a", "b")

    roots = dict(tuple(r) for r in linking.bucket_components(members, members.select("node").distinct(), verify).collect())
    assert roots == {2: 1, 3: 1, 4: 1, 9: 8}


def test_broadcast_counts_the_elements_of_lists(spark):
    plan = lambda df: spark.range(9).join(df, "id")._jdf.queryExecution().logical().toString()
    one = spark.range(1)
    assert "broadcast" in plan(linking.counted_small(one, spark.range(5)))
    assert "broadcast" not in plan(linking.counted_small(one, spark.range(linking.BROADCAST_ROWS + 1)))


def test_quality_separates_junk(spark, empty):
    clean = [(k, " ".join(f"wort{(k * 7 + j * j) % 91}" for j in range(60)).replace("1", "a")) for k in range(60)]
    junk = [(100 + k, "BUY!!! NOW!!! " * 40) for k in range(10)] + [(200, ""), (201, None)]
    scored = quality.score_quality(spark.createDataFrame(clean + junk, "doc_id long, text string"))
    accepted = {r[0] for r in scored.filter("accepted").select("doc_id").collect()}
    assert accepted == {k for k, _ in clean}
    assert quality.score_quality(empty).count() == 0


def test_estimate_trusts_the_consistent_labeller():
    patterns = quality.pattern_votes()
    counts = np.zeros(len(patterns))
    counts[(patterns == quality.GOOD).all(axis=1)] = 1000
    two_bad = (patterns[:, 1] == quality.BAD) & (patterns[:, 6] == quality.BAD) & ((patterns == quality.GOOD).sum(axis=1) == 5)
    counts[two_bad] = 100
    posterior = quality.estimate(counts)
    assert posterior[(patterns == quality.GOOD).all(axis=1)][0] > 0.9 and posterior[two_bad][0] < 0.1


def contaminated(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    w, hit, found = split(text), set(), set()
    for name, item in items:
        v = split(item)
        size = min(len(v), 10)
        for k in range(len(v) - size + 1) if size else ():
            for p in range(len(w) - size + 1):
                if w[p : p + size] == v[k : k + size]:
                    hit.update(range(p, p + size))
                    found.add(name)
    return len(w), len(hit), sorted(found), bool(hit)


def test_decontamination_equals_all_windows(spark, docs, rows, empty):
    text = rows[24][1].split("\n")[1]
    items = [(5, text), (5, text), (40, "Nothing of this occurs " * 4), (7, "ONE, two!"), (None, rows[0][1][3:180]), (8, None), (9, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    named = [("" if i is None else str(i), t) for i, t in items]
    got = collections.Counter(
        (r[0], r[1], r[2], tuple(r[3]), r[4])
        for r in decontaminate.mark_contaminated(docs.withColumn("items", F.lit(1)), benchmark)
        .select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    )
    want = collections.Counter()
    for i, t, *_ in rows:
        n, hit, found, bad = contaminated(t, named)
        want[(i, n, hit, tuple(found), bad)] += 1
    assert got == want
    assert decontaminate.mark_contaminated(empty, benchmark).count() == 0
    assert decontaminate.mark_contaminated(docs, benchmark.limit(0)).filter("contaminated").count() == 0


def test_fingerprints_follow_the_next_document(docs, rows, empty):
    texts = sorted(((i is not None, i or 0, t or "") for i, t, *_ in rows))
    want = collections.Counter()
    for k, (known, i, t) in enumerate(texts):
        e = fingerprints.edited(t, texts[(k + 1) % len(texts)][2])
        want[(i if known else None, len(t), hashlib.sha256(e.encode()).hexdigest(), fingerprints.fingerprint(t), fingerprints.fingerprint(e))] += 1
    for blocks in (1, 4, 50):
        got = fingerprints.fingerprint_documents(docs, blocks=blocks)
        assert table(got.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint")) == want
    assert fingerprints.fingerprint_documents(empty).count() == 0


def test_span_hashes_and_common_extension():
    a, b = fingerprints.Prefixes("xxabcabcd"), fingerprints.Prefixes("abcabce")
    assert a.span(2, 8) == b.span(0, 6) and a.span(2, 9) != b.span(0, 7)
    assert fingerprints.common_extension(a, 2, b, 0) == 6 and fingerprints.common_extension(a, 0, b, 0) == 0
    f = fingerprints.fingerprint
    assert fingerprints.likeness(f("a" * 500), f("a" * 500)) == 1 and fingerprints.likeness(f(""), f("x")) == 0
    assert 0.4 < fingerprints.likeness(f("ab" * 300), f("ab" * 150 + "c" * 300)) <= 0.5


def test_likeness_sees_past_edits_at_both_ends_and_in_the_middle():
    rng = random.Random(8)
    f, likeness = fingerprints.fingerprint, fingerprints.likeness
    for n in (1000, 4095, 10_000, 16_500):
        text = "".join(rng.choice("abcdefgh ") for _ in range(n))
        own = f(text)
        assert likeness(own, f("X" + text[1:-1] + "X")) > 0.8
        assert likeness(own, f("X" + text + "X")) > 0.8
        assert likeness(own, f(text[: n // 10] + "changed" + text[n // 10 + 4 : 9 * n // 10] + "word" + text[9 * n // 10 :])) > 0.75
        assert likeness(own, f("X" + text[1 : n // 2] + text[n // 2 + 1 : -1] + "X")) > 0.7
        assert likeness(own, f("".join(rng.choice("abcdefgh ") for _ in range(n)))) < 0.1
    assert len(f("x" * 30_000)) < 6000


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<nav><a href=x>Home</a></nav><article><h1>Head &amp; more</h1><p>First  para\n text.<br>Rest<p>Second</article><footer>c</footer>", "Head & more\nFirst para text. Rest\nSecond"),
        ('<article><p>Kept words here</p><div class="ad">Buy it</div><script>var a="</p>";</script><!-- x --><p>&lt;b&gt; end</p></article>', "Kept words here\n<b> end"),
        ('<main><p>Story text of this page</p><section id="comments"><p>nice one</p></section></main>', "Story text of this page"),
    ],
)
def test_html(page, text):
    assert html_text.main_text(page, html_text.trained_tree()) == text


@pytest.mark.parametrize(
    "opening, kept",
    [
        ('<body class="overflow-x-hidden">', True),
        ('<div class="overflow-hidden">', True),
        ('<div class="content has-sidebar">', True),
        ('<main class="hidden">', True),
        ('<div class="layout--sidebar" data-state="hidden">', True),
        ('<div title="a hidden valley">', True),
        ("<div hidden>", False),
        ('<div style="display: none">', False),
        ('<div aria-hidden="true">', False),
        ('<div class="hidden">', False),
        ('<div class="page-sidebar">', False),
    ],
)
def test_html_boilerplate_names_are_the_elements_own(opening, kept):
    story = " ".join(f"word{k}" for k in range(60))
    page = f"<html>{opening}<p>{story}</p><p>{story}</p>"
    assert html_text.main_text(page, html_text.trained_tree()) == (f"{story}\n{story}" if kept else "")


def test_html_operator_replaces_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "<article><p>a b</p></article>", "old"), (2, None, "old")], "page_id long, html string, text string")
    assert table(html_text.extract_text(pages).select("page_id", "text", "n_chars")) == {(1, "a b", 3): 1, (2, "", 0): 1}


def test_toxicity_on_held_out_rows(spark, empty):
    kinds = ["you grumpf fool", "nice day today", "grumpfing again", "plain words only"]
    data = [(k, f"{kinds[k % 4]} number{k % 17} item{k % 23}") for k in range(400)] + [(1000, None), (1001, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(k, (k + 1) % 2) for k in range(400)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert len(got) == 402 and all(0 <= r.score <= 1 for r in got.values())
    for k in range(400):
        assert got[k].held_out == (zlib.crc32(str(k).encode()) % 4 == 2)
        assert got[k].predicted == (k + 1) % 2
    assert toxicity.score_toxicity(empty, labels).count() == 0
    assert {r.score for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {0.5}


def test_suffix_dedup_equals_all_strings(docs, rows, empty):
    data = [((i is None, i or 0), i, (t or "").encode()) for i, t, *_ in rows]
    first = {}
    for place, i, b in data:
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            first[w] = min(first.get(w, place), place)
    want = collections.Counter()
    for place, i, b in data:
        cut = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < place:
                cut[p : p + 50] = b"\1" * 50
        spans = sum(c and (k == 0 or not cut[k - 1]) for k, c in enumerate(cut))
        kept = bytes(x for x, c in zip(b, cut) if not c)
        want[(i, len(b), sum(cut), spans, hashlib.sha256(kept).hexdigest())] += 1
    assert table(suffix_dedup.remove_repeats(docs).drop("spans")) == want
    assert suffix_dedup.remove_repeats(empty).count() == 0


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for x in a:
        new = [row[0] + 1]
        for k, y in enumerate(b):
            new.append(min(row[k] + (x != y), row[k + 1] + 1, new[k] + 1))
        row = new
    return row[-1]


def normal(line):
    return re.sub("[0-9]", "0", " ".join(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", line))).translate(LOWER)


def test_line_dedup_equals_all_pairs(spark, empty):
    long_line = " ".join(f"word{'abcdefgh'[k % 8]}{'xyz'[k % 3]}" for k in range(60))
    near = long_line + " x"
    texts = [
        (1, f"{long_line}\nshort\nAnother line of some length, 2020!"),
        (2, f"{near}\nshort\nanother LINE of some length 1999"),
        (3, f"quite unlike the other lines here\n\n{long_line}"),
        (4, None), (5, ""), (None, "another line of some length 1111"), (6, "unique content that stays\nunique content that stays"),
        (2, f"{near}\nshort\nanother LINE of some length 1999"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("n_lines", F.lit("clash"))
    got = collections.Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(docs).collect())
    forms = sorted({normal(line) for _, t in texts if t for line in t.split("\n")} - {""})
    links = [(a, b) for a in forms for b in forms if b < a and levenshtein(a, b) <= 0.1 * max(len(a), len(b)) + 1e-9]
    assert (near, long_line) in links
    root = union_find(forms, links)
    first = {}
    places = sorted({(i is not None, i or 0, k, line) for i, t in texts if t for k, line in enumerate(t.split("\n"))})
    for known, i, k, line in places:
        if normal(line) in root:
            first.setdefault(root[normal(line)], (known, i, k))
    want = collections.Counter()
    for i, t in texts:
        lines = [] if t is None else t.split("\n")
        kept = [x for k, x in enumerate(lines) if normal(x) not in root or first[root[normal(x)]] == (i is not None, i or 0, k)]
        want[(i, None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
    assert got == want
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_links_by_edit_similarity_alone(spark):
    """One line in two documents, the second with edits anywhere; other lines are unlike."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(2, 8)))
    data, sizes = [], [10, 11, 14, 19, 20, 23, 29, 30, 34, 39, 40, 41, 45, 52, 60, 75, 90, 99, 108, 111, 120, 150, 220, 400]
    for k, n in enumerate(sizes * 3):
        line = " ".join(word() for _ in range(n))[:n].rstrip().ljust(n, "x")
        most = n // 10  # inserted or replaced: the longer line has n characters at least
        other = list(line)
        for at in sorted(rng.sample([x for x in range(n) if line[x] != " "], most if n < 60 else most // 2 + 1), reverse=True):
            other[at : at + 1] = "q" if k % 3 else ["q", other[at]]
        data += [(2 * k, line), (2 * k + 1, "".join(other))]
    data += [(1000, "日本語日本語日本語本"), (1001, "日本語日本x日本語本")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(docs).collect()}
    missed = [(i, len(t)) for i, t in data if got[i] != i % 2]
    assert not missed


def test_line_dedup_takes_short_lines(spark):
    data = [(1, "Menu\nles\n\n日本\n--"), (2, "menu!\nlet\n\n日本\n--\nRead more"), (3, "read more\n7"), (4, "9")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: (data[0][1], 0), 2: ("let\n\n--\nRead more", 2), 3: ("7", 1), 4: ("", 1)}


def test_mixing_meets_targets(docs, rows, empty):
    got = mixing.mix_sources(docs.withColumn("size", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    sizes, targets, taken = collections.Counter(), {}, collections.Counter()
    for r in got:
        assert r.size == len(WORD.findall(r.text or "")) and r.taken == r.size * r.copies and 0 <= r.copies <= 3
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        targets[r.source] = r.target
    weights = dict(zip(["a", "b", "c", None], [5, 2, 1, 5]))
    full, level = set(), 0.0
    while True:
        rest = [s for s in weights if s not in full]
        level = (sum(sizes.values()) - sum(3 * sizes[s] for s in full)) / sum(weights[s] for s in rest)
        more = {s for s in rest if level * weights[s] > 3 * sizes[s]}
        if not more:
            break
        full |= more
    for s in weights:
        assert targets[s] == pytest.approx(3 * sizes[s] if s in full else level * weights[s])
    assert {tuple(r) for r in got} == {tuple(r) for r in mixing.mix_sources(docs.withColumn("size", F.lit("clash"))).collect()}
    assert mixing.mix_sources(empty).count() == 0
    assert mixing.emit_copies(mixing.mix_sources(docs)).agg(F.sum("size")).first()[0] == sum(taken.values())


def test_blocks_are_made_of_few_lines_at_once(monkeypatch):
    """pipeline: the working arrays of a task follow BLOCK_BYTES, not the slices of other operators; the blocks stay the same."""
    import pyarrow as pa

    from tradeloom.llm import line_dedup

    words = [f"line {n} of words that are {'long ' * (n % 30)}enough" for n in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(["\n".join(words[k : k + 20]) for k in range(0, 400, 20)])], ["text"])

    def blocks():
        found = list(line_dedup._block_rows(0.9)([batch]))
        return len(found), sorted(row for b in found for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))

    monkeypatch.setattr(line_dedup, "BLOCK_BYTES", 1 << 30)
    n, rows = blocks()
    monkeypatch.setattr(line_dedup, "BLOCK_BYTES", 4096)
    assert n == 1 and blocks()[0] > 1 and blocks()[1] == rows


def test_shuffles_of_a_stored_table_are_removed(spark):
    """op8, op9, pipeline: what a written table was shuffled through takes no disk afterwards; the setting is as before."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: set(re.findall(r"shuffle_\w+\.data", blocks.getAllFiles().mkString(" ")))
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffled(), spark.conf.get(key)
    out = session.stored(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count(), "counted")
    for _ in range(100):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before and spark.conf.get(key) == setting
    assert out.agg(F.sum("count")).first()[0] == 10_000


def test_pairs_that_cannot_be_links_are_not_made(spark):
    """pipeline, op9: `near` holds within the joins on buckets, for centres and for members; links are the same."""
    buckets = spark.createDataFrame([(b, n) for b in (1, 2) for n in range(b, 40)], "bucket long, node long")
    nodes = buckets.select("node", (F.col("node") % 5).alias("kind")).distinct()
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs.filter("abs(a.node - b.node) = 5")

    near = lambda a, b: F.expr(f"{a}.kind = {b}.kind")
    roots = dict(tuple(r) for r in linking.bucket_components(buckets, nodes, verify, near=near).collect())
    assert roots == {n: (n - 1) % 5 + 1 for n in range(6, 40)}
    assert sum(seen) <= sum(1 for a in range(1, 40) for b in range(1, a) if a % 5 == b % 5)


def test_pair_counts_never_exceed_the_edits():
    rng, codes = random.Random(5), line_dedup._codes()
    lines = ["", "a", "ab", "日", "日本語 ñandú x"] + ["".join(rng.choice("abcd é日") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    others = []
    for line in lines:
        x = list(line)
        for _ in range(rng.randint(1, 4)):
            at = rng.randint(0, len(x))
            x[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "語"])
        others.append("".join(x))
    counts = lambda texts: line_dedup._pair_counts(codes, *line_dedup.tb.buffers(pa.array(texts)))
    for a, b, x, y in zip(lines, others, counts(lines), counts(others)):
        assert sum(int(p ^ q).bit_count() for p, q in zip(x, y)) <= 4 * levenshtein(a, b)
    assert (counts(lines) == np.concatenate([counts([x]) for x in lines])).all()
    unlike = counts(["the first of two lines that share few letters", "kumquat jazz buzz wax vow hymn pyx qoph zebu gnu"])
    assert sum(int(p ^ q).bit_count() for p, q in zip(*unlike)) > 4 * 4


def test_suffix_names_are_sorted_in_turns(docs, monkeypatch):
    """op8: no table on disk holds the 48 bytes of all sampled positions at once."""
    sizes = []

    def stored(df, name):
        out = session.stored(df, name)
        if name == "sampled":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(suffix_dedup, "stored", stored)
    want = table(suffix_dedup.remove_repeats(docs).drop("spans"))
    assert len(sizes) > 1 and max(sizes) < sum(sizes) / 2
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 7)
    monkeypatch.setattr(suffix_dedup, "PIECE", 1)
    assert table(suffix_dedup.remove_repeats(docs).drop("spans")) == want
