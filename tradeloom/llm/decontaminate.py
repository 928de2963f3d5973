"""Benchmark decontamination by winnowing, in DataFrame operations only.

Every window of `WINDOW` words is represented by the least hash of the `GRAM`-word runs inside
it (its fingerprint), so two texts that share a window share its fingerprint. The distinct
fingerprints of each document are joined with the benchmark's, a side that Spark broadcasts
where its size allows and shuffles otherwise. Only documents that meet one are looked at again
(their keys are broadcast up to a counted size), where the windows behind the fingerprints are
compared word by word and overlapping hits extend each other.
"""

import string

from pyspark.sql import Window
from pyspark.sql import functions as F

from tradeloom.llm.linking import counted_small
from tradeloom.session import stored

# All but a-z, 0-9 and what is not ASCII; the commonest range first, as matching tries them in turn.
BREAK = r"[^a-z0-9\x{80}-\x{10FFFF}]+"
WORD = r"[a-zA-Z0-9\x{80}-\x{10FFFF}]+"
WINDOW = 10
GRAM = 5
KEY = ["__id", "__hash"]


def words(text):
    """Words of a text in lower case (A-Z only); none for null."""
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    folded = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, upper, lower)).otherwise(F.lower(text))
    return F.array_remove(F.split(F.coalesce(folded, F.lit("")), BREAK), "")


def fingerprints(texts, size, gram):
    """`prints`: for each window of `size` words the least hash of its runs of `gram` words."""
    n = min(gram, size)
    run = lambda x, i: F.xxhash64(x, *[F.get("hashes", i + k) for k in range(1, n)])
    least = lambda x, i: F.least(x, *[F.get("runs", i + k) for k in range(1, size - n + 1)]) if size > n else x
    count = F.greatest(F.size("hashes") - (size - 1), F.lit(0))
    # Arrays in steps of their own: each is computed once per text.
    return (
        texts.withColumn("runs", F.slice(F.transform("hashes", run), 1, F.greatest(F.size("hashes") - (n - 1), F.lit(0))))
        .withColumn("prints", F.slice(F.transform("runs", least), 1, count))
        .drop("runs")
    )


def windows(texts, size, gram):
    """One row per window: the columns of `texts`, first (word number from 0), fingerprint."""
    marked = fingerprints(texts, size, gram)
    # An inner explode would make Spark infer a filter on the array and compute it inside itself.
    return marked.select(*texts.columns, F.posexplode_outer("prints").alias("first", "fingerprint")).filter("first >= 0")


def with_words(df, text):
    split = df.withColumn("words", words(F.col(text)))
    return split.withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x)))


def _window_text(size):
    return F.array_join(F.slice("words", F.col("first") + 1, size), " ")


def _items(benchmark, item_id, text):
    name = F.coalesce(F.col(item_id).cast("string"), F.lit(""))
    return with_words(benchmark.select(name.alias("item"), F.col(text).alias("text")), "text").filter(F.size("words") > 0)


def mark_contaminated(docs, benchmark, id="doc_id", text="text", item_id="item_id", item_text="text", window=WINDOW, gram=GRAM):
    """Every row of `docs` with n_words, n_hit, items (sorted ids), contaminated.

    A window is `window` consecutive words of an item; an item with fewer words, but not none,
    is one window. A document word inside any occurrence of a window is hit. All columns of
    `docs` stay; the new ones replace columns of the same name. Null and empty texts have no
    words and no hits; null item ids count as the empty id; items that repeat an id are one
    item. Rows are told apart by id (null included) and text, so rows that repeat get the same
    result each. An empty benchmark or table gives no hits or no rows.
    """
    c = F.col
    items = _items(benchmark, item_id, item_text)
    # At most `window` numbers: the lengths that windows have.
    sizes = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(window))).distinct().collect())
    keyed = docs.withColumns(
        {"__id": F.coalesce(c(id).cast("long"), F.lit(-(1 << 63))), "__hash": F.xxhash64(c(text))}
    )
    narrow = keyed.select(*KEY, c(text).alias("text"))

    found = None
    for size in sizes:
        own = items.filter(F.size("words") >= window if size == window else F.size("words") == size)
        targets = windows(own, size, gram).select("item", "fingerprint", _window_text(size).alias("window"))
        prints = targets.select("fingerprint").distinct()
        touched = (
            fingerprints(with_words(narrow, "text"), size, gram)
            .select(*KEY, F.explode_outer(F.array_distinct("prints")).alias("fingerprint"))
            .join(prints, "fingerprint", "left_semi")
            .select(*KEY)
            .distinct()
        )
        suspects = narrow.join(counted_small(stored(touched, "touched")), KEY, "left_semi")
        hits = (
            windows(with_words(suspects, "text"), size, gram)
            .join(prints, "fingerprint", "left_semi")
            .select(*KEY, "first", _window_text(size).alias("window"))
            .join(targets.groupBy("window").agg(F.collect_set("item").alias("items")), "window")
            .select(*KEY, "first", F.lit(size).alias("size"), "items")
        )
        found = hits if found is None else found.unionByName(hits)

    made = ["n_words", "n_hit", "items", "contaminated"]
    kept = [x for x in docs.columns if x not in made]
    n_words = F.coalesce(F.regexp_count(c(text), F.lit(WORD)), F.lit(0)).cast("long")
    counted = keyed.withColumn("__words", n_words)
    if found is None:
        joined = counted.withColumns({"__hit": F.lit(0), "__items": F.array().cast("array<string>")})
    else:
        joined = counted.join(_per_document(found), KEY, "left")
    n_hit = F.coalesce("__hit", F.lit(0)).cast("long")
    return joined.select(
        *kept,
        c("__words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("__items", F.array().cast("array<string>")).alias("items"),
        (n_hit > 0).alias("contaminated"),
    )


def _per_document(hits):
    """Words covered by the hits of a document, and its items. A document bounds its group."""
    at = hits.groupBy(*KEY, "first").agg(F.max("size").alias("size"), F.flatten(F.collect_set("items")).alias("items"))
    so_far = Window.partitionBy(*KEY).orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("first") + F.col("size")
    covered = at.withColumn("before", F.coalesce(F.max(end).over(so_far), F.lit(0))).withColumn(
        "fresh", F.greatest(end - F.greatest("first", "before"), F.lit(0))
    )
    return covered.groupBy(*KEY).agg(
        F.sum("fresh").alias("__hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("__items"),
    )


ORACLE_SQL = r"""
with doc as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
item as (
  select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
spans as (
  select item_id, w, least(len(w), 10) as n, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from item where len(w) > 0),
target as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as words from spans),
place as (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from doc, (select distinct n from target) where len(w) >= n),
hit as (
  select p.doc_id, p.i, p.n, t.item_id
  from (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as words from place) p join target t using (n, words)),
word as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + n)) as k from hit) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, item_id::varchar as id from hit) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join word using (doc_id) left join items using (doc_id)
"""
