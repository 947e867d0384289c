"""Benchmark decontamination against brute force."""

import random
import re
import string
from hashlib import sha256

from pyspark.sql import functions as F

from parcelforge.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    """``n_words, n_hit, item ids`` of every text."""
    wanted = {}
    for item, text in items:
        w = words(text)
        if item is not None and w:
            for k in range(max(len(w) - 10, 0) + 1):
                wanted.setdefault(tuple(w[k : k + 10]), set()).add(str(item))
    lengths, out = {len(g) for g in wanted}, []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if own := wanted.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= own
        out.append((i, len(w), len(hit), len(found), sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def told(spark, docs, items, **kw):
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in decontamination.contamination(d, b, **kw).collect()), key=repr)


def test_equals_brute_force(spark):
    r = random.Random(11)
    vocabulary = ["a", "b", "C", "dé", "x1", "中", "rare"]
    say = lambda n: " ".join(r.choices(vocabulary, [9, 9, 5, 3, 2, 1, 0.2], k=n))
    items = [(k, say(r.choice([1, 3, 4, 5, 6, 9, 10, 11, 14, 30]))) for k in range(14)] + [(3, "again one more text of the same item with many words in"), (90, None), (91, " .. "), (None, "a b"), (92, "never! seen; here")]
    long = [t for _, t in items if t and len(words(t)) >= 9]
    docs = [(k, say(r.choice([0, 1, 4, 9, 40, 200]))) for k in range(40)]
    docs += [(100 + k, f"{say(3)}-{r.choice(long)},{say(2)}") for k in range(20)] + [(200, long[0].upper() + "!"), (200, long[1]), (200, long[1]), (201, None), (202, ""), (203, "?!"), (None, long[2]), (None, None), (204, "a " * 60000 + long[3])]
    assert told(spark, docs, items) == brute(docs, items)
    # Without windows of one or two words, which nearly every text here holds.
    items = [x for x in items if len(words(x[1])) > 2]
    assert told(spark, docs, items) == brute(docs, items)


def test_overlapping_items_and_a_text_that_all_share(spark):
    base = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(base[k : k + 15])) for k in range(20)] + [(50, " ".join(base))]
    docs = [(k, " ".join(base)) for k in range(30)] + [(100, " ".join(base[:9])), (101, " ".join([*base[:9], "x", *base[10:]])), (102, " ".join(base[5:16] * 3))]
    assert told(spark, docs, items) == brute(docs, items)


def test_empty_tables_and_clashing_columns(spark):
    items = [(1, "one two three four five six seven eight nine ten eleven")]
    assert told(spark, [], items) == [] and told(spark, [(1, "one two")], []) == brute([(1, "one two")], []) and told(spark, [(1, "x")], [(1, "-")]) == brute([(1, "x")], [])
    docs = spark.createDataFrame([(1, f"so {items[0][1]}"), (2, "one two"), (2, "one two"), (3, None), (None, "y")], "doc_id long, text string")
    names = "own held place shingle window row_id row_text start length words item".split()
    docs = docs.select("*", *(F.lit(n).alias(n) for n in names))
    kept = decontamination.without_hits(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 2, 2, 3] and kept.head()["own"] == "own"
    found = decontamination.contamination(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"]: r["n_hit"] for r in found.collect()} == {1: 11, 2: 0, 3: 0, None: 0}
