"""Exact dedup, the Jaccard join, components, paragraph dedup, against brute force."""

import pathlib
import random
import re
import string
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from parcelforge.llm import exact_dedup, jaccard_join, linking, paragraph_dedup, scratch, shingles
from parcelforge.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(seed, n):
    r = random.Random(seed)
    return [f"w{r.randrange(5000)}" for _ in range(n)]


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(texts):
    """Least reachable id by links of Jaccard 0.8 or more, and set sizes."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    shared, by = Counter(), defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    for own in by.values():
        shared.update((a, b) for k, b in enumerate(own) for a in own[:k])
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in texts}


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "a long, b long")


def test_components(spark):
    r = random.Random(1)
    pairs = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 340)] + [(7, 7), (None, 3)]
    parent = list(range(400))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    nodes = {x for a, b in pairs if a is not None and a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in connected_components(edges(spark, pairs)).collect()} == {n: find(n) for n in nodes}
    assert connected_components(edges(spark, [(1, 1)])).count() == 0


def random_components(seed: int):
    """Edges of paths, of hubs of the greatest or least id, and of chance, and each node's component."""
    rng, pairs = random.Random(seed), []
    for k in range(12):
        own = rng.sample(range(1000 * k, 1000 * k + 900), 40)
        pairs += [list(zip(own, own[1:], strict=False)), [(max(own), x) for x in own], [(x, min(own)) for x in own], [tuple(rng.sample(own, 2)) for _ in own], list(zip(sorted(own), sorted(own)[1:], strict=False))][k % 5]
    root = {n: n for pair in pairs for n in pair}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return pairs + pairs[:50], {n: find(n) for n in root}


@pytest.mark.parametrize("most", [1 << 26, 0])
def test_components_with_and_without_broadcasts(spark, monkeypatch, most):
    monkeypatch.setattr(scratch, "BROADCAST_BYTES", most)
    pairs, brute = random_components(7)
    found = connected_components(edges(spark, pairs)).collect()
    assert {r["node"]: r["component"] for r in found} == brute and len(found) == len(brute)


def test_components_of_few_edges_take_few_tasks(spark):
    """What a run leaves on disk for each task (logs, shuffle files) is more than such edges are."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup("few-edges", "few edges")
    try:
        pairs, brute = random_components(8)
        found = connected_components(edges(spark, pairs))
        tracker = spark.sparkContext.statusTracker()
        stages = {s for job in tracker.getJobIdsForGroup("few-edges") for s in tracker.getJobInfo(job).stageIds}
        tasks = sum(info.numCompletedTasks for info in map(tracker.getStageInfo, stages) if info)
        assert {r["node"]: r["component"] for r in found.collect()} == brute
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert 0 < tasks < 700, tasks


def test_exact_dedup_against_an_index(spark, make_docs):
    index = exact_dedup.DigestIndex(spark)
    first = {r["doc_id"]: r for r in exact_dedup.deduplicate(make_docs(["A", "a", "É", "é", None, "", (9, "b")]), index).collect()}
    assert [first[k]["kept"] for k in range(6)] == [False, True, True, True, False, True] and first[0]["keep_id"] == 1 and first[4]["group_size"] == 2
    second = {r["doc_id"]: r for r in exact_dedup.deduplicate(make_docs([(20, "B"), (21, "c")]), index).collect()}
    assert not second[20]["kept"] and second[20]["keep_id"] == 9 and second[21]["kept"]
    assert exact_dedup.deduplicate(make_docs([]), index).count() == 0
    kept = exact_dedup.keep_first_copies(make_docs([(1, "x"), (2, "X"), (2, "X"), (None, "x"), (None, "y")]), exact_dedup.DigestIndex(spark))
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect()) == [(-1, "y"), (2, "X")]


def test_a_batch_that_is_run_again_keeps_the_same(spark, make_docs):
    index = exact_dedup.DigestIndex(spark, buckets=3)
    docs = make_docs([(1, "x"), (2, "X"), (3, "y"), (None, "z")])
    told = lambda batch, df=docs: sorted((r["doc_id"] or -1, r["keep_id"] or -1, r["kept"]) for r in exact_dedup.deduplicate(df, index, batch=batch).collect())
    first = told("a")
    assert told("a") == first and index.read().count() == 3
    index.append(index.resolved(exact_dedup.deduplicate(docs.limit(0), index).groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "b").where("NOT added"), "b")
    assert [r[2] for r in told("b")] == [False] * 4 and told("b", make_docs([(9, "new")])) == [(9, 9, True)]
    index.compact(5)
    again = exact_dedup.DigestIndex(spark, index.path)
    assert again.buckets == 5 and again.read().count() == 4 and told("a") == first and told("b", make_docs([(9, "new")])) == [(9, 9, True)]
    again._registered(f"{index.path}/aside-x-5")  # a compaction that a crash cut short
    assert exact_dedup.DigestIndex(spark, index.path).read().count() == 4


def test_another_session_finds_the_index(spark, make_docs, tmp_path):
    path = f"{tmp_path}/index"
    exact_dedup.deduplicate(make_docs([(1, "x"), (2, "y")]), exact_dedup.DigestIndex(spark, path, buckets=2), batch="a").count()
    code = f"""
import sys
sys.path.insert(0, {str(pathlib.Path(__file__).parents[2])!r})
from parcelforge.session import local_session
from parcelforge.llm import exact_dedup
spark = local_session(2, spark__sql__warehouse__dir={str(tmp_path / 'w')!r})
index = exact_dedup.DigestIndex(spark, {path!r})
docs = spark.createDataFrame([(7, "X"), (8, "new")], "doc_id long, text string")
print("FOUND", sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in exact_dedup.deduplicate(docs, index, batch="b").collect()), index.buckets)
"""
    told = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=tmp_path, check=False)
    assert "FOUND [(7, 1, False), (8, 8, True)] 2" in told.stdout, told.stderr[-2000:]
    assert exact_dedup.DigestIndex(spark, path).read().count() == 3


def test_batches_that_ran_at_once_and_hot_groups(spark, make_docs, monkeypatch):
    index = exact_dedup.DigestIndex(spark, buckets=2)
    docs = make_docs([(1, "x"), (2, "x"), (3, "y")])
    groups = exact_dedup.deduplicate(docs, exact_dedup.DigestIndex(spark)).groupBy("digest").agg(F.max("keep_id").alias("keep_id"))
    for batch in ("b", "a"):  # neither saw the other's rows
        index.append(groups.withColumn("keep_id", F.col("keep_id") + (100 if batch == "b" else 0)), batch)
    found = exact_dedup.deduplicate(docs, index, batch="c").collect()
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in found) == [(1, 2, False), (2, 2, False), (3, 3, False)]
    monkeypatch.setattr(exact_dedup, "HOT", 3)
    texts = [(k, "ABCDx"[k % 5 * (k % 2)]) for k in range(60)] + [(None, "a"), (None, None), (7, "b")]
    told = exact_dedup.deduplicate_in_batches(make_docs(texts), exact_dedup.DigestIndex(spark), batches=3).collect()
    by = defaultdict(list)
    for i, t in texts:
        by[(t or "").lower()].append(i)
    want = [(i, max((x for x in own if x is not None), default=None), len(own)) for own in by.values() for i in own]
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in told), key=repr) == sorted(want, key=repr)
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in told)


def clashing(docs):
    """Columns of the names that operators use themselves."""
    names = "_own _id _gone id digest name node grp size c0 text_a start end gaps cut keep_id component_id doc asked_doc key".split()
    return docs.select("*", *(F.lit(n).alias(n) for n in names)), names


def test_columns_of_clashing_names_are_kept(spark, make_docs):
    base = words(5, 120)
    docs, names = clashing(make_docs([(1, " ".join(base)), (2, " ".join(base).upper()), (3, " ".join([*base[:119], "z"])), (4, None), (5, ""), (5, "")]))
    kept = exact_dedup.keep_first_copies(docs, exact_dedup.DigestIndex(spark))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5] and kept.head()["_own"] == "_own"
    one = jaccard_join.keep_one_of_each(docs)
    assert one.columns == docs.columns and sorted(r["doc_id"] for r in one.collect()) == [1, 4, 5, 5]
    found = paragraph_dedup.repeated_passages(docs)
    cut = paragraph_dedup.without_passages(docs, found)
    assert cut.columns == docs.columns and sorted(r["doc_id"] for r in cut.collect()) == [1, 4, 5, 5] and cut.head()["gaps"] == "gaps"


def test_jaccard_components(spark, sf_dir, small_docs):
    texts = {r["doc_id"]: r["text"] for r in small_docs.select("doc_id", "text").collect()}
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(small_docs).collect()}
    assert found == brute_components(texts)


def test_jaccard_near_copies_in_groups(make_docs):
    """A group of edited copies, chains among them, copies of sets in another order of words, and odd texts."""
    r, base = random.Random(3), words(0, 150)
    texts = {}
    for k in range(60):
        w = list(base)
        for _ in range(r.randrange(5)):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        texts[k] = " ".join(w)
    texts |= {60: " ".join(base), 61: " ".join(base).upper(), 62: " ".join(base + base), 70: None, 71: "", 72: " \n", 73: "one two", 74: "ONE two", 75: "a b c d e", 76: "of " * 400, 77: "of " * 900}
    found = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in jaccard_join.jaccard_components(make_docs(list(texts.items()))).collect()}
    assert found == brute_components(texts)


def test_jaccard_rows_without_id_and_repeated_rows(make_docs):
    text = " ".join(words(5, 40))
    found = jaccard_join.jaccard_components(make_docs([(None, text), (4, text), (4, text), (2, text)])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in found) == [(-1, -1), (2, 2), (4, 2), (4, 2)]
    assert jaccard_join.jaccard_components(make_docs([])).count() == 0


def test_bounds_hold_for_all_links():
    r = random.Random(7)
    for n in (1, 4, 5, 9, 100, 1000, 3000):
        for _ in range(20):
            one = np.unique(np.array([r.getrandbits(64) for _ in range(n)], np.uint64))
            keep = one[: max(1, int(len(one) * r.uniform(0.7, 1)))]
            two = np.unique(np.concatenate((keep, np.array([r.getrandbits(64) for _ in range(r.randrange(n // 4 + 1))], np.uint64))))
            a, b = (np.unpackbits(linking.parity_sketch(x).view(np.uint8)) for x in (one, two))
            if len(a) < len(b):
                a, b = b, a
            if len(a) == 2 * len(b):
                a = a[: len(b)] ^ a[len(b) :]
            if len(a) == len(b):
                assert int((a ^ b).sum()) <= len(np.setxor1d(one, two))
            shared = len(np.intersect1d(one, two))
            if 100 * shared >= 80 * (len(one) + len(two) - shared):
                p, q = (x[: linking.prefix_length(len(x))] for x in (one, two))
                assert len(np.intersect1d(p, q))


def test_shingles_by_bytes():
    text = "É a\tB\x0bc d" + " x" * 3
    assert len(next(iter(shingles.shingle_sets([text])))) == len(shingle_set(text))
    a, b, c, d = shingles.shingle_sets(["A b c d e f", "a B C D e f", "a b", ""])
    assert a.tolist() == b.tolist() and len(c) == 1 and len(d) == 0


def passage_docs():
    passage = " ".join(words(99, 70))
    texts = {k: " ".join(words(1000 + k, 300)) for k in range(30)}
    for k in (3, 8, 21):
        w = texts[k].split()
        texts[k] = " ".join(w[: 50 + k]) + " " + passage + " " + " ".join(w[50 + k :])
    short = " ".join(words(98, 20))
    for k in (4, 5):
        texts[k] += " " + short
    return texts, passage


def test_repeated_passages_are_found_and_cut(make_docs):
    texts, passage = passage_docs()
    docs = make_docs([*texts.items(), (90, None), (91, ""), (None, passage)])
    found = paragraph_dedup.repeated_passages(docs)
    rows = found.collect()
    assert {r["doc_id"] for r in rows} == {8, 21} and {r["keep_id"] for r in rows} == {3}
    assert all(texts[r["doc_id"]][r["start"] : r["end"]] == passage for r in rows)
    cut = {r["doc_id"]: r["text"] for r in paragraph_dedup.without_passages(docs, found).collect() if r["doc_id"] is not None}
    assert passage in cut[3] and passage not in cut[8] and passage not in cut[21]
    assert all(cut[k] == texts[k] for k in texts if k not in (8, 21)) and cut[90] is None and cut[91] == ""


def test_long_words_and_repeated_words_at_the_ends_are_found(make_docs):
    """Shared passages of 56 words of 90 characters, and one with a word over and over at its end, are taken whole."""
    r = random.Random(11)
    long = [" ".join("".join(r.choice(string.ascii_lowercase) for _ in range(90)) for _ in range(56)) for _ in range(6)]
    dull = " ".join(words(97, 70)) + " the" * 400
    texts = {}
    for k, passage in enumerate([*long, dull]):
        for half in (0, 1):
            texts[10 * k + half] = " ".join([*words(2000 + 10 * k + half, 80), passage, *words(3000 + 10 * k + half, 80)])
    found = paragraph_dedup.repeated_passages(make_docs(list(texts.items()))).collect()
    assert sorted(texts[r["doc_id"]][r["start"] : r["end"]] for r in found) == sorted([*long, dull])


def test_short_paragraphs_count_and_one_word_over_and_over_does_not():
    r = random.Random(2)
    texts = [" ".join(f"w{r.randrange(9999)}" for _ in range(n)) for n in range(5, 9)]
    x = paragraph_dedup.paragraphs_of([*texts, "of " * 90, " ".join([*words(1, 60), *["of"] * 90, *words(2, 60)])])
    assert {0, 1, 2, 3} <= set(x["text"].tolist()) and 4 not in x["text"] and x["idx"][x["text"] == 5].tolist() == list(range(int((x["text"] == 5).sum())))


def test_shared_words_ask_for_more_text():
    more = paragraph_dedup.shared_words
    assert more("a b c", "a  b c", False) == (3, 5, 6, False) and more("a b c", "a b c", False, (True, True)) == (2, 3, 3, True)
    assert more("a b c", "a b d", False, (True, True)) == (2, 3, 3, True) and more("a x c", "a b c", False, (True, True)) == (1, 1, 1, False)
    assert more("b c", "x b c", True, (False, True)) == (2, 3, 3, False) and more("b c", "b c ", True, (True, True)) == (1, 1, 2, True)
    assert more("", "", False) == (0, 0, 0, False) and more("A B", "a b", True) == (2, 3, 3, False) and more("Σ", "σ", False) == (0, 0, 0, False)


def test_one_passage_is_one_row(make_docs):
    """A line over and over in a document, a passage whose lines occur before apart, and one that goes on in a word said
    500 times."""
    line, passage, tail = " ".join(words(1, 31)), words(2, 70), " ".join([*words(3, 70), *["over"] * 500])
    texts = {0: " ".join([*words(10, 90), *passage[20:45], *words(11, 90)]), 1: " ".join([*words(12, 60), *passage, *words(13, 60)]), 2: " ".join([*words(14, 60), *passage, *words(15, 60)])}
    texts |= {3: " ".join([*words(16, 40), *[line] * 12, *words(17, 40)]), 4: f"{' '.join(words(18, 30))} {tail} {' '.join(words(19, 30))}", 5: f"{' '.join(words(20, 30))} {tail} {' '.join(words(21, 30))}"}
    found = {r["doc_id"]: texts[r["doc_id"]][r["start"] : r["end"]] for r in paragraph_dedup.repeated_passages(make_docs(list(texts.items()))).collect()}
    # A paragraph may begin some words before the passage: it is alike, not equal.
    assert found[5].endswith(tail) and len(found.pop(5)) < len(tail) + 50
    assert found == {2: " ".join(passage), 3: " ".join([line] * 11)}


def test_no_passage_is_lost_everywhere(small_docs):
    """Of every 50 words that several documents share, one document at least keeps them or a near copy is kept."""
    found = paragraph_dedup.repeated_passages(small_docs).collect()
    assert all((r["keep_id"], r["keep_start"]) < (r["doc_id"], r["end"]) for r in found)
    texts = {r["doc_id"]: r["text"] or "" for r in small_docs.collect()}
    spans = defaultdict(list)
    for r in found:
        spans[r["doc_id"]].append((r["start"], r["end"]))
    seen = defaultdict(set)
    for i, t in texts.items():
        w = [m for m in WORD.finditer(t)]
        for k in range(len(w) - 59):
            part = w[k : k + 60]
            distinct = {m.group() for m in part}
            if len(distinct) > 20:
                seen[" ".join(m.group().lower() for m in part)].add((i, any(a <= part[0].start() and part[-1].end() <= b for a, b in spans[i])))
    shared = [v for v in seen.values() if len({i for i, _ in v}) > 1]
    left = [v for v in shared if len({i for i, gone in v if not gone}) > 1]
    assert shared and len(left) <= 0.1 * len(shared)


def test_overlapping_spans_are_cut_once(spark, make_docs):
    spans = spark.createDataFrame([(0, 0, 3), (0, 2, 5), (0, 7, 8), (1, 0, 9)], "doc_id long, start int, end int")
    out = {r["doc_id"]: r["text"] for r in paragraph_dedup.without_passages(make_docs(["abcdefghij", "whole one", "same"]), spans).collect()}
    assert out == {0: "fgij", 2: "same"}
    assert paragraph_dedup.repeated_passages(make_docs([])).count() == 0


def test_words_that_collide_under_polynomials_are_told_apart(make_docs):
    one, other = ("".join("ab"[(k.bit_count() + x) % 2] for k in range(2048)) for x in (0, 1))
    found = jaccard_join.jaccard_components(make_docs([f"p q r s {one}", f"p q r s {other}", f"P q r s {other}"])).collect()
    assert sorted(tuple(r) for r in found) == [(0, 1, 0), (1, 1, 1), (2, 1, 1)]


def test_words_that_collide_eight_bytes_at_a_time_are_told_apart(make_docs):
    # A hash that takes in eight bytes at a time and scrambles after each gives these two one value.
    texts = [f"one two three four {w} six seven" for w in ("abcdefghijklmnop", "pgmxoohjj?7-_gd1")]
    found = jaccard_join.jaccard_components(make_docs([(1, texts[0]), (2, texts[1]), (3, texts[1].upper())]))
    assert sorted(map(tuple, found.collect())) == [(1, 3, 1), (2, 3, 2), (3, 3, 2)]
    (one, a), (two, b), (_, c) = shingles.digested_sets([texts[0], texts[1], texts[1].upper()])
    assert not set(one.tolist()) & set(two.tolist()) and a != b and b == c


def test_exact_sets_are_those_of_the_words():
    r = random.Random(1)
    texts = [" ".join(r.choice(["a", "B", "b", "c" * 70, "D" * 130, "é", "longerword", "longerwore"]) for _ in range(r.randrange(12))) for _ in range(120)] + [None]
    own, exact, hashed = [shingle_set(t) for t in texts], list(shingles.exact_sets(texts)), list(shingles.shingle_sets(texts))
    for i, x in enumerate(own):
        for j, y in enumerate(own):
            assert len(x & y) == len(np.intersect1d(exact[i], exact[j])) == len(np.intersect1d(hashed[i], hashed[j]))
