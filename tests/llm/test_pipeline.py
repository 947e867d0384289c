"""The corpus pipeline over planted documents, stage by stage."""

import corpus_pipeline
from parcelforge.llm.scratch import materialise
from test_dedup import brute_components, passage_docs
from test_tokens import check_packing

from pyspark.sql import functions as F


def test_pipeline_stages(spark, small_docs, make_docs):
    # The planted texts in words of the documents, so that they are in a language.
    vocabulary = sorted({w for r in small_docs.where("lang = 'en'").limit(60).collect() for w in r["text"].lower().split() if w.isalpha() and w.isascii()})
    spelled = lambda text: " ".join(vocabulary[int(w[1:]) % len(vocabulary)] for w in text.split())
    texts, passage = passage_docs()
    texts, passage = {k: spelled(t) for k, t in texts.items()}, spelled(passage)
    jumbled = " ".join("".join(chr(97 + (k * k * 7 + n * 31 + k * n) % 26) for k in range(3 + n % 6)) for n in range(60))
    planted = {1000 + k: t for k, t in texts.items()} | {2000: texts[0].upper(), 2001: " ".join(texts[1].split()[:-3]), 2002: "12 34", 2003: None, 2004: jumbled, 2005: "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw"}
    docs = small_docs.unionByName(make_docs(list(planted.items())))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "jaccard_join", "substring_dedup", "packing"]
    step = {}
    for name, stage in stages.items():
        docs = step[name] = materialise(stage(spark, docs, ""), name)
    ids = {n: {r["doc_id"] for r in d.select("doc_id").collect()} for n, d in step.items()}
    assert all(step[n].columns == small_docs.columns for n in list(stages)[:-1])
    assert not {2002, 2003, 2004, 2005} & ids["language_id"] and len(ids["language_id"]) >= 0.98 * (200 + len(planted) - 4)
    assert 2000 in ids["exact_dedup"] and 1000 not in ids["exact_dedup"]
    held = {r["doc_id"]: r["text"] for r in step["exact_dedup"].collect()}
    assert ids["jaccard_join"] == {i for i, (_, c) in brute_components(held).items() if i == c} and 2001 not in ids["jaccard_join"]
    cut = {r["doc_id"]: (r["text"], r["n_chars"]) for r in step["substring_dedup"].collect()}
    assert sum(passage in t for t, _ in cut.values()) == 1 and all(len(t) == n for t, n in cut.values())
    pieces = step["packing"].withColumn("ids_crc32", F.crc32("ids")).collect()
    check_packing(pieces, {i: t for i, (t, _) in cut.items()})


def test_run_equals_the_stages(spark, sf_dir, small_docs):
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    docs = small_docs
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)

    def tokens(pieces):
        """The ids of each document, wherever they are cut."""
        out = {}
        for r in sorted(pieces.collect(), key=lambda r: (r["doc_id"], r["start"])):
            out[r["doc_id"]] = out.get(r["doc_id"], b"") + bytes(r["ids"])
        return out

    assert tokens(found) == tokens(docs) and found.count() > 100


def test_stages_on_empty_tables_repeated_rows_and_clashing_columns(spark, small_docs, make_docs):
    empty = small_docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0, name
    docs = small_docs.limit(60).unionByName(small_docs.limit(5)).unionByName(make_docs([(None, None), (7777, "")])).withColumn("id", F.lit("id")).withColumn("lang_known", F.lit("old")).withColumn("digest", F.lit(3))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs.select(sorted(docs.columns)), ""), name)
        assert docs.columns == sorted(docs.columns) and docs.where("id = 'id' AND digest = 3 AND lang_known = 'old'").count() == docs.count() > 0, name
    assert stage is not None and dict(corpus_pipeline.STAGES)["packing"](spark, docs, "").count() > 0
