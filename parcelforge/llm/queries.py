"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_trie, decontamination, exact_dedup, hard_negatives, html_layout, jaccard_join, language_id, license_rules, order_minhash, packing, paragraph_dedup, piece_bpe, warc
from .scratch import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary file lies; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op5_exact_dedup",
    """WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
    g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
)
def op5_exact_dedup(spark, sf_dir):
    """The whole of ``documents`` against a new index, in two batches: the second finds the texts of the first in it."""
    index = exact_dedup.DigestIndex(spark)
    found = exact_dedup.deduplicate_in_batches(table(spark, sf_dir, "documents"), index)
    index.drop()  # a user keeps it for the next batch; results don't read it
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query(
    "op9_warc",
    """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
    g AS (SELECT payload_digest, payload_bytes, max(page_id) AS first_id FROM p GROUP BY ALL)
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
    FROM p JOIN g USING (payload_digest, payload_bytes)""",
)
def op9_warc(spark, sf_dir):
    """Write every page to an archive, read the records back, and take every figure from what was read."""
    archive = warc.write_archive(table(spark, sf_dir, "pages"))
    read = warc.parse_records(warc.read_records(spark, archive))
    whole = F.col("record_type") == "response"
    facts = materialise(
        read.select("page_id", "record_type", "refers_to", F.when(whole, F.octet_length("payload").cast("long")).alias("payload_bytes"), F.when(whole, F.sha1("payload")).alias("payload_digest")),
        "warc-read",
    )
    responses = facts.where(whole)
    referred = responses.groupBy(F.col("page_id").alias("refers_to")).agg(F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest"))
    revisits = facts.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to").join(referred, "refers_to")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(columns).unionByName(revisits.select(columns))


@query("op1_piece_bpe")
def op1_piece_bpe(spark, sf_dir):
    """Encode and decode the whole of ``documents``; both digests are taken from the operator's ids and texts."""
    path = tokenizer_file("piece_bpe_32k.model")
    ids = piece_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, keep_text=False)
    told = ids.withColumn("ids_sha256", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)).withColumn("n_tokens", F.size("ids").cast("long"))
    texts = piece_bpe.decode(told, path, keep_ids=False)
    return texts.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op3_packing")
def op3_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op10_language_id")
def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs)
    found = language_id.predict(docs.select("doc_id", "text"), model, keep_text=False)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query("op2_order_minhash")
def op2_order_minhash(spark, sf_dir):
    """Fingerprints of the whole of ``documents`` and of its edited texts."""
    found = order_minhash.edit_pairs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        order_minhash.fingerprint(F.col("signature")).alias("fingerprint"), order_minhash.fingerprint(F.col("edited_signature")).alias("edited_fingerprint"),
        order_minhash.likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        order_minhash.likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )


@query("op6_jaccard_join")
def op6_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


@query("op8_substring_dedup")
def op8_substring_dedup(spark, sf_dir):
    """Every passage of 50 words or more that another document (or place) keeps, over the whole of ``documents``."""
    return paragraph_dedup.repeated_passages(table(spark, sf_dir, "documents"))


@query("op4_html_layout")
def op4_html_layout(spark, sf_dir):
    """The visible text of every page."""
    found = html_layout.extract(table(spark, sf_dir, "pages").select("page_id", "html"), keep_html=False)
    return found.select("page_id", "text", F.char_length("text").cast("long").alias("text_chars"))


@query("op7_license_rules", license_rules.oracle())
def op7_license_rules(spark, sf_dir):
    """The licences that documents state, over whole texts."""
    found = license_rules.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("licence_sentences").cast("long").alias("n_sentences"), F.array_join("licence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))


@query(
    "op11_decontamination",
    r"""WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
    b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
    starts AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM b WHERE len(w) > 0),
    win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + 9], ' ') AS g FROM starts),
    grams AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM d, (SELECT DISTINCT n FROM win))),
    occ AS (SELECT r, i, n, item_id FROM grams JOIN win USING (n, g)),
    hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM occ) GROUP BY r),
    named AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM occ) GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)""",
)
def op11_decontamination(spark, sf_dir):
    """Every whole document against every window of every benchmark item."""
    return decontamination.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


@query(
    "op12_conversation_trie",
    r"""WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
    crc AS (SELECT c, c::VARCHAR AS s, 0 AS k, 4294967295::BIGINT AS v FROM ids
      UNION ALL SELECT c, s, k + 1, CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END
      FROM (SELECT c, s, k, CASE WHEN k % 8 = 0 THEN xor(v, ascii(substr(s, k // 8 + 1, 1))::BIGINT) ELSE v END AS y FROM crc WHERE k < 8 * length(s))),
    h AS (SELECT c, (xor(v, 4294967295) % 4)::INTEGER AS h FROM crc WHERE k = 8 * length(s)),
    told AS (SELECT conv_id, turn, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
    own AS (SELECT conv_id, list(digest ORDER BY turn NULLS FIRST, digest) AS l, list(words ORDER BY turn NULLS FIRST, digest) AS lw FROM told GROUP BY conv_id),
    r AS (SELECT c, coalesce(b.l[1:h], []) || o.l[h + 1:] AS l, coalesce(b.lw[1:h], []) || o.lw[h + 1:] AS lw
      FROM h JOIN own o ON o.conv_id = c LEFT JOIN own b ON b.conv_id = c - c % 20),
    each AS (SELECT c, d, array_to_string(l[1:d], '') AS p, array_to_string(l[1:d - 1], '') AS up, CASE WHEN d > 0 THEN lw[d] ELSE 0 END AS w, len(l) AS n FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM r)),
    nodes AS (SELECT p, d, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(w) AS saved,
      sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256 FROM each GROUP BY p, d),
    kids AS (SELECT up AS p, count(*) AS k FROM nodes WHERE d > 0 GROUP BY up),
    full_nodes AS (SELECT nodes.*, coalesce(k, 0) AS k FROM nodes LEFT JOIN kids USING (p)),
    sums AS (SELECT a.p, count(*) FILTER (b.k = 0) AS n_leaves, sum(b.saved)::BIGINT AS saved_tokens FROM full_nodes a JOIN full_nodes b ON starts_with(b.p, a.p) GROUP BY a.p)
    SELECT x.conv_id, x.d AS depth, CASE WHEN x.d > 0 THEN y.conv_id END AS parent_conv_id, x.n_convs, x.k AS n_children, n_leaves, saved_tokens, x.ends_sha256
    FROM full_nodes x JOIN sums USING (p) LEFT JOIN nodes y ON y.p = x.up""",
)
def op12_conversation_trie(spark, sf_dir):
    """All nodes of the trie of all conversations, rebuilt to share starts as the contract has it."""
    own = conversation_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    turns = materialise(conversation_trie.shared_starts(own, group=20, most=4), "rebuilt")
    return conversation_trie.prefix_trie(turns, table(spark, sf_dir, "conversations"))


@query(
    "op13_hard_negatives",
    """WITH rows_ AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM rows_ a JOIN rows_ b ON a.id % 100 = 0 AND a.id <> b.id),
    positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER w AS rank, id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN pairs USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 10""",
)
def op13_hard_negatives(spark, sf_dir):
    """For each hundredth vector its positives, and for each of them the hardest negatives within the window."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.usable(table(spark, sf_dir, "embeddings"), label=label)
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)
