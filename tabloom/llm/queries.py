"""Registered queries of the subpackage: ``QUERIES`` and their DuckDB twins in
``ORACLE``.  Each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.archive import archive_round_trip
from tabloom.llm.chunk_dedup import drop_repeats
from tabloom.llm.common import read_table
from tabloom.llm.hamming_search import search, sign_codes
from tabloom.llm.lbl import score_texts
from tabloom.llm.multiset_hash import fingerprints
from tabloom.llm.packing import pack_documents
from tabloom.llm.piece_dropout import encode_documents
from tabloom.llm.prefix_trie import conversation_trie
from tabloom.llm.reply_trees import format_conversations, linear_messages, read_loss, read_turns
from tabloom.llm.simhash import near_duplicates
from tabloom.llm.stripes import collocations
from tabloom.llm.suffix_search import contamination
from tabloom.llm.toxicity import score_toxicity


#: The extra conversation of the contract: its texts are control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"))
    chats = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = format_conversations(linear_messages(chats.union(extra)))
    read = out.select("tree", "formatted", read_turns(F.col("formatted")).alias("turns"),
                      read_loss(F.col("formatted"), F.col("loss")).alias("masked"))
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(all_turns, 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def binary_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest sign codes of every fiftieth vector among all vectors."""
    codes = sign_codes(read_table(spark, sf_dir, "embeddings"))
    return search(codes, codes.where(F.col("id") % 50 == 0))


def piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces under seeded merge-dropout, decoded again."""
    return encode_documents(read_table(spark, sf_dir, "documents"),
                            public_tokenizers.path("piece_bpe_32k.model"))


def multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edits and their likeness."""
    return fingerprints(read_table(spark, sf_dir, "documents"))


def simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: 3-word shingles, two bits."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def archive_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through an archive and back."""
    return archive_round_trip(read_table(spark, sf_dir, "pages"))


def toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category probabilities of all documents, from the labelled ones."""
    return score_toxicity(read_table(spark, sf_dir, "documents"),
                          read_table(spark, sf_dir, "labels"))


def chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages that an earlier one holds."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_repeats(docs, spans_col="removed")
    gone = F.coalesce(F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["chars"]),
                      F.lit(0).cast("long"))
    return out.withColumn("removed_chars", gone)


def pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token pieces in sequences of at most 4096 tokens."""
    return pack_documents(read_table(spark, sf_dir, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"))


def lbl_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of all documents; one in seven is kept from training."""
    return score_texts(read_table(spark, sf_dir, "documents"))


def phrase_stripes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2,000 phrases of two and three words of each language."""
    return collocations(read_table(spark, sf_dir, "documents"))


def suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that stand in ten-word windows of benchmark texts."""
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return conversation_trie(read_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_chat_reply_trees": chat_formatting,
    "op2_binary_top_k": binary_top_k,
    "op3_piece_dropout": piece_dropout,
    "op4_multiset_fingerprints": multiset_fingerprints,
    "op5_simhash_near_dedup": simhash_classes,
    "op6_warc_archive": archive_pages,
    "op7_toxicity_chain": toxicity_chain,
    "op8_chunk_dedup": chunk_dedup,
    "op9_pattern_packing": pattern_packing,
    "op10_lbl_scores": lbl_scores,
    "op11_phrase_stripes": phrase_stripes,
    "op12_suffix_decontamination": suffix_decontamination,
    "op13_prefix_trie": prefix_trie,
}

ORACLE: dict[str, str] = {
    "op1_chat_reply_trees": r"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
                   FROM conversations
                   UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                                    (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
             e AS (SELECT *, 20 + length(regexp_replace(role,
                       '([<\[])(\\*)(s>|/s>|ROLE\]|/ROLE\]|INST\]|/INST\])', '\1\\\2\3', 'g'))
                     + length(regexp_replace(text,
                       '([<\[])(\\*)(s>|/s>|ROLE\]|/ROLE\]|INST\]|/INST\])', '\1\\\2\3', 'g'))
                       AS chars FROM t),
             c AS (SELECT conv_id, count(*) AS n_turns,
                          string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                          coalesce(string_agg(text, '' ORDER BY turn, role, text)
                                   FILTER (role = 'assistant'), '') AS loss,
                          CAST(sum(chars) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
               sha256(loss) AS loss_sha256, formatted_chars
        FROM c""",
    "op2_binary_top_k": """
        WITH v AS (SELECT vec_id, [CAST(x > 0 AS INT) FOR x IN embedding[1:64]] AS bits
                   FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
             d AS (SELECT q.vec_id AS query_id, v.vec_id AS neighbor_id,
                          CAST(list_sum([CAST(coalesce(q.bits[i], 0) <> coalesce(v.bits[i], 0) AS INT)
                                         FOR i IN range(1, 65)]) AS BIGINT) AS distance
                   FROM v AS q CROSS JOIN v WHERE q.vec_id % 50 = 0),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank
                   FROM d)
        SELECT query_id, rank, neighbor_id, distance FROM r WHERE rank <= 10""",
    "op6_warc_archive": """
        WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
                          CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
             k AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p)
        SELECT page_id, url, payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END
                   AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
        FROM k""",
    "op11_phrase_stripes": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
             w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
             g AS (SELECT lang, k, unnest([array_to_string(ws[i:i + k - 1], ' ')
                                           FOR i IN range(1, len(ws) - k + 2)]) AS phrase
                   FROM w, (VALUES (1), (2), (3)) AS s(k) WHERE len(ws) >= k),
             f AS (SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS ws FROM g GROUP BY ALL),
             n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
             c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
             m AS (SELECT lang, part, max(f) AS most FROM (
                       SELECT lang, f, array_to_string(ws[1:2], ' ') AS part FROM c WHERE k = 3
                       UNION ALL SELECT lang, f, array_to_string(ws[2:3], ' ') FROM c WHERE k = 3)
                   GROUP BY ALL),
             d AS (SELECT c.* FROM c LEFT JOIN m ON m.lang = c.lang AND m.part = c.phrase
                   WHERE coalesce(100 * most < 50 * f, true)),
             x AS (SELECT d.lang, d.phrase, d.f AS a, cut, l.f AS l, r.f AS r,
                          (d.f::HUGEINT * d.f * 1000000) // (l.f::HUGEINT * r.f) AS score
                   FROM d JOIN (VALUES (1), (2)) AS t(cut) ON cut < d.k
                   JOIN f AS l ON l.lang = d.lang AND l.phrase = array_to_string(d.ws[1:cut], ' ')
                   JOIN f AS r ON r.lang = d.lang AND r.phrase = array_to_string(d.ws[cut + 1:], ' ')),
             b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
        SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, CAST(score AS BIGINT) AS score
        FROM b JOIN n ON n.lang = b.lang QUALIFY rank <= 2000""",
    "op12_suffix_decontamination": r"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
             t AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(
                       coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
             w AS (SELECT DISTINCT item, k, unnest([array_to_string(ws[i:i + k - 1], ' ')
                                                    FOR i IN range(1, len(ws) - k + 2)]) AS grams
                   FROM (SELECT *, least(len(ws), 10) AS k FROM t WHERE len(ws) > 0)),
             g AS (SELECT rid, k, unnest(range(1, len(ws) - k + 2)) AS pos,
                          unnest([array_to_string(ws[i:i + k - 1], ' ') FOR i IN range(1, len(ws) - k + 2)]) AS grams
                   FROM d, (SELECT DISTINCT k FROM w) WHERE len(ws) >= k),
             h AS (SELECT g.rid, g.pos, g.k, w.item FROM g JOIN w ON w.k = g.k AND w.grams = g.grams),
             n AS (SELECT rid, count(DISTINCT place) AS n_hit
                   FROM (SELECT DISTINCT rid, unnest(range(pos, pos + k)) AS place FROM h) GROUP BY rid),
             i AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                   FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN n USING (rid) LEFT JOIN i USING (rid)""",
    "op13_prefix_trie": r"""
        WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                                             coalesce(role, ''), coalesce(text, '')) AS pos
                   FROM conversations WHERE conv_id IS NOT NULL),
             c AS (SELECT conv_id, xor(list_reduce([4294967295] || [CAST(ascii(x) AS BIGINT)
                                                     FOR x IN string_split(CAST(conv_id AS VARCHAR), '')],
                       lambda s, b: list_reduce([xor(s, b)] || [0 FOR i IN range(8)],
                           lambda v, i: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END))),
                       4294967295) % 6 AS h
                   FROM (SELECT DISTINCT conv_id FROM t)),
             r AS (SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text
                   FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos <= h
                   UNION ALL SELECT conv_id, 1, pos, role, text FROM t JOIN c USING (conv_id) WHERE pos > h),
             q AS (SELECT conv_id, list(length(role) || ':' || role || text ORDER BY part, pos) AS ts,
                          list(length(text) ORDER BY part, pos) AS chars FROM r GROUP BY conv_id
                   UNION ALL SELECT conv_id, [], [] FROM c WHERE conv_id NOT IN (SELECT conv_id FROM r)),
             e AS (SELECT conv_id, len(ts) AS len, unnest(range(0, len(ts) + 1)) AS depth, ts, chars FROM q),
             m AS (SELECT depth, ts[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
                          any_value(CASE WHEN depth > 0 THEN chars[depth] ELSE 0 END) AS last,
                          coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                                   FILTER (len = depth), '') AS ends
                   FROM e GROUP BY ALL),
             k AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM m WHERE depth > 0 GROUP BY 1),
             v AS (SELECT m.*, coalesce(n_children, 0) AS n_children FROM m LEFT JOIN k USING (path)),
             s AS (SELECT up.path, count(*) FILTER (v.n_children = 0) AS n_leaves,
                          CAST(sum((v.n_convs - 1) * v.last) AS BIGINT) AS saved
                   FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM v) AS v
                   JOIN m AS up ON up.path = v.path[1:v.d] GROUP BY 1)
        SELECT v.conv_id, v.depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves,
               saved AS saved_tokens, sha256(v.ends) AS ends_sha256
        FROM v JOIN s ON s.path = v.path
        LEFT JOIN m AS up ON up.depth = v.depth - 1 AND up.path = v.path[1:v.depth - 1]""",
}
