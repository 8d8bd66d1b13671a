"""The registered queries of this subpackage, one per operator, with their production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.llm import ann, bpe, decontaminate, htmltext, langid, packing, repair, sharding, simhash, tokencounts, tokenfiles, trie, urlfilter
from skeinwork.llm.common import table

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
PACK_TOKENIZER, PACK_END_ID, PACK_LONGEST = "word_bpe_49k.json", 1, 2048
#: Bytes of a shard of op5: small enough that the given tables split.
SHARD_LIMIT = 1 << 20
RULES = [
    urlfilter.Rule("block", "com", "/en/"),
    urlfilter.Rule("allow", "example.com", "/en/7"),
    urlfilter.Rule("allow", "net", "/de/"),
    urlfilter.Rule("block", "example.net", "/de/8"),
    urlfilter.Rule("block", "org", "/es/"),
]


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document and the bytes that they decode to, as digests."""
    return bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with each benchmark item that it leaks."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's URL, by rule or by the model."""
    return urlfilter.judge(table(spark, sf_dir, "pages"), urlfilter.fit(urlfilter.labelled_urls(spark)), RULES)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs.filter(~langid.held_out("doc_id"))))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARD_LIMIT)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), width=4, limit=4)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document's lines."""
    return tokencounts.count_sections(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth id."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, written as token ids and read back."""
    return tokenfiles.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, each a sequence of its own."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(PACK_TOKENIZER), PACK_END_ID, PACK_LONGEST)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of rebuilt conversations."""
    return trie.prefix_trie(trie.rebuilt(trie.sequences(table(spark, sf_dir, "conversations"))))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    return repair.audits(repair.damage(table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_decontamination, op3_url_filter, op4_language_id, op5_sharding, op6_simhash, op7_token_counts, op8_permutation_index, op9_html_text, op10_token_files, op11_packing, op12_prefix_trie, op13_structure_repair)}


def _crc32(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a text in ASCII."""
    step = "lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {step})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)), {byte}), 4294967295::BIGINT)"


ORACLES = {
    # Sums only shrink with depth, so a leaf is a prefix that fits under a parent that does not.
    "op5_sharding": f"""WITH r AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes, lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT), 60, '0') AS place FROM documents),
  k AS (SELECT doc_id, n_bytes, d, substr(place, 1, d) AS shard FROM r, generate_series(0, 60) g(d)), n AS (SELECT d, shard, sum(n_bytes)::BIGINT AS b FROM k GROUP BY 1, 2)
  SELECT k.doc_id, k.n_bytes, k.shard, k.d::INT AS depth, n.b AS shard_bytes FROM k JOIN n USING (d, shard) LEFT JOIN n p ON p.d = k.d - 1 AND p.shard = substr(k.shard, 1, k.d - 1)
  WHERE (n.b <= {SHARD_LIMIT} OR k.d = 60) AND (k.d = 0 OR p.b > {SHARD_LIMIT})""",
    "op12_prefix_trie": f"""WITH o AS (SELECT conv_id, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS id, strlen(coalesce(text, '')) AS b,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p FROM conversations WHERE conv_id IS NOT NULL),
  c AS (SELECT conv_id, conv_id - (conv_id % 5 + 5) % 5 AS base, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM o)),
  n AS (SELECT conv_id, count(*) AS n FROM o GROUP BY 1),
  r AS (SELECT c.conv_id, p AS d, id, b FROM c JOIN o ON o.conv_id = c.base AND p <= h
    UNION ALL SELECT c.conv_id, p - h + least(h, coalesce(n.n, 0)), id, b FROM c JOIN o ON o.conv_id = c.conv_id AND p > h LEFT JOIN n ON n.conv_id = c.base),
  s AS (SELECT c.conv_id, coalesce(list(id ORDER BY d) FILTER (WHERE id IS NOT NULL), []) AS ids, coalesce(list(b ORDER BY d) FILTER (WHERE b IS NOT NULL), []) AS bs FROM c LEFT JOIN r USING (conv_id) GROUP BY 1),
  m AS (SELECT conv_id, len(ids) AS n, d, array_to_string(ids[1:d], '') AS k, CASE WHEN d > 0 THEN bs[d] ELSE 0 END AS b FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM s)),
  g AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(b) AS b, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = n), '')) AS ends FROM m GROUP BY 1, 2),
  ch AS (SELECT substr(k, 1, 32 * (d - 1)) AS k, count(*) AS n_children FROM g WHERE d > 0 GROUP BY 1),
  e AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN ch USING (k)),
  u AS (SELECT substr(k, 1, 32 * a) AS k, sum((n_convs - 1) * b)::BIGINT AS saved, count(*) FILTER (WHERE n_children = 0) AS n_leaves FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM e) GROUP BY 1)
  SELECT e.conv_id, e.d AS depth, p.conv_id AS parent_conv_id, e.n_convs, e.n_children, n_leaves, saved AS saved_tokens, e.ends AS ends_sha256 FROM e JOIN u USING (k) LEFT JOIN e p ON e.d > 0 AND p.k = substr(e.k, 1, 32 * (e.d - 1))""",
    # Cheapest edits by rows and states, of equal costs the least letters; after each row up to two turns may be inserted.
    "op13_structure_repair": f"""WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS d FROM conversations),
  dm AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(0, CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k),
  n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS p, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM dm),
  f AS (SELECT *, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY p) || left(role, 1) AS pair, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN nth > 1 THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') THEN 't' ELSE '' END AS fault FROM n),
  dp AS (SELECT conv_id, 0::BIGINT AS p, q, c, a, t FROM (SELECT DISTINCT conv_id FROM k), (VALUES (0, 0, '', ''), (2, 5, 'I', chr(10) || 'user:'), (3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')) v(q, c, a, t)
    UNION ALL SELECT conv_id, p, q, c, a, t FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, q ORDER BY c, a) AS best FROM (
      SELECT conv_id, p, CASE WHEN ins = 0 OR ins = 2 AND q1 = 2 THEN q1 WHEN ins = 1 AND q1 <> 2 OR ins = 2 AND q1 = 2 THEN 2 ELSE 3 END AS q, c + 5 * ins AS c, a || repeat('I', ins) AS a,
        t || CASE WHEN ins = 0 THEN '' WHEN q1 = 2 THEN chr(10) || 'assistant:' ELSE chr(10) || 'user:' END || CASE WHEN ins < 2 THEN '' WHEN q1 = 2 THEN chr(10) || 'user:' ELSE chr(10) || 'assistant:' END AS t
      FROM (SELECT f.conv_id, f.p, CASE l WHEN 'D' THEN q WHEN 'K' THEN CASE i WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE CASE q WHEN 2 THEN 3 ELSE 2 END END AS q1,
          c + CASE l WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN fault = 't' AND l <> 'D' THEN 5 ELSE 0 END AS c, a || l AS a,
          t || CASE l WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text ELSE chr(10) || CASE q WHEN 2 THEN 'assistant' ELSE 'user' END || ':' || text END AS t
        FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.p = dp.p + 1, (VALUES ('D'), ('K'), ('R')) m(l)
        WHERE l = 'D' OR fault NOT IN ('b', 'd') AND (l = 'R' OR i = 's' AND q = 0 OR i = 'u' AND q <> 2 OR i = 'a' AND q = 2)), (VALUES (0), (1), (2)) e(ins))) WHERE best = 1),
  z AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY p DESC, c, a) AS best FROM dp WHERE q IN (0, 3)),
  st AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1)
  SELECT z.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, c AS cost, a AS audit, sha256(substr(t, 2)) AS repaired_sha256 FROM z LEFT JOIN st ON st.conv_id IS NOT DISTINCT FROM z.conv_id WHERE best = 1""",
}
