"""The registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import read
from sluice.llm.decontaminate import find_contamination, items_digest
from sluice.llm.embedding_dedup import near_vectors
from sluice.llm.html_extract import extract
from sluice.llm.lexical_search import search
from sluice.llm.packing import pack_documents
from sluice.llm.periodic_runs import periodic_runs, runs_digest, strongest_run, with_planted_runs
from sluice.llm.quality import fit, held_out, score
from sluice.llm.sharding import shard_documents
from sluice.llm.simhash import hex_digits, near_duplicates
from sluice.llm.suffix_dedup import remove_repeats
from sluice.llm.token_counts import apply_edits, build_trees
from sluice.llm.warc import archive
from sluice.llm.window_packing import pack_windows

SQL: dict[str, str] = {}


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens, each ended by id 0."""
    import public_tokenizers

    out = pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 100-byte strings that start earlier."""
    return remove_repeats(read(spark, sf_dir, "documents")).drop("kept")


SQL["op2_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, s, substr(h, 2 * s + 1, 200) AS g
      FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 99, 0))) AS s FROM d)),
again AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS n FROM w) WHERE n > 1),
steps AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS step FROM again),
runs AS (SELECT doc_id, s, sum(step) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM steps),
spans AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM runs GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS a, a AS b FROM spans
  UNION ALL SELECT doc_id, max(b), CAST(NULL AS BIGINT) FROM spans GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * coalesce(b, length(h)) - 2 * a), '' ORDER BY a) AS k
         FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a) AS n, count(*) AS c FROM spans GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(c, 0) AS n_spans,
       sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of 4-word shingles, and the components of those at most 4 bits apart."""
    out = near_duplicates(read(spark, sf_dir, "documents"), max_bits=4, words=4, seed=42)
    return out.select("doc_id", hex_digits().alias("fingerprint"), "component_id")


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back through the merged capture index."""
    return archive(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op4_warc_index"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
     top AS (SELECT html, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY html)
SELECT p.page_id, p.n AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN top.top > p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top.top > p.page_id THEN top.top END AS refers_to
FROM p LEFT JOIN top ON p.html = top.html AND p.n >= 1000
"""


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of a label linked at a cosine of 0.98 or more, and their components."""
    return near_vectors(read(spark, sf_dir, "embeddings"), cosine=0.98)


SQL["op5_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.q > 0 AND b.q > 0 AND list_dot_product(a.e, b.e) / sqrt(a.q * b.q) >= 0.98),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT e.vec_id, CAST((SELECT count(*) FROM links WHERE a = e.vec_id) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id) c USING (vec_id)
"""


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 8 shards of equal counts, copies together."""
    return shard_documents(read(spark, sf_dir, "documents"), shards=8)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' words inside passages of 10 words that benchmark items hold."""
    out = find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10)
    return out.select("doc_id", "n_words", "n_hit", "n_items", items_digest().alias("items_sha256"), "contaminated")


SQL["op7_decontamination"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM words, sizes WHERE len(w) >= n)),
hits AS (SELECT g.doc_id, g.i, g.n, x.item_id FROM grams g JOIN windows x ON g.n = x.n AND g.phrase = x.phrase),
per_doc AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
per_item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN per_doc USING (doc_id) LEFT JOIN per_item USING (doc_id)
"""


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(read(spark, sf_dir, "pages"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after long numbers and addresses are hidden, the second by its edited tree."""
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    out = apply_edits(build_trees(read(spark, sf_dir, "documents"), ranks, pattern), ranks, pattern)
    return out.select("doc_id", "n_tokens_before", "n_tokens", "n_edits", "n_encoded")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by votes of labelled neighbours."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and what is left once each is cut down to one period."""
    found = periodic_runs(with_planted_runs(read(spark, sf_dir, "documents").select("doc_id", "text")), repeats=4, least=6)
    best = found.withColumn("_best", strongest_run("runs"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        runs_digest("runs").alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


SQL["op11_periodic_runs"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, CAST(doc_id AS VARCHAR) AS id FROM documents),
crc AS (
  SELECT doc_id, w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(id) + 1), lambda i: ascii(id[i])::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h FROM docs),
g AS (SELECT doc_id, w, len(w) AS n, h // 10 AS g, h % 10 = 0 AND len(w) > 0 AS made FROM crc),
a AS (SELECT *, CASE WHEN made THEN g % n END AS a FROM g),
texts AS (
  SELECT doc_id, n, CASE WHEN made THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w END AS w FROM a),
lags AS (SELECT doc_id, n, w, unnest(range(1, n // 4 + 1)) AS q FROM texts WHERE n >= 6),
probes AS (SELECT doc_id, n, w, q, list_filter(range(0, (n - 1) // q - 2), lambda j: w[1 + j * q] = w[1 + (j + 1) * q] AND w[1 + (j + 1) * q] = w[1 + (j + 2) * q] AND w[1 + (j + 2) * q] = w[1 + (j + 3) * q]) AS hits FROM lags),
places AS (SELECT doc_id, n, w, q, unnest(range(0, n - q)) AS i FROM probes WHERE len(hits) > 0),
same AS (SELECT doc_id, q, i FROM places WHERE w[1 + i] = w[1 + i + q]),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same),
stretches AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (
  SELECT doc_id, s, l, q FROM stretches x
  WHERE NOT EXISTS (SELECT 1 FROM stretches y WHERE y.doc_id = x.doc_id AND y.q < x.q AND y.s <= x.s AND y.s + y.l >= x.s + x.l)),
lines AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS text FROM runs GROUP BY doc_id),
best AS (SELECT doc_id, s, l, q FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY l::DOUBLE / q DESC, s, q) = 1),
dropped AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (
  SELECT t.doc_id, string_agg(t.word, ' ' ORDER BY t.i) AS text
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM texts) t LEFT JOIN dropped d ON d.doc_id = t.doc_id AND d.i = t.i
  WHERE d.i IS NULL GROUP BY t.doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, l AS length, q AS period, (1000 * l) // q AS exponent_milli,
       sha256(coalesce(lines.text, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM texts t LEFT JOIN lines USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def op12_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 1024 tokens, by best-fit decreasing."""
    import public_tokenizers

    out = pack_windows(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), window=1024)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best documents for every benchmark item."""
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), limit=10)


SQL["op13_lexical_search"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
sizes AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0),
total AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nl FROM sizes),
lengths AS (SELECT doc_id, 10 + (90 * n * nd) // nl AS m FROM sizes, total),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
vocab AS (SELECT DISTINCT term FROM items),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) JOIN vocab USING (term) GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), total),
scores AS (
  SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM items JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked WHERE r <= 10
"""


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_warc_index": op4_warc_index,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_sharding": op6_sharding,
    "op7_decontamination": op7_decontamination,
    "op8_html_extraction": op8_html_extraction,
    "op9_token_counts": op9_token_counts,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_window_packing": op12_window_packing,
    "op13_lexical_search": op13_lexical_search,
}
