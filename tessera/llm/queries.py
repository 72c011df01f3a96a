"""Registered queries of the training-data operators and their SQL.

Each runs its operator with production parameters over whole tables.  A query
whose result SQL cannot express (hashes, tokenizers, trained models) has no SQL;
``tests/llm`` holds it against a brute-force version.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import functions as F

from tessera.session import ship_package, table

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine (the same on workers)."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op2_simhash")
def op2_simhash(spark, sf_dir):
    from tessera.llm.op02_simhash import hex_fingerprint, simhash_components
    out = simhash_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", hex_fingerprint("fp").alias("fingerprint"), "component_id")


@query("op7_packing")
def op7_packing(spark, sf_dir):
    from tessera.llm.op07_packing import pack
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), with_ids=False)


@query("op5_bpe")
def op5_bpe(spark, sf_dir):
    from tessera.llm.op05_bpe import encode_decode
    out = encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), ids_as_text=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


_LINKED_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
         ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings
          UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
low AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT low.x AS vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, low.x = component_id AS kept
FROM low LEFT JOIN n ON n.x = low.x
"""


@query("op1_grid_join", _LINKED_VECTORS)
def op1_grid_join(spark, sf_dir):
    from tessera.llm.op01_grid_join import near_duplicates
    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op4_quality")
def op4_quality(spark, sf_dir):
    from tessera.llm.op04_quality import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    from tessera.llm.op09_toxicity import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_rules")
def op3_rules(spark, sf_dir):
    from tessera.llm.op03_rules import judge
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# a window is the shortest run of lines from a line on with 50 words; ``last`` its last line
_LINES = """
WITH s AS (
  SELECT doc_id, i, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)),
l AS (SELECT *, row_number() OVER w AS k, sum(words) OVER w - words AS before,
             sum(words) OVER (PARTITION BY doc_id) AS total
      FROM s WHERE words > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
win AS (SELECT doc_id, k, before, max(k) OVER w AS last, string_agg(line, chr(10)) OVER w AS passage, total - before >= 50 AS whole
        FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)),
first AS (SELECT *, first_value(doc_id) OVER p AS f_doc, first_value(k) OVER p AS f_k FROM win WHERE whole
          WINDOW p AS (PARTITION BY passage ORDER BY doc_id, k)),
hit AS (SELECT * FROM first WHERE f_doc <> doc_id OR f_k <> k),
step AS (SELECT hit.doc_id, hit.k, hit.last, a.k AS t, a.line = b.line AS alike,
                a.before + a.words - (l0.before + l0.words) AS words_on
         FROM hit JOIN l l0 ON l0.doc_id = hit.doc_id AND l0.k = hit.k
         JOIN l a ON a.doc_id = hit.doc_id AND a.k >= hit.k
         LEFT JOIN l b ON b.doc_id = hit.f_doc AND b.k = a.k - hit.k + hit.f_k
         WHERE a.k <= hit.last OR a.before + a.words - (l0.before + l0.words) < 50),
reach AS (SELECT *, coalesce(min(CASE WHEN NOT coalesce(alike, false) THEN t END) OVER (PARTITION BY doc_id, k), 1000000000) AS stop
          FROM step),
gone AS (SELECT DISTINCT reach.doc_id, l.i FROM reach JOIN l ON l.doc_id = reach.doc_id AND l.k = reach.t WHERE reach.t < reach.stop),
left_over AS (SELECT s.doc_id, string_agg(s.line, chr(10) ORDER BY s.i) AS text
              FROM s LEFT JOIN gone ON gone.doc_id = s.doc_id AND gone.i = s.i
              WHERE gone.i IS NULL GROUP BY s.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(o.text, '') END AS text
FROM documents d LEFT JOIN left_over o ON o.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


@query("op10_lines", _LINES)
def op10_lines(spark, sf_dir):
    from tessera.llm.op10_lines import dedup_lines
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_removed", "text")


@query("op6_html")
def op6_html(spark, sf_dir):
    from tessera.llm.op06_html import extract
    return extract(table(spark, sf_dir, "pages"))


@query("op8_token_counts")
def op8_token_counts(spark, sf_dir):
    from tessera.llm.op08_token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), 50256)


@query("op12_spelling")
def op12_spelling(spark, sf_dir):
    from tessera.llm.op12_spelling import variants
    return variants(table(spark, sf_dir, "documents"))


_RANKED = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
tf AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf
       FROM (SELECT doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
s AS (
  SELECT q.item_id, tf.doc_id,
         sum(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
             * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN tf ON tf.term = q.term JOIN df ON df.term = q.term, total GROUP BY q.item_id, tf.doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""


@query("op13_ranked_search", _RANKED)
def op13_ranked_search(spark, sf_dir):
    from tessera.llm.op13_ranked_search import search
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_spotsigs")
def op11_spotsigs(spark, sf_dir):
    from tessera.llm.op11_spotsigs import fingerprints
    return fingerprints(table(spark, sf_dir, "documents"))
