"""Registered text queries (C*, X11) over ``documents`` and ``benchmark``,
with DuckDB oracle SQL.

Dictionaries come from the data: ``benchmark`` items are the keyword
entries (documents quote them), their sentences are the class phrases,
their words are the spelling vocabulary.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import strings as S
from tessera.operators import text as TX
from tessera.plans.registry import query
from tessera.session import cut_lineage, table

ALNUM = r"[\p{L}\p{N}]+"
ALNUM_SQL = "[\\p{L}\\p{N}]+"
STOP_SQL = ", ".join(f"'{w}'" for w in S.DEFAULT_STOP_WORDS)
N_CLASSES = 5
# Blend weights of the two scoring tasks, as the source sets them.
WEIGHTS = {"category": (0.362, 0.594), "feedback": (0.00038, 0.019)}


def alnum_tokens(col: str):
    return F.regexp_extract_all(F.lower(F.col(col)), F.lit(ALNUM), F.lit(0))


def keyword_dictionary(spark, sf):
    """(item_id, keywords array) — benchmark text as comma-separated keyword text."""
    b = table(spark, sf, "benchmark")
    return b.select("item_id", S.split_keywords("text", ",").alias("kw"))


_KW_SQL = """
kwd AS (SELECT item_id, flatten(list_transform(
          string_split(regexp_replace(lower(text), ', +', ',', 'g'), ','),
          lambda x: list_filter(string_split_regex(trim(x), '\\s+'), lambda w: w <> ''))) AS kw
        FROM benchmark)"""


def class_phrases(spark, sf):
    """(cls, phrase, pword) words of every benchmark sentence, class =
    item % 5; and (cls, n) phrases per class."""
    b = table(spark, sf, "benchmark")
    s = b.select("item_id", F.posexplode(F.split("text", r"\.", -1)).alias("si", "s"))
    w = s.select((F.col("item_id") % N_CLASSES).alias("cls"),
                 F.concat_ws("-", F.col("item_id"), F.col("si") + 1).alias("phrase"),
                 F.explode(F.regexp_extract_all(F.lower("s"), F.lit(ALNUM), F.lit(0))).alias("pword"))
    n = w.select("cls", "phrase").distinct().groupBy("cls").agg(F.count(F.lit(1)).alias("n"))
    return w, n


_PHRASES_SQL = f"""
sent AS (SELECT item_id, si, string_split(text, '.')[si] AS s
         FROM (SELECT item_id, text, unnest(range(1, len(string_split(text, '.')) + 1)) AS si
               FROM benchmark)),
pw0 AS (SELECT item_id % {N_CLASSES} AS cls, item_id || '-' || si AS phrase,
               unnest(regexp_extract_all(lower(s), '{ALNUM_SQL}')) AS pword FROM sent),
np AS (SELECT cls, count(*) AS n FROM (SELECT DISTINCT cls, phrase FROM pw0) GROUP BY cls)"""


def _bigrams_sql(col: str) -> str:
    return (f"list_distinct(list_filter(list_transform(range(1, greatest(length({col}), 2)), "
            f"lambda i: substr({col}, i, 2)), lambda g: length(g) = 2))")


@query("C01_C02_classify_text", sql=f"""
WITH {_KW_SQL.strip()},
d AS (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS tok FROM documents),
dt AS (SELECT doc_id, tok, count(*) AS c FROM d GROUP BY ALL),
dn AS (SELECT doc_id, sqrt(sum(c * c)) AS nrm FROM dt GROUP BY doc_id),
k AS (SELECT item_id AS label, unnest(kw) AS tok FROM kwd),
kt AS (SELECT label, tok, count(*) AS c FROM k GROUP BY ALL),
kn AS (SELECT label, sqrt(sum(c * c)) AS nrm FROM kt GROUP BY label),
dot AS (SELECT dt.doc_id, kt.label, sum(dt.c * kt.c) AS dp FROM dt JOIN kt USING (tok) GROUP BY ALL),
sc AS (SELECT dot.doc_id, dot.label, dp / (dn.nrm * kn.nrm) AS score FROM dot JOIN dn USING (doc_id) JOIN kn USING (label)),
best AS (SELECT doc_id, label, score FROM (
           SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rn FROM sc) WHERE rn = 1)
SELECT documents.doc_id, coalesce(best.label, (SELECT min(item_id) FROM benchmark)) AS label,
       round(coalesce(best.score, 0) * 100, 2) AS score
FROM documents LEFT JOIN best USING (doc_id)""")
def c01_c02(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return TX.classify_text(d, "doc_id", "text", keyword_dictionary(spark, sf), "item_id", "kw")


@query("C03_match_part", sql="""
WITH pd AS (SELECT p_name, min(p_partkey) AS part_number, string_split(lower(p_name), ' ') AS kw FROM part GROUP BY p_name),
d AS (SELECT conv_id, turn, unnest(string_split(lower(text), ' ')) AS tok FROM conversations),
dt AS (SELECT conv_id, turn, tok, count(*) AS c FROM d GROUP BY ALL),
dn AS (SELECT conv_id, turn, sqrt(sum(c * c)) AS nrm FROM dt GROUP BY ALL),
k AS (SELECT p_name AS label, unnest(kw) AS tok FROM pd),
kt AS (SELECT label, tok, count(*) AS c FROM k GROUP BY ALL),
kn AS (SELECT label, sqrt(sum(c * c)) AS nrm FROM kt GROUP BY label),
dot AS (SELECT conv_id, turn, label, sum(dt.c * kt.c) AS dp FROM dt JOIN kt USING (tok) GROUP BY ALL),
sc AS (SELECT conv_id, turn, label, dp / (dn.nrm * kn.nrm) AS score FROM dot JOIN dn USING (conv_id, turn)
       JOIN kn USING (label)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, label) AS rn
                        FROM sc) WHERE rn = 1),
c AS (SELECT conv_id, turn, conv_id || '-' || turn AS msg_id FROM conversations)
SELECT msg_id, coalesce(best.label, (SELECT min(p_name) FROM part)) AS part_name,
       round(coalesce(best.score, 0) * 100, 2) AS part_score, pd.part_number
FROM c LEFT JOIN best USING (conv_id, turn)
     LEFT JOIN pd ON pd.p_name = coalesce(best.label, (SELECT min(p_name) FROM part))""")
def c03(spark, sf):
    c = table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("msg_id"), "text")
    return TX.match_part(c, "msg_id", "text", table(spark, sf, "part"), "p_name", "p_partkey") \
        .select("msg_id", "part_name", "part_score", "part_number")


def doc_words(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(F.explode(alnum_tokens("text")).alias("w")).filter(F.length("w") > 2).distinct()


def vocabulary(spark, sf):
    b = table(spark, sf, "benchmark")
    return b.select(F.explode(alnum_tokens("text")).alias("v")).distinct()


@query("C05_T02_correct_words", sql=f"""
WITH w AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_extract_all(lower(text), '{ALNUM_SQL}')) AS w FROM documents)
           WHERE length(w) > 2),
voc AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{ALNUM_SQL}')) AS v FROM benchmark),
kw AS (SELECT DISTINCT v FROM (SELECT unnest(regexp_extract_all(lower(text), '{ALNUM_SQL}')) AS v FROM benchmark)
        WHERE length(v) > 2 AND v NOT IN ({STOP_SQL})),
unk AS (SELECT w FROM w WHERE w NOT IN (SELECT v FROM voc)),
gw AS MATERIALIZED (SELECT w, substr(w, 1, 1) AS letter, {_bigrams_sql('w')} AS g FROM unk),
gv AS MATERIALIZED (SELECT v, substr(v, 1, 1) AS letter, {_bigrams_sql('v')} AS g FROM voc),
bw AS MATERIALIZED (SELECT w, letter, unnest(g) AS bg, len(g) AS nb FROM gw),
bv AS MATERIALIZED (SELECT v, letter, unnest(g) AS bg, len(g) AS nb FROM gv),
shared AS (SELECT w, v, 1 - count(*) / (any_value(bw.nb) + any_value(bv.nb) - count(*)) AS dist
           FROM bw JOIN bv USING (letter, bg) GROUP BY w, v),
heads AS (SELECT v, substr(v, 1, 1) AS letter FROM voc
          QUALIFY row_number() OVER (PARTITION BY substr(v, 1, 1) ORDER BY v) <= 10),
fill AS (SELECT w, heads.v, 1.0 AS dist FROM unk JOIN heads ON letter = substr(w, 1, 1)
         LEFT JOIN shared USING (w, v) WHERE shared.dist IS NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY dist, v) AS rn
      FROM (SELECT * FROM shared UNION ALL SELECT * FROM fill)),
best AS (SELECT w, arg_min(r.v, rn) AS corr FROM r JOIN kw USING (v) WHERE rn <= 10 GROUP BY w)
SELECT w.w AS word, coalesce(best.corr, w.w) AS corrected FROM w LEFT JOIN best USING (w)""")
def c05(spark, sf):
    voc = vocabulary(spark, sf)
    # keywords: the dictionary's countable words (longer than 2, not stop
    # words), a subset of the vocabulary
    kw = vocabulary(spark, sf).filter((F.length("v") > 2) & ~F.col("v").isin(S.DEFAULT_STOP_WORDS))
    return TX.correct_words_postings(doc_words(spark, sf), "w", voc.withColumn("vp", F.col("v")), "v", "vp",
                                     kw, "v").withColumnRenamed("w", "word")


_PHRASE_SCORE_SQL = f"""
{_PHRASES_SQL.strip()},
toks AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '{ALNUM_SQL}')) AS token FROM documents),
dt AS (SELECT * FROM toks WHERE length(token) > 2 AND token NOT IN ({STOP_SQL})),
pw AS (SELECT * FROM pw0 WHERE length(pword) > 2 AND pword NOT IN ({STOP_SQL})),
nw AS (SELECT cls, phrase, count(*) AS nw FROM pw GROUP BY ALL),
bt AS (SELECT token, unnest({_bigrams_sql('token')}) AS bg, len({_bigrams_sql('token')}) AS nb
       FROM (SELECT DISTINCT token FROM dt)),
bp AS (SELECT pword, unnest({_bigrams_sql('pword')}) AS bg, len({_bigrams_sql('pword')}) AS nb
       FROM (SELECT DISTINCT pword FROM pw)),
sim0 AS (SELECT token, pword, count(*) / (bt.nb + bp.nb - count(*)) AS sim FROM bt JOIN bp USING (bg)
         GROUP BY token, pword, bt.nb, bp.nb),
sim AS (SELECT * FROM sim0 WHERE sim >= 0.35),
bestw AS (SELECT doc_id, pword, max(sim) AS m FROM dt JOIN sim USING (token) GROUP BY ALL),
ph AS (SELECT doc_id, cls, phrase, sum(m) AS s FROM bestw JOIN pw USING (pword) GROUP BY ALL),
ps AS (SELECT doc_id, cls, phrase, s / nw AS ps FROM ph JOIN nw USING (cls, phrase)),
agg AS (SELECT doc_id, cls, max(ps) AS mx, sum(ps) AS sm FROM ps GROUP BY ALL),
phs AS (SELECT doc_id, cls, mx AS max_score, sm / n AS mean_score FROM agg JOIN np USING (cls))"""


def phrase_scores(spark, sf, docs=None):
    d = table(spark, sf, "documents") if docs is None else docs
    toks = TX.token_sets(d, "doc_id", "text").withColumnRenamed("tokens", "token")
    pw, n = class_phrases(spark, sf)
    return TX.phrase_scores(toks, "doc_id", "token", pw, "cls", "phrase", "pword", n, n_rows=d.count())


@query("C04_phrase_scores", sql=f"""
WITH {_PHRASE_SCORE_SQL.strip()}
SELECT doc_id, cls, round(max_score, 6) AS max_score, round(mean_score, 6) AS mean_score FROM phs""")
def c04(spark, sf):
    return phrase_scores(spark, sf).select("doc_id", "cls", F.round("max_score", 6).alias("max_score"),
                                           F.round("mean_score", 6).alias("mean_score"))


@query("C06_T04_top_keywords", sql=f"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{ALNUM_SQL}')) AS w FROM documents),
tc AS (SELECT doc_id, w, count(*) AS tf FROM t WHERE length(w) >= 3 AND w NOT IN ({STOP_SQL}) GROUP BY ALL),
df AS (SELECT w, count(*) AS df FROM tc GROUP BY w),
n AS (SELECT count(*) AS n FROM documents),
sc AS (SELECT doc_id, w, tf * ln(n / df) AS tfidf FROM tc JOIN df USING (w), n),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, w) AS rn FROM sc)
SELECT doc_id, string_agg(w, ', ' ORDER BY rn) AS keywords FROM r WHERE rn <= 20 GROUP BY doc_id""")
def c06(spark, sf):
    d = table(spark, sf, "documents")
    return TX.top_keywords(d, "doc_id", alnum_tokens("text"), k=20)


_EMBED_SQL = """
ex AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS pos
       FROM embeddings),
cen AS (SELECT label, pos, avg(x) AS cv FROM ex GROUP BY ALL),
vn AS (SELECT vec_id, sqrt(sum(x * x)) AS vn FROM ex GROUP BY vec_id),
cn AS (SELECT label, sqrt(sum(cv * cv)) AS cn FROM cen GROUP BY label),
dot AS (SELECT ex.vec_id, cen.label, sum(x * cv) AS dp FROM ex JOIN cen USING (pos) GROUP BY ALL),
cs AS (SELECT dot.vec_id, dot.label, dp / (vn * cn) AS cos FROM dot JOIN vn USING (vec_id) JOIN cn USING (label))"""


@query("C08_T03_embed_cosine", sql=f"""
WITH {_EMBED_SQL.strip()},
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cos DESC, label) AS rn FROM cs) WHERE rn = 1)
SELECT e.vec_id, e.label, b.label AS predicted, round(b.cos, 6) AS cos FROM embeddings e JOIN b USING (vec_id)""")
def c08(spark, sf):
    e = table(spark, sf, "embeddings")
    cen = TX.label_centroids(e, "embedding", "label")
    cs = TX.embed_cosine(e, "vec_id", "embedding", cen, "label")
    best = cs.groupBy("vec_id").agg(F.min_by(F.struct(F.col("label").alias("p"), F.col("cos").alias("c")),
                                             F.struct(-F.col("cos"), F.col("label"))).alias("b"))
    return e.select("vec_id", "label").join(best, "vec_id") \
        .select("vec_id", "label", F.col("b.p").alias("predicted"), F.round("b.c", 6).alias("cos"))


def bow_class_scores(spark, sf, n_classes=N_CLASSES, docs=None):
    """Per (doc, class): best bag-of-words cosine to the class's benchmark items."""
    d = (table(spark, sf, "documents") if docs is None else docs).select("doc_id", "text")
    sc = TX.bow_cosine(d, "doc_id", "text", keyword_dictionary(spark, sf), "item_id", "kw")
    return sc.groupBy("doc_id", (F.col("item_id") % n_classes).alias("cls")).agg(F.max("score").alias("bow"))


_BOW_CLASS_SQL = f"""
{_KW_SQL.strip()},
d AS (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS tok FROM documents),
dtk AS (SELECT doc_id, tok, count(*) AS c FROM d GROUP BY ALL),
dn AS (SELECT doc_id, sqrt(sum(c * c)) AS nrm FROM dtk GROUP BY doc_id),
k AS (SELECT item_id AS label, unnest(kw) AS tok FROM kwd),
kt AS (SELECT label, tok, count(*) AS c FROM k GROUP BY ALL),
kn AS (SELECT label, sqrt(sum(c * c)) AS nrm FROM kt GROUP BY label),
dot AS (SELECT dtk.doc_id, kt.label, sum(dtk.c * kt.c) AS dp FROM dtk JOIN kt USING (tok) GROUP BY ALL),
sc AS (SELECT dot.doc_id, dot.label, dp / (dn.nrm * kn.nrm) AS score FROM dot JOIN dn USING (doc_id) JOIN kn USING (label)),
bowc AS (SELECT doc_id, label % {N_CLASSES} AS cls, max(score) AS bow FROM sc GROUP BY ALL)"""


def class_scores(spark, sf, docs=None):
    """Phrase and bag-of-words scores per (doc, class), of ``docs`` if given; every task blends these two."""
    return phrase_scores(spark, sf, docs), bow_class_scores(spark, sf, docs=docs)


def blended(spark, sf, task="category", docs=None, scores=None):
    w1, w2 = WEIGHTS[task]
    ps, bow = scores or class_scores(spark, sf)
    classes = spark.range(N_CLASSES).select(F.col("id").cast("int").alias("cls"), F.col("id").alias("pos"))
    d = table(spark, sf, "documents")
    allowed = None
    if task == "category":
        # documents in English may only take classes 0-2 (a per-row mask)
        allowed = d.filter(F.col("lang") == "en").select("doc_id", F.explode(F.array(
            F.lit(0), F.lit(1), F.lit(2))).alias("cls"))
    pred = TX.blend_predict(ps.withColumn("cls", F.col("cls").cast("int")), bow.withColumn("cls", F.col("cls").cast("int")),
                            "doc_id", "cls", "max_score", "bow", w1, w2, classes, "pos", allowed)
    base = (docs if docs is not None else d).select("doc_id")
    return base.join(pred, "doc_id", "left").select(
        "doc_id", F.coalesce(F.col("label"), F.lit(0)).alias("label"),
        F.round(F.coalesce(F.col("score"), F.lit(0.0)), 6).alias("score"))


def _blend_sql(task: str, docs_sql: str = "SELECT doc_id, lang FROM documents") -> str:
    w1, w2 = WEIGHTS[task]
    mask = ("CASE WHEN dd.lang = 'en' AND j.cls > 2 THEN 0.0 ELSE v END" if task == "category" else "v")
    return f"""
{_PHRASE_SCORE_SQL.strip()},
{_BOW_CLASS_SQL.strip()},
j AS (SELECT coalesce(p.doc_id, b.doc_id) AS doc_id, coalesce(p.cls, b.cls) AS cls,
             coalesce(p.max_score, 0.0) / {w1} + coalesce(b.bow, 0.0) / {w2} AS v
      FROM phs p FULL OUTER JOIN bowc b ON p.doc_id = b.doc_id AND p.cls = b.cls),
dd AS ({docs_sql}),
sc0 AS (SELECT j.doc_id, j.cls, {mask} AS v FROM j JOIN documents dd USING (doc_id)),
every AS (SELECT doc_id, cls FROM (SELECT DISTINCT doc_id FROM sc0), range({N_CLASSES}) g(cls)),
c AS (SELECT doc_id, cls, coalesce(v, 0.0) AS v FROM every LEFT JOIN sc0 USING (doc_id, cls)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY v DESC, cls) AS rn FROM c) WHERE rn = 1),
pred AS (SELECT dd.doc_id, coalesce(best.cls, 0) AS label, round(coalesce(best.v, 0.0), 6) AS score
         FROM dd LEFT JOIN best USING (doc_id))"""


@query("C07_M05_blend_predict", sql=f"""
WITH {_blend_sql('category').strip()}
SELECT doc_id, CAST(label AS INTEGER) AS label, score FROM pred""")
def c07(spark, sf):
    return blended(spark, sf, "category")


# F10 gate and C09 two-task scores on derived post columns
_GATED_SQL = """
gated AS (SELECT doc_id FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 4 <> 0 AND doc_id % 5 <> 1 AND doc_id % 7 - 3 < 0)"""


def _task_sql(task: str, p: str) -> str:
    w1, w2 = WEIGHTS[task]
    mask = "CASE WHEN lang = 'en' AND cls > 2 THEN 0.0 ELSE v END" if task == "category" else "v"
    return f"""{p}_v AS (SELECT doc_id, cls, {mask} AS v FROM (
  SELECT coalesce(p.doc_id, b.doc_id) AS doc_id, coalesce(p.cls, b.cls) AS cls,
         coalesce(p.max_score, 0.0) / {w1} + coalesce(b.bow, 0.0) / {w2} AS v
  FROM phs p FULL OUTER JOIN bowc b ON p.doc_id = b.doc_id AND p.cls = b.cls) JOIN documents USING (doc_id)),
{p}_every AS (SELECT doc_id, cls FROM (SELECT DISTINCT doc_id FROM {p}_v), range({N_CLASSES}) g(cls)),
{p}_all AS (SELECT doc_id, cls, coalesce(v, 0.0) AS v FROM {p}_every LEFT JOIN {p}_v USING (doc_id, cls)),
{p}_best AS (SELECT doc_id, cls, v FROM {p}_all QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY v DESC, cls) = 1)"""


@query("C09_F10_gated_tasks", sql=f"""
WITH {_PHRASE_SCORE_SQL.strip()},
{_BOW_CLASS_SQL.strip()},
{_GATED_SQL.strip()},
{_task_sql("category", "c")},
{_task_sql("feedback", "f")}
SELECT documents.doc_id,
       CASE WHEN g.doc_id IS NOT NULL THEN CAST(coalesce(c_best.cls, 0) AS INTEGER) END AS category_label,
       CASE WHEN g.doc_id IS NOT NULL THEN round(coalesce(c_best.v, 0.0), 6) END AS category_score,
       CASE WHEN g.doc_id IS NOT NULL THEN CAST(coalesce(f_best.cls, 0) AS INTEGER) END AS feedback_label,
       CASE WHEN g.doc_id IS NOT NULL THEN round(coalesce(f_best.v, 0.0), 6) END AS feedback_score
FROM documents LEFT JOIN gated g USING (doc_id) LEFT JOIN c_best USING (doc_id) LEFT JOIN f_best USING (doc_id)""")
def c09_f10(spark, sf):
    """Both scoring tasks for the posts that pass the gate (a model, a part, the
    flag, negative sentiment); the others keep null predictions."""
    from tessera.operators import filters as FL
    i, text = F.col("doc_id"), F.lit(None).cast("string")
    d = table(spark, sf, "documents").withColumns({
        "model_name": F.when(i % 3 == 0, text).otherwise("m"), "part_name": F.when(i % 4 == 0, text).otherwise("p"),
        "flag": F.when(i % 5 == 1, False).otherwise(True), "sentiment": (i % 7 - 3).cast("int")})
    gated = d.filter(FL.score_gate("model_name", "part_name", "flag", "sentiment"))
    out = d.select("doc_id")
    # only posts that pass are scored, once for both tasks
    scores = [cut_lineage(s) for s in class_scores(spark, sf, gated)]
    for task in ("category", "feedback"):
        out = out.join(blended(spark, sf, task, gated, scores).select(
            "doc_id", F.col("label").alias(f"{task}_label"), F.col("score").alias(f"{task}_score")), "doc_id", "left")
    return out


# ------------------------------------------------------------------ X11 terms

def term_dictionary(spark, sf):
    """Model terms: first word and first two words of each benchmark item
    (lower-case); canonical name per item; category only for items not
    divisible by 4 (so some lookups miss)."""
    b = table(spark, sf, "benchmark").select("item_id", alnum_tokens("text").alias("t"))
    one = b.select(F.element_at("t", 1).alias("term"), "item_id")
    two = b.select(F.array_join(F.slice("t", 1, 2), " ").alias("term"), "item_id")
    terms = one.unionByName(two).filter(F.col("term").isNotNull() & (F.col("term") != "")) \
        .groupBy("term").agg(F.min("item_id").alias("tpos"))
    canon = terms.select("term", F.concat(F.lit("MODEL-"), F.col("tpos").cast("string")).alias("model_name"))
    cat = b.filter(F.col("item_id") % 4 != 0).select(
        F.concat(F.lit("MODEL-"), F.col("item_id").cast("string")).alias("model_name"),
        F.concat(F.lit("CAT-"), (F.col("item_id") % 3).cast("string")).alias("vehicle_category"))
    return terms, canon, cat


@query("X11_extract_term", sql=f"""
WITH b AS (SELECT item_id, regexp_extract_all(lower(text), '{ALNUM_SQL}') AS t FROM benchmark),
terms0 AS (SELECT t[1] AS term, item_id FROM b UNION ALL SELECT array_to_string(t[1:2], ' '), item_id FROM b),
terms AS (SELECT term, min(item_id) AS tpos FROM terms0 WHERE term IS NOT NULL AND term <> '' GROUP BY term),
cat AS (SELECT 'MODEL-' || CAST(item_id AS VARCHAR) AS model_name, 'CAT-' || CAST(item_id % 3 AS VARCHAR) AS vehicle_category
        FROM benchmark WHERE item_id % 4 <> 0),
dtok AS (SELECT doc_id, regexp_extract_all(lower(text), '{ALNUM_SQL}') AS t FROM documents),
g AS (SELECT doc_id, s AS start, array_to_string(t[s + 1: s + n], ' ') AS gram, n
      FROM dtok, (VALUES (1), (2), (3)) nn(n), LATERAL (SELECT unnest(range(0, len(t) - n + 1)) AS s)),
m AS (SELECT doc_id, term, start, tpos FROM g JOIN terms ON g.gram = terms.term),
first AS (SELECT doc_id, arg_min(term, (start, -length(term), tpos)) AS term FROM m GROUP BY doc_id),
res AS (SELECT doc_id, term, 'MODEL-' || CAST(tpos AS VARCHAR) AS model_name FROM first JOIN terms USING (term))
SELECT doc_id, CASE WHEN vehicle_category IS NULL THEN NULL ELSE res.model_name END AS model_name, vehicle_category
FROM res LEFT JOIN cat USING (model_name)""")
def x11(spark, sf):
    terms, canon, cat = term_dictionary(spark, sf)
    d = table(spark, sf, "documents")
    found = TX.extract_term(d, "doc_id", alnum_tokens("text"), terms, "term", "tpos")
    res = found.join(canon, "term").join(cat, "model_name", "left")
    return res.select("doc_id",
                      F.when(F.col("vehicle_category").isNull(), F.lit(None).cast("string"))
                      .otherwise(F.col("model_name")).alias("model_name"), "vehicle_category")


# ------------------------------------------------------------------ SQL twins as CTE builders
# (used by the text marts: each returns CTE text ending in a relation
# ``{p}_best(<keys>, label, score)``)

def classify_ctes(p: str, docs: str, keys: list[str], text: str, dict_rel: str, label: str = "label") -> str:
    """Bag-of-words classification of ``docs`` (a relation with ``keys`` and
    ``text``) against ``dict_rel(label, kw list)``; ties -> smallest label,
    no overlap -> smallest label with 0."""
    k = ", ".join(keys)
    on = " AND ".join(f"d.{c} = b.{c}" for c in keys)
    return f"""
{p}_d AS (SELECT {k}, unnest(string_split(lower({text}), ' ')) AS tok FROM {docs}),
{p}_dt AS (SELECT {k}, tok, count(*) AS c FROM {p}_d GROUP BY ALL),
{p}_dn AS (SELECT {k}, sqrt(sum(c * c)) AS nrm FROM {p}_dt GROUP BY ALL),
{p}_k AS (SELECT {label} AS label, unnest(kw) AS tok FROM {dict_rel}),
{p}_kt AS (SELECT label, tok, count(*) AS c FROM {p}_k GROUP BY ALL),
{p}_kn AS (SELECT label, sqrt(sum(c * c)) AS nrm FROM {p}_kt GROUP BY label),
{p}_dot AS (SELECT {", ".join("dt." + c for c in keys)}, kt.label, sum(dt.c * kt.c) AS dp
            FROM {p}_dt dt JOIN {p}_kt kt USING (tok) GROUP BY ALL),
{p}_sc AS (SELECT {", ".join("x." + c for c in keys)}, x.label, dp / (dn.nrm * kn.nrm) AS score
           FROM {p}_dot x JOIN {p}_dn dn USING ({k}) JOIN {p}_kn kn USING (label)),
{p}_b1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY score DESC, label) AS rn
                          FROM {p}_sc) WHERE rn = 1),
{p}_best AS (SELECT {", ".join("d." + c for c in keys)}, coalesce(b.label, (SELECT min({label}) FROM {dict_rel})) AS label,
                    round(coalesce(b.score, 0) * 100, 2) AS score
             FROM {docs} d LEFT JOIN {p}_b1 b ON {on})"""


PART_DICT_SQL = """
pd AS (SELECT p_name AS label, min(p_partkey) AS part_number, string_split(lower(p_name), ' ') AS kw
       FROM part GROUP BY p_name)"""

KEYWORD_DICT_SQL = _KW_SQL.strip()


# ------------------------------------------------------------------ C08 encoder hook

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _encoded_sql(name: str, rel: str, key: str, dim: int = 64) -> str:
    return f"""{name}_w AS (SELECT {key}, unnest(regexp_extract_all({_LOWER}, '[a-z0-9]+')) AS w FROM {rel}),
{name}_c AS (SELECT {key}, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {dim} AS k, count(*) AS n FROM {name}_w GROUP BY ALL),
{name}_n AS (SELECT {key}, sqrt(sum(n * n)) AS len FROM {name}_c GROUP BY ALL)"""


@query("C08_encoder_hook", sql=f"""
WITH {_encoded_sql("t", "conversations", "conv_id, turn")},
{_encoded_sql("l", "benchmark", "item_id")},
dot AS (SELECT conv_id, turn, item_id, sum(t_c.n * l_c.n) AS d FROM t_c JOIN l_c USING (k) GROUP BY ALL),
cs AS (SELECT conv_id, turn, item_id, round(d / (t_n.len * l_n.len), 9) AS cos FROM dot JOIN t_n USING (conv_id, turn) JOIN l_n USING (item_id))
SELECT conv_id, turn, item_id, round(cos, 6) AS cos FROM cs
QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY cos DESC, item_id) = 1""")
def c08_encoder(spark, sf):
    """Messages and label texts encoded by a registered encoder; the label of the largest cosine."""
    from tessera.operators.encoders import encode
    m = encode(table(spark, sf, "conversations").select("conv_id", "turn", "text"), "text")
    m = m.select(F.struct("conv_id", "turn").alias("m"), "vector")
    labels = encode(table(spark, sf, "benchmark").select("item_id", "text"), "text").select("item_id", F.col("vector").alias("centroid"))
    cs = TX.embed_cosine(m, "m", "vector", labels, "item_id").withColumn("cos", F.round("cos", 9)).filter("cos > 0")
    best = cs.groupBy("m").agg(F.min_by(F.struct("item_id", "cos"), F.struct(-F.col("cos"), F.col("item_id"))).alias("b"))
    return best.select("m.conv_id", "m.turn", "b.item_id", F.round("b.cos", 6).alias("cos"))


# ------------------------------------------------------------------ C04 with word vectors

@query("C04_vector_phrases", sql=f"""
WITH {_PHRASES_SQL.strip()},
e AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS place, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings WHERE embedding IS NOT NULL),
size AS (SELECT count(*) AS n FROM e),
toks AS (SELECT DISTINCT conv_id, turn, unnest(regexp_extract_all(lower(text), '{ALNUM_SQL}')) AS w FROM conversations),
tok AS (SELECT *, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % (SELECT n FROM size) AS place FROM toks WHERE length(w) > 2 AND w NOT IN ({STOP_SQL})),
pw AS (SELECT *, CAST('0x' || substr(md5(pword), 1, 8) AS BIGINT) % (SELECT n FROM size) AS place FROM pw0
       WHERE length(pword) > 2 AND pword NOT IN ({STOP_SQL})),
nw AS (SELECT cls, phrase, count(*) AS nw FROM pw GROUP BY ALL),
sim AS (SELECT a.place AS ta, b.place AS pa, list_cosine_similarity(a.x, b.x) AS sim
        FROM e a JOIN (SELECT DISTINCT place FROM tok) USING (place), e b JOIN (SELECT DISTINCT place FROM pw) p ON p.place = b.place),
best AS (SELECT conv_id, turn, pw_at.place, max(sim) AS m FROM tok JOIN sim ON sim.ta = tok.place JOIN (SELECT DISTINCT place FROM pw) pw_at ON pw_at.place = sim.pa
         WHERE sim >= 0.35 GROUP BY ALL),
ph AS (SELECT conv_id, turn, cls, phrase, sum(m) AS s FROM best JOIN pw USING (place) GROUP BY ALL),
agg AS (SELECT conv_id, turn, cls, max(s / nw) AS mx, sum(s / nw) AS sm FROM ph JOIN nw USING (cls, phrase) GROUP BY ALL)
SELECT conv_id, turn, cls, round(mx, 6) AS max_score, round(sm / n, 6) AS mean_score FROM agg JOIN np USING (cls)""")
def c04_vectors(spark, sf):
    """Phrase scores of messages by word vectors: a word's vector is the row of
    ``embeddings`` that its MD5 picks."""
    from tessera.operators.projections import global_index
    c = table(spark, sf, "conversations")
    toks = c.select(F.struct("conv_id", "turn").alias("m"), F.explode(alnum_tokens("text")).alias("token"))
    pw, n = class_phrases(spark, sf)
    e = global_index(table(spark, sf, "embeddings").filter(F.col("embedding").isNotNull()).select("vec_id", "embedding"), ["vec_id"])
    size = e.agg(F.count(F.lit(1))).scalar()
    words = toks.select(F.col("token").alias("word")).unionByName(pw.select(F.col("pword").alias("word"))).distinct()
    place = F.pmod(F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("bigint"), size)
    vectors = words.withColumn("_at", place).join(e, F.col("_at") == F.col("_idx")).select("word", "embedding")
    out = TX.phrase_scores(toks, "m", "token", pw, "cls", "phrase", "pword", n, vectors=vectors)
    return out.select("m.conv_id", "m.turn", "cls", F.round("max_score", 6).alias("max_score"), F.round("mean_score", 6).alias("mean_score"))
