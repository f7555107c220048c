"""Registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm.common import read_table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op2_language_id(spark, sf_dir):
    """Language of every document, learned from those not held out."""
    from tessera.llm import langid
    out = langid.identify(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query
def op5_best_fit_packing(spark, sf_dir):
    """Documents packed into sequences of at most 4096 tokens."""
    from tessera.llm import packing
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op1_suffix_dedup(spark, sf_dir):
    """Bytes of every document that no earlier document holds, as a digest."""
    from tessera.llm import suffix_dedup
    out = suffix_dedup.repeated_spans(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                      F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_ngram_jaccard_join(spark, sf_dir):
    """Size of every document's shingle set and its component of similar documents."""
    from tessera.llm import jaccard
    return jaccard.join_components(read_table(spark, sf_dir, "documents"))


#: The rules of the url query.
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/"))


@query
def op7_url_filter(spark, sf_dir):
    """Verdict on every page's url; urls that a rule decides are the labelled table of the model."""
    from tessera.llm import urlfilter
    pages = urlfilter.parsed(read_table(spark, sf_dir, "pages"), URL_RULES)
    labelled = pages.where("by_rule IS NOT NULL").withColumn("blocked", F.col("by_rule.verdict") == "block")
    return urlfilter.judge(pages, urlfilter.train(labelled))


@query
def op10_pii(spark, sf_dir):
    """Personal data spans of every document, as counts and digests."""
    from tessera.llm import pii
    return pii.digest(pii.find(read_table(spark, sf_dir, "documents")))


@query
def op3_exact_topk(spark, sf_dir):
    """The 5 largest integer products of every vector whose id is divisible by 50."""
    from tessera.llm import topk
    vectors = topk.integers(read_table(spark, sf_dir, "embeddings"))
    return topk.search(vectors.where("vec_id % 50 = 0"), vectors, 5)


ORACLES["op3_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op9_embedding_near_dedup(spark, sf_dir):
    """Links and components of vectors with a cosine of at least 0.9."""
    from tessera.llm import rpforest
    return rpforest.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query
def op4_quotation_linking(spark, sf_dir):
    """Conversations as a mail thread would hold them, each turn quoting the one before it (which quotes
    the one before that), linked again by the quotes alone."""
    from pyspark.sql import Window as W

    from tessera.llm import quotes
    turns = read_table(spark, sf_dir, "conversations")
    line = W.partitionBy("conv_id").orderBy("turn")
    last = F.lag("text").over(line)
    before = F.lag("text", 2).over(line)
    quoted = F.concat_ws("\n", quotes.quote(quotes.quote(before)), quotes.quote(last), F.col("text"))
    linked = quotes.link_replies(turns.withColumn("text", quoted))
    return linked.select("conv_id", "turn", "role", F.col("parent").alias("parent_turn"), F.col("root").alias("root_turn"),
                         "depth", "position", F.md5("body").alias("body_md5"))


ORACLES["op4_quotation_linking"] = r"""
WITH RECURSIVE t AS (
  SELECT *, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS norm,
         lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS last_text FROM conversations
), p AS (
  SELECT a.conv_id, a.turn, any_value(a.role) AS role, any_value(a.text) AS text, min(b.turn) AS parent_turn
  FROM t a LEFT JOIN t b ON a.conv_id = b.conv_id AND b.turn < a.turn
    AND b.norm = trim(regexp_replace(lower(a.last_text), '\s+', ' ', 'g'))
  GROUP BY a.conv_id, a.turn
), r AS (
  SELECT conv_id, turn, turn AS root_turn, 0 AS depth FROM p WHERE parent_turn IS NULL
  UNION ALL
  SELECT p.conv_id, p.turn, r.root_turn, r.depth + 1 FROM p JOIN r ON p.conv_id = r.conv_id AND p.parent_turn = r.turn
)
SELECT p.conv_id, p.turn, role, parent_turn, root_turn, CAST(depth AS INTEGER) AS depth,
       CAST(row_number() OVER (PARTITION BY p.conv_id, root_turn ORDER BY depth, p.turn) AS INTEGER) AS position,
       md5(text) AS body_md5
FROM p JOIN r ON p.conv_id = r.conv_id AND p.turn = r.turn
"""


@query
def op6_sentencepiece(spark, sf_dir):
    """Pieces of every document, and whether they decode to the same text."""
    from tessera.llm import sentencepieces
    path = tokenizer_path("piece_bpe_32k.model")
    encoded = sentencepieces.encode(read_table(spark, sf_dir, "documents"), path, check=True)
    return encoded.select("doc_id", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "round_trip")


@query
def op11_merkle_manifest(spark, sf_dir):
    """Leaf, subroot, root and folded proof of every document; a fifth of the ids is tampered with."""
    from tessera.llm import merkle
    docs = read_table(spark, sf_dir, "documents")
    return merkle.proofs(docs, tampered=F.crc32(F.col("doc_id").cast("string")) % 5 == 0)


ORACLES["op11_merkle_manifest"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('s' || source, '') AS src,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS front,
    coalesce(strlen(text) || ':' || text, '-') AS body,
    coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS low,
    xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1),
        lambda i: [256 + ascii(CAST(doc_id AS VARCHAR)[i]), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda x, y: CASE WHEN y >= 256 THEN xor(x, y - 256)
                        WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END), 4294967295) AS crc
  FROM documents
), leaf AS (
  SELECT doc_id, src, sha256(front || body) AS leaf,
         CASE WHEN crc % 5 = 0 THEN sha256(front || low) ELSE sha256(front || body) END AS seen
  FROM d
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
         count(*) OVER (PARTITION BY src) AS n FROM leaf
), nodes AS (
  SELECT 0 AS lvl, src, r, n, leaf AS h FROM ranked
  UNION ALL
  SELECT lvl + 1, src, r // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY r)) FROM nodes
  WHERE n > 1 GROUP BY lvl, src, n, r // 16
), subroots AS (
  SELECT src, h, row_number() OVER (ORDER BY src) - 1 AS r, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS lvl, r, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, r // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY r)) FROM upper
  WHERE n > 1 GROUP BY lvl, n, r // 16
), side AS (
  SELECT a.lvl, a.src, a.r, coalesce(string_agg(b.h, '' ORDER BY b.r) FILTER (b.r < a.r), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.r) FILTER (b.r > a.r), '') AS rt
  FROM nodes a JOIN nodes b ON a.lvl = b.lvl AND a.src = b.src AND a.r // 16 = b.r // 16
  WHERE a.n > 1 GROUP BY a.lvl, a.src, a.r
), upside AS (
  SELECT a.lvl, a.r, coalesce(string_agg(b.h, '' ORDER BY b.r) FILTER (b.r < a.r), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.r) FILTER (b.r > a.r), '') AS rt
  FROM upper a JOIN upper b ON a.lvl = b.lvl AND a.r // 16 = b.r // 16
  WHERE a.n > 1 GROUP BY a.lvl, a.r
), path AS (
  SELECT x.src, x.r, s.lvl, s.l, s.rt FROM ranked x JOIN side s ON s.src = x.src AND s.r = x.r >> (4 * s.lvl)
  UNION ALL
  SELECT x.src, x.r, 100 + u.lvl, u.l, u.rt FROM ranked x JOIN subroots t ON t.src = x.src
  JOIN upside u ON u.r = t.r >> (4 * u.lvl)
), steps AS (
  SELECT *, row_number() OVER (PARTITION BY src, r ORDER BY lvl) AS k FROM path
), fold AS (
  SELECT src, r, CAST(0 AS BIGINT) AS k, seen AS h FROM ranked
  UNION ALL
  SELECT f.src, f.r, s.k, sha256(s.l || f.h || s.rt) FROM fold f JOIN steps s ON s.src = f.src AND s.r = f.r AND s.k = f.k + 1
), ends AS (
  SELECT src, r, arg_max(h, k) AS h FROM fold GROUP BY src, r
), proof AS (
  SELECT src, r, sha256(string_agg(l || rt, '' ORDER BY k)) AS p FROM steps GROUP BY src, r
)
SELECT x.doc_id, x.leaf, t.h AS subroot, u.h AS root, coalesce(p.p, sha256('')) AS proof_sha256, e.h AS folded_root,
       e.h = u.h AS verified
FROM ranked x JOIN subroots t ON t.src = x.src JOIN ends e ON e.src = x.src AND e.r = x.r
JOIN upper u ON u.n = 1 LEFT JOIN proof p ON p.src = x.src AND p.r = x.r
"""


@query
def op12_embedding_whitening(spark, sf_dir):
    """Every vector's coordinates along the first 8 eigenvectors, scaled to unit variance."""
    from tessera.llm import whitening
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=8)


@query
def op13_html_extraction(spark, sf_dir):
    """Main text of every page, along the paths its host's pages agree on."""
    from tessera.llm import webtext
    return webtext.extract(read_table(spark, sf_dir, "pages")).drop("path")


# What the given pages' markup comes to: one article element of h1 and p blocks, two named references.
ORACLES["op13_html_extraction"] = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS inner_html FROM pages
), t AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(string_split_regex(inner_html, '</?(?:p|h1)>'),
    lambda b: trim(regexp_replace(regexp_replace(replace(regexp_replace(replace(b, '<br>', ' '), '<[^>]*>', '', 'g'),
                '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda b: b <> ''), chr(10) || chr(10)) AS text
  FROM a
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t
"""
