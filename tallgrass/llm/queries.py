"""The package's queries over the driver tables: ``QUERIES`` by name, and
``ORACLES`` with DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, langid, merkle, mixing, prefix_trie, quality, secrets, sentencepiece_bpe, simhash, topk, toxicity, warc, wavelet
from ..session import release
from .common import ascii_lower, id_crc, table, written

QUERIES = {}
ORACLES = {}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def registered(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@registered
def op1_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@registered
def op2_topk_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


ORACLES["op2_topk_tiles"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""


@registered
def op3_sentencepiece(spark: SparkSession, sf_dir: str, model: str = "piece_bpe_32k.model") -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sentencepiece_bpe.encode_decode(docs, tokenizer_file(model), decoded="decoded")
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@registered
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


ORACLES["op4_warc"] = """
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
             sha1(encode(coalesce(html, ''))) AS payload_digest,
             max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
"""


@registered
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs)
    return langid.with_language(docs, model, keep=["doc_id"]).select(
        "doc_id", (id_crc() % 4 == 2).alias("held_out"), "lang_pred", "score")


@registered
def op6_token_shards(spark: SparkSession, sf_dir: str, model: str = "word_bpe_49k.json", end_id: int = 1) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return wavelet.read_shards(*wavelet.write_shards(docs, tokenizer_file(model), end_id))


@registered
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs, model, keep=["doc_id"]).select(
        "doc_id", (id_crc() % 5 == 0).alias("held_out"), "score",
        (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


@registered
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.content_groups(docs, keep_columns=False)


ORACLES["op8_exact_dedup"] = f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, {LOWER} AS body FROM documents)
WINDOW g AS (PARTITION BY body)
"""


@registered
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_severity(docs, model, toxic="score", keep=["doc_id"]).select(
        "doc_id", (id_crc() % 5 == 0).alias("held_out"), "severity", "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@registered
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count().alias("size"))
    out = mixing.systematic_copies(written(docs, "sizes"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                      "copies")


ORACLES["op10_mix_sources"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
 src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
 weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM src),
 ranked AS (SELECT *, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST) AS k FROM weighed),
 tried AS (
  SELECT a.k, a.source, a.source_size, a.w,
         (1.5::DOUBLE * (SELECT sum(source_size) FROM src)
          - coalesce((SELECT sum(2.0::DOUBLE * b.source_size) FROM ranked b WHERE b.k < a.k), 0))
         / (SELECT sum(b.w) FROM ranked b WHERE b.k >= a.k) AS level FROM ranked a),
 lev AS (SELECT max(level) AS level FROM tried WHERE level <= 2.0::DOUBLE * source_size / w),
 targets AS (
  SELECT t.source, t.source_size, least(2.0::DOUBLE * t.source_size, t.w * lev.level) AS target,
         ('0x' || substr(md5('mix' || coalesce('s' || t.source, 'n')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS moved
  FROM tried t, lev),
 placed AS (
  SELECT doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY floor(log2(size + 1)),
           ('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
             % (SELECT greatest(1, ceil(sqrt(count(*)) / 8))::BIGINT FROM documents),
           size, doc_id NULLS LAST) AS pos FROM sized),
 crossed AS (
  SELECT p.doc_id, p.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS each, p.pos, t.moved
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(each * pos + moved) - floor(each * (pos - 1) + moved)))::BIGINT AS taken,
       (floor(each * pos + moved) - floor(each * (pos - 1) + moved))::INT AS copies
FROM crossed
"""


@registered
def op11_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = secrets.Ledger(spark)
    paths = ledger.ingest(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = ledger.by_path(paths)

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["rule"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["place"] <= len(secrets.BASE))
    return found.select("doc_id", *[count(r.name) for r in secrets.BASE],
                        F.sha2(secrets.written_out(base), 256).alias("base_sha256"),
                        secrets.written_out(F.col("spans")).alias("spans"))


def _scan_sql() -> str:
    kinds = " UNION ALL ".join(
        f"""SELECT row, '{r.name}' AS kind, {k} AS place, {r.least} AS least,
            regexp_extract_all(body, $re${r.pattern}$re$) AS found, regexp_extract_all(body, $re${r.pattern}$re$, {r.group}) AS val,
            string_split_regex(body, $re${r.pattern}$re$) AS gaps FROM d""" for k, r in enumerate(secrets.RULES))
    base = len(secrets.BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS body FROM documents),
 kinds AS ({kinds}),
 each AS (SELECT row, kind, place, least, unnest(found) AS found, unnest(val) AS val, unnest(gaps[:len(found)]) AS gap,
                 unnest(range(len(found))) AS k FROM kinds),
 placed AS (
  SELECT row, kind, place, length(val) >= least AS valid, length(found) AS n,
         sum(length(gap) + length(found)) OVER (PARTITION BY row, place ORDER BY k) - length(found) AS start FROM each),
 spans AS (SELECT row, kind, place, start, kind || ':' || start::BIGINT || ':' || (start + n)::BIGINT AS span FROM placed WHERE valid),
 per_row AS (
  SELECT row, {', '.join(f"count(*) FILTER (kind = '{r.name}') AS n_{r.name}" for r in secrets.BASE)},
         string_agg(span, ',' ORDER BY start, place) FILTER (place < {base}) AS base,
         string_agg(span, ',' ORDER BY start, place) AS spans
  FROM spans GROUP BY row)
SELECT doc_id, {', '.join(f"coalesce(n_{r.name}, 0) AS n_{r.name}" for r in secrets.BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per_row USING (row)
"""


ORACLES["op11_secret_ledger"] = _scan_sql()


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@registered
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    lowered = merkle.leaf([F.col(c) for c in FIELDS[:-1]] + [ascii_lower(F.col("text"))])
    seen = F.when(id_crc() % 5 == 0, lowered).otherwise(merkle.leaf([F.col(c) for c in FIELDS]))
    rows = merkle.manifest(docs, FIELDS, held={"seen": seen})
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof().alias("proof_sha256"),
                       merkle.folded(F.col("seen")).alias("folded_root")).withColumn("verified", F.expr("folded_root = root"))


def _tree_sql(name: str, levels: int) -> str:
    """CTEs ``{name}1`` .. over ``{name}0 (key, r, n, h)``, and the runs ``{name}_run0`` .. of each level."""
    out = []
    for k in range(levels):
        out.append(f"""{name}_run{k} AS (SELECT key, r // 16 AS q, n, string_agg(h, '' ORDER BY r) AS run FROM {name}{k}
                      GROUP BY key, r // 16, n)""")
        out.append(f"""{name}{k + 1} AS (SELECT key, q AS r, (n + 15) // 16 AS n,
                      CASE WHEN n > 1 THEN sha256(run) ELSE run END AS h FROM {name}_run{k})""")
    return ", ".join(out)


def _fold_sql(name: str, start: str, key: str, r: str, first: int, levels: int) -> str:
    """CTEs ``f{first + 1}`` .. that fold ``f`` and gather ``proof`` through the runs of a tree."""
    out = []
    for k in range(levels):
        place = f"({r} // {16 ** k})"
        left = f"run[:({place} % 16) * 64]"
        right = f"run[({place} % 16) * 64 + 65:]"
        out.append(f"""f{first + k + 1} AS (SELECT p.* REPLACE (
            CASE WHEN t.n > 1 THEN sha256({left} || f || {right}) ELSE f END AS f,
            CASE WHEN t.n > 1 THEN proof || {left} || {right} ELSE proof END AS proof)
          FROM {start if k == 0 else f'f{first + k}'} p JOIN {name}_run{k} t ON t.key = p.{key} AND t.q = {place} // 16)""")
    return ", ".join(out)


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR END"
        for c in [*FIELDS[:-1], text]) + ")"


def _crc_sql(text: str) -> str:
    """CRC-32 of a text of ASCII letters, bit by bit: DuckDB has no such function."""
    return f"""xor(list_reduce(list_transform(string_split({text}, ''), lambda b: ascii(b)::BIGINT), lambda c, b:
        list_reduce(range(8), lambda d, i: xor(d >> 1, (d & 1) * 3988292384), xor(c, b)), 4294967295::BIGINT), 4294967295)"""


#: Levels for up to 16 ** 8 documents a source and 16 ** 4 sources.
ORACLES["op12_merkle_manifest"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS row, *, coalesce('s' || source, 'n') AS key, {_leaf_sql("text")} AS leaf,
         CASE WHEN {_crc_sql("doc_id::VARCHAR")} % 5 = 0
              THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
              ELSE {_leaf_sql("text")} END AS seen FROM documents),
 placed AS (SELECT doc_id, key, leaf, seen, count(*) OVER (PARTITION BY key) AS n,
                   row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS r FROM d),
 a0 AS (SELECT key, r, n, leaf AS h FROM placed),
 {_tree_sql("a", 8)},
 tops AS (SELECT key, h AS subroot, row_number() OVER (ORDER BY encode(key)) - 1 AS s, count(*) OVER () AS n FROM a8),
 b0 AS (SELECT '' AS key, s AS r, n, subroot AS h FROM tops),
 {_tree_sql("b", 4)},
 f0 AS (SELECT p.*, t.subroot, t.s, '' AS whole, p.seen AS f, '' AS proof FROM placed p JOIN tops t USING (key)),
 {_fold_sql("a", "f0", "key", "r", 0, 8)},
 {_fold_sql("b", "f8", "whole", "s", 8, 4)}
SELECT doc_id, leaf, subroot, b4.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = b4.h AS verified
FROM f12, b4
"""


@registered
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = written(prefix_trie.sequences(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")), "trie-paths")
    out = prefix_trie.trie(prefix_trie.rebuilt(own))
    release(own)
    return out


ORACLES["op13_prefix_trie"] = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations WHERE conv_id IS NOT NULL),
 c AS (
  SELECT conv_id, {_crc_sql("conv_id::VARCHAR")} % 4 AS h,
         list(struct_pack(role, body) ORDER BY turn NULLS FIRST, role,
              sha256(octet_length(encode(role)) || ':' || role || body)) AS path FROM t GROUP BY conv_id),
 r AS (
  SELECT c.conv_id, list_concat(coalesce(b.path[:c.h], []), c.path[c.h + 1:]) AS path
  FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 20),
 pre AS (SELECT conv_id, d, path[:d] AS key, len(path) AS n FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM r)),
 nodes AS (
  SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d) AS ends FROM pre GROUP BY d, key),
 line AS (  -- each node with itself and all nodes above it
  SELECT n.d, n.conv_id, n.n_convs, n.key, u.d AS up_d, u.conv_id AS up
  FROM nodes n JOIN pre p ON p.conv_id = n.conv_id AND p.d <= n.d JOIN nodes u ON u.d = p.d AND u.key = p.key),
 kids AS (SELECT up_d AS d, up AS conv_id, count(*) AS n_children FROM line WHERE up_d = d - 1 GROUP BY ALL),
 sums AS (
  SELECT l.up_d AS d, l.up AS conv_id, count(*) FILTER (k.conv_id IS NULL) AS n_leaves,
         sum(CASE WHEN l.d = 0 THEN 0 ELSE (l.n_convs - 1) * len(regexp_extract_all(l.key[-1].body, '[^ 	-]+')) END)
           AS saved_tokens
  FROM line l LEFT JOIN kids k ON k.d = l.d AND k.conv_id = l.conv_id GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, l.up AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN sums s ON s.d = n.d AND s.conv_id = n.conv_id
LEFT JOIN line l ON l.d = n.d AND l.conv_id = n.conv_id AND l.up_d = n.d - 1
LEFT JOIN kids k ON k.d = n.d AND k.conv_id = n.conv_id
"""
