"""Registered queries of the training-data operators.

Each ``opN_<name>`` applies operator N, with production parameters, to its
whole table and derives the agreed columns from the operator's output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

END_ID = 2
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from usagelens.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), tokenizer_file(), end_id=END_ID)


@register
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from usagelens.llm.token_files import read_token_files, write_token_files

    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex[:12]}"
    manifest = write_token_files(_table(spark, sf_dir, "documents"), folder, tokenizer_file(), end_id=END_ID)
    return read_token_files(spark, folder, manifest)


@register
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from usagelens.llm.secret_scan import base_only, count_kind, scan, spelled

    found = scan(_table(spark, sf_dir, "documents").select("doc_id", "text"), out="spans", pieces=True).drop("text")
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[count_kind(spans, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(spelled(base_only(spans)), 256).alias("base_sha256"),
        spelled(spans).alias("spans"),
    )


@register
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from usagelens.llm.decontaminate import contamination

    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE["op8_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
     iw AS (
       SELECT item_id, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s, w FROM i WHERE len(w) > 0),
     item_windows AS (SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS win FROM iw),
     sizes AS (SELECT DISTINCT n FROM item_windows),
     dw AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
     hits AS (
       SELECT dw.doc_id, dw.s, dw.n, x.item_id
       FROM dw JOIN item_windows x ON x.n = dw.n AND x.win = array_to_string(dw.w[dw.s : dw.s + dw.n - 1], ' ')),
     words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
     items AS (
       SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(words.n_hit, 0) AS n_hit, coalesce(items.n_items, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(words.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@register
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from usagelens.llm.ngram_join import ngram_groups

    return ngram_groups(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies", "kept")


ORACLE["op3_ngram_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     s AS (
       SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i : i + 4], ' '))) AS g
       FROM w WHERE len(w) > 0),
     sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
     links AS (
       SELECT x, y, c = nx.n AND c = ny.n AS same FROM pairs JOIN sizes nx ON nx.doc_id = x JOIN sizes ny ON ny.doc_id = y
       WHERE 10 * c >= 8 * (nx.n + ny.n - c)),
     reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
     classes AS (SELECT x, min(y) AS class_id FROM reach GROUP BY x),
     counts AS (SELECT x, count(*) AS n_links, count_if(same) AS copies FROM links GROUP BY x)
SELECT d.doc_id, classes.class_id, coalesce(counts.n_links, 0) AS n_links, CAST(coalesce(counts.copies, 0) + 1 AS BIGINT) AS n_copies,
       d.doc_id = classes.class_id AS kept
FROM documents d JOIN classes ON classes.x = d.doc_id LEFT JOIN counts ON counts.x = d.doc_id
"""


#: Least score of a document that counts as good.
QUALITY_CUT = 0.3


@register
def op6_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    from usagelens.llm.quality_gam import score, train

    docs = _table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, _table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_CUT).cast("int"))


@register
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from usagelens.llm.language_id import identify, train

    docs = _table(spark, sf_dir, "documents")
    return identify(docs, train(docs))


@register
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from usagelens.llm.toxicity import score, train

    docs = _table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, _table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@register
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from usagelens.llm.license_scan import license_spans

    found = license_spans(_table(spark, sf_dir, "documents"))
    base, own = F.col("base.label"), F.col("spans.label")
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    at_least = F.when(F.size("base") > 0, F.lit(0.5)).otherwise(F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        listed(base).alias("base_labels"),
        listed(F.concat(base, own)).alias("labels"),
        F.greatest(at_least, F.coalesce(F.array_max("spans.coverage"), F.lit(0.0))).alias("score"),
    )


@register
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from usagelens.llm.embedding_dedup import embedding_groups

    return embedding_groups(_table(spark, sf_dir, "embeddings"))


ORACLE["op10_embedding_dedup"] = """
WITH RECURSIVE v AS (
       SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
       WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
     links AS (
       SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
       ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
     reach(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
     component AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
     counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT m.vec_id, coalesce(counts.n, 0) AS n_links, component.component_id, m.vec_id = component.component_id AS kept
FROM embeddings m JOIN component ON component.x = m.vec_id LEFT JOIN counts ON counts.x = m.vec_id
"""


@register
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from usagelens.llm.merkle_manifest import folded, leaf_digest, lowered, manifest, proof_digest

    fields = ["doc_id", "source", "lang", "n_chars"]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        leaf_digest([*map(F.col, fields), F.col("text")]).alias("leaf"),
        F.when(tampered, leaf_digest([*map(F.col, fields), lowered(F.col("text"))])).alias("tampered"),
    )
    found = manifest(docs).withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def _crc32(number: str) -> str:
    """Unsigned crc32 of an integer's decimal digits, for DuckDB."""
    codes = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))"
    byte = "list_reduce(list_prepend(xor(h, b), CAST([1, 1, 1, 1, 1, 1, 1, 1] AS UBIGINT[])), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), {codes}), lambda h, b: {byte}), CAST(4294967295 AS UBIGINT))"


def _tree_sql(name: str, leaves: str, levels: int = 5) -> str:
    """CTEs of a tree over ``leaves`` (t, r, d): {name}0 ... with siblings (l, g) of each node, c nodes in its level."""
    out = []
    for k in range(levels + 1):
        up = f"SELECT t, r // 16 AS r, CASE WHEN any_value(c) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY r)) END AS d FROM {name}{k - 1} GROUP BY t, r // 16"
        out.append(f"""{name}{k} AS (
       SELECT t, r, d, count(*) OVER (PARTITION BY t) AS c,
              coalesce(string_agg(d, '') OVER (PARTITION BY t, r // 16 ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
              coalesce(string_agg(d, '') OVER (PARTITION BY t, r // 16 ORDER BY r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS g
       FROM ({leaves if k == 0 else up}))""")
    out.append(f"{name}top AS (SELECT t, d FROM {name}{levels})")
    return ",\n     ".join(out)


def _climb_sql(tree: str, rows: str, t: str, r: str, levels: int = 5) -> str:
    """One select a level: ``rows`` with proof and fold taken through the levels of ``tree``."""
    for k in range(levels):
        rows = f"""(SELECT x.* EXCLUDE (proof, fold), CASE WHEN n.c = 1 THEN x.proof ELSE x.proof || n.l || n.g END AS proof,
               CASE WHEN n.c = 1 THEN x.fold ELSE sha256(n.l || x.fold || n.g) END AS fold
        FROM {rows} x JOIN {tree}{k} n ON n.t = x.{t} AND n.r = x.{r} // {16**k})"""
    return rows


def _leaf_sql(text: str) -> str:
    fields = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")] + [text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CLIMBED = _climb_sql("s", "(SELECT ranked.*, '' AS proof, CASE WHEN tampered THEN other ELSE leaf END AS fold FROM ranked)", "t", "r")
ORACLE["op12_merkle_manifest"] = f"""
WITH leaves AS (
       SELECT doc_id, coalesce('=' || source, '-') AS t, {_leaf_sql('text')} AS leaf, {_leaf_sql(_LOWERED)} AS other,
              coalesce({_crc32('doc_id')} % 5 = 0, false) AS tampered
       FROM documents),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM leaves),
     {_tree_sql('s', 'SELECT t, r, leaf AS d FROM ranked')},
     members AS (SELECT t AS member, d, row_number() OVER (ORDER BY t) - 1 AS place FROM stop),
     {_tree_sql('m', "SELECT 'root' AS t, place AS r, d FROM members")},
     climbed AS (SELECT x.*, members.d AS subroot, members.place, 'root' AS top FROM {_CLIMBED} x JOIN members ON members.member = x.t)
SELECT doc_id, leaf, subroot, mtop.d AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = mtop.d AS verified
FROM {_climb_sql('m', 'climbed', 'top', 'place')} y, mtop
"""


@register
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from usagelens.llm.exact_dedup import exact_groups

    return exact_groups(_table(spark, sf_dir, "documents"))


ORACLE["op13_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
     g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""


@register
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from usagelens.llm.prefix_trie import trie

    return trie(_table(spark, sf_dir, "conversations"))


ORACLE["op11_prefix_trie"] = f"""
WITH t AS (
       SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, length(coalesce(text, '')) AS chars,
              sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
       FROM conversations WHERE conv_id IS NOT NULL),
     n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
     c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32('conv_id')} % 6 AS h FROM n),
     r AS (
       SELECT c.conv_id, t.pos AS depth, k, chars FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
       UNION ALL
       SELECT c.conv_id, least(c.h, coalesce(n.n, 0)) + t.pos - c.h, k, chars
       FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h LEFT JOIN n ON n.conv_id = c.base),
     p AS (
       SELECT conv_id, depth, chars, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path FROM r
       UNION ALL SELECT conv_id, 0, 0, '' FROM c),
     e AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM p),
     nodes AS (
       SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
              coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '') AS ends
       FROM e GROUP BY path),
     kids AS (SELECT path[: -65] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
     full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (path)),
     below AS (
       SELECT p.path, sum(saved) AS saved_tokens, count_if(x.n_children = 0) AS n_leaves
       FROM full_nodes x JOIN p ON p.conv_id = x.conv_id AND p.depth <= x.depth GROUP BY p.path)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, x.n_convs, x.n_children, CAST(below.n_leaves AS BIGINT) AS n_leaves,
       CAST(below.saved_tokens AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM full_nodes x JOIN below USING (path) LEFT JOIN full_nodes u ON x.depth > 0 AND u.path = x.path[: -65]
"""
