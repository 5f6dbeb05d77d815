"""One query per operator of this subpackage, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers

from vitarium.session import scratch_path
from vitarium.llm import (
    bpe, hardnegatives, idfiles, langid, licences, mainpage, neargraph, packing, prefixtrie, quality, secrets, sharding, simhash)

Spark = SparkSession
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def _table(spark: Spark, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_quality(spark: Spark, sf: str) -> DataFrame:
    return quality.quality(_table(spark, sf, "documents"))


def op2_bpe(spark: Spark, sf: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)
    both = bpe.decode(bpe.encode(_table(spark, sf, "documents"), path), path)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_neargraph(spark: Spark, sf: str) -> DataFrame:
    return neargraph.near_duplicates(_table(spark, sf, "embeddings"))


def op4_packing(spark: Spark, sf: str) -> DataFrame:
    return packing.pack(_table(spark, sf, "documents"), public_tokenizers.path(WORD_BPE)).drop("ids")


def op5_secrets(spark: Spark, sf: str) -> DataFrame:
    base = secrets.spans_text(F.col("spans"), secrets.BASE)
    return secrets.scan(_table(spark, sf, "documents")).select(
        "doc_id", *(secrets.kind_count(F.col("spans"), kind).alias(f"n_{kind}") for kind in secrets.BASE),
        F.sha2(base, 256).alias("base_sha256"), secrets.spans_text(F.col("spans"), secrets.KINDS).alias("spans"))


def op6_idfiles(spark: Spark, sf: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    idfiles.write_ids(_table(spark, sf, "documents"), path, public_tokenizers.path(BYTE_BPE), end_id=2)
    return idfiles.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_sharding(spark: Spark, sf: str) -> DataFrame:
    return sharding.shard(_table(spark, sf, "documents"))


def op8_simhash(spark: Spark, sf: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf, "documents"))


def op9_mainpage(spark: Spark, sf: str) -> DataFrame:
    return mainpage.extract(_table(spark, sf, "pages"))


def op10_langid(spark: Spark, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    return langid.predict(documents, langid.fit(documents))


def op11_hardnegatives(spark: Spark, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf, "embeddings").select(
        "vec_id", label.alias("label"), hardnegatives.quantised(F.col("embedding")).alias("vector"))
    return hardnegatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op12_licences(spark: Spark, sf: str) -> DataFrame:
    return licences.labels(licences.scan(_table(spark, sf, "documents")))


def op13_prefixtrie(spark: Spark, sf: str) -> DataFrame:
    conv = F.col("conv")
    head = F.crc32(conv.cast("string").cast("binary")) % 4
    turns, convs = prefixtrie.with_shared_heads(
        prefixtrie.ordered(_table(spark, sf, "conversations")), head, conv - conv % 20)
    return prefixtrie.prefix_trie(turns, convs).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def pipeline(spark: Spark, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_bpe, op3_neargraph, op4_packing, op5_secrets, op6_idfiles, op7_sharding, op8_simhash, op9_mainpage, op10_langid,
    op11_hardnegatives, op12_licences, op13_prefixtrie, pipeline)}
WORDS = "[^ \\x09-\\x0D]"


def _quality_sql() -> str:
    """The measures and the verdict of ``op1_quality``, counted from single words and windows."""
    stop = "|".join(quality.STOP_WORDS)
    bounds = [f"{measure} {sign} {bound}" for _, measure, least, most in quality.RULES
              for sign, bound in ((">=", least), ("<=", most)) if bound is not None]
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{WORDS}+') AS ws,
            list_filter(string_split(t, chr(10)), lambda line: regexp_matches(line, '{WORDS}')) AS ls FROM d),
        starts AS (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS place FROM w WHERE len(ws) >= 3),
        windows AS (SELECT rid, place, ws[place] || ' ' || ws[place + 1] || ' ' || ws[place + 2] AS three FROM starts),
        twice AS (SELECT rid, place FROM (SELECT rid, place, count(*) OVER (PARTITION BY rid, three) AS n FROM windows) WHERE n > 1),
        covered AS (SELECT rid, count(DISTINCT place + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
        counts AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
            len(regexp_extract_all(t, '{quality.SYMBOLS}')) AS n_symbols, len(ls) AS n_lines,
            len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
            len(list_filter(ws, lambda x: regexp_matches(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '^(?:{stop})(?:[,.;:!?]|$)'))) AS n_stop_words,
            len(regexp_extract_all(t, '\\p{{Lu}}')) AS n_capitals FROM w LEFT JOIN covered USING (rid)),
        measures AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
            coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_chars, coalesce(n_symbols / nullif(word_chars, 0), 0) AS symbol_ratio,
            coalesce(n_stop_words / nullif(n_words, 0), 0) AS stop_ratio, coalesce(n_capitals / nullif(word_chars, 0), 0) AS capital_ratio,
            coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_ratio, coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_ratio FROM counts)
        SELECT *, NOT base_failed AND {" AND ".join(bounds)} AS kept FROM measures"""


HARD_NEGATIVES = """WITH e AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.rid AS anchor, a.vec_id AS anchor_id, a.l = e.l AS same, e.vec_id AS id,
        list_inner_product(a.v, e.v)::BIGINT AS score FROM e a JOIN e ON a.rid <> e.rid WHERE a.vec_id % 50 = 0),
    p AS (SELECT anchor, anchor_id, id AS positive_id, score AS positive_score,
        row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS positive_rank FROM s WHERE same QUALIFY positive_rank <= 5)
    SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor, positive_rank ORDER BY score DESC, id)::INTEGER AS "rank",
        id AS negative_id, positive_score, score AS negative_score, positive_rank::INTEGER AS positive_rank
    FROM p JOIN s ON p.anchor = s.anchor AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY "rank" <= 3"""

#: CRC-32 of a number's digits: the bytes are taken one by one, each in eight steps.
PREFIX_TRIE = """WITH RECURSIVE t AS (SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS place
        FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv, conv - conv % 20 AS base, count(*) AS n, xor(list_reduce(list_transform(range(1, length(conv::VARCHAR) + 1),
            lambda i: ascii(substr(conv::VARCHAR, i, 1))::BIGINT), lambda crc, byte: list_reduce(range(8),
            lambda r, k: xor(r >> 1, 3988292384 * (r & 1)), xor(crc, byte)), 4294967295::BIGINT), 4294967295) % 4 AS h
        FROM t GROUP BY conv),
    r AS (SELECT c.conv, t.place AS d, role, text FROM c JOIN t ON t.conv = c.base AND t.place <= c.h
        UNION ALL SELECT c.conv, t.place - c.h + least(c.h, coalesce(b.n, 0)), role, text
        FROM c JOIN t ON t.conv = c.conv AND t.place > c.h LEFT JOIN c b ON b.conv = c.base),
    seq AS (SELECT c.conv, coalesce(list({'r': role, 't': text} ORDER BY d) FILTER (d IS NOT NULL), []) AS turns
        FROM c LEFT JOIN r ON r.conv = c.conv GROUP BY c.conv),
    pre AS (SELECT conv, len(turns) AS size, unnest(range(len(turns) + 1)) AS d, turns FROM seq),
    keyed AS (SELECT conv, size, d, md5(turns[:d]::VARCHAR) AS k, md5(turns[:d - 1]::VARCHAR) AS up, turns[d].t AS last FROM pre),
    node AS (SELECT d, k, any_value(up) AS up, min(conv) AS conv, count(*) AS n, any_value(last) AS last,
        sha256(coalesce(string_agg(conv::VARCHAR, ',' ORDER BY conv) FILTER (size = d), '')) AS ends FROM keyed GROUP BY d, k),
    kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
    own AS (SELECT node.d, node.k, coalesce(kids.n, 0) AS n_children, (node.n - 1) * len(regexp_extract_all(coalesce(last, ''),
        '[^ \x09-\x0D]+')) AS saved FROM node LEFT JOIN kids ON kids.d = node.d AND kids.k = node.k),
    up AS (SELECT d, k, n_children, saved, d AS top, k AS place FROM own
        UNION ALL SELECT up.d, up.k, n_children, saved, node.d - 1, node.up FROM up JOIN node ON node.d = up.top AND node.k = up.place
        WHERE up.top > 0),
    sums AS (SELECT top AS d, place AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved FROM up GROUP BY ALL)
    SELECT node.conv AS conv_id, node.d AS depth, above.conv AS parent_conv_id, node.n AS n_convs, own.n_children, n_leaves,
        sums.saved::BIGINT AS saved_tokens, node.ends AS ends_sha256
    FROM node JOIN own ON own.d = node.d AND own.k = node.k JOIN sums ON sums.d = node.d AND sums.k = node.k
        LEFT JOIN node above ON above.d = node.d - 1 AND above.k = node.up AND node.d > 0"""

#: The other operators hash, encode or learn by rules SQL does not have; see their tests.
ORACLES: dict[str, str] = {"op1_quality": _quality_sql(), "op11_hardnegatives": HARD_NEGATIVES, "op13_prefixtrie": PREFIX_TRIE}
