"""The corpus operators as queries over the given tables, and their SQL twins.

Models are trained and thresholds set as in production; every query reads its
whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm import (
    bpe,
    decontamination,
    jaccard_join,
    language_id,
    licenses,
    line_dedup,
    sharding,
    suffix_dedup,
    token_counts,
    topk_search,
    toxicity,
    turn_repair,
    vector_codes,
)
from adlake.llm.shared import of_hash, read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.exact_top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept and removed; the kept text as its MD5."""
    found = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = of_hash("doc_id", 4, 2)
    docs = read_table(spark, sf_dir, "documents")
    found = language_id.identify(docs, ~held_out)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_bytes(read_table(spark, sf_dir, "documents")).drop("kept")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = of_hash("doc_id", 5, 0)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.score_toxicity(docs, read_table(spark, sf_dir, "labels"), ~held_out)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of each document and the known sentences they come from."""
    found = licenses.scan_licences(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), shards=8)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(read_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents with each benchmark item found in them."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.match_items(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matched_items").alias("item_id"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).drop("text")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("text")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.audit_conversations(turn_repair.damage(read_table(spark, sf_dir, "conversations")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"), parts=8, count=16, rounds=6)


QUERIES: dict[str, Query] = {
    function.__name__: function
    for function in (
        op1_topk_search,
        op2_line_dedup,
        op3_language_id,
        op4_suffix_dedup,
        op5_toxicity,
        op6_licenses,
        op7_sharding,
        op8_jaccard_join,
        op9_decontamination,
        op10_bpe,
        op11_token_counts,
        op12_turn_repair,
        op13_vector_codes,
    )
}

TURN_REPAIR_SQL = r"""
    WITH RECURSIVE k AS (
      SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
    f AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(4294967295, list_reduce(list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(key[i]) AS BIGINT)),
          lambda c, b: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
          CAST(4294967295 AS BIGINT))) % 20 AS fate
      FROM k),
    d AS (
      SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
        CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
      FROM f WHERE fate <> 0),
    n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS seq FROM d),
    w AS (
      SELECT *, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS inner_text,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY seq) AS nth,
        lag(role[1]) OVER (PARTITION BY conv_id ORDER BY seq) || role[1] AS pair
      FROM n),
    c AS (
      SELECT conv_id, seq, turn, role, text, pair, inner_text = '' AS blank, inner_text <> '' AND nth > 1 AS dup,
        inner_text <> '' AND nth = 1 AND inner_text[-1] NOT IN ('.', '!', '?') AS trunc
      FROM w),
    s AS (
      SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, max(seq) AS n,
        CAST(count_if(blank) AS BIGINT) AS blank, CAST(count_if(dup) AS BIGINT) AS duplicate, CAST(count_if(trunc) AS BIGINT) AS truncated,
        CAST(count_if(pair NOT IN ('su', 'ua', 'au')) AS BIGINT) AS illegal
      FROM c GROUP BY conv_id),
    r AS (  -- the cheapest way to each state before turn ``seq``; states: nothing yet, s, u, a
      SELECT conv_id, CAST(1 AS BIGINT) AS seq, {'c': 0, 'e': ''} AS z, {'c': 100000000, 'e': ''} AS s, {'c': 3, 'e': 'I'} AS u, {'c': 6, 'e': 'II'} AS a FROM s
      UNION ALL
      SELECT conv_id, seq, z, s, u, least(a, {'c': u.c + 3, 'e': u.e || 'I'}) FROM (
        SELECT conv_id, seq, z, s, a, least(u, {'c': z.c + 3, 'e': z.e || 'I'}, {'c': s.c + 3, 'e': s.e || 'I'}, {'c': a.c + 3, 'e': a.e || 'I'}) AS u FROM (
          SELECT r.conv_id, r.seq + 1 AS seq, {'c': z.c + 4, 'e': z.e || 'D'} AS z,
            least({'c': s.c + 4, 'e': s.e || 'D'}, {'c': z.c + CASE WHEN gone OR role[1] <> 's' THEN 100000000 ELSE more END, 'e': z.e || 'K'}) AS s,
            least({'c': u.c + 4, 'e': u.e || 'D'}, {'c': z.c + stay_u, 'e': z.e || edit_u}, {'c': s.c + stay_u, 'e': s.e || edit_u}, {'c': a.c + stay_u, 'e': a.e || edit_u}) AS u,
            least({'c': a.c + 4, 'e': a.e || 'D'}, {'c': u.c + stay_a, 'e': u.e || edit_a}) AS a
          FROM r JOIN (
            SELECT conv_id, seq, role, blank OR dup AS gone, CASE WHEN trunc THEN 3 ELSE 0 END AS more,
              CASE WHEN blank OR dup THEN 100000000 ELSE more + CASE WHEN role[1] = 'u' THEN 0 ELSE 3 END END AS stay_u, CASE WHEN role[1] = 'u' THEN 'K' ELSE 'R' END AS edit_u,
              CASE WHEN blank OR dup THEN 100000000 ELSE more + CASE WHEN role[1] = 'a' THEN 0 ELSE 3 END END AS stay_a, CASE WHEN role[1] = 'a' THEN 'K' ELSE 'R' END AS edit_a
            FROM c) t ON t.conv_id IS NOT DISTINCT FROM r.conv_id AND t.seq = r.seq))),
    b AS (SELECT s.*, least(r.z, r.a) AS way FROM s JOIN r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.seq = s.n + 1),
    e AS (SELECT conv_id, way.e AS audit, length(replace(way.e, 'D', '')) AS total, unnest(range(1, length(way.e) + 1)) AS i FROM b),
    o AS (SELECT conv_id, total, i, audit[i] AS edit, length(replace(audit[1:i], 'I', '')) AS seq, length(replace(audit[1:i], 'D', '')) AS place FROM e),
    t AS (
      SELECT o.conv_id, string_agg(
        CASE WHEN o.edit = 'K' THEN c.role WHEN (o.place + o.total) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN o.edit = 'I' THEN '' ELSE c.text END,
        chr(10) ORDER BY o.i) AS lines
      FROM o LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM o.conv_id AND c.seq = o.seq WHERE o.edit <> 'D' GROUP BY o.conv_id)
    SELECT a.conv_id, coalesce(b.gaps, 0) AS gaps, coalesce(b.blank, 0) AS blank, coalesce(b.duplicate, 0) AS duplicate,
      coalesce(b.truncated, 0) AS truncated, coalesce(b.illegal, 0) AS illegal, CAST(coalesce(b.way.c, 0) AS BIGINT) AS cost,
      coalesce(b.way.e, '') AS audit, sha256(coalesce(t.lines, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) a
    LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM a.conv_id
"""


SUFFIX_DEDUP_SQL = """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (SELECT doc_id, i, substring(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d)),
    l AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
    b AS (SELECT *, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 1 ELSE 0 END AS fresh FROM l),
    n AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM b),
    r AS (SELECT doc_id, span, min(i) AS a, max(i) + 100 AS z FROM n GROUP BY doc_id, span),
    k AS (
      SELECT r.doc_id, CAST(count(*) AS BIGINT) AS n_spans, CAST(sum(z - a) AS BIGINT) AS n_removed, max(z) AS last
      FROM r GROUP BY r.doc_id),
    g AS (  -- what stands before each span
      SELECT r.doc_id, a, substring(h, 2 * before + 1, 2 * (a - before)) AS piece
      FROM (SELECT *, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM r) r JOIN d ON d.doc_id = r.doc_id),
    t AS (SELECT doc_id, string_agg(piece, '' ORDER BY a) AS head FROM g GROUP BY doc_id)
    SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
      sha256(unhex(CASE WHEN t.head IS NULL THEN h ELSE t.head || substring(h, 2 * last + 1) END)) AS kept_sha256
    FROM d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""

JACCARD_JOIN_SQL = r"""
    WITH RECURSIVE t AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
      FROM documents),
    s AS (
      SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 4], ' ') END AS x
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM t WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
    e AS (
      SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 75 * (na.n + nb.n - common)),
    u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
    r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, u.b FROM r JOIN u ON u.a = r.b)
    SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
    FROM documents d JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def vector_codes_sql(parts: int = 8, count: int = 16, rounds: int = 6) -> str:
    """Plain rounds over all entries; a value a row."""
    steps = [f"""
    v AS (
      SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS id,
        list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
      FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    x AS (
      SELECT id, i // (len(e) // {parts}) AS part, i % (len(e) // {parts}) AS pos, e[i + 1] AS val
      FROM (SELECT id, e, unnest(range(len(e))) AS i FROM v)),
    c0 AS (SELECT part, id AS entry, pos, val FROM x WHERE id < {count})"""]
    for at in range(rounds + 1):
        steps.append(f"""
    a{at} AS (
      SELECT id, part, min(struct_pack(d := d, entry := entry)) AS best FROM (
        SELECT x.id, x.part, c.entry, sum((x.val - c.val) * (x.val - c.val)) AS d FROM x JOIN c{at} c ON c.part = x.part AND c.pos = x.pos GROUP BY ALL)
      GROUP BY id, part)""")
        if at < rounds:
            steps.append(f"""
    c{at + 1} AS (
      SELECT c.part, c.entry, c.pos, coalesce(m.val, c.val) AS val FROM c{at} c LEFT JOIN (
        SELECT x.part, a.best.entry AS entry, x.pos, CAST(floor(sum(x.val) / count(*)) AS BIGINT) AS val
        FROM x JOIN a{at} a ON a.id = x.id AND a.part = x.part GROUP BY ALL) m ON m.part = c.part AND m.entry = c.entry AND m.pos = c.pos)""")
    return f"""WITH {",".join(steps)},
    r AS (
      SELECT id, string_agg(lower(lpad(to_hex(best.entry), 2, '0')), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
      FROM a{rounds} GROUP BY id)
    SELECT v.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error,
      (SELECT sha256(string_agg(CAST(val AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c{rounds}) AS codebooks_sha256
    FROM v JOIN r ON r.id = v.id"""


ORACLES: dict[str, str] = {
    "op4_suffix_dedup": SUFFIX_DEDUP_SQL,
    "op8_jaccard_join": JACCARD_JOIN_SQL,
    "op12_turn_repair": TURN_REPAIR_SQL,
    "op13_vector_codes": vector_codes_sql(),
    "op1_topk_search": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
          FROM embeddings
          WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, o.vec_id, CAST(list_dot_product(CAST(q.c AS DOUBLE[]), CAST(o.c AS DOUBLE[])) AS BIGINT) AS score
          FROM v q JOIN v o ON q.vec_id <> o.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op2_line_dedup": """
        WITH l AS (
          SELECT doc_id, string_split(text, chr(10)) AS raw,
            list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))) AS lines
          FROM documents WHERE text IS NOT NULL),
        w AS (
          SELECT doc_id, i AS pos, lines[i] || chr(10) || lines[i + 1] || chr(10) || lines[i + 2] AS win
          FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM l)),
        r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS nth FROM w WHERE win <> chr(10) || chr(10)),
        c AS (SELECT DISTINCT doc_id, pos + step AS pos FROM r, (SELECT unnest([0, 1, 2]) AS step) WHERE nth > 1),
        k AS (
          SELECT doc_id, list(pos) AS gone FROM c GROUP BY doc_id)
        SELECT d.doc_id, CAST(coalesce(len(l.raw), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(k.gone), 0) AS BIGINT) AS n_removed,
          md5(CASE WHEN k.gone IS NULL THEN d.text ELSE array_to_string(list_transform(
            list_filter(range(1, len(l.raw) + 1), lambda i: NOT list_contains(k.gone, i)), lambda i: l.raw[i]), chr(10)) END) AS kept_md5
        FROM documents d LEFT JOIN l ON l.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
    """,
}
