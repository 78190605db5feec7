"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from .chaining import op9_passages
from .chat import op8_chat
from .decontaminate import op7_decontaminate
from .knn import op3_voronoi_knn
from .langid import op1_language_id
from .pieces import op5_pieces
from .quality import op10_quality
from .simhash import op6_simhash
from .suffix_dedup import op2_suffix_dedup
from .warc import op4_warc

QUERIES = {
    "op1_language_id": op1_language_id,
    "op6_simhash": op6_simhash,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_voronoi_knn": op3_voronoi_knn,
    "op4_warc": op4_warc,
    "op5_pieces": op5_pieces,
    "op7_decontaminate": op7_decontaminate,
    "op8_chat": op8_chat,
    "op9_passages": op9_passages,
    "op10_quality": op10_quality,
}
ORACLE_SQL = {
    "op3_voronoi_knn": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
                   FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, rank::INT AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op4_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, upper(sha1(coalesce(html, ''))) AS h,
                          max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
        SELECT page_id, n AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   (1 + ((('0x' || substr(h, (1 + 5 * (i // 4))::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::INT, 1)), '') AS payload_digest,
               CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < last THEN last END AS refers_to
        FROM p""",
    "op8_chat": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
                   UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(24 + length(role) + length(text) + len(regexp_extract_all(text, '<\\*[|]')))::BIGINT AS formatted_chars
        FROM c GROUP BY conv_id""",
}
