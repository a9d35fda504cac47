"""SQL that the registered queries of this part are checked against, where SQL can say what they do."""

from __future__ import annotations


def crc32(number: str) -> str:
    """The crc32 of a number in decimals, bit by bit."""
    # Each character, then seven zeros: eight steps of the shift register.
    bits = (
        f"list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(({number})::VARCHAR, ''), "
        "lambda c: list_prepend(ord(c)::BIGINT, [0::BIGINT, 0, 0, 0, 0, 0, 0]))))"
    )
    return f"xor(list_reduce({bits}, lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384)), 4294967295)"


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    parts = [
        f"coalesce(strlen(({f})::VARCHAR)::VARCHAR || ':' || ({f})::VARCHAR, '-')" for f in fields
    ]
    return f"sha256({' || '.join(parts)})"


OP12 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), near AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
    FROM near
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

# `up`: all runs of all trees (the subroots' tree is -1) with their members in order; a climber is at a
# node and knows its digest as it is, as folded, and the siblings so far.
OP13 = f"""
WITH RECURSIVE named AS (
    SELECT doc_id, {_leaf("text")} AS leaf, {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lower_leaf,
        {crc32("doc_id")} % 5 = 0 AS tampered,
        dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, source
    FROM documents
), leaves AS (
    SELECT doc_id, leaf, CASE WHEN tampered THEN lower_leaf ELSE leaf END AS told, tree,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS ord
    FROM named
), built AS (
    SELECT tree, 0 AS level, ord, leaf AS hash, count(*) OVER (PARTITION BY tree) AS size FROM leaves
    UNION ALL
    SELECT tree, level + 1, ord // 16, sha256(string_agg(hash, '' ORDER BY ord)), (any_value(size) + 15) // 16
    FROM built WHERE size > 1 GROUP BY tree, level, ord // 16
), subroots AS (
    SELECT tree, hash FROM built WHERE size = 1
), top AS (
    SELECT 0 AS level, tree AS ord, hash, count(*) OVER () AS size FROM subroots
    UNION ALL
    SELECT level + 1, ord // 16, sha256(string_agg(hash, '' ORDER BY ord)), (any_value(size) + 15) // 16
    FROM top WHERE size > 1 GROUP BY level, ord // 16
), nodes AS (
    SELECT tree, level, ord, hash, size FROM built
    UNION ALL
    SELECT -1, level, ord, hash, size FROM top
), runs AS (
    SELECT tree, level, ord // 16 AS run, list(hash ORDER BY ord) AS members
    FROM nodes WHERE size > 1 GROUP BY tree, level, ord // 16
), climb AS (
    SELECT doc_id, leaf, told AS folded, '' AS proof, tree, 0 AS level, ord, tree AS own,
        (SELECT max(size) FROM built b WHERE b.tree = l.tree AND b.level = 0) AS size
    FROM leaves l
    UNION ALL
    SELECT doc_id, leaf,
        CASE WHEN size > 1 THEN sha256(
            list_aggregate(members[1 : ord % 16] || [folded] || members[ord % 16 + 2 :], 'string_agg', ''))
        ELSE folded END,
        CASE WHEN size > 1 THEN proof || coalesce(
            list_aggregate(members[1 : ord % 16] || members[ord % 16 + 2 :], 'string_agg', ''), '')
        ELSE proof END,
        CASE WHEN size > 1 THEN c.tree ELSE -1 END,
        CASE WHEN size > 1 THEN c.level + 1 ELSE 0 END,
        CASE WHEN size > 1 THEN ord // 16 ELSE own END,
        own,
        CASE WHEN size > 1 THEN (size + 15) // 16 ELSE (SELECT count(*) FROM subroots) END
    FROM climb c LEFT JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.run = c.ord // 16
    WHERE size > 1 OR c.tree >= 0
)
SELECT doc_id, leaf, s.hash AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root,
    folded = root AS verified
FROM climb c JOIN subroots s ON s.tree = c.own, (SELECT hash AS root FROM top WHERE size = 1)
WHERE c.tree = -1 AND c.size = 1
"""
