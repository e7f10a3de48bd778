"""DuckDB SQL for the queries that SQL can express."""

ORACLES = {
    "op10_exact_dedup": """
        WITH n AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM n JOIN g USING (t)""",
    "op12_fill_in_middle": """
        WITH h AS (
            SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x,
                   length(t) - length(replace(t, chr(10), '')) + CASE WHEN t = '' OR t LIKE '%' || chr(10) THEN 0 ELSE 1 END AS n
            FROM documents),
        u AS (
            SELECT *, ('0x' || substr(x, 1, 8))::BIGINT % (n + 1) AS r1, ('0x' || substr(x, 9, 8))::BIGINT % (n + 1) AS r2,
                   ('0x' || substr(x, 25, 8))::BIGINT % 100 AS r4,
                   list_prepend(0::BIGINT, list_transform(string_split(t, chr(10)), lambda l: length(l) + 1)) AS w
            FROM h),
        c AS (
            SELECT *, t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain,
                   least(length(t), list_sum(w[1:least(r1, r2) + 1])::BIGINT) AS a,
                   least(length(t), list_sum(w[1:greatest(r1, r2) + 1])::BIGINT) AS b
            FROM u),
        p AS (
            SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
        SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN r4 < 50 THEN 'spm' ELSE 'psm' END AS form,
               CASE WHEN NOT plain THEN a END AS prefix_chars, CASE WHEN NOT plain THEN b - a END AS middle_chars,
               sha256(CASE WHEN plain THEN t
                           WHEN r4 < 50 THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
                           ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM p""",
}
