"""DuckDB counterparts of the queries that SQL can express on whole tables."""

ORACLES = {
    "op1_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY h) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept,
               h AS text_sha256
        FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
    """,
    "op5_decontamination": r"""
        WITH i AS (
            SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x20\x09-\x0D]+') AS w FROM benchmark),
        d AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        g AS (
            SELECT DISTINCT item_id, least(5, len(w)) AS k,
                   array_to_string(w[p : p + least(5, len(w)) - 1], ' ') AS s
            FROM (SELECT *, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
        n AS (SELECT item_id, count(*) AS n_item FROM g GROUP BY 1),
        h AS (
            SELECT DISTINCT doc_id, k, array_to_string(w[p : p + k - 1], ' ') AS s
            FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p
                  FROM d, (SELECT DISTINCT k FROM g) WHERE len(w) >= k)),
        m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM h JOIN g USING (k, s) GROUP BY 1, 2)
        SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
        FROM m JOIN n USING (item_id) WHERE 100 * n_shared >= 75 * n_item
    """,
    "op6_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        windows AS (
            SELECT doc_id, p, array_to_string(w[p : p + 49], ' ') AS s
            FROM (SELECT *, unnest(range(1, len(w) - 48)) AS p FROM d)),
        first AS (SELECT s, min(doc_id) AS k FROM windows GROUP BY s),
        gone AS (
            SELECT DISTINCT doc_id, p + unnest(range(0, 50)) AS q
            FROM windows JOIN first USING (s) WHERE doc_id > k),
        words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS q FROM d),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY q) AS t
            FROM words ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op12_fill_middle": r"""
        WITH h AS (
            SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d,
                   regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
        k AS (
            SELECT doc_id, t, u, len(u) AS n,
                   ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
                   ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM h),
        f AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                        THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k),
        c AS (
            SELECT doc_id, t, n, form, array_to_string(u[1 : a], '') AS p,
                   array_to_string(u[a + 1 : b], '') AS m, array_to_string(u[b + 1 :], '') AS s FROM f)
        SELECT doc_id, n::BIGINT AS n, form,
               CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM c
    """,
}
