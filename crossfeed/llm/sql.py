"""DuckDB SQL that gives the rows of the registered queries from the parquet tables."""

from __future__ import annotations

SQL: dict[str, str] = {}

#: Words of a text.
WORDS = r"'[^\x20\x09-\x0D]+'"

#: Halvings that bring any number of words below one.
HALVINGS = 24


def _pareto_mix() -> str:
    """Each pass as steps of its own; passes in which no document is small enough change nothing."""
    order = "rk, doc_id NULLS LAST, size, rid"
    steps = [f"""
taken0 AS MATERIALIZED (
    SELECT * EXCLUDE (room), rk IS NOT NULL AND sum(size) OVER (PARTITION BY source, rk IS NULL ORDER BY {order}
                                                ROWS UNBOUNDED PRECEDING) <= room AS picked
    FROM ranked)"""]
    for n in range(1, HALVINGS + 1):
        steps.append(f"""
small{n} AS (
    SELECT *, coalesce(NOT picked AND rk IS NOT NULL AND size > 0 AND size <= missing / 2, false) AS open
    FROM (SELECT *, target - sum((certain + picked::BIGINT) * size) OVER (PARTITION BY source) AS missing FROM taken{n - 1})),
taken{n} AS MATERIALIZED (
    SELECT * EXCLUDE (missing, open) REPLACE (picked OR (open AND sum(size) OVER (
               PARTITION BY source, open ORDER BY {order} ROWS UNBOUNDED PRECEDING) <= missing) AS picked) FROM small{n})""")
    return rf"""
WITH docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {WORDS}))::BIGINT AS size,
           (('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 13))::BIGINT + 0.5::DOUBLE)
             / 4503599627370496::DOUBLE AS u,
           row_number() OVER () AS rid
    FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
    SELECT *, list_extract([5, 2, 1], 1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT)::BIGINT AS w
    FROM per_source),
levels AS (
    SELECT *, ((SELECT sum(source_size) FROM per_source)
               - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w::DOUBLE, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
           / sum(w) OVER (ORDER BY 3 * source_size / w::DOUBLE, source NULLS LAST
                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed),
targets AS (
    SELECT source, source_size,
           CASE WHEN level > 3 * source_size / w::DOUBLE THEN 3 * source_size::DOUBLE
                ELSE w * max(CASE WHEN level <= 3 * source_size / w::DOUBLE THEN level END) OVER () END AS target
    FROM levels),
rated AS (
    SELECT d.*, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
ranked AS (
    SELECT *, floor(rate)::BIGINT AS certain, target - sum(floor(rate)::BIGINT * size) OVER (PARTITION BY source) AS room,
           CASE WHEN rate > floor(rate) THEN (u / (1 - u)) / ((rate - floor(rate)) / (1 - (rate - floor(rate)))) END AS rk
    FROM rated),{",".join(steps)},
nearer AS (
    SELECT *, NOT picked AND rk IS NOT NULL AND size > 0 AND abs(missing - size) < missing AS open
    FROM (SELECT *, target - sum((certain + picked::BIGINT) * size) OVER (PARTITION BY source) AS missing FROM taken{HALVINGS})),
done AS (
    SELECT * REPLACE (picked OR (open AND 1 = row_number() OVER (
               PARTITION BY source, open ORDER BY abs(missing - size), rk, doc_id, rid)) AS picked) FROM nearer)
SELECT doc_id, size, source_size, target, (certain + picked::BIGINT) * size AS taken,
       certain + picked::BIGINT AS copies, source
FROM done
"""


SQL["op2_pareto_mix"] = _pareto_mix()


#: Macros and common steps of the Merkle tree: texts with their fingerprints.
MERKLE = r"""
    SELECT *, sha256(list_aggregate(list_transform(string_split(body, ';'), lambda s: sha256(list_aggregate(
               list_transform(string_split(s, ','), lambda p: sha256(p)), 'string_agg', ''))), 'string_agg', ''))
              || ':' || body AS mark
    FROM (SELECT *, list_aggregate(list_transform(list_transform(string_split(text, chr(10)), lambda p: {'text': p, 'leaves':
               coalesce(list_aggregate(list_transform(regexp_extract_all(p, '(?s).{1,64}'),
                                                      lambda x: substr(sha256(x), 1, 12)), 'string_agg', '.'), '')}),
               lambda p: p.leaves || CASE WHEN trim(p.text, ' ') = '' OR starts_with(sha256(p.leaves), '0')
                                     THEN ';' ELSE ',' END), 'string_agg', '') AS body FROM TEXTS)
"""

SQL["op3_merkle_fingerprints"] = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
own AS ({MERKLE.replace('TEXTS', 'docs')}),
paired AS (
    SELECT doc_id, text, mark, coalesce(lead(text) OVER o, first_value(text) OVER o) AS next_text,
           coalesce(lead(mark) OVER o, first_value(mark) OVER o) AS next_mark
    FROM own WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, text)),
cut AS (
    SELECT doc_id, text AS own_text, mark AS own_mark, next_mark,
           substr(text, 1, length(text) - length(text) // 3) || substr(next_text, 1, length(text) // 3) AS text
    FROM paired),
edited AS ({MERKLE.replace('TEXTS', 'cut')}),
leaves AS (
    SELECT *, list_distinct(list_filter(regexp_split_to_array(split_part(own_mark, ':', 2), '[.,;]'), lambda x: x <> '')) AS a,
           list_distinct(list_filter(regexp_split_to_array(split_part(mark, ':', 2), '[.,;]'), lambda x: x <> '')) AS b,
           list_distinct(list_filter(regexp_split_to_array(split_part(next_mark, ':', 2), '[.,;]'), lambda x: x <> '')) AS c,
           list_transform(string_split(split_part(own_mark, ':', 2), ';'), lambda s: s) AS mine,
           string_split(split_part(mark, ':', 2), ';') AS theirs
    FROM edited)
SELECT doc_id, length(own_text)::BIGINT AS n_chars, sha256(text) AS edited_sha256, own_mark AS fingerprint,
       mark AS edited_fingerprint,
       CASE WHEN own_mark = mark THEN 1.0::DOUBLE WHEN len(a) + len(b) = 0 THEN 0.0::DOUBLE
            ELSE 2.0::DOUBLE * len(list_intersect(a, b)) / (len(a) + len(b)) END AS near_edited,
       CASE WHEN own_mark = next_mark THEN 1.0::DOUBLE WHEN len(a) + len(c) = 0 THEN 0.0::DOUBLE
            ELSE 2.0::DOUBLE * len(list_intersect(a, c)) / (len(a) + len(c)) END AS near_next,
       len(list_filter(mine, lambda s: NOT list_contains(theirs, s)))::BIGINT AS n_sections_changed
FROM leaves
"""


#: Lower-cased tokens, for the query's texts.
TOKENS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: t <> '')"
MASKS = ((0, 1, 3, 6, 7, 8), (0, 1, 2, 5, 7, 8), (0, 1, 4, 5, 6, 8), (0, 1, 3, 4, 5), (0, 1, 2, 3, 4))


def _seeds(texts: str, key: str) -> str:
    """(key, k, seed) for every place that a mask fits at."""
    return " UNION ALL ".join(
        f"SELECT {key}, k, '{m} ' || " + " || ' ' || ".join(f"t[k + {place + 1}]" for place in mask)
        + f" AS seed FROM (SELECT {key}, t, unnest(range(0, len(t) - {mask[-1]})) AS k FROM {texts})"
        for m, mask in enumerate(MASKS))


SQL["op7_benchmark_overlaps"] = f"""
WITH docs AS (SELECT DISTINCT doc_id, {TOKENS} AS t FROM documents WHERE doc_id IS NOT NULL),
items AS (SELECT DISTINCT item_id, {TOKENS} AS t FROM benchmark WHERE item_id IS NOT NULL),
doc_seeds AS ({_seeds('docs', 'doc_id')}),
item_seeds AS ({_seeds('(SELECT * FROM items WHERE len(t) >= 5)', 'item_id')}),
hits AS (SELECT DISTINCT doc_id, item_id, d.k - i.k AS shift FROM doc_seeds d JOIN item_seeds i USING (seed)),
places AS (
    SELECT doc_id, item_id, shift, i.t AS q, d.t AS h, unnest(range(0, len(i.t))) AS j
    FROM hits JOIN docs d USING (doc_id) JOIN items i USING (item_id)),
same AS (
    SELECT doc_id, item_id, shift, j, len(q) AS n,
           (j + shift >= 0 AND coalesce(h[j + shift + 1] = q[j + 1], false))::INT AS e FROM places),
sums AS (
    SELECT *, sum(e) OVER w AS m, sum(CASE e WHEN 1 THEN 1 ELSE -3 END) OVER w AS s,
           sum(CASE e WHEN 1 THEN 1 ELSE -4 END) OVER w AS even FROM same
    WINDOW w AS (PARTITION BY doc_id, item_id, shift ORDER BY j)),
stretches AS (
    SELECT z.doc_id, z.item_id, z.shift, z.n, a.j AS start, z.j AS stop, z.j - a.j + 1 AS length, z.m - a.m + a.e AS matched,
           z.s - a.s + CASE a.e WHEN 1 THEN 1 ELSE -3 END AS s, z.even - a.even + CASE a.e WHEN 1 THEN 1 ELSE -4 END AS even
    FROM sums a JOIN sums z ON a.doc_id = z.doc_id AND a.item_id = z.item_id AND a.shift = z.shift AND a.j <= z.j),
best AS (
    SELECT * FROM stretches
    QUALIFY 1 = row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY s DESC, stop, start DESC)),
enough AS (
    SELECT * FROM best WHERE length >= least(13, n) AND matched >= 0.8 * length AND (n >= 9 OR matched = n)),
whole AS (
    SELECT * FROM stretches
    WHERE length >= least(13, n) AND even >= 0 AND (n >= 9 OR matched = n)
      AND NOT EXISTS (SELECT 1 FROM enough g WHERE g.doc_id = stretches.doc_id AND g.item_id = stretches.item_id
                      AND g.shift = stretches.shift)
    QUALIFY 1 = row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY even DESC, stop, start DESC)),
taken AS (SELECT *, 0 AS way FROM enough UNION ALL SELECT *, 1 AS way FROM whole)
SELECT doc_id, item_id, (start + shift)::BIGINT AS doc_start, start::BIGINT AS item_start, length::BIGINT AS length,
       matched::BIGINT AS matched
FROM taken
QUALIFY 1 = row_number() OVER (PARTITION BY doc_id, item_id ORDER BY way, matched DESC, length, start + shift, start)
"""


SQL["op8_tool_calls"] = """
WITH RECURSIVE calls AS (
    SELECT conv_id || ':' || turn AS call_id, turn, CASE role WHEN 'user' THEN 'reply' ELSE 'instruct' END AS name, text,
           CASE WHEN role = 'user' AND turn >= 2 THEN conv_id || ':' || (turn - 2) END AS parent_id,
           count(*) OVER (PARTITION BY conv_id, turn) AS n,
           row_number() OVER (PARTITION BY conv_id, turn ORDER BY CASE role WHEN 'user' THEN 'reply' ELSE 'instruct' END,
                              to_json(struct_pack(text := text, turn := turn)) NULLS LAST) AS r
    FROM conversations WHERE role IN ('user', 'system')),
called AS (SELECT * FROM calls WHERE r = 1 AND call_id IS NOT NULL),
answers AS (
    SELECT conv_id || ':' || (turn - 1) AS result_id, text AS content, count(*) OVER (PARTITION BY conv_id, turn) AS n,
           row_number() OVER (PARTITION BY conv_id, turn ORDER BY text NULLS LAST) AS r
    FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'system')),
answered AS (SELECT * FROM answers WHERE r = 1 AND result_id IS NOT NULL),
tree AS (
    SELECT call_id, call_id AS root_id, 0::BIGINT AS depth FROM called c
    WHERE NOT EXISTS (SELECT 1 FROM called p WHERE p.call_id = c.parent_id)
    UNION ALL
    SELECT c.call_id, t.root_id, t.depth + 1 FROM called c JOIN tree t ON c.parent_id = t.call_id),
joined AS (
    SELECT coalesce(c.call_id, a.result_id) AS call_id, c.call_id IS NOT NULL AS is_call, c.name, t.root_id, t.depth, c.parent_id,
           c.text, c.turn, a.content,
           CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN t.depth IS NULL THEN 'cycle'
                WHEN a.result_id IS NULL THEN 'open' ELSE 'answered' END AS status,
           coalesce(c.n, 0)::BIGINT AS n_calls, coalesce(a.n, 0)::BIGINT AS n_results
    FROM called c LEFT JOIN tree t USING (call_id) FULL JOIN answered a ON c.call_id = a.result_id
    UNION ALL
    SELECT call_id, true, name, NULL, NULL, parent_id, text, turn, NULL,
           CASE WHEN call_id IS NULL THEN 'open' ELSE 'repeated' END, 1, 0 FROM calls WHERE r > 1 OR call_id IS NULL
    UNION ALL
    SELECT result_id, false, NULL, NULL, NULL, NULL, NULL, NULL, content,
           CASE WHEN result_id IS NULL THEN 'orphan' ELSE 'repeated' END, 0, 1 FROM answers WHERE r > 1 OR result_id IS NULL),
checked AS (
    SELECT *, CASE WHEN is_call THEN list_filter([
               CASE WHEN text IS NULL THEN 'text: required' END,
               CASE WHEN name = 'reply' AND turn IS NULL THEN 'turn: required' END,
               CASE WHEN name = 'reply' AND length(text) < 1 THEN 'text: minLength'
                    WHEN name = 'reply' AND length(text) > 400 THEN 'text: maxLength' END,
               CASE WHEN name = 'reply' AND turn < 0 THEN 'turn: minimum' END], lambda x: x IS NOT NULL) END AS e
    FROM joined)
SELECT call_id, name, root_id, depth, status, array_to_string(e, '; ') AS errors, n_calls, n_results,
       '{"arguments":' || CASE WHEN is_call THEN '{' || concat_ws(',', '"text":' || to_json(text), '"turn":' || to_json(turn)) || '}'
                          ELSE 'null' END
       || ',' || substr(to_json(struct_pack(depth := depth, errors := e, id := call_id, name := name, parent := parent_id,
                                            result := content, status := status))::VARCHAR, 2) AS json
FROM checked
"""


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Every round as steps of their own: nearest entries, means, next codebook."""
    steps = [f"""
kept AS (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
           list_transform(embedding, lambda x: floor({scale}::DOUBLE * x::DOUBLE)) AS v
    FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS MATERIALIZED (
    SELECT rid, p, list_slice(v, p * len(v) // {parts} + 1, (p + 1) * len(v) // {parts}) AS x
    FROM kept, (SELECT unnest(range({parts})) AS p)),
c0 AS (SELECT p, rid - 1 AS e, x AS c FROM pieces WHERE rid <= {entries})"""]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
    SELECT rid, p, any_value(x) AS x,
           min((list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c))::BIGINT * {entries} + e) AS best
    FROM pieces JOIN c{n} USING (p) GROUP BY rid, p)""")
        if n < rounds:
            steps.append(f"""
m{n} AS (
    SELECT p, e, list(m ORDER BY i) AS c
    FROM (SELECT p, best % {entries} AS e, i, floor(sum(x[i]) / count(*)) AS m
          FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS i FROM a{n}) GROUP BY ALL) GROUP BY p, e),
c{n + 1} AS (SELECT p, e, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (p, e))""")
    return f"""
WITH {",".join(steps)},
coded AS (
    SELECT rid, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code, sum(best // {entries})::BIGINT AS error
    FROM a{rounds} GROUP BY rid),
books AS (
    SELECT sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
    FROM (SELECT p, e, unnest(c) AS y, unnest(range(len(c))) AS i FROM c{rounds}))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), books
"""


SQL["op12_vector_codes"] = _vector_codes()


SQL["op13_fill_in_middle"] = r"""
WITH lines AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
           sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents),
numbers AS (
    SELECT doc_id, t, u, len(u)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
           ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
    FROM lines),
pieces AS (
    SELECT doc_id, t, n,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(list_slice(u, 1, least(h1 % (n + 1), h2 % (n + 1))), '') AS p,
           array_to_string(list_slice(u, least(h1 % (n + 1), h2 % (n + 1)) + 1, greatest(h1 % (n + 1), h2 % (n + 1))), '') AS m,
           array_to_string(list_slice(u, greatest(h1 % (n + 1), h2 % (n + 1)) + 1, n), '') AS s
    FROM numbers)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM pieces
"""
