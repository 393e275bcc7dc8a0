"""SQL of the operators whose rows need many steps: conversation repair and Lloyd's algorithm."""

from __future__ import annotations


def _add(top: str, cost: int | str, letter: str) -> str:
    """A stack top is its cost in nine digits and its audit, so that text order is (cost, audit) order; null: unreachable."""
    return f"(lpad((left({top}, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({top}, 10) || '{letter}')"


SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: crc32 by its table: the remainder of every byte, then one step a byte
_REPAIR = f"""
    WITH RECURSIVE
    step AS (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) t(i)),
    tab AS (SELECT list(c ORDER BY i) AS tab FROM step),
    ids AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS g FROM (SELECT DISTINCT conv_id FROM conversations)),
    named AS (SELECT g, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(c.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
        FROM conversations c JOIN ids ON c.conv_id IS NOT DISTINCT FROM ids.conv_id),
    crc AS (SELECT n.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT)),
        lambda a, b: xor(a >> 8, tab[1 + (xor(a, b) & 255)])), 4294967295) % 20 AS fault FROM named n, tab),
    harm AS (SELECT g, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM crc WHERE fault <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, md5(length(role)::VARCHAR || ':' || role || text)) AS pos,
        right(rtrim(text, {SPACE}), 1) AS final, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS i FROM harm),
    faults AS (SELECT *, CASE WHEN final = '' THEN 'b' WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY pos) > 1 THEN 'd'
        WHEN final NOT IN ('.', '!', '?') THEN 't' ELSE 'f' END AS f, lead(i) OVER (PARTITION BY g ORDER BY pos) AS onward FROM placed),
    counts AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate,
        count(*) FILTER (f = 't') AS truncated, count(*) FILTER (onward IS NOT NULL AND i || onward NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY g),
    tops AS (
        SELECT g, 0::BIGINT AS num, '000000000' AS e, NULL::VARCHAR AS s, NULL::VARCHAR AS u, NULL::VARCHAR AS h FROM ids
        UNION ALL
        SELECT g, num + 1, {_add('e', 2, 'D')}, least({_add('s', 2, 'D')}, CASE WHEN i = 's' AND stays THEN {_add('e', 'm', 'K')} END),
            least({_add('u1', 2, 'D')}, CASE WHEN i = 'u' AND stays THEN least({_add('e', 'm', 'K')}, {_add('s', 'm', 'K')}, {_add('h1', 'm', 'K')}) END,
                CASE WHEN stays THEN least({_add('e', '1 + m', 'R')}, {_add('s', '1 + m', 'R')}, {_add('h1', '1 + m', 'R')}) END),
            least({_add('h1', 2, 'D')}, CASE WHEN i = 'a' AND stays THEN {_add('u1', 'm', 'K')} END, CASE WHEN stays THEN {_add('u1', '1 + m', 'R')} END)
        FROM (SELECT *, least(h, {_add('u1', 5, 'I')}) AS h1, f IN ('t', 'f') AS stays, CASE WHEN f = 't' THEN 5 ELSE 0 END AS m
            FROM (SELECT t.*, r.i, r.f, least(u, {_add('e', 5, 'I')}, {_add('s', 5, 'I')}, {_add('h', 5, 'I')}) AS u1 FROM tops t JOIN faults r ON r.g = t.g AND r.pos = t.num + 1))
    ),
    last AS (SELECT g, least(e, h, {_add('u', 5, 'I')}, {_add(_add('s', 5, 'I'), 5, 'I')}) AS best FROM tops QUALIFY row_number() OVER (PARTITION BY g ORDER BY num DESC) = 1),
    letters AS (SELECT g, unnest(range(1, len(best) - 8)) AS num, substr(best, num + 9, 1) AS edit FROM last),
    edits AS (SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY g ORDER BY num) AS pos FROM letters),
    stay AS (SELECT e.g, e.num, e.edit, r.role, r.text, r.i, row_number() OVER (PARTITION BY e.g ORDER BY e.num) AS n
        FROM edits e LEFT JOIN faults r ON r.g = e.g AND r.pos = e.pos AND e.edit <> 'I' WHERE e.edit <> 'D'),
    led AS (SELECT *, n - max(CASE WHEN n = 1 AND edit = 'K' AND i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY g) AS number FROM stay),
    lines AS (SELECT g, string_agg(CASE WHEN edit = 'K' THEN role WHEN number % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY num) AS body FROM led GROUP BY g)
    SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
        coalesce(illegal, 0)::BIGINT AS illegal, left(best, 9)::BIGINT AS cost, substr(best, 10) AS audit, sha256(coalesce(body, '')) AS repaired_sha256
    FROM ids JOIN last USING (g) LEFT JOIN counts USING (g) LEFT JOIN lines USING (g)
"""

REPAIR_SQL = _REPAIR


def lloyd_sql(k: int = 40, rounds: int = 5, size: int = 64) -> str:
    """Rounds written out. Products are exact: integers well below 2^53."""
    parts = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR), v) - 1 AS c, v AS m FROM kept ORDER BY 1 LIMIT {k})",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, vec_id, v, c, d FROM (SELECT r, vec_id, v, c, (list_inner_product(v, v) - 2 * list_inner_product(v, m) + list_inner_product(m, m))::BIGINT AS d
            FROM kept, c{i}) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, coalesce(n.m, o.m) AS m FROM c{i} o LEFT JOIN (SELECT c, list(floor(t::DOUBLE / n) ORDER BY j) AS m FROM
                (SELECT c, j, sum(v[j]) AS t, count(*) AS n FROM a{i}, range(1, {size + 1}) x(j) GROUP BY c, j) GROUP BY c) n USING (c))""")
    return f"""
    WITH {', '.join(parts)}
    SELECT vec_id, c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
        sha256(array_to_string(list_transform(m, lambda x: x::BIGINT), ',')) AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} USING (c)
    """
