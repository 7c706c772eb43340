"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from searchlake.llm.sharding import SLOT_GROUPS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


#: The table of CRC-32, and the checksum of a text by it.
_CRC_TABLE = """poly(i, k, c) AS (
    SELECT i, 0, i::BIGINT FROM range(256) t(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM poly WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS t FROM poly WHERE k = 8)"""


def _crc32(text: str) -> str:
    return f"""xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
            list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda p : ('0x' || p)::BIGINT)),
            lambda c, b : xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""


OP2 = rf"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (
    SELECT doc_id, (strlen(coalesce(text, '')) + 16)::BIGINT AS size,
        {_crc32("coalesce(text, '')")} AS text_crc32
    FROM documents, crc
), jump(doc_id, n, key, b, j, first_high) AS (
    SELECT DISTINCT coalesce(doc_id, 0), n,
        CASE WHEN coalesce(doc_id, 0) < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE coalesce(doc_id, 0)::HUGEINT END,
        -1::BIGINT, 0::BIGINT, NULL::BIGINT
    FROM documents, (VALUES (40), (41)) s(n)
    UNION ALL
    SELECT doc_id, n, k, j, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((k >> 33) + 1)::DOUBLE))::BIGINT,
        coalesce(first_high, (k >> 32)::BIGINT)
    FROM (SELECT *, ((key % 4294967296) * 2862933555777941757
        + ((key >> 32) * (2862933555777941757::HUGEINT % 4294967296) % 4294967296) * 4294967296
        + 1) % 18446744073709551616 AS k FROM jump WHERE j < n)
), ends AS (SELECT doc_id, n, b AS shard, first_high FROM jump WHERE j >= n)
SELECT d.doc_id, size, text_crc32, 'key' AS law, a.shard::INTEGER AS shard,
    row_number() OVER (PARTITION BY a.shard ORDER BY (a.first_high >> 3) % {SLOT_GROUPS},
        d.doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, g.shard::INTEGER AS grown_shard
FROM docs d JOIN ends a ON a.doc_id = coalesce(d.doc_id, 0) AND a.n = 40
JOIN ends g ON g.doc_id = coalesce(d.doc_id, 0) AND g.n = 41
"""

OP6 = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, {_words(r'[^\x20\x09-\x0D]+')} AS words FROM documents
), sets AS (
    SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS s
    FROM w, unnest(range(1, greatest(len(words) - 4, 1) + 1)) u(i) WHERE len(words) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
    FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT u, v FROM pairs JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
    WHERE 100 * shared >= 75 * (x.n + y.n - shared)
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM w
    UNION
    SELECT r.doc_id, l.v FROM reach r JOIN links l ON l.u = r.other
), low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN low USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

OP8 = rf"""
WITH rules(host, path, verdict) AS (VALUES
    ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), rest AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
        regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest
), keyed AS (SELECT row_number() OVER () AS id, * FROM parts),
fits AS (
    SELECT id, r.host || r.path AS rule, verdict,
        row_number() OVER (PARTITION BY id ORDER BY length(r.host || r.path) DESC, length(r.path) DESC) AS rank
    FROM keyed k JOIN rules r ON (k.host = r.host OR ends_with(k.host, '.' || r.host)) AND starts_with(k.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM keyed LEFT JOIN fits ON fits.id = keyed.id AND rank = 1
"""

OP10 = rf"""
WITH dw AS (SELECT doc_id, {_words(r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')} AS words FROM documents),
bw AS (SELECT item_id, {_words(r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')} AS words FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS size, array_to_string(words[i : i + least(len(words), 10) - 1], ' ') AS s
    FROM bw, unnest(range(1, greatest(len(words) - 9, 1) + 1)) u(i) WHERE len(words) > 0
), sizes AS (SELECT DISTINCT size FROM windows),
runs AS (
    SELECT doc_id, size, i, array_to_string(words[i : i + size - 1], ' ') AS s
    FROM dw, sizes, unnest(range(1, len(words) - size + 2)) u(i) WHERE len(words) >= size
), hits AS (SELECT DISTINCT doc_id, i, r.size, item_id FROM runs r JOIN windows USING (size, s)),
hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS item_ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT dw.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(item_ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _way(x: str, cost: int | str, letters: str, lines: str = "''") -> str:
    """A way of edits, continued: its cost, audit and repaired lines."""
    return f"struct_pack(cost := {x}.cost + {cost}, audit := {x}.audit || '{letters}', lines := {x}.lines || {lines})"


_LINE_U, _LINE_A = "chr(10) || 'user:'", "chr(10) || 'assistant:'"

#: The best ways to the four states (nothing, after s, after u, after a) with
#: insertions, out of those without.
_INSERTED = f"""[a[1], a[2],
    list_min([a[3], {_way('a[1]', 3, 'I', _LINE_U)}, {_way('a[2]', 3, 'I', _LINE_U)}, {_way('a[4]', 3, 'I', _LINE_U)}]),
    list_min([a[4], {_way('a[3]', 3, 'I', _LINE_A)}, {_way('a[1]', 6, 'II', f"{_LINE_U} || {_LINE_A}")},
        {_way('a[2]', 6, 'II', f"{_LINE_U} || {_LINE_A}")}])]"""

_KEPT = "chr(10) || role || ':' || text"
_NEVER = "struct_pack(cost := 1000000000::BIGINT, audit := '', lines := '')"


def _after_row(state: int, sources: list[int], initial: str, name: str) -> str:
    """The best way to a state over one row."""
    ways = [_way(f"c[{state}]", 4, "D")]
    for i in sources:
        ways.append(f"CASE WHEN NOT gone AND ini = '{initial}' THEN {_way(f'c[{i}]', 'cut', 'K', _KEPT)} ELSE {_NEVER} END")
        if name:
            line = f"chr(10) || '{name}:' || text"
            ways.append(f"CASE WHEN NOT gone THEN {_way(f'c[{i}]', '(3 + cut)', 'R', line)} ELSE {_NEVER} END")
    return f"list_min([{', '.join(ways)}])"


_AFTER = ", ".join([
    _after_row(1, [], "", ""), _after_row(2, [1], "s", ""), _after_row(3, [1, 2, 4], "u", "user"), _after_row(4, [3], "a", "assistant"),
])

OP11 = rf"""
WITH RECURSIVE {_CRC_TABLE},
base AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
    FROM conversations, crc
), hurt AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, kind,
        CASE WHEN kind <= 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM base
), left_over AS (
    SELECT conv_id, turn, role, text FROM hurt WHERE kind <> 0 UNION ALL SELECT conv_id, turn, role, text FROM hurt WHERE kind = 3
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM left_over
), marked AS (
    SELECT *, NOT regexp_matches(text, '[^ 	-]') AS blank, left(role, 1) AS ini,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal
    FROM placed
), faults AS (
    SELECT *, blank OR again AS gone,
        CASE WHEN NOT blank AND NOT again AND NOT regexp_matches(text, '[.!?][ 	-]*\z') THEN 3 ELSE 0 END AS cut
    FROM marked
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (NOT blank AND again) AS duplicate, count(*) FILTER (cut > 0) AS truncated,
        count(*) FILTER (illegal) AS illegal, count(*) AS n
    FROM faults GROUP BY conv_id
), ways(conv_id, pos, a) AS (
    SELECT conv_id, 0::BIGINT, [struct_pack(cost := 0::BIGINT, audit := '', lines := ''), {_NEVER}, {_NEVER}, {_NEVER}] FROM counts
    UNION ALL
    SELECT conv_id, pos, [{_AFTER}]
    FROM (SELECT f.*, {_INSERTED} AS c FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos + 1)
), best AS (
    SELECT counts.*, list_min([a[1], {_way('a[2]', 6, 'II', f"{_LINE_U} || {_LINE_A}")}, {_way('a[3]', 3, 'I', _LINE_A)}, a[4]]) AS way
    FROM counts JOIN ways ON counts.conv_id IS NOT DISTINCT FROM ways.conv_id AND pos = n
), every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(way.cost, 0)::BIGINT AS cost,
    coalesce(way.audit, '') AS audit, sha256(substring(coalesce(way.lines, ''), 2)) AS repaired_sha256
FROM every LEFT JOIN best ON every.conv_id IS NOT DISTINCT FROM best.conv_id
"""


def _kmeans(rounds: int) -> str:
    """Assignments a0 ... and codebooks e0 ... of each round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
    SELECT rid, p, min(d * 16 + e) % 16 AS e, min(d * 16 + e) // 16 AS d
    FROM (SELECT rid, p, e, list_sum(list_transform(range(1, len(x) + 1), lambda i : (x[i] - c[i]) * (x[i] - c[i])))::HUGEINT AS d
        FROM cuts JOIN e{r} USING (p)) GROUP BY rid, p
)""")
        if r < rounds:
            steps.append(f"""s{r} AS (
    SELECT p, e, i, sum(x[i])::HUGEINT AS s, count(*) AS n FROM a{r} JOIN cuts USING (rid, p), unnest(range(1, len(x) + 1)) u(i)
    GROUP BY p, e, i
), e{r + 1} AS MATERIALIZED (
    SELECT p, e, coalesce(m, c) AS c FROM e{r}
    LEFT JOIN (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM s{r} GROUP BY p, e) USING (p, e)
)""")
    return ", ".join(steps)


OP13 = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x : floor(x::DOUBLE * 4096)::BIGINT) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0
), cuts AS MATERIALIZED (
    SELECT rid, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS x FROM kept, range(8) t(p)
), e0 AS MATERIALIZED (
    SELECT p, e, x AS c FROM cuts JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 16) USING (rid)
), {_kmeans(6)}, coded AS (
    SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a6 GROUP BY rid
), books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM e6)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), books
"""
