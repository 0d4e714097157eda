"""SQL counterparts of the queries of this subpackage, where SQL can express them."""

from __future__ import annotations

from cashtide.llm import chat
from cashtide.llm import licence_scan as L
from cashtide.llm.common import WORD
from cashtide.llm.ranked import LOWER, TERM, UPPER
from cashtide.llm.queries import FORGED_ID, FORGED_TEXT


def _escaped(column: str) -> str:
    for plain, written in chat.ESCAPES:
        column = f"replace({column}, '{plain}', '{written}')"
    return column


OP1 = """
WITH finite AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), v AS (SELECT vec_id, [floor(64 * x) FOR x IN e] AS w, row_number() OVER () AS row FROM finite),
scored AS (
    SELECT q.row, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
    FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

OP5 = f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
           md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffled, row_number() OVER () AS row
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source
), ranked AS (
    SELECT *, row_number() OVER o AS place,
           CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest,
           CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS weights
    FROM sources WINDOW o AS (ORDER BY source_size * 6 // weight, source NULLS LAST)
), level AS (
    SELECT * FROM ranked WHERE 3 * source_size * weights > rest * weight ORDER BY place LIMIT 1
), targets AS (
    SELECT r.source, r.source_size,
           CASE WHEN l.place IS NULL OR r.place < l.place THEN CAST(3 * r.source_size AS DOUBLE)
                ELSE CAST(l.rest * r.weight AS DOUBLE) / l.weights END AS target
    FROM ranked r LEFT JOIN level l ON true
), queued AS (
    SELECT s.*, t.source_size, t.target,
           CAST(coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY shuffled, doc_id, size, row
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), parts AS (
    SELECT *, [greatest(0, least(size, CAST(floor(target) AS BIGINT) - c * source_size - before)) FOR c IN [0, 1, 2]] AS served FROM queued
)
SELECT doc_id, size, source_size, target, CAST(list_sum(served) AS BIGINT) AS taken,
       CAST(len([x FOR x IN served IF x = size]) AS BIGINT) AS copies
FROM parts
"""

def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical_lines(column: str) -> str:
    text = f"regexp_replace(translate(coalesce({column}, ''), '{L.UPPER}', '{L.LOWER}'), '{L.COPYRIGHT_PARAGRAPH}', '\n\n', 'g')"
    text = f"regexp_replace({text}, '{L.COPYRIGHT_LINE}', '', 'g')"
    for other, usual in L.SPELLINGS:
        text = f"replace({text}, '{other}', '{usual}')"
    return f"regexp_replace({text}, '{L.BETWEEN}', ' ', 'g')"


def _values(pairs) -> str:
    return ", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in pairs)


_JOINED = r"regexp_replace({}, '[ \n]+', ' ', 'g')"
for _other, _usual in L.JOINED_SPELLINGS:
    _JOINED = f"replace({_JOINED}, '{_other}', '{_usual}')"
_JOINED = f"trim({_JOINED})"

OP6 = f"""
WITH known AS (
    SELECT sha256({_JOINED.format(_canonical_lines("text"))}) AS digest, min(license) AS license
    FROM (VALUES {_values(L.licence_texts())}) k(license, text) GROUP BY 1
), notice AS (
    SELECT {_JOINED.format(_canonical_lines("text"))} AS line, min(license) AS license FROM (VALUES {_values(L.NOTICES)}) n(text, license) GROUP BY 1
), docs AS (
    SELECT doc_id, row_number() OVER () AS row, {_canonical_lines("text")} AS lines FROM documents
), lines AS (
    SELECT row, trim(unnest(string_split(lines, chr(10)))) AS line FROM docs
), declared AS (
    SELECT row, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM lines JOIN notice USING (line) GROUP BY row
)
SELECT doc_id, sha256({_JOINED.format("lines")}) AS digest, license, coalesce(notices, '') AS notices
FROM docs LEFT JOIN declared USING (row) LEFT JOIN known ON known.digest = sha256({_JOINED.format("lines")})
"""

OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS size FROM pages),
q AS (SELECT *, CASE WHEN size >= 1000 THEN max(page_id) OVER (PARTITION BY digest) END AS last FROM p)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
       CASE WHEN last IS NULL OR last = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last <> page_id THEN last END AS refers_to
FROM q
"""

OP9 = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT {FORGED_ID}, 0, 'user', '{FORGED_TEXT}' UNION ALL SELECT {FORGED_ID}, 1, 'assistant', '{FORGED_TEXT}'
), lengths AS (
    SELECT *, role = '{chat.TRAINED}' AS own, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n,
           sum({len(chat.TURN) + len(chat.TEXT) + len(chat.END)} + length({_escaped("role")}) + length({_escaped("text")}))
               OVER (w ROWS UNBOUNDED PRECEDING) AS upto
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (own), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (own), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (own OR place = n) AS BIGINT) AS formatted_chars
FROM lengths GROUP BY conv_id
"""

OP11 = f"""
WITH words AS (
    SELECT row, doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
    FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)
), counts AS (SELECT row, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT row, CAST(sum(tf) AS BIGINT) AS own FROM counts GROUP BY row),
total AS (SELECT count(*) AS docs, CAST(sum(own) AS BIGINT) AS words FROM lengths),
wanted AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight
    FROM counts, total GROUP BY term
), scored AS (
    SELECT item_id, row, doc_id,
           CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * own * docs) // words)))) AS BIGINT) AS score
    FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (row), total GROUP BY item_id, row, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""

_NEAREST = """a{r} AS MATERIALIZED (
    SELECT row, cluster, distance FROM (
        SELECT row, cluster, CAST(sum((x - c) * (x - c)) AS BIGINT) AS distance FROM x JOIN c{r} USING (dim) GROUP BY row, cluster)
    QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1
)"""
_MOVED = """m{r} AS (SELECT cluster, dim, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM x JOIN a{r} USING (row) GROUP BY cluster, dim),
c{next} AS MATERIALIZED (
    SELECT cluster, dim, coalesce((s - ((s % n) + n) % n) // n, c) AS c FROM c{r} LEFT JOIN m{r} USING (cluster, dim)
)"""
_ROUNDS = 10
_LLOYD = ",\n".join(f"{_NEAREST.format(r=r)},\n{_MOVED.format(r=r, next=r + 1)}" for r in range(_ROUNDS))

OP12 = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, [CAST(floor(1024 * v) AS BIGINT) FOR v IN CAST(embedding AS DOUBLE[])] AS w FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) = 64 AND len([v FOR v IN embedding IF v IS NULL OR NOT isfinite(v)]) = 0
), x AS MATERIALIZED (SELECT row, unnest(w) AS x, generate_subscripts(w, 1) AS dim FROM kept),
c0 AS MATERIALIZED (
    SELECT cluster, unnest(w) AS c, generate_subscripts(w, 1) AS dim
    FROM (SELECT w, row_number() OVER (ORDER BY sha256('3:' || vec_id), w) - 1 AS cluster FROM kept) WHERE cluster < 8
),
{_LLOYD},
{_NEAREST.format(r=_ROUNDS)},
digests AS (SELECT cluster, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM c{_ROUNDS} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INT) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{_ROUNDS} JOIN kept USING (row) JOIN digests USING (cluster)
"""


def statements() -> dict[str, str]:
    return {
        "op1_exact_top_k": OP1,
        "op5_source_mixing": OP5,
        "op6_license_digests": OP6,
        "op7_warc_packages": OP7,
        "op9_chat_prefix_targets": OP9,
        "op11_range_maximum_search": OP11,
        "op12_sharded_lloyd": OP12,
    }
