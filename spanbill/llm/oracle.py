"""DuckDB SQL for the dealt operators that SQL can express.

It follows the contracts, not the operators: positions come from running sums over pieces, windows from
lists of following words, links from an exact prefix filter and reach. Fitted models (op2, op6), checksums that
DuckDB lacks (op1), the tokenizer (op7), page structure (op8) and learned patterns (op10) have none.
"""

import string

_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _lower(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _spans(k: int, kind: str, pattern: str, fits: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
    SELECT rid, {k} AS k, '{kind}' AS kind, last - length(hit) AS start, last AS stop FROM (
        SELECT rid, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY rid ORDER BY n)::BIGINT AS last FROM (
            SELECT rid, unnest(string_split_regex(body, '{quoted}')) AS gap, unnest(regexp_extract_all(body, '{quoted}')) AS hit,
                unnest(range(len(regexp_extract_all(body, '{quoted}')))) AS n
            FROM docs) WHERE hit IS NOT NULL)
    WHERE {fits}"""


_NAMES = "|".join(_either(x).replace("_", "_?") for x in ("password", "passwd", "secret", "token", "api_key"))
_HEAD = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?"""
_VALUE = (_HEAD + "[A-Za-z0-9+/_.=-]{6,}").replace("'", "''")
_ISSUED = r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----|\bgh[pousr]_[A-Za-z0-9]{36,}|\bxox[abprs]-[A-Za-z0-9-]{10,}"

LINES = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM docs),
keyed AS (SELECT *, {_lower(f"trim(line, {_BLANKS})")} AS line_key FROM lines),
common AS (
    SELECT line_key, max(doc_id) AS last_doc FROM keyed WHERE length(line_key) >= 40
    GROUP BY line_key HAVING count(DISTINCT rid) >= 5),
told AS (SELECT k.*, coalesce(k.doc_id < c.last_doc, false) AS gone FROM keyed k LEFT JOIN common c ON k.line_key = c.line_key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM told GROUP BY rid, doc_id
"""

SECRETS = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
spans AS ({" UNION ALL ".join([
    _spans(0, "assign", _HEAD + "[A-Za-z0-9+/_.=-]+", f"regexp_full_match(hit, '{_VALUE}')"),
    _spans(1, "access", "AKIA[A-Z0-9]+", "length(hit) >= 20"),
    _spans(2, "hex", "[0-9a-f]+", "length(hit) >= 24"),
    _spans(3, "issued", _ISSUED, "true"),
])}),
texts AS (SELECT *, kind || ':' || start || ':' || stop AS span FROM spans)
SELECT d.doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    sha256(coalesce(string_agg(span, ',' ORDER BY start, k) FILTER (k < 3), '')) AS base_sha256,
    coalesce(string_agg(span, ',' ORDER BY start, k), '') AS spans
FROM docs d LEFT JOIN texts t ON d.rid = t.rid GROUP BY d.rid, d.doc_id
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOWS = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_lower("text")}, '{_WORD}') AS ws FROM documents),
items AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all({_lower("text")}, '{_WORD}') AS ws FROM benchmark),
starts AS (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 10 + 1, 1) + 1)) AS place FROM items WHERE len(ws) > 0),
wins AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[place:place + 9], ' ') AS win FROM starts),
words AS (SELECT rid, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM docs),
ahead AS (SELECT rid, pos, list(w) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS ws FROM words),
places AS (
    SELECT rid, pos, n, array_to_string(ws[1:n], ' ') AS win FROM ahead JOIN (SELECT DISTINCT n FROM wins) s ON len(ahead.ws) >= s.n),
hits AS (SELECT DISTINCT rid, pos, p.n, item_id FROM places p JOIN wins w ON p.n = w.n AND p.win = w.win),
covered AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + n)) AS place FROM hits) GROUP BY rid),
named AS (
    SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
"""

NEAR = rf"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_lower("text")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS pos, len(ws) AS total FROM docs),
pairs AS (SELECT doc_id, w, total, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS following FROM words),
shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN total = 1 THEN w ELSE w || ' ' || following END AS s FROM pairs
    WHERE total = 1 OR following IS NOT NULL),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
seen AS (SELECT s, count(*) AS many FROM shingles GROUP BY s),
ranked AS (
    SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY many, s) AS rank
    FROM shingles JOIN sizes USING (doc_id) JOIN seen USING (s)),
first AS (SELECT doc_id, s, n FROM ranked WHERE rank <= n - (80 * n + 99) // 100 + 1),
met AS (
    SELECT DISTINCT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny FROM first a JOIN first b ON a.s = b.s AND a.doc_id < b.doc_id
    WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
links AS (
    SELECT x, y FROM met JOIN shingles sa ON sa.doc_id = x JOIN shingles sb ON sb.doc_id = y AND sb.s = sa.s
    GROUP BY x, y, nx, ny HAVING 100 * count(*) >= 80 * (nx + ny - count(*))),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS node, doc_id AS far FROM documents UNION SELECT r.node, w.y FROM reach r JOIN ways w ON w.x = r.far),
least_id AS (SELECT node, min(far) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least_id l ON l.node = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RANKED = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_lower("text")}, '{_TERM}') AS ts FROM documents),
items AS (SELECT row_number() OVER () AS iid, item_id, regexp_extract_all({_lower("text")}, '{_TERM}') AS ts FROM benchmark),
totals AS (SELECT count(*) AS docs, sum(len(ts))::BIGINT AS words FROM docs WHERE len(ts) > 0),
wanted AS (SELECT iid, item_id, term, count(*) AS times FROM (SELECT iid, item_id, unnest(ts) AS term FROM items) GROUP BY ALL),
found AS (
    SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(ts) AS n, unnest(ts) AS term FROM docs)
    WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM found, totals GROUP BY term, docs),
parts AS (SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))) AS part FROM found JOIN weights USING (term), totals),
scores AS (SELECT iid, item_id, rid, doc_id, sum(times * part)::BIGINT AS score FROM wanted JOIN parts USING (term) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scores WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 10
"""


def _paid(key: str, cost: str, letter: str) -> str:
    """Keys are nine digits of cost and the letters so far, so that the least key is the cheapest and then the first in ASCII order."""
    return f"lpad((substr({key}, 1, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({key}, 10) || '{letter}'"


def _least(*keys: str) -> str:
    return f"least({', '.join(keys)})"


def _if(condition: str, key: str) -> str:
    return f"CASE WHEN {condition} THEN {key} END"


_CLOSED = f"""SELECT cid, n, k0, k1, k2, {_least("k3", _paid("k2", "2", "I"))} AS k3 FROM (
        SELECT cid, n, k0, k1, k3, {_least("k2", *[_paid(k, "2", "I") for k in ("k0", "k1", "k3")])} AS k2 FROM paid)"""
_KEPT, _ROLE = "NOT gone AND ini = '{}'", "NOT gone"
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ord(c)::BIGINT)), lambda c, b: "
    "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda t, z: xor(t >> 1, 3988292384::BIGINT * (t & 1)))), 4294967295::BIGINT)"
)
REPAIR = f"""
WITH RECURSIVE told AS (
    SELECT conv_id, dense_rank() OVER (ORDER BY conv_id) AS cid, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
marked AS (SELECT *, {_CRC} % 20 AS fault FROM told),
faulty AS (
    SELECT cid, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM marked WHERE fault <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, md5(text), copy) AS n FROM faulty),
seen AS (
    SELECT *, row_number() OVER (PARTITION BY cid, role, text ORDER BY n) > 1 AS again, trim(text, {_BLANKS}) AS core,
        CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '' END AS ini,
        left(lag(role) OVER (PARTITION BY cid ORDER BY n), 1) || left(role, 1) AS pair
    FROM ordered),
rows AS MATERIALIZED (
    SELECT *, core = '' AS blank, core <> '' AND again AS twice, core <> '' AND NOT again AND right(core, 1) NOT IN ('.', '!', '?') AS late,
        core = '' OR again AS gone FROM seen),
facts AS (
    SELECT cid, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (twice) AS duplicate, count(*) FILTER (late) AS truncated, count(*) FILTER (n > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM rows GROUP BY cid),
paid AS (
    SELECT cid, 0::BIGINT AS n, '000000000' AS k0, NULL::VARCHAR AS k1, NULL::VARCHAR AS k2, NULL::VARCHAR AS k3 FROM facts
    UNION ALL
    SELECT cid, r.n, {_paid("k0", "3", "D")},
        {_least(_paid("k1", "3", "D"), _if(_KEPT.format("s"), _paid("k0", "late::INT", "K")))},
        {_least(_paid("k2", "3", "D"), *[_if(_KEPT.format("u"), _paid(k, "late::INT", "K")) for k in ("k0", "k1", "k3")],
                *[_if(_ROLE, _paid(k, "2 + late::INT", "R")) for k in ("k0", "k1", "k3")])},
        {_least(_paid("k3", "3", "D"), _if(_KEPT.format("a"), _paid("k2", "late::INT", "K")), _if(_ROLE, _paid("k2", "2 + late::INT", "R")))}
    FROM ({_CLOSED}) c JOIN rows r USING (cid) WHERE r.n = c.n + 1),
best AS (SELECT cid, least(k0, k3) AS k FROM ({_CLOSED}) JOIN facts USING (cid, n)),
audits AS (SELECT cid, substr(k, 1, 9)::BIGINT AS cost, substr(k, 10) AS audit FROM best),
written AS (
    SELECT cid, audit, 0 AS pos, 0::BIGINT AS used, 0 AS state, NULL::VARCHAR AS line FROM audits
    UNION ALL
    SELECT w.cid, audit, pos + 1, CASE WHEN letter = 'I' THEN used ELSE used + 1 END,
        CASE WHEN letter = 'D' THEN state WHEN letter = 'K' AND r.ini = 's' THEN 1 WHEN state = 2 THEN 3 ELSE 2 END,
        CASE letter WHEN 'I' THEN want || ':' WHEN 'K' THEN r.role || ':' || r.text WHEN 'R' THEN want || ':' || r.text END
    FROM (SELECT *, substr(audit, pos + 1, 1) AS letter, CASE state WHEN 2 THEN 'assistant' ELSE 'user' END AS want FROM written WHERE pos < length(audit)) w
    LEFT JOIN rows r ON r.cid = w.cid AND r.n = w.used + 1),
texts AS (SELECT cid, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (line IS NOT NULL), '')) AS repaired_sha256 FROM written GROUP BY cid)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, cid FROM told) LEFT JOIN facts USING (cid) LEFT JOIN audits USING (cid) LEFT JOIN texts USING (cid)
"""

ORACLE: dict[str, str] = {
    "op3_line_dedup": LINES,
    "op4_secret_scan": SECRETS,
    "op5_decontamination": WINDOWS,
    "op9_near_copies": NEAR,
    "op11_ranked_search": RANKED,
    "op13_turn_repair": REPAIR,
}
