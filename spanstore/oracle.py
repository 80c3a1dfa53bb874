"""DuckDB SQL that states the queries of :mod:`.queries`."""

from __future__ import annotations

from .functions import fixed

_SUFFIXES = "['.txt','.md','.py','.log','.min.js','.env','.csv','.rst']"
ITEMS = f"""items AS (
  SELECT doc_id, coalesce(source, 'none') || '/' || doc_id || {_SUFFIXES}[doc_id % 8 + 1] AS path, coalesce(text, '') AS text FROM documents
)"""

# chr() spells the separators, so that no escape rule of a SQL dialect matters.
_BREAKS = "chr(13) || chr(10) || '|[' || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(133) || chr(8232) || chr(8233) || ']'"


def _windows(of: str) -> str:
    """CTEs from ``of`` (k, text) to wins (k, s, e, t): greedy windows, one line a step."""
    return f"""
parts AS (SELECT k, CASE WHEN text = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(text, {_BREAKS}) END AS ls FROM {of}),
lined AS (SELECT k, CASE WHEN len(ls) > 0 AND ls[-1] = '' THEN ls[:-2] ELSE ls END AS ls FROM parts),
steps AS (
  SELECT k, 1::BIGINT AS i, 1::BIGINT AS s, 0::BIGINT AS n, 0::BIGINT AS size, 0::BIGINT AS from_s, 0::BIGINT AS from_e FROM lined WHERE len(ls) > 0
  UNION ALL
  SELECT k, i + 1,
    CASE WHEN shut THEN i ELSE s END, CASE WHEN shut THEN 1 ELSE n + 1 END, CASE WHEN shut THEN w ELSE size + w END,
    CASE WHEN shut THEN s ELSE 0 END, CASE WHEN shut THEN i - 1 ELSE 0 END
  FROM (
    SELECT st.k, i, s, n, size, length(l.ls[i]) + 1 AS w,
      n > 0 AND (n >= {fixed.MAX_LINES} OR size + length(l.ls[i]) + 1 > {fixed.MAX_CHARS}) AS shut
    FROM steps st JOIN lined l ON l.k = st.k WHERE i <= len(l.ls)
  )
),
cuts AS (
  SELECT k, from_s AS s, from_e AS e FROM steps WHERE from_s > 0
  UNION ALL SELECT st.k, s, s + n - 1 FROM steps st JOIN lined l ON l.k = st.k WHERE i = len(l.ls) + 1
),
wins AS (
  SELECT * FROM (SELECT c.k, s, e, array_to_string(l.ls[s:e], chr(10)) AS t FROM cuts c JOIN lined l ON l.k = c.k)
  WHERE regexp_matches(t, '[^\\s]')
)"""


_DOC_WINDOWS = f"WITH RECURSIVE {ITEMS}, texts AS (SELECT doc_id AS k, text FROM items), {_windows('texts')}"
_SOURCE_ID = "sha256(concat_ws(chr(0), 'source', 'tables', 'documents'))[1:32]"
_DOC_ID = f"sha256(concat_ws(chr(0), 'document', {_SOURCE_ID}, path))[1:32]"


def _values(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _rlike(text: str, pattern: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"regexp_matches({text}, '{quoted}')"


_NAME = "lower(regexp_extract(path, '[^/]*$'))"
_SUFFIX = f"regexp_extract({_NAME}, '^\\.*[^.].*?(\\.[^.]+)$', 1)"
_KIND = "CASE suffix WHEN '.md' THEN 'text/markdown' WHEN '.py' THEN 'text/x-python' WHEN '.js' THEN 'text/javascript' WHEN '.csv' THEN 'text/csv' WHEN '.rst' THEN 'text/x-rst' ELSE 'text/plain' END"
_NAMED = f"named AS (SELECT *, {_NAME} AS name, {_SUFFIX} AS suffix FROM items)"
# A number alone before a suffix is never a manifest, lock or environment file.
_TYPED = f"typed AS (SELECT *, CASE WHEN name LIKE '%.env' THEN 'text/x-ini' ELSE {_KIND} END AS media_type FROM named)"


def _relevance(size: str) -> str:
    return (
        f"CASE WHEN list_has_any(string_split(lower(path), '/'), [{_values(fixed.IGNORABLE_PARTS)}]) OR name IN ({_values(fixed.LOCKFILES)}) "
        f"OR contains(name, '.min.') OR ends_with(name, '.map') OR ends_with(name, '.bundle.js') OR ({size} >= {fixed.LARGE_ASSET_BYTES} AND suffix IN ('.js', '.css')) THEN 0 "
        f"WHEN name IN ({_values(fixed.MANIFEST_NAMES)}) OR {_rlike('name', '^(' + '|'.join(fixed.MANIFEST_PREFIXES) + ')')} "
        f"OR suffix IN ({_values(fixed.PRIMARY_SUFFIXES)}) OR contains('/' || lower(path), '/docs/') THEN 3 "
        f"WHEN suffix IN ({_values(fixed.CODE_SUFFIXES)}) THEN 2 ELSE 1 END::INTEGER"
    )


_READER = "CASE WHEN media_type IN ('text/markdown', 'text/x-rst') THEN 'markdown' WHEN media_type = 'text/csv' THEN 'csv' ELSE 'text' END"

# Word boundaries spelt out, since this dialect's \b knows ASCII only.
_B, _E = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
_WORD = r"[\p{L}\p{N}_]"


def _boundaries(pattern: str) -> str:
    head = pattern.startswith(r"\b")
    tail = pattern.endswith(r"\b")
    body = pattern[2 if head else 0 : len(pattern) - (2 if tail else 0)]
    return (_B if head else "") + body.replace(r"\w", r"\p{L}\p{N}_") + (_E if tail else "")


_PLACEHOLDER = fixed.PLACEHOLDER.replace(r"\w*", _WORD + "*")
_ASSIGNED = (
    r"(?i)" + _B + r"(password|passwd|pwd|secret|token|api[_-]?key|apikey|access[_-]?key|client[_-]?secret|authorization)"
    r"""\s*[:=]\s*["']?([^\s"',;]{6,})"""
)
_CARDS = (
    "list_filter(list_transform(regexp_extract_all(' ' || {t}, '" + r"[^\p{L}\p{N}_]((?:[0-9][ -]?){12,18}[0-9])(?:[ -]?$|[ -]?[^\p{L}\p{N}_])" + "', 1), "
    "lambda c: regexp_replace(c, '[ -]', '', 'g')), lambda d: length(d) BETWEEN 13 AND 19 AND "
    "list_sum(list_transform(range(length(d)), lambda i: CASE WHEN i % 2 = 1 THEN (d[length(d) - i]::INTEGER * 2) // 10 + (d[length(d) - i]::INTEGER * 2) % 10 "
    "ELSE d[length(d) - i]::INTEGER END)) % 10 = 0)"
)


def _sensitive(t: str) -> tuple[str, str]:
    """(secret labels, personal labels) as list expressions."""
    named = []
    for label, pattern in fixed.SECRETS.items():
        hit = _rlike(t, _boundaries(pattern))
        if label == "connection_string":
            value = f"regexp_extract({t}, '{_boundaries(pattern)}', 1)"
            hit += f" AND NOT {_rlike(value, _PLACEHOLDER)}"
        named.append(f"CASE WHEN {hit} THEN '{label}' END")
    quoted = _ASSIGNED.replace("'", "''")
    pairs = f"list_zip(regexp_extract_all({t}, '{quoted}', 1), regexp_extract_all({t}, '{quoted}', 2))"
    placeholder = _PLACEHOLDER.replace("'", "''")
    first = f"list_filter({pairs}, lambda p: NOT regexp_matches(p[2], '{placeholder}'))[1][1]"
    secret = f"list_filter([{', '.join(named)}, 'assigned_' || replace(lower({first}), '-', '_')], lambda x: x IS NOT NULL)"
    email = _rlike(t, _boundaries(fixed.EMAIL))
    personal = f"list_filter([CASE WHEN {email} THEN 'email' END, CASE WHEN len({_CARDS.replace('{t}', t)}) > 0 THEN 'card_number' END], lambda x: x IS NOT NULL)"
    return secret, personal


_SECRET, _PERSONAL = _sensitive("text")
_FOUND = f"found AS (SELECT *, {_SECRET} AS secret, {_PERSONAL} AS personal FROM {{of}})"
_LEVEL = "CASE WHEN len(secret) > 0 THEN 'secret' WHEN len(personal) > 0 THEN 'pii' ELSE 'none' END"
_LABELS = "array_to_string(CASE WHEN len(secret) > 0 THEN secret ELSE personal END, ',')"

_SNAPSHOT = """
SELECT {doc_id} AS id, doc_id, path, sha256(text) AS blob_sha, strlen(text)::BIGINT AS size, 'run{run}' AS first_seen, 'run{run}' AS last_seen, text FROM ({items})
"""
_RUN1 = _SNAPSHOT.format(doc_id=_DOC_ID, run=1, items="SELECT * FROM items")
_RUN2 = _SNAPSHOT.format(
    doc_id=_DOC_ID, run=2,
    items="SELECT doc_id, path, CASE WHEN doc_id % 3 = 0 THEN text || chr(10) || 'edited' ELSE text END AS text FROM items WHERE doc_id % 7 <> 0",
)
_RUNS = f"{ITEMS}, one AS ({_RUN1}), two AS ({_RUN2})"

_UNITS = f"""{_DOC_WINDOWS},
numbered AS (SELECT k, s, e, t, row_number() OVER (PARTITION BY k ORDER BY s) - 1 AS ordinal FROM wins),
units AS (
  SELECT i.doc_id, i.path, i.text AS whole, sha256(i.text) AS blob_sha, {_DOC_ID} AS document_id, s, e, ordinal, t AS text, {_NAME} AS name, {_SUFFIX} AS suffix,
    '{{"end":' || e || ',"kind":"lines","start":' || s || '}}' AS locator_json
  FROM numbered JOIN items i ON i.doc_id = k
),
full_units AS (
  SELECT *, sha256(concat_ws(chr(0), 'unit', document_id, blob_sha, locator_json, ordinal::VARCHAR))[1:32] AS id, {_relevance("0")} AS relevance FROM units
)"""

_EVENTS = f"""{_DOC_WINDOWS}, {_NAMED}, {_TYPED},
counted AS (SELECT k, count(*) AS n FROM wins GROUP BY k),
sized AS (
  SELECT *, CASE WHEN doc_id % 11 = 0 THEN 0 WHEN doc_id % 13 = 0 THEN {fixed.MAX_BLOB_BYTES} + doc_id ELSE strlen(text) END AS size FROM typed
),
gated AS (
  SELECT *, CASE WHEN doc_id % 17 = 0 THEN 'skipped/pruned_directory' WHEN size = 0 THEN 'skipped/empty_file'
    WHEN size > {fixed.MAX_BLOB_BYTES} THEN 'skipped/too_large' WHEN doc_id % 5 = 0 THEN 'unchanged/unchanged_blob'
    WHEN {_relevance("size")} = 0 THEN 'skipped/low_relevance' END AS gate FROM sized
),
events_ AS (
  SELECT 'run' || doc_id % 3 AS run_id, lpad(doc_id::VARCHAR, 20, '0') AS seq, path,
    CASE WHEN gate IS NOT NULL THEN split_part(gate, '/', 1) WHEN coalesce(n, 0) = 0 THEN 'skipped' ELSE 'extracted' END AS outcome,
    CASE WHEN gate IS NOT NULL THEN split_part(gate, '/', 2) WHEN coalesce(n, 0) = 0 THEN 'nothing_to_extract' ELSE '' END AS reason,
    CASE WHEN gate IS NULL THEN coalesce(n, 0) ELSE 0 END::INTEGER AS units
  FROM gated LEFT JOIN counted ON k = doc_id
)"""

_SHIFTED = f"""{_UNITS},
shifted AS (SELECT *, CASE doc_id % 10 WHEN 0 THEN 1 WHEN 1 THEN 100000 ELSE 0 END AS d FROM full_units),
opened AS (
  SELECT u.id, u.text, u.s + d > len(l.ls) AS failed, array_to_string(l.ls[u.s + d : u.e + d], chr(10)) AS got FROM shifted u JOIN lined l ON l.k = u.doc_id
)"""


def _one_node(rows: str, key: str, units: list[tuple[str, str, str]]) -> str:
    """SQL of one unit per listed (locator json, text, meta) of each row."""
    return " UNION ALL ".join(
        f"SELECT {key}::BIGINT AS document_id, 'ok' AS status, {i}::BIGINT AS ordinal, {loc} AS locator_json, {text} AS text, false AS verbatim, {meta} AS meta FROM {rows}"
        for i, (loc, text, meta) in enumerate(units)
    )


_CELL = "'{{\"kind\":\"node\",\"path\":\"/diagram[1]/mxCell[@id=''{}'']\"}}'"
# Two runs of the engine over documents as files.
_RUN_SUFFIXES = "['.txt','.py','.log','.min.js','.env','.json']"
_TWO_RUNS = f"""WITH RECURSIVE
files AS (
  SELECT doc_id, coalesce(source, 'none') || '/' || doc_id || {_RUN_SUFFIXES}[doc_id % 6 + 1] AS path,
    CASE WHEN doc_id % 6 = 5 THEN '{{ ' ELSE '' END || coalesce(text, '') AS text FROM documents
),
versions_ AS (
  SELECT doc_id, path, 1 AS run, text FROM files
  UNION ALL SELECT doc_id, path, 2, CASE WHEN doc_id % 3 = 0 THEN text || chr(10) || 'edited' ELSE text END FROM files
),
texts AS (SELECT (doc_id, run) AS k, text FROM versions_), {_windows("texts")},
counted AS (SELECT k, count(*) AS n, sum(length(t)) AS chars FROM wins GROUP BY k),
met AS (
  SELECT v.*, coalesce(n, 0) AS n, coalesce(chars, 0) AS chars,
    CASE WHEN doc_id % 17 = 0 THEN 'pruned_directory' WHEN doc_id % 11 = 0 OR (doc_id % 13 <> 0 AND strlen(text) = 0) THEN 'empty_file' WHEN doc_id % 13 = 0 THEN 'too_large' END AS early,
    doc_id % 6 = 3 AS ignorable
  FROM versions_ v LEFT JOIN counted c ON c.k = (v.doc_id, v.run)
),
both_ AS (SELECT two.*, one.text = two.text AND one.early IS NULL AND NOT one.ignorable AND one.n > 0 AND two.run = 2 AS same FROM met two JOIN met one ON one.doc_id = two.doc_id AND one.run = 1)"""

ORACLE_SQL = {
    "ingest_ledger": f"""{_TWO_RUNS},
judged AS (
  SELECT *, CASE WHEN early IS NOT NULL THEN early WHEN same THEN 'unchanged_blob' WHEN ignorable THEN 'low_relevance' WHEN n = 0 THEN 'nothing_to_extract'
    WHEN doc_id % 6 = 5 THEN 'degraded_parse' ELSE '' END AS reason FROM both_
)
SELECT run, path, CASE WHEN reason IN ('', 'degraded_parse') THEN 'extracted' WHEN reason = 'unchanged_blob' THEN 'unchanged' ELSE 'skipped' END AS outcome, reason,
  CASE WHEN reason IN ('', 'degraded_parse') THEN n ELSE 0 END::INTEGER AS units, reason NOT IN ('', 'unchanged_blob', 'empty_file') AS has_detail FROM judged""",
    "ingest_tables": f"""{_TWO_RUNS},
current AS (SELECT * FROM both_ b WHERE early IS NULL AND run = 2),
named AS (SELECT *, {_NAME} AS name, {_SUFFIX} AS suffix FROM current)
SELECT {_DOC_ID} AS document_id, path, sha256(text) AS blob_sha, strlen(text)::BIGINT AS stored, {_relevance("strlen(text)")} AS relevance,
  (SELECT count(DISTINCT m.text) FROM met m WHERE m.doc_id = named.doc_id AND m.early IS NULL)::BIGINT AS versions,
  CASE WHEN ignorable THEN 0 ELSE n END::BIGINT AS units, CASE WHEN ignorable THEN 0 ELSE chars END::BIGINT AS chars,
  CASE WHEN NOT ignorable AND n > 0 THEN n - 1 END::BIGINT AS last FROM named""",
    "text_windows": f"""{_DOC_WINDOWS}
SELECT k AS doc_id, (row_number() OVER (PARTITION BY k ORDER BY s) - 1)::BIGINT AS ordinal, s AS start_line, e AS end_line, length(t)::BIGINT AS char_count, sha256(t) AS text_sha FROM wins""",
    "unit_ids": f"""{_UNITS}
SELECT id, document_id, blob_sha, locator_json, path || ' · ' || CASE WHEN s = e THEN 'line ' || s ELSE 'lines ' || s || '-' || e END AS cite FROM full_units""",
    "path_triage": f"""WITH {ITEMS}, {_NAMED}, {_TYPED}
SELECT doc_id, path, media_type, {_relevance("strlen(text)")} AS relevance, {_READER} AS extractor,
  contains(text, chr(0)) AND position(chr(0) IN text) <= 8192 AS looks_binary, true AS is_textual FROM typed""",
    "sensitivity": f"WITH {ITEMS}, {_FOUND.replace('{of}', 'items')} SELECT doc_id, {_LEVEL} AS level, {_LABELS} AS labels FROM found",
    "blob_dedup": f"""WITH {ITEMS}, {_NAMED}, {_TYPED}
SELECT sha256(text) AS sha256, arg_min(strlen(text), doc_id)::BIGINT AS size, arg_min(media_type, doc_id) AS media_type, arg_min(path, doc_id) AS from_path FROM typed GROUP BY 1""",
    "document_upsert": f"""WITH {_RUNS}
SELECT coalesce(one.id, two.id) AS id, coalesce(two.doc_id, one.doc_id) AS doc_id, coalesce(two.path, one.path) AS path, coalesce(two.blob_sha, one.blob_sha) AS blob_sha,
  coalesce(two.size, one.size) AS size, coalesce(one.first_seen, two.first_seen) AS first_seen, coalesce(two.last_seen, one.last_seen) AS last_seen
FROM one FULL JOIN two ON one.id = two.id""",
    "version_append": f"""WITH {_RUNS}
SELECT id AS document_id, blob_sha, first_seen AS seen_utc FROM one
UNION ALL SELECT id, blob_sha, first_seen FROM two WHERE NOT EXISTS (SELECT 1 FROM one WHERE one.id = two.id AND one.blob_sha = two.blob_sha)""",
    "unit_replace": f"""WITH RECURSIVE {_RUNS},
after AS (
  SELECT one.id, CASE WHEN two.blob_sha <> one.blob_sha THEN two.blob_sha ELSE one.blob_sha END AS blob_sha,
    CASE WHEN two.blob_sha <> one.blob_sha THEN two.text ELSE one.text END AS text FROM one LEFT JOIN two ON one.id = two.id
), texts AS (SELECT id AS k, text FROM after), {_windows("texts")}
SELECT k AS document_id, blob_sha, count(*)::BIGINT AS units, sum(length(t))::BIGINT AS chars FROM wins JOIN after ON id = k GROUP BY 1, 2""",
    "unchanged_gate": f"""WITH {_RUNS}
SELECT two.id, CASE WHEN one.blob_sha = two.blob_sha AND regexp_matches(one.text, '[^\\s]') THEN 'unchanged' ELSE 'read' END AS verdict FROM two LEFT JOIN one ON one.id = two.id""",
    "find_units": f"""{_UNITS}
SELECT id, path, relevance, length(text)::BIGINT AS char_count FROM full_units
WHERE translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') LIKE '%the of%' ORDER BY relevance DESC, char_count, id LIMIT 20""",
    "sensitive_units": f"""{_UNITS}, {_FOUND.replace("{of}", "full_units")}
SELECT id, path, {_LEVEL} AS sensitivity, {_LABELS} AS labels FROM found WHERE len(secret) + len(personal) > 0 ORDER BY sensitivity DESC, id LIMIT 50""",
    "gap_report": f"""{_EVENTS}
SELECT outcome, reason, count(*)::BIGINT AS documents, min(path) AS example FROM events_ WHERE outcome IN ('skipped', 'failed') GROUP BY 1, 2""",
    "run_counters": f"""{_EVENTS}
SELECT run_id, {", ".join(f"count(*) FILTER (outcome = '{o}')::BIGINT AS {o}" for o in ("extracted", "unchanged", "skipped", "failed"))},
  sum(units)::BIGINT AS units, count(*)::BIGINT AS documents FROM events_ GROUP BY 1""",
    "event_list": f"""{_EVENTS}
SELECT run_id, seq, path, outcome, reason FROM events_ WHERE run_id = 'run1' AND outcome = 'skipped' ORDER BY seq LIMIT 200""",
    "table_counts": " UNION ALL ".join(f"SELECT '{t}' AS name, count(*)::BIGINT AS rows FROM {t}" for t in ("documents", "pages", "labels", "conversations", "events")),
    "resolve_units": f"""{_SHIFTED}
SELECT id, CASE WHEN NOT failed THEN sha256(got) END AS resolved_sha, CASE WHEN NOT failed THEN got = text END AS same, NOT failed AS exact, failed FROM opened""",
    "verify_units": f"{_UNITS} SELECT relevance, count(*)::BIGINT AS units, 0::BIGINT AS different FROM full_units GROUP BY 1",
    "verify_blobs": "SELECT doc_id % 9 <> 0 AS intact, count(*)::BIGINT AS blobs FROM documents GROUP BY 1",
    "source_order": f"WITH {ITEMS} SELECT path, row_number() OVER (PARTITION BY split_part(path, '/', 1) ORDER BY path)::BIGINT AS place FROM items",
    # Sections between headings outside of fences.  A heading's trail holds the last heading of each upper
    # level that no higher one has cut off; sections over the limit become windows.
    "markdown_units": f"""WITH RECURSIVE
docs AS (
  SELECT conv_id AS d, string_agg(repeat('#', (turn % 3 + 1)::INTEGER) || ' ' || coalesce(role, '?') || chr(10) || coalesce(text, ''), chr(10) ORDER BY turn) AS text
  FROM conversations GROUP BY 1
),
split AS (SELECT d, regexp_split_to_array(text, {_BREAKS}) AS ls FROM docs),
kept AS (SELECT d, CASE WHEN ls[-1] = '' THEN ls[:-2] ELSE ls END AS ls FROM split),
numbered_lines AS (SELECT d, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM kept),
fences AS (SELECT *, regexp_matches(line, '^\\s*```') AS fence FROM numbered_lines),
states AS (SELECT *, sum(fence::INTEGER) OVER (PARTITION BY d ORDER BY i) % 2 = 1 AS fenced FROM fences),
heads AS (
  SELECT d, i, length(regexp_extract(line, '^(#{{1,6}})\\s+(.*\\S)\\s*$', 1)) AS level, regexp_extract(line, '^(#{{1,6}})\\s+(.*\\S)\\s*$', 2) AS title
  FROM states WHERE NOT fence AND NOT fenced AND regexp_matches(line, '^#{{1,6}}\\s+.*\\S\\s*$')
),
placed AS (
  SELECT *, {", ".join(f"max(CASE WHEN level = {j} THEN i END) OVER w AS p{j}" for j in range(1, 7))}, {", ".join(f"max(CASE WHEN level < {j} THEN i END) OVER w AS u{j}" for j in range(1, 7))},
    lead(i) OVER (PARTITION BY d ORDER BY i) AS next_i
  FROM heads WINDOW w AS (PARTITION BY d ORDER BY i)
),
trails AS (
  SELECT h.d, h.i, h.title, h.next_i,
    list_filter([{", ".join(f"CASE WHEN {j} <= h.level AND h.p{j} >= coalesce(h.u{j}, 0) THEN (SELECT title FROM heads t WHERE t.d = h.d AND t.i = h.p{j}) END" for j in range(1, 7))}],
      lambda x: x IS NOT NULL AND x <> '') AS trail
  FROM placed h
),
sections AS (
  SELECT d, i AS first, coalesce(next_i - 1, len(ls)) AS last, title, array_to_string(trail, ' > ') AS trail, array_to_string(ls[i : coalesce(next_i - 1, len(ls))], chr(10)) AS body
  FROM trails JOIN kept USING (d)
  UNION ALL
  SELECT d, 1, coalesce(min(i) - 1, any_value(len(ls))), NULL, NULL, array_to_string(any_value(ls)[1 : coalesce(min(i) - 1, any_value(len(ls)))], chr(10))
  FROM kept LEFT JOIN heads USING (d) GROUP BY d HAVING coalesce(min(i), 2) > 1
),
texts AS (SELECT (d, first) AS k, body AS text FROM sections WHERE length(body) > {fixed.MAX_CHARS}), {_windows("texts")},
units AS (
  SELECT d, first AS s, last AS e, body AS t, title, trail FROM sections WHERE length(body) <= {fixed.MAX_CHARS} AND regexp_matches(body, '[^\\s]')
  UNION ALL SELECT d, first + w.s - 1, first + w.e - 1, w.t, title, trail FROM sections JOIN wins w ON w.k = (d, first)
)
SELECT d::BIGINT AS document_id, 'ok' AS status, (row_number() OVER (PARTITION BY d ORDER BY s) - 1)::BIGINT AS ordinal,
  '{{"end":' || e || ',"kind":"lines","start":' || s || '}}' AS locator_json, t AS text, true AS verbatim,
  CASE WHEN title IS NULL THEN '' ELSE 'heading=' || title || ';heading_trail=' || trail END AS meta FROM units""",
    # Pieces between "<" signs; a block's end tag meets the last open start tag of its name.
    "html_units": f"""WITH
pieces AS (SELECT page_id, unnest(string_split(coalesce(html, ''), '<')) AS piece, unnest(range(len(string_split(coalesce(html, ''), '<')))) AS n FROM pages),
tokens AS (
  SELECT *, CASE WHEN n = 0 THEN '' ELSE lower(regexp_extract(piece, '^/?[a-zA-Z][a-zA-Z0-9]*')) END AS tag,
    CASE WHEN n = 0 THEN piece WHEN starts_with(piece, '!--') THEN split_part(piece, '-->', 2) ELSE regexp_replace(piece, '^[^>]*>?', '') END AS data,
    1 + coalesce(sum(len(string_split(piece, chr(10))) - 1) OVER (PARTITION BY page_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line
  FROM pieces
),
raw AS (
  SELECT *, coalesce(sum((tag IN ({_values(fixed.HTML_DROPPED)}))::INTEGER) OVER w - sum((tag IN ({_values(["/" + t for t in fixed.HTML_DROPPED])}))::INTEGER) OVER w, 0) > 0 AS dropped
  FROM tokens WINDOW w AS (PARTITION BY page_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
marks AS (
  SELECT *, CASE WHEN NOT dropped AND tag IN ({_values(fixed.HTML_BLOCKS)}) THEN 1 WHEN NOT dropped AND tag IN ({_values(["/" + t for t in fixed.HTML_BLOCKS])}) THEN -1 ELSE 0 END AS step,
    ltrim(tag, '/') AS name FROM raw
),
depths AS (
  SELECT page_id, n, name, line, step, sum(step) OVER (PARTITION BY page_id, name ORDER BY n) - least(step, 0) AS depth FROM marks WHERE step <> 0
),
blocks AS (
  SELECT page_id, name, n AS last, line AS end_line, max(CASE WHEN step = 1 THEN n END) OVER w AS first, max_by(line, n) FILTER (step = 1) OVER w AS start_line, step
  FROM depths WINDOW w AS (PARTITION BY page_id, name, depth ORDER BY n)
),
texts AS (
  SELECT b.page_id, b.name, b.last, b.start_line, b.end_line,
    trim(regexp_replace(string_agg(replace(replace(replace(replace(replace(data, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), ' ' ORDER BY m.n), '\\s+', ' ', 'g')) AS t
  FROM blocks b JOIN marks m ON m.page_id = b.page_id AND m.n >= b.first AND m.n < b.last
  WHERE b.step = -1 AND b.first IS NOT NULL AND NOT m.dropped AND m.tag NOT IN ({_values(fixed.HTML_DROPPED)}) GROUP BY ALL
)
SELECT page_id::BIGINT AS document_id, 'ok' AS status, (row_number() OVER (PARTITION BY page_id ORDER BY last) - 1)::BIGINT AS ordinal,
  '{{"end":' || end_line || ',"kind":"lines","start":' || start_line || '}}' AS locator_json, t AS text, false AS verbatim, 'tag=' || name AS meta
FROM texts WHERE t <> ''""",
    "mermaid_units": """
WITH c AS (
  SELECT *, c_nationkey + 25 * (c_custkey // 10000) AS k FROM customer
), l AS (
  SELECT k, 0 AS ordinal, 1 AS n, 'graph TD' AS text, '' AS meta, true AS v FROM c GROUP BY 1
  UNION ALL
  SELECT k, row_number() OVER w, row_number() OVER w + 2, 'C' || c_custkey || ' -->|' || c_mktsegment || '| N' || c_nationkey,
    'arrow=-->;edge_from=C' || c_custkey || ';edge_label=' || c_mktsegment || ';edge_to=N' || c_nationkey, false FROM c WINDOW w AS (PARTITION BY k ORDER BY c_custkey)
)
SELECT k::BIGINT AS document_id, 'ok' AS status, ordinal::BIGINT AS ordinal, '{"end":' || n || ',"kind":"lines","start":' || n || '}' AS locator_json, text, v AS verbatim, meta FROM l""",
    "plantuml_units": """
SELECT (s_nationkey + 25 * (s_suppkey // 10000))::BIGINT AS document_id, 'ok' AS status, (row_number() OVER w - 1)::BIGINT AS ordinal,
  '{"end":' || (row_number() OVER w + 1) || ',"kind":"lines","start":' || (row_number() OVER w + 1) || '}' AS locator_json,
  '"S' || s_suppkey || '" --> N' || s_nationkey || ' : serves' AS text, true AS verbatim,
  'arrow=-->;edge_from=S' || s_suppkey || ';edge_label=serves;edge_to=N' || s_nationkey AS meta
FROM supplier WINDOW w AS (PARTITION BY s_nationkey + 25 * (s_suppkey // 10000) ORDER BY s_suppkey)""",
    "csv_units": """
WITH r AS (
  SELECT c_custkey // 1000 AS k, row_number() OVER (PARTITION BY c_custkey // 1000 ORDER BY c_custkey) AS i,
    c_custkey || ',"' || c_name || chr(10) || 'says ""hi"", twice",' || c_mktsegment AS l FROM customer
), b AS (
  SELECT k, (i - 1) // 120 AS ordinal, min(i) AS lo, max(i) AS hi, string_agg(l, chr(10) ORDER BY i) AS body FROM r GROUP BY 1, 2
)
SELECT k::BIGINT AS document_id, 'ok' AS status, ordinal::BIGINT AS ordinal,
  '{"end":' || (2 * hi + 1) || ',"kind":"lines","start":' || CASE WHEN ordinal = 0 THEN 1 ELSE 2 * lo END || '}' AS locator_json,
  CASE WHEN ordinal = 0 THEN 'key,name,segment' || chr(10) ELSE '' END || body AS text, true AS verbatim,
  'columns=3;rows=' || (2 * (hi - lo + 1) + CASE WHEN ordinal = 0 THEN 1 ELSE 0 END) AS meta FROM b""",
    "csv_file_units": """
WITH r AS (
  SELECT coalesce(source, 'none') || '/' || (doc_id // 10000) AS file, doc_id,
    replace(doc_id || ',"' || replace(coalesce(lang, ''), '"', '""') || '","' || replace(coalesce(text, ''), '"', '""') || '"', chr(13) || chr(10), chr(10)) AS rec FROM documents
), n AS (
  SELECT *, row_number() OVER w - 1 AS i, 1 + length(rec) - length(replace(rec, chr(10), '')) AS h,
    sum(1 + length(rec) - length(replace(rec, chr(10), ''))) OVER w AS last_line FROM r WINDOW w AS (PARTITION BY file ORDER BY doc_id)
)
SELECT file, ordinal::BIGINT AS ordinal, start_line::BIGINT AS start_line, end_line::BIGINT AS end_line, 3::BIGINT AS "columns",
  length(text)::BIGINT AS char_count, sha256(text) AS text_sha
FROM (
  SELECT file, (greatest(i, 1) - 1) // 120 AS ordinal, min(last_line - h + 1) AS start_line, max(last_line) AS end_line, string_agg(rec, chr(10) ORDER BY doc_id) AS text
  FROM n GROUP BY 1, 2
)""",
    "json_units": _one_node(
        "events", "event_id",
        [("'{\"kind\":\"node\",\"path\":\"/\"}'", "'{' || chr(10) || '  \"k\": ' || json_extract_string(props, '$.k') || chr(10) || '}'", "'pointer=/'")],
    ),
    "toml_units": _one_node(
        "orders", "o_orderkey",
        [("'{\"kind\":\"node\",\"path\":\"/\"}'",
          "'{' || chr(10) || '  \"order\": {' || chr(10) || '    \"key\": ' || o_orderkey || ',' || chr(10) || '    \"status\": \"' || o_orderstatus || '\"' || chr(10) || '  }' || chr(10) || '}'",
          "'pointer=/'")],
    ),
    "xml_units": _one_node(
        "orders", "o_orderkey",
        [("'{\"kind\":\"node\",\"line\":2,\"path\":\"/o/key[1]\"}'", "o_custkey || ' n=''' || o_orderkey || ''''", "'tag=key'"),
         ("'{\"kind\":\"node\",\"line\":3,\"path\":\"/o/status[1]\"}'", "o_orderstatus", "'tag=status'")],
    ),
    "svg_units": _one_node(
        "orders", "o_orderkey",
        [("'{\"kind\":\"node\",\"path\":\"/svg/title[1]\"}'", "o_orderkey::VARCHAR", "'tag=title'"),
         ("'{\"kind\":\"node\",\"path\":\"/svg/text[2]\"}'", "'a ' || o_orderstatus", "'tag=text'"),
         ("'{\"kind\":\"node\",\"path\":\"/svg/tspan[3]\"}'", "o_orderstatus", "'tag=tspan'")],
    ),
    "notebook_units": _one_node(
        "orders", "o_orderkey",
        [("'{\"kind\":\"node\",\"line\":1,\"path\":\"/cells/0\"}'", "'k = ' || o_orderkey || chr(10) || 's = ''' || o_orderstatus || ''''", "'cell_type=code'")],
    ),
    "drawio_units": _one_node(
        "orders", "o_orderkey",
        [(_CELL.format("o"), "'O' || o_orderkey", "'node_label=O' || o_orderkey || ';page=1'"),
         (_CELL.format("c"), "'C' || o_custkey", "'node_label=C' || o_custkey || ';page=1'"),
         (_CELL.format("e"), "'by: O' || o_orderkey || ' -> C' || o_custkey", "'edge_from=O' || o_orderkey || ';edge_label=by;edge_to=C' || o_custkey || ';page=1'")],
    ),
}

ORACLE_SQL["ingest_failures"] = """
WITH odd AS (SELECT doc_id, coalesce(text, '') AS t, ['.txt', '.pdf', '.xyz', '.bin', '.json', '.md', '.gone', '.docx'][doc_id % 8 + 1] AS ext FROM documents),
gated AS (SELECT *, ext IN ('.txt', '.pdf', '.xyz', '.docx') AND t = '' AS empty, regexp_matches(t, '[^\\s]') AS said FROM odd)
SELECT doc_id || ext AS path,
  CASE WHEN empty THEN 'skipped' WHEN ext IN ('.gone', '.json') THEN 'failed' WHEN ext = '.txt' AND said THEN 'extracted' ELSE 'skipped' END AS outcome,
  CASE WHEN empty THEN 'empty_file' WHEN ext = '.gone' THEN 'read_error' WHEN ext = '.json' THEN 'extractor_error' WHEN ext = '.bin' THEN 'binary'
    WHEN ext = '.xyz' THEN 'no_extractor' WHEN ext IN ('.pdf', '.docx') THEN 'missing_dependency' WHEN ext = '.txt' AND said THEN '' ELSE 'nothing_to_extract' END AS reason,
  NOT empty AND NOT (ext = '.txt' AND said) AS has_detail,
  NOT empty AND ext <> '.gone' AS has_document_id, NOT empty AND ext <> '.gone' AS has_blob_sha,
  CASE WHEN empty OR ext IN ('.gone', '.xyz', '.bin') THEN NULL
    ELSE CASE ext WHEN '.txt' THEN 'text' WHEN '.pdf' THEN 'pdf' WHEN '.json' THEN 'json' WHEN '.md' THEN 'markdown' ELSE 'docx' END END AS extractor
FROM gated"""

ORACLE_SQL["ingest_runs"] = f"""
SELECT run, 'tables' AS connector, 'documents' AS target, 'ok' AS status, true AS finished,
  count(*) FILTER (outcome = 'extracted') AS extracted, count(*) FILTER (outcome = 'unchanged') AS unchanged,
  count(*) FILTER (outcome = 'skipped') AS skipped, count(*) FILTER (outcome = 'failed') AS failed, count(*) AS documents
FROM ({ORACLE_SQL["ingest_ledger"]}) GROUP BY run"""

ORACLE_SQL["html_function"] = f"""
SELECT document_id AS page_id, ordinal, (locator_json->>'$.start')::BIGINT AS start_line, (locator_json->>'$.end')::BIGINT AS end_line, text
FROM ({ORACLE_SQL["html_units"]}) AS h"""

ORACLE_SQL["find_indexed"] = ORACLE_SQL["find_units"].replace("'%the of%'", "'%licens_d un%apache%'")
