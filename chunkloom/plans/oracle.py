"""The registered queries restated as SQL for DuckDB, over the same tables.

The code and Markdown rules are restated over one row per token or line with windows, which
is independent of the array expressions the engine uses.
"""

from chunkloom.plans.views import EXTENSIONS, GO_FORMS, PY_FORMS

DIM = 64


def _q(text: str) -> str:
    """A SQL string literal."""
    parts = [f"'{p}'" for p in text.replace("'", "''").split("\n")]
    return "(" + " || chr(10) || ".join(parts).replace("\t", "' || chr(9) || '") + ")"


def _ext(number: str, extensions) -> str:
    names = ", ".join(f"'{e}'" for e in extensions)
    return f"([{names}])[1 + ({number}) % {len(extensions)}]"


def _lines(body: str) -> str:
    return (
        "array_to_string(list_transform(string_split(text, chr(10)), "
        f"lambda x, j: {body}), chr(10))"
    )


def _forms(templates) -> str:
    cases = []
    for k, t in enumerate(templates):
        text = f"replace(replace({_q(t)}, '{{i}}', (j - 1)::VARCHAR), '{{x}}', x)"
        cases.append(f"WHEN (j - 1) % {len(templates)} = {k} THEN {text}")
    return "CASE " + " ".join(cases) + " END"


MD = _lines("CASE WHEN (j - 1) % 3 = 0 THEN '## ' || x ELSE x END")
MD_NUMBERED = _lines(
    "CASE WHEN (j - 1) % 2 = 0 THEN '# s' || ((j - 1) % 3) || chr(10) || x ELSE x END"
)
GO = f"'package p' || chr(10) || {_lines(_forms(GO_FORMS))}"
PY = _lines(_forms(PY_FORMS))

_LANGUAGE = """CASE
  WHEN regexp_matches({p}, '\\.go$') THEN 'go'
  WHEN regexp_matches({p}, '\\.py$') THEN 'python'
  WHEN regexp_matches({p}, '\\.(md|mdx|MDX)$') THEN 'markdown'
  WHEN regexp_matches({p}, '\\.(ts|tsx)$') THEN 'typescript'
  WHEN regexp_matches({p}, '\\.(js|jsx)$') THEN 'javascript'
  WHEN regexp_matches({p}, '\\.rs$') THEN 'rust'
  WHEN regexp_matches({p}, '\\.java$') THEN 'java'
  WHEN regexp_matches({p}, '\\.(cpp|cc|cxx)$') THEN 'cpp'
  WHEN regexp_matches({p}, '\\.(c|h|hpp)$') THEN 'c'
  ELSE 'text' END"""


def _records(content: str, extensions=None) -> str:
    """CTE recs."""
    path = f"'d' || doc_id || {_ext('doc_id', extensions or EXTENSIONS)}"
    return f"""docs AS (
  SELECT *, {path} AS path FROM documents),
langs AS (SELECT *, {_LANGUAGE.format(p="path")} AS language FROM docs),
recs AS (
  SELECT sha256(source || ':' || path) AS id, source AS workspace_id, path, language, lang,
    {content} AS content, doc_id AS seq FROM langs)"""


MIXED = (
    f"CASE language WHEN 'markdown' THEN {MD} WHEN 'go' THEN {GO} "
    f"WHEN 'python' THEN {PY} ELSE text END"
)

_OLD_SNAPSHOT = """old AS (
  SELECT workspace_id, CASE WHEN seq % 4 = 3 THEN 'gone/' || path ELSE path END AS path,
    CASE WHEN seq % 4 = 1 THEN sha256(sha256(content) || 'x') ELSE sha256(content) END
      AS content_hash,
    '2024-01-01 00:00:00' AS updated_at
  FROM recs WHERE seq % 4 <> 2)"""


def _md_chunks(source: str, out: str) -> str:
    """One row per line, a running count of headings, one group per section."""
    return f"""{out}_line AS (
  SELECT path, unnest(parts) AS line, generate_subscripts(parts, 1) AS n
  FROM (SELECT path, string_split(content, chr(10)) AS parts FROM {source})),
{out}_sec AS (
  SELECT *, starts_with(line, '#') AS head,
    sum(CASE WHEN starts_with(line, '#') THEN 1 ELSE 0 END)
      OVER (PARTITION BY path ORDER BY n) AS sec
  FROM {out}_line),
{out}_body AS (
  SELECT path, sec,
    coalesce(max(CASE WHEN head THEN trim(ltrim(line, '#')) END), '_intro') AS symbol,
    coalesce(string_agg(line || chr(10), '' ORDER BY n) FILTER (WHERE NOT head), '') AS content
  FROM {out}_sec GROUP BY path, sec),
{out} AS (
  SELECT path, row_number() OVER (PARTITION BY path ORDER BY sec) - 1 AS chunk_no,
    symbol, 'section' AS symbol_type, content
  FROM {out}_body WHERE trim(content, ' ' || chr(10)) <> '')"""


_GO_TOKEN = (
    r"(?s)`[^`]*`|/\*.*?\*/|//[^\n]*|\"[^\"\\\n]*(?:\\.[^\"\\\n]*)*\"|''[^''\\\n]*(?:\\.[^''\\\n]*)*''"
    r"|\n|[A-Za-z_][A-Za-z0-9_]*|[ \t\r]+|."
).replace('\\"', '"')
_PY_TOKEN = (
    r"(?s)\"{3}.*?\"{3}|''{3}.*?''{3}|#[^\n]*|\"[^\"\\\n]*(?:\\.[^\"\\\n]*)*\"|''[^''\\\n]*(?:\\.[^''\\\n]*)*''"
    r"|\\\n|\n|[A-Za-z_][A-Za-z0-9_]*|[ \t\r]+|."
).replace('\\"', '"')


def _tokens(source: str, out: str, pattern: str, blank: str) -> str:
    """CTE <out>_run: tokens with bracket depth, line and whether they are significant."""
    return f"""{out}_tok AS (
  SELECT path, unnest(parts) AS t, generate_subscripts(parts, 1) AS n
  FROM (SELECT path, regexp_extract_all(content, '{pattern}') AS parts FROM {source})),
{out}_pos AS (
  SELECT *, CASE WHEN t IN ('(', '[', '{{') THEN 1 WHEN t IN (')', ']', '}}') THEN -1 ELSE 0 END
      AS d,
    length(t) - length(replace(t, chr(10), '')) AS nl, NOT ({blank}) AS sig
  FROM {out}_tok),
{out}_run AS (
  SELECT *, coalesce(sum(d) OVER w, 0) AS depth, coalesce(sum(nl) OVER w, 0) AS line,
    lag(t) OVER (PARTITION BY path ORDER BY n) AS raw_before
  FROM {out}_pos
  WINDOW w AS (PARTITION BY path ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def _go_chunks(source: str, out: str) -> str:
    blank = (
        "regexp_full_match(t, '[ \\t\\r\\n]+') OR starts_with(t, '//') OR starts_with(t, '/*')"
    )
    ended = """(pt = ';' OR (line > pend AND regexp_matches(pt, '^[A-Za-z0-9_"`'')}\\]]')))"""
    return f"""{_tokens(source, out, _GO_TOKEN, blank)},
{out}_sig AS (
  SELECT *, lag(t) OVER v AS pt, lag(line + nl) OVER v AS pend
  FROM {out}_run WHERE sig WINDOW v AS (PARTITION BY path ORDER BY n)),
{out}_decl AS (
  SELECT *, sum(CASE WHEN depth = 0 AND (pt IS NULL OR {ended}) THEN 1 ELSE 0 END)
    OVER (PARTITION BY path ORDER BY n) AS decl FROM {out}_sig),
{out}_rank AS (
  SELECT *, row_number() OVER (PARTITION BY path, decl ORDER BY n) AS k FROM {out}_decl),
{out}_head AS (
  SELECT path, decl, max(CASE WHEN k = 1 THEN t END) AS kw,
    coalesce(max(CASE WHEN k = 2 THEN t END) = '(', false) AS paren
  FROM {out}_rank GROUP BY path, decl),
{out}_in AS (
  SELECT r.*, h.kw, h.paren FROM {out}_rank r JOIN {out}_head h USING (path, decl)
  WHERE h.kw IN ('func', 'type', 'var', 'const')),
{out}_spec AS (
  SELECT *, CASE WHEN kw = 'func' OR NOT paren THEN 1 ELSE
    sum(CASE WHEN depth = 1 AND t <> ')' AND (pt = '(' OR {ended}) THEN 1 ELSE 0 END)
      OVER (PARTITION BY path, decl ORDER BY n) END AS spec
  FROM {out}_in
  WHERE kw = 'func' OR (NOT paren AND k > 1) OR (paren AND depth >= 1 AND NOT
    (t = ')' AND depth = 1))),
{out}_unit AS (
  SELECT path, decl, spec, kw, min(line) AS first_line, max(line + nl) AS last_line,
    string_agg(t, ' ' ORDER BY n) AS words
  FROM {out}_spec GROUP BY path, decl, spec, kw),
{out}_named AS (
  SELECT *, CASE
    WHEN kw = 'func' AND starts_with(words, 'func (') THEN [
      regexp_extract(words, '^func \\( (?:\\w+ )?(?:\\* )?(\\w+) \\)', 1) || '.' ||
      regexp_extract(words, '^func \\([^)]*\\) (\\w+)', 1)]
    WHEN kw = 'func' THEN [regexp_extract(words, '^func (\\w+)', 1)]
    WHEN kw = 'type' THEN [regexp_extract(words, '^(\\w+)', 1)]
    ELSE string_split(regexp_extract(words, '^\\w+(?: , \\w+)*', 0), ' , ') END AS names,
    CASE WHEN kw = 'func' AND starts_with(words, 'func (') THEN 'method' ELSE kw END AS kind
  FROM {out}_unit),
{out}_flat AS (
  SELECT path, decl, spec, kind, first_line, last_line, unnest(names) AS symbol,
    generate_subscripts(names, 1) AS name_no FROM {out}_named),
{out} AS (
  SELECT path, row_number() OVER (PARTITION BY path ORDER BY decl, spec, name_no) - 1 AS chunk_no,
    symbol, kind AS symbol_type,
    array_to_string(list_slice(string_split(content, chr(10)), (first_line + 1)::BIGINT,
      (last_line + 1)::BIGINT), chr(10)) AS content
  FROM {out}_flat JOIN {source} USING (path))"""


def _py_chunks(source: str, out: str) -> str:
    blank = (
        "regexp_full_match(t, '[ \\t\\r\\n]+') OR starts_with(t, '#') OR t = chr(92) || chr(10)"
    )
    return f"""{_tokens(source, out, _PY_TOKEN, blank)},
{out}_stmt AS (
  SELECT *, sum(CASE WHEN sig AND depth = 0 AND (raw_before IS NULL OR raw_before = chr(10))
    THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY n) AS stmt FROM {out}_run),
{out}_rank AS (
  SELECT path, stmt, t, n, row_number() OVER (PARTITION BY path, stmt ORDER BY n) AS k
  FROM {out}_stmt WHERE sig),
{out}_head AS (
  SELECT path, stmt, max(CASE WHEN k = 1 THEN t END) AS t1, max(CASE WHEN k = 2 THEN t END) AS t2,
    max(CASE WHEN k = 3 THEN t END) AS t3, min(n) AS n_first, max(n) AS n_last
  FROM {out}_rank GROUP BY path, stmt),
{out}_def AS (
  SELECT *, lag(t1) OVER (PARTITION BY path ORDER BY stmt) AS before FROM {out}_head),
{out}_keep AS (
  SELECT path, stmt, n_first, n_last, CASE WHEN t1 = 'async' THEN t3 ELSE t2 END AS symbol,
    CASE WHEN t1 = 'class' THEN 'class' ELSE 'func' END AS symbol_type
  FROM {out}_def WHERE (t1 IN ('def', 'class') OR (t1 = 'async' AND t2 = 'def'))
    AND before IS DISTINCT FROM '@'),
{out}_last AS (
  SELECT path, stmt, max(line + nl) AS last_line FROM {out}_stmt
  JOIN {out}_keep USING (path, stmt) WHERE n <= n_last GROUP BY path, stmt),
{out}_tail AS (
  SELECT s.path, s.stmt, s.n,
    s.line = l.last_line OR (s.raw_before <> chr(10) AND length(s.raw_before) >= 4) AS belongs
  FROM {out}_stmt s JOIN {out}_keep k USING (path, stmt) JOIN {out}_last l USING (path, stmt)
  WHERE s.n > k.n_last AND starts_with(s.t, '#')),
{out}_stop AS (
  SELECT path, stmt, min(n) AS n_stop FROM {out}_tail WHERE NOT belongs GROUP BY path, stmt),
{out}_end AS (
  SELECT k.path, k.stmt, greatest(k.n_last, coalesce(max(t.n), 0)) AS n_end
  FROM {out}_keep k LEFT JOIN {out}_stop x USING (path, stmt)
  LEFT JOIN {out}_tail t ON t.path = k.path AND t.stmt = k.stmt AND t.belongs
    AND (x.n_stop IS NULL OR t.n < x.n_stop)
  GROUP BY k.path, k.stmt, k.n_last),
{out}_text AS (
  SELECT s.path, s.stmt, string_agg(s.t, '' ORDER BY s.n) AS content
  FROM {out}_stmt s JOIN {out}_keep k USING (path, stmt) JOIN {out}_end e USING (path, stmt)
  WHERE s.n BETWEEN k.n_first AND e.n_end GROUP BY s.path, s.stmt),
{out} AS (
  SELECT path, row_number() OVER (PARTITION BY path ORDER BY stmt) - 1 AS chunk_no,
    symbol, symbol_type, content
  FROM {out}_keep JOIN {out}_text USING (path, stmt))"""


def _fanned(source: str) -> str:
    """CTE fanned: all branches of the fan-out over <source> (with column deleted)."""
    return f"""md_in AS (SELECT * FROM {source} WHERE language = 'markdown' AND NOT deleted),
go_in AS (SELECT * FROM {source} WHERE language = 'go' AND NOT deleted),
py_in AS (SELECT * FROM {source} WHERE language = 'python' AND NOT deleted),
{_md_chunks("md_in", "mdc")},
{_go_chunks("go_in", "goc")},
{_py_chunks("py_in", "pyc")},
chunks AS (SELECT * FROM mdc UNION ALL SELECT * FROM goc UNION ALL SELECT * FROM pyc),
fanned AS (
  SELECT s.workspace_id, s.path, s.seq, s.language, s.id AS file_id, c.chunk_no,
    s.id || '#' || c.symbol AS id, c.symbol, c.symbol_type, c.content, 'upsert' AS action
  FROM chunks c JOIN {source} s USING (path)
  UNION ALL
  SELECT workspace_id, path, seq, language, id, 0, id,
    CASE WHEN deleted OR language NOT IN ('markdown', 'go', 'python') THEN ''
      WHEN language = 'markdown' THEN '_doc' ELSE '_file' END,
    CASE WHEN deleted OR language NOT IN ('markdown', 'go', 'python') THEN ''
      WHEN language = 'markdown' THEN 'section' ELSE 'file' END,
    content, CASE WHEN deleted THEN 'delete' ELSE 'upsert' END
  FROM {source} WHERE path NOT IN (SELECT path FROM chunks))"""


def _vectors(source: str, key: str) -> str:
    """CTE vec (key, vector): hashed word counts of <source>.content, scaled to length 1."""
    return f"""words AS (
  SELECT {key}, unnest(regexp_extract_all(lower(content), '[\\p{{L}}\\p{{N}}_]+')) AS w
  FROM {source}),
counts AS (
  SELECT {key}, ('0x' || substr(sha256(w), 1, 8))::UBIGINT % {DIM} AS b, count(*) AS c
  FROM words GROUP BY ALL),
norms AS (SELECT {key}, sqrt(sum(c * c)::DOUBLE) AS norm FROM counts GROUP BY ALL),
grid AS (SELECT {key}, b FROM (SELECT DISTINCT {key} FROM {source}), range({DIM}) r(b)),
vec AS (
  SELECT {key}, string_agg(
    floor(coalesce((c::DOUBLE / norm)::FLOAT, 0)::DOUBLE * 1e6 + 0.5)::BIGINT::VARCHAR,
    ',' ORDER BY b) AS vector
  FROM grid LEFT JOIN counts USING ({key}, b) LEFT JOIN norms USING ({key}) GROUP BY {key})"""


_LOG = """log AS (
  SELECT sha256('w:u' || user_id) || '#s' || (event_id % 3) AS id, 'w' AS workspace_id,
    'u' || user_id AS path, 's' || (event_id % 3) AS symbol,
    CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS content,
    sha256(event_type) AS content_hash,
    CASE WHEN event_type <> 'view' THEN floor(value::FLOAT::DOUBLE * 1e6 + 0.5)::BIGINT || ',' ||
      floor((user_id % 100)::FLOAT::DOUBLE * 1e6 + 0.5)::BIGINT END AS vector,
    '{"props":"' || (event_id % 7) || '"}' AS metadata,
    event_type = 'error' AS deleted, event_id AS seq
  FROM events),
users AS (SELECT DISTINCT user_id FROM events),
known AS (
  SELECT 'u' || user_id AS path, sha256('click') AS content_hash FROM users
  WHERE user_id % 3 = 0),
base AS (
  SELECT 'w' AS workspace_id, 'u' || user_id AS path, symbol, 'old' AS content,
    sha256('old') AS content_hash, '{}' AS metadata, NULL::VARCHAR AS vector,
    CASE WHEN symbol <> 's0' THEN '2024-01-01 00:00:00' END AS created_at,
    '2024-01-01 00:00:00' AS updated_at,
    sha256('w:u' || user_id) || '#' || symbol AS id
  FROM users, (VALUES ('s0'), ('s1'), ('s9')) v(symbol) WHERE user_id % 2 = 0)"""

_PAYLOAD = (
    """'{"workspace_id":"w","file_path":"' || path || '","symbol":"' || symbol || """
    """'","symbol_type":"section","language":"text","content_hash":"' || content_hash || '"'"""
)


def _dedup(compared: str, kept: str) -> str:
    return f"""WITH {_LOG},
seen AS (
  SELECT path, -1 AS seq, content_hash AS h, false AS deleted FROM known
  UNION ALL
  SELECT path, seq, CASE WHEN NOT deleted THEN content_hash END, deleted FROM log
  WHERE {compared}),
lagged AS (SELECT *, lag(h) OVER (PARTITION BY path ORDER BY seq) AS p FROM seen)
{kept}"""


_PASSING = "(deleted OR h IS DISTINCT FROM p) AND seq >= 0"
_DEDUP = _dedup(
    "true",
    f"""SELECT path, seq, CASE WHEN deleted THEN 'delete' ELSE 'upsert' END AS action
FROM lagged WHERE {_PASSING}""",
)
_DEDUP_STRICT = _dedup(
    "NOT deleted",
    f"""SELECT path, seq, 'upsert' AS action FROM lagged WHERE {_PASSING}
UNION ALL SELECT path, seq, 'delete' FROM log WHERE deleted""",
)


# Each symbol of a user as a file of its own.
_BY_SYMBOL = "(SELECT * REPLACE (path || '/' || symbol AS path) FROM {})"


def _replay(which: str, base: str = "base", log: str = "log") -> str:
    return f"""WITH {_LOG},
part AS (SELECT * FROM {log} WHERE {which}),
del AS (SELECT path, max(seq) AS last FROM part WHERE deleted GROUP BY path),
ups AS (
  SELECT p.*, row_number() OVER (PARTITION BY p.path, symbol ORDER BY seq DESC) AS r
  FROM part p LEFT JOIN del d ON d.path = p.path
  WHERE NOT deleted AND (last IS NULL OR seq > last)),
live AS (SELECT b.* FROM {base} b WHERE path NOT IN (SELECT path FROM del))
SELECT 'w' AS workspace_id, u.path, u.symbol, u.content, u.content_hash, u.metadata, u.vector,
  l.created_at, '2024-06-01 00:00:00' AS updated_at
FROM ups u LEFT JOIN live l ON l.path = u.path AND l.symbol = u.symbol WHERE r = 1
UNION ALL
SELECT workspace_id, path, symbol, content, content_hash, metadata, vector, created_at, updated_at
FROM live l WHERE NOT EXISTS (
  SELECT 1 FROM ups u WHERE u.path = l.path AND u.symbol = l.symbol)"""


def _points(which: str, base: str = "base", log: str = "log") -> str:
    return f"""WITH {_LOG},
part AS (SELECT * FROM {log} WHERE ({which}) AND (deleted OR vector IS NOT NULL)),
del AS (SELECT path, max(seq) AS last FROM part WHERE deleted GROUP BY path),
ups AS (
  SELECT p.*, row_number() OVER (PARTITION BY p.id ORDER BY seq DESC) AS r
  FROM part p LEFT JOIN del d ON d.path = p.path
  WHERE NOT deleted AND (last IS NULL OR seq > last))
SELECT id, path, vector, {_PAYLOAD} || ',"content":"' || content || '"}}' AS payload
FROM ups WHERE r = 1
UNION ALL
SELECT id, path, '1000000,0', '{{}}' FROM {base}
WHERE path NOT IN (SELECT path FROM del) AND id NOT IN (SELECT id FROM ups)"""


def _with_errors() -> str:
    return f"""WITH {_records(MD, [".md"])},
flagged AS (SELECT *, seq % 10 = 9 AS deleted FROM recs),
md_in AS (SELECT * FROM flagged WHERE NOT deleted),
{_md_chunks("md_in", "mdc")},
rows AS (
  SELECT r.path, r.seq, c.chunk_no, r.id || '#' || c.symbol AS id, c.symbol, c.content,
    false AS deleted, true AS chunked
  FROM mdc c JOIN flagged r USING (path)
  UNION ALL
  SELECT path, seq, 0, id, CASE WHEN deleted THEN '' ELSE '_doc' END, content, deleted, false
  FROM flagged WHERE path NOT IN (SELECT path FROM mdc)),
marked AS (
  SELECT *, CASE WHEN deleted THEN NULL WHEN length(content) > 300 THEN 'TextTooLong'
      WHEN symbol = '' THEN 'EmptyName' END AS error_type,
    CASE WHEN length(content) > 300 THEN 'embed' ELSE 'fan_out' END AS stage
  FROM rows)"""


_OBJECT_KEYS = """keys AS (
  SELECT page_id, regexp_replace(url, '^https?://', '') AS key FROM pages),
prefixed AS (
  SELECT page_id, key, CASE page_id % 4 WHEN 0 THEN string_split(key, '/')[1]
    WHEN 1 THEN string_split(key, '/')[1] || '/' WHEN 2 THEN string_split(key, '.')[1]
    ELSE 'elsewhere/' END AS prefix FROM keys)"""

_PLAIN = f"WITH {_records('text')}"
_DOC_PATH = f"'f' || doc_id || {_ext('doc_id', EXTENSIONS)}"

ORACLE = {
    "record_scan": f"""WITH f AS (
  SELECT text, source AS folder, doc_id,
    CASE doc_id % 5 WHEN 0 THEN '__d' WHEN 1 THEN '.d' ELSE 'd' END || doc_id ||
      {_ext("doc_id", EXTENSIONS)} AS name
  FROM documents),
g AS (SELECT text, folder || '/' || name AS path FROM f
  WHERE doc_id % 11 <> 0 AND regexp_matches(lower(name), '\\.(md|mdx|go|py|ts|rs)$'))
SELECT sha256('tree:' || path) AS id, 'tree' AS workspace_id, path,
  {_LANGUAGE.format(p="path")} AS language, sha256(text) AS content_hash, 'upsert' AS action,
  length(text)::INTEGER AS n_chars, true AS same_hash
FROM g""",
    "relative_path": f"""WITH {_OBJECT_KEYS},
cut AS (SELECT *, CASE WHEN starts_with(key, prefix) THEN substr(key, length(prefix) + 1)
  ELSE key END AS rest FROM prefixed)
SELECT page_id, key, prefix, CASE WHEN starts_with(rest, '/') THEN substr(rest, 2) ELSE rest END
  AS path FROM cut""",
    "ext_filter": f"""WITH f AS (SELECT {_DOC_PATH} AS path FROM documents)
SELECT path FROM f WHERE regexp_matches(lower(path), '\\.(md|mdx|go|py|ts|rs)$')""",
    "hidden_prune": f"""WITH f AS (SELECT
  {_ext("doc_id", ["a/", ".git/", "a/.b/", "_p/", ".", "a/.", ""])} || {_DOC_PATH} AS path
  FROM documents)
SELECT path FROM f WHERE len(list_filter(string_split(path, '/')[:-2],
  lambda part: starts_with(part, '.'))) = 0""",
    "language_tag": f"""WITH f AS (SELECT 'f' || doc_id || {_ext("doc_id", [
        ".go", ".py", ".md", ".MDX", ".ts", ".tsx", ".js", ".jsx", ".rs", ".java", ".cpp", ".cc",
        ".cxx", ".c", ".h", ".hpp", ".txt", ""])} AS path FROM documents)
SELECT path, {_LANGUAGE.format(p="path")} AS language FROM f""",
    "record_id": f"""SELECT {_DOC_PATH} AS path, sha256(source || ':' || {_DOC_PATH}) AS id
FROM documents""",
    "origin_metadata": f"""WITH {_OBJECT_KEYS}
SELECT page_id, CASE page_id % 3
  WHEN 0 THEN '{{"bucket":"b1","s3_key":"' || key || '"}}'
  WHEN 1 THEN '{{"blob_name":"' || key || '","container":"c1"}}' ELSE '{{}}' END AS metadata
FROM keys""",
    "content_hash": "SELECT doc_id, sha256(text) AS content_hash FROM documents",
    "dedup_snapshot": f"""{_PLAIN}, {_OLD_SNAPSHOT}
SELECT r.workspace_id, r.path, sha256(r.content) AS content_hash
FROM recs r LEFT JOIN old o ON o.workspace_id = r.workspace_id AND o.path = r.path
WHERE o.content_hash IS DISTINCT FROM sha256(r.content)""",
    "dedup_sequence": f"""WITH {_LOG},
lagged AS (SELECT *, lag(content_hash) OVER (PARTITION BY path ORDER BY seq) AS p
  FROM log WHERE NOT deleted)
SELECT path, seq, content_hash FROM lagged WHERE p IS DISTINCT FROM content_hash""",
    "dedup_sequence_hot": f"""WITH {_LOG},
clocked AS (SELECT CASE WHEN seq % 2 = 0 THEN 'hot' ELSE path END AS path, content_hash,
    seq * 1000000007 + 1700000000000000000 AS seq FROM log WHERE NOT deleted),
lagged AS (SELECT *, lag(content_hash) OVER (PARTITION BY path ORDER BY seq) AS p FROM clocked)
SELECT path, seq, content_hash FROM lagged WHERE p IS DISTINCT FROM content_hash""",
    "dedup_with_deletes": _DEDUP,
    "dedup_with_deletes_strict": _DEDUP_STRICT,
    "snapshot_load": f"""{_PLAIN}, {_OLD_SNAPSHOT}
SELECT path, content_hash FROM old WHERE workspace_id = 'src3'""",
    "snapshot_upsert": f"""{_PLAIN}, {_OLD_SNAPSHOT}
SELECT workspace_id, path, sha256(content) AS content_hash, '2024-06-01 00:00:00' AS updated_at
FROM recs
UNION ALL
SELECT * FROM old WHERE (workspace_id, path) NOT IN (SELECT (workspace_id, path) FROM recs)""",
    "snapshot_delete": f"""{_PLAIN}, {_OLD_SNAPSHOT}
SELECT workspace_id, path, content_hash FROM old
WHERE (workspace_id, path) NOT IN (SELECT (workspace_id, path) FROM recs WHERE seq % 3 = 0)""",
    "tombstones": f"""{_PLAIN}, {_OLD_SNAPSHOT}
SELECT workspace_id, path, 'delete' AS action FROM old
WHERE (workspace_id, path) NOT IN (SELECT (workspace_id, path) FROM recs)""",
    "markdown_sections": f"""WITH {_records(MD, [".md"])}, {_md_chunks("recs", "mdc")}
SELECT path, chunk_no, symbol, symbol_type, content FROM mdc""",
    "go_symbols": f"""WITH {_records(GO, [".go"])}, {_go_chunks("recs", "goc")}
SELECT path, chunk_no, symbol, symbol_type, content FROM goc""",
    "python_symbols": f"""WITH {_records(PY, [".py"])}, {_py_chunks("recs", "pyc")}
SELECT path, chunk_no, symbol, symbol_type, content FROM pyc""",
    "fanout_mixed": f"""WITH {_records(MIXED)},
flagged AS (SELECT *, seq % 10 = 9 AS deleted FROM recs),
{_fanned("flagged")}
SELECT path, chunk_no, id, symbol, symbol_type, language, sha256(content) AS content_hash, action
FROM fanned""",
    "whole_file_fallback": f"""WITH {_records("text", [".go", ".py", ".md"])},
shaped AS (SELECT id, path, language, CASE
    WHEN language = 'markdown' AND seq % 2 = 0 THEN '#' || replace(content, chr(10), chr(10) || '#')
    WHEN language = 'go' AND seq % 2 = 0 THEN 'package p' || chr(10) || chr(10) || 'import "x"' ||
      chr(10) || '// ' || replace(content, chr(10), chr(10) || '// ')
    ELSE content END AS content, seq FROM recs)
SELECT id, path, CASE language WHEN 'markdown' THEN '_doc' ELSE '_file' END AS symbol,
  CASE language WHEN 'markdown' THEN 'section' ELSE 'file' END AS symbol_type,
  sha256(content) AS content_hash
FROM shaped WHERE language <> 'markdown' OR seq % 2 = 0 OR NOT EXISTS (
  SELECT 1 FROM (SELECT unnest(string_split(shaped.content, chr(10))) AS line) l
  WHERE NOT starts_with(line, '#') AND trim(line) <> '')""",
    "chunk_identity": f"""WITH {_records(MD, [".md"])}, {_md_chunks("recs", "mdc")}
SELECT r.id AS file_id, r.id || '#' || c.symbol AS id, c.chunk_no, c.symbol,
  'markdown' AS language, sha256(c.content) AS content_hash, 'upsert' AS action,
  CASE WHEN r.seq % 2 = 0 THEN '{{"lang":"' || r.lang || '"}}' ELSE '{{}}' END AS metadata,
  true AS no_vector
FROM mdc c JOIN recs r USING (path)
UNION ALL
SELECT id, id, 0, '_doc', 'markdown', sha256(content), 'upsert',
  CASE WHEN seq % 2 = 0 THEN '{{"lang":"' || lang || '"}}' ELSE '{{}}' END, true
FROM recs WHERE path NOT IN (SELECT path FROM mdc)""",
    "symbol_collisions": f"""WITH {_records(MD_NUMBERED, [".md"])}, {_md_chunks("recs", "mdc")}
SELECT r.workspace_id, path, symbol, count(*) AS copies FROM mdc JOIN recs r USING (path)
GROUP BY ALL HAVING count(*) > 1""",
    "chunk_upsert": _replay("NOT deleted"),
    "chunk_delete_by_file": _replay("deleted", _BY_SYMBOL.format("base"), _BY_SYMBOL.format("log")),
    "log_replay": _replay("true"),
    "replay_null_and_ties": f"""WITH {_LOG},
part AS (SELECT * REPLACE (CASE WHEN seq % 5 <> 0 THEN seq // 4 END AS seq) FROM log),
del AS (SELECT path, max(seq) AS last, true AS gone FROM part WHERE deleted GROUP BY path),
ups AS (
  SELECT p.*, row_number() OVER (
    PARTITION BY p.path, symbol ORDER BY seq DESC NULLS LAST, content_hash DESC) AS r
  FROM part p LEFT JOIN del d ON d.path = p.path
  WHERE NOT deleted AND (gone IS NULL OR seq > last OR (last IS NULL AND seq IS NOT NULL))),
live AS (SELECT * FROM base WHERE path NOT IN (SELECT path FROM del))
SELECT 'w' AS workspace_id, u.path, u.symbol, u.content, u.content_hash, l.created_at
FROM ups u LEFT JOIN live l ON l.path = u.path AND l.symbol = u.symbol WHERE r = 1
UNION ALL
SELECT workspace_id, path, symbol, content, content_hash, created_at
FROM live l WHERE NOT EXISTS (
  SELECT 1 FROM ups u WHERE u.path = l.path AND u.symbol = l.symbol)""",
    "vector_points": _points("true"),
    "vector_delete": _points("deleted", _BY_SYMBOL.format("base"), _BY_SYMBOL.format("log")),
    "point_payload": f"""WITH {_LOG}
SELECT seq, id, {_PAYLOAD} || ',"content":"' || content || '"}}' AS payload
FROM log WHERE NOT deleted""",
    "memory_append": f"""WITH {_LOG}
SELECT content, {_PAYLOAD} || ',"source":"chunkloom"}}' AS metadata FROM log WHERE NOT deleted""",
    "fanout_counts": f"""WITH {_LOG},
del AS (SELECT path, max(seq) AS last FROM log WHERE deleted GROUP BY path),
live AS (SELECT l.* FROM log l LEFT JOIN del d ON d.path = l.path
  WHERE NOT deleted AND (last IS NULL OR seq > last))
SELECT 'chunks' AS sink, count(DISTINCT id) AS stored FROM live
UNION ALL SELECT 'points', count(DISTINCT id) FROM live WHERE vector IS NOT NULL
UNION ALL SELECT 'memories', count(*) FROM log WHERE NOT deleted""",
    "embed_chunks": f"""{_PLAIN}, {_vectors("recs", "path")}
SELECT path, vector FROM vec""",
    "embed_passthrough": f"""{_PLAIN}
SELECT path, CASE seq % 4 WHEN 0 THEN 2 WHEN 3 THEN {DIM} ELSE 0 END::INTEGER AS dim,
  CASE seq % 4 WHEN 0 THEN true WHEN 3 THEN false END AS kept FROM recs""",
    "workspace_index": f"""WITH {_records(MIXED)}, {_OLD_SNAPSHOT},
changed AS (
  SELECT r.*, false AS deleted FROM recs r
  LEFT JOIN old o ON o.workspace_id = r.workspace_id AND o.path = r.path
  WHERE o.content_hash IS DISTINCT FROM sha256(r.content)),
{_fanned("changed")},
keyed AS (SELECT *, path || '/' || chunk_no AS k FROM fanned),
{_vectors("keyed", "k")}
SELECT workspace_id, path, chunk_no, id, symbol, symbol_type, language,
  sha256(content) AS content_hash, vector FROM keyed JOIN vec USING (k)""",
    "file_quarantine": f"""{_with_errors()}
SELECT path, chunk_no, id, sha256(content) AS content_hash FROM marked
WHERE path NOT IN (SELECT path FROM marked WHERE error_type IS NOT NULL)""",
    "errors_by_stage": f"""{_with_errors()}
SELECT stage, error_type, count(*) AS errors FROM marked WHERE error_type IS NOT NULL
GROUP BY ALL""",
    "flow_stats": f"""{_with_errors()},
part AS (SELECT * FROM marked WHERE seq % 4 <> 0 OR deleted)
SELECT (SELECT count(*) FROM documents) AS records_in,
  count(*) FILTER (WHERE path NOT IN (SELECT path FROM part WHERE error_type IS NOT NULL))
    AS records_out,
  (SELECT count(*) FROM documents) - count(*) FILTER (WHERE chunk_no = 0) AS records_skipped,
  count(*) FILTER (WHERE deleted) AS records_deleted,
  count(error_type) AS records_failed
FROM part""",
    "job_rollup": """WITH ev AS (
  SELECT 'j' || user_id AS job_id, 'w' || (user_id % 5) AS workspace_id, event_id AS seq, ts,
    CASE event_type WHEN 'signup' THEN 'created' WHEN 'purchase' THEN 'done'
      WHEN 'error' THEN 'failed' ELSE 'status' END AS kind,
    (['running', 'done', 'failed'])[1 + event_id % 3] AS status,
    CASE WHEN event_id % 3 = 2 THEN props ELSE '' END AS error_msg, user_id % 10 AS total
  FROM events)
SELECT job_id, workspace_id,
  coalesce(arg_max(status, seq) FILTER (WHERE kind = 'status'), 'queued') AS status,
  max(total) AS total_files,
  count(*) FILTER (WHERE kind = 'done') AS done, count(*) FILTER (WHERE kind = 'failed') AS failed,
  coalesce(arg_max(error_msg, seq) FILTER (WHERE kind = 'status'), '') AS error_msg,
  min(ts) FILTER (WHERE kind = 'created') AS created_at,
  max(ts) FILTER (WHERE kind IN ('created', 'status')) AS updated_at
FROM ev GROUP BY job_id, workspace_id HAVING count(*) FILTER (WHERE kind = 'created') > 0""",
    "dedup_stream": f"SELECT path, seq FROM ({_DEDUP})",
    "replay_stream": _replay("true", "(SELECT * FROM base WHERE false)"),
}
