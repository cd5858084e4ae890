"""DuckDB statements that compute, independently of Spark, what each registered query must return.

The adapters of ``quire.plans.adapters`` are restated here as CTEs over the driver views, then each query's rules are
written in plain SQL. Column names equal the Spark query's.
"""

from __future__ import annotations

from quire.plans import adapters as A


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _catpath(m: str) -> str:
    return (
        f"('/volume1/share' || CAST(({m}) % 20 AS VARCHAR) || '/' || "
        f"CASE WHEN ({m}) % 23 = 0 THEN '~$' ELSE '' END || 'doc' || CAST({m} AS VARCHAR) || '.' || "
        f"{_list(A.CATALOGUE_EXTS)}[({m}) % 8 + 1])"
    )


M = "CASE WHEN doc_id % 41 = 8 THEN doc_id - 8 ELSE doc_id END"

NAS_FILES = f"""
nas_files AS (
  SELECT doc_id AS id,
         CASE WHEN doc_id % 97 = 5 THEN CASE WHEN doc_id % 2 = 0 THEN NULL ELSE '  ' END
              ELSE {_catpath(M)} END AS full_path,
         CASE WHEN doc_id % 10 = 9 THEN 1 ELSE 3 END AS status
  FROM documents
)"""

INVENTORY = f"""
inventory AS (
  SELECT CASE WHEN doc_id % 3 = 0 THEN {_catpath('doc_id')}
              WHEN doc_id % 3 = 1 THEN '/' || substr({_catpath('doc_id')}, 10)
              ELSE substr({_catpath('doc_id')}, 10) END AS path,
         CAST(strlen(text) AS BIGINT) AS length,
         encode(text) AS content
  FROM documents WHERE doc_id % 13 <> 0
)"""

REGISTRY = f"""
registry AS (
  SELECT doc_id AS id,
         'doc' || CAST(doc_id AS VARCHAR) || '.' || {_list(A.REGISTRY_EXTS)}[doc_id % 8 + 1] AS file_name,
         {_list(A.REGISTRY_EXTS)}[doc_id % 8 + 1] AS file_ext,
         CAST(strlen(text) AS BIGINT) AS file_size,
         md5(CASE WHEN doc_id % 29 = 0 THEN {_catpath(M)}
                  ELSE '/archive/' || source || '/doc' || CAST(doc_id AS VARCHAR) || '.'
                       || {_list(A.REGISTRY_EXTS)}[doc_id % 8 + 1] END) AS file_uid,
         CASE WHEN doc_id % 31 = 0 THEN sha256(text) ELSE sha256(text || '#v0') END AS file_hash,
         CASE WHEN doc_id % 29 = 0 THEN {_catpath(M)}
              ELSE '/archive/' || source || '/doc' || CAST(doc_id AS VARCHAR) || '.'
                   || {_list(A.REGISTRY_EXTS)}[doc_id % 8 + 1] END AS original_path,
         CASE WHEN doc_id % 17 = 0 THEN CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE ' ' END
              WHEN doc_id % 7 = 2 THEN '{A.MD_ROOT}/../x/doc' || CAST(doc_id AS VARCHAR) || '.md'
              WHEN doc_id % 11 = 4 THEN '{A.MD_ROOT}/doc' || CAST(doc_id AS VARCHAR) || '.txt'
              WHEN doc_id % 5 = 3 THEN 'doc' || CAST(doc_id AS VARCHAR) || '.markdown'
              ELSE '{A.MD_ROOT}/doc' || CAST(doc_id AS VARCHAR) || '.md' END AS parse_path,
         CAST({_list(A.STATES)}[doc_id % 4 + 1] AS TINYINT) AS parse_status,
         CAST({_list(A.STATES)}[(doc_id // 4) % 4 + 1] AS TINYINT) AS clean_status,
         CAST({A.BASE_TIME} AS BIGINT) AS created_at,
         CAST({A.BASE_TIME} + doc_id AS BIGINT) AS updated_at,
         text
  FROM documents
)"""

EXT = r"lower(regexp_extract({p}, '[^/]\.([^/.]+)$', 1))"
NAME = r"regexp_extract({p}, '[^/]*$')"

VERDICTS = f"""
WITH {NAS_FILES.strip()}, {INVENTORY.strip()}, {REGISTRY.strip()},
cat AS (
  SELECT id, trim(coalesce(full_path, '')) AS original_path FROM nas_files WHERE status = 3
),
early AS (
  SELECT id, original_path,
         CASE WHEN original_path = '' THEN 'missing_remote'
              WHEN {EXT.format(p='original_path')} NOT IN ('pdf','docx','xlsx','pptx','txt','md','markdown')
                THEN 'skipped_unsupported'
              WHEN {EXT.format(p='original_path')} IN ('docx','xlsx','pptx')
                   AND starts_with({NAME.format(p='original_path')}, '~$') THEN 'skipped_temp'
              WHEN original_path IN (SELECT original_path FROM registry) THEN 'known'
         END AS early
  FROM cat
),
open_paths AS (SELECT DISTINCT original_path FROM early WHERE early IS NULL),
cand AS (
  SELECT original_path, 1 AS r, original_path AS c FROM open_paths
  UNION ALL SELECT original_path, 2, '/' || regexp_replace(original_path, '^/volume[^/]*/', '') FROM open_paths
  UNION ALL SELECT original_path, 3, regexp_replace(original_path, '^/volume[^/]*/', '') FROM open_paths
  UNION ALL SELECT original_path, 4, ltrim(original_path, '/') FROM open_paths
),
resolved AS (
  SELECT original_path, arg_min(c, r) AS resolved_path FROM cand JOIN inventory ON c = path GROUP BY original_path
),
info AS (
  SELECT r.original_path, r.resolved_path, i.length AS file_size, sha256(i.content) AS file_hash
  FROM resolved r JOIN inventory i ON i.path = r.resolved_path
),
rows AS (
  SELECT e.id, e.original_path, e.early, i.resolved_path, i.file_size, i.file_hash
  FROM early e LEFT JOIN info i ON e.early IS NULL AND i.original_path = e.original_path
),
winners AS (
  SELECT min(id) AS id FROM rows
  WHERE early IS NULL AND file_hash IS NOT NULL AND file_hash NOT IN (SELECT file_hash FROM registry)
  GROUP BY file_hash
),
verdicts AS (
  SELECT id, original_path,
         CASE WHEN early = 'known' THEN 'skipped_existing'
              WHEN early IS NOT NULL THEN early
              WHEN file_hash IS NULL THEN 'missing_remote'
              WHEN id IN (SELECT id FROM winners) THEN 'inserted'
              ELSE 'skipped_existing' END AS verdict,
         resolved_path,
         {NAME.format(p='resolved_path')} AS file_name,
         {EXT.format(p=NAME.format(p='resolved_path'))} AS file_ext,
         file_size, file_hash
  FROM rows
)"""

ORACLES: dict[str, str] = {}

ORACLES["register_verdicts"] = VERDICTS + "\nSELECT * FROM verdicts"

STORED = f"""
inventory AS (
  SELECT CASE WHEN doc_id % 3 = 0 THEN {_catpath('doc_id')} ELSE '/' || substr({_catpath('doc_id')}, 10) END AS path,
         CAST(CASE WHEN doc_id % 11 = 2 THEN 0 ELSE strlen(text) END AS BIGINT) AS length,
         CASE WHEN doc_id % 17 = 3 THEN NULL WHEN doc_id % 11 = 2 THEN encode('') ELSE encode(text) END AS content
  FROM documents WHERE doc_id % 13 <> 0
)"""

ORACLES["register_files"] = VERDICTS.replace(INVENTORY.strip(), STORED.strip()) + "\nSELECT * FROM verdicts"

ORACLES["register_counters"] = VERDICTS + """
SELECT count(*) AS fetched, count(*) AS checked,
       count(*) FILTER (WHERE verdict = 'inserted') AS inserted,
       count(*) FILTER (WHERE verdict = 'skipped_existing') AS skipped_existing,
       count(*) FILTER (WHERE verdict = 'skipped_unsupported') AS skipped_unsupported,
       count(*) FILTER (WHERE verdict = 'skipped_temp') AS skipped_temp,
       count(*) FILTER (WHERE verdict = 'missing_remote') AS missing_remote,
       count(*) FILTER (WHERE verdict = 'failed') AS failed
FROM verdicts"""

# UUIDv5 (URL namespace) of '<hash>:<path>', from SHA-1 with the version and variant digits set.
_UID = (
    "(substr(h, 1, 12) || '5' || substr(h, 14, 3) || "
    "lower(printf('%x', (('0x' || substr(h, 17, 1))::INTEGER & 3) | 8)) || substr(h, 18, 15))"
)

ORACLES["registry_new_rows"] = VERDICTS + f"""
, ins AS (
  SELECT id AS catalogue_id, file_name, file_ext, file_size, file_hash, original_path,
         sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(file_hash || ':' || original_path)) AS h,
         row_number() OVER (ORDER BY id) AS seq
  FROM verdicts WHERE verdict = 'inserted'
)
SELECT CAST((SELECT max(id) FROM registry) + seq AS BIGINT) AS id, file_name, {_UID} AS file_uid, file_ext,
       CAST(file_size AS BIGINT) AS file_size, file_hash, original_path, '' AS parse_path,
       CAST(0 AS TINYINT) AS parse_status, CAST(0 AS TINYINT) AS clean_status,
       CAST({A.NOW} AS BIGINT) AS created_at, CAST({A.NOW} AS BIGINT) AS updated_at, catalogue_id
FROM ins"""

ORACLES["catalogue_page"] = f"""
WITH {NAS_FILES.strip()}
SELECT id, full_path FROM nas_files WHERE status = 3 AND id > 100 ORDER BY id LIMIT 50"""

ORACLES["path_candidates"] = f"""
WITH p AS (
  SELECT doc_id AS id, doc_id % 6 AS v, {_catpath('doc_id')} AS c FROM documents
), n AS (
  SELECT id, v, CASE WHEN v = 4 THEN '/' || c WHEN v = 5 THEN substr(c, 2) ELSE c END AS norm,
         regexp_replace(c, '^/volume1/', '') AS rest
  FROM p
)
SELECT id, 1 AS pos, norm AS candidate FROM n
UNION ALL SELECT id, 2, '/' || rest FROM n
UNION ALL SELECT id, 3, rest FROM n
UNION ALL SELECT id, 4, ltrim(norm, '/') FROM n WHERE starts_with(norm, '/')"""


# ------------------------------------------------------------------------------------------------ cleaning
# RE2 classes standing for Python's white space (LF excluded in HWS) and decimal digits.
HWS = r"[\pZ\t\x0b\x0c\r\x1c-\x1f\x{85}]"
WSX = r"[\pZ\s\x0b\x1c-\x1f\x{85}]"
NWS = r"[^\pZ\s\x0b\x1c-\x1f\x{85}]"
DG = r"\p{Nd}"
PAGE = (
    HWS + "*(?:(?i:page)" + HWS + "+" + DG + "+(?:" + HWS + "+(?i:of)" + HWS + "+" + DG + "+)?|"
    + DG + "+" + HWS + "*/" + HWS + "*" + DG + "+|-+" + HWS + "*" + DG + "+" + HWS + "*-+|" + DG + "+)" + HWS + "*"
)


def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


def _rewrite(pattern: str, body) -> str:
    """SQL for ``s`` with every match of ``pattern`` replaced by ``body(match)``."""
    found, pieces = f"regexp_extract_all(s, '{pattern}')", f"string_split_regex(s, '{pattern}')"
    return (f"CASE WHEN regexp_matches(s, '{pattern}') THEN {pieces}[1] || array_to_string(list_transform("
            f"range(1, len({found}) + 1), lambda i: ({body(found + '[i]')}) || {pieces}[i + 1]), '') ELSE s END")


def _let(value: str, name: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def _table_sql(match: str) -> str:
    """C4 and C5 on one HTML table."""
    cell = (f"replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(c, "
            f"'(?i)<br\\b[^>]*>|</p>|</div>|</section>|</article>', ' ', 'g'), '</?([a-zA-Z][a-zA-Z0-9]*)\\b[^>]*>', '', 'g'), "
            f"'{WSX}+', ' ', 'g'), '^ | $', '', 'g'), '|', '\\|')")
    rows = (f"list_filter(list_transform(regexp_extract_all({match}, '(?is)<tr\\b[^>]*>.*?</tr>'), lambda r: "
            f"list_transform(regexp_extract_all(r, '(?is)<t[dh]\\b[^>]*>(.*?)</t[dh]>', 1), lambda c: {cell})), lambda r: len(r) > 0)")
    line = "'| ' || array_to_string(list_resize({0}, w, {1}), ' | ') || ' |'"
    made = (f"chr(10) || {line.format('q[1]', chr(39) * 2)} || chr(10) || {line.format('[' + chr(39) + '---' + chr(39) + ']', chr(39) + '---' + chr(39))}"
            f" || array_to_string(list_transform(q[2:], lambda r: chr(10) || {line.format('r', chr(39) * 2)}), '') || chr(10)")
    return _let(rows, "q", f"CASE WHEN len(q) = 0 THEN '' ELSE {_let('list_max(list_transform(q, lambda r: len(r)))', 'w', made)} END")


def _clean_path(path: str) -> str:
    return f"replace(replace(regexp_replace({path}, '^{WSX}+|{WSX}+$', '', 'g'), chr(92), '/'), ' ', '%20')"


_BASE = "url_decode(replace(regexp_extract(regexp_extract({0}, '^([^?#]*)', 1), '([^/]*)/*$', 1), '+', '%2B'))"


def _html_image_sql(match: str) -> str:
    """C8 on one image tag (the data quote ``src`` with '"')."""
    path = _clean_path(f"regexp_extract({match}, '(?i)\\bsrc=\"([^\"]*)\"', 1)")
    return _let(path, "p", f"CASE WHEN p <> '' THEN '![' || {_BASE.format('p')} || '](' || p || ')' ELSE '' END")


def _image_ref_sql(match: str) -> str:
    """C15 and C16 on one reference: the parent folder if all digits, else the record's id."""
    parent = "regexp_extract(regexp_extract(p, '^([^?#]*)', 1), '(?:^|/)([0-9]+)/+[^/]*$', 1)"
    suffix = "substr(p, length(regexp_extract(p, '^([^?#]*)', 1)) + 1)"
    fid = f"CASE WHEN {parent} <> '' THEN {parent} ELSE CAST(id AS VARCHAR) END"
    target = f"CASE WHEN {_BASE.format('p')} = '' THEN p ELSE '/images/' || {fid} || '/' || {_BASE.format('p')} || {suffix} END"
    path = _clean_path(f"regexp_extract({match}, '!\\[[^\\]]*\\]\\(([^)]+)\\)', 1)")
    return _let(path, "p", f"'![](' || {target} || ')'")


def clean_chain(src: str, name_expr: str, audit: bool = False, blocks: bool = False):
    """CTEs ``c0`` .. ``c20`` over ``src(id, s)``; ``c20(id, s)`` holds the cleaned text.

    Covers the rules the driver data exercises: line ends, header, the four entities of the data (``&amp;`` last, one
    pass), comments, anchors, breaks, noise/paragraph/all tags, garbage, emphasis pairs, headings, page lines, blank
    runs, strip and header. ``blocks`` adds tables, both image forms and single emphasis marks, which only
    ``rich_documents`` has.
    """
    nl = "chr(10)"
    steps = [
        f"replace(replace(s, chr(13) || chr(10), {nl}), chr(13), {nl})",
        # Drop a header block carrying our keys
        f"CASE WHEN starts_with(s, '---' || {nl}) AND strpos(substr(s, 5), {nl} || '---' || {nl}) > 0 "
        f"AND (contains(left(s, strpos(substr(s, 5), {nl} || '---' || {nl}) + 8), 'file_name:') "
        f"OR contains(left(s, strpos(substr(s, 5), {nl} || '---' || {nl}) + 8), 'source_file_id:')) "
        f"THEN substr(s, strpos(substr(s, 5), {nl} || '---' || {nl}) + 9) ELSE s END",
        # C3
        "replace(regexp_replace(replace(replace(replace(s, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), "
        "'&amp;?', '&', 'g'), chr(160), ' ')",
        "regexp_replace(s, '<!--.*?-->', '', 'gs')",
        f"regexp_replace(s, '{_q(r'(?i)<a' + WSX + r'+[^>]*(?:id|name)=[\"' + chr(39) + r']?_Toc[^>]*>' + WSX + r'*</a>')}', '', 'g')",
        f"regexp_replace(s, '(?i)<br\\b[^>]*>|</p>|</div>|</section>|</article>', {nl}, 'g')",
        "regexp_replace(s, '(?i)</?(?:a|span|div|u|font|strong|b|em|i|section|article|header|footer|center)\\b[^>]*>',"
        " '', 'g')",
        f"regexp_replace(regexp_replace(regexp_replace(s, '(?i)(<t[dh]\\b[^>]*>){WSX}*<p\\b[^>]*>', '\\1', 'g'), "
        f"'(?i)</p>{WSX}*(</t[dh]>)', '\\1', 'g'), '(?i)</?p\\b[^>]*>', {nl}, 'g')",
        "regexp_replace(s, '</?([a-zA-Z][a-zA-Z0-9]*)\\b[^>]*>', '', 'g')",
        # C13
        "replace(replace(replace(replace(replace(replace(replace(replace(s, chr(8203), ''), chr(8204), ''), "
        "chr(8205), ''), chr(65279), ''), chr(65533), ''), chr(160), ' '), '\\_', ''), 'text_image', '')",
        # C14: marker pairs by lazy patterns; a left-over '***' becomes '*'
        "replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(s, "
        "'\\*\\*\\*(.+?)\\*\\*\\*', '\\1', 'gs'), '___(.+?)___', '\\1', 'gs'), '\\*\\*(.+?)\\*\\*', '\\1', 'gs'), "
        "'__(.+?)__', '\\1', 'gs'), '~~(.+?)~~', '\\1', 'gs'), '***', '*')",
        # C17
        f"regexp_replace(regexp_replace(regexp_replace(s, '{HWS}+(\\n|$)', '\\1', 'g'), "
        f"'(?m)^{HWS}+#', '#', 'g'), '(?m)^(#{{1,6}})({NWS})', '\\1 \\2', 'g')",
        # C18
        f"regexp_replace(regexp_replace(s, '(?m)^{_q(PAGE)}\\n', '', 'g'), '(?:\\A|\\n){_q(PAGE)}\\z', '')",
        # C19
        f"regexp_replace(regexp_replace(s, '[ \\t]+\\n', {nl}, 'g'), '\\n{{3,}}', {nl} || {nl}, 'g')",
        # C20
        f"regexp_replace(s, '^{WSX}+|{WSX}+$', '', 'g')",
    ]
    if blocks:
        table = "(?is)<table\\b[^>]*>.*?</table>"
        image = "(?i)<img\\b[^>]*\\bsrc=\"[^\"]*\"[^>]*>"
        steps[10] = f"regexp_replace(regexp_replace({steps[10]}, '\\*(ital [0-9]+)\\*', '\\1', 'g'), '_(under [0-9]+)_', '\\1', 'g')"
        steps = [*steps[:3], _rewrite(table, _table_sql), *steps[3:5], _rewrite(image, _html_image_sql), *steps[5:11],
                 _rewrite("!\\[[^\\]]*\\]\\([^)]+\\)", _image_ref_sql), *steps[11:]]
    ctes = [f"c0 AS (SELECT id, s, {name_expr} AS name FROM {src})"]
    for i, expr in enumerate(steps, start=1):
        ctes.append(f"c{i} AS (SELECT id, {expr} AS s, name FROM c{i - 1})")
    if audit:
        return ",\n".join(ctes), len(steps)
    last = len(steps)
    ctes.append(
        f"cleaned AS (SELECT id, CASE WHEN name <> '' THEN '---' || {nl} || 'file_name: \"' || "
        f"replace(replace(name, '\\', '\\\\'), '\"', '\\\"') || '\"' || {nl} || '---' || {nl} || s || {nl} "
        f"ELSE s || {nl} END AS s FROM c{last})"
    )
    return ",\n".join(ctes)


ORACLES["clean_pages"] = (
    "WITH src AS (SELECT page_id AS id, html AS s, url FROM pages),\n"
    + clean_chain("src", "regexp_extract(regexp_replace(url, '/+$', ''), '[^/]*$')")
    + "\nSELECT id AS page_id, length(s) AS cleaned_len, md5(s) AS cleaned_md5 FROM cleaned"
)

DOC_ORIGINAL = (
    "'/corpus/' || source || '/doc' || CAST(doc_id AS VARCHAR) || "
    "CASE WHEN doc_id % 7 = 0 THEN '\"q\"' ELSE '' END || '.txt'"
)

ORACLES["clean_documents"] = (
    f"WITH src AS (SELECT doc_id AS id, text AS s, {DOC_ORIGINAL} AS original_path FROM documents),\n"
    + clean_chain("src", "regexp_extract(original_path, '[^/]*$')")
    + "\nSELECT id AS doc_id, length(s) AS cleaned_len, md5(s) AS cleaned_md5 FROM cleaned"
)


# ------------------------------------------------------------------------------------------------ state, claims
ARCHIVE = f"""
archive AS (
  SELECT '/archive/' || source || '/doc' || CAST(doc_id AS VARCHAR) || '.' || {_list(A.REGISTRY_EXTS)}[doc_id % 8 + 1]
           AS path, CAST(strlen(text) AS BIGINT) AS length
  FROM documents WHERE doc_id % 13 <> 0
)"""

LISTING = f"""{INVENTORY.strip()}, {ARCHIVE.strip()},
listing AS (SELECT path, length FROM inventory UNION ALL SELECT path, length FROM archive)"""

NOW = A.NOW

RECOVERED = f"""
WITH {REGISTRY.strip()}, {LISTING},
r1 AS (SELECT *, coalesce(clean_status = 1 AND updated_at < {NOW} - 3600, false) AS crp FROM registry),
r2 AS (SELECT * REPLACE (CASE WHEN crp THEN 0 ELSE clean_status END AS clean_status,
                         CASE WHEN crp THEN {NOW} ELSE updated_at END AS updated_at) FROM r1),
r3 AS (SELECT *, clean_status = -1 AS crf FROM r2),
r4 AS (SELECT * REPLACE (CASE WHEN crf THEN 0 ELSE clean_status END AS clean_status,
                         CASE WHEN crf THEN {NOW} ELSE updated_at END AS updated_at) FROM r3),
r5 AS (SELECT *, parse_status = 1 AS rp FROM r4),
r6 AS (SELECT * REPLACE (CASE WHEN rp THEN 0 ELSE parse_status END AS parse_status,
                         CASE WHEN rp THEN {NOW} ELSE updated_at END AS updated_at) FROM r5),
r7 AS (SELECT *, trim(coalesce(original_path, '')) <> ''
                 AND original_path IN (SELECT path FROM listing) AS src FROM r6),
r8 AS (SELECT *, parse_status = -1 AND src AS rf, parse_status = -1 AND NOT src AS kf FROM r7),
recovered AS (
  SELECT * REPLACE (CAST(CASE WHEN rf THEN 0 ELSE parse_status END AS TINYINT) AS parse_status,
                    CAST(clean_status AS TINYINT) AS clean_status,
                    CAST(CASE WHEN rf OR kf THEN {NOW} ELSE updated_at END AS BIGINT) AS updated_at) FROM r8
)"""

ORACLES["state_recovery"] = RECOVERED + "\nSELECT id, parse_status, clean_status, updated_at FROM recovered"

ORACLES["state_counts"] = RECOVERED + """
SELECT count(*) FILTER (WHERE crp) AS clean_recovered_processing, count(*) FILTER (WHERE crf) AS clean_recovered_failed,
       count(*) FILTER (WHERE rp) AS recovered_processing, count(*) FILTER (WHERE rf) AS recovered_failed,
       count(*) FILTER (WHERE kf) AS kept_failed
FROM recovered"""

ORACLES["status_update"] = f"""
WITH {REGISTRY.strip()},
res AS (SELECT id, id % 3 <> 0 AS ok, '{A.MD_ROOT}/' || file_hash || '.md' AS path FROM registry WHERE parse_status = 1),
t3 AS (
  SELECT r.* REPLACE (
           CAST(CASE WHEN x.ok THEN 2 WHEN x.ok IS NOT NULL THEN -1 ELSE r.parse_status END AS TINYINT) AS parse_status,
           CASE WHEN x.ok THEN x.path ELSE r.parse_path END AS parse_path,
           CASE WHEN x.ok IS NOT NULL THEN {NOW} ELSE r.updated_at END AS updated_at)
  FROM registry r LEFT JOIN res x ON x.id = r.id
)
SELECT id, parse_status,
       CAST(CASE WHEN id % 10 = 1 THEN 0 ELSE clean_status END AS TINYINT) AS clean_status, parse_path,
       CAST(CASE WHEN id % 10 = 1 THEN {NOW + 1} ELSE updated_at END AS BIGINT) AS updated_at
FROM t3"""

PARSE_CLAIMS = """
pclaims AS (
  SELECT *, CAST((row_number() OVER (ORDER BY id) - 1) // 5 AS BIGINT) AS claim_no,
         CAST((row_number() OVER (ORDER BY id) - 1) % 5 AS INTEGER) AS claim_pos
  FROM registry WHERE parse_status = 0
)"""

ORACLES["claims_parse"] = f"WITH {REGISTRY.strip()}, {PARSE_CLAIMS.strip()}\nSELECT id, claim_no, claim_pos FROM pclaims"

ORACLES["claims_clean"] = f"""
WITH {REGISTRY.strip()},
c AS (SELECT id, row_number() OVER (ORDER BY file_size, id) - 1 AS rn FROM registry
      WHERE clean_status = 0 AND parse_status = 2 AND parse_path <> '')
SELECT id, CAST(rn // 5 AS BIGINT) AS claim_no, CAST(rn % 5 AS INTEGER) AS claim_pos FROM c"""

ROUTE = ("CASE WHEN {e} IN ('pdf','docx','xlsx','pptx') THEN 'parser' WHEN {e} = 'txt' THEN 'passthrough' "
         "ELSE 'unsupported' END")
ONE_STEP = "CASE WHEN {e} IN ('pdf','docx','xlsx','pptx') THEN 'parser' ELSE 'unsupported' END"
NEXT = "regexp_replace(lower(coalesce(file_ext, '')), '^[.]+', '')"

ORACLES["routes"] = f"""
WITH {REGISTRY.strip()}
SELECT id, {ROUTE.format(e=NEXT)} AS route, {ONE_STEP.format(e=NEXT)} AS one_step_route FROM registry"""

ORACLES["by_extension"] = f"""
WITH {REGISTRY.strip()}
SELECT {NEXT} AS ext, count(*) AS files, min(id) AS first_id, max(id) AS last_id FROM registry GROUP BY 1"""

ORACLES["passthrough_results"] = f"""
WITH {REGISTRY.strip()}
SELECT id, trim(coalesce(original_path, '')) <> '' AS ok,
       CASE WHEN trim(coalesce(original_path, '')) <> '' THEN trim(original_path) END AS parse_path
FROM registry WHERE {ROUTE.format(e=NEXT)} = 'passthrough'"""

REQUEST_CHAIN = f"""
WITH {REGISTRY.strip()}, {LISTING}, {PARSE_CLAIMS.strip()},
todo AS (SELECT * FROM pclaims WHERE {ROUTE.format(e=NEXT)} = 'parser'),
paths AS (SELECT DISTINCT original_path AS p FROM todo),
cand AS (
  SELECT p, 1 AS r, p AS c FROM paths
  UNION ALL SELECT p, 2, '/' || regexp_replace(p, '^/?volume[^/]*/', '') FROM paths
    WHERE regexp_matches(p, '^/?volume[^/]*/.')
  UNION ALL SELECT p, 3, regexp_replace(p, '^/?volume[^/]*/', '') FROM paths WHERE regexp_matches(p, '^/?volume[^/]*/.')
  UNION ALL SELECT p, 4, ltrim(p, '/') FROM paths WHERE starts_with(p, '/')
),
found AS (SELECT DISTINCT p FROM cand JOIN listing ON c = path),
files AS (SELECT t.* FROM todo t JOIN found f ON f.p = t.original_path),
w1 AS (SELECT *, file_size > 20000 AS large,
              sum(CAST(file_size > 20000 AS INTEGER)) OVER (PARTITION BY claim_no ORDER BY claim_pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg FROM files),
w2 AS (SELECT *, row_number() OVER (PARTITION BY claim_no, seg, large ORDER BY claim_pos) - 1 AS rn FROM w1),
w3 AS (SELECT *, CASE WHEN large THEN 0 ELSE 1 + rn // 2 END AS sub FROM w2),
batches AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY claim_no ORDER BY seg, sub) AS INTEGER) AS batch_in_claim,
         CAST(CASE WHEN large THEN 0 ELSE rn % 2 END AS INTEGER) AS batch_pos
  FROM w3
)"""

ORACLES["request_batches"] = REQUEST_CHAIN + """
SELECT id, claim_no, batch_in_claim, batch_pos, large, file_name AS upload_name, file_name AS local_name FROM batches"""

# ------------------------------------------------------------------------------------------------ replies
# The replies adapter answers batch b in form b % 6 (0 by uid, 1 by name, 2 by stem as bare strings, 3 array,
# 4 second container, 5 not JSON) and with 503 when b % 7 = 3. What each file must get follows from that without
# reading JSON.
REPLY_CHAIN = REQUEST_CHAIN + """,
reqs AS (
  SELECT *, CAST(claim_no * 10 + batch_in_claim AS BIGINT) AS batch_no,
         count(*) OVER (PARTITION BY claim_no * 10 + batch_in_claim) AS batch_size
  FROM batches
),
exp AS (
  SELECT r.*, batch_no % 6 AS form, batch_no % 7 <> 3 AS answered,
         batch_no % 7 <> 3 AND batch_no % 6 <> 5 AS has_md,
         batch_no % 7 <> 3 AND batch_no % 6 NOT IN (2, 5) AND id % 5 <> 0 AS has_images
  FROM reqs r
),
md AS (
  SELECT e.*,
    CASE WHEN has_md THEN d.text
      || CASE WHEN id % 5 = 0 THEN ''
              WHEN has_images THEN chr(10) || '![fig](/images/' || CAST(id AS VARCHAR) || '/p' || CAST(id AS VARCHAR)
                   || '.png)' || chr(10) || 'see /images/' || CAST(id AS VARCHAR) || '/p' || CAST(id AS VARCHAR) || '.png'
              ELSE chr(10) || '![fig](images/p' || CAST(id AS VARCHAR) || '.png)' || chr(10) || 'see p'
                   || CAST(id AS VARCHAR) || '.png' END
      || CASE WHEN id % 7 = 1 THEN chr(10) || '![gone](missing' || CAST(id AS VARCHAR) || '.png)' ELSE '' END
    END AS markdown
  FROM exp e JOIN documents d ON d.doc_id = e.id
)"""

ORACLES["reply_audit"] = REPLY_CHAIN + """
SELECT DISTINCT batch_no, CASE WHEN answered THEN 200 ELSE 503 END AS status_code, answered AS response_success,
       form <> 5 AS is_json,
       CASE form WHEN 3 THEN 'array' WHEN 5 THEN 'none' ELSE 'object' END AS form,
       CAST(CASE form WHEN 3 THEN batch_size + 1 WHEN 5 THEN 0 ELSE batch_size END AS INTEGER) AS entries
FROM exp"""

ORACLES["reply_match"] = REPLY_CHAIN + """
SELECT id, batch_no, CASE WHEN answered THEN 'success' ELSE 'failed' END AS parse_status,
       length(markdown) AS md_len, md5(markdown) AS md_md5
FROM md"""

ORACLES["large_replies"] = f"""
WITH d AS (SELECT doc_id AS id, text, CAST(doc_id AS VARCHAR) AS k FROM documents),
md AS (
  SELECT id, text || chr(10) || '![inline](data:image/png;base64,' || base64(encode(text)) || ')' || chr(10)
         || '![fig](/images/' || k || '/p' || k || '.png)' AS markdown FROM d
)
SELECT id, '' AS name, length(markdown) AS size, md5(markdown) AS digest FROM md
UNION ALL
SELECT id, 'p' || k || '.png', CAST(strlen(text) * {A.HEAVY_COPIES} AS BIGINT), md5(repeat(text, {A.HEAVY_COPIES})) FROM d"""

ORACLES["parse_outcomes"] = REPLY_CHAIN + f"""
SELECT id, has_md AS ok, CASE WHEN has_md THEN '{A.MD_ROOT}/' || file_hash || '.md' END AS parse_path FROM exp"""

ORACLES["images_decoded"] = REPLY_CHAIN + """
SELECT id AS file_id, 'p' || CAST(id AS VARCHAR) || '.png' AS image_name,
       '/images/' || CAST(id AS VARCHAR) || '/p' || CAST(id AS VARCHAR) || '.png' AS url,
       strlen('img-' || CAST(id AS VARCHAR)) AS n_bytes, md5('img-' || CAST(id AS VARCHAR)) AS bytes_md5
FROM exp WHERE has_images
UNION ALL
SELECT id, 'image_2.png', '/images/' || CAST(id AS VARCHAR) || '/image_2.png',
       strlen('junk-' || CAST(id AS VARCHAR)), md5('junk-' || CAST(id AS VARCHAR))
FROM exp WHERE has_images AND id % 3 = 2"""

ORACLES["dangling_images"] = REPLY_CHAIN + """
SELECT id, 0 AS pos, 'p' || CAST(id AS VARCHAR) || '.png' AS image_name FROM exp
WHERE has_md AND id % 5 <> 0 AND NOT has_images
UNION ALL
SELECT id, CASE WHEN id % 5 <> 0 THEN 1 ELSE 0 END, 'missing' || CAST(id AS VARCHAR) || '.png' FROM exp
WHERE has_md AND id % 7 = 1"""

ORACLES["parse_counters"] = REPLY_CHAIN + f""",
claimed AS (SELECT p.id, p.claim_no, {ROUTE.format(e=NEXT)} AS route,
                   trim(coalesce(p.original_path, '')) <> '' AS has_path FROM pclaims p),
rows AS (
  SELECT c.claim_no, c.route, e.id IS NOT NULL AS downloaded,
         CASE WHEN c.route = 'parser' THEN coalesce(e.has_md, false)
              WHEN c.route = 'passthrough' THEN c.has_path ELSE false END AS ok
  FROM claimed c LEFT JOIN exp e ON e.id = c.id
)
SELECT claim_no, count(DISTINCT claim_no) AS cycles, count(*) AS picked,
       count(*) FILTER (WHERE route = 'parser' AND downloaded) AS downloaded,
       count(*) FILTER (WHERE ok) AS success, count(*) FILTER (WHERE NOT ok) AS failed,
       count(*) FILTER (WHERE route = 'unsupported') AS unsupported,
       count(*) FILTER (WHERE route = 'passthrough' AND ok) AS passthrough
FROM rows GROUP BY ROLLUP (claim_no)"""


# ------------------------------------------------------------------------------------------------ uploads
STORE = f"""
store AS (
  SELECT doc_id AS k,
         CASE WHEN doc_id % 7 = 2 THEN '/x/doc' || CAST(doc_id AS VARCHAR) || '.md'
              WHEN doc_id % 11 = 4 THEN '{A.MD_ROOT}/doc' || CAST(doc_id AS VARCHAR) || '.txt'
              WHEN doc_id % 5 = 3 THEN '{A.MD_ROOT}/doc' || CAST(doc_id AS VARCHAR) || '.markdown'
              ELSE '{A.MD_ROOT}/doc' || CAST(doc_id AS VARCHAR) || '.md' END AS path,
         doc_id % 23 = 5 AS damaged, text
  FROM documents WHERE doc_id % 19 <> 7
)"""

UPLOAD_OK = "({k}) % 5 IN (0, 3, 4)"  # success, duplicated and not-JSON replies are accepted

RAW_UPLOAD = f"""
WITH {REGISTRY.strip()}, {STORE.strip()},
parsed AS (
  SELECT id, parse_path, row_number() OVER (ORDER BY id) - 1 AS rn FROM registry
  WHERE parse_status = 2 AND parse_path <> ''
),
resolved AS (
  SELECT id, rn,
         CASE WHEN parse_path = ' ' THEN '{A.MD_ROOT}/ '
              WHEN starts_with(parse_path, '{A.MD_ROOT}/../') THEN NULL
              WHEN starts_with(parse_path, '/') THEN parse_path
              ELSE '{A.MD_ROOT}/' || parse_path END AS markdown_path
  FROM parsed
),
verdicts AS (
  SELECT r.id, CAST(r.rn // 5 AS BIGINT) AS page_no,
         CASE WHEN r.markdown_path IS NULL THEN 'skipped'
              WHEN s.path IS NULL THEN 'failed'
              WHEN NOT (ends_with(lower(r.markdown_path), '.md') OR ends_with(lower(r.markdown_path), '.markdown'))
                THEN 'skipped'
              WHEN s.damaged THEN 'failed'
              WHEN NOT {UPLOAD_OK.format(k='r.id')} THEN 'failed'
              ELSE 'uploaded' END AS verdict
  FROM resolved r LEFT JOIN store s ON s.path = r.markdown_path
)"""

ORACLES["raw_upload_page"] = RAW_UPLOAD + "\nSELECT id, page_no, verdict FROM verdicts"

ORACLES["raw_upload_counters"] = RAW_UPLOAD + """
SELECT count(*) AS picked, count(*) FILTER (WHERE verdict = 'uploaded') AS success,
       count(*) FILTER (WHERE verdict = 'failed') AS failed, count(*) FILTER (WHERE verdict = 'uploaded') AS uploaded,
       count(*) FILTER (WHERE verdict = 'skipped') AS skipped
FROM verdicts"""

ORACLES["utf8_repair"] = f"""
WITH {STORE.strip()}
SELECT path, length(text) + CASE WHEN damaged THEN 1 ELSE 0 END AS n_chars, md5(text) AS text_md5,
       true AS readable, damaged AS repaired
FROM store"""

CLEAN_FLOW = f"""
WITH {REGISTRY.strip()}, {STORE.strip()},
rec AS (
  SELECT * REPLACE (CASE WHEN clean_status = 1 AND updated_at < {NOW} - 3600 THEN 0
                         WHEN clean_status = -1 THEN 0 ELSE clean_status END AS clean_status)
  FROM registry
),
claimed AS (
  SELECT id, file_name, parse_path, row_number() OVER (ORDER BY file_size, id) - 1 AS rn FROM rec
  WHERE clean_status = 0 AND parse_status = 2 AND parse_path <> ''
),
flow AS (
  SELECT c.id, c.file_name, CAST(c.rn // 5 AS BIGINT) AS claim_no,
         s.path IS NOT NULL AND {UPLOAD_OK.format(k='c.id')} AS ok, s.text
  FROM claimed c LEFT JOIN store s ON s.path = c.parse_path
),
src AS (SELECT id, text AS s, file_name FROM flow),
{clean_chain('src', 'trim(file_name)')}"""

ORACLES["upload_outcomes"] = CLEAN_FLOW + """
SELECT f.id, f.claim_no, f.ok, CAST(CASE WHEN f.ok THEN 2 ELSE -1 END AS TINYINT) AS clean_status,
       md5(c.s) AS cleaned_md5
FROM flow f JOIN cleaned c ON c.id = f.id"""

ORACLES["clean_counters"] = CLEAN_FLOW + """
SELECT claim_no, count(*) AS picked, count(*) FILTER (WHERE ok) AS success, count(*) FILTER (WHERE NOT ok) AS failed,
       count(*) FILTER (WHERE ok) AS uploaded
FROM flow GROUP BY ROLLUP (claim_no)"""

ONE_STEP = REPLY_CHAIN + f""",
one AS (
  SELECT e.id, e.claim_no, e.claim_pos, e.original_path,
         CASE WHEN NOT e.has_md THEN 'parse_failed' WHEN {UPLOAD_OK.format(k='e.claim_no')} THEN 'uploaded'
              ELSE 'upload_failed' END AS outcome
  FROM exp e
)"""

ORACLES["one_step_outcomes"] = ONE_STEP + """
SELECT o.id, o.outcome,
       CAST(CASE WHEN o.outcome = 'uploaded' THEN 2 ELSE -1 END AS TINYINT) AS parse_status,
       CAST(CASE WHEN o.outcome = 'uploaded' THEN 2 WHEN o.outcome = 'upload_failed' THEN -1 ELSE r.clean_status END
            AS TINYINT) AS clean_status
FROM one o JOIN registry r ON r.id = o.id"""

ORACLES["upload_batches"] = ONE_STEP + """
SELECT claim_no, CAST(count(*) AS INTEGER) AS n_texts, string_agg(original_path, '|' ORDER BY claim_pos) AS file_sources
FROM one WHERE outcome <> 'parse_failed' GROUP BY claim_no"""


ORACLES["stream_register"] = VERDICTS + "\nSELECT id, original_path, verdict FROM verdicts"


# ------------------------------------------------------------------------------------------------ extraction
ORACLES["doc_tables"] = """
WITH t AS (SELECT doc_id FROM documents WHERE doc_id % 5 = 1),
cells AS (
  SELECT doc_id, 0 AS row_no, 0 AS col_no, 'h' || CAST(doc_id AS VARCHAR) AS cell FROM t
  UNION ALL SELECT doc_id, 0, 1, 'v' FROM t UNION ALL SELECT doc_id, 0, 2, '' FROM t
  UNION ALL SELECT doc_id, 1, 0, 'a\\|' || CAST(doc_id AS VARCHAR) || ' x' FROM t
  UNION ALL SELECT doc_id, 1, 1, '' FROM t UNION ALL SELECT doc_id, 1, 2, '' FROM t
  UNION ALL SELECT doc_id, 2, 0, '1' FROM t UNION ALL SELECT doc_id, 2, 1, '2' FROM t
  UNION ALL SELECT doc_id, 2, 2, '3' FROM t
)
SELECT doc_id, CAST(0 AS INTEGER) AS table_no, CAST(row_no AS INTEGER) AS row_no, CAST(col_no AS INTEGER) AS col_no,
       cell FROM cells"""

ORACLES["doc_images"] = """
SELECT doc_id, CAST(0 AS INTEGER) AS pos, 'fig 1.png' AS name, 'img/' || CAST(doc_id AS VARCHAR) || '/fig%201.png?x=1' AS path,
       'markdown' AS syntax FROM documents WHERE doc_id % 4 = 2
UNION ALL
SELECT doc_id, CAST(1 AS INTEGER), 'p' || CAST(doc_id AS VARCHAR) || '.png', 'im/p' || CAST(doc_id AS VARCHAR) || '.png', 'html'
FROM documents WHERE doc_id % 4 = 2"""

ORACLES["removed_lines"] = """
SELECT doc_id, 'Page ' || CAST(doc_id % 9 AS VARCHAR) || ' of 9' AS line FROM documents WHERE doc_id % 3 = 1
UNION ALL
SELECT doc_id, CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id % 3 = 1"""

ORACLES["image_refs"] = REPLY_CHAIN + """,
imgs AS (
  SELECT id, file_uid, 'p' || CAST(id AS VARCHAR) || '.png' AS image_file FROM exp WHERE has_images
  UNION ALL SELECT id, file_uid, 'image_2.png' FROM exp WHERE has_images AND id % 3 = 2
)
SELECT DISTINCT file_uid, image_file, id % 3 <> 0 AS inserted FROM imgs"""


# Stage audit on the plain documents: the SQL chain's steps line up with the Spark stages; C4, C8 and C15 have
# nothing to act on in these texts (no tables or images) and change nothing.
_AUDIT_STEPS = [("C1", 0, 1), ("C2", 1, 2), ("C3", 2, 3), ("C4", 3, 3), ("C6", 3, 4), ("C7", 4, 5), ("C8", 5, 5),
                ("C9", 5, 6), ("C10", 6, 7), ("C11", 7, 8), ("C12", 8, 9), ("C13", 9, 10), ("C14", 10, 11),
                ("C15", 11, 11), ("C17", 11, 12), ("C18", 12, 13), ("C19", 13, 14), ("C20", 14, "cleaned")]


def _audit_sql() -> str:
    chain, last = clean_chain("src", "regexp_extract(original_path, '[^/]*$')", audit=True)
    nl = "chr(10)"
    cleaned = (
        f"cleaned AS (SELECT id, CASE WHEN name <> '' THEN '---' || {nl} || 'file_name: \"' || "
        f"replace(replace(name, '\\', '\\\\'), '\"', '\\\"') || '\"' || {nl} || '---' || {nl} || s || {nl} "
        f"ELSE s || {nl} END AS s FROM c{last})"
    )
    parts = []
    for stage, a, b in _AUDIT_STEPS:
        left = f"c{a}"
        right = b if isinstance(b, str) else f"c{b}"
        parts.append(
            f"SELECT d.source, '{stage}' AS stage, x.s <> y.s AS changed, length(x.s) - length(y.s) AS removed "
            f"FROM {left} x JOIN {right} y ON x.id = y.id JOIN documents d ON d.doc_id = x.id"
        )
    return (
        f"WITH src AS (SELECT doc_id AS id, text AS s, {DOC_ORIGINAL} AS original_path FROM documents),\n"
        + chain + ",\n" + cleaned + ",\nsteps AS (" + "\nUNION ALL ".join(parts) + ")\n"
        + "SELECT source, stage, count(*) FILTER (WHERE changed) AS docs_changed, "
          "CAST(sum(removed) AS BIGINT) AS chars_removed FROM steps GROUP BY source, stage"
    )


ORACLES["clean_audit"] = _audit_sql()


# The documents of ``adapters.rich_documents``: the added blocks, then those of ``block_documents``.
_K = "CAST(doc_id AS VARCHAR)"
_NL = "chr(10)"
RICH = f"""
extra AS (
  SELECT doc_id, source, text ||
    CASE WHEN doc_id % 10 = 3 THEN {_NL} || '<a name="_Toc' || {_K} || '"></a>anchor' || {_NL} ELSE '' END ||
    CASE WHEN doc_id % 12 = 6 THEN {_NL} || '![x](img/77/100%25 50%.png#' || {_K} || ')' || {_NL} ELSE '' END ||
    CASE WHEN doc_id % 11 = 2 AND NOT contains(text, '_') THEN {_NL} || '_under ' || {_K} || '_ end' || {_NL} ELSE '' END ||
    CASE WHEN doc_id % 11 = 5 AND NOT contains(text, '*') THEN {_NL} || '*ital ' || {_K} || '* end' || {_NL} ELSE '' END ||
    CASE WHEN doc_id % 13 = 1 THEN {_NL} || 'before<!-- note' || {_NL} || {_K} || ' -->after' || {_NL} ELSE '' END ||
    CASE WHEN doc_id % 13 = 2 THEN {_NL} || '<div><span>x</span><p>' || {_K} || '</p></div><h1>t</h1>' || {_NL} ELSE '' END ||
    CASE WHEN doc_id % 13 = 3 THEN {_NL} || 'text_image\\_ ' || {_K} || {_NL} ELSE '' END ||
    CASE WHEN doc_id % 13 = 4 THEN {_NL} || '&copy; &middot; &amp; ' || {_K} || {_NL} ELSE '' END AS text
  FROM documents
),
src AS (
  SELECT doc_id AS id, {DOC_ORIGINAL} AS original_path,
    CASE WHEN doc_id % 6 = 0 THEN '---' || {_NL} || 'file_name: "old"' || {_NL} || '---' || {_NL} ELSE '' END ||
    CASE WHEN doc_id % 7 = 3 THEN chr(8203) ELSE '' END || text ||
    CASE WHEN doc_id % 5 = 1 THEN {_NL} || '<table><tr><th>h' || {_K} || '</th><th>v</th></tr><tr><td>a|' || {_K} ||
      '<br>x</td></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>' || {_NL} ELSE '' END ||
    CASE WHEN doc_id % 4 = 2 THEN {_NL} || '![pic](img/' || {_K} || '/fig%201.png?x=1)' || {_NL} || '<img src="im/p' || {_K} ||
      '.png">' || {_NL} ELSE '' END ||
    CASE WHEN doc_id % 3 = 1 THEN {_NL} || 'Page ' || CAST(doc_id % 9 AS VARCHAR) || ' of 9' || {_NL} || {_K} || {_NL} ELSE '' END ||
    CASE WHEN doc_id % 8 = 5 THEN {_NL} || '##Heading ' || {_K} || {_NL} ELSE '' END ||
    CASE WHEN doc_id % 9 = 4 THEN chr(13) || {_NL} || 'end  ' || chr(13) || {_NL} || chr(13) || {_NL} || chr(13) || {_NL} ||
      chr(13) || {_NL} || 'x' ELSE '' END AS s
  FROM extra
)"""
_BLOCK_STAGES = ("C1", "C2", "C3", "C4", "C6", "C7", "C8", "C9", "C10", "C11", "C12", "C13", "C14", "C15", "C17", "C18", "C19")

ORACLES["clean_blocks"] = (
    "WITH " + RICH.strip() + ",\n" + clean_chain("src", "regexp_extract(original_path, '[^/]*$')", blocks=True)
    + "\nSELECT id AS doc_id, length(s) AS cleaned_len, md5(s) AS cleaned_md5 FROM cleaned"
)


def _block_audit_sql() -> str:
    chain = clean_chain("src", "regexp_extract(original_path, '[^/]*$')", blocks=True)
    last = len(_BLOCK_STAGES)
    pairs = [(stage, f"c{i}", f"c{i + 1}") for i, stage in enumerate(_BLOCK_STAGES)] + [("C20", f"c{last}", "cleaned")]
    parts = [f"SELECT d.source, '{stage}' AS stage, x.s <> y.s AS changed, length(x.s) - length(y.s) AS removed "
             f"FROM {a} x JOIN {b} y ON x.id = y.id JOIN documents d ON d.doc_id = x.id" for stage, a, b in pairs]
    return ("WITH " + RICH.strip() + ",\n" + chain + ",\nsteps AS (" + "\nUNION ALL ".join(parts) + ")\n"
            "SELECT source, stage, count(*) FILTER (WHERE changed) AS docs_changed, "
            "CAST(sum(removed) AS BIGINT) AS chars_removed FROM steps GROUP BY source, stage")


ORACLES["block_audit"] = _block_audit_sql()


# ------------------------------------------------------------------------------------------------ whole cycles
ORACLES["parse_cycle"] = REPLY_CHAIN + f""",
routed AS (SELECT *, {ROUTE.format(e=NEXT)} AS route FROM pclaims),
claimed AS (
  SELECT p.id, p.route, e.id IS NOT NULL AND e.has_md AS has_md, p.file_hash, trim(coalesce(p.original_path, '')) AS path
  FROM routed p LEFT JOIN exp e ON e.id = p.id
),
done AS (
  SELECT id, CASE route WHEN 'parser' THEN has_md WHEN 'passthrough' THEN path <> '' ELSE false END AS ok,
         CASE route WHEN 'parser' THEN '{A.MD_ROOT}/' || file_hash || '.md' ELSE path END AS new_path
  FROM claimed
)
SELECT r.id, CAST(CASE WHEN d.ok THEN 2 WHEN d.id IS NOT NULL THEN -1 ELSE r.parse_status END AS TINYINT) AS parse_status,
       r.clean_status, CASE WHEN d.ok THEN d.new_path ELSE r.parse_path END AS parse_path,
       CASE WHEN d.id IS NOT NULL THEN {NOW} + 1 ELSE r.updated_at END AS updated_at
FROM registry r LEFT JOIN done d ON d.id = r.id"""

ORACLES["clean_cycle"] = CLEAN_FLOW.split("src AS (")[0].rstrip().rstrip(",") + f"""
SELECT r.id, r.parse_status,
       CAST(CASE WHEN f.ok THEN 2 WHEN f.id IS NOT NULL THEN -1 ELSE c.clean_status END AS TINYINT) AS clean_status,
       CASE WHEN f.id IS NOT NULL THEN {NOW} + 1 WHEN c.clean_status <> r.clean_status THEN {NOW} ELSE r.updated_at END AS updated_at
FROM registry r JOIN rec c ON c.id = r.id LEFT JOIN flow f ON f.id = r.id"""

ORACLES["stored_markdown"] = REPLY_CHAIN + """
SELECT file_hash AS doc_key, length(last(markdown ORDER BY id)) AS md_len, md5(last(markdown ORDER BY id)) AS md_md5
FROM md WHERE has_md GROUP BY file_hash"""

ORACLES["stored_image_files"] = (
    ORACLES["images_decoded"].replace("'/images/' || CAST(id AS VARCHAR) || '/p' || CAST(id AS VARCHAR) || '.png' AS url,", "")
    .replace("'/images/' || CAST(id AS VARCHAR) || '/image_2.png',", ""))

ORACLES["stream_cycle"] = ORACLES["parse_cycle"].replace("WITH ", f"WITH {STORE.strip()}, ", 1).replace(
    "SELECT r.id, CAST(CASE WHEN d.ok", ", p AS (SELECT r.id, coalesce(d.ok, false) AND c.route = 'parser' AS fresh, CAST(CASE WHEN d.ok").replace(
    "FROM registry r LEFT JOIN done d ON d.id = r.id", "FROM registry r LEFT JOIN done d ON d.id = r.id LEFT JOIN claimed c ON c.id = r.id)") + f""",
rec AS (SELECT *, clean_status = 1 AND updated_at < {NOW} - 3600 AS late FROM p),
flow AS (
  SELECT r.id, (s.path IS NOT NULL OR r.fresh) AND {UPLOAD_OK.format(k='r.id')} AS ok
  FROM rec r LEFT JOIN store s ON s.path = r.parse_path
  WHERE (r.clean_status = 0 OR r.late) AND r.parse_status = 2 AND r.parse_path <> ''
)
SELECT r.id, r.parse_status, CAST(CASE WHEN f.ok THEN 2 WHEN f.id IS NOT NULL THEN -1 WHEN r.late THEN 0 ELSE r.clean_status END AS TINYINT) AS clean_status,
       r.parse_path, CASE WHEN f.id IS NOT NULL THEN {NOW} + 1 WHEN r.late THEN {NOW} ELSE r.updated_at END AS updated_at
FROM rec r LEFT JOIN flow f ON f.id = r.id"""

PREPARED = ONE_STEP + f""",
src AS (SELECT m.id, m.markdown AS s, m.file_name FROM md m JOIN one o ON o.id = m.id WHERE o.outcome <> 'parse_failed'),
{clean_chain('src', 'trim(file_name)', blocks=True)}"""

ORACLES["clean_records"] = PREPARED + """
SELECT m.id, m.file_uid, m.file_name, lower(m.file_ext) AS file_ext,
       '/tmp/parse/' || CAST(m.id AS VARCHAR) || '/' || m.file_name AS original_path, md5(m.markdown) AS markdown_md5
FROM md m WHERE m.has_md"""

ORACLES["upload_payloads"] = PREPARED + """
SELECT o.claim_no, CAST(count(*) AS INTEGER) AS n_texts, md5(string_agg(md5(c.s), ',' ORDER BY o.claim_pos)) AS texts_md5,
       string_agg(o.original_path, '|' ORDER BY o.claim_pos) AS file_sources
FROM one o JOIN cleaned c ON c.id = o.id GROUP BY o.claim_no"""

ORACLES["stored_cleaned"] = PREPARED + """
SELECT CAST(id AS VARCHAR) AS doc_key, md5(s) AS cleaned_md5 FROM cleaned"""

ORACLES["one_step_requests"] = f"""
WITH {REGISTRY.strip()},
f AS (
  SELECT id, original_path,
         CASE id % 5 WHEN 0 THEN ' a<b>:"c|?*' || CAST(id AS VARCHAR) || ' .pdf' WHEN 1 THEN NULL WHEN 2 THEN ' . .docx'
              WHEN 3 THEN 'x/y/d' || CAST(id AS VARCHAR) || '.PDF' ELSE file_name END AS name,
         CASE id % 5 WHEN 0 THEN 'a_b___c___' || CAST(id AS VARCHAR) || '.pdf' WHEN 1 THEN 'file_' || CAST(id AS VARCHAR)
              WHEN 2 THEN 'file_' || CAST(id AS VARCHAR) || '.docx' WHEN 3 THEN 'd' || CAST(id AS VARCHAR) || '.PDF'
              ELSE file_name END AS local,
         {NAME.format(p='original_path')} AS base
  FROM registry
)
SELECT 'copies' AS flow, id, local AS local_name, coalesce(name, local) AS request_name, coalesce(name, local) AS upload_name,
       '/tmp/parse/' || CAST(id AS VARCHAR) || '/' || local AS absolute_path FROM f
UNION ALL
SELECT 'one_step', id, base, coalesce(name, base), coalesce(name, base), original_path FROM f"""

ORACLES["ordered_results"] = REPLY_CHAIN + """
SELECT row_number() OVER (ORDER BY claim_no, batch_in_claim, batch_pos) - 1 AS position, id,
       CASE WHEN answered THEN 'success' ELSE 'failed' END AS parse_status
FROM exp"""

ORACLES["one_step_errors"] = f"""
WITH {REGISTRY.strip()},
o AS (
  SELECT id, CASE WHEN (id // 4) % 9 = 4 OR id % 6 = 3 OR NOT regexp_matches(text, '[^\\s]') AND id % 6 <> 1 THEN 'parse_failed'
                  WHEN id % 6 = 1 THEN 'clean_failed' WHEN {UPLOAD_OK.format(k='(id // 4)')} THEN 'uploaded' ELSE 'upload_failed' END AS outcome,
         clean_status
  FROM registry
)
SELECT id, outcome, CAST(CASE WHEN outcome = 'uploaded' THEN 2 ELSE -1 END AS TINYINT) AS parse_status,
       CAST(CASE outcome WHEN 'uploaded' THEN 2 WHEN 'parse_failed' THEN clean_status ELSE -1 END AS TINYINT) AS clean_status
FROM o"""

ORACLES["registry_views"] = f"""
WITH {REGISTRY.strip()}
SELECT 'pending_parse' AS view, id, original_path FROM registry WHERE parse_status = 0
UNION ALL SELECT 'failed_parse', id, original_path FROM registry WHERE parse_status = -1
UNION ALL SELECT 'pending_clean', id, original_path FROM registry WHERE clean_status = 0 AND parse_status = 2 AND parse_path <> ''
UNION ALL SELECT 'parsed', id, original_path FROM registry WHERE parse_status = 2 AND parse_path <> ''"""

ORACLES["status_pairs"] = f"""
WITH {REGISTRY.strip()}
SELECT parse_status, clean_status, count(*) AS files FROM registry GROUP BY ALL"""

ORACLES["parsed_pages"] = f"""
WITH {REGISTRY.strip()},
n AS (SELECT row_number() OVER (ORDER BY id) - 1 AS position, id, parse_path FROM registry WHERE parse_status = 2 AND parse_path <> '')
SELECT CAST(position // 50 AS INTEGER) AS page, position, id, parse_path FROM n WHERE position // 50 IN (0, 1, 4)"""

ORACLES["run_totals"] = CLEAN_FLOW.split("src AS (")[0].rstrip().rstrip(",") + f""",
raw AS ({ORACLES["raw_upload_counters"]}),
parse AS ({ORACLES["parse_counters"]})
SELECT 'clean' AS run,
       (SELECT count(*) FROM registry WHERE clean_status = 1 AND updated_at < {NOW} - 3600) AS recovered_processing,
       (SELECT count(*) FROM registry WHERE clean_status = -1) AS recovered_failed,
       count(*) AS picked, count(*) FILTER (WHERE ok) AS success, count(*) FILTER (WHERE NOT ok) AS failed,
       count(*) FILTER (WHERE ok) AS uploaded, CAST(NULL AS BIGINT) AS skipped,
       CAST(NULL AS BIGINT) AS downloaded, CAST(NULL AS BIGINT) AS unsupported, CAST(NULL AS BIGINT) AS passthrough FROM flow
UNION ALL SELECT 'raw_upload', NULL, NULL, picked, success, failed, uploaded, skipped, NULL, NULL, NULL FROM raw
UNION ALL SELECT 'parse', NULL, NULL, picked, success, failed, NULL, NULL, downloaded, unsupported, passthrough FROM parse WHERE claim_no IS NULL"""
