"""SQL pieces that say the same as the Column functions, for the query oracles."""

from __future__ import annotations

import re

# Written down apart from the code, so a wrong pattern there shows here.
# Token classes, sounds and English words of the data format.
BRACES, ANGLES, ESCAPES = r"\{[^{}\r\n]*\}", r"<[^<>\r\n]*>", r'\\[nrt"\\]'
SOUNDS = "a+h+|g+r+a+h+|g+r+o+a+r+|g+r+|r+a+h+|r+o+a+r+|u+g+h+|h+m+|m+|s+h+|h+m+p+h+"
ENGLISH_HINTS = ["the", "and", "but", "with", "from", "this", "that", "have", "will", "would", "could", "should", "your", "their", "into", "before", "after"]
WS = r"[\s\x{0B}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
OUTER = r"[^\p{L}\p{N}_]"
PRINTF = r"%(?:\d+\$)?[-+#0'']*(?:\d+|\*)?(?:\.(?:\d+|\*))?[hlLzjt]*[diuoxXfFeEgGaAcspn%]"
KEEP = ["keeper", "scout", "baker", "pilot"]


def norm(x: str) -> str:
    return rf"regexp_replace(nfc_normalize(coalesce({x}, '')), '\r\n?', chr(10), 'g')"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def flat(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def tech(x: str) -> str:
    own = [f"regexp_extract_all({x}, '{p}')" for p in (BRACES, ANGLES, ESCAPES, r"[\x{E000}-\x{F8FF}]")]
    return f"list_sort(flatten([{', '.join(own)}, regexp_extract_all(regexp_replace({x}, '([0-9])%', '\\1', 'g'), '{PRINTF}')]))"


def canon(t: str) -> str:
    core = rf"regexp_extract({t}, '^[-+]?([0-9]+(?:[.,][0-9]+)*)', 1)"
    grouped = rf"regexp_matches({core}, '^[0-9]{{1,3}}(?:[.,][0-9]{{3}})+$')"
    whole = rf"CASE WHEN {grouped} THEN regexp_replace({core}, '[.,]', '', 'g') ELSE regexp_replace(regexp_replace({core}, '[.,][0-9]+$', ''), '[.,]', '', 'g') END"
    part = rf"CASE WHEN {grouped} THEN '' ELSE regexp_replace(regexp_extract({core}, '[.,]([0-9]+)$', 1), '0+$', '') END"
    return rf"regexp_extract({t}, '^([-+]?)', 1) || regexp_replace({whole}, '^0+([0-9])', '\1') || CASE WHEN {part} = '' THEN '' ELSE '.' || {part} END || lower(regexp_extract({t}, '([%xX]?)$', 1))"


def nums(x: str) -> str:
    a = rf"regexp_replace({x}, '([\p{{L}}\p{{N}}_])[-+]', '\1  ', 'g')"
    b = rf"regexp_replace({a}, '([^\p{{L}}\p{{N}}_.,+%-])', '\1\1', 'g')"
    return rf"list_sort(list_transform(regexp_extract_all({b}, '(?:^|{OUTER})([-+]?\d+(?:[.,]\d+)*(?:%|x)?)(?:$|{OUTER})', 1), lambda t: {canon('t')}))"


def loose(x: str) -> str:
    return rf"list_sort(list_transform(regexp_extract_all({x}, '[-+]?\d+(?:[.,]\d+)*'), lambda t: {canon('t')}))"


def doubled(x: str) -> str:
    return rf"(' ' || regexp_replace({x}, '({OUTER})', '\1\1', 'g') || ' ')"


def term_count(x: str, term: str, case_sensitive: bool) -> str:
    t = re.sub(r"[^\w]", lambda m: re.escape(m.group(0)) * 2, term).replace("\\ ", " ").replace("'", "''")
    flag = "" if case_sensitive else "(?i)"
    return f"len(regexp_extract_all({doubled(x)}, '{flag}{OUTER}{t}{OUTER}'))"


#: The glossary from its table; a kept term counts with its case only.
TERMS = "terms AS (SELECT term, bool_or(target IS NULL) AS keep FROM glossary_terms GROUP BY term)"


def count_of(x: str) -> str:
    """Whole-word occurrences of ``term`` from TERMS."""
    return rf"len(regexp_extract_all({doubled(x).replace(x, f"coalesce({x}, '')", 1)}, CASE WHEN keep THEN '' ELSE '(?i)' END || '{OUTER}' || regexp_replace(term, '([^\p{{L}}\p{{N}}_])', '[\1][\1]', 'g') || '{OUTER}'))"


def masked() -> str:
    """Every text, and the text with each token and kept term as the letter U+A66E,
    all signs but letters and digits doubled.  A percent sign after a digit begins no
    token, so U+A66D stands for it meanwhile."""
    t = norm("english")
    tokens = f"{BRACES}|{ANGLES}|{ESCAPES}|[\\x{{E000}}-\\x{{F8FF}}]|{PRINTF}"
    bare = rf"replace(regexp_replace(regexp_replace({t}, '([0-9])%', '\1' || chr(42605), 'g'), '{tokens}', chr(42606), 'g'), chr(42605), '%')"
    bare = doubled(bare)
    for term in sorted(KEEP, key=lambda k: (-len(k), k)):
        bare = f"regexp_replace({bare}, '({OUTER}){term}({OUTER})', '\\1' || chr(42606) || '\\2', 'g')"
    return f"SELECT ord, {t} AS text, {bare} AS bare FROM story_job"


def utf16(x: str) -> str:
    return rf"(length({x}) + len(regexp_extract_all({x}, '[\x{{10000}}-\x{{10FFFF}}]')))"


def qa_ctes(base: str, keep: list[str] = KEEP) -> str:
    """CTEs q1..qa over a CTE ``base`` with id, english, japanese, candidate; qa has
    its columns and errors, warnings as lists."""
    bare = doubled("en_flat")
    for t in keep:
        bare = f"regexp_replace({bare}, '({OUTER}){t}({OUTER})', '\\1 \\2', 'g')"
    kept_only = " OR ".join(f"en_flat = '{t}'" for t in keep)
    missing = ", ".join(f"CASE WHEN {term_count('raw', t, True)} > {term_count('vi', t, True)} THEN 'PROTECTED_TERM_MISSING:{t}' END" for t in keep)
    hints = ", ".join(f"'{w}'" for w in ENGLISH_HINTS)
    return rf"""
q1 AS (SELECT *, {norm('english')} AS en, {norm('japanese')} AS jp, coalesce(english, '') AS raw, {strip(norm('candidate'))} AS vi FROM {base}),
q2 AS (SELECT *, {tech('en')} AS en_tech, {tech('vi')} AS vi_tech, {nums('en')} AS en_num, {nums('vi')} AS vi_num, {loose('jp')} AS jp_num,
  {flat('en')} AS en_flat, {flat('vi')} AS vi_flat, starts_with({strip("coalesce(id, '')")}, 'TXT_CV_') AS meta FROM q1),
q3 AS (SELECT *, regexp_extract_all({bare}, '[A-Za-z]+') AS sounds,
  len(list_filter(string_split_regex(lower(vi), '{OUTER}+'), lambda w: w IN ({hints}))) AS hints,
  {utf16('raw')} AS n_raw, {utf16('vi')} AS n_vi FROM q2),
qa AS (SELECT *, list_filter([
  CASE WHEN vi = '' THEN 'EMPTY' END,
  CASE WHEN regexp_matches(vi, '[\p{{Han}}\p{{Hiragana}}\p{{Katakana}}\p{{Hangul}}]') THEN 'UNEXPECTED_CJK' END,
  CASE WHEN regexp_matches(vi, 'LOOMKEEP[0-9]+END') THEN 'UNRESTORED_MARKER' END,
  CASE WHEN regexp_matches(vi, '(?i)```|</?think>|/no_think|SOURCE_BEGIN|VIETNAMESE_BEGIN') THEN 'MODEL_META_LEAK' END,
  CASE WHEN en_tech <> vi_tech THEN 'TECHNICAL_TOKEN_MISMATCH' END,
  CASE WHEN en_num <> vi_num AND NOT (len(en_num) = 0 AND len(jp_num) > 0 AND jp_num = vi_num) THEN 'NUMBER_MISMATCH' END,
  {missing},
  CASE WHEN meta AND vi_flat <> en_flat THEN 'KEEP_ENGLISH_SOURCE_MISMATCH' END,
  CASE WHEN NOT meta AND NOT ({kept_only}) AND len(regexp_extract_all(en_flat, '[A-Za-z]+(?:[''’-][A-Za-z]+)*')) >= 2 AND lower(vi_flat) = lower(en_flat)
    AND NOT (len(sounds) > 0 AND len(list_filter(sounds, lambda w: NOT regexp_matches(w, '(?i)^(?:{SOUNDS})$'))) = 0) THEN 'UNCHANGED_ENGLISH' END
  ], lambda e: e IS NOT NULL) AS errors,
  list_filter([
  CASE WHEN meta AND vi_flat = en_flat THEN 'DETERMINISTIC_KEEP_ENGLISH_ID:TXT_CV' END,
  CASE WHEN hints >= 2 THEN 'POSSIBLE_ENGLISH_LEAK' END,
  CASE WHEN contains(raw, chr(10)) AND NOT contains(vi, chr(10)) THEN 'LINE_BREAKS_COLLAPSED' END,
  CASE WHEN n_raw >= 20 AND (n_vi / n_raw > 2.5 OR n_vi / n_raw < 0.22) THEN 'SUSPICIOUS_LENGTH_RATIO' END
  ], lambda e: e IS NOT NULL) AS warnings FROM q3)"""


#: One line per key; the newest log row of each key with its line's hash; routes.
LINES = "lines AS (SELECT * FROM story_job WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY ord DESC) = 1)"
LATEST = """latest AS (SELECT t.* FROM story_translations t JOIN lines l ON l.key = t.key AND l."sourceHash" = t."sourceHash"
  QUALIFY row_number() OVER (PARTITION BY t.key ORDER BY t.seq DESC) = 1)"""
ROUTES = f"""{LINES}, {LATEST},
base AS (SELECT t.key AS key, t.seq AS seq, t.status AS status, t.vietnamese AS vietnamese, t.vietnamese AS candidate, l.id AS id, l.english AS english, l.japanese AS japanese
  FROM latest t JOIN lines l ON l.key = t.key),
{qa_ctes('base')},
routes AS (SELECT key, seq, status, vietnamese, errors, CASE WHEN coalesce(vietnamese, '') <> '' THEN
    CASE WHEN status IS NOT DISTINCT FROM 'INHERITED_R3' OR len(errors) = 0 THEN 'valid' ELSE 'requeued' END
  WHEN status IS NOT DISTINCT FROM 'TECHNICAL_ERROR' THEN 'failed' ELSE 'none' END AS route FROM qa)"""
STATE = f"""{ROUTES},
backlog AS (SELECT DISTINCT k AS key FROM (SELECT unnest(keys) AS k FROM story_failures) WHERE k IN (SELECT key FROM lines)
  AND k NOT IN (SELECT key FROM routes WHERE route = 'valid')),
historical AS (SELECT key FROM routes WHERE route IN ('requeued', 'failed') UNION SELECT key FROM backlog),
meta AS (SELECT l.key AS key, {strip(norm('l.english'))} AS target,
    CASE WHEN r.route = 'valid' AND {strip(norm('r.vietnamese'))} = {strip(norm('l.english'))} THEN 'kept' WHEN r.route IS NOT DISTINCT FROM 'requeued' THEN 'corrected' ELSE 'added' END AS action
  FROM lines l LEFT JOIN routes r ON r.key = l.key WHERE starts_with({strip("coalesce(l.id, '')")}, 'TXT_CV_')),
inherited AS (SELECT key, "currentVietnamese" AS vietnamese FROM story_job
  WHERE "inheritedR3" AND key IS NOT NULL AND NOT starts_with({strip("coalesce(id, '')")}, 'TXT_CV_') AND key NOT IN (SELECT key FROM routes WHERE route = 'valid')
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY ord) = 1),
records AS (SELECT key, status, vietnamese FROM routes WHERE route = 'valid' AND key NOT IN (SELECT key FROM meta WHERE action <> 'kept')
  UNION ALL SELECT key, 'LOCAL_OK', target FROM meta WHERE action <> 'kept'
  UNION ALL SELECT key, 'INHERITED_R3', vietnamese FROM inherited)"""


def batches(items: int = 10, chars: int = 5200) -> str:
    return f"""
w AS (SELECT ord, key, english, row_number() OVER (ORDER BY ord) AS i, length(coalesce(english, '')) + length(coalesce(japanese, '')) + 200 AS w FROM story_job),
g(i, n, c, b) AS (SELECT i, 1, w, 0 FROM w WHERE i = 1
  UNION ALL SELECT w.i, CASE WHEN g.n >= {items} OR g.c + w.w > {chars} THEN 1 ELSE g.n + 1 END, CASE WHEN g.n >= {items} OR g.c + w.w > {chars} THEN w.w ELSE g.c + w.w END,
    CASE WHEN g.n >= {items} OR g.c + w.w > {chars} THEN g.b + 1 ELSE g.b END FROM g JOIN w ON w.i = g.i + 1),
batches AS (SELECT w.ord AS ord, w.key AS key, w.english AS english, g.b AS batch_id FROM w JOIN g ON g.i = w.i)"""


RESULTS = r"""
once AS (SELECT request_id, any_value(phase) AS phase, any_value("itemCount") AS items, any_value(accepted) AS ok FROM story_requests GROUP BY request_id),
broken AS (SELECT request_id, max(coalesce(len(list_filter(map_values(reasons), lambda r: len(list_filter(r, lambda e: regexp_matches(e, '^(?:INVALID_JSON:|JSON_ROOT_NOT_OBJECT$|MISSING_STRUCTURED_KEY$)'))) > 0)), 0)) AS broken
  FROM story_failures GROUP BY request_id),
numbered AS (SELECT o.*, coalesce(b.broken, 0) AS broken, phase <> 'PRIMARY_REPAIR' AS main,
    sum(CASE WHEN phase <> 'PRIMARY_REPAIR' THEN 1 ELSE 0 END) OVER (ORDER BY o.request_id) AS n
  FROM once o LEFT JOIN broken b ON b.request_id = o.request_id WHERE phase IN ('PILOT', 'PRIMARY', 'PRIMARY_REPAIR')),
per AS (SELECT n - 1 AS batch_id, sum(items) FILTER (main) AS items, sum(ok) FILTER (main) AS direct, coalesce(sum(ok) FILTER (NOT main), 0) AS fixed,
    coalesce(sum(broken) FILTER (main), 0) AS raw_structured_items FROM numbered WHERE n > 0 GROUP BY n),
res0 AS (SELECT batch_id, items, direct, least(fixed, items - direct) AS repaired, direct + least(fixed, items - direct) AS accepted, items - direct - least(fixed, items - direct) AS unresolved, raw_structured_items FROM per),
results AS (SELECT batch_id::BIGINT AS batch_id, items::BIGINT AS items, accepted::BIGINT AS accepted, direct::BIGINT AS direct, repaired::BIGINT AS repaired, unresolved::BIGINT AS unresolved,
    (direct = 0 AND items > 0)::BIGINT AS raw_wide, (accepted = 0 AND items > 0)::BIGINT AS wide, raw_structured_items::BIGINT AS raw_structured_items, (raw_structured_items > 0)::BIGINT AS raw_structured_batches,
    least(raw_structured_items, unresolved)::BIGINT AS structured_items, (least(raw_structured_items, unresolved) > 0)::BIGINT AS structured_batches FROM res0)"""
_RUN = ["items", "accepted", "direct", "repaired", "unresolved", "raw_wide", "wide", "raw_structured_items", "raw_structured_batches", "structured_items", "structured_batches"]
COUNTERS = RESULTS + ",\nrun AS (SELECT *, " + ", ".join(f"sum({c}) OVER (ORDER BY batch_id)::BIGINT AS run_{c}" for c in _RUN) + """, lead(batch_id) OVER (ORDER BY batch_id) IS NOT NULL AS more FROM results),
gated AS (SELECT *, CASE WHEN run_structured_batches > 1 THEN 'STRUCTURED_OUTPUT_FAILURE' WHEN run_wide > 0 THEN 'UNRECOVERED_BATCH_WIDE_FAILURE'
  WHEN more AND run_unresolved > 2 AND run_items < 100 THEN 'EARLY_RECOVERY_GROWTH'
  WHEN more AND run_unresolved > 2 AND run_items >= 100 AND run_unresolved / run_items > 0.01 THEN 'UNRESOLVED_RATE_TOO_HIGH' END AS gate FROM run)"""
RUN_COLUMNS = _RUN
