"""Queries of the localisation job itself, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomline.functions.structured import parse_error, response_text
from loomline.functions.text import collapsed, compose, line_feeds, source_hash
from loomline.functions.tokens import keeps_source, loose_numbers, numbers, punctuation_only, sounds_only, technical_tokens, term_count
from loomline.operators import batching, cascade, masking, report, worker
from loomline.operators.qa import Glossary, checked
from loomline.operators.replay import Resume, latest_records, line_index, overlaid, revalidated
from loomline.operators.skew import many_to_one
from loomline.plans import sql as S
from loomline.session import table, work_dir, written
from loomline.sources import files, schemas
from loomline.sources.provider import requests_of
from loomline.streaming.latest import LatestTable, latest_stream

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _job(spark, sf):
    return compose(table(spark, sf, "story_job"), "english", "japanese")


def _glossary(spark, sf):
    return Glossary.of(table(spark, sf, "glossary_terms"))


def _joined(c, sep="|"):
    return F.array_join(c, sep)


def _resume(spark, sf):
    return Resume(table(spark, sf, "story_job"), table(spark, sf, "story_translations"), table(spark, sf, "story_failures"), _glossary(spark, sf))


@query(f"SELECT ord, {S.norm('english')} AS english, {S.flat(S.norm('english'))} AS comparable FROM story_job")
def q01_normalised_text(spark, sf):
    en = line_feeds(F.col("english"))
    return _job(spark, sf).select("ord", en.alias("english"), collapsed(en).alias("comparable"))


@query(f"""SELECT ord, sha256(coalesce(file, '') || chr(31) || coalesce("row"::VARCHAR, '') || chr(31) || {S.norm('english')} || chr(31) || {S.norm('japanese')}) AS hash,
  sha256(coalesce(file, '') || chr(31) || coalesce("row"::VARCHAR, '') || chr(31) || {S.norm('english')} || chr(31) || {S.norm('japanese')}) IS NOT DISTINCT FROM "sourceHash" AS fits FROM story_job""")
def q02_source_hash(spark, sf):
    h = source_hash(F.col("file"), F.col("row"), F.col("english"), F.col("japanese"))
    return _job(spark, sf).select("ord", h.alias("hash"), h.eqNullSafe(F.col("sourceHash")).alias("fits"))


@query(f"SELECT ord, array_to_string({S.tech(S.norm('english'))}, '|') AS tokens FROM story_job")
def q03_technical_tokens(spark, sf):
    return _job(spark, sf).select("ord", _joined(technical_tokens(line_feeds(F.col("english")))).alias("tokens"))


@query(f"SELECT ord, array_to_string({S.nums(S.norm('english'))}, '|') AS numbers FROM story_job")
def q04_numbers(spark, sf):
    return _job(spark, sf).select("ord", _joined(numbers(line_feeds(F.col("english")))).alias("numbers"))


@query(f"SELECT ord, array_to_string({S.loose(S.norm('japanese'))}, '|') AS numbers FROM story_job")
def q05_loose_numbers(spark, sf):
    return _job(spark, sf).select("ord", _joined(loose_numbers(line_feeds(F.col("japanese")))).alias("numbers"))


def _glossary_terms(spark, sf):
    """(term, kept) of the whole glossary; a kept term counts with its case only."""
    g = _glossary(spark, sf)
    return [(t, True) for t in g.keep] + [(t, False) for t in g.translate if t not in g.keep]


@query(f"WITH {S.TERMS}, n AS (SELECT term, {S.count_of('english')} AS n FROM story_job, terms) SELECT term, count(*) FILTER (n > 0) AS lines, coalesce(sum(n), 0)::BIGINT AS occurrences FROM n GROUP BY term")
def q06_term_counts(spark, sf):
    terms = _glossary_terms(spark, sf)
    n = F.array(*[F.struct(F.lit(t).alias("term"), term_count(F.coalesce("english", F.lit("")), t, k).cast("bigint").alias("n")) for t, k in terms])
    hits = table(spark, sf, "story_job").select(F.inline(F.filter(n, lambda x: x.n > 0)))
    sums = hits.groupBy("term").agg(F.count(F.lit(1)).alias("lines"), F.sum("n").alias("occurrences"))
    every = spark.createDataFrame([(t,) for t, _ in terms], "term string")
    return every.join(sums, "term", "left").select("term", F.coalesce("lines", F.lit(0)).cast("bigint").alias("lines"), F.coalesce("occurrences", F.lit(0)).cast("bigint").alias("occurrences"))


def _batched(spark, sf, items=10, chars=5200):
    job = table(spark, sf, "story_job").withColumn("w", batching.line_weight(F.col("english"), F.col("japanese")))
    return batching.greedy_batches(job, "ord", "w", items, chars)


@query(f"WITH RECURSIVE {S.batches()}, {S.TERMS} SELECT DISTINCT batch_id::BIGINT AS batch_id, term FROM batches, terms WHERE {S.count_of('english')} > 0")
def q07_batch_terms(spark, sf):
    terms, b = _glossary_terms(spark, sf), _batched(spark, sf)
    keep = batching.batch_terms(b, "english", [t for t, k in terms if k], True)
    return keep.unionByName(batching.batch_terms(b, "english", [t for t, k in terms if not k], False))


_PAIRS = 'pairs AS (SELECT t.seq AS seq, t.vietnamese AS candidate, l.id AS id, l.english AS english, l.japanese AS japanese FROM story_translations t JOIN lines l ON l.key = t.key AND l."sourceHash" = t."sourceHash")'


def _checked_log(spark, sf):
    # Texts are composed before the join, which then stands once in the plan.
    log = compose(table(spark, sf, "story_translations").select("seq", "key", "sourceHash", "vietnamese"), "vietnamese")
    lines = compose(line_index(table(spark, sf, "story_job").select("ord", "key", "sourceHash", "id", "english", "japanese")), "english", "japanese").drop("ord")
    return checked(many_to_one(log, lines, ["key", "sourceHash"]), _glossary(spark, sf))


@query(f"WITH {S.LINES}, {_PAIRS}, {S.qa_ctes('pairs')} SELECT seq, len(errors) = 0 AS ok, array_to_string(errors, '|') AS errors, array_to_string(warnings, '|') AS warnings FROM qa")
def q08_checks(spark, sf):
    return _checked_log(spark, sf).select("seq", "check.ok", _joined("check.errors").alias("errors"), _joined("check.warnings").alias("warnings"))


@query(f"WITH {S.LINES}, {_PAIRS}, {S.qa_ctes('pairs')} SELECT CASE WHEN len(errors) > 0 THEN 'REJECTED' WHEN len(warnings) > 0 THEN 'REVIEW' ELSE 'LOCAL_OK' END AS status, count(*) AS rows FROM qa GROUP BY 1")
def q09_status_counts(spark, sf):
    s = F.when(~F.col("check.ok"), "REJECTED").when(F.size("check.warnings") > 0, "REVIEW").otherwise("LOCAL_OK")
    return _checked_log(spark, sf).groupBy(s.alias("status")).agg(F.count(F.lit(1)).alias("rows"))


@query(f"WITH {S.LINES}, {_PAIRS}, {S.qa_ctes('pairs')}, e AS (SELECT unnest(list_concat(errors, warnings)) AS code FROM qa) SELECT code, count(*) AS rows FROM e GROUP BY code")
def q10_code_histogram(spark, sf):
    codes = _checked_log(spark, sf).select(F.explode(F.concat("check.errors", "check.warnings")).alias("code"))
    return codes.groupBy("code").agg(F.count(F.lit(1)).alias("rows"))


def _sounds_sql():
    bare = S.doubled(S.flat(S.norm("english")))
    for t in S.KEEP:
        bare = f"regexp_replace({bare}, '({S.OUTER}){t}({S.OUTER})', '\\1 \\2', 'g')"
    return rf"""WITH s AS (SELECT ord, {S.strip(S.norm('english'))} AS t, regexp_extract_all({bare}, '[A-Za-z]+') AS w, starts_with({S.strip("coalesce(id, '')")}, 'TXT_CV_') AS meta FROM story_job)
SELECT ord, t <> '' AND NOT regexp_matches(t, '[\p{{L}}\p{{N}}]') AS punctuation, len(w) > 0 AND len(list_filter(w, lambda x: NOT regexp_matches(x, '(?i)^(?:{S.SOUNDS})$'))) = 0 AS sounds, meta FROM s"""


@query(_sounds_sql())
def q11_line_kinds(spark, sf):
    from loomline.functions.text import strip

    en = line_feeds(F.col("english"))
    return _job(spark, sf).select("ord", punctuation_only(strip(en)).alias("punctuation"), sounds_only(collapsed(en), list(_glossary(spark, sf).keep)).alias("sounds"), keeps_source(F.col("id")).alias("meta"))


@query(f"WITH {S.LINES}, {S.LATEST} SELECT key, seq, status FROM latest")
def q12_latest_records(spark, sf):
    return latest_records(table(spark, sf, "story_translations"), line_index(table(spark, sf, "story_job"))).select("key", "seq", "status")


@query(f"WITH {S.ROUTES} SELECT key, seq, route, CASE WHEN route = 'requeued' THEN array_to_string(errors, '|') END AS errors FROM routes")
def q13_revalidated(spark, sf):
    r = revalidated(table(spark, sf, "story_translations"), line_index(table(spark, sf, "story_job")), _glossary(spark, sf))
    return r.select("key", "seq", "route", F.when(F.col("route") == "requeued", _joined("check.errors")).alias("errors"))


@query(f"WITH {S.STATE} SELECT b.key AS key, b.key NOT IN (SELECT key FROM records) AS active FROM backlog b")
def q14_failure_backlog(spark, sf):
    r = _resume(spark, sf)
    return r.backlog.join(r.records().select("key", F.lit(True).alias("done")), "key", "left").select("key", F.col("done").isNull().alias("active"))


@query(f"WITH {S.STATE} SELECT key, action, target FROM meta")
def q15_metadata_overlay(spark, sf):
    return _resume(spark, sf).metadata().select("key", "action", "target")


@query(f"WITH {S.STATE} SELECT key, vietnamese FROM inherited")
def q16_inherited_overlay(spark, sf):
    return _resume(spark, sf).inherited()


@query(f"WITH {S.STATE} SELECT ord, key FROM story_job WHERE key IS NOT NULL AND key NOT IN (SELECT key FROM records) AND key NOT IN (SELECT key FROM historical)")
def q17_fresh_queue(spark, sf):
    return _resume(spark, sf).fresh()


@query(f"WITH {S.STATE} SELECT ord, key FROM story_job WHERE key NOT IN (SELECT key FROM records) AND key IN (SELECT key FROM historical)")
def q18_recovery_queue(spark, sf):
    return _resume(spark, sf).recovery()


@query("WITH RECURSIVE " + S.batches() + " SELECT ord, batch_id::BIGINT AS batch_id FROM batches")
def q19_greedy_batches(spark, sf):
    return _batched(spark, sf).select("ord", "batch_id")


@query("WITH RECURSIVE " + S.batches() + """, b AS (SELECT batch_id::BIGINT AS batch_id, count(*) AS lines, sum(length(coalesce(english, '')))::BIGINT AS chars FROM batches GROUP BY batch_id)
SELECT batch_id, lines, chars, least(3072, greatest(384, ceil(chars * 0.72)::BIGINT + lines * 24 + 128))::BIGINT AS budget FROM b""")
def q20_token_budget(spark, sf):
    return batching.token_budget(_batched(spark, sf), "english")


@query("""WITH p AS (SELECT request_id, any_value(phase) AS phase FROM story_requests GROUP BY request_id),
n AS (SELECT request_id, phase, row_number() OVER (PARTITION BY phase ORDER BY request_id) - 1 AS i FROM p)
SELECT request_id, phase, (211 + CASE WHEN phase IN ('PILOT', 'PRIMARY') THEN i WHEN phase = 'PRIMARY_REPAIR' THEN 300000 + i * 100 + 10 + 1 WHEN phase = 'RECOVERY_SMALL_BATCH' THEN 100000 + i WHEN phase = 'RECOVERY_SINGLE' THEN 200000 + 10 + 1 END)::BIGINT AS seed FROM n""")
def q21_seeds(spark, sf):
    # Request numbers within a phase stand for the batch; item and attempt are 1.
    once = table(spark, sf, "story_requests").groupBy("request_id").agg(F.first("phase").alias("phase"))
    from loomline.operators.running import running_sums

    phases = ["PILOT", "PRIMARY", "PRIMARY_REPAIR", "RECOVERY_SMALL_BATCH", "RECOVERY_SINGLE"]
    flags = once.withColumns({f"is_{p}": (F.col("phase") == p).cast("bigint") for p in phases})
    n = running_sums(flags, "request_id", [f"is_{p}" for p in phases])
    i = F.coalesce(*[F.when(F.col("phase") == p, F.col(f"run_is_{p}") - 1) for p in phases])
    return n.select("request_id", "phase", batching.phase_seed(F.col("phase"), i, F.lit(1), F.lit(1)).cast("bigint").alias("seed"))


@query("WITH RECURSIVE " + S.batches() + """, b AS (SELECT batch_id::BIGINT AS batch_id, count(*) AS items FROM batches GROUP BY batch_id),
r AS (SELECT batch_id, items, sum(items) OVER (ORDER BY batch_id)::BIGINT AS run_items FROM b) SELECT batch_id, items, run_items FROM r WHERE run_items - items < 100""")
def q22_pilot_prefix(spark, sf):
    per = _batched(spark, sf).groupBy("batch_id").agg(F.count(F.lit(1)).alias("items"))
    return cascade.pilot_batches(per)


_ATTEMPTS = f"""{S.LINES}, pairs AS (SELECT t.seq AS seq, t.key AS key, t.vietnamese AS candidate, l.id AS id, l.english AS english, l.japanese AS japanese
  FROM story_translations t JOIN lines l ON l.key = t.key AND l."sourceHash" = t."sourceHash"), {S.qa_ctes('pairs')},
att AS (SELECT key, row_number() OVER (PARTITION BY key ORDER BY seq) AS n, len(errors) = 0 AS ok, errors, warnings FROM qa),
a6 AS (SELECT * FROM att WHERE n <= 6),
win AS (SELECT key, min(n) AS n FROM a6 WHERE ok GROUP BY key),
made AS (SELECT key, max(n) AS made FROM a6 GROUP BY key),
won AS (SELECT a.key AS key, a.n AS n, CASE WHEN (a.n > 1 AND a.n <= 3) OR a.n > 4 THEN list_append(a.warnings, 'RECOVERED_AFTER_QA_REJECTION') ELSE a.warnings END AS warnings FROM a6 a JOIN win w ON w.key = a.key AND w.n = a.n)"""


def _attempts(spark, sf):
    """The log rows of a line, in order, stand for its attempts."""
    log = table(spark, sf, "story_translations").select("seq", "key", "sourceHash", "vietnamese")
    lines = line_index(table(spark, sf, "story_job")).select("key", "sourceHash", "id", "english", "japanese")
    pairs = many_to_one(log, lines, ["key", "sourceHash"])
    # Spark keeps only the first few rows of a key before the shuffle (group limit).
    first = pairs.withColumn("attempt_no", F.row_number().over(Window.partitionBy("key").orderBy("seq"))).filter(F.col("attempt_no") <= cascade.LAST)
    return checked(compose(first, "vietnamese", "english", "japanese"), _glossary(spark, sf)).select("key", "attempt_no", "check.ok", "check.errors", "check.warnings")


@query(f"WITH {_ATTEMPTS} SELECT key, CASE WHEN len(warnings) > 0 THEN 'REVIEW' ELSE 'LOCAL_OK' END AS status, CASE WHEN n = 1 THEN 'PRIMARY' WHEN n <= 3 THEN 'PRIMARY_REPAIR' WHEN n = 4 THEN 'RECOVERY_SMALL_BATCH' ELSE 'RECOVERY_SINGLE' END AS phase, (CASE WHEN n > 1 AND n <= 3 THEN n ELSE 1 END)::INT AS attempts, array_to_string(warnings, '|') AS warnings FROM won")
def q23_first_success(spark, sf):
    out = cascade.outcomes(_attempts(spark, sf)).filter(F.col("status").isin("REVIEW", "LOCAL_OK"))
    return out.select("key", "status", "phase", F.col("attempts").cast("int").alias("attempts"), _joined("warnings").alias("warnings"))


@query(f"""WITH {_ATTEMPTS}, lost AS (SELECT m.key AS key, m.made AS made FROM made m WHERE m.key NOT IN (SELECT key FROM win)),
e AS (SELECT key, n, unnest(errors) AS e FROM a6 WHERE n > 4), f AS (SELECT key, array_to_string(list_sort(list(DISTINCT e)), '|') AS errors FROM e GROUP BY key)
SELECT l.key AS key, CASE WHEN made >= 6 THEN 'TECHNICAL_ERROR' ELSE 'PENDING' END AS status, CASE WHEN made >= 6 THEN coalesce(f.errors, 'MODEL_RETRY_EXHAUSTED') ELSE '' END AS errors FROM lost l LEFT JOIN f ON f.key = l.key""")
def q24_unfinished(spark, sf):
    out = cascade.outcomes(_attempts(spark, sf)).filter(F.col("status").isin("TECHNICAL_ERROR", "PENDING"))
    return out.select("key", "status", _joined(F.array_sort("errors")).alias("errors"))


def _results(spark, sf):
    return written(cascade.batch_results(table(spark, sf, "story_requests"), table(spark, sf, "story_failures")), "results")


_RUNS = ", ".join(f"run_{c}" for c in S.RUN_COLUMNS)


@query(f"WITH {S.COUNTERS} SELECT batch_id, {_RUNS} FROM run")
def q25_running_counters(spark, sf):
    return cascade.running_counters(_results(spark, sf)).select("batch_id", *[f"run_{c}" for c in S.RUN_COLUMNS])


@query(f"WITH {S.COUNTERS} SELECT batch_id, gate FROM gated WHERE gate IS NOT NULL")
def q26_gates(spark, sf):
    return cascade.gates(cascade.running_counters(_results(spark, sf))).filter("gate is not null").select("batch_id", "gate")


_PILOT = """, pil AS (SELECT * FROM (SELECT *, run_items - items AS before FROM run) WHERE before < 100)"""


@query(f"WITH {S.COUNTERS}{_PILOT} SELECT count(*) AS batches, sum(items)::BIGINT AS items, sum(accepted) / sum(items) AS acceptance, sum(direct) / sum(items) AS direct_rate, CASE WHEN sum(accepted) / sum(items) < 0.98 THEN 'PILOT_ACCEPTANCE_TOO_LOW' ELSE 'PASSED' END AS verdict FROM pil")
def q27_pilot_verdict(spark, sf):
    return cascade.pilot_verdict(_results(spark, sf))


@query(f"WITH {S.COUNTERS}{_PILOT}, v AS (SELECT max(batch_id) AS e, sum(accepted) / sum(items) AS r FROM pil), c AS (SELECT min(batch_id) AS c FROM gated WHERE gate IS NOT NULL) SELECT batch_id, gate FROM gated, v, c WHERE batch_id <= least(coalesce(c, 1e18), CASE WHEN r < 0.98 THEN e ELSE 1e18 END)")
def q28_until_first_gate(spark, sf):
    return cascade.until_first_gate(cascade.gates(cascade.running_counters(_results(spark, sf)))).select("batch_id", "gate")


@query(f"""WITH {S.STATE}, r AS (SELECT count(*) AS completed, count(*) FILTER (status = 'INHERITED_R3') AS inherited, count(*) FILTER (status = 'LOCAL_OK') AS local_ok, count(*) FILTER (status = 'REVIEW') AS review, count(*) FILTER (status = 'TECHNICAL_ERROR') AS technical_errors FROM records), t AS (SELECT count(*) AS total FROM lines)
SELECT total, completed, total - completed AS remaining, inherited, local_ok, review, technical_errors, CASE WHEN completed = total AND technical_errors = 0 THEN 'COMPLETE' ELSE 'COMPLETE_WITH_ERRORS' END AS status FROM r, t""")
def q29_final_report(spark, sf):
    r = _resume(spark, sf)
    return report.final_report(r.lines, r.records())


@query("""WITH o AS (SELECT request_id, any_value(phase) AS phase, any_value(usage) AS usage FROM story_requests GROUP BY request_id), e AS (SELECT phase, unnest(map_entries(usage)) AS e FROM o)
SELECT phase, e.key AS counter, sum(e.value)::BIGINT AS total FROM e GROUP BY 1, 2""")
def q30_usage_totals(spark, sf):
    return report.usage_totals(table(spark, sf, "story_requests"))


@query("""WITH o AS (SELECT request_id, any_value(accepted) AS accepted, greatest(0.001, coalesce(any_value("elapsedSeconds"), 0)) AS s, coalesce(any_value(usage['completion_tokens']), 0) AS tokens FROM story_requests GROUP BY request_id),
a AS (SELECT count(*) AS requests, sum(accepted)::BIGINT AS accepted, sum(s) AS seconds, sum(tokens)::BIGINT AS tokens FROM o), b AS (SELECT *, accepted / greatest(1.0 / 60, seconds / 60) AS per_minute FROM a),
r AS (SELECT count(DISTINCT key) AS remaining FROM story_job WHERE key NOT IN (SELECT key FROM story_translations WHERE key IS NOT NULL))
SELECT requests, accepted, tokens, remaining, round(per_minute, 3) AS per_minute, round(CASE WHEN tokens > 0 THEN tokens / seconds ELSE 0 END, 3) AS tokens_per_second,
  floor(remaining / per_minute / 60)::BIGINT::VARCHAR || 'h' || lpad(ceil((remaining / per_minute) % 60)::BIGINT::VARCHAR, 2, '0') AS eta FROM b, r""")
def q31_throughput(spark, sf):
    left = table(spark, sf, "story_job").join(table(spark, sf, "story_translations").select("key"), "key", "left_anti").filter("key is not null").agg(F.countDistinct("key")).first()[0]
    t = report.throughput(table(spark, sf, "story_requests"), left)
    return t.select("requests", "accepted", "tokens", "remaining", F.round("per_minute", 3).alias("per_minute"), F.round("tokens_per_second", 3).alias("tokens_per_second"), "eta")


@query("""WITH o AS (SELECT request_id, any_value(phase) AS phase, any_value("itemCount") AS items, any_value(accepted) AS accepted, any_value("parseError") AS e, any_value("elapsedSeconds") AS s FROM story_requests GROUP BY request_id)
SELECT phase, count(*) AS requests, sum(items)::BIGINT AS items, sum(accepted)::BIGINT AS accepted, sum(accepted) / sum(items) AS acceptance, count(e) AS parse_errors, max(s) AS slowest FROM o GROUP BY phase""")
def q32_request_rates(spark, sf):
    return report.request_rates(table(spark, sf, "story_requests"))


@query(f"""WITH {S.STATE} SELECT l.file AS file, count(*) AS source, count(*) FILTER (r.status IS NOT NULL AND r.status <> 'TECHNICAL_ERROR') AS translated, count(*) FILTER (r.status = 'TECHNICAL_ERROR') AS fallback, count(*) FILTER (r.status IS NULL) AS blocked
FROM lines l LEFT JOIN records r ON r.key = l.key GROUP BY l.file""")
def q33_reconciliation(spark, sf):
    r = _resume(spark, sf)
    return report.reconciliation(r.lines, r.records())


@query("SELECT key, count(*) AS lines FROM story_job GROUP BY key HAVING count(*) > 1")
def q34_repeated_keys(spark, sf):
    return report.repeated_keys(table(spark, sf, "story_job"))


@query(rf"""WITH c AS (SELECT request_id, regexp_replace(regexp_replace({S.strip(S.norm('"responsePreview"'))}, '(?i)^```(?:json)?{S.WS}*', ''), '{S.WS}*```$', '') AS t FROM story_failures)
SELECT request_id, CASE WHEN NOT json_valid(t) THEN 'INVALID_JSON' WHEN json_type(CASE WHEN json_valid(t) THEN t ELSE 'null' END) <> 'OBJECT' THEN 'JSON_ROOT_NOT_OBJECT' END AS error FROM c""")
def q35_parse_errors(spark, sf):
    return table(spark, sf, "story_failures").select("request_id", parse_error(F.col("responsePreview")).alias("error"))


@query(S.masked())
def q36_mask_restore(spark, sf):
    """Every text is masked batch by batch and restored; beside the text, what stays
    unmasked is compared, with each marker as one letter and all other signs doubled."""
    b = compose(_batched(spark, sf), "english").withColumn("english", line_feeds(F.col("english")))
    m = masking.masked(b, "batch_id", "ord", "english", list(_glossary(spark, sf).keep))
    bare = F.regexp_replace("masked", "LOOMKEEP[0-9]{6,}END", "\ua66e")
    bare = F.concat(F.lit(" "), F.regexp_replace(bare, r"([^\p{L}\p{N}_])", "$1$1"), F.lit(" "))
    return m.select("ord", masking.restored(F.col("masked"), F.col("replacements")).alias("text"), bare.alias("bare"))


@query()
def q37_alias_repair(spark, sf):
    """Every line with every kept term misspelt in upper case, repaired; tested by brute
    force, as SQL cannot replace a number of occurrences that differs by row."""
    rows = compose(table(spark, sf, "story_job").select("ord", "english"), "english").withColumn("repaired", F.coalesce("english", F.lit("")))
    keep = _glossary(spark, sf).keep
    for t in keep:
        rows = rows.withColumn("repaired", F.replace("repaired", F.lit(t), F.lit(t.upper() + "S")))
    rows = rows.withColumn("repairs", F.expr("cast(array() as array<string>)"))
    for t in keep:
        pattern = rf"(?<![\p{{L}}\p{{N}}_]){t}s?(?![\p{{L}}\p{{N}}_])"
        done = masking.repaired_aliases(rows.withColumnsRenamed({"repaired": "c", "repairs": "before"}), "english", "c", t, [pattern])
        rows = done.select("ord", "english", "repaired", F.concat("before", "repairs").alias("repairs"))
    return rows.select("ord", "repaired", _joined("repairs").alias("repairs"))


@query(f"""WITH {S.LINES}, {_PAIRS}, {S.qa_ctes('pairs')}
SELECT seq, CASE WHEN NOT list_contains(errors, 'UNEXPECTED_CJK') THEN coalesce(japanese, '') END AS japanese,
  CASE WHEN len(list_filter(errors, lambda e: regexp_matches(e, '^(?:UNEXPECTED_CJK|UNCHANGED_ENGLISH|PROTECTED_TERM_MISSING:|UNRESTORED_MARKER|MODEL_META_LEAK|EMPTY)'))) > 0 THEN '' ELSE coalesce(nfc_normalize(candidate), '') END AS previous,
  array_to_string(errors, '|') AS problems FROM qa WHERE len(errors) > 0""")
def q38_repair_projection(spark, sf):
    rows = _checked_log(spark, sf).filter(~F.col("check.ok")).select(F.col("seq").alias("key"), "japanese", F.col("vietnamese").alias("candidate"), F.col("check.errors").alias("errors"))
    p = cascade.repair_projection(rows)
    return p.select(F.col("key").alias("seq"), "japanese", "previous", _joined("problems").alias("problems"))


@query(f"WITH {S.STATE} SELECT key, status, vietnamese FROM records ORDER BY key")
def q39_ordered_result(spark, sf):
    return files.ordered(_resume(spark, sf).records())


@query(f"""WITH {S.STATE} SELECT j.ord AS ord, j.key AS key, CASE WHEN coalesce(r.vietnamese, '') <> '' AND r.status <> 'TECHNICAL_ERROR' THEN r.vietnamese ELSE j.english END AS text,
CASE WHEN coalesce(r.vietnamese, '') <> '' AND r.status <> 'TECHNICAL_ERROR' THEN 'translated' ELSE 'fallback' END AS origin FROM story_job j LEFT JOIN records r ON r.key = j.key""")
def q40_downstream_texts(spark, sf):
    return overlaid(table(spark, sf, "story_job"), _resume(spark, sf).records())


@query('SELECT request_id, phase, "itemCount", coalesce(array_to_string(keys, \'|\'), \'\') AS keys FROM story_failures')
def q41_tolerant_log(spark, sf):
    """The failure log as JSON lines among blank and torn ones, read back."""
    path = work_dir(spark, "log")
    rows = table(spark, sf, "story_failures").select("request_id", "phase", "itemCount", "keys")
    files.append_log(rows, path)
    torn = rows.select(F.explode(F.array(F.lit(""), F.lit('{"request_id": 7, "phase": "PI'), F.lit("   "))).alias("value")).distinct()
    torn.write.mode("append").text(path)
    log = files.read_log(spark, path, schemas.FAILURE)
    return log.select("request_id", "phase", "itemCount", F.coalesce(_joined("keys"), F.lit("")).alias("keys"))


@query(f"WITH {S.LINES}, {S.LATEST} SELECT key, seq, status FROM latest")
def q42_streamed_latest(spark, sf):
    """q12 from a stream of the log's files."""
    folder = work_dir(spark, "feed")
    table(spark, sf, "story_translations").repartition(4, "seq").write.parquet(folder)
    held = LatestTable(spark, work_dir(spark, "state"), schemas.RECORD)
    latest_stream(spark, folder, schemas.RECORD, line_index(table(spark, sf, "story_job")), held, files_per_batch=2).awaitTermination()
    return held.read().select("key", "seq", "status")


def _provider(request):
    """A stand-in that fails as often as the last digit of a line's key says, by turns
    with an empty text, one in kanji and no text at all."""
    import json

    out = {}
    for row in request["rows"]:
        if request["attempt"] > int(row["key"][-1]) % 8:
            out[row["key"]] = (row.get("english") or "") + " ạ"
        elif request["attempt"] % 3:
            out[row["key"]] = ["", "", "日本"][request["attempt"] % 3]
    return json.dumps(out)


def _cascade(spark, sf):
    lines = line_index(table(spark, sf, "story_job")).filter(F.col("key").rlike("[0-9]$"))
    return worker.run(lines, _provider, _glossary(spark, sf))


@query(rf"""WITH {S.LINES}, l AS (SELECT * FROM lines WHERE regexp_matches(key, '[0-9]$')),
good AS (SELECT key, id, english, japanese, coalesce(english, '') || ' ạ' AS candidate FROM l), {S.qa_ctes('good')},
p AS (SELECT key, candidate, errors, warnings, right(key, 1)::INT % 8 AS f,
  {S.strip("coalesce(english, '')")} <> '' AND NOT regexp_matches(coalesce(english, ''), '[\p{{L}}\p{{N}}]') AS bare FROM qa),
n AS (SELECT *, CASE WHEN len(errors) = 0 AND f < 6 THEN f + 1 END AS n FROM p)
SELECT key, CASE WHEN n IS NULL THEN 'TECHNICAL_ERROR' WHEN len(warnings) > 0 OR n IN (2, 3, 5, 6) THEN 'REVIEW' ELSE 'LOCAL_OK' END AS status,
  CASE WHEN n = 1 THEN 'PRIMARY' WHEN n <= 3 THEN 'PRIMARY_REPAIR' WHEN n = 4 THEN 'RECOVERY_SMALL_BATCH' WHEN n <= 6 THEN 'RECOVERY_SINGLE' END AS phase,
  (CASE WHEN n IS NULL THEN 3 WHEN n IN (2, 3) THEN n ELSE 1 END)::INT AS attempts FROM n WHERE NOT bare""")
def q43_cascade(spark, sf):
    """All phases run against a stand-in provider.  Lines of mere punctuation, which an
    empty answer copies, are compared in a test."""
    bare = line_index(table(spark, sf, "story_job")).filter(~F.coalesce(F.col("english"), F.lit("")).rlike(r"[\p{L}\p{N}]") & (F.trim(F.coalesce("english", F.lit(""))) != ""))
    return _cascade(spark, sf).records.join(bare.select("key"), "key", "left_anti").select("key", "status", "phase", F.col("attempts").cast("int").alias("attempts"))


@query("WITH RECURSIVE " + S.batches(3, 2200) + " SELECT ord, batch_id::BIGINT AS batch_id FROM batches")
def q44_recovery_batches(spark, sf):
    """Recovery packs the queue into batches of 3 lines and 2200 characters."""
    return _batched(spark, sf, 3, 2200).select("ord", "batch_id")


@query("""WITH o AS (SELECT request_id, coalesce(any_value(usage['completion_tokens']), 0) AS t, greatest(0.001, coalesce(any_value("elapsedSeconds"), 0)) AS s FROM story_requests GROUP BY request_id)
SELECT request_id, round(CASE WHEN t > 0 THEN t / s ELSE 0 END, 3) AS speed FROM o""")
def q45_request_speed(spark, sf):
    once = table(spark, sf, "story_requests").dropDuplicates(["request_id"])
    return once.select("request_id", F.round(worker.speed(F.try_element_at("usage", F.lit("completion_tokens")), F.col("elapsedSeconds")), 3).alias("speed"))


_LINE = ["key", "file", "row", "id", "subid", "type", "english", "japanese", "currentVietnamese", "inheritedR3", "sourceHash"]


@query('SELECT (ord // 5000)::VARCHAR AS job, row_number() OVER (PARTITION BY ord // 5000 ORDER BY ord) AS ord, key, sha256(coalesce(english, \'\')) AS english, "inheritedR3" FROM story_job')
def q46_job_scan(spark, sf):
    """Job files of at most 5000 lines, written as JSON documents and read back."""
    path = work_dir(spark, "jobs")
    line = F.struct("ord", F.to_json(F.struct(*_LINE)).alias("j"))
    jobs = table(spark, sf, "story_job").groupBy(F.floor(F.col("ord") / 5000).cast("string").alias("job")).agg(F.array_sort(F.collect_list(line)).alias("a"))
    text = F.concat(F.lit('{"jobId":"'), F.col("job"), F.lit('","items":[\n'), F.array_join(F.transform("a", lambda x: x.j), ",\n"), F.lit("]}"))
    jobs.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return files.read_job(spark, path).select(F.col("jobId").alias("job"), "ord", "key", F.sha2(F.coalesce("english", F.lit("")), 256).alias("english"), "inheritedR3")


@query(f"WITH {S.STATE} SELECT key, status, sha256(coalesce(vietnamese, '')) AS text FROM records")
def q47_bundle(spark, sf):
    """The result bundle, read back from its archive."""
    r = _resume(spark, sf)
    done = written(r.records(), "records")
    archive = files.write_bundle(done, report.final_report(r.lines, done), work_dir(spark, "bundle"), "job", "hash")
    return files.read_bundle(spark, archive).select("key", "status", F.sha2(F.coalesce("vietnamese", F.lit("")), 256).alias("text"))


@query("SELECT request_id, CASE WHEN coalesce(\"responsePreview\", '') <> '' THEN regexp_replace(nfc_normalize(\"responsePreview\"), '\\r\\n?', chr(10), 'g') ELSE nfc_normalize(phase) END AS text FROM story_failures")
def q48_response_text(spark, sf):
    """The first of three fields of a response that is not empty."""
    rows = compose(table(spark, sf, "story_failures").select("request_id", "phase", "responsePreview"), "phase", "responsePreview")
    return rows.select("request_id", response_text(F.col("responsePreview"), F.lit(""), F.col("phase")).alias("text"))


@query("WITH RECURSIVE " + S.batches() + """ SELECT batch_id::BIGINT AS batch_id, array_to_string(list(key ORDER BY ord), '|') AS keys, count(*)::INT AS rows, count(DISTINCT key)::INT AS required FROM batches GROUP BY batch_id""")
def q49_prompt_rows(spark, sf):
    """Requests of the primary batches: keys in order, rows and the schema's keys."""
    req = requests_of(_batched(spark, sf))
    must = F.from_json("schema", "required array<string>").required
    return req.select("batch_id", _joined("keys").alias("keys"), F.size(F.from_json("rows", "array<struct<key string>>")).alias("rows"), F.size(must).alias("required"))
