"""The whole cascade of attempts against a provider of candidate texts.

Every phase is one plan over all lines that still need a text: requests are made
from batches, answered in Arrow batches, repaired, checked, and what fails goes on
to the next phase.  Lines never meet on the driver, and each phase is written once,
so a lost executor repeats no request of an earlier phase.

Defined cases: null texts count as ''; a key that a response lacks, a value that is
no string and a response that is no JSON object fail as unstructured; an empty queue
gives empty results; of a key that stands twice in the queue both lines are asked
for, the outcome is one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import compose, strip
from loomline.functions.tokens import punctuation_only
from loomline.operators import batching, cascade, masking
from loomline.operators.qa import Glossary, checked
from loomline.session import written
from loomline.sources.provider import Config, attempts, requests_of

#: Characters of a response that the failure log keeps.
PREVIEW = 12_000
_NONE = "cast(array() as array<string>)"


def judged(rows: DataFrame, glossary: Glossary, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """rows(id, english, japanese, candidate, structured, error) with the text that is
    kept and ok, errors, warnings.

    Known misspellings of kept terms are repaired first; an empty answer to a source
    of mere punctuation becomes the source; both are warnings.  An unstructured
    response has its own error instead of the checks'.
    """
    rows = compose(rows, "english", "japanese", "candidate").withColumn("__notes", F.expr(_NONE))
    for term, patterns in (aliases or {}).items():
        if term in glossary.keep:
            rows = masking.repaired_aliases(rows, "english", "candidate", term, patterns)
            rows = rows.withColumns({"candidate": F.when(F.col("structured"), F.col("repaired")).otherwise(F.col("candidate")), "__notes": F.when(F.col("structured"), F.concat("__notes", "repairs")).otherwise(F.col("__notes"))}).drop("repaired", "repairs")
    source = F.coalesce("english", F.lit(""))
    copy = F.col("structured") & (strip(F.coalesce("candidate", F.lit(""))) == "") & punctuation_only(strip(source))
    rows = rows.withColumn("__copy", copy).withColumn("candidate", F.when(F.col("__copy"), source).otherwise(F.col("candidate")))
    out = checked(rows, glossary, candidate="candidate")
    note = F.when(F.col("__copy"), F.array(F.lit("DETERMINISTIC_PUNCTUATION_COPY"))).otherwise(F.expr(_NONE))
    return out.withColumns(
        {
            "ok": F.col("structured") & F.col("check.ok"),
            "errors": F.when(F.col("structured"), F.col("check.errors")).otherwise(F.array("error")),
            "warnings": F.array_distinct(F.concat("check.warnings", "__notes", note)),
        }
    ).drop("check", "__notes", "__copy")


@dataclass
class Outcome:
    """attempts(key, attempt_no, candidate, ok, errors, warnings), the request and
    failure logs, and records(key, status, phase, attempts, warnings, errors, vietnamese)."""

    attempts: DataFrame
    requests: DataFrame
    failures: DataFrame
    records: DataFrame


def run(lines: DataFrame, answer: Callable[[dict], str], glossary: Glossary, config: Config = Config(), recovery: DataFrame | None = None, aliases: dict[str, list[str]] | None = None) -> Outcome:
    """Takes ``lines`` (ord, key, id, type, english, japanese) through all phases.

    ``recovery`` has lines of the same columns that failed in an earlier run; they
    join the queue at the small batches, with the fresh ones that are unresolved.
    """
    columns = ["ord", "key", "id", "type", "english", "japanese"]
    empty = [F.lit("").alias("previous"), F.expr(_NONE).alias("problems")]
    todo = lines.select(*columns, *empty)
    made, requests, failures = None, None, None
    for number in range(1, cascade.LAST + 1):
        first, small = number == 1, number == 2 + cascade.REPAIRS
        if small and recovery is not None:
            todo = todo.unionByName(recovery.select(*columns, *empty))
        phase = "PRIMARY" if first else "PRIMARY_REPAIR" if number <= 1 + cascade.REPAIRS else "RECOVERY_SMALL_BATCH" if small else "RECOVERY_SINGLE"
        todo = written(todo, "queue")
        if first or small:
            items, chars = (config.max_batch_items, config.max_batch_chars) if first else (config.recovery_items, config.recovery_chars)
            queue = todo.withColumn("__w", batching.line_weight(F.col("english"), F.col("japanese")))
            queue = batching.greedy_batches(queue, "ord", "__w", items, chars).drop("__w")
            shown = queue.withColumns({"previous": F.lit(""), "problems": F.expr(_NONE)})
        else:
            # One line a request, with what was wrong with its last text.
            hint = cascade.repair_projection(todo.select("key", "ord", "japanese", F.col("previous").alias("candidate"), F.col("problems").alias("errors")), "ord")
            queue = todo.withColumn("batch_id", F.col("ord"))
            shown = queue.drop("japanese", "previous", "problems").join(hint.select("ord", F.col("japanese"), "previous", "problems"), "ord")
        budget = batching.token_budget(queue, "english", config.max_tokens).select("batch_id", "budget")
        asked = requests_of(shown).join(budget, "batch_id").withColumns({"phase": F.lit(phase), "attempt": F.lit(number)})
        got = written(attempts(asked, answer), "responses")
        rows = written(judged(queue.select("batch_id", *columns).join(got.drop("response"), ["batch_id", "key"]), glossary, aliases), "judged")
        mine = rows.select("key", F.lit(number).alias("attempt_no"), "candidate", "ok", "errors", "warnings")
        made = mine if made is None else made.unionByName(mine)
        log, bad = _logs(rows, got, asked.select("batch_id", "budget"), phase, number)
        requests = log if requests is None else requests.unionByName(log)
        failures = bad if failures is None else failures.unionByName(bad)
        todo = rows.filter(~F.col("ok")).select(*columns, F.coalesce("candidate", F.lit("")).alias("previous"), F.col("errors").alias("problems"))
    made = written(made, "attempts")
    out = cascade.outcomes(made.select("key", "attempt_no", "ok", "errors", "warnings"))
    text = made.filter("ok").groupBy("key").agg(F.min_by("candidate", "attempt_no").alias("vietnamese"))
    records = out.join(text, "key", "left").withColumn("vietnamese", F.coalesce("vietnamese", F.lit("")))
    return Outcome(made, requests, failures, records)


def speed(usage_tokens: Column, seconds: Column) -> Column:
    """Tokens a second of one request; times under a millisecond count as one."""
    s = F.greatest(F.lit(0.001), F.coalesce(seconds, F.lit(0.0)))
    return F.when(F.coalesce(usage_tokens, F.lit(0)) > 0, usage_tokens / s).otherwise(0.0)


def _logs(rows: DataFrame, got: DataFrame, budgets: DataFrame, phase: str, number: int) -> tuple[DataFrame, DataFrame]:
    """Request and failure log of one phase; a request is a few lines."""
    per = rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("itemCount"),
        F.count_if("ok").alias("accepted"),
        F.max("error").alias("parseError"),
        F.array_sort(F.collect_list(F.when(~F.col("ok"), F.struct("ord", "key", "errors")))).alias("bad"),
    )
    per = per.withColumn("rejected", F.col("itemCount") - F.col("accepted")).join(budgets.withColumnRenamed("budget", "maxTokens"), "batch_id")
    head = [F.lit(number).alias("attempt_no"), F.lit(phase).alias("phase"), "batch_id", "itemCount", "accepted", "rejected", "parseError", "maxTokens"]
    text = got.groupBy("batch_id").agg(F.max("response").alias("response"))
    failed = per.filter("rejected > 0").join(text, "batch_id")
    reasons = F.map_from_entries(F.transform(F.array_distinct(F.transform("bad", lambda b: b.key)), lambda k: F.struct(k, F.get(F.filter("bad", lambda b: b.key == k), F.lit(0)).errors)))
    return per.select(*head), failed.select(*head, F.transform("bad", lambda b: b.key).alias("keys"), reasons.alias("reasons"), F.left("response", F.lit(PREVIEW)).alias("responsePreview"))
