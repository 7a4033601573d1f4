"""Where candidate texts come from: any function on batches of rows."""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import joined_url
from loomline.session import ship

ATTEMPT = "batch_id bigint, key string, candidate string, structured boolean, error string, response string"


@dataclass(frozen=True)
class Config:
    """Limits of a run; all of it stays on the driver."""

    max_batch_items: int = 10
    max_batch_chars: int = 5200
    recovery_items: int = 3
    recovery_chars: int = 2200
    max_tokens: int = 3072
    seed: int = 211
    repair_attempts: int = 2
    single_attempts: int = 2


def requests_of(batches: DataFrame) -> DataFrame:
    """One row per batch_id with its rows as JSON, its required keys and the JSON
    schema that a response must fit.  Lines of a repair show what was wrong."""
    shown = ["key", "type", "english", "japanese"]
    if "problems" in batches.columns:
        shown += [F.when(F.size("problems") > 0, F.col(c)).alias(c) for c in ("previous", "problems")]
    row = F.struct("ord", F.to_json(F.struct(*shown)).alias("j"), "key")
    per = batches.groupBy("batch_id").agg(F.array_sort(F.collect_list(row)).alias("r"))  # a batch is a few rows
    keys = F.transform("r", lambda x: x.key)
    props = F.map_from_entries(F.transform(F.array_distinct(keys), lambda k: F.struct(k, F.struct(F.lit("string").alias("type")))))
    schema = F.to_json(F.struct(F.lit("object").alias("type"), props.alias("properties"), F.array_distinct(keys).alias("required"), F.lit(False).alias("additionalProperties")))
    return per.select("batch_id", keys.alias("keys"), F.concat(F.lit("["), F.array_join(F.transform("r", lambda x: x.j), ","), F.lit("]")).alias("rows"), schema.alias("schema"))


def attempts(requests: DataFrame, answer: Callable[[dict], str]) -> DataFrame:
    """Calls ``answer({batch_id, rows, schema})``, with phase and attempt where the
    requests have them, for each request and unpacks the response by key, each once.  Missing keys and values that are no strings are unstructured."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for n, (b, keys, rows, schema) in enumerate(zip(f["batch_id"], f["keys"], f["rows"], f["schema"], strict=True)):
                text, error, got = answer({"batch_id": b, "rows": json.loads(rows), "schema": json.loads(schema), **{c: f[c].iloc[n] for c in extra}}), None, {}
                try:
                    got = json.loads(text)
                    if not isinstance(got, dict):
                        got, error = {}, "JSON_ROOT_NOT_OBJECT"
                except ValueError as e:
                    error = f"INVALID_JSON:{e}"
                for n_key, k in enumerate(dict.fromkeys(keys)):
                    ok = isinstance(got.get(k), str)
                    # The response goes with its first key only.
                    out.append((b, k, got[k].strip() if ok else None, ok, None if ok else error or "MISSING_STRUCTURED_KEY", None if n_key else text))
            yield pd.DataFrame(out, columns=["batch_id", "key", "candidate", "structured", "error", "response"])

    extra = [c for c in ("phase", "attempt") if c in requests.columns]
    ship(requests.sparkSession)
    return requests.select("batch_id", "keys", "rows", "schema", *extra).mapInPandas(run, ATTEMPT)


def http_answer(endpoint: str, model: str, timeout: float = 600.0) -> Callable[[dict], str]:
    """A chat endpoint as an answer function.  A failed call raises with the first
    500 characters of the body."""

    def call(request: dict) -> str:
        body = {"model": model, "messages": [{"role": "user", "content": json.dumps(request["rows"], ensure_ascii=False)}], "response_format": {"type": "json_schema", "json_schema": {"name": "batch", "strict": True, "schema": request["schema"]}}}
        r = urllib.request.Request(joined_url(endpoint, "chat/completions"), json.dumps(body).encode(), {"content-type": "application/json"})
        try:
            with urllib.request.urlopen(r, timeout=timeout) as got:
                message = json.load(got)["choices"][0]["message"]
        except urllib.error.HTTPError as e:
            raise RuntimeError(f"{e.code} {e.reason}: {e.read().decode(errors='replace')[:500]}") from e
        text = message.get("content") or message.get("reasoning_content") or message.get("reasoning") or ""
        return text if isinstance(text, str) else "\n".join(p if isinstance(p, str) else p.get("text", "") for p in text)

    return call


def preferred_models(models: DataFrame, wanted: list[str]) -> DataFrame:
    """Models whose key, name and variant together hold every wanted part."""
    text = F.lower(F.concat_ws(" ", "key", "display_name", "selected_variant"))
    hit = F.lit(True)
    for w in wanted:
        hit = hit & F.contains(text, F.lit(w.lower()))
    return models.filter(hit)
