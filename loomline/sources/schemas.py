"""Schemas of the job and its logs."""

ITEM = "key string, file string, row bigint, id string, subid string, type string, english string, japanese string, currentVietnamese string, inheritedR3 boolean, sourceHash string"
JOB = f"jobId string, createdAt string, items array<struct<{', '.join(p.strip().replace(' ', ': ', 1) for p in ITEM.split(','))}>>"
RECORD = "seq bigint, batch_id bigint, key string, sourceHash string, vietnamese string, status string, qa struct<ok: boolean, errors: array<string>, warnings: array<string>>, attempts int, provenance string, updatedAt timestamp"
REQUEST = "request_id bigint, at timestamp, phase string, itemCount int, accepted int, rejected int, elapsedSeconds double, tokensPerSecond double, finishReason string, parseError string, maxTokens int, usage map<string, bigint>"
FAILURE = REQUEST + ", keys array<string>, reasons map<string, array<string>>, responsePreview string"
GLOSSARY = "keepExact array<string>, translateAs map<string, string>"
