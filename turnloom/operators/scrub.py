"""Secrets out of texts by rules for public token formats, with the number of replacements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: name and pattern; our own list of publicly documented formats. The order counts: what one rule took, later ones do not see.
RULES = (
    ("private_key", r"(?s)-----BEGIN [A-Z ]*PRIVATE KEY-----.*?-----END [A-Z ]*PRIVATE KEY-----"),
    ("github_token", r"\bgh[pousr]_[A-Za-z0-9]{36,255}\b"),
    ("aws_key_id", r"\bAKIA[0-9A-Z]{16}\b"),
    ("slack_token", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    ("jwt", r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    ("bearer", r"(?i)\bbearer\s+[a-z0-9._~+/-]{20,}=*"),
    ("assignment", r"""(?i)\b(?:token|secret|password|passwd|api_key)\s*[=:]\s*["']?[A-Za-z0-9+/_-]{12,}["']?"""),
)


def scrub(text: Column) -> Column:
    """STRUCT<text, n>."""
    n = F.lit(0)
    for name, pattern in RULES:
        n = n + F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))
        text = F.regexp_replace(text, pattern, f"[{name.upper()}]")
    return F.struct(text.alias("text"), n.alias("n"))


def scrub_messages(msgs: Column) -> Column:
    """STRUCT<conversations, n>: each message's value scrubbed, and how many replacements there were."""
    done = F.transform(msgs, lambda m: F.struct(m["from"].alias("from"), scrub(m.value).alias("s")))
    return F.struct(F.transform(done, lambda d: F.struct(d["from"].alias("from"), d.s.text.alias("value"))).alias("conversations"), F.aggregate(done, F.lit(0), lambda a, d: a + d.s.n).alias("n"))
