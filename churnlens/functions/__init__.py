"""Column expressions. Every helper returns a native Spark ``Column`` (no Python UDF)."""

from churnlens.functions.buckets import engagement_tier, engagement_rank, tenure_bucket, tenure_rank, ticket_bucket
from churnlens.functions.dates import parse_date, parse_mixed_date
from churnlens.functions.numeric import clip_lower, exact_mean, np_round, pct_half_up, safe_ratio
from churnlens.functions.text import null_tokens_to_null, strip_ws, title_case, clean_text

__all__ = [
    "clean_text", "clip_lower", "engagement_rank", "engagement_tier", "exact_mean", "np_round",
    "null_tokens_to_null", "parse_date", "parse_mixed_date", "pct_half_up", "safe_ratio",
    "strip_ws", "tenure_bucket", "tenure_rank", "ticket_bucket", "title_case",
]
