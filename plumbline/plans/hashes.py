"""Queries of tree hashes, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledger
from ..sources.tables import table


def content_hashes(s, d):
    """One hash for all pages of each scheme and host, by page number and content."""
    p = table(s, d, "pages").select(F.regexp_extract("url", r"^([a-z]+://[^/]*)", 1).alias("site"), "page_id", F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"))
    return ledger.tree_hash(p, ["site"], "page_id", "digest")


ORACLES = {
    "content_hashes": r"""WITH l AS (SELECT regexp_extract(url, '^([a-z]+://[^/]*)', 1) AS site, sha256(page_id::VARCHAR)[:2] AS bucket, sha256(page_id || ':' || sha256(coalesce(html, ''))) AS leaf FROM pages),
b AS (SELECT site, bucket, count(*) AS n, sha256(string_agg(leaf, chr(10) ORDER BY leaf)) AS h FROM l GROUP BY site, bucket)
SELECT site, sum(n)::BIGINT AS n, sha256(string_agg(bucket || ':' || h, chr(10) ORDER BY bucket || ':' || h)) AS root FROM b GROUP BY site""",
}

QUERIES = {"content_hashes": content_hashes}
