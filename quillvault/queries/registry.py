"""All registered queries: name -> (query, equivalent SQL or None)."""

from __future__ import annotations

from quillvault.queries import corpus, logs, retrieval

REGISTRY = {**corpus.QUERIES, **retrieval.QUERIES, **logs.QUERIES}
