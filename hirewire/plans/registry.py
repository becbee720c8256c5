"""All registered queries: name -> (Spark callable, oracle SQL or None)."""

from __future__ import annotations

from hirewire.plans import q_classify, q_dates, q_domains, q_extract, q_registry, q_run, q_text, q_urls

MODULES = [q_classify, q_urls, q_domains, q_text, q_dates, q_registry, q_extract, q_run]


def all_queries() -> dict:
    out: dict = {}
    for m in MODULES:
        out.update(m.QUERIES)
    return out
