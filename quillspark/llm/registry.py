"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import decontaminate, divergence_audit, html_template, mixing, pii, ppm, quality, secrets, sharding, simhash, token_counts, token_files, whitening

MODULES = (mixing, simhash, pii, token_files, decontaminate, quality, sharding, token_counts, secrets, html_template, divergence_audit, whitening, ppm)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
