"""The registered queries: grocery tables derived from the benchmark tables, the jobs
that run on them, and an independent SQL statement for each where one exists."""

from __future__ import annotations

from larder.catalog import browsing, files, forecasting, prices, products, sales, shaping, star, texts

from larder.session import prepare

MODULES = (star, products, prices, sales, browsing, texts, shaping, files, forecasting)


def _runnable(query):
    return lambda spark, sf_dir: query(prepare(spark), sf_dir)


def all_queries() -> dict:
    return {name: _runnable(q) for m in MODULES for name, q in m.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: s for m in MODULES for name, s in m.ORACLES.items()}
