"""Registered queries: a DataFrame function and the same result in plain SQL."""

from weir.queries import analytics, jobs, quality, relational, steps, storage, streams

REGISTRY = {
    **relational.QUERIES,
    **analytics.QUERIES,
    **quality.QUERIES,
    **storage.QUERIES,
    **streams.QUERIES,
    **jobs.QUERIES,
    **steps.QUERIES,
}
