"""All registered queries of the engine, by name."""

from . import queries_changes, queries_core, queries_more, queries_publish, queries_rest, queries_runs, queries_stream, queries_text

QUERIES = {**queries_core.QUERIES, **queries_more.QUERIES, **queries_publish.QUERIES, **queries_changes.QUERIES, **queries_rest.QUERIES, **queries_runs.QUERIES, **queries_stream.QUERIES, **queries_text.QUERIES}
ORACLE = {**queries_core.ORACLE, **queries_more.ORACLE, **queries_publish.ORACLE, **queries_changes.ORACLE, **queries_rest.ORACLE, **queries_runs.ORACLE, **queries_stream.ORACLE, **queries_text.ORACLE}
