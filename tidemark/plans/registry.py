"""All registered queries and the SQL that gives the same rows."""

from tidemark.plans import (catalog_queries, corpus_queries, customer_queries, evaluation_queries, file_queries, image_queries,
                            stream_queries, trip_queries)

_MODULES = (catalog_queries, corpus_queries, image_queries, evaluation_queries, customer_queries, trip_queries, stream_queries, file_queries)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
