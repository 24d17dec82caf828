"""The query catalogue: each query as a function and, where SQL can say it, as SQL."""

from marlstone.plans import capacity, catalog, publishing, recovery

QUERIES = {**catalog.QUERIES, **capacity.QUERIES, **publishing.QUERIES, **recovery.QUERIES}
ORACLE_SQL = {**catalog.ORACLE_SQL, **capacity.ORACLE_SQL, **publishing.ORACLE_SQL, **recovery.ORACLE_SQL}
