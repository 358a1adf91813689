"""All driver queries and their oracle SQL, merged from the topic modules."""

from __future__ import annotations

from pricemart.queries import cleaning, cleaning_sql, jobs, jobs_sql, readers, readers_sql, star, star_sql


def all_queries():
    return {**star.QUERIES, **cleaning.QUERIES, **readers.QUERIES, **jobs.QUERIES}


def all_sql():
    return {**star_sql.STAR_SQL, **cleaning_sql.SQL, **readers_sql.SQL, **jobs_sql.SQL}
