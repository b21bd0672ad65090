"""Registered queries and their SQL."""

from . import book, checks, fold, links, master, relational

QUERIES: dict = {**links.QUERIES, **relational.QUERIES, **master.QUERIES, **fold.QUERIES, **book.QUERIES, **checks.QUERIES}
SQL: dict[str, str] = {**links.SQL, **relational.SQL, **master.SQL, **fold.SQL, **book.SQL, **checks.SQL}
