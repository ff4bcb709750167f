"""Shared fixture bindings for the registered queries."""

from __future__ import annotations

from auditlens.sources import Tables
from auditlens.sources import views as V

ATTRS = V.ATTRIBUTES
REFS = V.REFERENCE_GROUPS


def tables(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


def scored(spark, sf_dir, **kw):
    return V.scored(Tables(spark, sf_dir), **kw)


def applications(spark, sf_dir, **kw):
    return V.applications(Tables(spark, sf_dir), **kw)


SQL_SCORED = V.sql_scored()
SQL_APPS = V.sql_applications()
