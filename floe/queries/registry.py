"""Registration of queries and their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floe.queries.fixtures import DUCK, Tables
from floe.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _with_fixtures(sql: str) -> str:
    """Put the fixture definitions a statement mentions in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bfx_\w+", text):
            if name in DUCK and name not in needed:
                visit(DUCK[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    parts = ",\n".join(f"{name} AS ({DUCK[name].strip()})" for name in needed)
    body = sql.strip()
    recursive = body.upper().startswith("WITH RECURSIVE")
    if body.upper().startswith("WITH"):
        body = body[len("WITH RECURSIVE") if recursive else len("WITH"):].strip()
        return f"WITH {'RECURSIVE ' if recursive else ''}{parts},\n{body}"
    return f"WITH {parts}\n{body}"


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a name, with the SQL that must give equal rows."""

    def register(function: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: function(Tables(prepare(spark), sf_dir))
        if sql is not None:
            ORACLES[name] = _with_fixtures(sql)
        return function

    return register


def r4(column: Column | str, places: int = 4) -> Column:
    """Doubles are compared at four places."""
    return F.round(F.col(column) if isinstance(column, str) else column, places)


def day(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def stamp(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
