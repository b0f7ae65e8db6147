"""Complete DuckDB statements: a query preceded by the expressions it needs."""

from __future__ import annotations

import re

from oracle.domain import DOMAIN
from oracle.operators import LOADING, QUALITY, RISK_MODEL
from oracle.reports import LIBRARY, REPORTS
from oracle.views import VIEWS

_DEFINITIONS = {**DOMAIN, **VIEWS}
_NAME = re.compile(r"\b(?:" + "|".join(sorted(_DEFINITIONS, key=len, reverse=True)) + r")\b")


def _needed(sql: str, found: list[str]) -> list[str]:
    for name in _NAME.findall(sql):
        if name not in found:
            _needed(_DEFINITIONS[name], found)
            if name not in found:
                found.append(name)
    return found


def complete(sql: str) -> str:
    """Puts the needed expressions, in dependency order, in front of a query."""
    parts = [f"{name} as ({_DEFINITIONS[name].strip()})" for name in _needed(sql, [])]
    if not parts:
        return sql.strip()
    return f"with {',\n'.join(parts)}\nselect * from ({sql.strip()})"


def oracle_sql() -> dict[str, str]:
    plain = {name.upper(): f"select * from {name}" for name in VIEWS}
    statements = {**plain, **REPORTS, **LIBRARY, **QUALITY, **LOADING, **RISK_MODEL}
    # the same rows by another way
    again = {f"{view}_refreshed": statements[view] for view in ("V03", "V12", "V14", "V15", "V16")} | {"D32_published": statements["D32"]}
    return {key: complete(sql) for key, sql in (statements | again).items()}
