"""All registered queries over the given tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def _nudged(sql: str) -> str:
    """Each round(x, n) of the SQL rounds as adapters.rounded does: a little is added first, so ties don't differ."""
    out, at = [], 0
    while (i := sql.find("round(", at)) >= 0:
        depth, j, comma = 1, i + 6, -1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[j], 0)
            comma = j if sql[j] == "," and depth == 1 else comma
            j += 1
        digits = sql[comma + 1 : j - 1].strip() if comma > 0 else ""
        inner = sql[i + 6 : comma] if digits.isdigit() else sql[i + 6 : j - 1]
        tail = f" + 1.37e-{int(digits) + 2}, {digits})" if digits.isdigit() else ")"
        out.append(sql[at:i] + "round(" + _nudged(inner) + tail)
        at = j
    return "".join(out) + sql[at:]


def query(oracle: str | None = None):
    """Registers a query under its function's name, with its SQL where there is one."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        if f.__name__ in _QUERIES:
            raise ValueError(f"{f.__name__} is registered twice")
        _QUERIES[f.__name__] = f
        if oracle is not None:
            _ORACLES[f.__name__] = _nudged(oracle)
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import catalog  # noqa: F401  registers

    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    from . import catalog  # noqa: F401

    return dict(_ORACLES)
