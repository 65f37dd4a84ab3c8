"""SQL fragments for the DuckDB oracle, generated from the same fixed values."""

from __future__ import annotations

from connlens import config


def _q(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def seen_list() -> str:
    return ", ".join(_q(a) for a in config.SEEN_ATTACKS)


def binary_label(c: str = "class") -> str:
    return f"CASE WHEN {c} IS NOT DISTINCT FROM 'normal' THEN 0 ELSE 1 END"


def segment(c: str = "class") -> str:
    k = f"lower(trim({c}))"
    return (f"CASE WHEN {k} = 'normal' THEN 'normal' WHEN {k} IN ({seen_list()}) THEN 'seen' "
            f"ELSE 'novel' END")


def family_label(c: str = "class") -> str:
    k = f"lower(trim({c}))"
    whens = " ".join(f"WHEN {_q(n)} THEN {f}" for n, f in config.ATTACK_FAMILY.items())
    return f"CAST(COALESCE(CASE {k} {whens} END, {config.UNKNOWN_FAMILY}) AS INTEGER)"


def eda_category(c: str = "class") -> str:
    whens = " ".join(f"WHEN {_q(n)} THEN {_q(f)}" for n, f in config.EDA_CATEGORY.items())
    return f"CASE {c} {whens} END"


def family_name(c: str) -> str:
    whens = " ".join(f"WHEN {k} THEN {_q(v)}" for k, v in config.FAMILY_NAME.items())
    return f"COALESCE(CASE CAST({c} AS INTEGER) {whens} END, 'normal')"


def values_doubles(vals, name: str) -> str:
    rows = ", ".join(f"({float(v)!r}::DOUBLE)" for v in vals)
    return f"(SELECT * FROM (VALUES {rows}) v({name}))"


def r6(expr: str) -> str:
    """Decimal half-up rounding (what Spark's ``round`` does on doubles), after a
    9-digit step that removes last-bit differences between engines."""
    return f"(CAST(round(CAST(CAST({expr} AS DOUBLE) AS DECIMAL(38, 9)), 6) AS DOUBLE) + 0.0)"


def sdiv(num: str, den: str) -> str:
    """zero_division = 0 in SQL."""
    return f"COALESCE(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0), 0.0)"


def md5_uniform(key: str, seed: int = 42) -> str:
    return (f"(CAST(('0x' || substr(md5(concat_ws('|', '{seed}', CAST({key} AS VARCHAR))), 1, 8)) "
            f"AS BIGINT) / 4294967296.0)")


def md5_hex(key: str, seed: int = 42) -> str:
    return f"md5(concat_ws('|', '{seed}', CAST({key} AS VARCHAR)))"
