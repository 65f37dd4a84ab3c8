"""Label taxonomy and segment rules.

All rules are projections with fixed literal maps (no join, no UDF); the generic
lookup-join variant for arbitrary mapping tables lives in ``operators.joins``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connlens import config
from connlens.functions.core import col, literal_map


def binary_label(c: str | Column = "class") -> Column:
    """1 unless the value is exactly 'normal' (case/space sensitive); null -> 1."""
    return (~col(c).eqNullSafe("normal")).cast("int")


def family_label(c: str | Column = "class") -> Column:
    """trim+lower, map attack name -> family id; unknown or null -> 3 (R2L)."""
    key = F.lower(F.trim(col(c)))
    return F.coalesce(F.try_element_at(literal_map(config.ATTACK_FAMILY), key),
                      F.lit(config.UNKNOWN_FAMILY)).cast("int")


def eda_category(c: str | Column = "class") -> Column:
    """Exploratory taxonomy: exact-name lookup, unknown -> null."""
    return F.try_element_at(literal_map(config.EDA_CATEGORY), col(c))


def segment(c: str | Column = "class") -> Column:
    """'normal' / 'seen' / 'novel' from the trimmed, lower-cased attack name."""
    key = F.lower(F.trim(col(c)))
    return (F.when(key == "normal", "normal")
            .when(key.isin(config.SEEN_ATTACKS), "seen")
            .otherwise("novel"))


def family_name(family_id: str | Column) -> Column:
    """family id -> display name; anything unknown -> 'normal'."""
    return F.coalesce(F.try_element_at(literal_map(config.FAMILY_NAME), col(family_id).cast("int")),
                      F.lit("normal"))


def with_labels(df: DataFrame, c: str = "class") -> DataFrame:
    return df.withColumns({
        "target_label": binary_label(c),
        "multiclass_label": family_label(c),
        "segment": segment(c),
    })
