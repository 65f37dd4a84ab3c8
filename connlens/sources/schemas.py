"""Typed schemas of the raw connection record and of a scoring request.

A name ending in ``rate`` is a double in [0, 1]; the protocol, service, flag and class
are strings; everything else is a count or a 0/1 flag."""

from __future__ import annotations

from pyspark.sql import types as T

from connlens import config

_TEXT = {"protocol_type", "service", "flag", "class"}


def _field(name: str) -> T.StructField:
    kind = T.StringType() if name in _TEXT else T.DoubleType() if name.endswith("_rate") else T.LongType()
    return T.StructField(name, kind)


#: All 43 columns of the headerless raw file, in its order.
RECORD = T.StructType([_field(c) for c in config.RAW_COLUMNS])
#: The 41 fields of a request, all required: a record without its label and difficulty.
REQUEST = T.StructType([_field(c) for c in config.RAW_COLUMNS if c not in ("class", "difficulty_score")])
