"""The number inside a product code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Code formats of the point-of-sale, ERP and web-shop systems. The first two describe
# the whole code, the third its ending.
POS_CODE = r"\ACN-([0-9]{5})\z"
ERP_CODE = r"\AERP-PROV-MX-([0-9]{3})-[A-Z]\z"
HANDLE_CODE = r"-([0-9]{3})\n?\z"


def code_number(code: Column | str, pattern: str) -> Column:
    """First group of ``pattern`` as an integer; NULL when the code is NULL or does not match."""
    text = F.col(code) if isinstance(code, str) else code
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("bigint")
