"""Record keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def natural_key(source: Column, case_no: Column, decision_no: Column, statute_no: Column, url: Column) -> Column:
    """Source and both numbers, else source and statute number, else source and address; empty counts as missing."""
    case_no, decision_no, statute_no = (F.nullif(c, F.lit("")) for c in (case_no, decision_no, statute_no))
    return (
        F.when(case_no.isNotNull() & decision_no.isNotNull(), F.concat_ws(":", source, case_no, decision_no))
        .when(statute_no.isNotNull(), F.concat_ws(":", source, statute_no))
        .otherwise(F.concat_ws(":", source, url))
    )


def message_key(key: Column) -> Column:
    """UTF-8 bytes; null where the key is null or empty."""
    return F.nullif(key, F.lit("")).cast("binary")
