"""Digests of texts and rows."""
from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

_BLANKS = " \t\n\r\x0b\x0c"


def text_digest(text: Column) -> Column:
    """256-bit digest of a text, as hex."""
    return F.sha2(text, 256)


@F.pandas_udf(T.StringType())
def blake2b_digest(texts: pd.Series) -> pd.Series:
    """BLAKE2b-256 of a text, as hex, for logs that hold such digests already.

    Spark has no such function; :func:`text_digest` does not leave the JVM.
    """
    return texts.map(lambda t: hashlib.blake2b(t.encode(), digest_size=32).hexdigest(), na_action="ignore")


def row_digest(columns: Sequence[str]) -> Column:
    """Digest of one row: columns in alphabetical order, cells stripped, nulls as empty.

    Names and cells are written as ``length:text`` so that no two rows share a text, and equal
    cells under other names are another row.
    """
    cells = []
    for name in sorted(columns):
        cells.append(F.lit(f"{len(name)}:{name}"))
        cell = F.coalesce(F.btrim(F.col(f"`{name}`").cast("string"), F.lit(_BLANKS)), F.lit(""))
        cells.append(F.concat(F.length(cell).cast("string"), F.lit(":"), cell))
    return F.sha2(F.concat(*cells), 256)
