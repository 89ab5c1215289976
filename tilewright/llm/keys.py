"""Keys for rows that may lack an id."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The id as text; where it is null, a digest of the text, so that such rows are judged by what they say."""
    return F.coalesce(F.concat(F.lit("id "), F.col(id_col).cast("string")), F.concat(F.lit("text "), F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)))


def own_id(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The id; where it is null, a large number made of the text."""
    return F.coalesce(F.col(id_col).cast("long"), F.pmod(F.xxhash64(F.col(text_col).cast("string")), F.lit(2**61)) + F.lit(2**62))
