"""Gzip payloads: the one place where a codec needs Python (Arrow batches)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F

from gleaner.functions.text import word_count

_DECODED = "struct<text:string,error:string>"


def _decoder():
    # Nested so that it is shipped by value: executors need no installed package.
    @F.pandas_udf(_DECODED)
    def decode(content: pd.Series, encoding: pd.Series) -> pd.DataFrame:
        import gzip

        texts, errors = [], []
        for data, charset in zip(content, encoding):
            text, error = "", None
            if data is None:
                error = "missing"
            else:
                try:
                    text = gzip.decompress(data).decode(charset or "utf-8")
                    # A lone surrogate decodes but cannot be stored as UTF-8.
                    text.encode("utf-8")
                except Exception as exc:  # every failure becomes a row, never a lost task
                    text, error = "", type(exc).__name__
            texts.append(text)
            errors.append(error)
        return pd.DataFrame({"text": texts, "error": errors})

    return decode


def decode_blob(content: Column, encoding: Column) -> Column:
    """``struct(text, error)`` of a gzip payload; a failure has an empty text and an error name."""
    return _decoder()(content, encoding)


def with_decoded(df, content: str = "content", encoding: str = "src_encoding"):
    """Add ``text, word_count, status, error`` and drop the payload."""
    decoded = df.withColumn("_decoded", decode_blob(F.col(content), F.col(encoding)))
    return (
        decoded.withColumns({
            "text": F.col("_decoded.text"),
            "word_count": word_count(F.col("_decoded.text")),
            "status": F.when(F.col("_decoded.error").isNull(), "ok").otherwise("failed"),
            "error": F.col("_decoded.error"),
        }).drop("_decoded", content)
    )
