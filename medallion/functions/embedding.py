"""Text embedding by hashed term counts, scaled to unit length.

A term's place is its md5 modulo the length, so any engine that knows md5 finds the same vectors.
"""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits of the md5 that make a term's number.
_DIGITS = 8


def terms(text: Column) -> Column:
    """Runs of letters and digits in lower case; none for NULL."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def term_place(term: Column, dim: int) -> Column:
    """Place of a term in a vector of ``dim`` numbers."""
    return F.conv(F.substring(F.md5(term.cast("binary")), 1, _DIGITS), 16, 10).cast("long") % dim


def embed(df: DataFrame, column: str, out: str = "embedding", dim: int = 256) -> DataFrame:
    """Add a ``dim``-long float vector for the text column. Row-local: no fit, no shuffle."""
    places = F.transform(terms(F.col(column)), lambda t: term_place(t, dim).cast("string"))
    counts = CountVectorizerModel.from_vocabulary([str(i) for i in range(dim)], inputCol="_places", outputCol="_counts")
    unit = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0)
    steps = df.withColumn("_places", places)
    for step in (counts, unit):
        steps = step.transform(steps)
    return steps.withColumn(out, vector_to_array("_unit", "float32")).drop("_places", "_counts", "_unit")
