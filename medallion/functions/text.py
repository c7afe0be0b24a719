"""Text expressions: templates, field extraction, response parsing, chunking."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SLOT = re.compile(r"\{(\w+)\}")


def as_text(value: Column | str) -> Column:
    """Value as text; NULL becomes the word ``None``."""
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(column.cast("string"), F.lit("None"))


def render(template: str, **columns: Column | str) -> Column:
    """Fill ``{name}`` slots of a template with columns (slot name = column name by default)."""
    parts: list[Column] = []
    at = 0
    for slot in _SLOT.finditer(template):
        parts.append(F.lit(template[at : slot.start()]))
        parts.append(as_text(columns.get(slot[1], slot[1])))
        at = slot.end()
    parts.append(F.lit(template[at:]))
    return F.concat(*parts)


def extract_fields(text: Column, labels: Mapping[str, str]) -> Column:
    """Struct of the words that follow ``Label:``; a label that is absent gives NULL."""
    return F.struct(
        *[
            F.nullif(F.regexp_extract(text, re.escape(label) + r":\s*(\S+)", 1), F.lit("")).alias(name)
            for name, label in labels.items()
        ]
    )


def parse_text_blocks(content: Column | str) -> Column:
    """Text of the last ``{"type": "text"}`` block of a JSON list; anything else is returned raw."""
    raw = F.col(content) if isinstance(content, str) else content
    # The JSON reader accepts trailing characters, so the closing bracket is checked here.
    document = F.when(F.rtrim(raw).endswith("]"), F.try_parse_json(raw))
    blocks = F.try_variant_get(document, "$", "array<variant>")
    texts = F.filter(blocks, lambda b: F.try_variant_get(b, "$.type", "string") == "text")
    last = F.try_variant_get(F.try_element_at(texts, F.lit(-1)), "$.text", "string")
    return F.coalesce(F.nullif(last, F.lit("")), raw)


def row_json(*columns: str) -> Column:
    """Columns as one JSON object, decimals already cast by the caller."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def chunk_text(
    df: DataFrame, column: str, size: int = 200, overlap: int = 50, pos: str = "chunk_pos", out: str = "chunk"
) -> DataFrame:
    """One row per window of ``size`` characters, starting every ``size - overlap`` characters.

    The text is first cut into pieces of the stride in one pass and a window is glued from
    neighbouring pieces, so cost grows linearly with the text; a substring from character
    ``i`` would rescan the text from its beginning for every window.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    stride = size - overlap
    followers = -(-size // stride) - 1
    cut = df.withColumn("_pieces", F.regexp_extract_all(F.col(column), F.lit(f"(?s).{{1,{stride}}}"), F.lit(0)))

    def window(piece: Column, i: Column) -> Column:
        rest = [F.coalesce(F.get(F.col("_pieces"), i + F.lit(n + 1)), F.lit("")) for n in range(followers)]
        return F.substring(F.concat(piece, *rest), 1, size)

    kept = [c for c in df.columns if c != column]
    return cut.select(*kept, F.posexplode(F.transform("_pieces", window)).alias(pos, out))
