"""Lists out of HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Named entities a list item may carry, and their characters; `&amp;` goes last.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}

ITEM = r"(?is)<li\b[^>]*>(.*?)</li>"


def plain_text(html: Column) -> Column:
    """Text of an HTML fragment: tags dropped, entities decoded, trimmed."""
    text = F.regexp_replace(html, r"(?s)<[^>]*>", "")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(text)


def html_list_items(pages: DataFrame, id_col: str, html: str, item_pattern: str = ITEM,
                    list_pattern: str | None = None, out: str = "item") -> DataFrame:
    """List items of every page in page order, blanks dropped; `pos` counts from 1.

    `list_pattern` (one group) narrows the page to the list wanted first.
    """
    body = F.col(html) if list_pattern is None else F.regexp_extract(html, list_pattern, 1)
    items = F.regexp_extract_all(body, F.lit(item_pattern), F.lit(1))
    texts = F.filter(F.transform(items, plain_text), lambda t: t != "")
    return (pages.select(id_col, F.posexplode(texts).alias("pos", out))
            .withColumn("pos", F.col("pos") + 1))
