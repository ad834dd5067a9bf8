"""From page records to article text.

``article_text`` works on arrays inside the page row and shuffles nothing;
``html_blocks`` and ``block_classify`` expose the same steps as tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.functions import html as hx
from corpusloom.functions.plan import where_computed


def filter_html(
    df: DataFrame, html: str = "payload", content_type: str | None = "content_type"
) -> DataFrame:
    """Keep HTML records; empty ones are dropped."""
    kind = F.col(content_type) if content_type else None
    return df.where(hx.is_html(F.col(html), kind))


def extract_title(df: DataFrame, html: str = "html") -> DataFrame:
    """Add ``title``."""
    return df.withColumn("title", hx.title_of(F.col(html)))


def _parts(line: Column) -> Column:
    return F.struct(hx.plain(line).alias("txt"), hx.link_words(line).alias("linked"))


def _features(parts: Column) -> Column:
    """Text, words and link density of a block, from its text made once."""
    words = hx.plain_words(parts["txt"])
    return F.struct(
        parts["txt"].alias("txt"), words.alias("nw"), (parts["linked"].cast("double") / words).alias("ld"),
    )


def html_blocks(df: DataFrame, id: str = "page_id", html: str = "html") -> DataFrame:
    """``id, pos, txt, nw, ld``: text blocks with word count and link density."""
    lines = df.select(id, hx.block_lines(F.col(html)).alias("lines"))
    rows = lines.select(id, F.posexplode_outer("lines").alias("pos", "line"))
    rows = rows.where(F.col("line").isNotNull())
    rows = rows.select(id, "pos", _parts(F.col("line")).alias("parts"))
    return rows.select(id, "pos", _features(F.col("parts")).alias("f")).select(id, "pos", "f.*")


def block_classify(blocks: DataFrame, id: str = "page_id") -> DataFrame:
    """Add ``content``: whether the block belongs to the article."""
    page = Window.partitionBy(id).orderBy("pos")
    return blocks.withColumn(
        "content",
        hx.is_content(
            F.col("nw"), F.col("ld"),
            F.lag("nw", 1, 0).over(page), F.lag("ld", 1, 0.0).over(page),
            F.lead("nw", 1, 0).over(page),
        ),
    )


def article_text(
    df: DataFrame, id: str = "page_id", html: str = "html", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``id, text``: content blocks joined by newlines; pages without are dropped.

    Columns named in ``keep`` are carried along.
    """
    lines = df.select(id, *keep, hx.block_lines(F.col(html)).alias("lines"))
    blocks = lines.select(id, *keep, F.transform(F.transform("lines", _parts), _features).alias("b"))

    def content(block: Column, pos: Column) -> Column:
        before, after = F.get("b", pos - 1), F.get("b", pos + 1)
        zero = F.lit(0)
        return hx.is_content(
            block["nw"], block["ld"],
            F.coalesce(before["nw"], zero), F.coalesce(before["ld"], F.lit(0.0)),
            F.coalesce(after["nw"], zero),
        )

    kept = blocks.select(id, *keep, F.filter("b", content).alias("kept"))
    joined = F.array_join(F.col("kept.txt"), "\n")
    texts = where_computed(kept, "text", joined, lambda text: F.length(text) > 0)
    return texts.select(id, *keep, "text")
