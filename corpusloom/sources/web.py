"""URL lists, site maps, listings and web-page corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import file_name, flat_element, markup_to_text, nested_element


def url_frame(spark: SparkSession, urls: list[str], partitions: int = 10) -> DataFrame:
    """A caller's list of URLs as rows, spread for parallel work."""
    rows = spark.createDataFrame([(u,) for u in urls], "url string")
    return rows.repartition(partitions)


def sitemap_urls(
    sitemaps: DataFrame, order: str, xml_col: str = "xml", max_documents: int | None = None
) -> DataFrame:
    """``(order, pos, url)`` of every ``loc`` element; the first ones if capped."""
    found = F.expr(f"""xpath({xml_col}, '//*[local-name()="loc"]/text()')""")
    urls = sitemaps.select(order, F.posexplode(found).alias("pos", "url")).withColumn(
        "pos", F.col("pos").cast("long")
    )
    if max_documents:
        urls = urls.orderBy(order, "pos").limit(max_documents)
    return urls


def listing(df: DataFrame, url_col: str = "url", without: str = "NOTICE") -> DataFrame:
    """Adds ``file_name`` and leaves out names that contain a word."""
    named = df.withColumn("file_name", file_name(F.col(url_col)))
    return named.where(~F.col("file_name").contains(without))


def preview(df: DataFrame, like: str, order: str, rows: int = 10, url_col: str = "url") -> DataFrame:
    """The first rows whose URL matches a pattern."""
    return df.where(F.col(url_col).like(like)).orderBy(order).limit(rows)


def article(html: Column, mode: str = "html") -> Column:
    """The page's ``<article>``, as markup or as text; NULL if it has none."""
    found = flat_element(html, "article")
    return markup_to_text(found) if mode == "text" else found


def article_body(html: Column) -> Column:
    """The ``div`` marked as article body, nested ones included."""
    return nested_element(html, "div", "itemprop", "articleBody")


def page_corpus(pages: DataFrame, extractor=article) -> DataFrame:
    """``(url, text)`` of the pages that have an article."""
    return pages.select("url", extractor(F.col("html")).alias("text")).where(
        F.col("text").isNotNull()
    )
