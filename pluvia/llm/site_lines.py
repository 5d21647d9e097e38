"""Line deduplication by site-relative frequency.

Pages are cut into text lines and grouped by host.  A line is boilerplate of its host if the pages that
contain it, divided by the host's pages, exceed ``max_ratio``; such lines are dropped from all pages of the
host.  Counting is partial before the shuffle; the drop lists are short (a host's pages hold at most
``lines per page / max_ratio`` such lines) and are one table with a row a host.  Its join with the pages is by the
table's size: Spark sends a small one, so that pages are not shuffled, and sorts a large one, dividing a hot host.
A page's lines are looked up in its drop list by sorting, so that a page of 10^5 lines costs no 10^10 comparisons.

Defined cases: a null page has no lines; a page whose URL has no host belongs to no site and keeps all of
its lines; a line that repeats in a page counts once for that page; repeated rows are separate pages; hosts
with fewer than ``min_pages`` pages keep all lines (with up to ``1 / max_ratio`` pages every line of a page is over
the ratio, which then says nothing; ``min_pages=1`` applies the ratio to all hosts); an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._store import pin

HOST = "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
UNSEEN = "(?is)<script[ >].*?</script *>|<style[ >].*?</style *>|<!--.*?-->"
BLOCK_TAG = ("(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html"
             "|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul)(?:[ \\t\\r\\n/][^>]*)?>")
ANY_TAG = "<[^>]*>"
#: The character references that are resolved, in this order.
REFERENCES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def page_lines(html: Column) -> Column:
    """Non-empty text lines of a page, blanks collapsed; null gives an empty array."""
    text = F.regexp_replace(html, UNSEEN, "")
    text = F.regexp_replace(text, BLOCK_TAG, "\n")
    text = F.regexp_replace(text, ANY_TAG, "")
    for name, char in REFERENCES:
        text = F.replace(text, F.lit(name), F.lit(char))
    text = F.regexp_replace(text, "[ \\t\\x0B\\f]+", " ")
    text = F.regexp_replace(text, " ?[\\r\\n]+[ \\r\\n]*", "\n")
    lines = F.array_remove(F.split(F.trim(text), "\n"), "")
    return F.coalesce(lines, F.array().cast("array<string>"))


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def listed(lines: pd.Series, drop: pd.Series) -> pd.Series:
    """Which of a page's lines (hashes) are in its drop list; null without a list."""
    return pd.Series([None if d is None else np.isin(x, d) for x, d in zip(lines, drop, strict=True)])


def drop_site_lines(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", max_ratio: float = 0.3, min_pages: int = 5,
) -> DataFrame:
    """One row per page: page_id, host, host_pages, n_lines, n_dropped, text (the kept lines)."""
    host = F.lower(F.regexp_extract(F.col(url), HOST, 1))
    cut = pin(pages.select(
        F.col(page_id).alias("page_id"), F.when(host != "", host).alias("host"), page_lines(F.col(html)).alias("lines"),
    ).withColumn("hashes", F.transform("lines", lambda x: F.xxhash64(x))), "site-lines")

    sites = cut.filter("host IS NOT NULL").groupBy("host").agg(F.count("*").alias("host_pages")).filter(F.col("host_pages") >= min_pages)
    counted = (
        cut.filter("host IS NOT NULL").select("host", F.explode(F.array_distinct("hashes")).alias("line"))
        .groupBy("host", "line").agg(F.count("*").alias("pages"))
        .filter(F.col("pages") > max_ratio * min_pages)
    )
    flagged = (
        counted.join(sites, "host").filter(F.col("pages") / F.col("host_pages") > max_ratio)
        .groupBy("host").agg(F.collect_list("line").alias("drop"))
    )
    drops = pin(sites.join(flagged, "host", "left"), "site-drops")
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda _, i: ~F.get("gone", i)))
    return (
        cut.join(drops, "host", "left")
        .withColumn("gone", listed("hashes", "drop"))
        .withColumn("kept", kept)
        .select("page_id", "host", "host_pages", F.size("lines").cast("long").alias("n_lines"),
                (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
                F.array_join("kept", "\n").alias("text"))
    )


def op9_site_lines(spark, sf_dir: str) -> DataFrame:
    """All ``pages`` without the lines that more than 30 % of their host's pages contain."""
    return drop_site_lines(spark.read.parquet(f"{sf_dir}/pages.parquet"))
