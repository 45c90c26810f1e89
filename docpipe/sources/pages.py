"""Web pages to text and to records, with column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docpipe.spec import DocumentSpec, Field, Output

# Elements whose content is no text.
DROPPED = ("script", "style")
# Elements that start a new line.
BLOCKS = (
    "p|div|br|hr|h1|h2|h3|h4|h5|h6|ul|ol|li|table|tr|td|th|nav|article|section|header|footer|main"
    "|html|head|body|title"
)
# Character references, the ampersand last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&amp;", "&"))

PAGE = DocumentSpec(
    name="page",
    fields=(
        Field("title", description="Title of the page."),
        Field("lang", description="Declared language."),
        Field("heading", description="First main heading."),
    ),
    outputs=(
        Output("title", "title"),
        Output("lang", "lang"),
        Output("heading", "heading"),
    ),
)


def html_text(html: Column) -> Column:
    """Readable text of a page: comments, scripts and styles dropped, block elements on lines
    of their own, other tags removed, references decoded, blanks collapsed."""
    text = F.regexp_replace(html, "(?s)<!--.*?-->", "")
    for name in DROPPED:
        text = F.regexp_replace(text, f"(?is)<{name}[^>]*>.*?</{name}>", "")
    text = F.regexp_replace(text, f"(?i)</?(?:{BLOCKS})(?:[ \t\r\n][^>]*)?/?>", "\n")
    text = F.regexp_replace(text, "<[^>]*>", "")
    for reference, character in ENTITIES:
        text = F.replace(text, F.lit(reference), F.lit(character))
    text = F.regexp_replace(text, "[ \t\r]+", " ")
    text = F.regexp_replace(text, " ?\n[ \n]*", "\n")
    return F.btrim(text, F.lit(" \n"))


def page_json(df: DataFrame, html: str, result: str) -> DataFrame:
    """Expression model for ``PAGE``: adds the JSON text of each page; what a page does not
    state is null."""
    def stated(pattern: str) -> Column:
        return F.nullif(F.btrim(F.regexp_extract(html, pattern, 1), F.lit(" \t\r\n")), F.lit(""))

    record = F.struct(
        stated("(?is)<title[^>]*>(.*?)</title>").alias("title"),
        stated('(?i)<html[^>]* lang="([^"]*)"').alias("lang"),
        stated("(?is)<h1[^>]*>(.*?)</h1>").alias("heading"),
    )
    return df.withColumn(result, F.to_json(record, {"ignoreNullFields": "false"}))


def page_manifest(pages: DataFrame) -> DataFrame:
    """``page_id, name, length, same_name``: the last segment of the address without query and
    fragment (NULL where there is none), size in bytes, and how many pages have that name.
    Names are counted before they are shuffled."""
    address = F.regexp_replace("url", "[?#].*$", "")
    name = F.nullif(F.regexp_extract(address, "[^/]*$", 0), F.lit(""))
    listed = pages.select(
        "page_id", name.alias("name"), F.octet_length("html").cast("bigint").alias("length")
    )
    clashes = (
        listed.where(F.col("name").isNotNull())
        .groupBy(F.col("name").alias("_name"))
        .agg(F.count("*").alias("same_name"))
    )
    return listed.join(clashes, F.col("name") == F.col("_name"), "left").drop("_name")
