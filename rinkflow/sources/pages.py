"""Link pages and result books: HTML tables by expressions, documents by a decoder that callers bring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import absolute_url, parse_tournament, resolve_gender

SHOT_PAGE = "Game - Shot by Shot"
PAGES = "path string, page_idx int, text string, error string, words array<struct<x0:double,top:double,text:string>>, images array<struct<x0:double,x1:double,top:double,bottom:double>>"


def read_html(spark: SparkSession, path: str) -> DataFrame:
    """Pages fetched before, whole."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("html"))


def fetch_pages(urls: DataFrame, timeout: float = 30.0, agent: str = "Mozilla/5.0") -> DataFrame:
    """(url, html, error) of every row of ``urls(url)``, fetched on the executors; bytes that are no UTF-8 are replaced.

    A page that can't be fetched has its error and no text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.request import Request, urlopen

        for batch in batches:
            for url in batch.column(0).to_pylist():
                html, error = None, None
                try:
                    with urlopen(Request(url, headers={"User-Agent": agent}), timeout=timeout) as answer:
                        html = answer.read().decode("utf-8", errors="replace")
                except (OSError, ValueError) as e:
                    error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (url, html, error)], ["url", "html", "error"])

    return urls.select(F.col("url").cast("string").alias("url")).mapInArrow(run, "url string, html string, error string")


def read_documents(spark: SparkSession, path: str, decode: Callable[[bytes], list[dict]]) -> DataFrame:
    """Pages of binary files, one file per task: ``decode`` gives a dict of text, words and images per page.

    No decoder of result books is at hand here, so callers bring theirs.  A
    file that it can't read gives one row with the error and no text.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path_, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    pages = decode(content)
                except Exception as e:  # whatever the caller's decoder raises belongs to the file
                    pages = [{"text": None, "error": f"{type(e).__name__}: {e}"}]
                word = pa.list_(pa.struct([("x0", pa.float64()), ("top", pa.float64()), ("text", pa.string())]))
                image = pa.list_(pa.struct([(c, pa.float64()) for c in ("x0", "x1", "top", "bottom")]))
                kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), word, image]
                rows = [(path_, i, p["text"], p.get("error"), p.get("words", []), p.get("images", [])) for i, p in enumerate(pages)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["path", "page_idx", "text", "error", "words", "images"])

    return files.mapInArrow(run, PAGES)


def shot_pages(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("text").contains(SHOT_PAGE))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, '' if absent, wherever it stands."""
    return F.regexp_extract(tag, rf"""(?i)\b{name}\s*=\s*["']([^"']*)["']""", 1)


def anchors(html: Column) -> Column:
    """Array of (href, title, image) of the links in a piece of HTML."""
    found = F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*\bhref\s*=.*?</a>"), F.lit(0))
    def one(a: Column) -> Column:
        tag = F.regexp_extract(a, r"(?is)^<a\b[^>]*>", 0)
        image = F.regexp_extract(a, r"(?is)<img\b[^>]*>", 0)
        return F.struct(attribute(tag, "href").alias("href"), attribute(tag, "title").alias("title"), attribute(image, "src").alias("image"))

    return F.transform(found, one)


def table_cells(pages: DataFrame, table_id: str = "SearchTable") -> DataFrame:
    """(page_id, row_no, cells): the <td> cells of a table's rows that have five at least."""
    html = F.regexp_replace("html", '<tr">', "<tr>")
    table = F.regexp_extract(html, rf"""(?is)<table\b[^>]*\bid\s*=\s*["']{table_id}["'][^>]*>(.*?)</table>""", 1)
    rows = F.regexp_extract_all(table, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|$)"), F.lit(1))
    cells = F.regexp_extract_all("row", F.lit(r"(?is)<td\b[^>]*>(.*?)(?=</td>|<td\b|$)"), F.lit(1))
    out = pages.select("page_id", F.posexplode(rows).alias("row_no", "row")).select("page_id", "row_no", cells.alias("cells"))
    return out.where(F.size("cells") >= 5)


def plain(html: Column) -> Column:
    """Text without tags, with the commonest entities resolved."""
    t = F.regexp_replace(html, r"(?s)<[^>]*>", "")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(sign))
    return F.regexp_replace(t, r"(?U)^\s+|\s+$", "")


def scrape(pages: DataFrame) -> DataFrame:
    """Books of the result tables with their summaries of the same gender.

    Of several summaries of a gender in a row the last counts; a book without
    one has ''.  Rows without name, year or book go.
    """
    r = table_cells(pages).withColumn("t", plain(F.col("cells")[0])).withColumn("p", parse_tournament(F.col("t")))
    r = r.where("t <> '' and p.name <> '' and p.year <> ''")

    def links(cell: int, words: tuple[str, str]) -> DataFrame:
        out = r.select("page_id", "row_no", "t", "p", F.posexplode(anchors(F.col("cells")[cell])).alias("pos", "a"))
        out = out.select("page_id", "row_no", "p", "pos", absolute_url(F.col("a.href")).alias("url"), resolve_gender(F.col("a.title"), F.col("a.image"), F.col("t")).alias("gender"))
        return out.where(F.lower("url").contains(words[0]) | F.lower("url").contains(words[1]))

    book = links(3, ("resultsbook", "resultbook"))
    summary = links(4, ("resultssummary", "resultsummary"))
    return pair_summaries(book, summary).select("page_id", "row_no", F.col("p.name").alias("tournament_name"), F.col("p.year").alias("year"), F.col("p.location").alias("location"), "gender", F.col("url").alias("result_book_url"), "result_summary_url")


def pair_summaries(book: DataFrame, summary: DataFrame) -> DataFrame:
    last = summary.groupBy("page_id", "row_no", "gender").agg(F.max_by("url", "pos").alias("result_summary_url"))
    return book.join(last, ["page_id", "row_no", "gender"], "left").na.fill("", ["result_summary_url"])


def links(pages: DataFrame) -> DataFrame:
    """Every link of every page in order: page_id, pos, href, absolute url, title."""
    out = pages.select("page_id", F.posexplode(anchors(F.col("html"))).alias("pos", "a"))
    return out.select("page_id", "pos", F.col("a.href").alias("href"), absolute_url(F.col("a.href")).alias("url"), F.col("a.title").alias("title"))
