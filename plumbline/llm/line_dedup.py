"""Boilerplate lines of a site, by the share of its pages that have them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements after which a browser starts a new line.
BLOCKS = ("address|article|aside|blockquote|body|br|caption|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|"
          "option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul")
CODE = r"(?is)<(script|style)[ \t\r\n>].*?</(script|style)>"
COMMENT = r"(?s)<!--.*?-->"
BREAK = rf"(?i)</?({BLOCKS})([ \t\r\n/][^>]*)?>"
TAG = r"<[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:]*)"

PARTS = 64  # over which a large host's lines and pages are dealt
LARGE = 200  # a large host has more than one of so many pages, so there are fewer than that


def host_of(url: Column) -> Column:
    """Lower-cased host of an address; empty where it has none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 2))


def lines_of(html: Column) -> Column:
    """Text lines of a page, without markup and outer spaces; null and empty pages have none."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), CODE, ""), COMMENT, "")
    text = F.regexp_replace(F.regexp_replace(text, BREAK, "\n"), TAG, "")
    return F.filter(F.transform(F.split(text, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")


def line_key(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def large_hosts(totals: DataFrame) -> Column:
    """Whether ``host`` has more than one of ``LARGE`` pages; fewer than ``LARGE`` names come to the driver."""
    least = totals.agg((F.sum("host_pages") / LARGE).alias("least"))
    return F.col("host").isin([r["host"] for r in totals.where(F.col("host_pages") > least.scalar()).select("host").collect()])


def dealt(rows: DataFrame, large: Column, by: str) -> DataFrame:
    """Rows with the part of their host that they fall in."""
    return rows.withColumn("part", F.when(large, F.pmod(F.xxhash64(by), F.lit(PARTS))).otherwise(0).cast("int"))


def every_part(hosts: DataFrame, large: Column) -> DataFrame:
    """One row for each part of a host."""
    return hosts.withColumn("part", F.explode(F.when(large, F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))))


def without_boilerplate(
    pages: DataFrame, num: int = 3, den: int = 10, min_pages: int = 3, key: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """Every page with its lines that aren't boilerplate of its host.

    A line is boilerplate of a host when ``den * pages with it > num * pages of the host`` and it is on ``min_pages`` pages
    at least; a line repeated on a page counts once. Returns ``key``, ``host``, ``host_pages``, ``n_lines``, ``n_dropped``
    and ``text`` (lines kept, one a row of text). Rows are pages, so repeated rows count each; null and malformed addresses
    share the empty host; null pages have no lines. Other columns are not read; an empty table gives no rows.
    Counts are combined before they are shuffled, by (host, line), and large hosts' lines and pages
    are dealt over ``PARTS`` parts where they meet the host's total and boilerplate, so neither a large host nor a common line meets in one task. A
    host's boilerplate has at most (its lines a page) * den / num entries, so it travels as one array to the pages.
    """
    read = pages.select(F.col(key).alias("id"), host_of(F.col(url)).alias("host"), lines_of(F.col(html)).alias("lines"))
    seen = read.select("host", F.explode(F.array_distinct(F.transform("lines", line_key))).alias("line"))
    counted = seen.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    totals = pages.select(host_of(F.col(url)).alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    large = large_hosts(totals)
    common = dealt(counted, large, "line").join(every_part(totals, large), ["host", "part"]).where(F.col("n") * den > F.col("host_pages") * num)
    common = common.groupBy("host").agg(F.collect_list("line").alias("common"))
    sites = every_part(totals.join(common, "host", "left"), large)
    joined = dealt(read, large, "lines").join(sites, ["host", "part"], "left")
    known = F.coalesce("common", F.array().cast("array<struct<a:bigint,b:bigint>>"))
    joined = joined.withColumn("kept", F.filter("lines", lambda x: ~F.array_contains(known, line_key(x))))
    return joined.select(
        F.col("id").alias(key), "host", "host_pages", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("text"))


def oracle(num: int = 3, den: int = 10, min_pages: int = 3) -> str:
    """The same as SQL over the view ``pages``."""
    quoted = {k: v.replace("'", "''") for k, v in (("code", CODE), ("comment", COMMENT), ("brk", BREAK), ("tag", TAG), ("host", HOST))}
    text = "coalesce(html, '')"
    for name, to in (("code", "''"), ("comment", "''"), ("brk", "chr(10)"), ("tag", "''")):
        text = f"regexp_replace({text}, '{quoted[name]}', {to}, 'g')"
    return f"""
WITH read AS (SELECT row_number() OVER () AS row_no, page_id, lower(regexp_extract(coalesce(url, ''), '{quoted["host"]}', 2)) AS host,
    list_filter(list_transform(string_split({text}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS lines FROM pages),
totals AS (SELECT host, count(*) AS host_pages FROM read GROUP BY host),
seen AS (SELECT DISTINCT row_no, host, unnest(lines) AS line FROM read),
common AS (SELECT host, list(line) AS common FROM (SELECT s.host, line FROM seen s JOIN totals t ON s.host = t.host
    GROUP BY s.host, line, host_pages HAVING count(*) >= {min_pages} AND count(*) * {den} > host_pages * {num}) found GROUP BY host)
SELECT page_id, r.host, host_pages, CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(list_filter(lines, lambda x: list_contains(coalesce(common, []), x))) AS BIGINT) AS n_dropped,
    array_to_string(list_filter(lines, lambda x: NOT list_contains(coalesce(common, []), x)), chr(10)) AS text
FROM read r JOIN totals t ON r.host = t.host LEFT JOIN common c ON r.host = c.host"""
