"""Site-relative boilerplate lines: a line that too many pages of one host carry is dropped from all of them.

Built-in functions only. Lines are counted as 128-bit hashes with a partial sum in every map task, so neither a hot host
nor a very common line gathers rows. What is found, a few hashes per host, is written to the shared folder; its size is
then known, and Spark broadcasts it if it is small or else joins by host with a split of hot hosts. Texts move only then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import kept, twin_hash
from daymark.operators.joins import join_splitting

HOST, KEY, FOUND, LINES, LEFT = "__ld_host", "__ld_key", "__ld_found", "__ld_lines", "__ld_left"
#: Fixed: what is ignored around a line when lines are compared.
EDGES = " \t\r"
MAX_RATIO = 0.1
MIN_PAGES = 5


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(EDGES))


def site_key(host: Column) -> Column:
    """Pages without a host are a site of their own, apart from an empty host name."""
    return F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit("-"))


def boilerplate(pages: DataFrame, host: Column, text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per host the hashes of its boilerplate lines.

    A line counts once per page. Per host there are at most (lines of a mean page) / ``max_ratio`` of them, so the
    list of a host is short whatever the size of the host.
    """
    sites = pages.select(site_key(host).alias(HOST), F.col(text).alias("t"))
    totals = sites.groupBy(HOST).agg(F.count(F.lit(1)).alias("pages"))
    once = F.array_distinct(F.transform(F.filter(F.transform(_lines("t"), _bare), lambda x: x != ""), lambda x: twin_hash(x)))
    carried = sites.select(HOST, F.explode(once).alias(KEY)).groupBy(HOST, KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    common = join_splitting(carried, totals, [HOST], "inner").where(F.col("n") > max_ratio * F.col("pages"))
    return common.groupBy(HOST).agg(F.array_sort(F.collect_list(KEY)).alias(FOUND))


def drop_boilerplate_lines(
    pages: DataFrame, host: Column, text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, counts: bool = True
) -> DataFrame:
    """The pages without lines that more than ``max_ratio`` of their host's pages carry, ``min_pages`` pages at least.

    Lines end at a line feed and are compared without blanks, tabs and carriage returns around them; blank lines stay.
    A page of nothing but boilerplate stays as it is: whole copies are for the near-duplicate operators. A null text
    stays null (0 lines) and counts as a page; an empty one stays empty (1 line). Pages of a null host form one site. Repeated rows are
    pages of their own. All columns are kept; with ``counts`` there are two more, ``n_lines`` and ``n_dropped``,
    which replace columns of these names. An empty table gives an empty result.
    """
    found = kept(boilerplate(pages, host, text, max_ratio, min_pages), "boilerplate")
    joined = pages.withColumn(HOST, site_key(host)).join(found, HOST, "left")
    stays = lambda x: (_bare(x) == "") | ~F.array_contains(F.col(FOUND), twin_hash(_bare(x)))
    lines = joined.withColumn(LINES, _lines(text)).withColumn(LEFT, F.when(F.col(FOUND).isNotNull(), F.filter(LINES, stays)))
    rest = F.col(LEFT).isNotNull() & (F.size(LEFT) < F.size(LINES)) & F.exists(LEFT, lambda x: _bare(x) != "")
    out = lines.withColumn(LEFT, F.when(rest, F.col(LEFT)))
    if counts:
        size = F.coalesce(F.size(F.col(LINES)), F.lit(0))
        out = out.withColumns({"n_lines": F.when(F.col(LINES).isNull(), 0).otherwise(size).cast("long"), "n_dropped": F.coalesce(F.size(LINES) - F.when(F.col(LEFT).isNotNull(), F.size(LEFT)), F.lit(0)).cast("long")})
    return out.withColumn(text, F.coalesce(F.array_join(LEFT, "\n"), F.col(text))).drop(HOST, FOUND, LINES, LEFT)


#: The query over ``documents``, a document being a page of the host ``source``.
SQL = f"""
WITH pages AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents),
cut AS (SELECT doc_id, source, unnest(parts) AS line, unnest(generate_series(1, len(parts))) AS pos FROM pages),
bare AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM cut),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
carried AS (SELECT source, key, count(DISTINCT doc_id) AS n FROM bare WHERE key <> '' GROUP BY source, key),
common AS (SELECT c.source, c.key FROM carried c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source WHERE n >= {MIN_PAGES} AND n > {MAX_RATIO} * pages),
marked AS (SELECT b.*, c.key IS NOT NULL AS gone FROM bare b LEFT JOIN common c ON b.source IS NOT DISTINCT FROM c.source AND b.key = c.key),
cleaned AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_gone, count(*) FILTER (WHERE NOT gone AND key <> '') AS n_left, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS rest
  FROM marked GROUP BY doc_id)
SELECT p.doc_id, p.source, CASE WHEN n_gone > 0 AND n_left > 0 THEN rest ELSE p.text END AS text,
  coalesce(len(parts), 0)::BIGINT AS n_lines, CASE WHEN n_left > 0 THEN n_gone ELSE 0 END::BIGINT AS n_dropped
FROM pages p LEFT JOIN cleaned c USING (doc_id)
"""
