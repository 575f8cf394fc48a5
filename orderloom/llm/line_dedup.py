"""Line dedup: lines that many sites carry are taken out of every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import fresh, text_of
from orderloom.session import shared_dir
from orderloom.sources.tables import written

_ENDS = " \t\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    """The lines of a text as an array; the empty text has one empty line."""
    return F.split(text, "\n")


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(_ENDS))


def line_sites(docs: DataFrame, text: str, site: str) -> DataFrame:
    """``line, site``: the digest of every line that is not blank, and its document's site."""
    lines = docs.select(F.explode(lines_of(text_of(text))).alias("line"), F.col(f"`{site}`").cast("string").alias("site"))
    kept = lines.filter(F.col("site").isNotNull()).withColumn("line", _trimmed(F.col("line"))).filter("line != ''")
    return kept.select(F.unhex(F.md5("line")).alias("line"), "site")


def spread_lines(
    docs: DataFrame, min_sites: int, text: str = "text", site: str = "source", bits: int = 12, margin: float = 0.1
) -> DataFrame:
    """``line``: digests of the lines on at least ``min_sites`` distinct sites.

    A sketch per line, merged by aggregation, estimates the sites. Lines whose
    estimate is within ``margin`` of the threshold (six standard errors at the
    default ``bits``) are counted exactly; sites combine before the shuffle, so
    a line that everybody carries is one row per task and site.
    """
    sites = line_sites(docs, text, site)
    estimates = sites.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", bits)).alias("sites"))
    lowest, highest = min_sites * (1 - margin), min_sites * (1 + margin)
    # Most lines are on few sites; what is left after this filter is written once.
    estimates = written(
        estimates.filter(F.col("sites") >= lowest), shared_dir(docs.sparkSession, "line-sites")
    )
    near = estimates.filter(F.col("sites") <= highest).select("line")
    exact = sites.join(near, "line", "left_semi").distinct().groupBy("line").count().filter(F.col("count") >= min_sites)
    return estimates.filter(F.col("sites") > highest).select("line").unionAll(exact.select("line"))


def remove_spread_lines(
    docs: DataFrame, min_sites: int = 10, key: str = "doc_id", text: str = "text", site: str = "source"
) -> DataFrame:
    """``docs`` without the lines that ``min_sites`` or more sites carry; same rows, same columns.

    Lines end at a line feed and are compared without blanks at their ends;
    blank lines stay. A document without a site adds to no line's sites, but
    loses spread lines like any other. NULL texts stay NULL. A document that
    would have nothing but blank lines left is a copy and not a carrier of
    boilerplate: it stays whole, for a document dedup to judge. Repeated rows
    are treated alike, also under one key.

    The columns ``n_lines`` and ``n_removed`` are added by :func:`line_report`.
    """
    reported = line_report(docs, min_sites, key, text, site, keep_columns=True)
    return reported.select(*[F.col(f"`{c}`") for c in docs.columns])


def line_report(
    docs: DataFrame,
    min_sites: int = 10,
    key: str = "doc_id",
    text: str = "text",
    site: str = "source",
    keep_columns: bool = False,
) -> DataFrame:
    """What :func:`remove_spread_lines` does: the key, the text left, ``n_lines`` and ``n_removed``.

    With ``keep_columns`` all other columns come along; ``n_lines`` and
    ``n_removed`` then have more underscores where ``docs`` has columns of these names.
    """
    spread = written(spread_lines(docs, min_sites, text, site), shared_dir(docs.sparkSession, "spread-lines"))
    # Rows are found again by key and text, so that repeated keys do no harm.
    row_key = [F.col(f"`{key}`").alias("row_key"), F.md5(text_of(text)).alias("row_text")]
    placed = docs.select(*row_key, F.posexplode(lines_of(text_of(text))).alias("place", "line"))
    digest = F.unhex(F.md5(_trimmed(F.col("line"))))
    hits = placed.filter(_trimmed(F.col("line")) != "").withColumn("line", digest).join(spread, "line", "left_semi")
    removed = hits.groupBy("row_key", "row_text").agg(F.collect_set("place").alias("removed"))

    n_lines, n_removed = fresh(docs, "n_lines"), fresh(docs, "n_removed")
    own = [F.col(f"`{c}`") for c in (docs.columns if keep_columns else (key, text))]
    # All columns travel as one, so that none can clash with the names used here.
    left = docs.select(*row_key, F.struct(*own).alias("row"))
    right = removed.select(F.col("row_key").alias("hit_key"), F.col("row_text").alias("hit_text"), "removed")
    same = F.col("row_key").eqNullSafe(F.col("hit_key")) & (F.col("row_text") == F.col("hit_text"))
    joined = left.join(right, same, "left")
    whole = F.col("row").getField(text)
    lines = lines_of(F.coalesce(whole, F.lit("")))
    cleaned = F.filter(lines, lambda line, i: ~F.array_contains(F.col("removed"), i))
    joined = joined.select(
        "row",
        F.size(lines).cast("long").alias("lines"),
        F.when(F.col("removed").isNotNull(), cleaned).alias("left"),
    )
    # Nothing but blanks left: the document stays whole.
    changed = F.exists("left", lambda line: _trimmed(line) != "")
    taken = F.when(changed, F.col("lines") - F.size("left")).otherwise(F.lit(0)).cast("long")
    result = F.when(changed, F.array_join("left", "\n")).otherwise(whole)
    others = [
        (result if c == text else F.col("row").getField(c)).alias(c) for c in (docs.columns if keep_columns else (key, text))
    ]
    return joined.select(*others, F.col("lines").alias(n_lines), taken.alias(n_removed))


def oracle_sql(min_sites: int) -> str:
    return rf"""
WITH placed AS (
    SELECT doc_id, source, u.place, u.line, trim(u.line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS bare
    FROM documents, LATERAL (
        SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    ) u
), spread AS (
    SELECT bare FROM placed WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= {min_sites}
), marked AS (
    SELECT p.*, s.bare IS NOT NULL AS hit FROM placed p LEFT JOIN spread s ON p.bare = s.bare
), judged AS (
    SELECT *, bool_or(NOT hit AND bare <> '') OVER (PARTITION BY doc_id) AS carrier FROM marked
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (hit AND carrier) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT (hit AND carrier)), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
