"""Line dedup by spread over sites.

A line that stands on many sites is boilerplate. For every line (trimmed, of SHORTEST characters or
more) a HyperLogLog sketch of its sites is merged by aggregation; lines whose estimate is near the
threshold are counted exactly. Every occurrence of a line on at least SITES sites goes, but for the
first (smallest doc_id, then text hash, then place), so that no text is lost altogether.

Lines travel as two hashes and a place, never as text; a hot line's rows are pre-aggregated for
the sketches, and Spark splits its side of the joins. Texts move once, to meet the places to drop.

Defined cases: a null text stays null, a null site counts as no site, null ids come last. Rows with equal id
and text are treated alike, so the first occurrence stays in each of them. An empty table gives no
rows. All columns are kept; clashing names do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platterwatch.llm.texts import fresh
from platterwatch.sources.storage import stage

SITES = 5
SHORTEST = 20
PRECISION = 12  # of the sketches: a standard error of 1.04 / sqrt(2 ** 12), 1.6 %
NEAR = 5  # standard errors, at least one site


def line_table(docs: DataFrame, site: str) -> DataFrame:
    """id, mark (of the row's id and text), site, place, a, b (hashes of the line)."""
    line = F.trim("line")
    return (
        docs.select(
            F.col("doc_id").cast("bigint").alias("id"),
            F.xxhash64("doc_id", "text").alias("mark"),
            F.col(site).cast("string").alias("site"),
            F.posexplode(F.split("text", "\n", -1)).alias("place", "line"),
        )
        .where(F.length(line) >= SHORTEST)
        .select("id", "mark", "site", "place", F.xxhash64(line).alias("a"), F.hash(line).alias("b"))
    )


def boilerplate(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """(a, b, first): lines on at least `sites` sites and their first occurrence."""
    band = max(1.0, NEAR * 1.04 / 2 ** (PRECISION / 2) * sites)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "mark", "place")
    spread = lines.groupBy("a", "b").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", PRECISION)).alias("estimate"),
        F.min(order).alias("first"),
    )
    seen = stage(spread.where(F.col("estimate") >= sites - band), "spread")
    near = seen.where(F.col("estimate") <= sites + band)
    exact = (
        lines.join(near.select("a", "b"), ["a", "b"], "left_semi")
        .select("a", "b", "site")
        .where("site is not null")
        .distinct()
        .groupBy("a", "b")
        .count()
        .where(F.col("count") >= sites)
    )
    sure = seen.where(F.col("estimate") > sites + band)
    return sure.select("a", "b", "first").unionAll(
        near.join(exact, ["a", "b"]).select("a", "b", "first")
    )


def without_boilerplate(
    docs: DataFrame, site: str = "source", sites: int = SITES, removed: str | None = None
) -> DataFrame:
    """The documents, their texts without boilerplate lines. removed: name of an added column with the
    number of lines taken out."""
    lines = stage(line_table(docs, site), "lines")
    here = F.struct(F.col("id").isNull().alias("no_id"), "id", "mark", "place")
    key, mark, drop, parts = fresh(docs, "key", "mark", "drop", "parts")
    drops = (
        lines.join(boilerplate(lines, sites), ["a", "b"])
        .where(here != F.col("first"))
        .groupBy(F.coalesce("id", F.lit(0)).alias(key), F.col("mark").alias(mark))
        .agg(F.collect_set("place").alias(drop))
    )
    columns = [
        F.when(F.col(drop).isNull(), F.col("text")).otherwise(without(parts, drop)).alias(c)
        if c.lower() == "text"
        else F.col(f"`{c}`")
        for c in docs.columns
    ]
    if removed:
        columns.append(F.coalesce(F.size(drop), F.lit(0)).cast("bigint").alias(removed))
    marked = docs.withColumns({
        key: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)), mark: F.xxhash64("doc_id", "text"),
    })
    joined = marked.join(drops, [key, mark], "left")
    # A one-row generator, so that a text is split once and not again for each line that is kept.
    split = F.struct(F.when(F.col(drop).isNotNull(), F.split("text", "\n", -1)).alias(parts))
    return joined.select("*", F.inline(F.array(split))).select(*columns)


def without(parts: str, drop: str) -> F.Column:
    """The lines in column `parts` but for those at the places in column `drop`, joined: what lies between one
    dropped line and the next is taken as a whole, so work grows with the lines."""
    places = F.array_sort(F.col(drop))
    begins = F.concat(F.array(F.lit(0)), F.transform(places, lambda k: k + 1))
    ends = F.concat(places, F.array(F.size(parts)))
    between = F.arrays_zip(begins.alias("begin"), ends.alias("end"))
    kept = F.transform(between, lambda x: F.slice(F.col(parts), x["begin"] + 1, x["end"] - x["begin"]))
    return F.array_join(F.flatten(kept), "\n")
