"""The end-of-run report: aggregates of a bounded number of rows, and a line for each failed domain, which stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleaner import vocabulary as v
from gleaner.functions.dialect import SPARK
from gleaner.functions.text import escape_cell, percent
from gleaner.operators.relational import field_completeness, most_common, top_domains


def _table(df: DataFrame, headers: list[str]) -> str:
    cells = df.select(*[F.expr(escape_cell(SPARK, f"cast(`{c}` as string)")).alias(c) for c in df.columns])
    rows = [" | ".join(r) for r in cells.collect()]
    return "\n".join(f"| {x} |" for x in [" | ".join(headers), " | ".join(["---"] * len(headers)), *rows])


def status_counts(summary: DataFrame) -> DataFrame:
    status = F.lower(F.trim("status"))
    counts = summary.agg(F.count("*").alias("total"), *[F.count_if(status == s).alias(s) for s in ("success", "failed", "skipped")])
    return counts.withColumn("rate", F.expr(percent(SPARK, "success", "total")))


def failure_reasons(summary: DataFrame, order: str | None = None) -> DataFrame:
    """Reasons by frequency, ties by first appearance in the column ``order``."""
    return most_common(summary, F.trim("reason"), "reason", order).select("reason", "n")


def report_head(listings: DataFrame, summary: DataFrame, errors: DataFrame) -> str:
    """Markdown with an overview, field completeness, top domains, failure reasons, and the heading of the failed domains.

    Equally frequent domains and reasons stand in the order of their first appearance, if the tables have a column
    ``place`` that tells it, else by name.
    """
    counts = status_counts(summary).first()
    filled = field_completeness(listings)
    order = F.array_position(F.array(*[F.lit(f) for f in v.LISTING_FIELDS]), F.col("field"))
    place = lambda df: "place" if "place" in df.columns else None
    top, reasons = top_domains(listings, order=place(listings)), failure_reasons(summary, place(summary))
    parts = [
        "# Listing Report\n\n## Overview",
        f"- Total domains processed: `{counts.total}`\n- Successful domains: `{counts.success}`\n- Failed domains: `{counts.failed}`"
        + (f"\n- Skipped domains: `{counts.skipped}`" if counts.skipped else "")
        + f"\n- Domain success rate: `{counts.rate}`\n- Total listings written: `{listings.count()}`",
        "## Field Completeness\n" + _table(filled.orderBy(order), ["Field", "Filled rows", "Fill rate"]),
        "## Top Successful Domains\n" + (_table(top, ["Domain", "Listings"]) if not top.isEmpty() else "_No listings were extracted._"),
        "## Failure Reasons\n" + (_table(reasons, ["Reason", "Count"]) if not reasons.isEmpty() else "_No failures._"),
        "## Failed Domains\n" + ("| Domain | Status | Reason |\n| --- | --- | --- |" if not errors.isEmpty() else "_No failed domains._"),
    ]
    return "\n\n".join(parts)


def report(listings: DataFrame, summary: DataFrame, errors: DataFrame) -> DataFrame:
    """``place, line``: the lines of the whole report; ``place`` sorts them, failed domains by their names."""
    spark = listings.sparkSession
    head = spark.createDataFrame([(f"0{i:06d}", x) for i, x in enumerate(report_head(listings, summary, errors).split("\n"))], "place string, line string")
    cells = [F.expr(escape_cell(SPARK, f"cast(`{c}` as string)")) for c in v.ERROR_FIELDS]
    failed = errors.select(F.concat(F.lit("1"), F.concat_ws("\t", *v.ERROR_FIELDS)).alias("place"), F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
    return head.union(failed)
