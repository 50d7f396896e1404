"""Writers: CSV, JSON lines, transcripts and the quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    """CSV with a header per part file, as one job; arrays are written as pipe-joined text."""
    flat = df.select(*[
        F.concat_ws("|", F.col(name).cast("array<string>")).alias(name) if kind.startswith("array") else F.col(name)
        for name, kind in df.dtypes
    ])
    mode = "append" if append else "overwrite"
    flat.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_threads(threads: DataFrame, path: str) -> None:
    """Nested THREAD records as JSON lines."""
    threads.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def transcript(threads: DataFrame) -> DataFrame:
    """One text block per thread: a framed heading and the turns with their speaker and id."""
    bar = "=" * 80
    line = F.transform(
        "conversation",
        lambda t: F.concat(
            F.lit("["), F.coalesce(t["speaker"], F.lit("nan")), F.lit("] "), F.coalesce(t["text"], F.lit("nan")),
            F.lit("\n    tweet_id: "), t["tweet_id"].cast("string"), F.lit("\n"),
        ),
    )
    return threads.select(
        F.concat_ws(
            "\n",
            F.lit(f"\n{bar}"),
            F.concat(F.lit("BRAND: "), "brand"),
            F.concat(F.lit("SUPPORT TWEET: "), F.col("support_tweet_id").cast("string")),
            F.concat(F.lit("MESSAGES: "), F.col("num_messages").cast("string")),
            F.lit(f"{bar}\n"),
            F.array_join(line, "\n"),
        ).alias("value")
    )


def write_transcripts(threads: DataFrame, path: str) -> None:
    transcript(threads).write.mode("overwrite").text(path)


REPORT_LINES = (
    ("raw_rows", "Raw rows"),
    ("clean_rows", "Clean rows"),
    ("duplicate_tweet_id_rows", "Duplicate tweet IDs"),
    ("duplicate_text_rows", "Duplicate tweet text"),
    ("empty_text_rows", "Empty text"),
    ("invalid_created_at_rows", "Invalid timestamps"),
    ("customer_inbound_rows", "Customer / inbound rows"),
    ("support_outbound_rows", "Support / outbound rows"),
    ("missing_parent_references", "Parent references missing from selected dataset"),
)


def quality_report(metrics: DataFrame) -> DataFrame:
    """The (metric, value) rows of the quality check as one text."""
    wide = metrics.groupBy().pivot("metric", [name for name, _ in REPORT_LINES]).agg(F.max("value"))
    sections = [
        F.concat(F.lit(f"{label}:\n"), F.format_number(F.col(name), 0)) for name, label in REPORT_LINES
    ]
    return wide.select(F.concat_ws("\n\n", F.lit("DATA QUALITY REPORT\n==================="), *sections).alias("value"))


def write_report(metrics: DataFrame, path: str) -> None:
    quality_report(metrics).write.mode("overwrite").text(path)
