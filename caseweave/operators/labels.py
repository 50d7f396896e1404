"""Validation of an annotated label set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from caseweave.functions import lexicon, text as tx

LABEL_DOMAINS = {
    "intent": lexicon.INTENTS,
    "resolution_status": lexicon.RESOLUTIONS,
    "requires_escalation": lexicon.ESCALATIONS,
}


def _finding(check: str, subject: str | Column, value: Column, n: Column) -> list[Column]:
    subject = F.lit(subject) if isinstance(subject, str) else subject
    return [
        F.lit(check).alias("check"), subject.alias("subject"), value.cast("string").alias("value"),
        n.cast("bigint").alias("n"),
    ]


def id_findings(df: DataFrame, id_column: str, expected: int) -> DataFrame:
    """Missing, extra and repeated ids against 1..``expected``."""
    ids = df.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).cast("bigint").alias("id")).agg(
        F.count(F.lit(1)).alias("n")
    )
    wanted = df.sparkSession.range(1, expected + 1)
    one = F.lit(1)
    missing = wanted.join(ids, "id", "left_anti").select(*_finding("missing_id", id_column, F.col("id"), one))
    extra = ids.join(wanted, "id", "left_anti").select(*_finding("extra_id", id_column, F.col("id"), F.col("n")))
    repeated = ids.where("n > 1").select(*_finding("duplicate_id", id_column, F.col("id"), F.col("n")))
    return missing.unionByName(extra).unionByName(repeated)


def blank_findings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls and blank texts per label column, from one pass."""
    counts = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"null_label:{c}") for c in columns],
        *[F.count_if(F.col(c).isNotNull() & tx.is_blank(F.col(c))).alias(f"empty_label:{c}") for c in columns],
    )
    long = counts.unpivot([], [F.col(f"`{c}`") for c in counts.columns], "key", "n")
    parts = F.split("key", ":")
    return long.select(parts[0].alias("check"), parts[1].alias("subject"), F.lit(None).cast("string").alias("value"), "n")


def domain_findings(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values outside the domain of their column."""
    parts = []
    for column, domain in domains.items():
        outside = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*domain))
        counted = outside.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        parts.append(counted.select(*_finding("invalid_value", column, F.col(column), F.col("n"))))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def label_findings(
    df: DataFrame,
    id_column: str = "annotation_id",
    expected: int = 200,
    domains: Mapping[str, Sequence[str]] = LABEL_DOMAINS,
    notes: str = "annotation_notes",
) -> DataFrame:
    """All findings as (check, subject, value, n) rows."""
    return (
        id_findings(df, id_column, expected)
        .unionByName(blank_findings(df, [*domains, notes]))
        .unionByName(domain_findings(df, domains))
    )


def label_verdict(
    df: DataFrame,
    id_column: str = "annotation_id",
    expected: int = 200,
    domains: Mapping[str, Sequence[str]] = LABEL_DOMAINS,
    notes: str = "annotation_notes",
) -> DataFrame:
    """One row: status PASS or REVIEW REQUIRED, and the reasons with their counts. Empty texts do not count."""
    findings = label_findings(df, id_column, expected, domains, notes)

    def rows(condition: Column) -> Column:
        return F.count_if(condition)

    check, subject = F.col("check"), F.col("subject")
    total = df.agg(F.count(F.lit(1)).alias("total"))
    counts = findings.agg(
        rows(check == "missing_id").alias("missing"),
        rows(check == "extra_id").alias("extra"),
        rows(check == "duplicate_id").alias("repeated"),
        F.coalesce(
            F.sum(F.when((check == "null_label") & subject.isin(*domains), F.col("n"))), F.lit(0)
        ).alias("unlabelled"),
        *[rows((check == "invalid_value") & (subject == c)).alias(f"invalid_{c}") for c in domains],
    )

    def reason(name: str, text: str) -> Column:
        return F.when(F.col(name) > 0, F.concat(F.lit(f"{text}: "), F.col(name).cast("string")))

    reasons = F.array_compact(F.array(
        reason("missing", "Missing IDs"),
        reason("extra", "Extra IDs"),
        reason("repeated", "Duplicate IDs"),
        reason("unlabelled", "Missing required labels"),
        *[reason(f"invalid_{c}", f"Invalid {c} values") for c in domains],
    ))
    with_reasons = counts.select(reasons.alias("reasons")).withColumn("total_rows", total.scalar())
    passed = (F.size("reasons") == 0) & (F.col("total_rows") == expected)
    return with_reasons.select(
        "total_rows", F.when(passed, "PASS").otherwise("REVIEW REQUIRED").alias("status"), "reasons"
    )
