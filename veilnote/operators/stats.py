"""Run counters, ledger and report."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..fixed_values import LEDGER_COLUMNS, LEDGER_ERROR_SUFFIX, REPORT_METRICS, RESIDUAL_REASONS


def run_stats(routed: DataFrame) -> DataFrame:
    """One row of counters from rows with a ``disposition``."""
    d = F.col("disposition")
    return routed.agg(
        F.count("*").alias("total"), F.count_if(d == "pending").alias("uploaded"),
        F.count_if(d == "quarantine").alias("quarantined"), F.count_if(d.startswith("skipped")).alias("skipped"),
        F.count_if(d == "error").alias("errors"))


def run_ledger_row(stats: DataFrame, run_date: str, run_at: str, inputs: str) -> DataFrame:
    """Stats as one ledger row; an error count becomes a message."""
    message = F.when(F.col("errors") > 0, F.concat(
        F.col("errors").cast("string"), F.lit(LEDGER_ERROR_SUFFIX))).otherwise("")
    values = (F.lit(run_date), F.lit(run_at), F.col("total"), F.col("uploaded"), F.col("quarantined"),
              F.col("skipped"), message, F.lit(inputs))
    return stats.select(*[v.alias(n) for v, n in zip(values, LEDGER_COLUMNS)])


def report_metrics(stats: DataFrame) -> DataFrame:
    """(metric, n) table; empty unless something was quarantined or failed."""
    pairs = ", ".join(f"'{label}', {column}" for label, column in REPORT_METRICS)
    return stats.where((F.col("quarantined") > 0) | (F.col("errors") > 0)).select(
        F.expr(f"stack({len(REPORT_METRICS)}, {pairs}) AS (metric, n)"))


def report_quarantined(results: DataFrame, masked: bool = True) -> DataFrame:
    """Quarantined notes; the raw values in the reason are masked by default."""
    reason = F.col("quarantine_reason")
    if masked:
        # The kind is looked up rather than cut out of the text, so no raw value can slip through.
        kinds = [F.when(reason.startswith(kind), F.lit(kind + "[masked]")) for kind in RESIDUAL_REASONS]
        reason = F.coalesce(*kinds, F.lit("[masked]"))
    return results.where("is_quarantined").select("note_id", "ref_code", reason.alias("reason"))


def report_errors(notes: DataFrame) -> DataFrame:
    return notes.where(F.col("error").isNotNull()).select("note_id", "error")


def label_totals(results: DataFrame) -> DataFrame:
    """Replacements per label over all notes."""
    return results.select(F.explode("counts").alias("c")).groupBy(F.col("c.label").alias("label")).agg(
        F.sum("c.n").alias("n"))
