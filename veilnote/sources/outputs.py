"""Output tables of a run."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import output_name
from ..functions.render import render_clean_note, render_quarantine_note


def rendered(results: DataFrame, target_date) -> DataFrame:
    """Output name and body of each finished note."""
    clean = render_clean_note(F.lit(str(target_date)), F.col("ref_code"), F.col("counts"), F.col("deidentified_text"))
    held = render_quarantine_note(F.col("note_id"), F.col("ref_code"), F.col("quarantine_reason"), F.col("deidentified_text"))
    return results.select(
        "note_id", "ref_code", "created_at",
        F.when(F.col("is_quarantined"), "quarantine").otherwise("pending").alias("disposition"),
        output_name(F.col("created_at"), F.col("ref_code"), F.col("note_id"), F.col("is_quarantined")).alias("output_path"),
        F.when(F.col("is_quarantined"), held).otherwise(clean).alias("body"), "quarantine_reason")


def route_outputs(outputs: DataFrame, base: str, run_id: str) -> str:
    """Write pending and quarantined notes to separate folders of a new attempt of the run; gives the attempt's path.

    A second call with the same run id (a late file, a new checkpoint of a stream) never touches earlier outputs.
    """
    path = f"{base}/outputs/run_id={run_id}/attempt={uuid.uuid4().hex}"
    outputs.write.partitionBy("disposition").parquet(path)
    return path
