"""Intake manifest rules (S7, S8), applied to a file-manifest DataFrame.

The remote-drive copiers decide per listed item whether to copy it and under
which name.  Here the listing is a DataFrame (``id, name, mimeType,
shortcutDetails``) and the decisions are column expressions, so a manifest of
any size is classified in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.schemas import CSV_SUFFIX, LANDING_PREFIX, MIME_CSV, MIME_FOLDER, MIME_SHEET, SHORTCUT_PREFIX


def classify_intake(manifest: DataFrame) -> DataFrame:
    """Add ``action`` and ``target_key`` to every manifest row.

    folder -> skip_folder; spreadsheet -> export (name gets '.csv' unless it
    already ends so, any case); text/csv or a '.csv' name (any case) ->
    download; anything else -> skip_other.
    """
    name, mime = F.col("name"), F.col("mimeType")
    is_sheet = mime == F.lit(MIME_SHEET)
    is_csv = (mime == F.lit(MIME_CSV)) | F.lower(name).endswith(CSV_SUFFIX)
    action = (F.when(mime == F.lit(MIME_FOLDER), F.lit("skip_folder"))
              .when(is_sheet, F.lit("export"))
              .when(is_csv, F.lit("download"))
              .otherwise(F.lit("skip_other")))
    target_name = (F.when(is_sheet & ~F.lower(name).endswith(CSV_SUFFIX), F.concat(name, F.lit(CSV_SUFFIX)))
                   .otherwise(name))
    return (manifest.withColumn("action", action)
            .withColumn("target_key", F.when(F.col("action").isin("export", "download"),
                                             F.concat(F.lit(LANDING_PREFIX), target_name))))


def intake(manifest: DataFrame) -> DataFrame:
    """Only the items that are copied: ``id, name, mimeType, action, target_key``."""
    return (classify_intake(manifest)
            .filter(F.col("action").isin("export", "download"))
            .select("id", "name", "mimeType", "action", "target_key"))


def resolve_shortcuts(manifest: DataFrame) -> DataFrame:
    """Resolve shortcut entries to their targets.

    An entry with ``shortcutDetails`` uses its target id and MIME type, any
    other uses its own.  A spreadsheet target is exported, its name gaining
    '.csv' unless it already ends with exactly '.csv'.
    """
    sd = F.col("shortcutDetails")
    has_sd = sd.isNotNull()
    target_id = F.when(has_sd, sd.getField("targetId")).otherwise(F.col("id"))
    target_mime = F.when(has_sd, sd.getField("targetMimeType")).otherwise(F.col("mimeType"))
    out = manifest.select(
        "id", "name",
        target_id.alias("target_id"),
        target_mime.alias("target_mime"),
    )
    export = F.col("target_mime") == F.lit(MIME_SHEET)
    filename = F.when(export & ~F.col("name").endswith(CSV_SUFFIX),
                      F.concat(F.col("name"), F.lit(CSV_SUFFIX))).otherwise(F.col("name"))
    return (out.withColumn("export", F.coalesce(export, F.lit(False)))
            .withColumn("target_key", F.concat(F.lit(SHORTCUT_PREFIX), filename)))
