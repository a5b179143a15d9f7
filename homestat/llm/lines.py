"""Line deduplication over overlapping windows of consecutive lines (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestat.llm.common import free_names

BLANK = r"[^\x20\x09-\x0D]"  # a line that has none of these is blank


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 3) -> DataFrame:
    """Remove lines that repeat, in runs of ``window`` lines, from all but their first place.

    Lines are the parts of a text between line feeds. Every ``window`` consecutive lines
    of a document form a window; a window that occurs more than once in the table keeps
    its first occurrence (smallest id, then position), and the lines covered by any
    later occurrence go, overlapping windows merging. Windows are judged on the input.
    Blank lines count as equal to one another, and a window of blank lines only is no
    repeat. Every row comes back with all its columns, ``text_col`` holding the lines
    kept, plus ``n_lines`` and ``n_removed``.

    Null text: comes back null, 0 lines; it has no windows. Empty text: one empty line.
    Texts of fewer lines than a window: unchanged. Rows repeated with equal id and text
    count as one document and lose the same lines; a null id sorts before the others.
    Input columns called ``n_lines`` or ``n_removed`` (in any case) are replaced. An empty table gives
    an empty table.

    Scale: windows are hashed line by line, grouped with map-side partial aggregation,
    and only windows that occur twice are joined back (a join whose hot keys AQE can
    split); no task holds a group of equal windows.
    """
    own = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    key_id, key_text, later_id, later_text, starts, all_lines, kept_at = free_names(
        docs.columns, "_ld_id", "_ld_text", "_ld_id2", "_ld_text2", "_ld_starts", "_ld_lines", "_ld_kept")
    text = F.col(f"`{text_col}`")
    base = docs.select(
        *[F.col(f"`{c}`") for c in own],
        F.col(f"`{id_col}`").alias(key_id), F.xxhash64(text).alias(key_text),
    )
    hashed = docs.where(text.isNotNull()).select(
        F.col(f"`{id_col}`").alias(key_id), F.xxhash64(text).alias(key_text),
        F.transform(F.split(text, "\n"),
                    lambda x: F.when(x.rlike(BLANK), F.xxhash64(x)).otherwise(F.lit(0))).alias("h"),
    )
    names = [f"h{i}" for i in range(window)]
    runs = hashed.where(F.size("h") >= window).select(
        key_id, key_text,
        F.posexplode(F.slice(F.arrays_zip(*[F.slice("h", i + 1, F.size("h")).alias(n) for i, n in enumerate(names)]),
                             F.lit(1), F.size("h") - (window - 1))).alias("pos", "w"),
    ).select(key_id, key_text, "pos", *[F.col("w")[n].alias(n) for n in names])
    runs = runs.where(" or ".join(f"{n} <> 0" for n in names))
    repeated = (runs.groupBy(*names)
                .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(key_id, key_text, "pos")).alias("first"))
                .where("n > 1").drop("n"))
    later = (runs.join(repeated, names)
             .where(~F.struct(key_id, key_text, "pos").eqNullSafe(F.col("first")))
             .groupBy(key_id, key_text).agg(F.collect_set("pos").alias(starts))
             .withColumnsRenamed({key_id: later_id, key_text: later_text}))
    lines, covered = F.split(text, "\n"), F.flatten(F.transform(
        starts, lambda p: F.sequence(p, p + (window - 1))))
    kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), covered)
    out = (base.join(later, F.col(key_id).eqNullSafe(F.col(later_id)) & (F.col(key_text) == F.col(later_text)), "left")
           .withColumn(all_lines, lines)
           .withColumn(kept_at, F.when(F.col(starts).isNotNull(), kept)))
    n_lines = F.when(text.isNull(), 0).otherwise(F.size(all_lines)).cast("long")
    removed = F.when(F.col(starts).isNull(), 0).otherwise(F.size(all_lines) - F.size(kept_at)).cast("long")
    new_text = F.when(F.col(starts).isNull(), text).otherwise(
        F.array_join(F.transform(kept_at, lambda i: F.col(all_lines)[i]), "\n"))
    return out.select(
        *[new_text.alias(c) if c.lower() == text_col.lower() else F.col(f"`{c}`") for c in own],
        n_lines.alias("n_lines"), removed.alias("n_removed"))
