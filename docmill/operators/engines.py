"""Results that several converters delivered for the same documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docmill.functions.strings import JS_SPACE, WS, is_blank, js_trim, normalize_markdown, strip_bom
from docmill.options import ENGINES, check_engine

# How package manager progress lines begin.
NOISE = (
    "Downloading Downloaded Installed Resolved Prepared Audited Building Built Installing "
    "Uninstalling Uninstalled Creating Updating Updated Using Removed"
).split() + ["warning: The `", "note: "]


def filter_engine_noise(text: Column) -> Column:
    """Diagnostics without progress lines and blank lines."""
    noise = rf"\A{WS}*(?:" + "|".join(NOISE) + ")"
    lines = F.transform(F.split(text, "\r?\n", -1), lambda line: F.rtrim(line, F.lit(JS_SPACE)))
    kept = F.filter(lines, lambda line: ~is_blank(line) & ~line.rlike(noise))
    return js_trim(F.array_join(kept, "\n"))


def clean_external_markdown(df: DataFrame) -> DataFrame:
    """Candidate ``(engine, markdown, stderr)`` rows made fit for a result.

    Output that is only white space is refused with its diagnostics.
    """
    text = strip_bom(F.col("markdown"))
    empty = is_blank(F.col("markdown"))
    said = js_trim(F.coalesce("stderr", F.lit("")))
    return (
        df.withColumn("markdown", text)
        .withColumn("status", F.when(empty, "empty_output").otherwise("ok"))
        .withColumn(
            "error",
            F.when(
                empty,
                F.concat(
                    "engine",
                    F.lit(" produced no Markdown"),
                    F.when(said == "", F.lit("")).otherwise(F.concat(F.lit(": "), said)),
                ),
            ),
        )
        .withColumn("markdown", F.when(~empty, normalize_markdown(F.col("markdown"))))
        .withColumn("stderr", filter_engine_noise(F.coalesce("stderr", F.lit(""))))
    )


def engine_rank(engine: Column) -> Column:
    """0 for the most preferred engine, NULL for an unknown one."""
    return F.nullif(F.array_position(F.array(*map(F.lit, ENGINES)), engine), F.lit(0).cast("bigint")) - 1


def select_engine(candidates: DataFrame, choice: str = "auto") -> DataFrame:
    """One candidate per document: the best ranked engine that delivered a row.

    Falling back depends on availability only, a blank result of the winner stays a
    failure. A forced engine has no fallback; a document it did not handle becomes an
    error row. The row number limit is applied per task before the shuffle.
    """
    check_engine(choice)
    forced = choice != "auto"
    order = [engine_rank(F.col("engine")).asc_nulls_last(), F.col("engine")]
    if forced:
        order.insert(0, (F.col("engine") == choice).desc())
    best = (
        candidates.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)))
        .where("place = 1")
        .drop("place")
    )
    cleaned = clean_external_markdown(best)
    if not forced:
        return cleaned
    missing = F.col("engine") != choice
    return cleaned.select(
        *[
            F.when(~missing, F.col(c)).alias(c) if c in ("markdown", "stderr") else F.col(c)
            for c in cleaned.columns
            if c not in ("engine", "status", "error")
        ],
        F.lit(choice).alias("engine"),
        F.when(missing, "engine_unavailable").otherwise(F.col("status")).alias("status"),
        F.when(missing, F.lit(f'engine "{choice}" is not available')).otherwise(F.col("error")).alias("error"),
    )
