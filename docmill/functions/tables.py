"""Pipe tables built inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill.functions.strings import js_trim, let


def escape_cell(text: Column) -> Column:
    """Escape pipes, turn line ends into spaces, trim."""
    t = F.replace(text, F.lit("|"), F.lit("\\|"))
    return js_trim(F.regexp_replace(t, "\r?\n", " "))


def blank_cells(count: Column) -> Column:
    """``count`` empty cells, without the closing bar of the line."""
    return F.repeat(F.lit("|  "), count.cast("int"))


def rule_line(width: Column) -> Column:
    return F.concat(F.repeat(F.lit("| --- "), width.cast("int")), F.lit("|"))


def table_line(cells: Column, width: Column) -> Column:
    """One line: escaped cells, then empty ones up to ``width``."""
    filled = F.array_join(
        F.transform(cells, lambda c: F.concat(F.lit("| "), escape_cell(c), F.lit(" "))), ""
    )
    return F.concat(filled, blank_cells(width - F.size(cells)), F.lit("|"))


def table_text(rows: Column) -> Column:
    """Array of rows to a pipe table: first row is the header, short rows are padded."""

    def render(r: Column) -> Column:
        def lines(width: Column) -> Column:
            body = F.transform(r, lambda cells: table_line(cells, width))
            return let(
                body,
                lambda b: F.array_join(
                    F.concat(
                        F.slice(b, 1, 1),
                        F.array(rule_line(width)),
                        F.slice(b, F.lit(2), F.size(b)),
                    ),
                    "\n",
                ),
            )

        widest = F.coalesce(F.array_max(F.transform(r, F.size)), F.lit(0))
        return let(widest, lambda w: F.when(w <= 0, F.lit("")).otherwise(lines(w)))

    return let(rows, render)
