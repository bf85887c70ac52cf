"""Character references of HTML and XML."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill.functions.strings import let, literal_map, replace_each

# The named references that are decoded (matched without regard to case).
NAMED = {
    "amp": "&",
    "lt": "<",
    "gt": ">",
    "quot": '"',
    "apos": "'",
    "nbsp": " ",
    "ndash": "–",
    "mdash": "—",
    "hellip": "…",
    "copy": "©",
    "reg": "®",
    "trade": "™",
    "laquo": "«",
    "raquo": "»",
    "lsquo": "‘",
    "rsquo": "’",
    "ldquo": "“",
    "rdquo": "”",
    "bull": "•",
    "middot": "·",
    "deg": "°",
    "times": "×",
    "divide": "÷",
    "eacute": "é",
    "egrave": "è",
    "uuml": "ü",
    "ouml": "ö",
    "auml": "ä",
    "szlig": "ß",
}
REFERENCE = "&(#[xX]?[0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);"


def _character(code: Column) -> Column:
    utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
    return (
        F.when(code < 128, F.char(code))
        .when(code.between(0xD800, 0xDFFF), F.lit(chr(0xFFFD)))
        .when(code <= 0x10FFFF, F.decode(utf32, "UTF-32"))
    )


def _numeric(body: Column) -> Column:
    # Leading zeros go first, so a bounded digit count proves the value fits.
    def decimal(digits: Column) -> Column:
        return F.when(F.length(digits) <= 7, F.coalesce(digits.try_cast("int"), F.lit(0)))

    def hexadecimal(digits: Column) -> Column:
        return F.when(F.length(digits) <= 6, F.conv(F.concat(F.lit("0"), digits), 16, 10).try_cast("int"))

    is_hex = F.lower(F.substring(body, 2, 1)) == "x"
    deci = F.regexp_extract(body, "^#([0-9]*)", 1)
    code = F.when(is_hex, let(F.ltrim(F.substr(body, F.lit(3)), F.lit("0")), hexadecimal)).otherwise(
        let(deci, lambda d: F.when(d != "", let(F.ltrim(d, F.lit("0")), decimal)))
    )
    return let(code, _character)


def decode_entities(text: Column) -> Column:
    """One pass over the references; unknown ones stay. Pass a column or a bound value."""
    names = literal_map(NAMED)

    def resolve(body: Column) -> Column:
        known = F.when(F.startswith(body, F.lit("#")), _numeric(body)).otherwise(
            F.element_at(names, F.lower(body))
        )
        return F.coalesce(known, F.concat(F.lit("&"), body, F.lit(";")))

    return F.when(F.contains(text, F.lit("&")), replace_each(text, REFERENCE, resolve)).otherwise(text)
