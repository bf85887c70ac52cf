"""String expressions shared by every converter.

All functions take and return Columns and stay inside the JVM. Documents come from
many producers, so the patterns avoid quadratic scans (possessive runs behind a
look-behind, paired tags searched only up to their last closing tag).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space set of ECMAScript (trim and \s), wider than Java's.
JS_SPACE_CODES = (
    *(0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0xA0, 0x1680),
    *range(0x2000, 0x200B),
    *(0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF),
)
JS_SPACE = "".join(map(chr, JS_SPACE_CODES))
WS = "[" + "".join(rf"\x{{{code:X}}}" for code in JS_SPACE_CODES) + "]"
# \b after a tag name, ASCII only (Java's own \b is Unicode-aware).
WORD_END = "(?![A-Za-z0-9_])"


def literal_map(table: dict[str, str]) -> Column:
    """Constant map from text to text."""
    quoted = lambda text: f"r'{text}'" if "'" not in text else f'r"{text}"'
    return F.expr("map(" + ", ".join(f"{quoted(k)}, {quoted(v)}" for k, v in table.items()) + ")")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it any number of times in ``body``."""
    return F.transform(F.array(value), body).getItem(0)


def in_turn(text: Column, passes) -> Column:
    """Apply passes one after the other, each seeing the bound result of the one before.

    Passes use their input several times. Folding over the pass number keeps the whole
    chain one expression that names ``text`` once, so the optimizer never multiplies it
    when it moves filters or merges projections.
    """

    def step(t: Column, number: Column) -> Column:
        cases = F.when(number == 0, passes[0](t))
        for i, one in enumerate(passes[1:], 1):
            cases = cases.when(number == i, one(t))
        return cases

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(passes) - 1)), text, step)


def each_of(df: DataFrame, keys: tuple[str, ...], items: Column, place: str, item: str) -> DataFrame:
    """The keys with the elements of ``items`` and their places from 0, a row each.

    From a plain ``posexplode`` Spark infers filters on its array, which it moves below and so computes the
    array up to three times, at worst in the few tasks before a shuffle. The outer form infers none.
    """
    return df.select(*keys, F.posexplode_outer(items).alias(place, item)).where(F.col(place).isNotNull())


def as_column(pattern: str | Column) -> Column:
    return F.lit(pattern) if isinstance(pattern, str) else pattern


def replace_each(
    text: Column, pattern: str | Column, rewrite: Callable[[Column], Column], group: int = 1
) -> Column:
    """Replace every match by an expression over one captured group.

    ``text`` is used twice, so pass a column or a bound value.
    """
    return F.array_join(
        F.zip_with(
            F.split(text, pattern, -1),
            F.transform(F.regexp_extract_all(text, as_column(pattern), F.lit(group)), rewrite),
            lambda between, new: F.concat(between, F.coalesce(new, F.lit(""))),
        ),
        "",
    )


def up_to_last(text: Column, closing: str | Column, rewrite: Callable[[Column], Column]) -> Column:
    """Apply ``rewrite`` to the text up to its last ``closing`` match, keep the rest.

    A paired construct cannot match beyond its last closing tag, so the result is the
    same as over the whole text, but unclosed opening tags no longer scan to the end.
    Pass a column or a bound value as ``text``.
    """
    start = r"(?is)\A.*"
    # regexp_substr searches twice, but takes a pattern that is a column.
    fixed = isinstance(closing, str)
    head = F.regexp_extract(text, start + closing, 0) if fixed else F.regexp_substr(text, F.concat(F.lit(start), closing))
    return let(
        head,
        lambda head: F.when(head.isNull() | (head == ""), text).otherwise(
            F.concat(rewrite(head), F.substr(text, F.length(head) + 1))
        ),
    )


def js_trim(text: Column) -> Column:
    return F.btrim(text, F.lit(JS_SPACE))


def is_blank(text: Column) -> Column:
    return js_trim(text) == ""


def decode_text(content: Column) -> Column:
    """UTF-8 bytes to text; malformed sequences become U+FFFD."""
    return F.make_valid_utf8(content.cast("string"))


def strip_bom(text: Column) -> Column:
    return F.regexp_replace(text, r"\A\x{FEFF}", "")


def closed_part(text: Column, closing: str) -> Column:
    """The text up to its last ``closing``, empty without one; elements that it closes lie within.

    ``text`` is used several times, so pass a column or a bound value.
    """
    after = F.length(F.substring_index(text, closing, -1))
    return F.when(F.contains(text, F.lit(closing)), F.left(text, F.length(text) - after)).otherwise(F.lit(""))


def closed_elements(text: Column, pattern: str, closing: str, group: int = 1) -> Column:
    """All matches of an element's pattern that ends with ``closing``.

    Every opening tag before the last closing one finds an end and the search goes on behind it;
    those after it are not tried, so a text takes one pass however many tags it leaves open.
    """
    return let(text, lambda t: F.regexp_extract_all(closed_part(t, closing), F.lit(pattern), F.lit(group)))


def elements_or_marks(text: Column, pattern: str, marks: str, closing: str) -> Column:
    """Matches of ``pattern``, elements that end with ``closing`` or ``marks`` without one, in order."""

    def both(t: Column) -> Column:
        return let(
            closed_part(t, closing),
            lambda head: F.concat(
                F.regexp_extract_all(head, F.lit(pattern), F.lit(0)),
                F.regexp_extract_all(F.substr(t, F.length(head) + 1), F.lit(marks), F.lit(0)),
            ),
        )

    return let(text, both)


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]+>", "")


def normalize_markdown(text: Column) -> Column:
    """LF line ends, no trailing blanks on a line, at most one empty line, trimmed."""
    t = F.regexp_replace(text, "\r\n?", "\n")
    t = F.regexp_replace(t, r"(?<![ \t])[ \t]++(?=[\n\x{2028}\x{2029}]|\z)", "")
    t = F.regexp_replace(t, "\n{3,}", "\n\n")
    return js_trim(t)


def fence_text(text: Column, language: str = "") -> Column:
    """Code fence one backtick longer than the longest run inside, three at least."""

    def fenced(t: Column) -> Column:
        runs = F.transform(F.regexp_extract_all(t, F.lit("(`+)"), F.lit(1)), F.length)
        longest = F.coalesce(F.array_max(runs), F.lit(0))
        ticks = F.repeat(F.lit("`"), F.greatest(F.lit(3), longest + 1))
        return let(
            ticks,
            lambda k: F.concat(k, F.lit(language + "\n"), F.rtrim(t, F.lit(JS_SPACE)), F.lit("\n"), k),
        )

    return let(text, fenced)


def percent_decode(text: Column) -> Column:
    """Percent escapes decoded, ``+`` kept; NULL for a malformed escape or malformed UTF-8."""
    replaced, escape = F.lit(chr(0xFFFD)), F.lit("%EF%BF%BD")
    return let(
        F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))),
        lambda d: F.when(
            ~F.contains(d, replaced) | F.contains(text, replaced) | F.contains(F.upper(text), escape), d
        ),
    )
