"""HTML to Markdown as an ordered chain of passes.

Every pass maps a bound value to a column; ``html_markdown`` runs them in turn.
"""

from __future__ import annotations

from functools import cache, partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions.entities import decode_entities
from docmill.functions.strings import (
    WORD_END,
    WS,
    in_turn,
    js_trim,
    let,
    normalize_markdown,
    replace_each,
    strip_tags,
    up_to_last,
)
from docmill.functions.tables import table_text

# Element groups that are treated alike.
DROPPED = "script|style|noscript|svg|head"
BLOCKS = "p|div|section|article|header|footer|tr|figure|figcaption"


def _element(name: str) -> str:
    """Pattern of a whole element; group 1 is its inner markup."""
    return f"(?is)<{name}{WORD_END}[^>]*>(.*?)</{name}>"


def _either(names: str) -> str:
    """Pattern of a whole element with one of several names; group 2 is its inner markup."""
    return rf"(?is)<({names}){WORD_END}[^>]*>(.*?)</\1>"


def _each_element(text: Column, name: str, rewrite) -> Column:
    return up_to_last(text, f"</{name}>", lambda t: replace_each(t, _element(name), rewrite))


def _paired(text: Column, names: str, rewrite) -> Column:
    """Apply ``rewrite`` to the text in which elements of several names can be, the opening tags that nothing closes renamed.

    The text ends with the last closing tag of any of the names. Where another name's last one lies
    before it, opening tags of that name behind it can't be paired and would each be searched for
    their end: they get a name that no pass knows and vanish with the other tags. Results are those
    of the pattern over the whole text. Pass a column or a bound value.
    """

    def settled(t: Column, name: Column) -> Column:
        closing = F.concat(F.lit(r"(?is)\A.*</"), name, F.lit(">"))
        opening = F.concat(F.lit("(?i)<"), name, F.lit(f"(?={WORD_END}[^>]*>)"))
        return let(
            F.coalesce(F.regexp_substr(t, closing), F.lit("")),
            lambda head: F.when(F.length(head) == F.length(t), t).otherwise(
                F.concat(head, F.regexp_replace(F.substr(t, F.length(head) + 1), opening, F.lit("<-")))
            ),
        )

    each = F.array(*(F.lit(n) for n in names.split("|")))
    return up_to_last(text, f"</(?:{names})>", lambda head: let(F.aggregate(each, head, settled), rewrite))


def _closed(body: Column, closing: str) -> Column:
    """The part in which elements with this closing tag can be."""
    return F.coalesce(F.regexp_extract(body, rf"(?is)\A.*{closing}", 0), F.lit(""))


def html_drop_blocks(text: Column) -> Column:
    """Pass 1: comments, then elements whose content is not text."""
    t = up_to_last(text, "-->", lambda h: F.regexp_replace(h, "(?s)<!--.*?-->", ""))
    return let(t, lambda kept: _paired(kept, DROPPED, lambda head: F.regexp_replace(head, _either(DROPPED), "")))


def html_breaks(text: Column) -> Column:
    """Pass 2: line breaks and rulers."""
    t = F.regexp_replace(text, f"(?i)<br{WS}*/?>", "\n")
    return F.regexp_replace(t, f"(?i)<hr{WS}*/?>", "\n\n---\n\n")


def _cells(row: Column) -> Column:
    """Inner markup of the cells of a row."""
    return let(
        _paired(_closed(row, "</t[dh]>"), "td|th", lambda head: head),
        lambda head: F.regexp_extract_all(head, F.lit(_either("td|th")), F.lit(2)),
    )


def html_tables(text: Column) -> Column:
    """Pass 3: tables to pipe tables; a table without cells disappears."""

    def rewrite(body: Column) -> Column:
        rows = F.filter(
            F.transform(
                F.regexp_extract_all(_closed(body, "</tr>"), F.lit(_element("tr")), F.lit(1)),
                lambda tr: F.transform(_cells(tr), inline_text),
            ),
            lambda cells: F.size(cells) > 0,
        )
        return let(
            rows,
            lambda r: F.when(F.size(r) == 0, F.lit("")).otherwise(
                F.concat(F.lit("\n\n"), table_text(r), F.lit("\n\n"))
            ),
        )

    return _each_element(text, "table", rewrite)


def html_headings(text: Column) -> Column:
    """Pass 4: h1 to h6 to that many hashes, level by level."""

    def one_level(t: Column, level: Column) -> Column:
        name = F.concat(F.lit("h"), level.cast("string"))
        closing = F.concat(F.lit("</"), name, F.lit(">"))
        pattern = F.concat(F.lit("(?is)<"), name, F.lit(f"{WORD_END}[^>]*>(.*?)</"), name, F.lit(">"))
        mark = F.concat(F.lit("\n\n"), F.repeat(F.lit("#"), level), F.lit(" "))
        return up_to_last(
            t,
            closing,
            lambda head: let(
                pattern,
                lambda p: replace_each(
                    head, p, lambda inner: F.concat(mark, inline_text(inner), F.lit("\n\n"))
                ),
            ),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(6)), text, one_level)


def html_pre(text: Column) -> Column:
    """Pass 5: preformatted text to a fence of three backticks."""

    def rewrite(inner: Column) -> Column:
        code = F.regexp_replace(strip_tags(inner), r"\A\n+|(?<!\n)\n++\z", "")
        return F.concat(F.lit("\n\n```\n"), code, F.lit("\n```\n\n"))

    return _each_element(text, "pre", rewrite)


def html_blockquote(text: Column) -> Column:
    """Pass 6: quoted lines, each trimmed."""

    def rewrite(inner: Column) -> Column:
        lines = F.transform(
            F.split(strip_tags(inner), "\n", -1), lambda line: F.concat(F.lit("> "), js_trim(line))
        )
        return F.concat(F.lit("\n\n"), F.array_join(lines, "\n"), F.lit("\n\n"))

    return _each_element(text, "blockquote", rewrite)


def html_lists(text: Column) -> Column:
    """Pass 7: list items to dashes, list ends to an empty line."""
    t = _each_element(text, "li", lambda inner: F.concat(F.lit("\n- "), inline_text(inner)))
    return F.regexp_replace(t, "(?i)</(?:ul|ol|dl)>", "\n\n")


def html_blocks(text: Column) -> Column:
    """Pass 8: block level tags to empty lines."""
    return F.regexp_replace(text, f"(?i)<(?:{BLOCKS}){WORD_END}[^>]*>|</(?:{BLOCKS})>", "\n\n")


LINK = f"(?is)<a{WORD_END}[^>]*href{WS}*={WS}*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"
IMAGE = f"(?i)<img{WORD_END}[^>]*alt{WS}*={WS}*[\"']([^\"']*)[\"'][^>]*>"
STRONG = "strong|b"
EMPHASIS = "em|i"


def _links(text: Column) -> Column:
    def rewrite(whole: Column) -> Column:
        href = js_trim(F.regexp_extract(whole, LINK, 1))
        return let(
            js_trim(strip_tags(F.regexp_extract(whole, LINK, 2))),
            lambda label: F.when(label == "", F.lit("")).otherwise(
                F.concat(F.lit("["), label, F.lit("]("), href, F.lit(")"))
            ),
        )

    return replace_each(text, LINK, rewrite, group=0)


def _images(text: Column) -> Column:
    return F.regexp_replace(text, IMAGE, "![$1]()")


def _marked(text: Column, names: str, mark: str) -> Column:
    return F.regexp_replace(text, _either(names), f"{mark}$2{mark}")


def _code(text: Column) -> Column:
    return F.regexp_replace(text, _element("code"), "`$1`")


def html_links(text: Column) -> Column:
    """Pass 9a: quoted links; a link without text disappears."""
    return up_to_last(text, "</a>", _links)


def html_emphasis(text: Column, names: str, mark: str) -> Column:
    """Pass 9c: one kind of emphasis."""
    return _paired(text, names, lambda head: _marked(head, names, mark))


def html_code(text: Column) -> Column:
    """Pass 9d: inline code, then every remaining tag goes."""
    return up_to_last(up_to_last(text, "</code>", _code), ">", strip_tags)


INLINE_PASSES = (
    html_links,
    _images,
    partial(html_emphasis, names=STRONG, mark="**"),
    partial(html_emphasis, names=EMPHASIS, mark="*"),
    html_code,
)


def inline_text(text: Column) -> Column:
    """Inner markup of one element as a single line. Pass a column or a bound value."""
    plain = F.when(F.contains(text, F.lit("<")), in_turn(text, INLINE_PASSES)).otherwise(text)
    return js_trim(F.regexp_replace(let(plain, decode_entities), f"{WS}+", " "))


HTML_PASSES = (
    html_drop_blocks,
    html_breaks,
    html_tables,
    html_headings,
    html_pre,
    html_blockquote,
    html_lists,
    html_blocks,
    *INLINE_PASSES,
    decode_entities,
    normalize_markdown,
)


def html_markdown(text: Column) -> Column:
    """All passes in order; a NULL stays NULL."""
    return in_turn(text, HTML_PASSES)


@cache
def html_of(column: str) -> Column:
    """``html_markdown`` of a named column, built once: micro-batches plan again and again."""
    return html_markdown(F.col(column))


def html_to_markdown(df: DataFrame, html_col: str = "html", out: str = "markdown") -> DataFrame:
    """Add the Markdown of an HTML column."""
    return df.withColumn(out, html_of(html_col))
