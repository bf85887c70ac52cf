"""Formats that convert within one row: text, XML, JSON and delimited text."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions.entities import decode_entities
from docmill.functions.strings import (
    decode_text,
    fence_text,
    js_trim,
    let,
    normalize_markdown,
    strip_bom,
    up_to_last,
)
from docmill.functions.tables import table_text
from docmill.operators.routing import is_binary
from docmill.sources.delimited import delimited_rows


def plain_markdown(text: Column) -> Column:
    return normalize_markdown(strip_bom(text))


def plain_to_markdown(df: DataFrame, content_col: str = "content") -> DataFrame:
    """Plain text documents; binary data gets a status instead of Markdown."""
    content = F.col(content_col)
    return df.withColumn("status", F.when(is_binary(content), "binary").otherwise("ok")).withColumn(
        "markdown", F.when(F.col("status") == "ok", plain_markdown(decode_text(content)))
    )


def xml_to_text(text: Column) -> Column:
    """Text of an XML document, one non-blank trimmed line per run of text."""

    def lines(t: Column) -> Column:
        return F.array_join(
            F.filter(F.transform(F.split(t, "\n", -1), js_trim), lambda line: line != ""), "\n"
        )

    t = let(text, lambda x: up_to_last(x, r"\?>", lambda h: F.regexp_replace(h, r"(?s)<\?.*?\?>", "")))
    t = let(t, lambda x: up_to_last(x, "-->", lambda h: F.regexp_replace(h, "(?s)<!--.*?-->", "")))
    return lines(let(F.regexp_replace(t, "<[^>]+>", "\n"), decode_entities))


def xml_markdown(text: Column) -> Column:
    return normalize_markdown(xml_to_text(text))


def pretty_json(text: Column) -> Column:
    """JSON with two-space indent; text that is not JSON is returned unchanged.

    Spark's own JSON writers neither indent nested values nor keep number and key
    spelling, so this is an Arrow-batched Python stage over the text column alone.
    """

    def pretty(texts: pa.Array) -> pa.Array:
        import json
        import re
        from decimal import Decimal

        import pyarrow

        surrogate = re.compile("[" + chr(0xD800) + "-" + chr(0xDFFF) + "]")

        def refuse(word):
            raise ValueError(word)

        def number(x):
            if x == 0:
                return "0"
            if x in (float("inf"), float("-inf")):
                return "null"
            sign, digits, exponent = Decimal(repr(x)).normalize().as_tuple()
            text = "".join(map(str, digits))
            point = len(text) + exponent
            if len(text) <= point <= 21:
                body = text + "0" * (point - len(text))
            elif 0 < point <= 21:
                body = text[:point] + "." + text[point:]
            elif -6 < point <= 0:
                body = "0." + "0" * -point + text
            else:
                fraction = "." + text[1:] if len(text) > 1 else ""
                body = f"{text[0]}{fraction}e{point - 1:+d}"
            return ("-" if sign else "") + body

        def string(s):
            quoted = json.dumps(s, ensure_ascii=False)
            return surrogate.sub(lambda m: f"\\u{ord(m.group()):04x}", quoted)

        def index_key(k):
            return len(k) <= 10 and k.isascii() and k.isdigit() and (k == "0" or k[0] != "0") and int(k) < 2**32 - 1

        def scalar(value):
            if isinstance(value, str):
                return string(value)
            if value is None:
                return "null"
            if isinstance(value, bool):
                return "true" if value else "false"
            return number(value)

        def write(value):
            """Text of a tree of any depth: a stack of what is still to be written."""
            out, todo = [], [(value, "", "")]
            while todo:
                value, pad, before = todo.pop()
                out.append(before)
                if value is END:
                    continue
                if not isinstance(value, (list, dict)):
                    out.append(scalar(value))
                    continue
                ends = "[]" if isinstance(value, list) else "{}"
                if not value:
                    out.append(ends)
                    continue
                inner = pad + "  "
                if isinstance(value, list):
                    items = [("", v) for v in value]
                else:
                    first = sorted((k for k in value if index_key(k)), key=int)
                    keys = first + [k for k in value if not index_key(k)]
                    items = [(string(k) + ": ", value[k]) for k in keys]
                out.append(ends[0] + "\n")
                todo.append((END, "", "\n" + pad + ends[1]))
                for i in range(len(items) - 1, -1, -1):
                    todo.append((items[i][1], inner, ("" if i == 0 else ",\n") + inner + items[i][0]))
            return "".join(out)

        def parse(text):
            """The same tree as the parser of the library, which goes no deeper than the interpreter's stack."""
            at, open_, root = 0, [], []
            target, state = root, "value"

            def skip(i):
                return blank.match(text, i).end()

            def put(value):
                if isinstance(target, list):
                    target.append(value)
                else:
                    target[open_[-1][1]] = value

            while True:
                at = skip(at)
                c = text[at : at + 1]
                if state in ("value", "first") and c and c in "[{":
                    made = [] if c == "[" else {}
                    put(made)
                    open_.append([target, None, c])
                    target, state, at = made, "first" if c == "[" else "first key", at + 1
                elif (state == "first" and c == "]") or (state == "first key" and c == "}") or (state == "next" and open_ and c == ("]" if open_[-1][2] == "[" else "}")):
                    target, state, at = open_.pop()[0], "next", at + 1
                elif state in ("first key", "key"):
                    if c != '"':
                        raise ValueError
                    key, at = json.decoder.scanstring(text, at + 1, True)
                    at = skip(at)
                    if text[at : at + 1] != ":":
                        raise ValueError
                    open_[-1][1], state, at = key, "value", at + 1
                elif state in ("value", "first"):
                    value, at = leaf.scan_once(text, at) if c else refuse(c)
                    put(value)
                    state = "next"
                elif not open_:
                    if at != len(text):
                        raise ValueError
                    return root[0]
                elif c == ",":
                    state, at = "value" if open_[-1][2] == "[" else "key", at + 1
                else:
                    raise ValueError

        END = object()
        leaf = json.JSONDecoder(parse_int=float, parse_float=float, parse_constant=refuse)
        blank = re.compile("[ \t\n\r]*")

        def convert(text):
            if text is None:
                return None
            try:
                try:
                    value = json.loads(text, parse_int=float, parse_float=float, parse_constant=refuse)
                except RecursionError:
                    value = parse(text)
                return write(value)
            except (ValueError, StopIteration):
                return text

        return pyarrow.array((convert(t.as_py()) for t in texts), pyarrow.string(), size=len(texts))

    pretty.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(pretty, "string")(text)


def json_markdown(pretty: Column) -> Column:
    """Fence of already indented JSON."""
    return normalize_markdown(fence_text(pretty, "json"))


def json_to_markdown(df: DataFrame, text_col: str = "text", out: str = "markdown") -> DataFrame:
    return df.withColumn(out, pretty_json(F.col(text_col))).withColumn(out, json_markdown(F.col(out)))


def delimited_markdown(rows: Column) -> Column:
    """Pipe table of already split records."""
    return normalize_markdown(table_text(rows))


def delimited_to_markdown(
    df: DataFrame, delimiter: str = ",", text_col: str = "text", out: str = "markdown"
) -> DataFrame:
    """Delimited text to a pipe table within its own row: no shuffle, whatever the widths."""
    return df.withColumn(out, delimited_rows(F.col(text_col), delimiter)).withColumn(
        out, delimited_markdown(F.col(out))
    )
