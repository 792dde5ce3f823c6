"""Text expressions: quoting, previews, counting, hashing, decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from treeframe.functions.arrays import let

# How an outline shortens leaf text.
SHOWN_CHARS = 50
KEPT_CHARS = 47
ELLIPSIS = "..."

# Code points that a quoted literal shows as an escape; space is not one.
_NON_PRINTABLE = r"[\p{C}\p{Zl}\p{Zp}\p{Zs}&&[^ ]]"


def _escape_char(char: Column) -> Column:
    code = F.ascii(char)
    digits = F.lower(F.hex(code))
    return (
        F.when(char == "\t", F.lit("\\t"))
        .when(char == "\r", F.lit("\\r"))
        .when(char == "\n", F.lit("\\n"))
        .when(~char.rlike(_NON_PRINTABLE), char)
        .when(code < 0x100, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
        .when(code < 0x10000, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
        .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0")))
    )


def quote_literal(text: Column) -> Column:
    """Python-style literal: single quotes, or double ones when only those fit."""

    def quoted(raw: Column) -> Column:
        body = F.replace(raw, F.lit("\\"), F.lit("\\\\"))
        body = F.when(
            body.rlike(_NON_PRINTABLE),
            F.array_join(
                F.transform(F.regexp_extract_all(body, F.lit("(?s)."), F.lit(0)), _escape_char),
                "",
            ),
        ).otherwise(body)
        return F.when(
            raw.contains("'") & ~raw.contains('"'), F.concat(F.lit('"'), body, F.lit('"'))
        ).otherwise(
            F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))
        )

    return let(text, quoted)


def unquote_literal(literal: Column) -> Column:
    """Inner text of a quoted literal with all its escapes undone."""
    inner = F.substring(literal, F.lit(2), F.length(literal) - 2)
    plain = F.array_join(
        F.transform(
            F.regexp_extract_all(inner, F.lit(_ESCAPE_OR_RUN), F.lit(0)),
            lambda part: F.when(part.startswith("\\") & (F.length(part) > 1), _unescaped(part))
            .otherwise(part),
        ),
        "",
    )
    return F.when(literal.contains("\\"), plain).otherwise(inner)


# An escape, or a run of other characters; a last backslash stands for itself.
_ESCAPE_OR_RUN = (
    r"(?s)[^\\]+|\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\.|\\"
)


def _unescaped(escape: Column) -> Column:
    """The character of one escape; an unknown one stays as it is."""
    kind = F.substring(escape, 2, 1)
    code = F.conv(F.substring(escape, F.lit(3), F.length(escape) - 2), 16, 10).try_cast("int")
    return (
        F.when(kind == "t", F.lit("\t")).when(kind == "r", F.lit("\r")).when(kind == "n", F.lit("\n"))
        .when(kind.isin("\\", "'", '"'), kind)
        .when(
            kind.isin("x", "u", "U") & (F.length(escape) > 2) & (code <= 0x10FFFF),
            F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"),
        )
        .otherwise(escape)
    )


def leaf_literal(text: Column) -> Column:
    """Leaf text as an outline shows it: newlines escaped, shortened, quoted."""
    # One character more than is shown decides everything; the rest of a long
    # text never needs to be copied.
    head = F.replace(F.substring(text, 1, SHOWN_CHARS + 1), F.lit("\n"), F.lit("\\n"))
    return quote_literal(
        let(
            head,
            lambda h: F.when(
                F.length(h) > SHOWN_CHARS,
                F.concat(F.substring(h, 1, KEPT_CHARS), F.lit(ELLIPSIS)),
            ).otherwise(h),
        )
    )


def content_hash(content: Column) -> Column:
    """SHA-256 of the UTF-8 text, in hex."""
    return F.sha2(content, 256)


def occurrences(text: Column, word: str) -> Column:
    """Non-overlapping occurrences of ``word``."""
    removed = F.length(F.replace(text, F.lit(word), F.lit("")))
    return F.expr("cast(0 as bigint)") if not word else (
        (F.length(text) - removed) / F.lit(len(word))
    ).cast("bigint")


def preview(text: Column, chars: int = 500) -> Column:
    """The first ``chars`` characters."""
    return F.substring(text, 1, chars)


def preview_lines(text: Column, lines: int = 20) -> Column:
    """The first ``lines`` lines, with a mark when there are more."""
    # Fixed value: the mark.
    more = F.lit("\n... (truncated)")
    return let(
        F.split(text, "\n"),
        lambda parts: F.concat(
            F.array_join(F.slice(parts, 1, lines), "\n"),
            F.when(F.size(parts) > lines, more).otherwise(F.lit("")),
        ),
    )


def line_count(text: Column) -> Column:
    return F.size(F.split(text, "\n")).cast("bigint")


def top_level_lines(text: Column) -> Column:
    """Lines that do not start with a space."""
    return F.size(F.filter(F.split(text, "\n"), lambda l: ~l.startswith(" "))).cast("bigint")


def decoded(raw: Column) -> Column:
    """Bytes to ``struct<content, encoding>``: UTF-8, else Latin-1.

    Line ends become ``\\n``; a byte order mark stays in the text.
    """
    utf8 = F.try_validate_utf8(raw.cast("string"))
    return let(
        F.struct(
            F.coalesce(utf8, F.decode(raw, "ISO-8859-1")).alias("content"),
            F.when(raw.isNull(), F.lit(None).cast("string"))
            .when(F.is_valid_utf8(raw.cast("string")), F.lit("utf-8"))
            .otherwise(F.lit("latin-1")).alias("encoding"),
        ),
        lambda d: F.struct(
            F.regexp_replace(d["content"], "\r\n?", "\n").alias("content"),
            d["encoding"].alias("encoding"),
        ),
    )
