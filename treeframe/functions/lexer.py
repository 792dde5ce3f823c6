"""Code told from comments and strings, for five code languages.

One alternation cuts the whole text into tokens: comments, strings, runs of
code. All repeated groups are possessive, which the JVM runs as a loop and never takes
back, so a token costs time in proportion to its length and no stack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ANY = r"(?s:.)"
# A string that ends at its line's end if it is not closed: a lone quote in a text
# that is no string must not hide what follows.
_DOUBLE = rf'"(?:[^"\\\n]++|\\{_ANY})*+"?'
_SINGLE = rf"'(?:[^'\\\n]++|\\{_ANY})*+'?"
_SLASHES = rf"//(?:[^\\\n]++|\\{_ANY})*+"
_BLOCK = rf"/\*{_ANY}*?(?:\*/|\z)"

_SCRIPT = (
    rf"{_SLASHES}|{_BLOCK}|`(?:[^`\\]++|\\{_ANY})*+(?:`|\z)|{_DOUBLE}|{_SINGLE}|[^\"'`/]++|/"
)
# Alternatives in the order in which they are tried.
TOKENS: dict[str, str] = {
    "python": (
        rf'"""(?:[^"\\]++|\\{_ANY}|"(?!""))*+(?:"""|\z)'
        rf"|'''(?:[^'\\]++|\\{_ANY}|'(?!''))*+(?:'''|\z)"
        rf"|{_DOUBLE}|{_SINGLE}|#[^\n]*+|[^\"'#]++"
    ),
    "javascript": _SCRIPT,
    "typescript": _SCRIPT,
    "go": rf"//[^\n]*+|{_BLOCK}|`[^`]*+(?:`|\z)|{_DOUBLE}|{_SINGLE}|[^\"'`/]++|/",
    "cpp": (
        rf"{_SLASHES}|{_BLOCK}"
        # A raw string ends with its own mark.
        rf'|R"([^()\\\s"]{{0,16}}+)\({_ANY}*?(?:\)\1"|\z)'
        # Marks between digits are no quotes.
        r"|(?<=[0-9a-fA-F])(?<!u8)'(?=[0-9a-fA-F])"
        rf"|{_DOUBLE}|{_SINGLE}|[^\"'/R]++|[R/]"
    ),
}
_COMMENT_START = r"^/[/*]"


def _tokens(language: Column, content: Column) -> Column:
    chosen = None
    for name, pattern in TOKENS.items():
        found = F.regexp_extract_all(content, F.lit(pattern), F.lit(0))
        chosen = F.when(language == name, found) if chosen is None else chosen.when(language == name, found)
    return chosen.otherwise(F.array(content))


def _blank(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\n]", " ")


def code_only(language: Column, content: Column) -> Column:
    """``struct<code, strings>``: the text without comments and the insides of strings,
    and without comments alone.

    What is left out becomes spaces; lines and places stay as they are. Text in
    another language stays whole.
    """

    def parts(token: Column) -> Column:
        comment = F.when(language == "python", token.startswith("#")).otherwise(
            token.rlike(_COMMENT_START)
        )
        quoted = token.rlike(r"^(?:[\"'`]|R\")") & (F.length(token) > 1)
        first, last = F.substring(token, 1, 1), F.substring(token, -1, 1)
        inside = F.concat(
            first, _blank(F.substring(token, F.lit(2), F.length(token) - 2)),
            # A string that is not closed has no last quote.
            F.when(last.isin('"', "'", "`"), last).otherwise(_blank(last)),
        )
        known = language.isin(*TOKENS)
        return F.struct(
            F.when(known & comment, _blank(token)).when(known & quoted, inside)
            .otherwise(token).alias("code"),
            F.when(known & comment, _blank(token)).otherwise(token).alias("strings"),
        )

    masked = F.transform(_tokens(language, content), parts)
    return F.struct(
        F.array_join(masked["code"], "").alias("code"),
        F.array_join(masked["strings"], "").alias("strings"),
    )
