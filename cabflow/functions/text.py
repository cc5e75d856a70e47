"""Line and token helpers with Java ``String.split`` semantics.

Java's ``split`` drops *trailing* empty tokens (and returns ``[""]`` for an
empty input); Spark's ``split`` keeps them.  The helpers below give the
Java result with built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(s, delim_regex: str, tail_chars: str | None = None) -> Column:
    """Tokens of ``s`` split by ``delim_regex`` as Java's ``String.split`` returns them.

    Trailing delimiters are stripped before a single split; the stripping
    regex runs only for lines whose last character is one of ``tail_chars``
    (the characters a delimiter match can end with; for a literal
    one-character delimiter, itself).
    """
    s = _c(s)
    if len(delim_regex) == 1 and delim_regex not in ".$|()[]{}^?*+\\":
        tail_chars = delim_regex          # a literal one-char delimiter ends with itself
    regex_strip = F.regexp_replace(s, f"(?:{delim_regex})+\\z", "")
    if tail_chars:
        last = F.substring(s, -1, 1)
        stripped = F.when(last.isin(*list(tail_chars)), regex_strip).otherwise(s)
    else:
        stripped = regex_strip
    return (F.when(s == "", F.array(F.lit("")))
             .when(stripped == "", F.array().cast("array<string>"))
             .otherwise(F.split(stripped, delim_regex, -1)))


def tokenize(line) -> Column:
    """Words of one line: lower-case, split on a single space (Java rules).

    ``"A b  "`` -> ``a, b``; ``" a  b"`` -> ``"", a, "", b``; ``""`` -> ``""``;
    ``"   "`` -> no tokens.
    """
    s = F.lower(_c(line))
    stripped = F.rtrim(s)            # trailing spaces only, no regex
    return (F.when(s == "", F.array(F.lit("")))
             .when(stripped == "", F.array().cast("array<string>"))
             .otherwise(F.split(stripped, " ", -1)))


def text_lines(text) -> Column:
    """Split a text into lines the way a line source does: one final line
    terminator does not start an extra empty line; ``\\r\\n`` counts as one."""
    t = _c(text)
    t = (F.when(t.endswith("\r\n"), t.substr(F.lit(1), F.length(t) - 2))
          .when(t.endswith("\n"), t.substr(F.lit(1), F.length(t) - 1))
          .otherwise(t))
    return F.transform(F.split(t, "\n", -1),
                       lambda x: F.when(x.endswith("\r"), x.substr(F.lit(1), F.length(x) - 1)).otherwise(x))
