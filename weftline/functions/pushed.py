"""Table names in the text of a query that a connector sends to its engine.

The text is cut into comments, literals, names (dotted, quoted by backticks or not) and other characters, so a FROM inside a literal or a
comment is none. This does not parse: FROM as a word of a function (``extract(year from d)``) is taken for the clause.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMMENT = r"--[^\n]*|/\*.*?\*/"
_LITERAL = r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\""
_PART = r"(?:`[^`]+`|\w+)"
_NAME = rf"{_PART}(?:\s*\.\s*{_PART})*"
_PIECE = rf"(?s){_COMMENT}|{_LITERAL}|{_NAME}|\S"


def pieces(query: Column) -> Column:
    """Names, literals and other characters in their order, without comments."""
    every = F.regexp_extract_all(query, F.lit(_PIECE), F.lit(0))
    return F.filter(every, lambda x: ~x.startswith("--") & ~x.startswith("/*"))


def tables(query: Column) -> Column:
    """The names after FROM or JOIN that the query does not define itself (``name AS (``), in order, without backticks; null for null."""
    # In an array of one, so that the pieces are cut once.
    found = F.transform(F.array(pieces(query)), _tables)[0]
    return F.when(query.isNotNull(), found)


def _tables(parts: Column) -> Column:
    at = lambda i: F.coalesce(F.get(parts, i), F.lit(""))
    plain = lambda x: F.regexp_replace(x, r"[`\s]", "")
    defined = F.filter(parts, lambda x, i: (F.lower(at(i + 1)) == "as") & (at(i + 2) == "(") & x.rlike(rf"^{_PART}$"))
    defined = F.transform(defined, lambda x: F.lower(plain(x)))
    after = F.filter(parts, lambda x, i: F.when(i > 0, F.lower(at(i - 1)).isin("from", "join")).otherwise(False) & x.rlike(rf"^{_NAME}$") & ~F.lower(x).isin("select", "lateral", "unnest"))
    return F.filter(F.transform(after, plain), lambda x: ~F.array_contains(defined, F.lower(x)))
