"""The integer average: whole-number inputs, nulls skipped, NaN when nothing was counted."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ``{0}`` is the input. A text input may hold a fraction, which the second cast cuts off; what is no
# number, NaN included, is skipped, and a number past the longs is an error, as a sum past them is. Only
# built-in sum and count are used, so every task sends one partial (sum, count) pair per group to the shuffle.
_LIMIT = 9.2e18
_PROBLEM = "overflow: a number to average does not fit a long"
_WHOLE = (
    "coalesce(try_cast({0} AS BIGINT), try_cast(try_cast({0} AS DECIMAL(38, 18)) AS BIGINT), "
    f"CASE WHEN abs(try_cast({{0}} AS DOUBLE)) BETWEEN {_LIMIT} AND double('Infinity') "
    f"THEN CAST(raise_error('{_PROBLEM}') AS BIGINT) END)"
)
_AVERAGE = "coalesce(sum({whole}) / nullif(count({whole}), 0), double('NaN'))"

# What SQL text is made of as far as calls are concerned: quoted parts and comments, which stay as they are,
# the call's head, and parentheses.
_PIECE = re.compile(
    r"""(?P<opaque>'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`(?:[^`]|``)*`|--[^\n]*|/\*.*?\*/)"""
    r"""|(?P<call>(?<![\w`.])myAverage\s*\()|(?P<open>\()|(?P<close>\))""",
    re.IGNORECASE | re.DOTALL,
)


def my_average(col: Column | str) -> Column:
    """Aggregate column: sum of the truncated values over the count of the non-null ones."""
    value = F.col(col) if isinstance(col, str) else col
    too_large = F.abs(value.try_cast("double")).between(_LIMIT, float("inf"))
    whole = F.coalesce(
        value.try_cast("bigint"),
        value.try_cast("decimal(38,18)").try_cast("bigint"),
        F.when(too_large, F.raise_error(F.lit(_PROBLEM)).cast("bigint")),
    )
    return F.coalesce(F.sum(whole) / F.nullif(F.count(whole), F.lit(0)), F.lit(float("nan")))


def my_average_sql(expression: str) -> str:
    """The same aggregate as SQL text, for queries written as strings."""
    return _AVERAGE.format(whole=_WHOLE.format(f"({expression})"))


def expand_my_average(query: str) -> str:
    """Replace each ``myAverage(expression)`` in SQL text, outside quotes and comments.

    A function registered from Python would pull every row of a group through one task, so the
    call is written out as built-in aggregates instead.
    """
    done, at, depth, start = [], 0, 0, 0  # start: where the open call's expression begins
    for piece in _PIECE.finditer(query):
        if not depth and piece["call"]:
            done.append(query[at : piece.start()])
            depth, start = 1, piece.end()
        elif depth and (piece["open"] or piece["call"]):
            depth += 1
        elif depth and piece["close"]:
            depth -= 1
            if not depth:
                done.append(my_average_sql(query[start : piece.start()].strip()))
                at = piece.end()
    if depth:
        raise ValueError("a call of myAverage has no closing parenthesis")
    return "".join(done) + query[at:]


def text_list(value: Column | str, order: Column | str | None = None, delimiter: str = ",") -> Column:
    """The texts of a group as one, in the order given (ties, and no order, by the text); null texts are left out, and
    an empty group gives an empty text. What one group holds meets in one task, as the text it becomes does: group finer
    where a group's text is too long to be one value."""
    value = F.col(value) if isinstance(value, str) else value
    order = value if order is None else F.col(order) if isinstance(order, str) else order
    text = value.cast("string")
    cells = F.collect_list(F.when(text.isNotNull(), F.struct(order.alias("order"), text.alias("text"))))
    return F.array_join(F.transform(F.array_sort(cells), lambda cell: cell["text"]), delimiter)
