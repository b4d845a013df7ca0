"""Cell values: missing-value texts, lenient casts and the value filter."""

from __future__ import annotations

import ast
import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts read as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]


def null_tokens(cell: Column) -> Column:
    return F.when(~cell.isin(NULL_TOKENS), cell)


def lenient_long(cell: Column) -> Column:
    return cell.try_cast("bigint")


def lenient_double(cell: Column) -> Column:
    """Number in a cell, NULL when it is not one. NaN counts as missing.

    The JVM reads ``5d`` and ``5f`` as numbers; a logger cell with such a suffix is text.
    """
    number = cell.try_cast("double")
    suffixed = F.upper(F.right(F.rtrim(cell), F.lit(1))).isin("D", "F") & (F.abs(number) != float("inf"))
    return F.when(~F.isnan(number) & ~suffixed, number)


def tag_key(cell: Column) -> Column:
    """Tag id as text; ids that are whole numbers lose padding, so 07 and 7 are one tag."""
    return F.coalesce(lenient_long(cell).cast("string"), cell)


_ARITHMETIC = {
    ast.Add: lambda x, y: x + y, ast.Sub: lambda x, y: x - y, ast.Mult: lambda x, y: x * y,
    ast.Div: lambda x, y: _quotient(x, y), ast.Mod: lambda x, y: x - y * F.floor(F.try_divide(x, y)),
    ast.Pow: lambda x, y: _number(F.pow(x, y)),
}
_COMPARISONS = {
    ast.Lt: lambda x, y: x < y, ast.LtE: lambda x, y: x <= y, ast.Gt: lambda x, y: x > y,
    ast.GtE: lambda x, y: x >= y, ast.Eq: lambda x, y: x == y, ast.NotEq: lambda x, y: x != y,
}


def _number(x: Column) -> Column:
    """No comparison holds for a result that is not a number."""
    return F.when(~F.isnan(x), x)


def _quotient(x: Column, y: Column) -> Column:
    """A number divided by zero is infinite, with the sign of the number; zero by zero is missing."""
    infinite = F.when(x > 0, float("inf")).when(x < 0, float("-inf"))
    return F.when(y == 0, infinite).otherwise(F.try_divide(x, y))


def _condition(node: ast.AST, column: str) -> Column:
    if isinstance(node, ast.BoolOp):
        parts = [_condition(v, column) for v in node.values]
        return reduce(and_ if isinstance(node.op, ast.And) else or_, parts)
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.Not):
        return ~F.coalesce(_condition(node.operand, column), F.lit(False))
    if isinstance(node, ast.Compare):
        if len(node.ops) == 1 and isinstance(node.ops[0], (ast.In, ast.NotIn)) and isinstance(node.comparators[0], (ast.Tuple, ast.List)):
            found = reduce(or_, [_term(node.left, column) == _term(e, column) for e in node.comparators[0].elts], F.lit(False))
            return found if isinstance(node.ops[0], ast.In) else ~found
        terms = [_term(t, column) for t in (node.left, *node.comparators)]
        if all(type(op) in _COMPARISONS for op in node.ops):
            return reduce(and_, [_COMPARISONS[type(op)](x, y) for op, x, y in zip(node.ops, terms[:-1], terms[1:], strict=True)])
    raise ValueError("not a condition")


def _term(node: ast.AST, column: str) -> Column:
    if isinstance(node, ast.Name) and node.id == "val":
        return F.col(f"`{column}`").cast("double")
    if isinstance(node, ast.Constant) and type(node.value) in (int, float):
        return F.lit(float(node.value))
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.USub, ast.UAdd)):
        value = _term(node.operand, column)
        return -value if isinstance(node.op, ast.USub) else value
    if isinstance(node, ast.BinOp) and type(node.op) in _ARITHMETIC:
        return _ARITHMETIC[type(node.op)](_term(node.left, column), _term(node.right, column))
    raise ValueError("not a number")


def value_query(query: str, column: str = "value") -> Column:
    """Row filter from a text over ``val``, such as ``val >= 0 and val <= 100``.

    ``& | ~`` stand for ``and or not``; ranges (``0 <= val <= 100``), ``in`` and ``+ - * / % **`` are
    allowed, with division and remainder of floating-point numbers. Only the name ``val``, numbers
    and operators may occur. ``val`` is read from ``column``.
    """
    text = query.replace("&", " and ").replace("|", " or ").replace("~", " not ").replace("<>", "!=")
    text = re.sub(r"(?<![<>=!])=(?!=)", "==", text)
    text = re.sub(r"\b(and|or|not|in)\b", lambda m: m[0].lower(), text, flags=re.IGNORECASE)
    try:
        tree = ast.parse(text.strip(), mode="eval").body
        if not any(isinstance(n, ast.Name) for n in ast.walk(tree)):
            raise ValueError("val does not occur")
        return F.col(f"`{column}`").isNotNull() & _condition(tree, column)
    except (SyntaxError, ValueError) as error:
        raise ValueError(f"value query may only use val, numbers and comparisons: {query!r}") from error
