"""Formulas kept as data, turned into Columns once per rule row.

A formula is ordinary arithmetic over variable names, so Python itself reads it and Column's own operators
build the expression; only the allowed syntax is let through. Results that plain Python arithmetic would
refuse (division by zero, roots of negative powers) become null.
"""

import ast

from pyspark.sql import Column, functions as F

from plumbline.functions.measures import round_exact

# Functions a formula may call.
FUNCTION_NAMES = ("ln", "log", "sqrt", "exp", "min", "max", "round", "abs")

_SYNTAX = (
    ast.Expression, ast.BinOp, ast.UnaryOp, ast.Call, ast.Name, ast.Load, ast.Constant,
    ast.Add, ast.Sub, ast.Mult, ast.Div, ast.Pow, ast.USub,
)


def _finite(c: Column) -> Column:
    return F.when(F.abs(c) < F.lit(float("inf")), c)  # NaN counts as larger than anything


def _logarithm(c: Column) -> Column:
    return F.when(c == 0, F.lit(float("-inf"))).when(c < 0, F.lit(float("nan"))).otherwise(F.ln(c))


def _column(value) -> Column:
    return value.column if isinstance(value, _Term) else F.lit(float(value))


class _Term:
    """A Column whose division and power follow the rules above."""

    def __init__(self, column: Column):
        self.column = column

    __add__ = lambda self, other: _Term(self.column + _column(other))
    __radd__ = lambda self, other: _Term(_column(other) + self.column)
    __sub__ = lambda self, other: _Term(self.column - _column(other))
    __rsub__ = lambda self, other: _Term(_column(other) - self.column)
    __mul__ = lambda self, other: _Term(self.column * _column(other))
    __rmul__ = lambda self, other: _Term(_column(other) * self.column)
    __truediv__ = lambda self, other: _Term(F.try_divide(self.column, _column(other)))
    __rtruediv__ = lambda self, other: _Term(F.try_divide(_column(other), self.column))
    __pow__ = lambda self, other: _Term(_finite(F.pow(self.column, _column(other))))
    __rpow__ = lambda self, other: _Term(_finite(F.pow(_column(other), self.column)))
    __neg__ = lambda self: _Term(-self.column)


def _call(function):
    return lambda *args: _Term(function(*[_column(a) for a in args]))


def _rounded(value, digits=0):
    column, digits = _column(value), int(digits)
    return _Term(F.rint(column) if digits == 0 else round_exact(column, digits))


_FUNCTIONS = {
    "ln": _call(_logarithm),
    "log": _call(_logarithm),
    "sqrt": _call(F.sqrt),
    "exp": _call(F.exp),
    "min": _call(F.least),
    "max": _call(F.greatest),
    "abs": _call(F.abs),
    "round": _rounded,
}


def formula_variables(expression: str) -> list[str]:
    """Variable names of a formula, checked for allowed syntax."""
    tree = ast.parse(expression.strip(), mode="eval")
    called = {n.func.id for n in ast.walk(tree) if isinstance(n, ast.Call) and isinstance(n.func, ast.Name)}
    for node in ast.walk(tree):
        wrong = (
            not isinstance(node, _SYNTAX)
            or isinstance(node, ast.Constant) and type(node.value) not in (int, float)
            or isinstance(node, ast.Call) and (node.keywords or not isinstance(node.func, ast.Name))
        )
        if wrong:
            raise ValueError(f"formula {expression!r} uses {type(node).__name__}")
    unknown = called - set(FUNCTION_NAMES)
    if unknown:
        raise ValueError(f"formula {expression!r} calls {sorted(unknown)}")
    return sorted({n.id for n in ast.walk(tree) if isinstance(n, ast.Name)} - called)


def uses_array_functions(expression: str) -> bool:
    """Whether a formula's result is an array-library number, which rounds by scaling."""
    return any(isinstance(n, ast.Name) and n.id in ("ln", "log", "sqrt", "exp") for n in ast.walk(ast.parse(
        expression.strip(), mode="eval")))


def formula_column(expression: str, variable) -> Column:
    """Column for a formula; ``variable`` maps a name to its double Column."""
    names = formula_variables(expression)
    scope = {"__builtins__": {}, **_FUNCTIONS, **{n: _Term(variable(n)) for n in names}}
    code = compile(ast.parse(expression.strip(), mode="eval"), "formula", "eval")
    return _column(eval(code, scope))  # syntax checked above: arithmetic over known names only
