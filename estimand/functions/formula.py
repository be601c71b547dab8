"""Metric formulas (``avg(a)/avg(b)`` or ``x1/x2``) and R-like model formulas.

The text is read with Python's own ``ast``; a metric becomes a small nested
tuple over argument positions that the finalizers evaluate, together with its
gradient, at a vector of means.
"""

import ast
import re
from dataclasses import dataclass

import numpy as np

_OPS = {ast.Add: "+", ast.Sub: "-", ast.Mult: "*", ast.Div: "/"}


@dataclass(frozen=True)
class Metric:
    tree: tuple

    def at(self, means):
        """Value and gradient at ``means``."""
        with np.errstate(all="ignore"):
            return _evaluate(self.tree, np.asarray(means, dtype=float))


def _evaluate(node, means):
    kind = node[0]
    if kind == "x":
        grad = np.zeros(len(means))
        grad[node[1]] = 1.0
        return means[node[1]], grad
    if kind == "c":
        return np.float64(node[1]), np.zeros(len(means))
    if kind == "neg":
        value, grad = _evaluate(node[1], means)
        return -value, -grad
    (a, da), (b, db) = _evaluate(node[1], means), _evaluate(node[2], means)
    if kind == "+":
        return a + b, da + db
    if kind == "-":
        return a - b, da - db
    if kind == "*":
        return a * b, a * db + b * da
    return a / b, (da - (a / b) * db) / b


class _Reader:
    """Maps avg(expr) calls and x1..xn names to argument positions."""

    def __init__(self, args):
        self.args = list(args) if args is not None else None
        self.columns = list(args) if args is not None else []

    def read(self, node):
        if isinstance(node, ast.Expression):
            return self.read(node.body)
        if isinstance(node, ast.BinOp) and type(node.op) in _OPS:
            return (_OPS[type(node.op)], self.read(node.left), self.read(node.right))
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
            return ("neg", self.read(node.operand))
        if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)):
            return ("c", float(node.value))
        if isinstance(node, ast.Name) and self.args is not None:
            m = re.fullmatch(r"x([1-9][0-9]*)", node.id)
            if m and int(m.group(1)) <= len(self.args):
                return ("x", int(m.group(1)) - 1)
        if (
            isinstance(node, ast.Call)
            and isinstance(node.func, ast.Name)
            and node.func.id == "avg"
            and len(node.args) == 1
            and self.args is None
        ):
            column = ast.unparse(node.args[0])
            if column not in self.columns:
                self.columns.append(column)
            return ("x", self.columns.index(column))
        raise ValueError(f"unsupported metric formula element: {ast.unparse(node)}")


def _parse(text):
    try:
        return ast.parse(text.strip(), mode="eval")
    except SyntaxError:
        raise ValueError(f"cannot read metric {text!r}; pass SQL expressions through args as x1..xn") from None


def _terms(node):
    if isinstance(node, ast.BinOp) and isinstance(node.op, ast.Add):
        return _terms(node.left) + _terms(node.right)
    return [node]


def read_metric(g, args=None, cuped=None):
    """Return ``(columns, [metric, covariate metrics...])``.

    ``g`` is either written over ``avg(<sql expr>)`` or, when ``args`` lists
    the column expressions, over ``x1..xn``.  ``cuped`` is a sum whose terms
    are the covariates.
    """
    reader = _Reader(args)
    metrics = [Metric(reader.read(_parse(g)))]
    if cuped:
        for term in _terms(_parse(re.sub(r"^\s*[xX]\s*=", "", cuped)).body):
            metrics.append(Metric(reader.read(term)))
    if not reader.columns:
        raise ValueError("metric formula uses no column")
    if args is not None:
        used = set()
        for m in metrics:
            _collect(m.tree, used)
        if used != set(range(len(args))):
            raise ValueError("metric formula must use exactly x1..xn")
    return reader.columns, metrics


def _collect(tree, used):
    if tree[0] == "x":
        used.add(tree[1])
    for part in tree[1:]:
        if isinstance(part, tuple):
            _collect(part, used)


def read_model(formula):
    """``y ~ x1 + x2`` -> (y, [x1, x2]); sides are SQL expressions."""
    y, sep, right = formula.partition("~")
    xs = _split_plus(right)
    if not sep or not y.strip() or not xs:
        raise ValueError(f"model formula must look like 'y ~ x1 + x2': {formula!r}")
    return y.strip(), xs


def read_iv(formula):
    """``y ~ (d1 ~ z1) + (d2 ~ z2) + x`` -> (y, [(d1, z1), (d2, z2)], [x])."""
    y, sep, right = formula.partition("~")
    pairs, xs = [], []
    for term in _split_plus(right):
        inner = re.fullmatch(r"\((.*)~(.*)\)", term, re.S)
        if inner:
            pairs.append((inner.group(1).strip(), inner.group(2).strip()))
        else:
            xs.append(term)
    if not sep or not y.strip() or not pairs:
        raise ValueError(f"IV formula must look like 'y ~ (d ~ z) + x': {formula!r}")
    return y.strip(), pairs, xs


def _split_plus(text):
    """Split on '+' outside parentheses."""
    parts, depth, current = [], 0, ""
    for ch in text:
        depth += (ch == "(") - (ch == ")")
        if ch == "+" and depth == 0:
            parts.append(current.strip())
            current = ""
        else:
            current += ch
    parts.append(current.strip())
    return [p for p in parts if p]
