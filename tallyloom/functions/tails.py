"""Tail probabilities of the F and chi-square distributions, for one test result at a time."""

from __future__ import annotations

import math

TINY = 1e-300


def _steps(size: float) -> int:
    """Terms that are enough for parameters of this size: both expansions need some multiple of its root."""
    return 1000 + int(100 * math.sqrt(size))


def _lentz(first: float, terms) -> float:
    """Modified Lentz evaluation of a continued fraction given (a, b) pairs."""
    value = first or TINY
    c, d = value, 0.0
    for a, b in terms:
        d = 1.0 / ((b + a * d) or TINY)
        c = (b + a / c) or TINY
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return value
    raise ArithmeticError("the continued fraction did not converge")


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_inc(b, a, 1.0 - x)
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)

    def terms():
        for step in range(1, _steps(a + b)):
            m, odd = divmod(step, 2)
            if odd:
                yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
            else:
                yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    return math.exp(log_front) / a / _lentz(1.0, terms())


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0.0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        for k in range(1, _steps(a)):
            term *= x / (a + k)
            total += term
            if term < total * 1e-16:
                return 1.0 - front * total
        raise ArithmeticError("the series did not converge")
    return front / _lentz(x + 1.0 - a, ((-k * (k - a), x + 2.0 * k + 1.0 - a) for k in range(1, _steps(x))))


def f_tail(f: float, d1: float, d2: float) -> float:
    """P(F > f) for F with (d1, d2) degrees of freedom."""
    if math.isinf(f):
        return 0.0
    return beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_tail(x: float, dof: float) -> float:
    """P(X > x) for a chi-square variable."""
    return gamma_upper(dof / 2.0, x / 2.0)


def _known(*values) -> bool:
    return all(v is not None and not math.isnan(v) for v in values)


def f_p_value(f: float | None, d1: float | None, d2: float | None) -> float | None:
    return f_tail(f, d1, d2) if _known(f, d1, d2) and d1 > 0 and d2 > 0 else None


def chi2_p_value(x: float | None, dof: float | None) -> float | None:
    """A table without freedom shows no association: p is 1."""
    if not _known(x, dof):
        return None
    return chi2_tail(x, dof) if dof > 0 else 1.0
