"""Distribution functions used by the finalizers (scalar, standard library only).

They are evaluated a handful of times per *result* row, never per data row.
Large degrees of freedom matter here (tables of 1e12 rows), so log-beta is
computed from a Stirling difference instead of three ``lgamma`` calls, whose
absolute error grows with the argument.
"""

import math
from statistics import NormalDist

_NORMAL = NormalDist()


def norm_cdf(x):
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def norm_sf(x):
    return 0.5 * math.erfc(x / math.sqrt(2.0))


def norm_pdf(x):
    return math.exp(-0.5 * x * x) / math.sqrt(2.0 * math.pi)


def norm_ppf(p):
    if p <= 0.0:
        return -math.inf
    if p >= 1.0:
        return math.inf
    return _NORMAL.inv_cdf(p)


def _stirling_tail(x):
    return 1.0 / (12.0 * x) - 1.0 / (360.0 * x**3) + 1.0 / (1260.0 * x**5)


def log_beta(a, b):
    big, small = max(a, b), min(a, b)
    if big < 50.0:
        return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    total = big + small
    # lgamma(big + small) - lgamma(big)
    rise = (
        (big - 0.5) * math.log1p(small / big)
        + small * math.log(total)
        - small
        + _stirling_tail(total)
        - _stirling_tail(big)
    )
    return math.lgamma(small) - rise


def _beta_fraction(a, b, x):
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    m = 1
    while m < 5_000_000:
        step = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        d = 1.0 + step * d
        c = 1.0 + step / c
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = c if abs(c) > tiny else tiny
        h *= d * c
        step = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        d = 1.0 + step * d
        c = 1.0 + step / c
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = c if abs(c) > tiny else tiny
        h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
        m += 1
    return h


def beta_inc(a, b, num, den):
    """Regularised incomplete beta at x = num/(num+den); both parts are passed
    so that neither x nor 1-x is rounded away."""
    if num <= 0.0:
        return 0.0
    if den <= 0.0:
        return 1.0
    x, y = num / (num + den), den / (num + den)
    log_x = -math.log1p(den / num)
    log_y = -math.log1p(num / den)
    front = math.exp(a * log_x + b * log_y - log_beta(a, b))
    if x < (a + 1.0) / (a + b + 2.0):
        return min(1.0, front * _beta_fraction(a, b, x) / a)
    return max(0.0, 1.0 - front * _beta_fraction(b, a, y) / b)


def t_sf(t, df):
    """P(T > t) for Student's t."""
    if math.isnan(t) or df <= 0:
        return math.nan
    if math.isinf(t):
        return 0.0 if t > 0 else 1.0
    if t < 0:
        return 1.0 - t_sf(-t, df)
    if df > 1e5:
        # Fisher's expansion around the normal tail
        s = (t**3 + t) / (4 * df) + (3 * t**7 - 7 * t**5 - 5 * t**3 - 3 * t) / (96.0 * df * df)
        return max(0.0, norm_sf(t) + norm_pdf(t) * s)
    return 0.5 * beta_inc(df / 2.0, 0.5, df, t * t)


def t_cdf(t, df):
    return 1.0 - t_sf(t, df)


def t_ppf(p, df):
    """Quantile of Student's t."""
    if not df > 0 or math.isnan(p):
        return math.nan
    if p <= 0.0 or p >= 1.0:
        return -math.inf if p <= 0.0 else math.inf
    if p < 0.5:
        return -t_ppf(1.0 - p, df)
    z = norm_ppf(p)
    if df > 1e5:
        return (
            z
            + (z**3 + z) / (4 * df)
            + (5 * z**5 + 16 * z**3 + 3 * z) / (96.0 * df**2)
            + (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / (384.0 * df**3)
        )
    lo, hi = 0.0, max(2.0 * z, 1.0)
    while t_sf(hi, df) > 1.0 - p and hi < 1e300:
        hi *= 2.0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if t_sf(mid, df) > 1.0 - p:
            lo = mid
        else:
            hi = mid
        if hi - lo <= 1e-15 * max(1.0, hi):
            break
    return 0.5 * (lo + hi)


def f_sf(f, d1, d2):
    """P(F > f)."""
    if math.isnan(f) or d1 <= 0 or d2 <= 0:
        return math.nan
    if f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    return beta_inc(d2 / 2.0, d1 / 2.0, d2, d1 * f)


def chi2_sf(x, k):
    """P(chi-square_k > x)."""
    if math.isnan(x) or k <= 0:
        return math.nan
    if x <= 0:
        return 1.0
    a, z = k / 2.0, x / 2.0
    front = a * math.log(z) - z - math.lgamma(a)
    if z < a + 1.0:
        term = total = 1.0 / a
        n = a
        while term > total * 1e-17:
            n += 1.0
            term *= z / n
            total += term
        return max(0.0, 1.0 - total * math.exp(front))
    b = z + 1.0 - a
    c, d = 1e300, 1.0 / b
    h = d
    for i in range(1, 100_000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = b + an / c
        c = c if abs(c) > 1e-300 else 1e-300
        h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return math.exp(front) * h
