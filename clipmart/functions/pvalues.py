"""Mann-Whitney U tail probabilities.

Only one row per test family reaches Python: (n1, n2, U, tie term, ties).
Method choice follows the public behaviour of the usual library default:
exact null distribution when the smaller sample has at most 8 values and
there are no ties, otherwise the normal approximation with tie and
continuity correction.  Two-sided: p = min(1, 2 * P(U' >= U)), with
U = max(U1, n1*n2 - U1).
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT_MAX_SMALL = 8


def _ways(m: int, t: int, table: list[int], period: int) -> int:
    """Number of solutions of x_1 + 2 x_2 + ... + m x_m + slack = t in whole
    numbers from 0.  On every residue modulo ``period`` (a multiple of 1..m)
    this is a polynomial of degree m, so values beyond the table follow from
    m + 1 values in it by forward differences, exactly."""
    if t < 0:
        return 0
    if t < len(table):
        return table[t]
    row, steps, out = [table[t % period + j * period] for j in range(m + 1)], t // period, 0
    for k in range(m + 1):
        out += math.comb(steps, k) * row[0]
        row = [y - x for x, y in zip(row, row[1:])]
    return out


def exact_sf(u: int, m: int, n: int) -> float:
    """P(U >= u) under H0 for sample sizes m, n (no ties), in exact integers.

    U counts like a partition into at most m parts of at most n; the bound n
    on the parts is taken back by inclusion and exclusion over m terms.  Work
    and memory depend on the smaller sample only."""
    m, n = min(m, n), max(m, n)
    period = math.lcm(*range(1, m + 1))
    table = np.ones((m + 1) * period, dtype=object)  # the slack alone
    for i in range(1, m + 1):
        for r in range(i):
            table[r::i] = np.cumsum(table[r::i])
    values = table.tolist()
    below = m * n - max(0, int(u))  # by symmetry, P(U >= u) = P(U <= m n - u)
    count = sum((-1) ** len(s) * _ways(m, below - sum(n + i for i in s), values, period)
                for k in range(m + 1) for s in itertools.combinations(range(1, m + 1), k))
    return count / math.comb(m + n, m)


def asymptotic_sf(u: float, n1: int, n2: int, tie_term: float) -> float:
    n = n1 + n2
    mu = n1 * n2 / 2.0
    var = n1 * n2 / 12.0 * ((n + 1) - tie_term / (n * (n - 1)))
    if var <= 0:
        return float("nan")
    z = (u - mu - 0.5) / math.sqrt(var)
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def two_sided_p(n1: int, n2: int, u: float, tie_term: float, has_ties: bool) -> float | None:
    if n1 < 1 or n2 < 1:
        return None
    if min(n1, n2) <= EXACT_MAX_SMALL and not has_ties:
        p = 2.0 * exact_sf(int(round(u)), n1, n2)
    else:
        p = 2.0 * asymptotic_sf(u, n1, n2, tie_term)
    if math.isnan(p):
        return None
    return min(max(p, 0.0), 1.0)


@F.pandas_udf(T.DoubleType())
def mwu_pvalue(n1: pd.Series, n2: pd.Series, u: pd.Series, tie: pd.Series,
               ties: pd.Series) -> pd.Series:
    """Arrow-batched: one call per batch of family rows."""
    out = [two_sided_p(int(a), int(b), float(c), float(d), bool(e))
           for a, b, c, d, e in zip(n1, n2, u, tie, ties)]
    return pd.Series(out, dtype="float64")
