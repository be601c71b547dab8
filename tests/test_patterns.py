"""Event patterns against a direct search over all choices of events."""

import itertools

import numpy as np
import pytest

from estimand.operators import events

PATTERNS = [
    "(?1)(?2)", "(?1).*(?2)", "(?1)(?2).*(?1)", "(?1).(?2)", "(?1)(?t<=3)(?2)", "(?1)(?t>3)(?2)", "(?1)(?t>=2)(?2)(?t<4)(?3)", "(?1)(?t==2)(?2)", "(?1)(?t==0)(?2)",
    "(?1)(?t>=0)(?3)", "(?2).*(?2).*(?2)", ".(?3).", "(?1)(?t<0)(?2)", ".*(?1)(?t>0)(?2).*"]


def matches(times, flags, steps):
    """(start, end) of all matches, by extending every choice of events."""
    found = []

    def extend(k, first, last):
        if k == len(steps):
            found.append((first, last))
            return
        number, gap = steps[k]
        for i in range(last + 1, len(times)):
            if number and not flags[i][number - 1]:
                continue
            apart = times[i] - times[last] if k else None
            if k and (gap is None and i != last + 1 or isinstance(gap, tuple) and not {"<=": apart <= gap[1], ">=": apart >= gap[1], "==": apart == gap[1]}[gap[0]]):
                continue
            extend(k + 1, first if k else i, i)

    extend(0, None, -1)
    return found


def taken(found):
    n, last = 0, -1
    for end in sorted({e for _, e in found}):
        if any(e == end and s > last for s, e in found):
            n, last = n + 1, end
    return n


def history(seed, users, rows):
    rng = np.random.default_rng(seed)
    out = []
    for u in range(users):
        t = np.sort(rng.integers(0, 14, rows))
        out += [(u, int(x), i, *(int(v) for v in rng.integers(0, 2, 3) * (rng.random(3) < 0.8))) for i, x in enumerate(t)]
    return out


@pytest.mark.parametrize("limit", [1000, 6])
@pytest.mark.parametrize("pattern", PATTERNS)
def test_patterns_match_a_direct_search(spark, pattern, limit):
    """A limit of 6 rows makes every user with more events a hot one."""
    data = [*history(len(pattern), 12, 14), (90, None, 0, 1, 1, 1), (91, 3, 0, 0, 0, 0), (None, 1, 0, 1, 0, 0)]
    df = spark.createDataFrame(data, "u long, t long, i long, a int, b int, c int")
    got = {r.u: (r.matched, r.matches) for r in events.sequence_pattern(df, "u", "t", pattern, ["a = 1", "b = 1", "c = 1"], ["i"], pattern_rows=limit).collect()}
    steps = events.parse_pattern(pattern, 3)
    wanted = {}
    for u, rows in itertools.groupby(sorted((r for r in data if r[0] is not None and r[1] is not None), key=lambda r: r[:3]), key=lambda r: r[0]):
        rows = [r for r in rows if any(r[3:])]
        n = taken(matches([r[1] * 1_000_000 for r in rows], [r[3:] for r in rows], steps))
        wanted[u] = (n > 0, n)
    assert got == wanted


@pytest.mark.parametrize("pattern", ["", "(?4)", "(?1)(?t<=1)", "(?t<1)(?1)", "(?1).*.*(?2)", "(?1)x(?2)"])
def test_wrong_patterns_raise(pattern):
    with pytest.raises(ValueError):
        events.parse_pattern(pattern, 3)
