"""latest_per_key / any_per_key against a brute force over random rows."""

import random

import pytest

from conftest import rows
from ratelake.operators.dedupe import any_per_key, latest_per_key

KEYS = ["a", "b", None]
TIMES = ["2019-05-01 10:00:00", "2019-05-02 10:00:00", "", None]


def _sort_key_desc(v):
    # DESC NULLS LAST: larger first, NULL after everything
    return (v is None, tuple(-ord(ch) for ch in v) + (1,) if v is not None else ())


def brute(data, ties):
    groups = {}
    for r in data:
        groups.setdefault(r[0], []).append(r)
    out = []
    for g in groups.values():
        ordered = sorted(g, key=lambda r: (_sort_key_desc(r[1]), -r[2]))
        if ties == "one":
            out.append(ordered[0])
        else:
            best = ordered[0][1]
            out.extend(r for r in g if r[1] == best)
    return sorted(((r[0], r[2]) for r in out), key=repr)


@pytest.mark.parametrize("seed", range(5))
def test_latest_per_key_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.choice(KEYS), rnd.choice(TIMES), i) for i in range(80)]
    df = spark.createDataFrame(data, "k string, t string, id int")
    one = latest_per_key(df, ["k"], ["t"], ties="one", tie_break=[("id", "desc")])
    assert rows(one, "k", "id") == brute(data, "one")
    allt = latest_per_key(df, ["k"], ["t"], ties="all")
    assert rows(allt, "k", "id") == brute(data, "all")
    anyk = any_per_key(df, ["k"], tie_break=[("id", "asc")])
    firsts = {}
    for k, _, i in data:
        firsts[k] = min(i, firsts.get(k, i))
    assert rows(anyk, "k", "id") == sorted(firsts.items(), key=repr)
