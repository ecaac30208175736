"""Mixing: water-level targets, exact cuts, odd rows."""

import hashlib
import re

import duckdb
import pytest

from ratelake.llm import mixing
from ratelake.llm.queries import op10_mixing
from tests.llm.util import SF, frame, oracle_rows, spark_rows

SCHEMA = "doc_id bigint, text string, source string, size string"


def literal_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    open_, left = set(names), share * sum(sizes.values())
    while open_ and left > 1e-9:
        total = sum(w[s] for s in open_)
        for s in open_:
            target[s] += left * w[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_.discard(s)
    return target


def literal(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _, _ in rows]
    per = {}
    for (_, _, s, _), n in zip(rows, size):
        per[s] = per.get(s, 0) + n
    target = literal_targets(per)
    h = [int(hashlib.md5(("null" if d is None else str(d)).encode()).hexdigest()[:15], 16) for d, *_ in rows]
    taken = [0] * len(rows)
    for s, total in per.items():
        epochs = int(target[s] // total) if total else 0
        left = target[s] - epochs * total
        groups = {}
        for i, r in enumerate(rows):
            if r[2] == s:
                groups.setdefault(h[i], []).append(i)
        run, open_ = 0, True
        for key in sorted(groups):
            n = sum(size[i] for i in groups[key])
            run += n
            more = open_ and (run <= left or 2 * (run - left) < n)
            if run > left:
                open_ = False
            for i in groups[key]:
                taken[i] = size[i] * min(2, epochs + more)
    return sorted(
        (repr(r[0]), size[i], per[r[2]], round(target[r[2]], 6), taken[i]) for i, r in enumerate(rows)
    )


ROWS = (
    [(i, "w " * (i % 7), "abc"[i % 3], "x") for i in range(200)]
    + [(1000 + i, "hot word " * 3, "hot", "x") for i in range(150)]
    + [(None, "no id", "a", None), (7, "same id", "b", "x"), (7, "same id", "b", "x")]
    + [(2000, None, None, "x"), (2001, "", None, "x"), (2002, "v " * 4000, None, "x"), (2003, "", "empty", "x")]
)


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], ROWS[:40], []])
def test_mix_against_literal(spark, rows):
    docs = frame(spark, rows, SCHEMA)
    got = mixing.mix(docs).collect()
    got = sorted((repr(r.doc_id), r["size"], r.source_size, round(r.target, 6), r["size"] * r.repeats) for r in got)
    assert got == literal(rows)


def test_documents_repeat_as_planned(spark):
    docs = frame(spark, ROWS, SCHEMA)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    plan = {}
    for r in mixing.mix(docs).collect():
        plan[(r.doc_id, r.source)] = plan.get((r.doc_id, r.source), 0) + r.repeats
    got = {}
    for r in out.collect():
        got[(r.doc_id, r.source)] = got.get((r.doc_id, r.source), 0) + 1
    assert got == {k: v for k, v in plan.items() if v}


def test_query_against_sql(spark):
    want = oracle_rows(mixing.ORACLE_SQL)
    got = spark_rows(op10_mixing(spark, SF))
    assert len(got) == len(want)
    key = lambda r: (r["doc_id"], r["size"], r["source_size"], round(r["target"], 4), r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_targets_are_near(spark):
    per = {}
    for r in spark_rows(op10_mixing(spark, SF)):
        assert r["taken"] <= 2 * r["size"]
        key = (r["source_size"], r["target"])
        per[key] = per.get(key, 0) + r["taken"]
    assert per and all(abs(t - k[1]) <= 0.2 * k[0] for k, t in per.items())
