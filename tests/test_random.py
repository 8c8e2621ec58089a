"""Keys, orphans, duplicates and drift of random small tables against plain Python."""

from collections import Counter

from conftest import one
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from credit_marts.operators import checks, conform, profile

few = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
key = st.one_of(st.none(), st.integers(0, 5))
pairs = st.lists(st.tuples(key, key), max_size=25)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k bigint, v bigint")


@few
@given(rows=pairs)
def test_key_profile(spark, rows):
    complete = {r for r in rows if None not in r}
    assert one(profile.key_profile(frame(spark, rows), ["k", "v"])) == {
        "row_count": len(rows),
        "distinct_k": len({k for k, _ in rows if k is not None}),
        "distinct_key_combo": len(complete),
        "duplicate_key_combo": len(rows) - len(complete),
    }


@few
@given(rows=pairs, first=st.lists(key, max_size=4), second=st.lists(key, max_size=4))
def test_orphans(spark, rows, first, second):
    df = frame(spark, rows)
    parents = [profile.Parent(spark.createDataFrame([(k,) for k in keys], "id bigint"), "id") for keys in (first, second)]
    expected = Counter(r for r in rows if r[0] is None or r[0] not in {*first, *second})
    assert one(profile.orphan_count(df, "k", parents)) == {"orphan_k_count": expected.total()}
    assert Counter(map(tuple, profile.orphans(df, "k", parents).collect())) == expected


@few
@given(rows=pairs)
def test_dedup(spark, rows):
    expected = Counter((k, v) for k, v in rows if k is None)
    best = {}
    for k, v in rows:
        if k is not None:
            best[k] = min(best.get(k, v), v, key=lambda x: (x is None, x))  # values before NULL
    expected.update(best.items())
    df = frame(spark, rows)
    assert Counter(map(tuple, conform.dedup(df, ["k"]).collect())) == expected
    assert Counter(map(tuple, conform.dedup_rare(df, ["k"]).collect())) == expected


@few
@given(left=pairs, right=pairs)
def test_category_drift(spark, left, right):
    found = checks.category_drift(frame(spark, left), frame(spark, right), ["k", "v"], unseen_only=False).collect()
    sides = [Counter((c, None if x is None else str(x)) for row in rows for c, x in zip("kv", row)) for rows in (left, right)]
    assert {(r.column_name, r.value): (r.train_count, r.test_count) for r in found} == {
        value: (sides[0][value], sides[1][value]) for value in {*sides[0], *sides[1]}
    }
