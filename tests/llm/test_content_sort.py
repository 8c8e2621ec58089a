"""Content sort against grouping in Python, over few and many partitions."""

import hashlib
from collections import defaultdict

import pytest

from credit_marts.llm import content_sort


def grouped(docs):
    by = defaultdict(list)
    for i, text in docs:
        by[content_sort.normal(text or "")].append(i)
    out = []
    for body, ids in by.items():
        keep = max(ids)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(body).hexdigest()) for i in ids]
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_groups(spark, parts):
    docs = [(i, "Copied TEXT" if i % 3 else "copied text") for i in range(400)]
    docs += [(1000 + i, f"same first words, then {i // 2}") for i in range(300)]
    docs += [(2000, None), (2001, ""), (2002, "É"), (2003, "é"), (2004, "K"), (2005, "K"), (2006, "x" * 200_000)]
    frame = spark.createDataFrame([(i, t, i, 0) for i, t in docs], "doc_id bigint, text string, __id bigint, keep int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert sorted(map(tuple, content_sort.content_groups(frame.repartition(5)).collect())) == grouped(docs)
        kept = content_sort.exact_dedup(frame.repartition(5))
        assert kept.columns == frame.columns
        expected = [(i, t, i, 0) for i, t in docs if (i, True) in {(r[0], r[3]) for r in grouped(docs)}]
        assert sorted(map(tuple, kept.collect())) == sorted(expected)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (None, "A"), (None, None), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = content_sort.content_groups(frame).collect()
    of_a = [r for r in got if r["group_size"] == 3]
    assert len(of_a) == 3 and {r["keep_id"] for r in of_a} == {1}
    assert [r["id"] for r in of_a if r["kept"]] == [1]
    assert sum(r["kept"] for r in got) == 2
    assert content_sort.exact_dedup(frame).count() == 2
    assert content_sort.content_groups(frame.limit(0)).collect() == []
