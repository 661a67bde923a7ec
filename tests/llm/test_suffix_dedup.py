import random

import numpy as np
import pytest
from llm_brute import passages

from chronoweave.llm import suffix_dedup as op
from chronoweave.llm.bloom import BloomFilter


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def want(rows, length):
    return sorted(((r[0], *p) for r, p in zip(rows, passages([r[1] for r in rows], length))), key=str)


@pytest.mark.parametrize("options", [{}, {"batch_bytes": 5_000}, {"hot": 1}])
def test_like_brute_force(docs, rows, options):
    assert got(op.report(docs, **options)) == want(rows, 200)


def test_short_strings_many_levels(docs, rows):
    assert got(op.report(docs, length=40, gram=16, batch_bytes=2_000, hot=5)) == want(rows, 40)


def test_empty(no_docs):
    assert got(op.report(no_docs)) == [] and op.remove(no_docs).collect() == []


def test_stage_cuts_whole_characters(spark, docs):
    same = "ñandú y más cosas " * 20
    df = spark.createDataFrame([(1, "a" + same + "é", 9), (2, "ü" + same, 9), (3, "clean text é", 12)], "doc_id long, text string, n_chars int")
    out = {r.doc_id: (r.text, r.n_chars) for r in op.remove(df).collect()}
    assert out == {1: ("aé", 2), 2: ("ü", 1), 3: ("clean text é", 12)}
    assert op.remove(docs).columns == docs.columns and op.remove(docs).count() == docs.count()


def test_levels_grow_geometrically_and_stay_sorted():
    rng = random.Random(3)
    pool = [bytes(rng.choice(b"ab") for _ in range(60)) for _ in range(30)]
    family = op.Family(16)
    for b in range(13):
        family.add([(b, i, 45, rng.choice(pool)) for i in range(4)])
        orders = [level.order for level in family.levels]
        assert orders == sorted(set(orders), reverse=True) and sum(1 << o for o in orders) == b + 1
    windows = [w for level in family.levels for w in (bytes(level.text[p:p + 16]) for p in level.window)]
    for level in family.levels:
        ordered = [bytes(level.text[p:p + 16]) for p in level.window[level.sorted]]
        assert ordered == sorted(ordered)
        for p, m in zip(level.window, level.marked):
            assert m == (windows.count(bytes(level.text[p:p + 16])) > 1)


def test_bloom_filter_holds_all(spark, docs):
    keys = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000)
    held = BloomFilter.of(spark.createDataFrame([(int(k),) for k in keys], "h long"), size=1 << 17)
    assert held.holds(keys.view(np.uint64)).all()
    assert held.holds(np.arange(10_000, dtype=np.uint64)).mean() < 0.2
