import random

import numpy as np
import pyarrow as pa
import pytest
from llm_brute import near, shingle_set

from chronoweave.llm import circulant_minhash as op
from chronoweave.llm.components import components


def check(df, rows, n, percent):
    expected = sorted(((r[0], size, c, r[0] is None or r[0] == c) for r, (size, c) in zip(rows, near([r[0] for r in rows], [r[1] for r in rows], n, percent))), key=str)
    assert sorted((tuple(r) for r in df.collect()), key=str) == expected


@pytest.mark.parametrize("n,percent", [(3, 85), (5, 80)])
def test_like_brute_force(docs, rows, n, percent):
    check(op.groups(docs, n, percent), rows, n, percent)


def mutated(seed):
    """Chains and clouds of near copies on both sides of the threshold."""
    rng = random.Random(seed)
    rows = []
    for base in range(4):
        words = [f"w{rng.randrange(5000)}" for _ in range(90 + 40 * base)]
        for _ in range(40):
            own = list(words)
            for _ in range(rng.randrange(7)):
                own[rng.randrange(len(own))] = f"m{rng.randrange(400)}"
            rows.append((len(rows), " ".join(own)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [8, 512])
def test_clouds_of_near_copies(spark, docs, block):
    rows = mutated(block)
    check(op.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 85, block), rows, 3, 85)


def test_empty(no_docs):
    assert op.groups(no_docs).collect() == [] and op.representatives(no_docs).collect() == []


def test_one_of_each_group_stays(docs, rows):
    out = op.representatives(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    expected = {r[0] for r, (_, c) in zip(rows, near([r[0] for r in rows], [r[1] for r in rows], 5, 80)) if r[0] == c and c is not None}
    assert sorted(i for i in ids if i is not None) == sorted(expected)
    # the texts of the rows without an id stand on rows with one
    assert None not in ids


def test_a_doc_id_on_two_texts(spark):
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(0, base), (1, "fresh " * 3 + " ".join(f"v{i}" for i in range(60))), (1, base + " tail"), (1, base + " tail"), (2, ""), (2, None),
            (None, base), (None, "only here"), (None, "only here"), (3, base + " x"), (3, base + " y")]
    out = op.representatives(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int"))
    assert sorted(((r.doc_id, r.text or "") for r in out.collect()), key=str) == sorted([(0, base), rows[1], (2, ""), (None, "only here")], key=str)
    # a group whose smallest doc_id stands on two of its texts keeps one row
    twins = op.representatives(spark.createDataFrame([(5, base + " x"), (5, base + " y"), (9, base)], "doc_id long, text string"))
    assert [r.doc_id for r in twins.collect()] == [5]


def test_signatures_are_circulant_and_estimate_similarity():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    other = [w if rng.random() > 0.04 else "new" + w for w in words]
    column = pa.array([" ".join(words), " ".join(other)])
    key, row = op.shingles(column, 3)
    begin = np.searchsorted(row, [0, 1])
    s = op.signatures(key, begin, 512)
    a, b = shingle_set(column[0].as_py(), 3), shingle_set(column[1].as_py(), 3)
    assert abs((s[0] == s[1]).mean() - len(a & b) / len(a | b)) < 0.08
    scattered = op.permute((key >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995))[row == 0]
    assert s[0, 7] == op.permute(scattered + np.uint32(7)).min()


def test_components_of_chains(spark, docs):
    links = [(i, i + 1) for i in range(50)] + [(100, 103), (103, 101)] + [(200, i) for i in range(201, 230)]
    out = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(51)}, **{i: 100 for i in (100, 101, 103)}, **{i: 200 for i in range(200, 230)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
