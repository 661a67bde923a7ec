import random

import numpy as np
import pytest
from llm_brute import ALNUM, LOWER, contamination

from chronoweave.llm import decontaminate as op

ITEMS = [(1, "That long passage went on for many more words than anyone there would"), (2, "one two"), (3, "ONE"), (4, None), (5, "  ... "),
         (6, "日本語 😀 ñandú"), (None, "shared passage number 3 stands here in full shared passage number 4"), (1, "word5 of5 word6 of6 word7 of7 word8 of8 word9 of9"),
         (10, "a b c a b c a b c a b c"), (11, "nowhere to be found in any of these documents at all, I hope")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("limit", [1 << 24, 100])
def test_like_brute_force(docs, rows, items, limit):
    expected = sorted(((r[0], *c, c[1] > 0) for r, c in zip(rows, contamination([r[1] for r in rows], ITEMS, 10))), key=str)
    assert sorted((tuple(r) for r in op.report(docs, items, limit=limit).collect()), key=str) == expected


def test_removal(docs, rows, items):
    out = op.remove(docs, items)
    assert out.columns == docs.columns and out.count() == len(rows)
    for r in out.where("text is not null").collect():
        left = [w for w in ALNUM.findall(r.text.translate(LOWER))]
        assert "ñandú" not in left and "one" not in left
    clean = {r[0]: r[1] for r, c in zip(rows, contamination([r[1] for r in rows], ITEMS, 10)) if c[1] == 0 and r[0] is not None}
    assert {r.doc_id: r.text for r in out.collect() if r.doc_id in clean} == clean


def test_empty(docs, no_docs, items, spark):
    assert op.report(no_docs, items).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert op.report(docs, none).where("contaminated or n_items > 0").count() == 0


def test_fm_index_finds_every_place():
    rng = random.Random(5)
    text = [0]
    for _ in range(12):
        text += [rng.randrange(1, 5) for _ in range(rng.randrange(1, 60))] + [0]
    index = op.FMIndex(np.array(text), 4, sample=5)
    for size in (1, 2, 3, 6):
        windows = np.array([[rng.randrange(1, 5) for _ in range(size)] for _ in range(40)])
        low, high = index.search(windows)
        for w, a, b in zip(windows.tolist(), low, high):
            places = sorted(index.locate(np.arange(a, b)).tolist())
            assert places == [i for i in range(len(text) - size + 1) if text[i:i + size] == w]


def test_pieces_hold_each_window_once():
    rng = random.Random(3)
    for n in (1, 9, 10, 11, 40, 300):
        words = [rng.choice(["é", "Word", "x" * 30, "語語"]) + str(i) for i in range(n)]
        text = " ... ".join(words) + "!"
        pieces = list(op.in_pieces("i", text, 10, 100))
        assert all(size == len(t.encode()) for _, t, size in pieces)
        cut = [ALNUM.findall(t.translate(LOWER)) for _, t, _ in pieces]
        windows = [tuple(c[i:i + 10]) for c in cut for i in range(max(1, len(c) - 9))]
        low = ALNUM.findall(text.translate(LOWER))
        assert windows == [tuple(low[i:i + 10]) for i in range(max(1, n - 9))]
        assert n < 40 or max(s for _, _, s in pieces) < 100 + 10 * 45
    assert list(op.in_pieces("i", "." * 500, 10, 100)) == []


def test_blocks_are_bounded(spark):
    items = spark.createDataFrame([(i, f"item {i} " + "word " * 40) for i in range(200)] + [(900, " ".join(f"w{i}" for i in range(5000)))], "item_id long, text string")
    found = list(op.blocks(items.repartition(7), limit=2000))
    assert len(found) > 10 and max(sum(len(t) for _, t in rows) for rows in found) < 4200
    assert {i for rows in found for i, _ in rows} == {*map(str, range(200)), "900"}
    assert list(op.blocks(items.limit(0))) == []
