import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from chronoweave.llm import toxicity
from chronoweave.llm.common import ship

SF = "/root/testdata/sf0.01"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automata_find_what_plain_distances_find():
    rng = random.Random(1)
    terms = ["scum", "idiot", "moron", "worthless", "pathetic", "réêou", "achlichst", "ab", "morons"]
    words = ["".join(rng.choice(t + "aeé") for _ in range(rng.randrange(1, 11))) for t in terms for _ in range(150)]
    for t in terms * 40:  # true misspellings
        w = list(t)
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(w) + 1)
            w[i:i + rng.randrange(2)] = rng.choice(["", "x", "é", "io"])
        words.append("".join(w))
    words = [w for w in words if w]
    texts = [" ".join(words[i:i + 7]) for i in range(0, len(words), 7)]
    for exact in (frozenset(), frozenset({"worthless", "moron"})):
        lexicon, got = toxicity.Lexicon(terms, exact), {}
        run = toxicity.Words.of(pa.array(texts))
        assert [run.text(i) for i in range(len(run.row))] == words
        for w, t, e in zip(*lexicon.hits(run)):
            got[int(w)] = (int(e), terms[int(t)])
        for i, w in enumerate(words):
            near = [(d, k) for k, t in enumerate(terms) if (d := distance(w, t)) <= (0 if t in exact else toxicity.errors_of(t))]
            assert got.get(i) == ((min(near)[0], terms[min(near)[1]]) if near else None), w


def test_words_and_places():
    texts = ["You id!ot, MORON! ÀÉ d'or «Stupid» $cum", None, "", "日本語 stupid。\nsaid \"moron\" x"]
    words = toxicity.Words.of(pa.array(texts))
    assert [words.text(i) for i in range(len(words.row))] == ["you", "id!ot", "moron", "àé", "d", "or", "stupid", "cum", "日本語", "stupid", "said", "moron", "x"]
    found = toxicity.hits_of(pa.array(texts), toxicity.Lexicon(["idiot", "moron", "stupid"]))
    assert sorted(found) == [0, 3]
    assert [(h.term, h.errors, texts[row][h.start:h.end], h.quoted, h.reported) for row in found for h in found[row]] == [
        ("idiot", 1, "id!ot", False, False), ("moron", 0, "MORON", False, False), ("stupid", 0, "Stupid", True, False),
        ("stupid", 0, "stupid", False, True), ("moron", 0, "moron", True, True)]
    assert toxicity.hits_of(pa.array(texts), toxicity.Lexicon(["idiot"]), frozenset({"id!ot"})) == {}


def test_quotation_counts_less_than_abuse():
    model = toxicity.Model(["idiot"], frozenset(), frozenset(), np.zeros(toxicity.BUCKETS), toxicity.PRIOR)
    lexicon = toxicity.Lexicon(["idiot"])
    score = [model.score(toxicity.hits_of(pa.array([t]), lexicon).get(0, [])) for t in (
        "you utter idiot go away", "they used the word \"idiot\" in a slur", "the house is green", "")]
    assert score[0] >= toxicity.THRESHOLD > 0.5 > score[1] > score[2] == score[3]


def test_held_out_labels(spark):
    got = {r["doc_id"]: r for r in toxicity.query(spark, "/root/testdata/sf0.1").collect()}
    labels = pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pylist()
    own = [(r["toxic"], got[r["doc_id"]]) for r in labels if r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
    toxic, clean = [g for t, g in own if t], [g for t, g in own if not t]
    assert sum(g["predicted"] for g in toxic) >= 0.8 * len(toxic)
    assert sum(g["predicted"] for g in clean) <= 0.02 * len(clean)
    assert all(0 <= g["score"] <= 1 and g["predicted"] == (g["score"] >= 0.7) for g in got.values())


def test_awkward_rows(spark, docs, rows, no_docs):
    ship(spark)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.scores(docs, model, hits=True).collect()
    assert len(got) == len(rows)
    # learned without the held-out fold: other labels there change nothing
    import zlib
    other = spark.createDataFrame([(i, 1, 1 - int(i % 3 == 0) if zlib.crc32(str(i).encode()) % 3 == 1 else int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    assert np.array_equal(toxicity.train(docs, other).weights, model.weights)
    none = toxicity.train(no_docs, labels)
    assert {r.score for r in toxicity.scores(docs, none).collect()} == {0.5}
    assert toxicity.scores(no_docs, model).collect() == []
