import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chronoweave.llm import token_align
from chronoweave.llm.common import ship
from chronoweave.llm.token_counts import model_path


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(model_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=model_path())


def plain(texts, libraries):
    """(n_a, n_b, groups, links) of each text, by the sets of ends."""
    lib_a, lib_b = libraries
    bytes_a = token_align.byte_level_tokens(model_path("byte_bpe_50k.json"))
    bytes_b = token_align.piece_tokens(model_path())
    out = []
    for t in texts:
        a = lib_a.encode(" " + (t or ""), add_special_tokens=False).ids
        b = lib_b.encode(t or "")
        wanted = (" " + (t or "")).encode()
        if not t or b"".join(bytes_a[i] for i in a) != wanted or b"".join(bytes_b[i] for i in b) != wanted:
            out.append((0, 0, "", []))
            continue
        end_a, end_b, at = {}, {}, 0
        for k, i in enumerate(a):
            end_a[at := at + len(bytes_a[i])] = k
        at = 0
        for k, i in enumerate(b):
            end_b[at := at + len(bytes_b[i])] = k
        shared = sorted(end_a.keys() & end_b.keys())
        groups, x, y = [], 0, 0
        for e in shared:
            groups.append(",".join(map(str, a[x:end_a[e] + 1])) + "|" + ",".join(map(str, b[y:end_b[e] + 1])))
            x, y = end_a[e] + 1, end_b[e] + 1
        out.append((len(a), len(b), ";".join(groups), [(a[end_a[e]], b[end_b[e]]) for e in shared]))
    return out


def brute(ids, texts, libraries):
    found = plain(texts, libraries)
    count = Counter(p for *_, links in found for p in links)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return sorted(((i, na, nb, len(links), len(links), hashlib.sha256(groups.encode()).hexdigest() if na else "",
                    sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links))
                   for i, (na, nb, groups, links) in zip(ids, found)), key=str)


def summary(docs):
    a = token_align.alignments(docs)
    linked = a.select("row.doc_id", "n_a", "n_b", "n_groups", F.size("links").cast("long").alias("n_links"),
                      F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"), "links")
    bytes_b = token_align.piece_tokens(model_path())
    pairs = token_align.PairTable.of(token_align.pair_counts(linked), token_align.pair_bound(
        token_align.byte_level_tokens(model_path("byte_bpe_50k.json")), bytes_b), len(bytes_b))
    return sorted((tuple(r) for r in token_align.scored(linked, pairs).collect()), key=str)


def test_rows_are_the_brute_force_ones(docs, rows, libraries):
    assert summary(docs) == brute([r[0] for r in rows], [r[1] for r in rows], libraries)


def test_query(spark, libraries):
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.001"
    d = pq.read_table(f"{sf}/documents.parquet")
    got = token_align.query(spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(d["doc_id"].to_pylist(), d["text"].to_pylist(), libraries)


def test_ids_are_both_libraries_ids(libraries):
    """A's ids come from its ranks in the other library: held against its own, over odd characters."""
    rng = random.Random(4)
    odd = [chr(c) for a, b in ((0, 0x3000), (0xA640, 0xA700), (0xFB00, 0x10000), (0x1F300, 0x1F700), (0x10400, 0x10450)) for c in range(a, b) if not 0xD800 <= c < 0xE000]
    texts = ["".join(rng.choice(odd if rng.random() < 0.5 else list(" \n\tab'sll1.")) for _ in range(60)) for _ in range(1500)]
    texts += ["<|endoftext|> x<|endoftext|>", "<s>a</s><unk>", "  two  spaces ", "x" * 5000, "it's we'll 'RE", "▁"]
    aligner = token_align.Aligner(model_path("byte_bpe_50k.json"), model_path())
    got = aligner.of(texts)
    said = got.text().to_pylist()
    for i, (na, nb, groups, links) in enumerate(plain(texts, libraries)):
        assert (got.n_a[i], got.n_b[i], said[i]) == (na, nb, groups), repr(texts[i])
        assert got.links[got.links_at[i]:got.links_at[i + 1]].tolist() == [aligner.code(*p) for p in links]


def test_forgetting_windows_changes_nothing(monkeypatch):
    texts = [f"word{i} of{i} it" for i in range(50)] * 2
    once = token_align.Aligner(model_path("byte_bpe_50k.json"), model_path()).of(texts).text().to_pylist()
    monkeypatch.setattr(token_align, "REMEMBERED", 10)
    aligner = token_align.Aligner(model_path("byte_bpe_50k.json"), model_path())
    assert [aligner.of([t]).text()[0].as_py() for t in texts] == once


def test_the_bound_holds_and_is_enforced(spark):
    assert token_align.pair_bound([b"a", b" a", b"ab"], [b"a", b"b", b" a"]) == 5
    ship(spark)
    counts = spark.createDataFrame([(1, 1), (2, 1)], "pair int, n long")
    with pytest.raises(ValueError):
        token_align.PairTable.of(counts, 1, 3)


def test_empty(no_docs):
    assert token_align.alignments(no_docs).collect() == []
    assert summary(no_docs) == []
