import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from llm_brute import best_pieces

from chronoweave.llm import piece_codec, token_counts
from chronoweave.llm.token_counts import MARK, model_path


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=model_path())


def test_counts_are_the_library_s(docs, rows, library):
    expected = sorted(((r[0], len((r[1] or "").encode()), n, n > 4096) for r in rows for n in [len(library.encode(r[1] or ""))]), key=str)
    assert sorted((tuple(r) for r in token_counts.token_counts(docs).collect()), key=str) == expected


def test_proven_words_are_single_tokens(library):
    proven = token_counts.WordCounter(model_path()).proven
    assert len(proven) > 10_000
    assert all(len(ids) == 1 for ids in library.encode(sorted(proven)[::37]))


def test_empty(no_docs):
    assert token_counts.token_counts(no_docs).collect() == []
    assert piece_codec.summary(no_docs).collect() == []
    assert piece_codec.decode(piece_codec.encode(no_docs)).collect() == []


def test_pieces_are_the_best_segmentation(rows):
    codec = piece_codec.PieceCodec(model_path())
    pieces = {"".join(map(chr, c[c > 0])): (int(i), s) for c, i, s in zip(codec.chars, codec.ids, codec.scores)}
    texts = [r[1] for r in rows if len(r[1] or "") < 3000] + ["x" * 900, "日本😀語" * 150, "abc  " * 9 + "q" * 400, "\n\n  \nfoo"]
    ids, per_row = codec.encode(pa.array(texts, pa.string()))
    at = np.concatenate([[0], np.cumsum(per_row)])
    for i, t in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == best_pieces(codec, pieces, t)
    again, _ = codec.encode(pa.array(texts, pa.string()))
    assert (again == ids).all()


def test_round_trip(docs, rows):
    encoded = piece_codec.encode(docs)
    back = sorted(((r.doc_id, r.text) for r in piece_codec.decode(encoded).collect()), key=str)
    assert back == sorted(((r[0], (r[1] or "").replace(MARK, " ")) for r in rows), key=str)
    assert {r.roundtrip for r in encoded.collect() if MARK not in (r.text or "")} == {True}
    assert {(r.doc_id, r.n_pieces) for r in piece_codec.summary(docs).collect()} == {(r.doc_id, len(r.piece_ids)) for r in encoded.collect()}
    last = piece_codec.stage(docs)
    assert last.count() == len(rows) and last.where("n_pieces <> size(piece_ids)").count() == 0


@pytest.mark.parametrize("rule", ["merges", "links"])
def test_pieces_are_the_library_s(docs, rows, library, rule):
    rng = np.random.default_rng(2)
    texts = [r[1] for r in rows] + ["x" * 900, "日本😀語" * 150, "abc  " * 9 + "q" * 400, "\n\n  \nfoo", "a" + MARK + "b", "\t\x01 \r\n é", "ab" * 300 + " " * 300]
    texts += ["".join(rng.choice(list("aab eionst\nzé語"), 300)) for _ in range(40)]
    texts += ["".join(map(chr, rng.integers(33, 0x3000, 400))) for _ in range(5)] + ["".join(rng.choice(list("abeionst"), 600)) for _ in range(5)]
    ids, per_row = piece_codec.PieceCodec(model_path(), rule).encode(pa.array(texts, pa.string()))
    at = np.concatenate([[0], np.cumsum(per_row)])
    for i, t in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == library.encode(t or "")
    encoded = piece_codec.encode(docs, rule=rule).collect()
    assert all(r.piece_ids == library.encode(r.text or "") for r in encoded)
    if rule != "links":
        return
    counted = token_counts.token_counts(docs).collect()
    assert sorted(((r.doc_id, r.n_pieces) for r in piece_codec.summary(docs).collect()), key=str) == sorted(((r.doc_id, r.n_tokens) for r in counted), key=str)


def test_forgotten_links_change_nothing(rows, library, monkeypatch):
    monkeypatch.setattr(piece_codec, "PAIRS", 64)
    texts = [r[1] for r in rows if r[1] and len(r[1]) < 3000][:60]
    ids, per_row = piece_codec.PieceCodec(model_path(), "links").encode(pa.array(texts, pa.string()))
    assert ids.tolist() == [i for t in texts for i in library.encode(t)]
