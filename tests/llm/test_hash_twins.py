"""Two different words whose plain sums of powers modulo 2^64 are equal whatever the radix."""

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from chronoweave.llm import circulant_minhash, decontaminate, fertility, piece_codec
from chronoweave.llm.common import prefix_hash, range_hash, ship
from chronoweave.llm.textstats import Words
from chronoweave.llm.token_counts import model_path


def twins(n):
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_hashes_differ(n):
    a, b = twins(n)
    data = np.frombuffer((a + " " + b).encode(), np.uint8)
    start, end = np.array([0, n + 1]), np.array([n, 2 * n + 1])
    plain = range_hash(prefix_hash(data), start, end)
    assert plain[0] == plain[1]
    sound = range_hash(prefix_hash(data), start, end, data)
    assert sound[0] != sound[1]


def test_operators_tell_them_apart(spark):
    ship(spark)
    a, b = twins(2048)
    docs = spark.createDataFrame([(0, f"x {a} y"), (1, f"x {b} y"), (2, a), (3, b)], "doc_id long, text string").coalesce(1)
    assert {(r.doc_id, r.component_id) for r in circulant_minhash.groups(docs, 3, 85).collect()} == {(i, i) for i in range(4)}
    items = spark.createDataFrame([(7, a)], "item_id long, text string")
    assert {r.doc_id: (r.n_hit, r.contaminated) for r in decontaminate.report(docs, items).collect()} == {0: (1, True), 1: (0, False), 2: (1, True), 3: (0, False)}
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    encoded = piece_codec.encode(docs).collect()
    assert all(r.roundtrip and r.piece_ids == library.encode(r.text) for r in encoded)
    words = Words.of(pa.array([f"{a}\n{b}", f"p q {a} p q {b}"]))
    assert words.lines()[1].tolist() == [0, 0] and words.repeat_words().tolist() == [0, 0]
    got = {r.doc_id: r.n_tokens for r in fertility.rules(docs).collect()}
    assert got == {r.doc_id: len(library.encode(r.text.split())) and sum(map(len, library.encode(r.text.split()))) for r in docs.collect()}


def test_long_words_are_the_library_s(spark):
    import base64

    import public_tokenizers
    import tiktoken

    with open(model_path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    word = "".join(chr(97 + (i * i) % 23) for i in range(800))
    ship(spark)
    got = fertility.rules(spark.createDataFrame([(1, f"a {word}")], "doc_id long, text string")).first()
    assert got.n_tokens_multi == sum(len(library.encode_ordinary(" " + w)) for w in ("a", word))
