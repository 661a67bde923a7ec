import base64
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_brute import base_rules, hilbert

from chronoweave.llm import fertility, hilbert_shards, language_ecoc, quality_fm
from chronoweave.llm.common import table

SF = "/root/testdata/sf0.01"


def test_base_rules_like_brute_force(docs, rows):
    out = fertility.rules(docs)
    got = Counter(tuple(r)[:7] for r in out.collect())
    assert got == Counter((r[0], *base_rules(r[1])) for r in rows)
    assert out.where("base_failed and kept").count() == 0


def test_fertility_by_hand(spark, docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=fertility.model_path())
    text = "the cat sat on the mat and then 日本😀 left " * 3
    r = fertility.rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    ids = [i for w in text.split() for i in model.encode(w)]
    shares = [c / len(ids) for c in Counter(ids).values()]
    assert (r.n_tokens, r.script) == (len(ids), "latin")
    assert math.isclose(r.chars_per_token, sum(map(len, text.split())) / len(ids))
    assert math.isclose(r.byte_share, sum(model.is_byte(i) for i in ids) / len(ids))
    assert math.isclose(r.token_entropy, -sum(s * math.log2(s) for s in shares), abs_tol=1e-8)


def test_bands_reject_noise_and_keep_prose(spark, docs):
    rng = np.random.default_rng(1)
    prose = "The reading of that long passage went on for many more words than anyone there would have thought possible, and the people who sat in the hall began to wonder whether it would ever come to an end before the evening meal, which was to be served at eight in the garden behind the old house by the river side."
    one = " ".join(f"a{'b' * i}" for i in range(60))
    noise = " ".join("".join(chr(0x1F300 + int(c)) for c in rng.integers(0, 400, 6)) for _ in range(80))
    df = spark.createDataFrame([(1, prose), (2, noise + " and some letters"), (3, "ab " * 30 + one)], "doc_id long, text string")
    kept = {r.doc_id: (r.base_failed, r.kept) for r in fertility.rules(df).collect()}
    assert kept[1] == (False, True) and kept[2] == (False, False)


def test_bands_part_noise_from_each_language(spark, docs):
    rng = np.random.default_rng(4)
    sizes = lambda least, most: rng.integers(least, most, 200).tolist()
    letters = lambda first, last: " ".join("".join(map(chr, rng.integers(first, last + 1, n))) for n in sizes(3, 10))
    noise = [f() for _ in range(10) for f in (
        lambda: letters(97, 122), lambda: letters(65, 90), lambda: " ".join(base64.b64encode(rng.bytes(n)).decode() for n in sizes(4, 60)),
        lambda: " ".join(rng.bytes(n).hex() for n in sizes(2, 20)), lambda: letters(0x3B1, 0x3C9), lambda: letters(0x430, 0x44F),
        lambda: letters(0x5D0, 0x5EA), lambda: letters(0x627, 0x64A), lambda: letters(0x4E00, 0x9FA5), lambda: letters(0xAC00, 0xD7A3))]
    prose = [
        "Việc đọc đoạn văn dài đó kéo dài hơn nhiều so với những gì mọi người nghĩ và những người ngồi trong hội trường bắt đầu tự hỏi liệu nó có kết thúc trước bữa tối hay không",
        "Čtení toho dlouhého textu trvalo mnohem déle než si kdo myslel a lidé kteří seděli v sále se začali ptát zda vůbec skončí před večeří",
        "Η ανάγνωση αυτού του μεγάλου κειμένου συνεχίστηκε για πολλή ώρα και οι άνθρωποι που κάθονταν στην αίθουσα άρχισαν να αναρωτιούνται αν θα τελείωνε ποτέ",
        "Чтение этого длинного отрывка продолжалось гораздо дольше чем кто-либо мог подумать и люди которые сидели в зале начали спрашивать себя закончится ли оно",
        "استمرت قراءة هذا النص الطويل وقتا أطول بكثير مما كان يعتقد أي شخص وبدأ الناس الذين جلسوا في القاعة يتساءلون عما إذا كانت ستنتهي قبل العشاء"]
    texts = noise + prose
    out = fertility.rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), min_words=10).collect()
    assert not [r for r in out if r.base_failed]
    assert {r.doc_id for r in out if r.kept} == set(range(len(noise), len(texts)))
    good = table(spark, SF, "documents").join(table(spark, SF, "labels").where("quality = 1").select("doc_id"), "doc_id")
    sound = fertility.rules(good).join(good.select("doc_id", "lang"), "doc_id").where("not base_failed").collect()
    assert {r.lang for r in sound} == {"en", "fr", "de", "es"} and all(r.kept for r in sound)


def fences_by_hand(rows):
    """Limits of each (lang, script) from the sorted values of the documents that pass the base rules."""
    groups, out = {}, {}
    for r in rows:
        if not r["base_failed"]:
            groups.setdefault((r["lang"], r["script"]), []).append(r)
    for key, own in groups.items():
        for m, (_, least) in fertility.FENCED.items():
            v = sorted(math.floor(r[m] * fertility.STEPS) for r in own)
            q1, q3 = (v[math.ceil(len(v) * q / 4) - 1] / fertility.STEPS for q in (1, 3))
            out[key, m] = q1, q3, max(q3 - q1, least)
    return out


def far_out_by_hand(r, fences):
    if r["base_failed"]:
        return False
    stray, key = fertility.FAR * max(1, math.sqrt(fertility.TYPICAL_WORDS / r["n_words"])), (r["lang"], r["script"])
    (c, _, cw), (_, b, bw), (e, _, ew) = (fences[key, m] for m in ("chars_per_token_multi", "byte_share", "token_entropy"))
    return r["chars_per_token_multi"] < c - stray * cw or r["byte_share"] > b + stray * bw or r["token_entropy"] < e - stray * ew


def fixed_band_by_hand(r):
    b = fertility.BANDS[r["script"]]
    return ((r["chars_per_token"] >= b.least or r["chars_per_token_multi"] >= b.least_multi) and r["chars_per_token"] <= b.most
            and r["byte_share"] <= b.byte_share and r["token_entropy"] >= b.entropy and r["token_entropy_multi"] >= b.entropy_multi)


def test_verdict_like_brute_force(spark):
    lang = dict(table(spark, SF, "documents").select("doc_id", "lang").collect())
    rows = [r.asDict() | {"lang": lang[r.doc_id]} for r in fertility.query(spark, SF).collect()]
    fences = fences_by_hand(rows)
    for r in rows:
        assert r["outlier"] == far_out_by_hand(r, fences), r
        assert r["kept"] == (not r["base_failed"] and fixed_band_by_hand(r) and not r["outlier"]), r
    quality = dict(table(spark, SF, "labels").select("doc_id", "quality").collect())
    passed = [(quality.get(r["doc_id"]), r["kept"]) for r in rows if not r["base_failed"]]
    assert sum(q == 0 and not k for q, k in passed) > 0.5 * sum(q == 0 for q, _ in passed)
    assert sum(q == 1 and not k for q, k in passed) < 0.005 * sum(q == 1 for q, _ in passed)


def test_verdict_of_hot_copies_nulls_and_few(spark, docs):
    """A third of the rows are one text, in a language of few others: copies make the quartiles equal
    and the others stay; one text alone is never far out; a null lang is a language."""
    good = [r.text for r in table(spark, SF, "documents").join(table(spark, SF, "labels").where("quality = 1"), "doc_id")
            .where("lang = 'en'").select("text").orderBy("doc_id").limit(40).collect()]
    rows = [(i, good[0], "xx") for i in range(40)] + [(100 + i, t, "xx") for i, t in enumerate(good)] + [(200, good[1], "alone"), (None, good[2], None)] * 2
    got = fertility.rules(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)).collect()
    assert len(got) == len(rows) and not any(r.outlier for r in got)
    assert all(r.kept for r in got if not r.base_failed)


def test_rules_on_empty(no_docs):
    assert fertility.rules(no_docs).collect() == []


def test_quality_on_held_out_rows(spark):
    out = quality_fm.query(spark, SF).toPandas().merge(table(spark, SF, "labels").toPandas(), on="doc_id")
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.5)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(out.doc_id, out.held_out))
    held = out[out.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95


def test_pairs_in_linear_time_are_all_pairs():
    rng = np.random.default_rng(3)
    m = quality_fm.Machine(0.3, rng.normal(size=quality_fm.SIZE), rng.normal(size=(quality_fm.SIZE, quality_fm.RANK)))
    feature, value = np.array([3, 70, 900, 33000]), np.array([0.5, 1.0, 0.25, 2.0])
    raw, _ = m.parts(np.zeros(4, np.int64), feature, value, 1)
    pairs = sum(m.factors[feature[i]] @ m.factors[feature[j]] * value[i] * value[j] for i in range(4) for j in range(i))
    assert math.isclose(raw[0], 0.3 + m.linear[feature] @ value + pairs)


def test_quality_edge_rows(spark, docs, no_docs, rows):
    labels = spark.createDataFrame([(i, [0, 1, None][i % 3], 0) for i in range(60)] + [(7, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    none = spark.createDataFrame([], labels.schema)
    machine = quality_fm.train(docs, labels)
    out = quality_fm.scores(docs, machine)
    assert out.count() == len(rows) and out.where("score is null or score < 0 or score > 1").count() == 0
    assert quality_fm.accepted(docs, labels).columns == docs.columns
    assert quality_fm.accepted(docs, none).count() == len(rows)
    assert quality_fm.accepted(no_docs, none).collect() == []
    assert quality_fm.scores(docs.drop("n_chars"), machine).count() == len(rows)


def test_language_on_held_out_rows(spark):
    out = language_ecoc.query(spark, SF).toPandas().merge(table(spark, SF, "documents").select("doc_id", "lang").toPandas(), on="doc_id")
    held = out[out.held_out]
    assert len(held) > 200 and (held.lang_pred == held.lang).mean() > 0.97 and out.score.between(0, 1).all()


def test_language_edge_rows(docs, no_docs, rows):
    out = {r.doc_id: r for r in language_ecoc.identify(docs, language_ecoc.train(docs)).collect()}
    assert len(out) <= len(rows)
    for i in (0, 1, 2, 6, 22):  # null, empty, blank, line ends, digits
        assert (out[i].lang_pred, out[i].score) == ("und", 0.0)
    assert out[7].lang_pred in ("en", "fr") and out[16].lang_pred != "und"
    empty = language_ecoc.train(no_docs)
    assert {r.lang_pred for r in language_ecoc.identify(docs, empty).collect()} == {"und"}
    assert language_ecoc.identify(no_docs, empty).collect() == []


def language_by_hand(text, codes):
    """One text's language: features gram by gram in Python, each codeword's loss added up bit by bit."""
    folded = [b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in (text or "").encode()]
    grams = Counter(b for b in folded if b != 32)
    for n in (2, 3):
        for i in range(len(folded) - n + 1):
            gram, h = folded[i:i + n], 0
            if gram != [32] * n:
                for b in gram:
                    h = h * 257 + b
                grams[256 + (n - 2) * 4096 + ((h * 2654435761) >> 11) % 4096] += 1
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    total = sum(grams.values())
    margin = sum((math.sqrt(c / total) * codes.weights[f].astype(float) for f, c in grams.items()), codes.bias.astype(float))
    loss = [sum(math.log1p(math.exp(-m * b)) for m, b in zip(margin, word)) for word in codes.code]
    chosen = min(range(len(loss)), key=lambda i: loss[i])
    return codes.languages[chosen], 1 / sum(math.exp(loss[chosen] - v) for v in loss)


def test_languages_like_brute_force(docs, rows):
    codes = language_ecoc.train(docs)
    out = {(r.doc_id): (r.lang_pred, r.score) for r in language_ecoc.identify(docs, codes).collect() if r.doc_id is not None}
    for i, text, *_ in rows:
        if i is not None and len(text or "") < 5000:
            lang, score = language_by_hand(text, codes)
            assert out[i][0] == lang and math.isclose(out[i][1], score, rel_tol=1e-3, abs_tol=1e-4), i


def test_many_languages(spark):
    rng = np.random.default_rng(8)
    letters = [rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6, replace=False) for _ in range(200)]
    rows = [(i, " ".join("".join(rng.choice(letters[i % 200], 5)) for _ in range(30)), f"l{i % 200:03}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    codes = language_ecoc.train(docs, learned=1000)
    assert len(codes.languages) == 200
    out = language_ecoc.identify(docs, codes).toPandas()
    assert (out.sort_values("doc_id").lang_pred.to_numpy() == np.array([r[2] for r in rows])).mean() > 0.8
    few = language_ecoc.train(docs, learned=50)
    assert len(few.languages) == 50


def test_quality_like_brute_force(spark, docs, rows):
    """The score of each text with all pairs of features added one by one."""
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    machine = quality_fm.train(docs, labels)
    out = {r.row.doc_id: r.score for r in quality_fm.scores(docs, machine).collect() if r.row.doc_id is not None}
    assert len(out) > 100
    for i, text, _, _, n_chars, *_ in rows:
        if i is not None and len(text or "") < 5000:
            _, feature, value = quality_fm.features(pa.array([text], pa.string()), pa.array([n_chars], pa.float64()))
            raw = machine.bias + sum(machine.linear[f] * v for f, v in zip(feature, value))
            weighted = machine.factors[feature] * value[:, None]
            raw += np.triu(weighted @ weighted.T, 1).sum()
            assert math.isclose(out[i], 1 / (1 + math.exp(-max(-30, min(30, raw)))), rel_tol=1e-6), i


def test_codewords_correct_errors():
    for n in (2, 3, 4, 6, 9, 30):
        code = language_ecoc.codewords(n)
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= max(1, code.shape[1] // 4)
    code = language_ecoc.codewords(6)
    codes = language_ecoc.Codes(list("abcdef"), code, np.zeros((1, code.shape[1])), np.zeros(code.shape[1]))
    for i in range(6):  # a flipped bit still decodes
        bits = code[i].copy()
        bits[3] *= -1
        codes.bias = 2 * bits
        assert codes.losses(np.zeros((1, 1))).argmin() == i


def cells(r):
    size = len((r[1] or "").encode()) + 8
    cat = [zlib.crc32(v.encode()) >> 26 if v is not None else 0 for v in (r[2], r[3])]
    return size, zlib.crc32((r[1] or "").encode()), hilbert([*cat, math.floor(math.log2(size) * 2)], 6)


@pytest.mark.parametrize("per_partition", [10, 1_000_000])
def test_shards_like_brute_force(docs, rows, per_partition):
    order = sorted(((h, c, -1 if r[0] is None else r[0], s) for r in rows for s, c, h in [cells(r)]))
    n = len(order)
    expected = sorted((None if i < 0 else i, s, c, "rows", place * 24 // n, place - -(-(place * 24 // n) * n // 24), None, h) for place, (h, c, i, s) in enumerate(order))\
        if all(r[0] is not None for r in rows) else \
        sorted(((None if i < 0 else i, s, c, "rows", place * 24 // n, place - -(-(place * 24 // n) * n // 24), None, h) for place, (h, c, i, s) in enumerate(order)), key=str)
    assert sorted((tuple(r) for r in hilbert_shards.shards(docs, 24, per_partition).collect()), key=str) == sorted(expected, key=str)


def test_curve_is_a_walk(spark):
    from pyspark.sql import functions as F

    cube = spark.range(8 ** 3).select(*[(F.shiftright("id", 3 * i).bitwiseAND(7)).cast("int").alias(n) for i, n in enumerate("abc")])
    walk = sorted((r.h, (r.a, r.b, r.c)) for r in cube.select("a", "b", "c", hilbert_shards.hilbert_index("a", "b", "c", 3).alias("h")).collect())
    assert [h for h, _ in walk] == list(range(512))
    assert all(sum(abs(x - y) for x, y in zip(p, q)) == 1 for (_, p), (_, q) in zip(walk, walk[1:]))


def test_shards_empty_and_few(no_docs, docs):
    assert hilbert_shards.shards(no_docs).collect() == []
    few = hilbert_shards.shards(docs.where("doc_id < 5")).collect()
    assert len(few) == 5 and all(r.slot == 0 for r in few)


def test_long_texts_have_cells_of_their_own(spark):
    sizes = [8, 46_340, 46_341, 100_000, 1 << 20, 50 << 20, 1 << 30, (1 << 31) + 8]
    cells = [r.c for r in spark.createDataFrame([(s,) for s in sizes], "size long").select(hilbert_shards.size_cell(hilbert_shards.F.col("size")).alias("c")).collect()]
    assert len(set(cells[1:])) == len(cells) - 1 and max(cells) < 1 << hilbert_shards.BITS


def test_filters_touch_few_shards(spark):
    docs = table(spark, SF, "documents")
    shards = docs.select("doc_id", "lang", "source").join(hilbert_shards.shards(docs), "doc_id").toPandas()
    assert len(shards) == docs.count() and shards.shard.nunique() == 24
    by_source, by_lang = shards.groupby("source").shard.nunique(), shards.groupby("lang").shard.nunique()
    both, longest = shards.groupby(["source", "lang"]).shard.nunique(), shards[shards["size"] > shards["size"].quantile(0.95)].shard.nunique()
    # 24 shards; English is 62 % of the rows, a source 5 %
    assert by_source.max() <= 8 and by_lang.drop("en").max() <= 8 and both.max() <= 6 and longest <= 13
