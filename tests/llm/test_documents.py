"""Operators 3, 5, 6, 7, 9, 10 and the pipeline."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import fm_dedup, gray_simhash, kneser_ney, language_crf, noisy_toxicity, pairwise_quality, word_hashes
from plumbline.llm import labelled as labelled_sample
from plumbline.llm.common import rows_numbered
from plumbline.session import stored

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def without_repeats(rows):
    seen, out = set(), {}
    for doc_id, text in rows:
        words = SPLIT.findall(text)
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i:i + 20])
            if window in seen:
                gone[i:i + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[doc_id] = len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()
    return out


@pytest.mark.parametrize("variants", [5000, 2])
def test_op5_equals_brute_force(shared, folder, documents, monkeypatch, variants):
    monkeypatch.setattr(fm_dedup, "VARIANTS", variants)  # 2: anchors are cut into single windows
    monkeypatch.setattr(fm_dedup, "SHARD_WORDS", 5000)
    got = {r["doc_id"]: tuple(r)[1:] for r in fm_dedup.op5_fm_dedup(shared, folder).collect()}
    assert got == without_repeats([(d, t) for d, t, _ in documents])


def test_wavelet_ranks_equal_counting():
    rng = np.random.default_rng(0)
    text = rng.integers(0, 11, 500)
    index = fm_dedup.WaveletMatrix(text, 11)
    symbol, low = rng.integers(0, 11, 200), rng.integers(0, 501, 200)
    high = np.array([rng.integers(a, 501) for a in low])
    less, more = index.ranks(symbol, low, high)
    assert less.tolist() == [(text[:a] == s).sum() for s, a in zip(symbol, low)]
    assert more.tolist() == [(text[:b] == s).sum() for s, b in zip(symbol, high)]


@pytest.mark.parametrize("words", [600_000, 1000])  # 1000: a long periodic text is cut into single windows
def test_op5_odd_rows(odd, monkeypatch, words):
    monkeypatch.setattr(fm_dedup, "SHARD_WORDS", words)
    rows = {(r["row"]["doc_id"], r["n_words"], r["n_removed"]) for r in fm_dedup.removed(odd).collect()}
    assert {(1, 22, 0), (1, 22, 22), (None, 30, 29), (5, 30000, 29999), (8, 0, 0), (9, 1, 0)} <= rows
    assert fm_dedup.removed(odd.where("false")).count() == 0


def test_op5_tells_words_with_equal_low_bits_apart(shared):
    words = [f"w{i}" for i in range(300_000)]
    low = word_hashes.hashed(pa.array([" ".join(words)]))[0] & np.uint64(0xFFFFFFFF)
    order = np.argsort(low, kind="stable")
    alike = np.flatnonzero(low[order][1:] == low[order][:-1])
    pairs = [(words[order[i]], words[order[i + 1]]) for i in alike[:3]]
    assert pairs
    texts = [f"{word} " + " ".join(f"{k}x{n}" for n in range(19)) for k, pair in enumerate(pairs * 7) for word in pair]
    docs = shared.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert fm_dedup.removed(docs).agg(F.sum("n_removed")).first()[0] == 0


@pytest.fixture
def moving(shared, documents, tmp_path, monkeypatch):
    """Documents in files that are split in another way after each step that is stored."""
    path, steps = f"{tmp_path}/documents.parquet", []
    shared.createDataFrame([d[:2] for d in documents], "doc_id bigint, text string").repartition(7).write.option(
        "parquet.block.size", 4096).parquet(path)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: shared.conf.get(n) for n in names}

    def then(keep):
        def run(*args):
            out = keep(*args)
            steps.append(1)
            for name, size in zip(names, (("3k", "1"), ("128m", "4m"), ("40k", "1k"))[len(steps) % 3]):
                shared.conf.set(name, size)
            return out
        return run

    monkeypatch.setattr(fm_dedup, "stored", then(fm_dedup.stored))
    monkeypatch.setattr(gray_simhash, "cut_lineage", then(gray_simhash.cut_lineage))
    yield shared.read.parquet(path)
    for name in names:
        shared.conf.set(name, before[name])


def test_op5_does_not_depend_on_file_splits(moving, documents):
    got = {r["row"]["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept_words"]).hexdigest())
           for r in fm_dedup.removed(moving).collect()}
    assert got == without_repeats([(d, t) for d, t, _ in documents])


def test_one_of_each_does_not_depend_on_file_splits(moving):
    want = gray_simhash.near_duplicates(moving).where(F.col("doc_id") == F.col("component_id")).collect()
    got = gray_simhash.one_of_each(moving)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r["doc_id"] for r in want)


def test_rows_are_numbered_once(shared, odd):
    for rows in (odd, odd.where("false"), odd.unionByName(odd), odd.crossJoin(shared.range(3)),
                 shared.createDataFrame([(1,), (1,)], "doc_id bigint"), odd.where(F.rand() < 0.5)):
        got = rows_numbered(rows)
        numbers = [r["_row"] for r in got.collect()]
        assert got.columns == [*rows.columns, "_row"] and len(set(numbers)) == len(numbers)
        assert sorted(numbers) == sorted(r["_row"] for r in got.collect())


def slow_fingerprint(text):
    words = SPLIT.findall(lower(text))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_op6_equals_brute_force(shared, folder, documents):
    prints = {d: slow_fingerprint(t) for d, t, _ in documents}
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r["doc_id"]: tuple(r)[1:] for r in gray_simhash.op6_gray_simhash(shared, folder).collect()}
    assert got == {d: (f"{p:016x}", find(d)) for d, p in prints.items()}


@pytest.mark.parametrize("group_rows", [100_000, 20])
def test_links_of_dense_groups(shared, group_rows, monkeypatch):
    monkeypatch.setattr(gray_simhash, "GROUP_ROWS", group_rows)  # 20: groups are cut by further blocks
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2 ** 63, 6)
    codes = sorted({int(c) ^ sum(1 << int(b) for b in rng.integers(0, 63, rng.integers(0, 5))) for c in np.repeat(base, 60)})
    edges = gray_simhash.links(shared.createDataFrame([(c,) for c in codes], "fp bigint")).collect()
    assert all((r["a"] ^ r["b"]) >= 0 for r in edges)

    def classes(pairs):
        root = {c: c for c in codes}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        return [find(c) for c in codes]

    near = [(a, b) for a in codes for b in codes if a < b and (a ^ b).bit_count() <= 2]
    assert classes((r["a"], r["b"]) for r in edges) == classes(near)


def test_op6_odd_rows(odd):
    rows = [tuple(r) for r in gray_simhash.near_duplicates(odd).collect()]
    assert len(rows) == odd.count()
    assert {r[2] for r in rows if r[1] == "0" * 16} == {3}
    assert gray_simhash.one_of_each(odd).columns == odd.columns
    assert gray_simhash.near_duplicates(odd.where("false")).count() == 0


def kneser_ney_by_hand(rows):
    """rows: (held out, words). The same formulas on dictionaries."""
    uni, pair = Counter(), Counter()
    for held, words in rows:
        if not held:
            tokens = [*words, "\0end"]
            uni.update(tokens)
            pair.update(zip(["\0end", *tokens], tokens))
    n, v = sum(uni.values()), len(uni)
    before, context, kinds = Counter(w for _, w in pair), Counter(), defaultdict(lambda: [0] * 4)
    for (a, _), c in pair.items():
        context[a] += c
        kinds[a][min(c, 3)] += 1

    def discount(counts):
        of = Counter(counts)
        return kneser_ney.discounts([of[i] for i in (1, 2, 3, 4)])

    d2, d1, total = discount(pair.values()), discount(before.values()), sum(before.values())
    rest = sum(d1[min(c, 3)] for c in before.values()) / total

    def alone(w):
        return (before[w] - d1[min(before[w], 3)]) / total + rest / (v + 1)

    def chance(a, w):
        if not context[a]:
            return alone(w)
        c = pair[a, w]
        return (c - d2[min(c, 3)] + sum(d2[i] * kinds[a][i] for i in (1, 2, 3)) * alone(w)) / context[a]

    assert sum(chance("the", w) for w in uni) + chance("the", "\0unknown") == pytest.approx(1)
    for _, words in rows:
        tokens = [*words, "\0end"]
        yield (len(tokens), sum(t in uni for t in tokens), n, sum(math.log10((uni[t] + 1) / (n + v + 1)) for t in tokens),
               sum(math.log10(chance(a, w)) for a, w in zip(["\0end", *tokens], tokens)))


def test_op9_equals_formulas(shared, folder, documents, monkeypatch):
    monkeypatch.setattr(kneser_ney, "SHARD_CHARS", 1 << 16)
    rows = [(zlib.crc32(str(d).encode()) % 7 == 2, SPLIT.findall(lower(t))) for d, t, _ in documents]
    got = sorted(kneser_ney.op9_kneser_ney(shared, folder).collect(), key=lambda r: r["doc_id"])
    for r, want in zip(got, kneser_ney_by_hand(rows), strict=True):
        assert tuple(r)[2:7] == pytest.approx(want, abs=1e-6)


def test_op9_frequent_word_has_several_cells(shared, monkeypatch):
    monkeypatch.setattr(kneser_ney, "SHARD_CHARS", 1 << 11)
    texts = [" ".join(f"the {w}{i * 7 % 53}x the {w}" for w in range(i, i + 40)) for i in range(60)]
    docs = shared.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    model = kneser_ney.fit(docs)
    assert model["cells"].parts.max() > 2 and len(model["stored"]) > len(model["starts"])
    got = sorted(kneser_ney.score(docs, model).collect(), key=lambda r: r["doc_id"])
    for r, want in zip(got, kneser_ney_by_hand([(False, t.split()) for t in texts]), strict=True):
        assert (r["n_tokens"], r["n_known"], r["base_score"], r["score"]) == pytest.approx((*want[:2], *want[3:]), abs=1e-6)


def test_hashes_of_words_equal_those_of_single_words():
    texts = ["a Bc\tdefghijk  ", None, "", "Bc", "é\x0e x\x0b" + "y" * 300 + " " + "z" * 256, "12345678 123456789 \x00 a\x00"]
    for texts in (texts, texts[2:]):
        for lower_case in (False, True):
            words = [[w.lower() if lower_case else w for w in (t or "").encode().split()] for t in texts]
            found, sizes = word_hashes.hashed(pa.array(texts), lower_case)
            assert sizes.tolist() == [len(w) for w in words]
            flat = [w for ws in words for w in ws]
            alone = [int(word_hashes.hashed(pa.array([w.decode()]))[0][0]) for w in flat]
            assert found.tolist() == alone and len(set(alone)) == len(set(flat))


def test_op9_odd_rows(odd):
    rows = kneser_ney.score(odd, kneser_ney.fit(odd)).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    rows = kneser_ney.score(odd, kneser_ney.fit(odd.where("false"))).collect()
    assert {r["score"] for r in rows} == {0.0}


def test_op3_held_out(shared, folder, documents):
    lang = {d: x for d, _, x in documents}
    got = language_crf.op3_language_crf(shared, folder).collect()
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) >= 0.95


def test_samples_are_the_ids_of_least_hash_one_text_each(shared):
    ids = shared.range(2000).selectExpr("id as doc_id", "case when id % 10 < 8 then 'a' else 'b' end as lang")
    first = ids.repartition(37).withColumn("h", F.xxhash64("doc_id")).orderBy("h").collect()
    want = {lang: {r["doc_id"] for r in [r for r in first if r["lang"] == lang][:20]} for lang in "ab"}
    got = labelled_sample.drawn(ids.repartition(37), "lang", 20).collect()
    assert len(got) == 40 and all({r["doc_id"] for r in got if r["lang"] == lang} == want[lang] for lang in "ab")
    docs = shared.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, None), (3, "x")], "doc_id long, text string")
    labels = shared.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    rows, counts = labelled_sample.sample(docs, labels, "quality", 5)
    assert {tuple(r) for r in rows.select("doc_id", "_label", "text").collect()} == {(1, 1, "text 0"), (2, 0, None)}
    assert counts == {0: 1, 1: 1}


def test_op3_labels_words_of_switched_text(shared, folder):
    docs = shared.read.parquet(f"{folder}/documents.parquet")
    model = language_crf.learn(docs)
    mixed = shared.createDataFrame([(1, "the thing that was there and then der die und nicht mit einer heit")],
                                   "doc_id bigint, text string")
    row = language_crf.words_labelled(mixed, model).first()
    assert row["langs"][:5] == ["en"] * 5 and row["langs"][-5:] == ["de"] * 5


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    shine, first, across = rng.random((4, 3)) + 0.1, rng.random(3) + 0.1, rng.random((3, 3)) + 0.1
    want = np.zeros((4, 3))
    for path in np.ndindex(3, 3, 3, 3):
        p = first[path[0]] * np.prod([shine[t, k] for t, k in enumerate(path)]) * np.prod(
            [across[a, b] for a, b in zip(path, path[1:])])
        for t, k in enumerate(path):
            want[t, k] += p
    got = language_crf.forward_backward(language_crf.Packed(np.array([4])), shine, first, across)
    assert np.allclose(got, want / want.sum(1, keepdims=True))


def test_op3_odd_rows(odd):
    rows = language_crf.identified(odd, language_crf.learn(odd)).collect()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (3, 4, 7, 8)} == {"und"}
    assert {r["lang_pred"] for r in language_crf.identified(odd, None).collect()} == {"und"}


def labelled(shared, folder, name):
    return {r["doc_id"]: r[name] for r in shared.read.parquet(f"{folder}/labels.parquet").collect()}


def test_op7_held_out(shared):
    folder = "/root/testdata/sf0.01"
    label = labelled(shared, folder, "quality")
    got = [r for r in pairwise_quality.op7_pairwise_quality(shared, folder).collect() if r["held_out"] and r["doc_id"] in label]
    assert np.mean([r["predicted"] == label[r["doc_id"]] for r in got]) >= 0.9


def test_op7_learns_from_every_labelled_row(shared, monkeypatch):
    monkeypatch.setattr(pairwise_quality, "PAIRS", 1)
    rows = shared.createDataFrame([(i, int(i % 5 == 0), [float(i)]) for i in range(10_000)], "doc_id long, _label int, x array<double>")
    pairs = pairwise_quality.paired(rows, {0: 8000, 1: 2000}).collect()
    assert len(pairs) == 8000 and {r.good[0] for r in pairs} | {r.bad[0] for r in pairs} == set(map(float, range(10_000)))
    for values, k in (([3.0, 1.0, 2.0, 8.0, 5.0], 3), ([1.0] * 9 + [2.0], 4), ([1.0, 1.0, 4.0], 2), (list(map(float, range(9000))), 7000)):
        own = shared.createDataFrame([([v],) for v in values], "x array<double>")
        want = sum(sorted(values)[k - 1:k + 1]) / 2
        assert pairwise_quality.quantile(own, lambda part: pairwise_quality.matrix(part.column("x"))[:, 0], k) == pytest.approx(want)


def test_op10_held_out(shared):
    folder = "/root/testdata/sf0.01"
    label = labelled(shared, folder, "toxic")
    got = [r for r in noisy_toxicity.op10_noisy_toxicity(shared, folder).collect() if r["held_out"] and r["doc_id"] in label]
    assert np.mean([r["predicted"] == label[r["doc_id"]] for r in got]) >= 0.9
    assert not any(r["predicted"] for r in got if label[r["doc_id"]] == 0)


def test_toxicity_is_learned_from_every_labelled_row(shared):
    """A word of few toxic rows among very many labelled ones gets a weight; half of them would not do."""
    rows = [(i, f"the day was good {i % 7}" if i % 2 else f"you idiot number {i % 5}") for i in range(12000)]
    rows += [(12000 + i, "that zorblax again") for i in range(22)]
    docs = shared.createDataFrame(rows, "doc_id bigint, text string")
    labels = shared.createDataFrame([(i, 1 - i % 2 if i < 12000 else 1) for i, _ in rows], "doc_id bigint, toxic int")
    model = noisy_toxicity.learn(docs, labels)
    assert {"idiot", "zorblax"} <= set(model["words"])
    score = noisy_toxicity.scorer(model)
    assert score("that zorblax again") > 0.5 and score("you i d i o t number") > 0.5 and score("the day was good") < 0.5


def test_texts_without_a_label_are_not_shuffled(shared):
    """A field of bits leaves few others before the join; a crowded one, or ids of unlike types, lose no row."""
    docs = shared.createDataFrame([(i if i % 9 else None, f"{i % 5} {i}") for i in range(4000)] * 2, "doc_id bigint, text string")
    known = shared.createDataFrame([(i, i % 2) for i in range(1, 9000, 90)], "doc_id bigint, _label int")
    want = sorted((i, i % 2, f"{i % 5} {i}") for i in range(1, 4000, 90) if i % 9)
    assert len(want) <= labelled_sample.maybe(docs, known).count() / 2 <= len(want) + 10
    assert sorted(map(tuple, labelled_sample.texts_of(docs, known).collect())) == want
    assert labelled_sample.maybe(docs, known, 1).join(known, "doc_id").count() == 2 * len(want)
    unlike = known.withColumn("doc_id", F.col("doc_id").cast("int"))
    assert sorted(map(tuple, labelled_sample.texts_of(docs, unlike).collect())) == want
    assert labelled_sample.maybe(docs, known.where("false")).count() == 0


def test_the_cut_leaves_fewest_rows_on_the_wrong_side(shared):
    rows = shared.createDataFrame([(1, ["a", "b"]), (1, ["b"]), (1, ["a"]), (0, ["a"]), (0, ["a"]), (0, [])],
                                  "label int, words array<string>")
    assert noisy_toxicity.best_cut(rows, {"a": 1.0, "b": 2.0}) == 1.5
    assert noisy_toxicity.best_cut(rows, {}) == 1.0


def test_disguised_words_are_restored(odd):
    words = "idiot moron scum clown trash the there that hello letter will".split() * 5
    text = "  " + "  ".join(words) + "  "
    code = noisy_toxicity.TABLE[[ord(c) for c in text]]
    counts = np.bincount((code[:-2] * 64 + code[1:-1]) * 64 + code[2:], minlength=64 ** 3).astype(float)
    model = noisy_toxicity.CharModel(counts)
    assert [model.decode(w) for w in ("1d10t", "iiidiooot", "s.c.u.m", "letter", "tr@$h")] == [
        "idiot", "idiot", "scum", "letter", "trash"]
    score = noisy_toxicity.scorer({"counts": counts, "words": {"idiot": 5.0, "scum": 5.0}, "bias": -2.5})
    assert all(score(t) > 0.9 for t in ("an 1d10t", "i d i o t", "you s c u m !", "S.C.U.M.", "idiooot", "idiot!"))
    assert all(score(t) < 0.1 for t in ("hello there", None, "", "a b c d"))


def test_scoring_equals_scoring_of_all_restored_words(shared):
    words = "stupid moron scum clown idiot the there that hello letter will".split()
    text = "  " + "  ".join(words * 5) + "  "
    code = noisy_toxicity.TABLE[[ord(c) for c in text]]
    counts = np.bincount((code[:-2] * 64 + code[1:-1]) * 64 + code[2:], minlength=64 ** 3).astype(float)
    texts = ["st!upid", "mo+ron", "sc|um", "c£own", "!diot", "a st!u.pid mo+ron", "c1own", "(clown)", "hello th3re 455",
             "l3tter clovvn sc um"]
    rng = np.random.default_rng(0)
    for word in words * 8:
        odd = [*word]
        for at in rng.integers(0, len(odd) + 1, 2):
            odd.insert(at, str(rng.choice([*noisy_toxicity.LOOKS, ".", "-"])))
        texts.append("".join(odd))
    model = {"counts": counts, "words": dict.fromkeys(words[:5], 5.0), "bias": -2.5}
    score = noisy_toxicity.scorer(model)
    assert all(score(t) > 0.9 for t in texts[:6])
    docs = shared.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in noisy_toxicity.restore(docs, counts, {}).collect():
        z = sum(model["words"].get(w, 0) for w in set(r["restored"].split())) + model["bias"]
        assert score(texts[r["doc_id"]]) == pytest.approx(1 / (1 + math.exp(-z)))


def test_spaced_letters_are_decoded_when_scoring(shared):
    words = "kill hell fool idiot a you are the look skill shell killer that hello letter will of at".split()
    text = "  " + "  ".join(words * 5) + "  "
    code = noisy_toxicity.TABLE[[ord(c) for c in text]]
    counts = np.bincount((code[:-2] * 64 + code[1:-1]) * 64 + code[2:], minlength=64 ** 3).astype(float)
    vocabulary = {w: math.log(1 / len(words)) for w in words}
    model = {"counts": counts, "vocabulary": vocabulary, "words": dict.fromkeys(words[:4], 5.0), "bias": -2.5}
    toxic = ["k i l l", "h e l l", "f o o l", "a i d i o t", "y o u i d i o t", "y o u a r e a f o o l", "k i l l l o o k",
             "y o u 1 d ! 0 t", "k 1 l l t h a t"]
    clean = ["s k i l l", "s h e l l", "k i l l e r", "l o o k a t t h e s h e l l", "a b c d", "h e l l o"]
    own = noisy_toxicity.scorer(model)
    assert [own(t) > 0.9 for t in toxic] == [True] * len(toxic)
    assert [own(t) < 0.1 for t in clean] == [True] * len(clean)
    docs = shared.createDataFrame(list(enumerate([*toxic, *clean])), "doc_id bigint, text string")
    for r in noisy_toxicity.restore(docs, counts, vocabulary).collect():
        z = sum(model["words"].get(w, 0) for w in set(r["restored"].split())) + model["bias"]
        assert own([*toxic, *clean][r["doc_id"]]) == pytest.approx(1 / (1 + math.exp(-z)))


def test_scores_of_odd_rows(shared, odd):
    labels = shared.createDataFrame([(1, 1, 0), (3, 0, 0), (6, None, 1), (None, 1, 1), (6, 1, 1), (5, 0, 0), (5, 0, 0)],
                                    "doc_id bigint, quality int, toxic int")
    for given in (labels, labels.where("false")):
        for name in (pairwise_quality, noisy_toxicity):
            rows = name.scored(odd, name.learn(odd, given)).collect()
            assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
            assert name.scored(odd.where("false"), name.learn(odd.where("false"), given)).count() == 0


def test_pipeline(shared, folder, odd, tmp_path):
    docs = shared.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stored(stage(shared, kept, folder))
        if name != "packing":
            assert kept.columns == docs.columns
        if name == "SimHash near-dedup":
            classes = gray_simhash.near_duplicates(before).where(F.col("doc_id") == F.col("component_id"))
            assert {r[0] for r in kept.select("doc_id").collect()} == {r[0] for r in classes.select("doc_id").collect()}
        if name == "substring dedup":
            rows = [(r["doc_id"], r["text"]) for r in before.orderBy("doc_id").collect()]
            want = without_repeats(rows)
            for r in kept.collect():
                words = " ".join(SPLIT.findall(r["text"]))
                assert hashlib.sha256(words.encode()).hexdigest() == want[r["doc_id"]][2]
    shared.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (odd, odd.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            rows = stored(stage(shared, rows, str(tmp_path)))


CLASHING = ("_file", "_at", "_first", "_row", "_ord", "a.b", "row", "fp", "root", "alone", "firsts", "_one")


def test_columns_with_the_operators_own_names_stay(shared, tmp_path):
    """Whatever else a table holds, rows and their columns come through, from files and from other plans."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, 1, *[f"{c}1" for c in CLASHING]), (2, text, 2, *[f"{c}2" for c in CLASHING]),
            (3, None, 3, *[None] * len(CLASHING))]
    columns = "doc_id bigint, text string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)
    made = shared.createDataFrame(rows, columns)
    made.write.parquet(f"file://{tmp_path}/t.parquet")
    for docs in (made, shared.read.parquet(f"file://{tmp_path}/t.parquet")):
        left = gray_simhash.one_of_each(docs)
        assert left.columns == docs.columns and sorted(tuple(r) for r in left.collect()) == [rows[0], rows[2]]
        found = {r["row"]["doc_id"]: r for r in fm_dedup.removed(docs).collect()}
        assert [found[i]["n_removed"] for i in (1, 2, 3)] == [0, 40, 0]
        assert all(tuple(found[i]["row"]) == (i, *rows[i - 1][2:]) for i in (1, 2, 3))
