"""Language masks: the filter forgets nothing, and held-out documents get their language."""

import random

import numpy as np

from credit_marts.llm import lang_masks

SF = "/root/testdata/sf0.01"


def test_hashes_are_those_of_the_grams():
    words = ["ab", "c", "déjà", "ab"]
    hashes, owners = lang_masks.gram_hashes(words)
    seen: dict = {}
    for i, word in enumerate(words):
        marked = f" {word} "
        grams = [marked[a : a + n] for n in lang_masks.GRAMS for a in range(len(marked) - n + 1)]
        own = [g for g in grams if g != " "]  # a mark alone is none
        assert (owners == i).sum() == len(own)
        seen.setdefault(word, []).append(sorted(hashes[owners == i].tolist()))
    assert all(a == b for same in seen.values() for a, b in zip(same, same[1:], strict=False))


def test_filter_contains_what_was_put_in():
    chance = np.random.default_rng(1)
    languages = [f"l{i:02}" for i in range(70)]  # more than a word of bits
    hashes, owner = chance.integers(0, 2**63, 5000, dtype=np.uint64), chance.integers(0, 70, 5000)
    masks = lang_masks.Filter.of(languages, hashes, owner)
    assert masks.has(hashes)[np.arange(5000), owner].all()
    others = masks.has(chance.integers(0, 2**63, 20_000, dtype=np.uint64))
    assert abs(others.mean(axis=0) - masks.false_rates()).max() < 0.01


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = lang_masks.predicted(docs).join(docs.selectExpr("doc_id AS id", "lang", "text"), "id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 250
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_tables(spark):
    docs = [(i, ["the house and the garden", "das haus und der garten"][i % 2] + f" {i}", ["en", "de"][i % 2]) for i in range(60)]
    docs += [(100, None, "en"), (101, "", "en"), (102, "123 !?", "de"), (None, "the house", None), (103, "das " * 50_000, None)]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, lang string, id string, score int")
    rows = lang_masks.predicted(frame).collect()
    got = {r["id"]: r["lang_pred"] for r in rows}
    assert len(rows) == len(docs)
    assert got[100] == got[101] == got[102] == "und" and got[None] == "en" and got[103] == "de"
    assert all(r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    assert all(got[i] == lang for i, _, lang in docs[:60])
    unlabelled = lang_masks.predicted(frame.withColumn("lang", frame["lang"].substr(9, 1)).where("false")).collect()
    assert unlabelled == []
    none = frame.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert {r["lang_pred"] for r in lang_masks.predicted(none).collect()} == {"und"}


def test_rare_language_beside_large_ones(spark):
    chance = random.Random(4)
    letters, signs = "abcdefghijklmnopqrstuvwxyz", [chr(0x4E00 + i) for i in range(3000)]
    docs = []
    for lang in ("aa", "bb", "cc"):  # together more than 60,000 n-grams, all more frequent than those of the rare one
        words = ["".join(chance.choices(letters, k=6)) for _ in range(4000)]
        docs += [(" ".join(chance.choices(words, k=800)), lang) for _ in range(150)]
    words = ["".join(chance.sample(signs, 6)) for _ in range(80)]
    docs += [(" ".join(chance.choices(words, k=12)), "rare") for _ in range(30)]
    frame = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id bigint, text string, lang string")
    rows = lang_masks.predicted(frame).join(frame.selectExpr("doc_id AS id", "lang"), "id").where("held_out").collect()
    for lang in ("aa", "bb", "cc", "rare"):
        own = [r["lang_pred"] for r in rows if r["lang"] == lang]
        assert len(own) > 3 and own == [lang] * len(own)


def test_filter_grows_with_its_grams():
    chance = np.random.default_rng(5)
    hashes = chance.integers(0, 2**63, 400_000, dtype=np.uint64)
    masks = lang_masks.Filter.of(["a", "b"], hashes, np.zeros(400_000, dtype=np.int64))
    assert masks.has(hashes)[:, 0].all() and masks.false_rates()[0] < 0.05
    others = masks.has(chance.integers(0, 2**63, 20_000, dtype=np.uint64))
    assert abs(others.mean(axis=0) - masks.false_rates()).max() < 0.01
    assert lang_masks.slot_bits(2000, 400_000) == lang_masks.LEAST_BITS


def test_predictions_against_counts_gram_by_gram(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    masks = lang_masks.fit(docs)
    false = masks.false_rates().tolist()
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id % 9 = 0").collect()}
    rows = [r for r in lang_masks.predicted(docs).collect() if r["id"] in texts]
    assert len(rows) > 100
    for r in rows:
        sums, grams = [0] * len(masks.languages), 0
        for word in lang_masks.words_of(texts[r["id"]] or ""):
            for h in lang_masks.gram_hashes([word])[0]:
                grams += 1
                held = [masks.slots[p[0]] for p in lang_masks.slots_of(np.array([h]), masks.bits)]
                for n in range(len(sums)):
                    sums[n] += all(int(mask[n // 8]) >> (n % 8) & 1 for mask in held)
        real = [max(0.0, (s - grams * f) / (1 - f)) for s, f in zip(sums, false, strict=True)]
        best = max(range(len(real)), key=lambda n: (real[n], -n))
        assert r["lang_pred"] == (masks.languages[best] if grams else "und")
        assert abs(r["score"] - (real[best] / sum(real) if grams and sum(real) else 0.0)) < 1e-6


def test_collected_filter_is_the_one_made_at_once(spark):
    """The filter that Spark puts together in blocks has the bits of one made of all n-grams here."""
    words = {"en": ["the", "house", "garden"], "de": ["das", "haus", "garten"], "fr": ["la", "maison"]}
    docs = [(i * 3 + n, " ".join(w), lang) for n, (lang, w) in enumerate(words.items()) for i in range(40)]
    masks = lang_masks.fit(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"))
    hashes, owner = [], []
    rates = {lang: dict(zip(*np.unique(lang_masks.gram_hashes(w)[0], return_counts=True))) for lang, w in words.items()}
    totals = {lang: sum(own.values()) for lang, own in rates.items()}
    for h in sorted({h for own in rates.values() for h in own}):
        shares = {lang: own.get(h, 0) / totals[lang] for lang, own in rates.items()}
        for lang, share in shares.items():
            if share and share >= lang_masks.RARER * max(shares.values()):
                hashes.append(h)
                owner.append(masks.languages.index(lang))
    whole = lang_masks.Filter.of(masks.languages, np.array(hashes, np.uint64), np.array(owner))
    assert (whole.slots == masks.slots).all()
