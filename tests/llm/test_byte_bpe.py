"""Byte-level BPE against the plain merge loop and a public library; decoding as a round trip."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from credit_marts.llm import byte_bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = "aab \n\t.,'sl1 23éßñ中文　  🎉👨‍👩\x1c\x85ÀǅͰ١"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )


def odd_texts(n, seed=1):
    chance = random.Random(seed)
    return ["".join(chance.choice(ODD) for _ in range(chance.randint(0, 30))) for _ in range(n)]


def test_ids_are_those_of_the_library(library):
    units = byte_bpe.encoder(RANKS, public_tokenizers.PATTERN)
    for text in [*odd_texts(3000), "a" * 5000, " " * 3000, "=-" * 3000, "end \n\n ", " x", "I'll  it's"]:
        assert units.ids(text).tolist() == library.encode_ordinary(text)


def test_stream_agrees_with_plain_merges_on_small_vocabularies():
    chance = random.Random(7)
    for _ in range(60):
        ranks = {bytes([b]): i for i, b in enumerate(b"abc")}
        for _ in range(chance.randint(1, 12)):
            ranks.setdefault(chance.choice(list(ranks)) + chance.choice(list(ranks)), len(ranks))
        machine, merges = byte_bpe.Transducer(ranks, most_states=5), byte_bpe.Merges(ranks)
        made = [t for t in ranks if merges.merged(t) == [t]]
        if len(made) < len(ranks):  # a token no merge yields is only found as a whole piece
            continue
        machine.LOOK = 8
        for _ in range(40):
            piece = bytes(chance.choice(b"abc") for _ in range(chance.randint(1, 40)))
            expected = [ranks[t] for t in merges.merged(piece)]
            assert list(machine.stream(piece)) == expected


def test_streamed_text_is_that_of_the_whole():
    machine, chance = byte_bpe.decoder(RANKS), random.Random(3)
    for _ in range(500):
        ids = [chance.randrange(50256) for _ in range(9)]
        whole = b"".join(machine.token_bytes[i] for i in ids)
        assert "".join(machine.stream(ids)) == whole.decode("utf-8", "replace")


def test_tables(spark, library):
    docs = [(1, None), (2, ""), (None, "Two words"), (3, "x y " * 9000), (3, "x y " * 9000), (4, "é🎉")]
    frame = spark.createDataFrame([(i, t, 0, "a") for i, t in docs], "doc_id int, text string, id int, ids string")
    encoded = byte_bpe.encode(frame, RANKS, public_tokenizers.PATTERN)
    assert sorted(map(str, byte_bpe.decode(encoded, RANKS).collect())) == sorted(
        f"Row(id={i}, text={t or ''!r})" for i, t in docs
    )
    rows = byte_bpe.digests(frame, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(docs)
    by_sha = {r["decoded_sha256"]: r for r in rows}
    for _, text in docs:
        ids = library.encode_ordinary(text or "")
        row = by_sha[hashlib.sha256((text or "").encode()).hexdigest()]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert byte_bpe.encode(frame.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []
