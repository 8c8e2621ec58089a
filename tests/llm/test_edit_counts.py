"""Edit-aware counts against counting the edited text from the start."""

import random

import public_tokenizers
import pytest
import tiktoken

from credit_marts.llm import edit_counts
from credit_marts.llm.byte_bpe import cut, read_ranks

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
EDIT = "array<struct<start: bigint, stop: bigint, replacement: string>>"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


def edited(text, edits):
    for start, stop, new in edits:
        start = min(max(start or 0, 0), len(text))
        stop = min(max(len(text) if stop is None else stop, start), len(text))
        text = text[:start] + (new or "") + text[stop:]
    return text


def test_units_are_independent(library):
    chance = random.Random(5)
    for _ in range(2000):
        text = "".join(chance.choice("ab 'sé1.\n\t  ") for _ in range(chance.randint(0, 30)))
        units = cut(text)
        assert "".join(units) == text
        assert [i for u in units for i in library.encode_ordinary(u)] == library.encode_ordinary(text)


def test_random_edits(library):
    chance = random.Random(6)
    count = edit_counts._counter(RANKS, PATTERN)
    for _ in range(300):
        text = "".join(chance.choice("abc  'sé1.\n") for _ in range(chance.randint(0, 60)))
        units = cut(text)
        tree = edit_counts.CountTree(units[:], count(units))
        for _ in range(6):
            size = len(text)
            start = chance.randint(-2, size + 3)
            edit = (start, start + chance.choice([0, 0, 1, 3, 20]), chance.choice(["", " ", "x", " new word ", "\n", "'s"]))
            text = edited(text, [edit])
            tree.edit(*edit, count)
            assert tree.text == text and tree.chars == len(text)
            assert tree.tokens == len(library.encode_ordinary(text))


def test_only_the_region_is_counted_again(library):
    text = " ".join(f"word{i}" for i in range(5000))
    units, count = cut(text), edit_counts._counter(RANKS, PATTERN)
    tree = edit_counts.CountTree(units, count(units))
    assert tree.edit(20_000, 20_003, "and more", count) <= 6
    assert tree.tokens == len(library.encode_ordinary(tree.text))


def test_tables(spark, library):
    docs = [
        (1, "some text to be edited", [(0, 4, "any"), (100, None, " end"), (-5, 0, None)]),
        (2, None, [(0, 0, "new")]),
        (3, "", None),
        (None, "kept", [None, (None, None, None)]),
        (4, "x " * 50_000, [(10, 99_000, "y")]),
        (4, "x " * 50_000, []),
    ]
    frame = spark.createDataFrame(docs, f"doc_id bigint, text string, edits {EDIT}")
    trees = edit_counts.trees(frame, RANKS, PATTERN, keep={"edits": frame["edits"]})
    rows = edit_counts.apply_edits(trees, RANKS, PATTERN).collect()
    expected = []
    for i, text, edits in docs:
        after = edited(text or "", [e for e in edits or [] if e])
        expected.append((i, len(library.encode_ordinary(text or "")), len(library.encode_ordinary(after)), after))
    got = [(r["id"], r["n_tokens"], r["n_tokens_after"], r["text"]) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert edit_counts.trees(frame.limit(0), RANKS, PATTERN).collect() == []


def test_a_thousand_edits_in_one_place(library):
    text = " ".join(f"word{i}" for i in range(5000))
    units, count = cut(text), edit_counts._counter(RANKS, PATTERN)
    tree = edit_counts.CountTree(units, count(units))
    for _ in range(1000):
        text = text[:20_000] + " new words," + text[20_000:]
        assert tree.edit(20_000, 20_000, " new words,", count) <= 6
    assert tree.text == text and tree.tokens == len(library.encode_ordinary(text))
    assert tree.n_units == len(cut(text)) and max(len(own) for own, _ in tree.leaves) <= 2 * edit_counts.BLOCK
    page = " pasted" * 3000
    assert tree.edit(20_000, 20_000, page, count) <= 3006 and tree.edit(30_000, 30_000, "x", count) <= 6
    for _ in range(50):  # and away again
        tree.edit(10_000, 11_000, "", count)
    assert tree.edit(0, tree.chars, "", count) == 0 and tree.tokens == 0 and tree.text == ""
    tree.edit(5, 9, "all new", count)
    assert tree.text == "all new" and tree.tokens == len(library.encode_ordinary("all new"))


def test_units_and_counted_units(spark, library):
    chance = random.Random(8)
    docs = []
    for i in range(60):
        text = "".join(chance.choice("abc  'sé1.\n") for _ in range(chance.randint(0, 400)))
        edits = [(s := chance.randint(-2, 420), s + chance.choice([0, 2, 30]), chance.choice(["", " ", "x y z", None])) for _ in range(5)]
        docs.append((i, text, edits))
    frame = spark.createDataFrame(docs, f"doc_id bigint, text string, edits {EDIT}").repartition(3)
    stored = edit_counts.apply_edits(edit_counts.trees(frame, RANKS, PATTERN, keep={"edits": frame["edits"]}), RANKS, PATTERN)
    whole = edit_counts.edit_texts(frame, frame["edits"], RANKS, PATTERN)
    assert sorted(whole.collect()) == sorted(stored.collect())
    texts = {i: (t, e) for i, t, e in docs}
    for r in whole.collect():
        text, edits = texts[r["id"]]
        assert r["n_units"] == len(cut(text))
        counted = 0
        for edit in edits:
            counted += touched(text, edit)
            text = edited(text, [edit])
        assert r["n_counted"] == counted and r["text"] == text and r["n_tokens_after"] == len(library.encode_ordinary(text))


def touched(text, edit):
    """The units of the region of an edit, found by walking over all units."""
    units, size = cut(text), len(text)
    start = min(max(edit[0], 0), size)
    stop = min(max(edit[1], start), size)
    ends, at = [], 0
    for unit in units:
        at += len(unit)
        ends.append(at)

    def place(position):
        return next((n for n, end in enumerate(ends) if position < end), len(units) - 1)

    if not units:
        return len(cut(edit[2] or ""))
    first, last = max(place(start) - 1, 0), min(place(max(start, stop - 1)) + 1, len(units) - 1)
    begin = ends[first] - len(units[first])
    region = "".join(units[first : last + 1])
    return len(cut(region[: start - begin] + (edit[2] or "") + region[stop - begin :]))


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a b", 5, "t", 7)], "doc_id bigint, text string, id int, n_tokens string, unit_chars int")
    assert edit_counts.trees(frame, RANKS, PATTERN, keep={"n_tokens": frame["n_tokens"]}).first()["n_tokens"] == "t"
    with pytest.raises(ValueError, match="other names"):
        edit_counts.trees(frame, RANKS, PATTERN, keep={"id": frame["id"]})
