"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds spans.

A text's tokens (runs without white space) are tagged as begin, inside or outside of a secret. What
speaks for a tag are features of the token's shape, of the tokens beside it and of the whole text.
The field is trained here, in numpy, on bounded samples of documents with a match of a pattern and of
those without, each by hash, where the patterns' own matches are the secrets; so it finds what looks
and stands like them but is written otherwise. All documents are searched for matches first.

Viterbi decoding is exact and yet skips most of a text: where a token speaks for "outside" by more
than all transitions together can make up for, and an "inside" after it, which would have to become
a "begin", the best path goes through "outside", so only the stretches between such tokens are decoded.

Pattern matches stay; every span that the field finds is added as kind ``crf``, without quotes and
punctuation around it, unless pattern matches cover it wholly. Positions are code points, ends
exclusive. Null and empty texts have no spans. Repeated rows and ids, null ids included, are
scanned each on its own. An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credit_marts.llm.common import Kept, Steps, WordTable, arrow_map, hashed_share, per_worker, sample_share, ship, slices, texts

# The patterns, with the group and the least characters that make a match count.
PATTERNS = {
    "assign": (
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.I
        ),
        2,
        8,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 32),
}
KINDS = [*PATTERNS, "crf"]
# Two patterns in a form that finds the same matches of enough characters faster.
_QUICK = {"access": re.compile(r"AKIA[A-Z0-9]{12,}"), "hex": re.compile(r"[0-9a-f]{32,}")}
_KEYWORD = re.compile(r"passw|secret|token|api_?key", re.ASCII | re.I)

FIT_ROWS = 10_000  # documents without a match the field is trained on, about
MATCH_ROWS = 4_000  # documents with a match it is trained on besides, at most
WINDOWS = 10_000  # windows around secrets that the field learns from, of those documents
REACH = 5  # tokens on each side of a secret that are trained on with it
WINDOW = 2 * REACH + 3
BLOCK = 1_024  # windows whose slopes are worked out at a time
BEGIN, INSIDE, OUTSIDE = 0, 1, 2

_TOKEN = re.compile(r"\S+")
_TRIM = "\"'`,;:.()[]{}<>="

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and without overlap within each."""
    found = []
    for kind, (pattern, group, least) in PATTERNS.items():
        if kind == "assign" and not _KEYWORD.search(text):
            continue
        for match in _QUICK.get(kind, pattern).finditer(text):
            if match.end(group) - match.start(group) >= least:
                found.append((kind, match.start(), match.end()))
    return ordered(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


class _Skeleton(dict):
    """Characters to their class: a letter becomes one of its case and kind, an ASCII digit 0."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        if char.isalpha() and char.islower():
            self[code] = "a" if code < 128 else "\u00e0"
        elif char.isalpha() and char.isupper():
            self[code] = "A" if code < 128 else "\u00c0"
        else:
            self[code] = "0" if "0" <= char <= "9" else char
        return self[code]


# Features of a token, each 0 or 1. The first ones depend on its skeleton only.
_OF_SKELETON = [
    lambda w: len(w) >= 8, lambda w: len(w) >= 14, lambda w: len(w) >= 18, lambda w: len(w) >= 28, lambda w: len(w) <= 2,
    str.isalpha, str.islower, str.isupper, str.isalnum, lambda w: w[:1].isupper() and w[1:].islower(),
    lambda w: any(map(str.isdigit, w)), lambda w: sum(map(str.isdigit, w)) * 4 >= len(w),
    lambda w: sum(a.isdigit() != b.isdigit() for a, b in zip(w, w[1:], strict=False)) >= 4,
    lambda w: any(map(str.isupper, w[1:])) and any(map(str.isdigit, w)),
    lambda w: any(map(str.islower, w)) and any(map(str.isdigit, w)),
    lambda w: re.search(r"[0-9A-Z]{16}", w) is not None, lambda w: re.search(r"[A-Za-z0-9+/_-]{16}", w) is not None,
    lambda w: w in ("=", ":", ":=", "=>"), lambda w: "=" in w[1:], lambda w: ":" in w[1:-1], lambda w: w[-1:] in ("=", ":"),
    lambda w: w[:1] in "\"'" and len(w) > 1, lambda w: w[-1:] in "\"',;",
    lambda w: re.fullmatch(r"[\W_]+", w) is not None, lambda w: not w.isascii(),
    lambda w: "@" in w or re.search(r":/|/\w+/", w) is not None,
]
_HEX = re.compile(r"[0-9a-f]{16}")
_NAMES = re.compile(r"pass|secret|token|key|cred|auth", re.I)
_OF_WORD = [
    lambda w: len(w) >= 16 and _HEX.search(w) is not None,
    lambda w: _NAMES.search(w) is not None,
    lambda w: len(set(w)) * 2 > len(w) + 6,
]
SHAPES = len(_OF_SKELETON) + len(_OF_WORD) + 1  # and a constant

_classes = _Skeleton()
_known = Kept(lambda skeleton: [bool(test(skeleton)) for test in _OF_SKELETON], 1 << 23)


def shapes(words: list[str]) -> np.ndarray:
    rows = [_known[word.translate(_classes)] for word in words]
    out = np.ones((len(words), SHAPES), dtype=np.float32)
    out[:, : len(_OF_SKELETON)] = np.array(rows, dtype=bool).reshape(len(words), len(_OF_SKELETON))
    for i, test in enumerate(_OF_WORD, start=len(_OF_SKELETON)):
        out[:, i] = np.fromiter(map(test, words), bool, len(words))
    return out


FILE_FEATURES = 3


def file_features(text: str, tokens: int) -> list[float]:
    """Length, characters per token and lines per token, all about 0 to 1."""
    return [min(1.0, tokens / 1000), min(1.0, len(text) / max(tokens, 1) / 20), min(1.0, text.count("\n") * 10 / max(tokens, 1))]


@dataclass
class Field:
    """Weights: of a token, of the one before, of the one after (each shapes x tags), of the file
    (features x tags), and of transitions (tag x tag). An inside never begins a stretch."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    file: np.ndarray
    moves: np.ndarray

    def word_scores(self, words: list[str]) -> np.ndarray:
        found = shapes(words)
        return np.concatenate([found @ self.own, found @ self.before, found @ self.after], axis=1)

    def emissions(self, scores: np.ndarray, file: np.ndarray) -> np.ndarray:
        """Of one text's tokens, from their word scores."""
        total = scores[:, :3] + file @ self.file
        total[1:] += scores[:-1, 3:6]
        total[:-1] += scores[1:, 6:]
        return total

    def decode(self, emissions: np.ndarray) -> np.ndarray:
        """The best tags of one text."""
        tags = np.full(len(emissions), OUTSIDE)
        reach = self.moves.max() - self.moves[self.moves > -1e8].min()
        # Making a token "outside" changes two moves; an "inside" after it must become a "begin", and a third changes.
        slack = np.full(len(emissions), 2 * reach)
        slack[:-1] += np.maximum(0, reach + emissions[1:, INSIDE] - emissions[1:, BEGIN])
        unsure = np.flatnonzero(emissions[:, OUTSIDE] - emissions[:, :OUTSIDE].max(axis=1) <= slack)
        for stretch in np.split(unsure, np.flatnonzero(np.diff(unsure) > 1) + 1) if len(unsure) else []:
            tags[stretch] = self.viterbi(emissions[stretch], last=stretch[-1] == len(emissions) - 1)
        return tags

    def viterbi(self, emissions: np.ndarray, last: bool) -> np.ndarray:
        """The best tags of a stretch that comes after "outside", and before it unless it is last."""
        score, back = self.moves[OUTSIDE] + emissions[0], []
        for row in emissions[1:]:
            ways = score[:, None] + self.moves
            back.append(ways.argmax(0))
            score = ways.max(0) + row
        tag = int((score if last else score + self.moves[:, OUTSIDE]).argmax())
        tags = [tag]
        for came in back[::-1]:
            tag = int(came[tag])
            tags.append(tag)
        return np.array(tags[::-1])


FORBIDDEN = -1e9


def _slopes(field: Field, words: np.ndarray, tags: np.ndarray, file: np.ndarray) -> dict[str, np.ndarray]:
    """Of the likelihood of some windows, by weights."""
    length = words.shape[1]
    beyond = np.where(words.any(axis=2)[:, :, None], 0.0, [FORBIDDEN, FORBIDDEN, 0.0])
    truth = np.eye(3)[tags]
    emitted = words @ field.own + (file @ field.file)[:, None, :] + beyond
    emitted[:, 1:] += (words @ field.before)[:, :-1]
    emitted[:, :-1] += (words @ field.after)[:, 1:]
    ahead, behind = np.zeros_like(emitted), np.zeros_like(emitted)
    ahead[:, 0] = field.moves[OUTSIDE] + emitted[:, 0]
    for t in range(1, length):
        ahead[:, t] = np.logaddexp.reduce(ahead[:, t - 1, :, None] + field.moves, axis=1) + emitted[:, t]
    for t in range(length - 2, -1, -1):
        behind[:, t] = np.logaddexp.reduce(field.moves + (emitted[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
    whole = np.logaddexp.reduce(ahead[:, -1], axis=1)
    wrong = np.exp(ahead + behind - whole[:, None, None]) - truth
    pairs = np.exp(
        ahead[:, :-1, :, None] + field.moves + (emitted + behind)[:, 1:, None, :] - whole[:, None, None, None]
    ).sum((0, 1))
    both = ([0, 1], [0, 1])
    return {
        "own": np.tensordot(words, wrong, both), "before": np.tensordot(words[:, :-1], wrong[:, 1:], both),
        "after": np.tensordot(words[:, 1:], wrong[:, :-1], both), "file": file.T @ wrong.sum(1),
        "moves": pairs - np.einsum("wta,wtb->ab", truth[:, :-1], truth[:, 1:]),
    }


def train(words: np.ndarray, tags: np.ndarray, file: np.ndarray, rounds: int = 100, rate: float = 0.15) -> Field:
    """Maximise the likelihood of tag sequences by gradient steps on forward and backward sums.

    ``words`` is windows x tokens x shapes, ``tags`` windows x tokens, ``file`` windows x features.
    Places without any shape, after the end of a short text, are outside for certain. Slopes are added
    up over BLOCK windows at a time, which bounds the memory besides ``words``.
    """
    windows, length, _ = words.shape
    chance = np.random.default_rng(0)
    field = Field(*(chance.normal(0, 0.01, (n, 3)) for n in (SHAPES, SHAPES, SHAPES, FILE_FEATURES, 3)))
    parts = {"own": field.own, "before": field.before, "after": field.after, "file": field.file, "moves": field.moves}
    moments = {n: [np.zeros_like(p), np.zeros_like(p)] for n, p in parts.items()}
    for step in range(1, rounds + 1):
        field.moves[OUTSIDE, INSIDE] = FORBIDDEN
        slopes = {name: np.zeros_like(part) for name, part in parts.items()}
        for at in range(0, windows, BLOCK):
            own = slice(at, at + BLOCK)
            for name, slope in _slopes(field, words[own].astype(np.float64), tags[own], file[own]).items():
                slopes[name] += slope
        for name, part in parts.items():
            allowed = part > FORBIDDEN / 2
            slope = (slopes[name] + 0.05 * np.where(allowed, part, 0)) / windows
            first, second = moments[name]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            part -= np.where(allowed, move, 0)
    field.moves[OUTSIDE, INSIDE] = FORBIDDEN
    return field


def tagged(text: str) -> tuple[list[str], np.ndarray]:
    """Tokens of a text and their tags by the patterns."""
    found = list(_TOKEN.finditer(text))
    tags = np.full(len(found), OUTSIDE)
    starts, ends = np.array([m.start() for m in found]), np.array([m.end() for m in found])
    for _, start, end in reversed(base_spans(text)):
        inside = np.flatnonzero((starts < end) & (ends > start))
        if len(inside):
            tags[inside] = INSIDE
            tags[inside[0]] = BEGIN
    tags[(tags == INSIDE) & (np.concatenate([[OUTSIDE], tags[:-1]]) == OUTSIDE)] = BEGIN
    return [m.group() for m in found], tags


def _matching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of the texts with a match of a pattern."""
    for batch in batches:
        for part in slices(batch):
            has = [bool(base_spans(t)) for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["key"].filter(pa.array(has, pa.bool_()))], ["key"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text, a window around every secret and one anywhere, of one length or the whole text."""
    kinds = (pa.bool_(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.float64()))
    for batch in batches:
        for part in slices(batch):
            rows = []
            for text, chosen in zip(part["text"].to_pylist(), part["chosen"].to_pylist(), strict=True):
                words, tags = tagged(text)
                secrets = np.flatnonzero(tags == BEGIN).tolist()
                if bool(secrets) != chosen:  # has a match, but is not in the sample of those
                    continue
                centres = [*secrets, len(text) % max(len(words), 1)] if len(words) >= WINDOW else [0]
                about = file_features(text, len(words))
                for n, centre in enumerate(centres):
                    at = max(0, min(centre - REACH, len(words) - WINDOW))
                    while at > 0 and tags[at] == INSIDE:
                        at -= 1
                    rows.append((n < len(secrets), words[at : at + WINDOW], tags[at : at + WINDOW].tolist(), about))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["secret", "words", "tags", "file"]
            )


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS, matches: int = MATCH_ROWS
) -> Field | None:
    """The field of a sample of about ``rows`` documents without a match and at most ``matches`` with
    one, by hash of id and text; None if no document of the table has a match."""
    lines = texts(docs, id_col, text_col).withColumn("key", F.xxhash64("id", "text"))
    steps = Steps(docs.sparkSession)
    matching = steps.store(arrow_map(lines.select("key", "text"), _matching, "key bigint").distinct())
    # Bounded by the parameter, so it is sent to the documents.
    chosen = steps.store(matching.orderBy("key").limit(matches).withColumn("chosen", F.lit(True)))
    if chosen.isEmpty():
        return None
    share = sample_share(lines.count(), rows)
    sample = lines.join(F.broadcast(chosen), "key", "left").where(F.col("chosen") | hashed_share("key", share))
    sample = sample.select("text", F.coalesce("chosen", F.lit(False)).alias("chosen"))
    found = arrow_map(sample, _windows, "secret boolean, words array<string>, tags array<int>, file array<double>")
    found = steps.store(found)
    # A document may hold any number of secrets: of all their windows a share is learned from.
    part = sample_share(found.where("secret").count(), WINDOWS)
    found = found.where(~F.col("secret") | (F.pmod(F.xxhash64("words", F.lit("window")), F.lit(1_000_000)) < int(part * 1_000_000)))
    found = found.select("words", "tags", "file").toArrow()
    words, tags = np.zeros((len(found), WINDOW, SHAPES), dtype=bool), np.full((len(found), WINDOW), OUTSIDE, dtype=np.int8)
    i = 0
    for batch in found.select(["words", "tags"]).to_batches(max_chunksize=BLOCK):
        for some, given in zip(batch["words"].to_pylist(), batch["tags"].to_pylist(), strict=True):
            words[i, : len(some)], tags[i, : len(some)] = shapes(some), given
            i += 1
    return train(words, tags, np.array(found["file"].to_pylist()))


def _table(field: Field) -> WordTable:
    name = float(field.own.sum() + field.before.sum() * 3 + field.after.sum() * 7)
    return per_worker("secret_crf", name, lambda: WordTable(field.word_scores))


def added_spans(text: str, tags: np.ndarray, base: list[Span]) -> list[Span]:
    """Spans of tagged tokens, each whole, but for those that matches of patterns cover."""
    found, open_at, end = [], None, 0
    for match, tag in zip(_TOKEN.finditer(text), tags.tolist(), strict=True):
        if tag != INSIDE and open_at is not None:
            found.append((open_at, end))
            open_at = None
        if tag == BEGIN:
            open_at = match.start()
        end = match.end()
    if open_at is not None:
        found.append((open_at, end))
    spans = []
    for start, end in found:
        body = text[start:end]
        start, end = start + len(body) - len(body.lstrip(_TRIM)), end - len(body) + len(body.rstrip(_TRIM))
        bare = start
        for _, s, e in base:  # in order of their starts
            if s <= bare:
                bare = max(bare, e)
        if bare < end:
            spans.append(("crf", start, end))
    return spans


def scan(lines: list[str], field: Field | None) -> list[tuple[list[Span], list[Span]]]:
    """Of each text, the matches of the patterns and all spans."""
    out = []
    split = [t.split() for t in lines]
    scores = None
    if field is not None:
        table = _table(field)
        rows = table([w for own in split for w in own])
        scores = table.values[rows]
    at = 0
    for text, own in zip(lines, split, strict=True):
        base = base_spans(text)
        spans = base
        if field is not None and own:
            emissions = field.emissions(scores[at : at + len(own)].astype(np.float64), np.array(file_features(text, len(own))))
            tags = field.decode(emissions)
            if (tags != OUTSIDE).any():
                spans = ordered(base + added_spans(text, tags, base))
        at += len(own)
        out.append((base, spans))
    return out


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) for every row. Narrow after the fit."""
    field = fit(docs, id_col, text_col)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for part in slices(batch):
                both = scan(part["text"].to_pylist(), field)
                counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in both], pa.int64()) for kind in PATTERNS]
                said = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in both]
                columns = [part["id"], *counts, pa.array(said, pa.string()), pa.array([written(s) for _, s in both], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["id", *[f"n_{kind}" for kind in PATTERNS], "base_sha256", "spans"]
    schema = ", ".join(f"{n} bigint" for n in names[:-2]) + ", base_sha256 string, spans string"
    return arrow_map(texts(docs, id_col, text_col), batches, schema)


def masked(text: str, spans: list[Span], mask: str) -> str:
    """The text with every span, or what overlapping spans cover together, replaced."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]]) if spans else text


def mask_secrets(docs: DataFrame, text: Column, field: Field | None, mask: str = "[secret]") -> Column:
    """A text column with its secrets replaced; null stays null."""
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def replaced(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lines in batches:
            out: list[str | None] = []
            for part in slices(pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["text"])):
                found = part["text"].to_pylist()
                spans = scan([t or "" for t in found], field)
                out += [None if t is None else masked(t, own, mask) for t, (_, own) in zip(found, spans, strict=True)]
            yield pd.Series(out, dtype=object)

    return replaced(text)
