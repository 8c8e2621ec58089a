"""Edit-aware token counts: a segment tree per document, re-encoded where an edit touched it.

The units of a tree are runs of pre-tokens that are tokenised independently of each other (see
``byte_bpe.cut``), with their tokens. Leaves hold up to 2 * BLOCK units in order, inner nodes the sums
of characters and tokens below them. An edit finds its units by their characters, cuts their text and
that of one neighbour on each side anew (a cut depends on the characters next to it only), counts the
tokens of these units, puts every one of them in the place of the old ones and updates the sums above.
A leaf that grows too large is split, so however many edits meet in one place, each counts the units
it touches and no more.

Edits of a document are applied in order; positions are code points of the text as the earlier edits
left it, and are moved into it where they lie outside. A null list or edit changes nothing, a null
replacement is empty, null positions are the start or the end. Null and empty texts have no tokens.
Repeated rows and ids are counted each on its own. An empty table gives an empty table. Columns are
not read unless they are named in ``keep``, which may use any names but those of the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credit_marts.llm.byte_bpe import Units, cut, parted, unit_counts
from credit_marts.llm.common import arrow_map, slices

BLOCK = 32  # units of a leaf when it is made


class CountTree:
    """The units of a text with their tokens, in leaves under sums."""

    def __init__(self, units: list[str], tokens: list[int]) -> None:
        cuts = range(0, len(units), BLOCK)
        self.leaves = [(units[i : i + BLOCK], tokens[i : i + BLOCK]) for i in cuts] or [([], [])]
        self._build()

    def _build(self) -> None:
        """The sums over all leaves: characters and tokens, the root first."""
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        empty = [0] * (self.size - len(self.leaves))
        self.chars_of = [0] * self.size + [sum(map(len, units)) for units, _ in self.leaves] + empty
        self.tokens_of = [0] * self.size + [sum(tokens) for _, tokens in self.leaves] + empty
        for sums in (self.chars_of, self.tokens_of):
            for node in range(self.size - 1, 0, -1):
                sums[node] = sums[2 * node] + sums[2 * node + 1]

    @property
    def chars(self) -> int:
        return self.chars_of[1]

    @property
    def tokens(self) -> int:
        return self.tokens_of[1]

    @property
    def n_units(self) -> int:
        return sum(len(units) for units, _ in self.leaves)

    @property
    def text(self) -> str:
        return "".join("".join(units) for units, _ in self.leaves)

    def find(self, position: int) -> tuple[int, int, int]:
        """The leaf and the unit in it that hold a character, and where that unit begins. A position
        past the end is that of the last character."""
        node, begin, sums = 1, 0, self.chars_of
        while node < self.size:
            node *= 2
            if position >= begin + sums[node] and sums[node + 1]:
                begin, node = begin + sums[node], node + 1
        leaf = node - self.size
        units = self.leaves[leaf][0]
        for at, unit in enumerate(units):
            if position < begin + len(unit) or at == len(units) - 1:
                return leaf, at, begin
            begin += len(unit)
        return leaf, 0, begin

    def before(self, leaf: int, at: int) -> tuple[int, int]:
        """The unit before one, or that one if there is none."""
        if at:
            return leaf, at - 1
        for other in range(leaf - 1, -1, -1):
            if self.leaves[other][0]:
                return other, len(self.leaves[other][0]) - 1
        return leaf, at

    def after(self, leaf: int, at: int) -> tuple[int, int]:
        if at + 1 < len(self.leaves[leaf][0]):
            return leaf, at + 1
        for other in range(leaf + 1, len(self.leaves)):
            if self.leaves[other][0]:
                return other, 0
        return leaf, at

    def _resum(self, leaf: int) -> None:
        units, tokens = self.leaves[leaf]
        node = self.size + leaf
        chars, count = sum(map(len, units)) - self.chars_of[node], sum(tokens) - self.tokens_of[node]
        while node:
            self.chars_of[node] += chars
            self.tokens_of[node] += count
            node //= 2

    def edit(self, start: int, stop: int, text: str, count: Callable[[list[str]], list[int]]) -> int:
        """Replace characters; returns the number of units that were counted anew."""
        start = min(max(start, 0), self.chars)
        stop = min(max(stop, start), self.chars)
        leaf, at, begin = self.find(start)
        first = self.before(leaf, at)
        if first != (leaf, at):
            begin -= len(self.leaves[first[0]][0][first[1]])
        last = self.after(*self.find(max(start, stop - 1))[:2])
        (i, a), (j, b) = first, last
        between = [u for n in range(i, j + 1) for u in self.leaves[n][0][a if n == i else 0 : b + 1 if n == j else None]]
        region = "".join(between)
        units = cut(region[: start - begin] + text + region[stop - begin :])
        tokens = count(units)
        (left, left_tokens), (right, right_tokens) = self.leaves[i], self.leaves[j]
        whole = left[:a] + units + right[b + 1 :], left_tokens[:a] + tokens + right_tokens[b + 1 :]
        if len(whole[0]) > 2 * BLOCK or (not whole[0] and len(self.leaves) > 1):
            cuts = range(0, len(whole[0]), BLOCK)
            self.leaves[i : j + 1] = [(whole[0][n : n + BLOCK], whole[1][n : n + BLOCK]) for n in cuts]
            self.leaves = self.leaves or [([], [])]
            self._build()
        else:
            self.leaves[i : j + 1] = [whole, *[([], []) for _ in range(i, j)]]  # leaves between are empty
            for n in range(i, j + 1):
                self._resum(n)
        return len(units)

    def apply(self, changes: list[dict] | None, count: Callable[[list[str]], list[int]]) -> int:
        """Apply edits in order; returns the number of units that were counted anew."""
        counted = 0
        for change in changes or ():
            if change is not None:
                stop = self.chars if change["stop"] is None else change["stop"]
                counted += self.edit(change["start"] or 0, stop, change["replacement"] or "", count)
        return counted


def _counter(ranks_path: str, pattern: str) -> Callable[[list[str]], list[int]]:
    """The tokens of every unit of a region, as ``cut`` gives them."""
    units = unit_counts(ranks_path, pattern)
    return lambda found: [units.known[u[1:]] if u[:1] == " " else units.first[u] for u in found]


def trees(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
          keep: dict[str, Column] | None = None) -> DataFrame:
    """(id, text, unit_chars, unit_tokens) and the ``keep`` columns: the leaves of every text's
    tree, to be stored and edited later. Narrow: no exchange."""
    keep = keep or {}
    taken = {"id", "text", "unit_chars", "unit_tokens"}.intersection(keep)
    if taken:
        raise ValueError(f"kept columns need other names than {', '.join(sorted(taken))}")
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *[c.alias(n) for n, c in keep.items()],
    )

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = unit_counts(ranks_path, pattern)
        for batch in found:
            for part in slices(batch):
                sizes, tokens, ends = [], [], [0]
                for text in part["text"].to_pylist():
                    own, known = _parts(text, counts)
                    sizes += [len(p) + (i > 0) for i, p in enumerate(own)]
                    tokens += known
                    ends.append(len(tokens))
                at = pa.array(ends, pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(values, pa.int32())) for values in (sizes, tokens)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *lists], [*part.schema.names, "unit_chars", "unit_tokens"]
                )

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return arrow_map(rows, batches, f"{own}, unit_chars array<int>, unit_tokens array<int>")


def _parts(text: str, counts: Units) -> tuple[list[str], list[int]]:
    """The parts of a text and the tokens of their units."""
    parts = parted(text) if text else []
    return parts, counts.of_parts(parts) if parts else []


_OUT = ["id", "n_tokens", "n_tokens_after", "n_units", "n_counted", "text"]


def _edited(rows: DataFrame, ranks_path: str, pattern: str, stored: bool, with_text: bool) -> DataFrame:
    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, count = unit_counts(ranks_path, pattern), _counter(ranks_path, pattern)
        for batch in found:
            for part in slices(batch):
                out = []
                columns = (part[name].to_pylist() for name in part.schema.names)
                for i, text, changes, *leaves in zip(*columns, strict=True):
                    if stored:
                        sizes, tokens = leaves
                        ends = np.cumsum([0, *sizes]).tolist()
                        units = [text[a:b] for a, b in zip(ends, ends[1:], strict=False)]
                    else:
                        units, tokens = _parts(text, counts)
                        units[1:] = [" " + u for u in units[1:]]
                    tree = CountTree(units, tokens)
                    before, n_units = tree.tokens, len(units)
                    counted = tree.apply(changes, count)
                    out.append((i, before, tree.tokens, n_units, counted, tree.text if with_text else None))
                columns = list(zip(*out, strict=True)) if out else [()] * 6
                arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
                arrays += [pa.array(columns[5], pa.string())] if with_text else []
                yield pa.RecordBatch.from_arrays(arrays, _OUT[: len(arrays)])

    schema = ", ".join(f"{n} bigint" for n in _OUT[:5]) + (", text string" if with_text else "")
    return arrow_map(rows, batches, schema)


def apply_edits(trees: DataFrame, ranks_path: str, pattern: str, edits: str = "edits", with_text: bool = True) -> DataFrame:
    """(id, n_tokens, n_tokens_after, n_units, n_counted, text): stored trees after the edits of a
    column of arrays of (start, stop, replacement). Narrow: no exchange."""
    rows = trees.select("id", "text", F.col(edits), "unit_chars", "unit_tokens")
    return _edited(rows, ranks_path, pattern, True, with_text)


def edit_texts(
    docs: DataFrame, edits: Column, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    with_text: bool = True,
) -> DataFrame:
    """The same for texts whose trees are not stored: they are built and edited in one pass, and no
    unit leaves its task."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), edits.alias("edits")
    )
    return _edited(rows, ranks_path, pattern, False, with_text)
