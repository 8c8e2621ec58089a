"""Byte-level BPE: a lazily determinised transducer encodes, an incremental UTF-8 machine decodes.

A sequence of tokens is what the merges yield exactly if every two neighbours are: merging them
alone never crosses their border. So a nondeterministic transducer reads bytes along the trie of
the vocabulary and may end a token wherever it fits the token before; one path per text survives.
Its determinised states (places in the trie with the token before them, one for each path alive)
are built when a text first needs them. No path reaches further back than the longest token, so
the tokens all paths agree on are handed out after a bounded number of bytes.

Nulls and empty texts have no tokens. Repeated rows and ids are encoded each on its own; a null id
stays null. An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from credit_marts.llm.common import Kept, arrow_map, per_worker, slices, texts

# Characters with the Unicode property White_Space, as the inside of a class.
SPACES = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# A piece begins at a single space between two other characters, whatever stands further away.
_CUT = re.compile(rf"(?<=[^{SPACES}]) (?=[^{SPACES}])")
# All white space but space and line feed.
_RARE = [c for c in map(chr, range(0x3001)) if re.match(f"[{SPACES}]", c) and c not in " \n"]


def parted(text: str) -> list[str]:
    """A text split at each single space between two other characters."""
    beside = "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " "
    return _CUT.split(text) if beside or any(c in text for c in _RARE) else text.split(" ")


def cut(text: str) -> list[str]:
    """A text in units that are tokenised independently: cut before each single space between two
    other characters, where every piece of the pre-token pattern ends."""
    if not text:
        return []
    first, *rest = parted(text)
    return [first, *[" " + r for r in rest]]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """Which tokens can stand side by side under a set of merge ranks."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.forever = max(ranks.values(), default=0) + 1
        self.spines: dict[int, tuple[list, list]] = {}
        self.pairs: dict[int, bool] = {}

    def merged(self, piece: bytes) -> list[bytes]:
        """The plain method: merge the lowest-ranked pair, leftmost first, until none is left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranked = [self.ranks.get(a + b, self.forever) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(ranked)
            if best == self.forever:
                break
            at = ranked.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts whose merge makes a token; None for a token no merge makes."""
        if len(token) < 2:
            return None
        own, parts = self.ranks[token], [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            ranked = [self.ranks.get(a + b, self.forever) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(ranked)
            if best >= own:
                return None
            at = ranked.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts[0], parts[1]

    def spine(self, rank: int) -> tuple[list, list]:
        """The parts at the left and at the right end of a token while it is made, smallest first,
        each with the rank of the merge that swallows it."""
        if rank not in self.spines:
            ends: list[list] = []
            for side in (0, 1):
                part, swallowed, line = self.tokens[rank], self.forever, []
                while True:
                    line.append((part, swallowed))
                    split = self.halves(part)
                    if split is None:
                        break
                    swallowed, part = self.ranks[part], split[side]
                ends.append(line[::-1])
            self.spines[rank] = (ends[0], ends[1])
        return self.spines[rank]

    def fit(self, left: int, right: int) -> bool:
        """Whether merging both tokens' bytes never crosses the border between them."""
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is not None:
            return known
        ours, theirs = self.spine(left)[1], self.spine(right)[0]
        i = j = 0
        good = True
        while True:
            (a, a_ends), (b, b_ends) = ours[i], theirs[j]
            across = self.ranks.get(a + b, self.forever)
            if across < a_ends and across <= b_ends and across != self.forever:
                good = False
                break
            if a_ends == b_ends == self.forever:
                break
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1
        if len(self.pairs) > 400_000:
            self.pairs.clear()
        self.pairs[pair] = good
        return good


class Transducer:
    """Bytes of one piece to token ids, with states made on demand and forgotten when there are
    more than ``most_states``."""

    LOOK = 512  # bytes after which the tokens all paths agree on are handed out

    def __init__(self, ranks: dict[bytes, int], most_states: int = 200_000) -> None:
        self.merges = Merges(ranks)
        self.ranks = ranks
        self.most_states = most_states
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.trie: dict[int, int] = {}
        self.ends: list[int] = [-1]
        self.inner: list[bool] = [True]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                self.inner[node] = True
                child = self.trie.setdefault(node << 8 | byte, len(self.ends))
                if child == len(self.ends):
                    self.ends.append(-1)
                    self.inner.append(False)
                node = child
            self.ends[node] = rank
        # A state: for each path still alive, oldest first, its last token (-1: none) and trie node.
        self.start = ((-1, 0),)
        self.forget(self.start)

    def forget(self, current: tuple) -> int:
        """Drop all states but the first and the current one; returns the number of that one."""
        self.states: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.arcs: dict[int, tuple[int, int]] = {}
        self.number(self.start)
        return self.number(current)

    def number(self, state: tuple) -> int:
        at = self.states.setdefault(state, len(self.sets))
        if at == len(self.sets):
            self.sets.append(state)
        return at

    def arc(self, at: int, byte: int) -> tuple[int, int]:
        """The next state, and the token that ends here on the one path that may end here."""
        alive, ended = [], -1
        for last, node in self.sets[at]:
            child = self.trie.get(node << 8 | byte)
            if child is not None:
                token = self.ends[child]
                if token >= 0 and ended < 0 and (last < 0 or self.merges.fit(last, token)):
                    ended = token
                if self.inner[child]:
                    alive.append((last, child))
        alive.append((ended, 0))
        found = self.arcs[at << 8 | byte] = (self.number(tuple(alive)), ended)
        return found

    def back(self, ended: list[int], end: int, begin: int = 0) -> list[int]:
        """The tokens of the path that reaches ``end``, back to ``begin``, in order."""
        out, lengths = [], self.lengths
        while end > begin:
            token = ended[end - 1]
            out.append(token)
            end -= lengths[token]
        return out[::-1]

    def agreed(self, ended: list[int], lengths: list[int]) -> int:
        """The last position that every path alive has passed."""
        ends = {len(ended) - n for n in lengths}
        while len(ends) > 1:
            last = max(ends)
            ends.remove(last)
            ends.add(last - self.lengths[ended[last - 1]])
        return ends.pop()

    def depth(self, state: tuple) -> list[int]:
        """How many bytes each path has read since its last token."""
        if not hasattr(self, "depths"):
            self.depths = [0] * len(self.ends)
            for key, child in self.trie.items():  # a parent is made before its children
                self.depths[child] = self.depths[key >> 8] + 1
        return [self.depths[node] for _, node in state]

    def stream(self, piece: Iterable[int]) -> Iterator[int]:
        """Tokens of a piece, each handed out once all paths agree on it."""
        at, ended, arcs = 0, [], self.arcs
        for byte in piece:
            step = arcs.get(at << 8 | byte)
            if step is None:
                if len(self.sets) > self.most_states:
                    at = self.forget(self.sets[at])
                    arcs = self.arcs
                step = self.arc(at, byte)
            at, token = step
            ended.append(token)
            if len(ended) >= self.LOOK:
                sure = self.agreed(ended, self.depth(self.sets[at]))
                yield from self.back(ended, sure)
                ended = ended[sure:]
        yield from self.back(ended, len(ended))

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) >= self.LOOK or len(self.sets) > self.most_states:
            return list(self.stream(piece))
        at, ended, arcs = 0, [], self.arcs
        for byte in piece:
            at, token = arcs.get(at << 8 | byte) or self.arc(at, byte)
            ended.append(token)
        return self.back(ended, len(ended))


# Bytes of the tables of units and of pieces in a worker.
UNIT_BYTES, PIECE_BYTES = 160 << 20, 96 << 20


class Units:
    """Values of the units of texts (see ``cut``), kept per distinct unit."""

    def __init__(self, make: Callable[[str], object], most: int = UNIT_BYTES) -> None:
        self.first, self.known = Kept(make, most // 8), Kept(lambda rest: make(" " + rest), most)

    def of(self, text: str) -> list:
        """The values of a text's units, in order."""
        return self.of_parts(parted(text)) if text else []

    def of_parts(self, parts: list[str]) -> list:
        """The same of a text that is parted already (see ``parted``)."""
        return [self.first[parts[0]], *map(self.known.__getitem__, parts[1:])]


class UnitIds(Units):
    """Ids of units as little-endian bytes. ``encode`` gives the ids of a unit, or those bytes."""

    def __init__(self, encode: Callable[[str], Iterable[int] | bytes], width: str = "<u2") -> None:
        self.width = np.dtype(width)

        def as_bytes(unit: str) -> bytes:
            found = encode(unit)
            return found if isinstance(found, bytes) else np.array(found, dtype=self.width).tobytes()

        super().__init__(as_bytes)

    def __call__(self, units: list[str]) -> Iterator[bytes]:
        return (self.known[unit[1:]] if unit[:1] == " " else self.first[unit] for unit in units)

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.of(text)), dtype=self.width)


def pre_token_regex(pattern: str) -> regex.Pattern:
    """The pattern with white space as tokenisers define it, one class in place of its escapes."""
    spaces = pattern.replace(r"\s", f"[{SPACES}]").replace(r"\S", f"[^{SPACES}]")
    return regex.compile(spaces.replace(f"[^[{SPACES}]", f"[^{SPACES}"))


def _width(ranks: dict[bytes, int]) -> str:
    return "<u2" if max(ranks.values(), default=0) < 2**16 else "<u4"


def _pieces(ranks: dict[bytes, int], pattern: str) -> Callable[[str], list[int]]:
    """The ids of a unit by the transducer behind the pre-token pattern."""
    machine, split = Transducer(ranks), pre_token_regex(pattern)
    known = Kept(lambda piece: tuple(machine.encode(piece.encode())), PIECE_BYTES)
    return lambda unit: [i for piece in split.findall(unit) for i in known[piece]]


def encoder(ranks_path: str, pattern: str) -> UnitIds:
    """The transducer of a rank file behind the pre-token pattern, one per worker."""

    def make() -> UnitIds:
        ranks = read_ranks(ranks_path)
        return UnitIds(_pieces(ranks, pattern), _width(ranks))

    return per_worker("byte_bpe", (ranks_path, pattern), make)


def library_encoder(ranks_path: str, pattern: str) -> UnitIds:
    """The same ids by a public library, for operators whose own method lies elsewhere."""

    def make() -> UnitIds:
        ranks = read_ranks(ranks_path)
        by = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return UnitIds(by.encode_ordinary, _width(ranks))

    return per_worker("library", (ranks_path, pattern), make)


class Utf8Machine:
    """UTF-8 decoding token by token: the state holds the bytes of an unfinished character.

    The step of a token from a state is worked out once and kept. What is no UTF-8 becomes U+FFFD,
    one for each longest wrong prefix, as in Python's decoder.
    """

    def __init__(self, token_bytes: dict[int, bytes]) -> None:
        self.token_bytes = token_bytes
        self.steps: dict[tuple[bytes, int], tuple[bytes, str]] = {}

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """How many bytes at the end begin a character that more bytes could complete."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead >= 0xC0:
                needed = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                tail = data[len(data) - back :]
                low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
                high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF)
                valid = 0xC2 <= lead <= 0xF4 and (len(tail) < 2 or low <= tail[1] <= high)
                return back if valid and back < needed else 0
            if lead < 0x80:
                return 0
        return 0

    def step(self, state: bytes, token: int) -> tuple[bytes, str]:
        key = (state, token)
        if key not in self.steps:
            if len(self.steps) > 200_000:
                self.steps.clear()
            data = state + self.token_bytes[token]
            keep = len(data) - self._unfinished(data)
            self.steps[key] = (data[keep:], data[:keep].decode("utf-8", "replace"))
        return self.steps[key]

    def block(self, state: bytes, ids: Iterable[int]) -> tuple[bytes, str]:
        """As ``step``, for a run of tokens at once."""
        data = state + b"".join(map(self.token_bytes.__getitem__, ids))
        keep = len(data) - self._unfinished(data)
        return data[keep:], data[:keep].decode("utf-8", "replace")

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """The text of ids, piece by piece, each character as soon as it is complete."""
        state = b""
        for token in ids:
            state, text = self.step(state, token)
            if text:
                yield text
        if state:
            yield state.decode("utf-8", "replace")


def unit_counts(ranks_path: str, pattern: str) -> Units:
    """The number of tokens of units, by a public library."""

    def make() -> Units:
        by = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={})
        return Units(lambda unit: len(by.encode_ordinary(unit)))

    return per_worker("unit counts", (ranks_path, pattern), make)


def decoder(ranks_path: str) -> Utf8Machine:
    return per_worker("utf8", ranks_path, lambda: Utf8Machine({rank: token for token, rank in read_ranks(ranks_path).items()}))


class RoundTrips(Units):
    """Per unit the decimal ids as text, for units whose ids decode to the unit again and leave the
    decoder where it began; None for others."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        ranks = read_ranks(ranks_path)
        machine, split = Transducer(ranks), pre_token_regex(pattern)
        self.decoder = Utf8Machine({rank: token for token, rank in ranks.items()})
        self.pieces = Kept(lambda piece: " ".join(map(str, machine.encode(piece.encode()))), PIECE_BYTES)
        self.split = split

        def make(unit: str) -> str | None:
            said = self.ids_of(unit)
            return said if self.decoder.block(b"", map(int, said.split())) == (b"", unit) else None

        super().__init__(make)

    def ids_of(self, unit: str) -> str:
        return " ".join(map(self.pieces.__getitem__, self.split.findall(unit)))

    def digests(self, text: str) -> tuple[int, str, str]:
        """The number of ids, and the digests of the ids and of what they decode to."""
        if not text:
            return 0, _NOTHING, _NOTHING
        found = self.of(text)
        if None in found:  # a character goes on in the next unit: decode all ids as one stream
            said = " ".join(map(self.ids_of, cut(text)))
            back = "".join(self.decoder.stream(map(int, said.split())))
        else:
            said, back = " ".join(found), text  # the units' texts, one after the other
        digest = hashlib.sha256
        return said.count(" ") + 1, digest(said.encode()).hexdigest(), digest(back.encode()).hexdigest()


_NOTHING = hashlib.sha256().hexdigest()


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids): the token ids of every text, null as an empty one. Narrow: no exchange."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = encoder(ranks_path, pattern)
        for batch in found:
            for part in slices(batch):
                ids = [units.ids(t) for t in part["text"].to_pylist()]
                flat = np.concatenate(ids).astype(np.int32) if ids else np.array([], np.int32)
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part["id"], pa.ListArray.from_arrays(ends, flat)], ["id", "ids"])

    return arrow_map(texts(docs, id_col, text_col), batches, "id bigint, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(id, text): the text of every list of ids, null as an empty one; an unknown id is an error."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = decoder(ranks_path)
        for batch in found:
            lines = ["".join(machine.stream(ids or ())) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(lines, pa.string())], ["id", "text"])

    return arrow_map(encoded.select("id", "ids"), batches, "id bigint, text string")


def digests(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encode every text, then decode the ids."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trips = per_worker("round trips", (ranks_path, pattern), lambda: RoundTrips(ranks_path, pattern))
        for batch in found:
            for part in slices(batch):
                rows = [trips.digests(text) for text in part["text"].to_pylist()]
                counts, said, back = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [part["id"], pa.array(counts, pa.int64()), pa.array(said, pa.string()), pa.array(back, pa.string())],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return arrow_map(texts(docs, id_col, text_col), batches, schema)
