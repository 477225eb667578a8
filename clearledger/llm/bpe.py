"""Byte-level BPE encoding by backtracking, and decoding by an offset table.

Encoding a pretoken takes the longest vocabulary entry at each place (found by an Aho-Corasick
automaton), keeps it if it and the token before are compatible, else tries a shorter one, else
steps back. Two tokens are compatible if merging their joined bytes gives just these two; with
only compatible neighbours the result is what the merge rules give. Places that failed are
remembered, so the work is linear in the pretoken's length. Of the tokens that begin at a place
only the longest is kept; the next shorter one follows from a table of each token's longest proper
prefix that is a token.

Texts are taken whole; a null text is an empty one. Ids are packed as little-endian unsigned
32-bit integers. The vocabulary file is read once on the driver and broadcast: its size is that of
a tokenizer, whatever the corpus. Rows are independent, so a lost executor costs its own tasks. A
task builds its own vocabulary and drops it with all it remembers when it ends. Columns other than
those named pass through; one named like an added column is replaced.
"""

from __future__ import annotations

import json
import struct
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearledger.llm.workers import with_columns

#: The pretoken pattern of byte-level tokenizers (a fixed value).
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct pretokens, and pairs of tokens, that a task remembers (some 50 MB together); others
#: are worked out again when they come again.
REMEMBERED = 150_000
#: Bytes of text, or of ids, worked on at once.
SLICE_BYTES = 1 << 21
LATE = 1 << 40


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself if printable, else one
    from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level tokenizer file; without ``encodes`` only
    what decoding needs."""

    def __init__(self, source: str, encodes: bool = True):
        data = json.loads(source)
        letters = byte_letters()
        spelled = lambda s: bytes(letters[c] for c in s)
        ids = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.token = [b""] * size
        for name, i in ids.items():
            if name not in self.special:
                self.token[i] = spelled(name)
        for name, i in self.special.items():
            self.token[i] = name.encode()
        self.offsets = np.zeros(size + 1, np.int64)
        np.cumsum([len(t) for t in self.token], out=self.offsets[1:])
        self.blob = np.frombuffer(b"".join(self.token), np.uint8)
        if not encodes:
            return
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, made = ids[left], ids[right], ids[left + right]
            self.pairs[a, b] = (rank, made)
            self.halves.setdefault(made, (rank, a, b))
        self._fitting: dict[int, bool] = {}
        self.find = ahocorasick.Automaton()
        special = set(self.special.values())
        self.whole: dict[bytes, int] = {t: i for i, t in enumerate(self.token) if t and i not in special}
        self.lengths = [len(t) for t in self.token]
        self.shorter = [-1] * size
        for t, i in self.whole.items():
            self.find.add_word(t.decode("latin-1"), (len(t), i))
            self.shorter[i] = next((self.whole[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.whole), -1)
        self.find.make_automaton()
        names = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.pretoken = regex.compile(PRETOKEN)
        self.packed = _Packed(self)

    def _spine(self, token: int, half: int) -> list[tuple[int, int, int]]:
        """Parts of a token at its left (1) or right (2) edge: (part, made at, taken up at)."""
        out, until = [], LATE
        while token in self.halves:
            made = self.halves[token]
            out.append((token, made[0], until))
            token, until = made[half], made[0]
        return [*out, (token, -1, until)]

    def fit(self, a: int, b: int) -> bool:
        """Whether no merge would ever join the end of a with the beginning of b.

        A merge across the border happens if both parts exist at its rank and neither has been
        taken up before; at equal rank the leftmost pair goes first."""
        known = self._fitting.get(a << 32 | b)
        if known is not None:
            return known
        good = True
        begins = self._spine(b, 1)
        for x, x_made, x_until in self._spine(a, 2):
            for y, y_made, y_until in begins:
                pair = self.pairs.get((x, y))
                if pair and max(x_made, y_made) < pair[0] < x_until and pair[0] <= y_until:
                    good = False
        if len(self._fitting) < REMEMBERED:
            self._fitting[a << 32 | b] = good
        return good

    def longest(self, text: str) -> list[int]:
        """The longest token that begins at each place, -1 if none does (the automaton reports by
        end, so for one beginning longer tokens come later)."""
        at = [-1] * len(text)
        for end, (length, token) in self.find.iter(text):
            at[end - length + 1] = token
        return at

    def encode_pretoken(self, raw: bytes) -> list[int]:
        whole = self.whole.get(raw)
        if whole is not None:
            return [whole]
        at, lengths, shorter, fit = self.longest(raw.decode("latin-1")), self.lengths, self.shorter, self.fit
        good, out, place, size = bytearray(b"\1") * (len(raw) + 1), [], 0, len(raw)
        while place < size:
            token = at[place]
            while token >= 0 and not (good[place + lengths[token]] and (not out or fit(out[-1], token))):
                token = shorter[token]  # a longer one will not fit later either: what follows it has failed
            at[place] = token
            if token >= 0:
                out.append(token)
                place += lengths[token]
            elif out:
                good[place] = 0
                place -= lengths[out.pop()]
            else:
                raise ValueError(f"bytes without a token: {raw[:8]!r}")
        return out

    def encode(self, text: str) -> bytes:
        """Packed ids of a text; strings of special tokens become those tokens."""
        packed = self.packed.__getitem__
        if self.split is None or not any(s in text for s in self.special):
            return b"".join(map(packed, self.pretoken.findall(text)))
        out = []
        for part in self.split.split(text):
            if part in self.special:
                out.append(struct.pack("<I", self.special[part]))
            elif part:
                out.extend(map(packed, self.pretoken.findall(part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of packed ids: stretches of the joined vocabulary, gathered at once."""
        token = np.frombuffer(ids, "<u4")
        begin = self.offsets[token]
        length = self.offsets[token + 1] - begin
        to = np.cumsum(length)
        total = int(to[-1]) if len(to) else 0
        return self.blob[np.repeat(begin - (to - length), length) + np.arange(total)].tobytes()


class _Packed(dict):
    """Packed ids by pretoken, worked out when first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, pretoken: str) -> bytes:
        ids = self.vocabulary.encode_pretoken(pretoken.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) < REMEMBERED and len(pretoken) <= 64:
            self[pretoken] = packed
        return packed


def _texts(column: pa.Array) -> list[str]:
    return [(b or b"").decode("utf-8", "replace") for b in column.cast(pa.large_binary()).to_pylist()]


def _coded(df: DataFrame, tokenizer: str, column: str, added: str, encodes: bool, work) -> DataFrame:
    """Add columns made by work(vocabulary, column); the vocabulary is the task's own."""
    source = df.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text())
    place = df.columns.index(column)

    def start():
        vocabulary = Vocabulary(source.value, encodes)
        return lambda batch: work(vocabulary, batch.column(place))

    return with_columns(df, added, start, SLICE_BYTES, column)


def _packed_ids(vocabulary: Vocabulary, texts: pa.Array) -> pa.Array:
    return pa.array([vocabulary.encode(t) for t in _texts(texts)], pa.binary())


def _said(vocabulary: Vocabulary, ids: pa.Array) -> pa.Array:
    said = [vocabulary.decode(b or b"").decode("utf-8", "replace") for b in ids.to_pylist()]
    return pa.array(said, pa.string())


def encode(df: DataFrame, tokenizer: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Add the packed ids of a text column (in place of a column of that name).

    ``tokenizer`` is the path of a byte-level tokenizer file, read on the driver."""
    return _coded(df, tokenizer, text, f"`{into}` binary", True, lambda v, texts: [_packed_ids(v, texts)])


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the text of packed ids; bytes that are not UTF-8 become U+FFFD, null ids an empty text."""
    return _coded(df, tokenizer, ids, f"`{into}` string", False, lambda v, packed: [_said(v, packed)])


def encode_and_decode(
    df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """Add the packed ids of a text column and the text these ids decode to; each text is encoded
    once, and both directions share a vocabulary."""

    def both(vocabulary, texts):
        packed = _packed_ids(vocabulary, texts)
        return [packed, _said(vocabulary, packed)]

    return _coded(df, tokenizer, text, f"`{ids}` binary, `{decoded}` string", True, both)


def n_tokens(ids: Column) -> Column:
    """How many ids are packed."""
    return F.floor(F.octet_length(ids) / 4).cast("long")
