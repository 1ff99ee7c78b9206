"""Byte-level BPE: exact merges in linear time by longest matches with backtracking, and decoding.

An encoding is right if and only if each two neighbouring tokens are what merging their joined
bytes would leave. An Aho-Corasick automaton gives the longest token that starts at each byte; the
encoder takes it, and where it does not go with the token before it, or leads to a place already
known to be a dead end, it tries the next shorter one, or takes the last token back. Each place is
given up at most once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from struct import pack

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The pattern that the vocabulary's pre-tokenizer splits by.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces (of so many code points at most) and token pairs a worker remembers before it starts anew.
REMEMBERED_PIECES, REMEMBERED_CHARS, REMEMBERED = 1 << 18, 64, 1 << 17
#: Tokens decoded at a time.
DECODED_AT_ONCE = 1 << 16


def byte_letters() -> dict[str, int]:
    """The letter by which vocabulary files write each byte: printable ones stand for themselves,
    the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tables of a byte-level BPE file (the content of a ``tokenizers`` JSON file)."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        model, letters = spec["model"], byte_letters()
        if model["type"] != "BPE" or spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        # Bytes are written as the 256 first code points, for the automaton's keys are strings.
        spell = lambda token: "".join(chr(letters[c]) for c in token)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.id_of = {spell(t): i for t, i in model["vocab"].items() if t not in self.special}
        size = 1 + max([*self.id_of.values(), *self.special.values()])
        self.text_of: list[str | None] = [None] * size
        for t, i in self.id_of.items():
            self.text_of[i] = t
        self.lengths = [len(t or "") for t in self.text_of]
        self.born = [-1] * size  # the rank of the merge that makes a token
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.merged: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (self.id_of[spell(x)] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            whole = self.id_of[self.text_of[a] + self.text_of[b]]
            self.merged[a, b] = rank
            self.parts[whole], self.born[whole] = (a, b), rank
        self.shorter: list[int | None] = [None] * size  # the longest token that begins a token
        self.automaton = ahocorasick.Automaton()
        for t, i in self.id_of.items():
            self.automaton.add_word(t, (len(t), i))
            self.shorter[i] = next((self.id_of[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.id_of), None)
        self.automaton.make_automaton()
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pieces = regex.compile(PIECES)
        spelled = [t.encode("latin-1") if t is not None else b"" for t in self.text_of]
        for t, i in self.special.items():
            spelled[i] = t.encode()
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in spelled])])
        self.octets = np.frombuffer(b"".join(spelled), np.uint8)
        self._goes: dict[tuple[int, int], bool] = {}
        self._known: dict[str, bytes] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' joined bytes leaves exactly these two.

        The pieces that meet at the seam are followed backwards in time. A merge across the seam
        happens if its turn comes before either piece is used up; of equal turns the left one is
        first, so it loses to the one that uses up the left piece and beats that of the right one.
        """
        found = self._goes.get((left, right))
        if found is None:
            if len(self._goes) >= REMEMBERED:
                self._goes.clear()
            found = self._goes[left, right] = self._stays_apart(left, right)
        return found

    def _stays_apart(self, left: int, right: int) -> bool:
        left_used = right_used = len(self.merged)
        while True:
            turn = self.merged.get((left, right))
            if turn is not None and turn < left_used and turn <= right_used:
                return False
            if self.born[left] > self.born[right]:
                left_used, left = self.born[left], self.parts[left][1]
            elif self.born[right] >= 0:
                right_used, right = self.born[right], self.parts[right][0]
            else:
                return True

    def merge(self, piece: str) -> list[int]:
        """Tokens of one pre-token, given as a string of bytes."""
        whole = self.id_of.get(piece)
        if whole is not None:  # the first try, with nothing before it to disagree
            return [whole]
        size, lengths, shorter, known = len(piece), self.lengths, self.shorter, self._goes
        longest: list[int] = [0] * size
        for end, (n, token) in self.automaton.iter(piece):
            longest[end - n + 1] = token  # ends ascend, so the last one is the longest
        dead, taken, at, token = set(), [], 0, longest[0]
        while at < size:
            end = at + lengths[token]
            fits = end not in dead
            if fits and taken:
                fits = known.get((taken[-1], token))
                if fits is None:
                    fits = self.compatible(taken[-1], token)
            if fits:
                taken.append(token)
                at = end
                if at < size:
                    token = longest[at]
            elif (less := shorter[token]) is not None:
                token = less
            else:
                dead.add(at)
                token = taken.pop()
                at -= lengths[token]
        return taken

    def forget(self) -> None:
        """Give back what was remembered; a Python worker lives on after its task."""
        self._known.clear()
        self._goes.clear()

    def _packed(self, piece: str) -> bytes:
        ids = self.merge(piece.encode("utf-8").decode("latin-1"))
        packed = pack(f"<{len(ids)}I", *ids)
        if len(piece) <= REMEMBERED_CHARS:
            if len(self._known) >= REMEMBERED_PIECES:
                self._known.clear()
            self._known[piece] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; special tokens in the text are found."""
        out: list[bytes] = []
        known = self._known
        for part in self.split_special.split(text or "") if self.split_special else [text or ""]:
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
                continue
            for m in self.pieces.finditer(part):
                piece = m[0]
                out.append(known.get(piece) or self._packed(piece))
        return b"".join(out)

    def decode(self, packed: bytes | None) -> str:
        """The text of packed ids; ids out of the vocabulary add nothing, broken UTF-8 is replaced."""
        ids = np.frombuffer(packed or b"", "<u4").astype(np.int64)
        ids = ids[ids < len(self.text_of)]
        out = []
        for at in range(0, len(ids), DECODED_AT_ONCE):
            part = ids[at : at + DECODED_AT_ONCE]
            n = self.offsets[part + 1] - self.offsets[part]
            ends = np.cumsum(n)
            out.append(self.octets[np.repeat(self.offsets[part] - (ends - n), n) + np.arange(int(n.sum()))].tobytes())
        return b"".join(out).decode("utf-8", "replace")


_loaded: dict[int, Vocabulary] = {}


def _vocabulary(content) -> Vocabulary:
    """Built once in each Python worker."""
    if content.id not in _loaded:
        _loaded.clear()
        _loaded[content.id] = Vocabulary(content.value)
    return _loaded[content.id]


class _Shared:
    """The vocabulary's file, read on the driver and broadcast (1.6 MB for 50,000 tokens)."""

    def __init__(self, spark, path: str) -> None:
        self.broadcast = spark.sparkContext.broadcast(open(path, encoding="utf-8").read())
        self.id = f"{path}:{id(self.broadcast)}"

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}

    @property
    def value(self) -> str:
        return self.broadcast.value


def encoder(spark, path: str):
    """A function from a text column to a binary column of its ids (little-endian, 32 bits)."""
    content = _Shared(spark, path)

    @F.pandas_udf("binary")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = _vocabulary(content)
        for texts in batches:
            yield pd.Series([vocabulary.encode(t) for t in texts], dtype=object)

    return encoded


def decoder(spark, path: str):
    """A function from a binary column of ids to the text column they spell."""
    content = _Shared(spark, path)

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = _vocabulary(content)
        for ids in batches:
            yield pd.Series([vocabulary.decode(x) for x in ids], dtype=object)

    return decoded


def round_trip(spark, path: str):
    """A function from a text column to ``struct<ids, decoded>``: both ways in one worker, which
    holds one copy of the vocabulary."""
    content = _Shared(spark, path)

    @F.pandas_udf("ids binary, decoded string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocabulary = _vocabulary(content)
        for texts in batches:
            ids = [vocabulary.encode(t) for t in texts]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series([vocabulary.decode(x) for x in ids], dtype=object)})
        _vocabulary(content).forget()

    return both


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` for every row of ``docs(doc_id, text, …)``.

    A map over the rows, without a shuffle. Null and empty texts have no ids and decode to the
    empty text; very long texts are encoded whole; repeated rows and null doc_ids stay as they are;
    an empty table gives no rows; other columns, whatever their names, are ignored.
    """
    both: Column = round_trip(docs.sparkSession, path)(docs["text"])
    out = docs.select("doc_id", both.alias("t"))
    return out.select("doc_id", (F.octet_length("t.ids") / 4).cast("long").alias("n_tokens"), "t.ids", "t.decoded")
