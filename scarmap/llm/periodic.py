"""Periodic runs of words, found lag by lag on bit planes.

A text's different words are numbered, and each bit of the numbers is one big integer with a bit
for each word's place. Shifted by a lag and XORed with themselves, the planes show by their OR which
words differ from those a lag further on. Doubling shifts, ANDed, leave of the other places those
where a long enough stretch of agreement begins: q fewer words than a run of period q.

Every lag up to a quarter of the text is tried. After a few planes most lags have no stretch left,
which two or three doublings show; and a lag above :data:`DENSE` is only tried where some aligned
block of words, shorter than the lag, comes again at that lag, which every run of that period holds.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: A run is so many periods long at least, and so many words.
LEAST_PERIODS, LEAST_WORDS = 4, 6
#: Lags up to which all are tried.
DENSE = 64
#: Planes looked at before a first try to rule a lag out.
FIRST_PLANES = 3
#: Characters of texts whose results are handed on together.
CHARS_AT_ONCE = 1 << 20


def _planes(ids: np.ndarray) -> list[int]:
    """One big integer for each bit of the ids, lowest first; the bit of a place stands for a word."""
    bits = max(1, int(ids.max()).bit_length())
    return [int.from_bytes(np.packbits(ids >> k & 1, bitorder="little").tobytes(), "little") for k in range(bits)]


def _stretches(zeros: int, least: int) -> int:
    """The places at which ``least`` set bits in a row begin."""
    have = 1
    while have < least and zeros:
        step = min(have, least - have)
        zeros &= zeros >> step
        have += step
    return zeros


def _places(x: int) -> np.ndarray:
    """Where a number has set bits, ascending."""
    octets = np.frombuffer(x.to_bytes((x.bit_length() + 7) // 8, "little"), np.uint8)
    near = np.flatnonzero(octets)
    at, bit = np.nonzero(np.unpackbits(octets[near, None], axis=1, bitorder="little"))
    return near[at] * 8 + bit


def _lags(ids: np.ndarray, found: list[tuple[int, int, int]]) -> Iterator[int]:
    """Ascending lags at which a run may repeat; found: the runs of smaller periods so far.

    A run of a period q in [Q, 2Q) is 4Q words long at least, so among its first 2Q words there is
    a whole block of Q words that begins at a multiple of Q, and q further on the block comes again
    in the run. Blocks are told apart by hashes of Q words: equal blocks have equal hashes.

    Where a run of a period under Q holds both blocks, it overlaps any run of period q there by more
    than the two periods, so that one would have the smaller period as well: nothing to find there.
    """
    n, most = len(ids), len(ids) // LEAST_PERIODS
    yield from range(1, min(DENSE, most + 1))
    size, base = 1, 0x9E3779B97F4A7C15
    hashes = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    while size <= most:
        if size >= DENSE:
            starts = np.arange(0, n - 2 * size + 1, size)
            seen, reach = np.zeros(size, bool), np.zeros(n, np.int64)
            for start, length, _ in found:
                reach[start] = max(reach[start], start + length)
            reach = np.maximum.accumulate(reach)
            for lo in range(0, len(starts), max(1, (1 << 20) // size)):
                part = starts[lo : lo + max(1, (1 << 20) // size)]
                at = part[:, None] + np.arange(size, 2 * size)
                there = (at < len(hashes)) & (at + size > reach[part][:, None])
                seen |= ((hashes[np.minimum(at, len(hashes) - 1)] == hashes[part][:, None]) & there).any(axis=0)
            yield from (size + np.flatnonzero(seen[: most + 1 - size])).tolist()
        hashes = hashes[:-size] * np.uint64(base) + hashes[size:] if len(hashes) > size else hashes[:0]
        base, size = base * base % (1 << 64), 2 * size


def find_runs(words: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and then period.

    A run has a smallest period q, is max(6, 4q) words long or longer, and no word beside it keeps
    the period.
    """
    n = len(words)
    if n < LEAST_WORDS:
        return []
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    planes, out, ranges = _planes(ids), [], set()
    for q in _lags(ids, out):
        least = max(LEAST_WORDS, LEAST_PERIODS * q) - q
        same = (1 << (n - q)) - 1
        for lo, hi in ((0, FIRST_PLANES), (FIRST_PLANES, len(planes))):
            differ = 0
            for p in planes[lo:hi]:
                differ |= p ^ p >> q
            same &= ~differ
            begins = _stretches(same, least)
            if not begins:
                break
        if begins:
            firsts, lasts = _places(begins & ~(begins << 1)), _places(begins & ~(begins >> 1))
            for start, end in zip(firsts.tolist(), (lasts + least + q).tolist(), strict=True):
                # What has a smaller period as well was found as a run of that period, with the same ends.
                if (start, end) not in ranges:
                    ranges.add((start, end))
                    out.append((start, end - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    starts = np.array([(s + q, s + length) for s, length, q in runs])
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts[:, 0], 1)
    np.add.at(change, starts[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, changed: Callable[[int | None, list[str]], list[str]] | None = None) -> DataFrame:
    """``(doc_id, runs, collapsed)`` for every row of ``docs(doc_id, text, …)``: the runs, as
    ``array<struct<start long, length long, period long>>`` by start and period, and the text with
    each run cut back to its first period, words joined by one space. ``changed``, if given, gives the
    words to look at for a doc_id and its words.

    A map over the rows. Words are whatever stands between ASCII white space. Null and empty texts
    have no runs and collapse to the empty text. Texts of any length are taken whole. Repeated rows
    and null ids stay as they are; an empty table gives no rows; other columns are ignored.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, runs, collapsed, held = [], [], [], 0
            for i in range(batch.num_rows):
                doc_id, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py() or ""
                words = WORDS.findall(text)
                words = changed(doc_id, words) if changed else words
                r = find_runs(words)
                ids.append(doc_id)
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in r])
                collapsed.append(" ".join(kept_words(words, r)))
                held += len(text)
                if held >= CHARS_AT_ONCE or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(runs, pa.list_(run)), pa.array(collapsed, pa.string())], ["doc_id", "runs", "collapsed"])
                    ids, runs, collapsed, held = [], [], [], 0

    kind = dict(docs.dtypes)["doc_id"]
    plain = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    return plain.mapInArrow(found, f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def planted_runs(doc_id: int | None, words: list[str]) -> list[str]:
    """The words of a document, a tenth of them with a repeated part.

    h is the crc32 of doc_id as text. Where h is a multiple of 10 and there are n > 0 words, those
    from place a = g % n on, g = h // 10, repeat the p = 1 + (n - a) // (3 + g % 8) words that begin
    there. Others, and those of a null doc_id, stay."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def run_digest(found: DataFrame) -> DataFrame:
    """Of each row of :func:`periodic_runs`: the number of runs, the longest one (ties: the smallest
    start, then period; nulls where there is none), and digests of the runs and of the text left."""
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
