"""Fuzzy line dedup: MinHash of character shingles, banding, exact Jaccard, union-find.

Lines are normalised (lower case, white space runs to one space, trimmed). Equal ones are one node
from the start. Different ones that are alike in SHINGLE-character shingles (Jaccard SIMILAR or
more, counted exactly) are linked where a band of their MinHash signatures agrees, and of each
connected component of lines one place, the first, is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scarmap.llm.similar_sets import BLOCK, BLOCK_ELEMENTS, crowds, similar_components
from scarmap.llm.tables import column
from scarmap.shared import discard, written

#: Shorter lines (code points, normalised) stay where a caller of the functions names no other bound.
LEAST_CHARS = 40
#: The bound of the queries: every line that isn't empty takes part.
EVERY_LINE = 1
SHINGLE, SIMILAR = 10, 0.8
#: Two lines at SIMILAR agree in a band with probability 0.8 ** ROWS = 0.41, and in one or more of
#: the bands with 1 - 0.59 ** BANDS = 0.985; at 0.9 it is 0.9999.
BANDS, ROWS = 8, 4
#: Code points hashed at a time.
AT_ONCE = 1 << 18
#: Documents whose lines are taken out of a batch at a time.
ROWS_AT_ONCE = 256
#: A component of over one in so many lines is hot.
HOT = 2000
_SEEDS = np.random.default_rng(97).integers(1, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def normalised(line: str) -> str:
    return " ".join(line.lower().split())


def line_key(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    return h


def _run_hashes(points: np.ndarray) -> np.ndarray:
    """A hash of each run of SHINGLE (ten) code points: the polynomial of the run, built by doubling."""
    c, c2, c4 = (np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in (1, 2, 4))

    def joined(left: np.ndarray, by: np.uint64, right: np.ndarray) -> np.ndarray:
        out = left * by
        out += right
        return out

    h = points.astype(np.uint64)
    h += np.uint64(1)
    h2 = joined(h[:-1], c, h[1:])
    h = joined(h2[:-2], c2, h2[2:])
    h = joined(h[:-4], c4, h[4:])
    h = joined(h[:-2], c2, h2[8:])
    del h2
    return _mixed(h)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _minima(lines: list[str]) -> np.ndarray:
    """(lines, BANDS * ROWS): the smallest value in each hash order over a line's runs. The lines are
    hashed as one array; an order is the product with an odd number."""
    low = (_run_hashes(_points("".join(lines))) >> np.uint64(16)).astype(np.uint32)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.cumsum(lengths) - lengths
    bounds = np.stack([starts, starts + lengths - SHINGLE + 1], axis=1).ravel()[:-1]  # runs over an end are left out
    out, values = np.empty((len(lines), BANDS * ROWS), np.uint32), np.empty_like(low)
    for order in range(BANDS * ROWS):
        out[:, order] = np.minimum.reduceat(np.multiply(low, _SEEDS[order], out=values), bounds)[::2]
    return out


def band_keys(lines: list[str]) -> np.ndarray:
    """Keys (lines, BANDS) of normalised lines of SHINGLE code points or more. A line of over
    AT_ONCE code points is hashed in overlapping pieces."""
    pieces, of = [], []
    for i, line in enumerate(lines):
        for at in range(0, max(1, len(line) - SHINGLE + 1), AT_ONCE):
            pieces.append(line[at : at + AT_ONCE + SHINGLE - 1])
            of.append(i)
    least, lo, held = [], 0, 0
    for i, piece in enumerate(pieces):
        held += len(piece)
        if held >= AT_ONCE or i == len(pieces) - 1:
            least.append(_minima(pieces[lo : i + 1]))
            lo, held = i + 1, 0
    minima = np.concatenate(least) if least else np.zeros((0, BANDS * ROWS), np.uint32)
    if len(pieces) > len(lines):
        minima = np.minimum.reduceat(minima, np.flatnonzero(np.diff(of, prepend=-1)), axis=0)
    key = np.tile(np.arange(BANDS, dtype=np.uint64), (len(lines), 1))
    for row in range(ROWS):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + minima[:, row::ROWS])
    return key.view(np.int64)


def shingle_sets(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lines' shingles in one array, and how many each line has; a line shorter than
    a shingle is one."""
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    # a short line is stretched to one shingle that no line of its own length has
    whole = lines if not len(lines) or lengths.min() >= SHINGLE else [x if len(x) >= SHINGLE else x + "\0" * (SHINGLE - len(x)) for x in lines]
    sizes = np.maximum(lengths, SHINGLE)
    points = _points("".join(whole))
    if len(points) < SHINGLE:
        return np.zeros(0, np.uint64), np.zeros(len(lines), np.int64)
    ends = np.cumsum(sizes)
    inside = np.ones(len(points) - SHINGLE + 1, bool)  # runs over an end are left out
    for back in range(1, SHINGLE):
        inside[ends[:-1] - back] = False
    return _run_hashes(points)[inside], sizes - SHINGLE + 1


def rows_in_parts(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """The batch's rows as tuples; Python values are made for ROWS_AT_ONCE of them at a time."""
    for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(lo, ROWS_AT_ONCE)
        yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)


_PLACES = "doc_id long, row long, place int, line_id long, size int, keys array<long>"


def line_places(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``(doc_id, row, place, line_id, size, keys)`` of the lines that take part, of
    ``docs(doc_id, row, text)``. A line met again in a batch has null keys, so a very common line
    sends its keys on once a batch; one shorter than a shingle has none."""

    def rows_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at: list[list[int]] = [[] for _ in range(5)]
        counts: list[int] = []
        lines: list[str] = []
        known: set[int] = set()
        held = 0

        def flush() -> pa.RecordBatch:
            keys = band_keys(lines)
            offsets = np.concatenate([[0], np.cumsum(counts, dtype=np.int64) * BANDS])
            nulls = np.array(counts, bool) == 0
            columns = [pa.array(c, t) for c, t in zip(at, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()), strict=True)]
            columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.ravel()), mask=pa.array(nulls)))
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "place", "line_id", "size", "keys"])

        for doc_id, row, text in rows_in_parts(batch, "doc_id", "row", "text"):
            for place, line in enumerate((text or "").lower().split("\n")):
                line = " ".join(line.split())
                size = len(line)
                if size < least_chars:
                    continue
                key = line_key(line)
                new = size >= SHINGLE and key not in known  # shorter ones are one shingle, so only equal to their copies
                if new:
                    known.add(key)
                    lines.append(line)
                    held += size
                for c, v in zip(at, (doc_id, row, place, key, size), strict=True):
                    c.append(v)
                counts.append(new)
                if held >= 4 * AT_ONCE:
                    yield flush()
                    at, counts, lines, held = [[] for _ in range(5)], [], [], 0
        yield flush()

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from rows_of(batch)

    return docs.select("doc_id", "row", "text").mapInArrow(places, _PLACES)


def _texts(least_chars: int):
    """For mapInArrow over ``(text)``: each line and its key, once a batch; no more than about
    AT_ONCE code points of them are held."""

    def made(out: dict[int, str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(out.keys(), pa.int64()), pa.array(out.values(), pa.string())], ["line_id", "line"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: set[int] = set()
            out: dict[int, str] = {}
            held = 0
            for (text,) in rows_in_parts(batch, "text"):
                for line in (text or "").lower().split("\n"):
                    line = " ".join(line.split())
                    if len(line) < least_chars or (key := line_key(line)) in known:
                        continue
                    known.add(key)
                    out[key] = line
                    held += len(line)
                    if held >= AT_ONCE:
                        yield made(out)
                        out, held = {}, 0
            yield made(out)

    return texts


def lines_of(docs: DataFrame, wanted: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``(line_id, line)``: the normalised text of each line in ``wanted(line_id)``, once."""
    found = docs.select("text").mapInArrow(_texts(least_chars), "line_id long, line string")
    return found.join(wanted, "line_id", "left_semi").groupBy("line_id").agg(F.min("line").alias("line"))


def similar_lines(
    docs: DataFrame, places: DataFrame, similar: float = SIMILAR, least_chars: int = LEAST_CHARS, block: int = BLOCK, elements: int = BLOCK_ELEMENTS
) -> DataFrame:
    """``(node, component)`` of the lines linked to another, from the ``places`` of their keys: the
    components of all pairs that meet in a band, however large its bucket."""
    members = crowds(places.where("keys is not null").select(F.col("line_id").alias("id"), "size", "keys"))
    texts = written(lines_of(docs, members.select(F.col("id").alias("line_id")).distinct(), least_chars), "lines")
    out = similar_components(members, texts.select(F.col("line_id").alias("id"), F.col("line").alias("load")), shingle_sets, similar, block, elements)
    discard(members, texts)
    return out


def _dropped(docs: DataFrame, similar: float, least_chars: int) -> DataFrame:
    """``(doc_id, row, places)``: the places of lines that repeat an earlier one."""
    places = written(line_places(docs, least_chars), "places")
    components = similar_lines(docs, places, similar, least_chars)
    marked = places.join(components, places["line_id"] == components["node"], "left").select(
        "doc_id", "row", "place", F.coalesce("component", "line_id").alias("component")
    )
    spot = F.struct("doc_id", "row", "place")
    firsts = written(marked.groupBy("component").agg(F.min(spot).alias("kept"), F.count("*").alias("n")).where("n > 1"), "firsts")
    # No more than HOT components can hold over a HOT-th of the lines: these are broadcast, and their
    # lines, spread by a hash, meet no other component.
    hot = firsts.where(F.col("n") * HOT > places.count()).select(F.col("component").alias("_h"), F.col("kept").alias("_hot"))
    joined = marked.join(F.broadcast(hot), F.col("component") == F.col("_h"), "left")
    at = F.when(F.col("_h").isNotNull(), F.xxhash64("doc_id", "row", "place")).otherwise(F.col("component"))
    joined = joined.withColumn("_at", at).join(firsts.select(F.col("component").alias("_f"), "kept"), F.col("_at") == F.col("_f"), "left")
    first = F.coalesce("_hot", "kept")
    again = joined.where(first.isNotNull() & ~spot.eqNullSafe(first))
    out = written(again.groupBy("doc_id", "row").agg(F.collect_set("place").alias("places")), "dropped")
    discard(firsts)
    discard(places, components)
    return out


def dedup_lines(docs: DataFrame, similar: float = SIMILAR, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Every row of ``docs(doc_id, text, …)``, all columns, with the text rid of the lines that are
    copies or near copies of another, and last the columns n_lines and n_dropped.

    Of a component of lines the first place stays: smallest doc_id, then text hash, then place.
    Lines shorter than ``least_chars`` always stay, as does everything else of the text. Rows that
    repeat doc_id and text count as one document, and get the same text.

    Null texts stay null, with 0 lines; empty ones have one line, which is empty. Null doc_ids come
    first. An empty table gives no rows. Columns may have any names; n_lines and n_dropped of the
    input are replaced.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    others = F.struct(*[column(docs, c) for c in columns if c != "text"])  # texts go through the join once
    whole = docs.select(others.alias("r"), docs["doc_id"].alias("doc_id"), F.xxhash64(docs["text"]).alias("row"), docs["text"].alias("text"))
    drops = _dropped(whole.select("doc_id", "row", "text"), similar, least_chars)
    mine = drops.select(F.col("doc_id").alias("_d"), F.col("row").alias("_r"), "places")
    joined = whole.join(mine, whole["doc_id"].eqNullSafe(F.col("_d")) & (whole["row"] == F.col("_r")), "left")
    joined = joined.select("r", "places", "text", F.split("text", "\n").alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "places")
    kept = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    return joined.select(
        *[(F.when(F.col("places").isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col("r")[c].alias(c)) for c in columns],
        F.coalesce(F.size("lines"), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).alias("n_dropped"),
    )
