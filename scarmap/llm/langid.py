"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is bound by multiplying its letters'
vectors, permuted by two, one and no steps; a text bundles (adds) the vectors of its trigrams, and
a language the vectors of its training texts. A text is of the language of the highest cosine.
Bundling is linear and its sums are whole numbers, so tasks bundle what they read and their vectors
are added up, in any order to the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scarmap.shared import written

DIMS = 1024
#: Symbols: 0 is any run of other characters, then Latin letters by themselves, others in slots.
LATIN, SLOTS = 0x250, 64
#: Training texts of a language, about; those of the smallest hashes of doc_id.
TRAINED_ON = 1500
#: Label where there is nothing to go by.
UNDETERMINED = "und"
#: Code points counted at a time.
COUNTED_AT_ONCE = 1 << 18


@lru_cache(1)
def _symbols() -> tuple[np.ndarray, int]:
    """The symbol of each code point, and how many there are."""
    of = np.zeros(0x110000, np.int64)
    letters = np.fromiter((i for i in range(0x110000) if chr(i).isalpha()), np.int64)
    latin = letters[letters < LATIN]
    of[latin] = np.arange(1, len(latin) + 1)
    rest = letters[letters >= LATIN]
    of[rest] = len(latin) + 1 + rest % SLOTS
    return of, len(latin) + 1 + SLOTS


@lru_cache(1)
def _letter_vectors(dims: int = DIMS) -> np.ndarray:
    n = _symbols()[1]
    v = np.random.default_rng(20240229).integers(0, 2, (n, dims), dtype=np.int8) * 2 - 1
    return v.astype(np.float32)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Different trigrams, as numbers, and their counts; both empty where there is no letter."""
    of, n = _symbols()
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    parts = []
    carried = np.zeros(1, np.int64)  # a text begins after a gap, and ends with one
    for at in range(0, len(points), COUNTED_AT_ONCE):
        end = np.zeros(int(at + COUNTED_AT_ONCE >= len(points)), np.int64)
        s = np.concatenate([carried, of[points[at : at + COUNTED_AT_ONCE]], end])
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
        s = s[keep]
        parts.append(np.unique((s[:-2] * n + s[1:-1]) * n + s[2:], return_counts=True))
        carried = s[-2:]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(parts) == 1:
        grams, counts = parts[0]
    else:
        grams, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([c for _, c in parts])).astype(np.int64)
    lettered = grams % n + grams // n % n > 0
    return grams[lettered], counts[lettered]


def bundle(grams: np.ndarray, counts: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """The sum of the bound vectors, each as often as counted; exact, for all are whole numbers."""
    n, v = _symbols()[1], _letter_vectors(dims)
    out = np.zeros(dims, np.float64)
    for at in range(0, len(grams), 4096):
        g, c = grams[at : at + 4096], counts[at : at + 4096].astype(np.float64)
        bound = np.roll(v[g // (n * n)], 2, axis=1) * np.roll(v[g // n % n], 1, axis=1) * v[g % n]
        out += c @ bound
    return out


class Bound:
    """Bound vectors of the trigrams met lately, kept as one table of bytes."""

    def __init__(self, dims: int = DIMS, kept: int = 1 << 15) -> None:
        self.table = np.zeros((kept, dims), np.int8)
        self.at: dict[int, int] = {}
        self.dims = dims

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if len(grams) > len(self.table):
            return bundle(grams, counts, self.dims)
        known = self.at
        rows = [known.get(g, -1) for g in grams.tolist()]
        new = [g for g, r in zip(grams.tolist(), rows, strict=True) if r < 0]
        if new:
            if len(known) + len(new) > len(self.table):
                known.clear()
                new = grams.tolist()
            n, v = _symbols()[1], _letter_vectors(self.dims)
            g = np.array(new)
            first = len(known)
            for lo in range(0, len(g), 4096):
                part = g[lo : lo + 4096]
                vec = np.roll(v[part // (n * n)], 2, axis=1) * np.roll(v[part // n % n], 1, axis=1) * v[part % n]
                self.table[first + lo : first + lo + len(part)] = vec
            known.update(zip(new, range(first, first + len(new)), strict=True))
            rows = [known[x] for x in grams.tolist()]
        return counts.astype(np.float32) @ self.table[rows].astype(np.float32)


def training_sample(docs: DataFrame, label: str, most: int) -> DataFrame:
    """About ``most`` rows of each label (all, where there are fewer): those whose hash of doc_id
    is within that share of the hash range.

    Labels are counted first, one row each; the share is then a filter where the texts are read,
    so a label with a third of all rows is no large group and no text is shuffled.
    """
    labelled = docs.where(F.col(label).isNotNull()).select("doc_id", "text", label)
    shares = labelled.groupBy(label).agg(F.count("*").alias("_n")).select(F.col(label).alias("_label"), (F.lit(float(most)) / F.col("_n")).alias("_share"))
    at = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    joined = labelled.join(written(shares, "labels"), F.col(label) == F.col("_label"))
    return joined.where(at < F.col("_share")).select("doc_id", "text", label)


def train_profiles(docs: DataFrame, label: str = "lang", most: int = TRAINED_ON, dims: int = DIMS) -> tuple[list[str], np.ndarray]:
    """Labels and their unit vectors, learned from a bounded sample of ``docs(doc_id, text, label)``.

    Each task bundles the texts of a label into one vector; these are added up by label and
    dimension. What reaches the driver is one vector a label, however many documents or different
    trigrams there are. A text weighs by the letters it has.
    """
    sample = training_sample(docs, label, most)

    def bundled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, texts in batch.groupby("label")["text"]:
                parts = [trigrams(t) for t in texts]
                grams, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                counts = np.bincount(back, np.concatenate([c for _, c in parts]), len(grams))
                total[name] = total.get(name, 0) + bundle(grams, counts, dims)
        names = list(total)
        yield pd.DataFrame({"label": pd.Series(names, dtype=object), "vector": pd.Series([total[n].astype(np.int64) for n in names], dtype=object)})

    vectors = sample.select("text", F.col(label).alias("label")).mapInPandas(bundled, "label string, vector array<long>")
    sums = vectors.select("label", F.posexplode("vector").alias("at", "v")).groupBy("label", "at").agg(F.sum("v").alias("v"))
    rows = sums.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("vector"))
    labels, profiles = [], []
    for r in sorted(rows.collect(), key=lambda r: r["label"]):
        vector = np.array(r["vector"], float)
        if norm := float(np.linalg.norm(vector)):
            labels.append(r["label"])
            profiles.append(vector / norm)
    return labels, np.array(profiles, np.float32).reshape(len(labels), dims)


def predictor(labels: list[str], profiles: np.ndarray):
    """A function from a text column to ``struct<lang_pred string, score double>``."""

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bound = Bound(profiles.shape[1])
        for texts in batches:
            names, scores = [], []
            for text in texts:
                grams, counts = trigrams(text)
                if not len(grams) or not labels:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                vector = bound.bundle(grams, counts)
                cosines = profiles @ vector / max(float(np.linalg.norm(vector)), 1e-9)
                best = int(np.argmax(cosines))
                names.append(labels[best])
                scores.append(min(1.0, max(0.0, float(cosines[best]))))
            yield pd.DataFrame({"lang_pred": names, "score": np.array(scores, float)})

    return predicted


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def language_id(docs: DataFrame, label: str = "lang", most: int = TRAINED_ON) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row of ``docs(doc_id, text, lang, …)``.

    Profiles are learned from labelled documents that are not held out; prediction looks at the
    whole text and nothing else. score is the cosine with the best profile, 0 at least.

    Null texts, and texts without a letter, are ``und`` with score 0, as are all texts where
    nothing was learned (an empty table, no label). Rows with a null label are never trained on. A
    null doc_id is not held out. Repeated rows are predicted alike; other columns are ignored.
    Labels of equal cosine: the one that sorts first.
    """
    labels, profiles = train_profiles(docs.where(~held_out(docs["doc_id"])), label, most)
    out = docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), predictor(labels, profiles)(docs["text"]).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")
