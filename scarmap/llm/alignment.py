"""Cross-tokenizer alignment: tokens of two vocabularies linked through the byte ranges they share.

A text's places where tokens of both sides end cut it into groups, and every token of one side is
linked with every one of the other side in its group. How good a link is follows from how many
documents of the corpus hold the pair of ids linked.

Ids of the left side are dealt into stripes. In a stripe the document counts of all pairs are one
dense matrix, to which ``np.add.at`` adds what the tasks have counted; the maxima of its rows are
the best partners. Documents are encoded once, in chunks; a chunk asks each stripe for the pairs it
holds, and what comes back is partitioned like the chunks' links, so a document is scored where its
links are. No exchange has a row for each link, and none is dealt by an id alone: a frequent id is
one cell of a chunk, however many documents hold it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scarmap.llm.bpe import PIECES, byte_letters
from scarmap.shared import written

#: Rows of a stripe's matrix.
STRIPE_ROWS = 128
#: Links (different pairs of a document) and documents of a chunk, at most, but for a longer document.
CHUNK_LINKS, CHUNK_DOCS = 1 << 19, 1 << 14
#: Characters encoded and aligned at a time, but for a longer document.
CHARS_AT_ONCE = 1 << 18
#: Link occurrences of a group that are counted one by one; larger groups are counted by different ids.
FEW_LINKS = 64

#: The mark that stands for a space in the pieces of the right side.
_SPACE = "▁"


class Octets:
    """What the tokens of a vocabulary spell, as one table."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.table = np.frombuffer(b"".join(tokens), np.uint8)

    def of(self, ids: np.ndarray) -> bytes:
        n = self.lengths[ids]
        return self.table[np.repeat(self.starts[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))].tobytes()


class Tokenizers:
    """Both sides, and what each of their tokens spells."""

    def __init__(self, left: str, right: bytes) -> None:
        import sentencepiece
        import tiktoken

        spec, letters = json.loads(left), byte_letters()
        special = {t["content"] for t in spec.get("added_tokens", [])}
        spell = lambda token: bytes(letters[c] for c in token)
        ids = {spell(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        made = [ids[spell("".join(m.split(" ") if isinstance(m, str) else m))] for m in spec["model"]["merges"]]
        if spec["model"]["type"] != "BPE" or made != sorted(made):
            raise ValueError("not a byte-level BPE vocabulary whose ids rise with its merges")
        self.left = tiktoken.Encoding("left", pat_str=PIECES, mergeable_ranks=ids, special_tokens={})
        self.left_bytes = [b""] * (1 + max(ids.values()))
        for token, i in ids.items():
            self.left_bytes[i] = token
        self.right = sentencepiece.SentencePieceProcessor(model_proto=right)
        self.right_bytes = []
        for i in range(self.right.vocab_size()):
            piece = self.right.id_to_piece(i)
            self.right_bytes.append(bytes([int(piece[3:5], 16)]) if self.right.is_byte(i) else piece.replace(_SPACE, " ").encode())
        self.right_size = len(self.right_bytes)
        self.left_octets, self.right_octets = Octets(self.left_bytes), Octets(self.right_bytes)
        self.left_lengths, self.right_lengths = self.left_octets.lengths, self.right_octets.lengths
        # How a token is spelled in the digest: by what follows it, another of its side or not.
        self.spelled = [f"{i}{c}" for i in range(len(self.left_bytes)) for c in ",|"] + [f"{i}{c}" for i in range(self.right_size) for c in ",;"]

    def documents(self, texts: list[str | None]) -> list[tuple[np.ndarray, str, np.ndarray, np.ndarray]]:
        """Of each text: numbers of left tokens, right tokens, groups and links; the digest;
        different pairs, and how often each is linked. All empty where a text has no tokens."""
        none = np.zeros(0, np.int64)
        both = [(self.left.encode_to_numpy(" " + t, disallowed_special=()), np.array(r, np.int64)) if t else (none, none) for t, r in zip(texts, self.right.encode([t or "" for t in texts], num_threads=1), strict=True)]
        for i, (t, (left, right)) in enumerate(zip(texts, both, strict=True)):
            if t and not self.left_octets.of(left) == self.right_octets.of(right) == b" " + t.encode():
                both[i] = none, none
        return self._aligned(*(np.concatenate([none, *[x[i] for x in both]]).astype(np.int64) for i in (0, 1)), [(len(x), len(y)) for x, y in both])

    def _aligned(self, a: np.ndarray, b: np.ndarray, sizes: list[tuple[int, int]]) -> list[tuple[np.ndarray, str, np.ndarray, np.ndarray]]:
        """a, b: tokens of some documents, one after the other; both sides end together with each."""
        ends_a, ends_b = np.cumsum(self.left_lengths[a]), np.cumsum(self.right_lengths[b])
        last_a, last_b = np.zeros((2, 1 + (int(ends_a[-1]) if len(a) else 0)), bool)
        last_b[ends_a], last_a[ends_b] = True, True
        last_a, last_b = last_a[ends_a], last_b[ends_b]  # the last one of its group
        of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        n = int(last_a.sum())
        in_a, in_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        links = in_a * in_b
        from_a, from_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        # Links of groups that are not large, one by one; where a document's begin.
        each = np.where(links <= FEW_LINKS, in_b, 0)[of_a]
        x = np.repeat(np.arange(len(a)), each)
        nth = np.arange(len(x)) - np.repeat(np.cumsum(each) - each, each)
        codes = a[x] << 32 | b[from_b[of_a[x]] + nth]
        at_a, at_b = (np.concatenate([[0], np.cumsum([s[i] for s in sizes], dtype=np.int64)]) for i in (0, 1))
        at_code = np.concatenate([[0], np.cumsum(each)])[at_a]
        at_group = np.concatenate([[0], np.cumsum(last_a)])[at_a]
        all_links = np.concatenate([[0], np.cumsum(links)])[at_group]
        large = np.flatnonzero(links > FEW_LINKS)
        at_large = np.searchsorted(large, at_group)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + from_b[of_a]] = 2 * a + last_a
        order[np.arange(len(b)) + (from_a + in_a)[of_b]] = 2 * (len(self.left_bytes) + b) + last_b
        out = []
        for d, (n_a, n_b) in enumerate(sizes):
            if not n_a:
                out.append((np.zeros(4, np.int64), "", np.zeros(0, np.int64), np.zeros(0, np.int64)))
                continue
            pairs, often = np.unique(codes[at_code[d] : at_code[d + 1]], return_counts=True)
            for g in large[at_large[d] : at_large[d + 1]].tolist():
                (i, n_i), (j, n_j) = (np.unique(v[f[g] : f[g] + m[g]], return_counts=True) for v, f, m in ((a, from_a, in_a), (b, from_b, in_b)))
                pairs, back = np.unique(np.concatenate([pairs, (i[:, None] << 32 | j).ravel()]), return_inverse=True)
                often = np.bincount(back, np.concatenate([often, np.outer(n_i, n_j).ravel()])).astype(np.int64)
            text = "".join([self.spelled[c] for c in order[at_a[d] + at_b[d] : at_a[d + 1] + at_b[d + 1]].tolist()])[:-1]
            stats = np.array([n_a, n_b, at_group[d + 1] - at_group[d], all_links[d + 1] - all_links[d]], np.int64)
            out.append((stats, sha256(text.encode()).hexdigest(), pairs, often))
        return out


_loaded: dict[int, Tokenizers] = {}


def _tokenizers(files) -> Tokenizers:
    """Built once in each Python worker, from the broadcast contents of the two files."""
    if files.id not in _loaded:
        _loaded.clear()
        _loaded[files.id] = Tokenizers(*files.value)
    return _loaded[files.id]


class _Files:
    """The two vocabularies' files (some MB), read on the driver and broadcast."""

    def __init__(self, spark, left: str, right: str) -> None:
        with open(left, encoding="utf-8") as a, open(right, "rb") as b:
            self.broadcast = spark.sparkContext.broadcast((a.read(), b.read()))
        self.id = f"{left}:{right}:{id(self.broadcast)}"

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}

    @property
    def value(self) -> tuple[str, bytes]:
        return self.broadcast.value


def packed(x: np.ndarray) -> bytes:
    """Numbers of 0 and more in as few bytes each as the largest one takes."""
    most = int(x.max()) if len(x) else 0
    return x.astype(next(f"<u{n}" for n in (1, 2, 4, 8) if most < 1 << 8 * n)).tobytes()


def unpacked(x: bytes, n: int) -> np.ndarray:
    return np.frombuffer(x, f"<u{len(x) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


#: One row a chunk. Documents: ids, the four counts and digests. Pairs that the chunk holds: both
#: ids, and in how many of its documents (all packed). Links: how many pairs each document holds,
#: which, and how often (packed).
_CHUNK = pa.schema(
    [("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("stats", pa.binary()), ("digests", pa.list_(pa.string()))]
    + [("n_pairs", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("docs", pa.binary())]
    + [("n_links", pa.int64()), ("held", pa.binary()), ("which", pa.binary()), ("often", pa.binary())]
)
_CHUNK_SQL = "chunk long, doc_ids array<long>, stats binary, digests array<string>, n_pairs long, a binary, b binary, docs binary, n_links long, held binary, which binary, often binary"
#: What a chunk asks of a stripe, and a stripe's counts: pairs of both ids, with a number and a flag each.
_PAIRS_SQL = "stripe int, chunk long, n_pairs long, a binary, b binary, docs binary, best binary"
_PAIRS = pa.schema([("stripe", pa.int32()), ("chunk", pa.int64()), ("n_pairs", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("docs", pa.binary()), ("best", pa.binary())])
#: The chunk of a stripe's own counts; they sort before all questions.
_COUNTS = -1


def _chunk_row(number: int, held: list[tuple]) -> pa.RecordBatch:
    """held: (doc_id, stats, digest, pairs, often) of each document."""
    all_pairs = np.concatenate([x[3] for x in held])
    pairs, which = np.unique(all_pairs, return_inverse=True)
    row = {
        "chunk": number, "doc_ids": [x[0] for x in held], "stats": np.concatenate([x[1] for x in held]).tobytes(), "digests": [x[2] for x in held],
        "n_pairs": len(pairs), "a": packed(pairs >> 32), "b": packed(pairs & 0xFFFFFFFF), "docs": packed(np.bincount(which, minlength=len(pairs))),
        "n_links": len(which), "held": packed(np.array([len(x[3]) for x in held])), "which": packed(which), "often": packed(np.concatenate([x[4] for x in held])),
    }
    return pa.RecordBatch.from_pylist([row], _CHUNK)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """Ids and texts of a batch, some characters at a time."""
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
        ids.append(doc_id.as_py())
        texts.append(text.as_py())
        held += len(texts[-1] or "")
        if held >= CHARS_AT_ONCE:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def encoded_chunks(docs: DataFrame, left: str, right: str, chunk_links: int = CHUNK_LINKS, chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """The documents, encoded and aligned, as rows of ``_CHUNK``; a map over ``docs(doc_id, text)``."""
    files = _Files(docs.sparkSession, left, right)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _tokenizers(files)
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        held, links = [], 0
        for batch in batches:
            for ids, texts in _parts(batch):
                for doc_id, found in zip(ids, both.documents(texts), strict=True):
                    held.append((doc_id, *found))
                    links += len(found[2])
                    if links >= chunk_links or len(held) >= chunk_docs:
                        yield _chunk_row(number, held)
                        number, held, links = number + 1, [], 0
        if held:
            yield _chunk_row(number, held)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(chunks, _CHUNK_SQL)


def _questions(chunks: DataFrame, n_stripes: int) -> DataFrame:
    """What each chunk holds of each stripe, in the order in which the chunk has its pairs."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n_pairs"]
                a, b, docs = (unpacked(row[k], n) for k in ("a", "b", "docs"))
                stripe = a % n_stripes
                order = np.argsort(stripe, kind="stable")
                cuts = np.flatnonzero(np.diff(stripe[order], prepend=-1, append=-1)).tolist()
                out = [
                    {"stripe": int(stripe[at[0]]), "chunk": row["chunk"], "n_pairs": len(at), "a": packed(a[at]), "b": packed(b[at]), "docs": packed(docs[at]), "best": None}
                    for at in (order[lo:hi] for lo, hi in zip(cuts[:-1], cuts[1:], strict=True))
                ]
                if out:
                    yield pa.RecordBatch.from_pylist(out, _PAIRS)

    return chunks.select("chunk", "n_pairs", "a", "b", "docs").mapInArrow(asked, _PAIRS_SQL)


def _by_stripe(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def pair_counts(questions: DataFrame, n_stripes: int, right_size: int) -> DataFrame:
    """In how many documents each pair of ids is linked, and whether no partner of its left id is
    in more: rows of ``_PAIRS_SQL``, chunk ``_COUNTS``, some for a stripe.

    A task holds one stripe's matrix at a time.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, now = np.zeros((STRIPE_ROWS, right_size), np.int64), None

        def result() -> Iterator[pa.RecordBatch]:
            most = matrix.max(axis=1)
            for lo in range(0, STRIPE_ROWS, 16):  # a row is 16 lines of the matrix
                x, b = np.nonzero(matrix[lo : lo + 16])
                n = matrix[lo + x, b]
                if len(n):
                    yield pa.RecordBatch.from_pylist([{"stripe": now, "chunk": _COUNTS, "n_pairs": len(n), "a": packed((lo + x) * n_stripes + now), "b": packed(b), "docs": packed(n), "best": packed(n == most[lo + x])}], _PAIRS)

        for row in _by_stripe(batches):
            if row["stripe"] != now:
                if now is not None:
                    yield from result()
                matrix[:], now = 0, row["stripe"]
            n = row["n_pairs"]
            np.add.at(matrix, (unpacked(row["a"], n) // n_stripes, unpacked(row["b"], n)), unpacked(row["docs"], n))
        if now is not None:
            yield from result()

    return questions.repartition("stripe").sortWithinPartitions("stripe").mapInArrow(counted, _PAIRS_SQL)


def _answers(questions: DataFrame, counts: DataFrame, n_stripes: int, right_size: int) -> DataFrame:
    """Questions with the corpus-wide counts of their pairs in the place of the chunk's own."""

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, best, now = np.zeros((STRIPE_ROWS, right_size), np.int64), np.zeros((STRIPE_ROWS, right_size), bool), None
        out = []
        for row in _by_stripe(batches):
            if row["stripe"] != now:
                now = row["stripe"]
            n = row["n_pairs"]
            at = unpacked(row["a"], n) // n_stripes, unpacked(row["b"], n)
            if row["chunk"] == _COUNTS:  # a stripe's counts come first, and cover all it is asked for
                matrix[at], best[at] = unpacked(row["docs"], n), unpacked(row["best"], n) > 0
                continue
            out.append(row | {"docs": packed(matrix[at]), "best": packed(best[at])})
            if len(out) == 256:
                yield pa.RecordBatch.from_pylist(out, _PAIRS)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, _PAIRS)

    return questions.unionByName(counts).repartition("stripe").sortWithinPartitions("stripe", "chunk").mapInArrow(answered, _PAIRS_SQL)


_SCORED = pa.schema(
    [("doc_id", pa.int64())] + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [("groups_sha256", pa.string())]
)


def _scored(chunks: DataFrame, answers: DataFrame, n_stripes: int) -> DataFrame:
    """Each document's sums over its links; a chunk at a time."""

    def result(row: dict, got: list[dict]) -> pa.RecordBatch:
        n, docs = row["n_pairs"], len(row["doc_ids"])
        key = (unpacked(row["a"], n) << 32) | unpacked(row["b"], n)
        count, best = np.zeros(n, np.int64), np.zeros(n, bool)
        for x in got:
            m = x["n_pairs"]
            at = np.searchsorted(key, (unpacked(x["a"], m) << 32) | unpacked(x["b"], m))
            count[at], best[at] = unpacked(x["docs"], m), unpacked(x["best"], m) > 0
        links = row["n_links"]
        which, often = unpacked(row["which"], links), unpacked(row["often"], links)
        of = np.repeat(np.arange(docs), unpacked(row["held"], docs))
        sums = np.zeros((2, docs), np.int64)
        np.add.at(sums[0], of, often * best[which])
        np.add.at(sums[1], of, often * count[which])
        stats = np.frombuffer(row["stats"], np.int64).reshape(-1, 4)
        return pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), *[pa.array(stats[:, i]) for i in range(4)], pa.array(sums[0]), pa.array(sums[1]), pa.array(row["digests"], pa.string())], schema=_SCORED)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, got = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["stripe"] is None:  # the chunk itself comes before its answers
                    if held is not None:
                        yield result(held, got)
                    held, got = row, []
                else:
                    got.append(row)
        if held is not None:
            yield result(held, got)

    both = chunks.withColumn("stripe", F.lit(None).cast("int")).unionByName(answers, allowMissingColumns=True)
    together = both.repartition("chunk").sortWithinPartitions("chunk", F.col("stripe").asc_nulls_first())
    return together.mapInArrow(scored, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align(docs: DataFrame, left: str, right: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for every row of
    ``docs(doc_id, text, …)``.

    left: a byte-level BPE file (JSON of the tokenizers library); right: a sentencepiece BPE model
    that adds a leading space. Special tokens' strings are plain text. n_best counts the links
    whose pair no other partner of the left id is linked with in more documents, ties included;
    count_sum adds up the documents of all links' pairs.

    Null and empty texts, and those that one side can't spell byte for byte (they hold the mark
    U+2581), have no tokens: zeros and an empty digest. Repeated rows and rows of one doc_id or of
    none are documents of their own. Very long texts are encoded whole, and a group of any length
    is counted by its different ids; a document takes memory by its different pairs. An empty table
    gives no rows; other columns are ignored.
    """
    both = Tokenizers(*_Files(docs.sparkSession, left, right).value)
    n_stripes = -(-len(both.left_bytes) // STRIPE_ROWS)
    chunks = written(encoded_chunks(docs, left, right), "aligned")
    questions = _questions(chunks, n_stripes)
    counts = written(pair_counts(questions, n_stripes, both.right_size), "pair_counts")
    return _scored(chunks, _answers(questions, counts, n_stripes, both.right_size), n_stripes)
