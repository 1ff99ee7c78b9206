"""Alignment of two tokenizers against a brute-force version."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
from pyspark.sql import functions as F

from scarmap.llm import alignment
from scarmap.llm.bpe import byte_letters
from scarmap.llm.registry import tokenizer_path

LEFT, RIGHT = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def by_hand(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    left, right, letters = Tokenizer.from_file(LEFT), sentencepiece.SentencePieceProcessor(model_file=RIGHT), byte_letters()
    left.encode_special_tokens = True
    found, counts = [], Counter()
    for t in texts:
        a = left.encode(" " + (t or ""), add_special_tokens=False).ids if t else []
        b = right.encode(t) if t else []
        spelled_a = [bytes(letters[c] for c in left.id_to_token(i)) for i in a]
        spelled_b = [bytes([int(p[3:5], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [right.id_to_piece(i)]]
        if not t or b"".join(spelled_a) != b"".join(spelled_b) or b"".join(spelled_a) != (" " + t).encode():
            found.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in spelled_a]).tolist(), np.cumsum([len(x) for x in spelled_b]).tolist()
        groups, cuts = [], sorted(set(ends_a) & set(ends_b))
        for lo, hi in zip([0, *cuts[:-1]], cuts, strict=True):
            groups.append(([i for i, e in zip(a, ends_a, strict=True) if lo < e <= hi], [i for i, e in zip(b, ends_b, strict=True) if lo < e <= hi]))
        links = Counter((i, j) for x, y in groups for i in x for j in y)
        counts.update(links.keys())
        digest = sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups).encode()).hexdigest()
        found.append((len(a), len(b), len(groups), sum(links.values()), digest, links))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if f is None else (*f[:4], sum(m for p, m in f[5].items() if counts[p] == best[p[0]]), sum(m * counts[p] for p, m in f[5].items()), f[4])
        for f in found
    ]


def test_equals_brute_force(spark, sf_dir):
    rng = random.Random(3)
    texts = [None, "", " ", "  \n ", "a", "a b", "▁", "x ▁ y", "<|endoftext|> <s></s><unk> <0x41>", "don't  stop\t12345 67,890!", "中文字符 日本語テキスト", "é́ ñ 🙂🙃", "\x00\x01", "same text", "same text", "z" * 3000, " " * 500, "12" * 900 + "!?" * 700]
    texts += ["".join(rng.choice("ab cdé 1_.\n中") for _ in range(rng.randint(1, 200))) for _ in range(40)]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").where("n_chars < 4000").limit(60).collect()]
    docs = spark.createDataFrame([(i, t, "other", 5) for i, t in enumerate(texts)], "doc_id long, text string, chunk string, n_a int").repartition(3)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.align(docs, LEFT, RIGHT).collect()}
    want = by_hand(texts)
    assert got == dict(enumerate(want))
    assert any(w[0] == 0 for w in want[6:8])


def test_small_chunks_and_repeated_rows(spark):
    texts = ["the cat sat", "the cat", "the dog", "cats and dogs 123", None, "the cat sat"] * 5
    rows = [(i % 7 if i % 5 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = alignment.CHUNK_LINKS
    alignment.encoded_chunks.__defaults__ = (6, 2)
    try:
        got = sorted((r.doc_id is None, r.doc_id or 0, *[r[c] for c in COLUMNS]) for r in alignment.align(docs, LEFT, RIGHT).collect())
    finally:
        alignment.encoded_chunks.__defaults__ = (kept, alignment.CHUNK_DOCS)
    assert got == sorted((d is None, d or 0, *w) for (d, _), w in zip(rows, by_hand(texts), strict=True))
    assert alignment.align(docs.where(F.lit(False)), LEFT, RIGHT).count() == 0


def test_packed_numbers():
    for x in ([], [0], [255], [256, 3], [1 << 16], [1 << 33, 7]):
        assert alignment.unpacked(alignment.packed(np.array(x, np.int64)), len(x)).tolist() == x
