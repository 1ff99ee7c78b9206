import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from scarmap.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = bpe.Vocabulary(open(PATH, encoding="utf-8").read())
LIBRARY = Tokenizer.from_file(PATH)


def ids(text):
    return np.frombuffer(VOCABULARY.encode(text), "<u4").tolist()


def same(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids(text) == want, text
    assert VOCABULARY.decode(VOCABULARY.encode(text)) == LIBRARY.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["", " ", "a<|endoftext|>b<|endoftext|>", "aaaaaaaaaaaaaaaa" * 40, "it's they'LL", "  \x85\t\x1c x　y ", "é漢字🙂 " * 3, "-" * 500, "    \n\n   x", "1234 ²½ ٣"])
def test_fixed_texts(text):
    same(text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abeinorst TION.\n", max_size=80))
def test_dense_text(text):
    same(text)


def test_random_joined_tokens():
    rng = random.Random(5)
    tokens = list(VOCABULARY.id_of)
    for _ in range(3000):
        same("".join(rng.choice(tokens) for _ in range(4)).encode("latin-1").decode("utf-8", "ignore"))


def test_rows(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("ids", T.StringType()), T.StructField("n_tokens", T.LongType())])
    rows = [(1, None, "x", 0), (2, "", "x", 0), (3, "the thing " * 30000, "x", 0), (3, "the thing " * 30000, "x", 0), (None, "é", "x", 0)]
    out = bpe.bpe_round_trip(spark.createDataFrame(rows, schema), PATH).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in out) == [(0, 1), (1, 0), (2, 0), (3, 60001), (3, 60001)]
    for r in out:
        text = next(t or "" for d, t, *_ in rows if d == r.doc_id)
        assert r.decoded == text
        assert hashlib.sha256(r.ids).digest() == hashlib.sha256(np.array(LIBRARY.encode(text, add_special_tokens=False).ids, "<u4").tobytes()).digest()
    assert bpe.bpe_round_trip(spark.createDataFrame([], schema), PATH).count() == 0
