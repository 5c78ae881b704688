import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tierline.llm import bpe
from tierline.llm.words import ByteTokenizer

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = [None, "", " ", " " * 5000 + "x", "a" * 3000, "ab  c\n\n d's 12 ½ é漢字 " * 400, "\x1c\x85 　x '" * 500, "😀 x" * 2000,
         ("x " + " " * 700) * 10, "<|endoftext|> it's", "word and word, " * 900]


def _library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


LIBRARY, OURS = _library(), ByteTokenizer(PATH, PATTERN)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60))
def test_ids_are_those_of_the_library(text):
    ids = OURS.encode_pieces(OURS.pieces(text))
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text)
    assert OURS.decode(ids) == text.encode()


@pytest.mark.parametrize("chunk,overlap", [(bpe.CHUNK, bpe.OVERLAP), (1000, 64), (97, 10)])
def test_chunks_of_any_size_give_the_same_ids(documents, by_id, chunk, overlap):
    found = by_id(bpe.encode(documents(*TEXTS), PATH, PATTERN, chunk, overlap))
    for i, text in enumerate(TEXTS):
        ids = LIBRARY.encode_ordinary(text or "")
        assert np.frombuffer(found[i].ids, "<u4").tolist() == ids and found[i].n_tokens == len(ids)
        assert bytes(found[i].decoded) == (text or "").encode()


def test_decode(documents, spark):
    ids = bpe.encode(documents("héllo", None), PATH, PATTERN).drop("decoded").withColumn("decoded", F.lit(1))
    more = ids.unionByName(spark.createDataFrame([(9, 0, None, 1)], "doc_id long, n_tokens long, ids binary, decoded int"))
    raw = {r.doc_id: r.decoded and bytes(r.decoded) for r in bpe.decode(more, PATH, PATTERN).collect()}
    assert raw == {0: "héllo".encode(), 1: b"", 9: None}


def test_rows_and_columns(documents):
    docs = documents((1, "ab " * 100), (1, "ab " * 100), (None, "c " * 100)).withColumns(
        {c: F.lit(0) for c in ("tag", "no", "ids", "size", "last")})
    for chunk in (bpe.CHUNK, 50):
        rows = bpe.encode(docs, PATH, PATTERN, chunk, 10).collect()
        assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == sorted(
            [(i, len(bytes(r.ids)) // 4) for i, r in zip(["1", "1", "None"], sorted(rows, key=lambda r: str(r.doc_id)))])
    assert bpe.encode(documents(), PATH, PATTERN).count() == 0
