import hashlib

import numpy as np
import public_tokenizers as P
import pytest
from helpers import AWKWARD, awkward
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rackpulse.llm import bpe

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBPE(PATH, P.PATTERN, keep=50)


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from("aaabnt '\n  é日\U0001F600'sll0٣"), st.characters(codec="utf-8")), max_size=40))
def test_encodes_and_decodes_as_the_library(library, own, text):
    ids, ends = own.encode([text])
    want = library.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == want
    assert own.decode(ids, ends) == [library.decode(want, skip_special_tokens=False)]


def test_overlapping_pairs_and_long_words(library, own):
    for text in ("aaaaaaa", "ab" * 5000, "x" * 20000, "abababa" * 3, "<|endoftext|><|endoftext|> a"):
        assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_broken_utf8_decodes_with_replacement(library, own):
    ids = [222, 222, 65, 250, 13]
    assert own.decode(np.array(ids), np.array([5])) == [library.decode(ids, skip_special_tokens=False)]
    with pytest.raises(ValueError):
        own.decode(np.array([60000]), np.array([1]))


def test_columns_and_digests(spark, library):
    rows = [(d, t or "") for d, t in AWKWARD]
    want = sorted(((d, len(i := library.encode(t, add_special_tokens=False).ids), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
                    hashlib.sha256(library.decode(i, skip_special_tokens=False).encode()).hexdigest()) for d, t in rows), key=str)
    assert sorted(map(tuple, bpe.round_trip(awkward(spark), PATH, P.PATTERN).collect()), key=str) == want
    coded = bpe.encode(awkward(spark), PATH, P.PATTERN)
    assert coded.columns.count("ids") == 1 and "Text" in coded.columns
    texts = bpe.decode(coded, PATH, P.PATTERN)
    assert sorted(((r["doc_id"], r["decoded"]) for r in texts.collect()), key=str) == sorted(rows, key=str)
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH, P.PATTERN).count() == 0
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert bpe.decode(nothing, PATH, P.PATTERN).first()["decoded"] == ""
