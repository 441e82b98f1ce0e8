"""Very long texts without blanks, or of blanks only: no crash, no quadratic time."""

import time

import pytest
from tokenizers import Tokenizer

from weftline.llm import fingerprints, packing, privacy, units
from weftline.llm.queries import VOCABULARY
from weftline.llm.tokens import Encoder

N = 1_000_000
LONG = {
    "blanks": " " * N + "x",
    "feeds": "\n" * N,
    "marks": "." * N + " end",
    "han": "好" * N + "7",
    "digits": "a" * N + "1" + "b" * N,
    "mixed": ("w" + " \n\t" * 400) * 800,
}


@pytest.fixture(scope="module")
def encoder():
    return Encoder(VOCABULARY)


@pytest.mark.parametrize("text", ["x" + " " * 5000 + "y z", " " * 3000, "a" + "\n" * 2000 + " b", "  " * 999 + "1　" * 3, " " * 1500 + "é" + " \r\n" * 700])
def test_ids_equal_the_other_library(encoder, text):
    want = Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids
    assert encoder.ids(text).tolist() == want


@pytest.mark.parametrize("name", LONG)
def test_ids_of_long_texts(encoder, name):
    began = time.time()
    ids = encoder.ids(LONG[name])
    assert int(encoder.lengths[ids].sum()) == len(LONG[name].encode()) and time.time() - began < 20


def test_operators_on_long_texts(spark):
    docs = spark.createDataFrame(list(enumerate(LONG.values())), "doc_id long, text string").repartition(len(LONG)).cache()
    began = time.time()
    assert privacy.report(privacy.find_private(docs)).count() == len(LONG)
    assert units.drop_repeated_units(docs).count() == len(LONG)
    packed = packing.pack(docs, VOCABULARY)
    assert packed.selectExpr("count(distinct doc_id) n").first().n == len(LONG)
    assert fingerprints.compare_edited(docs).selectExpr("sum(size(fingerprint)) n").first().n > 0
    assert time.time() - began < 240
    docs.unpersist()
