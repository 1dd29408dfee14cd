"""Encoding and decoding by the word table against the library, text by text."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF_SMALL
from dayloom.llm import common, queries, word_table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " ", "a", "<|endoftext|>", "x<|startoftext|>y Z", "\x1ca\x1d b", "\x85\xa0 　", "Ünï ΑΣ İ ß ́a", "日本語 テキスト 👍🏽", "a" * 5000,
         " ​ ", "\x00 \x01", "<|ENDOFTEXT|>don't DON'T", "ꟋꟜ K ſ ﬁ", "zz\nyy\ttt"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def wanted(rows):
    library, out = Tokenizer.from_file(VOCABULARY), []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out.append((str(key), len(ids), sha(" ".join(map(str, ids))), sha(decoded), tuple(ids), decoded))
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"chunk_chars": 10, "slot_bytes": 7}])
def test_awkward_texts(spark, sizes):
    rows = [(None if i == 3 else i, t) for i, t in enumerate(TEXTS)] + [(3, "a"), (3, "a")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, TEXT int").repartition(3)
    got = sorted((str(r[0]), *r[1:4], tuple(r["ids"]), r["decoded"]) for r in word_table.encode(df, VOCABULARY, **sizes).collect())
    assert got == wanted(rows)
    assert word_table.encode(df.where("false"), VOCABULARY).collect() == []


def test_registered_query(spark):
    rows = [tuple(r) for r in common.table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert sorted((str(r[0]), *r[1:]) for r in queries.op12_bpe_round_trip(spark, SF_SMALL).collect()) == [w[:4] for w in wanted(rows)]


def test_vocabularies_that_cannot_be_used_by_word():
    with pytest.raises(ValueError):
        word_table.checked(public_tokenizers.path("byte_bpe_50k.json"))
