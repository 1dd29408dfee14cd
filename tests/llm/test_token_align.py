"""Alignment of two tokenizers against brute force over byte ranges and the libraries' own ids."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import SF_SMALL
from dayloom.llm import common, queries, token_align
from dayloom.llm.token_count import byte_alphabet

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "  a", "a", "<|endoftext|> <s>", "x▁y", "日本語 テキスト 👍🏽", "ab" * 300, " \n\n\t zz", "don't DON'T", "\x00 \x01", "a  b", "Ünï ÄÖ ́", "<0x41>"]


def ranges(tokens):
    out, at = [], 0
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def brute(rows):
    a_lib, b_lib = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a_lib.encode_special_tokens = True
    back = {c: i for i, c in enumerate(byte_alphabet())}
    docs, counts = [], Counter()
    for key, text in rows:
        a, b = (a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)) if text else ([], [])
        a_bytes = [bytes(back[c] for c in a_lib.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            docs.append((key, [], [], [], []))
            continue
        a_at, b_at = ranges(a_bytes), ranges(b_bytes)
        cuts = sorted({y for _, y in a_at} & {y for _, y in b_at})
        groups = ["|".join(",".join(str(i) for i, (x, y) in zip(ids, at) if low <= x and y <= high) for ids, at in ((a, a_at), (b, b_at)))
                  for low, high in zip([0, *cuts], cuts)]
        links = [(a[i], b[j]) for i, (x, y) in enumerate(a_at) for j, (u, v) in enumerate(b_at) if max(x, u) < min(y, v)]
        counts.update(set(links))
        docs.append((key, a, b, groups, links))
    top = {}
    for (x, _), n in counts.items():
        top[x] = max(top.get(x, 0), n)
    return sorted((str(k), len(a), len(b), len(g), len(links), sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links),
                   hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for k, a, b, g, links in docs)


def got(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


@pytest.mark.parametrize("sizes", [{}, {"chunk_chars": 10, "slot_bytes": 7}])
def test_awkward_texts(spark, sizes):
    rows = [(None if i == 4 else i, t) for i, t in enumerate(TEXTS)] + [(3, "a"), (3, "a")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, TEXT int").repartition(3)
    assert got(token_align.aligned_counts(df, BYTE, PIECE, **sizes)) == brute(rows)
    assert token_align.aligned_counts(df.where("false"), BYTE, PIECE).collect() == []
    told = {str(r[0]): r for r in token_align.alignments(df.where("doc_id <> 3"), BYTE, PIECE).collect()}
    assert told["12"]["groups"].count(";") + 1 == next(w[3] for w in brute(rows) if w[0] == "12")
    assert told["0"]["a_ids"] == [] and told["0"]["groups"] == ""


def test_registered_query(spark, tmp_path):
    docs = common.table(spark, SF_SMALL, "documents").where("length(text) < 2500")  # brute force is quadratic in a text
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(queries.op13_token_alignment(spark, str(tmp_path))) == brute(rows)


def test_run_skipping():
    """Random cuts of one range."""
    rng = random.Random(5)
    for _ in range(500):
        n = rng.randint(1, 60)
        shared = sorted({n, *rng.sample(range(1, n + 1), rng.randint(0, n))})
        a, b = (sorted({*shared, *rng.sample(range(1, n + 1), rng.randint(0, n // 3))}) for _ in "ab")
        inner_a, inner_b = token_align.align(a, b)
        assert inner_a == [i for i, x in enumerate(a) if x not in b] and inner_b == [j for j, x in enumerate(b) if x not in a]
