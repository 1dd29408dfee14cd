"""Cross-tokenizer alignment by diagonal run skipping.

Two tokenizers cut the same bytes; the offsets where tokens of both end cut them into groups.  At the current
shift between the two arrays of end offsets a run of equal ends is skipped as a whole: slices of
1, 2, 4, ... ends are compared until one differs, then halves of it say where.  Such a run is
one-to-one.  What differs is an irregular group, walked token by token until ends meet again, which sets the
shift anew.  Runs and walks also give the links: pairs of tokens whose bytes overlap.

The count of an id pair is how many documents hold it linked.  The texts of a task are gathered in
chunks; a chunk keeps each of its distinct pairs once, with the number of its documents, and its documents as numbers of pairs.
Pairs go to slots by hash, a slot sums up the pairs of all chunks and gives each chunk the totals of its own;
the highest count of each first id is one small aggregate over the slots (at most the vocabulary's size).

Scale: texts are tokenized once, where they are read; packed pair numbers are written and shuffled once.
A pair in every document is one row a chunk.  Chunks and slots have a fixed size, whatever the input.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type
from pyspark.sql.types import StructField, StructType

from . import packed
from .common import pick, small_batches, written

#: Characters of the texts that are aligned at once, and of those in a chunk; bytes of input for each slot of pairs.
ALIGN_CHARS, CHUNK_CHARS, SLOT_BYTES = 1 << 19, 8 << 20, 16 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Fixed value: how the byte-level vocabulary cuts texts before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def align(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Numbers of the tokens of each side that end inside a group, by their end offsets.

    The offsets ascend and the last ones are equal.  All other tokens end a group, so one-to-one runs leave nothing behind.
    """
    inner_a, inner_b = [], []
    i = j = 0
    n = len(a)
    while i < n:
        width = 1
        while a[i:i + width] == b[j:j + width] and i < n:
            i += width
            j += width
            width *= 2
        while width > 1:
            width //= 2
            if a[i:i + width] == b[j:j + width]:
                i += width
                j += width
        if i >= n:
            break
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                inner_a.append(i)
                i += 1
                x = a[i]
            else:
                inner_b.append(j)
                j += 1
                y = b[j]
        i += 1
        j += 1
    return inner_a, inner_b


class Tokenizers:
    """Token ids of both vocabularies, and the bytes that each id stands for."""

    def __init__(self, byte_spec: str, piece_model: bytes):
        import sentencepiece
        import tiktoken
        from .token_count import byte_alphabet
        back = {c: i for i, c in enumerate(byte_alphabet())}
        spec = json.loads(byte_spec)
        added = {t["id"] for t in spec["added_tokens"]}
        bytes_of = {i: bytes(back[c] for c in t) for t, i in spec["model"]["vocab"].items() if i not in added}
        # the order of ids is the order of merges, so ids serve as ranks; without special tokens their strings are plain text
        self.byte = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks={b: i for i, b in bytes_of.items()}, special_tokens={})
        self.piece = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.bytes_a = [bytes_of.get(i, b"") for i in range(max(bytes_of) + 1)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.piece.is_byte(i) else p.replace("▁", " ").encode()
                        for i in range(self.piece.get_piece_size()) if (p := self.piece.id_to_piece(i)) is not None]
        self.sizes_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # an id as it is told: a token of A inside a group and at its end, one of B likewise
        self.width = max(len(self.bytes_a), len(self.bytes_b))
        self.names = [f"{i}{mark}" for mark in ",|,;" for i in range(self.width)]

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, list[int]]]:
        """Ids of each text by both; none where either one's bytes are not a space and the text."""
        told = [i for i, t in enumerate(texts) if t]
        found: list[tuple[np.ndarray, list[int]]] = [(np.empty(0, np.uint32), [])] * len(texts)
        for i, own in zip(told, self.piece.encode([texts[i] for i in told], num_threads=1) if told else []):
            spaced = " " + texts[i]
            raw, other = spaced.encode("utf-8", "replace"), self.byte.encode_to_numpy(spaced, disallowed_special=())
            if b"".join(map(self.bytes_b.__getitem__, own)) == raw and b"".join(map(self.bytes_a.__getitem__, other.tolist())) == raw:
                found[i] = other, own
        return found


class Aligned:
    """Some texts, tokenized and aligned together; bounds are by text."""

    def __init__(self, with_: Tokenizers, texts: list[str | None]):
        found = with_.tokens(texts)
        self.bounds_a = packed.bounds(np.array([len(a) for a, _ in found]))
        self.bounds_b = packed.bounds(np.array([len(b) for _, b in found]))
        self.a = np.concatenate([a for a, _ in found]).astype(np.int64)
        self.b = np.fromiter(chain.from_iterable(b for _, b in found), np.int64, self.bounds_b[-1])
        self.at_a, self.at_b = np.cumsum(with_.sizes_a[self.a]), np.cumsum(with_.sizes_b[self.b])
        inner_a, inner_b = (np.array(x, np.int64) for x in align(self.at_a.tolist(), self.at_b.tolist()))
        self.ends_a, self.ends_b = np.ones(len(self.a), bool), np.ones(len(self.b), bool)
        self.ends_a[inner_a], self.ends_b[inner_b] = False, False
        # a link ends where a token of either side does; a text's groups and links end where its tokens do
        at = np.sort(np.concatenate([self.at_a, self.at_b[inner_b]]), kind="stable")
        self.link_a, self.link_b = np.searchsorted(self.at_a, at), np.searchsorted(self.at_b, at)
        self.groups = packed.bounds(self.ends_a)[self.bounds_a]
        self.links = np.searchsorted(self.link_a, self.bounds_a)

    def told(self, with_: Tokenizers) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` for each text."""
        ends_a, ends_b = (np.flatnonzero(e) + 1 for e in (self.ends_a, self.ends_b))
        before_a, before_b = packed.bounds(self.ends_a)[:-1], packed.bounds(self.ends_b)[:-1]  # groups before a token's own
        order = np.empty(len(self.a) + len(self.b), np.int64)
        order[np.arange(len(self.a)) + np.concatenate(([0], ends_b))[before_a]] = self.a + with_.width * self.ends_a
        order[np.arange(len(self.b)) + ends_a[before_b]] = self.b + with_.width * (2 + self.ends_b)
        parts, cuts = list(map(with_.names.__getitem__, order.tolist())), (self.bounds_a + self.bounds_b).tolist()
        return ["".join(parts[x:y])[:-1] for x, y in zip(cuts, cuts[1:])]

    def pairs(self) -> np.ndarray:
        return self.a[self.link_a] << 32 | self.b[self.link_b]


def _in_turn(texts: list[str | None], most: int) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of together `most` characters, or one of more."""
    first = chars = 0
    for i, t in enumerate(texts):
        if chars and chars + len(t or "") > most:
            yield first, i
            first, chars = i, 0
        chars += len(t or "")
    if first < len(texts):
        yield first, len(texts)


class _Chunk:
    """Texts of a task: facts about each, and their links as numbers of distinct pairs."""

    def __init__(self):
        self.keys: list[pa.Array] = []
        self.facts: list[np.ndarray] = []  # n_a, n_b, n_groups, n_links of each text
        self.digests: list[str] = []
        self.pairs: list[np.ndarray] = []
        self.chars = 0

    def add(self, with_: Tokenizers, keys: pa.Array, texts: list[str | None]) -> None:
        self.keys.append(keys)
        for x, y in _in_turn(texts, ALIGN_CHARS):
            found = Aligned(with_, texts[x:y])
            facts = np.stack([np.diff(z) for z in (found.bounds_a, found.bounds_b, found.groups, found.links)])
            self.facts.append(facts)
            self.digests += [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in found.told(with_)]
            self.pairs.append(found.pairs())
        self.chars += sum(len(t or "") for t in texts)

    def rows(self, chunk: int, slots: int) -> list[dict]:
        """A row of texts, and a row of pairs for each slot; pairs are numbered slot by slot."""
        facts = np.concatenate(self.facts, axis=1)
        links = np.concatenate(self.pairs)
        which, kinds = pd.factorize(links)  # by hash: there are few kinds among many links
        slot = (kinds.astype(np.uint64) * _MIX >> np.uint64(32)).astype(np.int64) % slots
        order = np.lexsort((kinds, slot))
        number = np.empty(len(kinds), np.int64)
        number[order] = np.arange(len(kinds))
        kinds, slot = kinds[order], slot[order]
        width = max(1, len(kinds))
        at, held = pd.factorize(np.repeat(np.arange(facts.shape[1]), facts[3]) * width + number[which])
        times, order = np.bincount(at, minlength=len(held)), np.argsort(held)
        times, (doc, held) = times[order], np.divmod(held[order], width)
        docs_with = np.bincount(held, minlength=len(kinds))
        sizes = np.bincount(doc, minlength=facts.shape[1])
        gaps = np.diff(held, prepend=0)
        begins = packed.bounds(sizes)[:-1][sizes > 0]
        gaps[begins] = held[begins]
        out = [{"chunk": chunk, "keys": pa.concat_arrays(self.keys), "facts": packed.pack(facts.ravel()), "digests": self.digests,
                "sizes": packed.pack(sizes.astype(np.int32)), "held": packed.pack(gaps.astype(np.int32)), "times": packed.pack(times.astype(np.int32))}]
        cuts = np.flatnonzero(np.diff(slot, prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(slot))):
            out.append({"chunk": chunk, "slot": int(slot[a]), "first": int(a), "pairs": packed.pack_sorted(kinds[a:b]), "docs": packed.pack(docs_with[a:b])})
        return out


def _spark(schema: pa.Schema) -> StructType:
    return StructType([StructField(f.name, from_arrow_type(f.type)) for f in schema])


def _chunk_schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("chunk", pa.int64()), ("slot", pa.int64()), ("first", pa.int64()), ("pairs", pa.binary()), ("docs", pa.binary()),
                      ("keys", pa.list_(kind)), ("facts", pa.binary()), ("digests", pa.list_(pa.string())), ("sizes", pa.binary()),
                      ("held", pa.binary()), ("times", pa.binary())])


_TOTALS = pa.schema([("chunk", pa.int64()), ("first", pa.int64()), ("pairs", pa.binary()), ("totals", pa.binary()), ("a", pa.list_(pa.int64())), ("top", pa.list_(pa.int64()))])


def _slot_totals(rows: pa.Table) -> pa.Table:
    """The pairs of a slot summed up over chunks: totals back to each chunk, and the highest for each first id."""
    asked = [packed.unpack_sorted(p, np.int64) for p in rows.column("pairs").to_pylist()]
    docs = np.concatenate([packed.unpack(d, np.int64) for d in rows.column("docs").to_pylist()])
    kinds, which = np.unique(np.concatenate(asked), return_inverse=True)
    totals = np.zeros(len(kinds), np.int64)
    np.add.at(totals, which, docs)
    cuts = packed.bounds(np.array([len(p) for p in asked]))
    out = [{"chunk": c, "first": f, "pairs": p, "totals": packed.pack(totals[which[x:y]])}
           for c, f, p, x, y in zip(*(rows.column(n).to_pylist() for n in ("chunk", "first", "pairs")), cuts, cuts[1:])]
    a = kinds >> 32
    first = np.flatnonzero(np.diff(a, prepend=-1))
    out.append({"a": a[first].tolist(), "top": np.maximum.reduceat(totals, first).tolist()})
    return pa.Table.from_batches(packed.rows(_TOTALS, out))


def _read(byte_vocabulary: str, piece_model: str) -> tuple[str, bytes]:
    with open(byte_vocabulary, encoding="utf-8") as f, open(piece_model, "rb") as g:
        return f.read(), g.read()


def alignments(docs: DataFrame, byte_vocabulary: str, piece_model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, a_ids, b_ids (array<int>), groups (as in op13's contract).  Texts as in `aligned_counts`."""
    shared = docs.sparkSession.sparkContext.broadcast(_read(byte_vocabulary, piece_model))
    small_batches(docs.sparkSession)
    rows = pick(docs, key, text)
    schema = pa.schema([(key, to_arrow_type(rows.schema[key].dataType)), ("a_ids", pa.list_(pa.int32())), ("b_ids", pa.list_(pa.int32())), ("groups", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_ = Tokenizers(*shared.value)
        for b in batches:
            texts = b.column(text).to_pylist()
            for x, y in _in_turn(texts, ALIGN_CHARS):
                found = Aligned(with_, texts[x:y])
                ids = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, pa.int32()))
                       for cuts, flat in ((found.bounds_a, found.a), (found.bounds_b, found.b))]
                yield pa.RecordBatch.from_arrays([b.column(key).slice(x, y - x), *ids, pa.array(found.told(with_))], schema=schema)

    return rows.mapInArrow(run, _spark(schema))


def aligned_counts(docs: DataFrame, byte_vocabulary: str, piece_model: str, key: str = "doc_id", text: str = "text",
                   chunk_chars: int = CHUNK_CHARS, slot_bytes: int = SLOT_BYTES) -> DataFrame:
    """One row per row of `docs`: key, n_a, n_b, n_groups, n_links, n_best, count_sum (long), groups_sha256 (contract of op13).

    A: a space and the text by the byte-level vocabulary (a tokenizers file); B: the text by the piece model (a
    sentencepiece file), which adds the space; special strings are plain text.  Null and empty texts, and texts whose tokens do not
    give back the space and the text, have no tokens: zeros and the empty string.  Whole texts of any length are
    read, memory grows with the longest; every row counts as a document, repeated ones too; null keys are kept; an empty
    table gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_read(byte_vocabulary, piece_model))
    small_batches(spark)
    own = pick(docs, key, text)
    slots = (own.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0) // slot_bytes + 1
    kind = to_arrow_type(own.schema[key].dataType)
    schema = _chunk_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, chunk, with_ = TaskContext.get().partitionId(), 0, _Chunk(), Tokenizers(*shared.value)
        for b in batches:
            chunk.add(with_, b.column(key), b.column(text).to_pylist())
            if chunk.chars >= chunk_chars:
                yield from packed.rows(schema, chunk.rows((part << 32) + n, slots))
                n, chunk = n + 1, _Chunk()
        if chunk.keys:
            yield from packed.rows(schema, chunk.rows((part << 32) + n, slots))

    table = written(own.mapInArrow(run, _spark(schema)), "align-chunks")
    totals = written(table.where("slot is not null").select("chunk", "slot", "first", "pairs", "docs").groupBy("slot")
                     .applyInArrow(_slot_totals, _spark(_TOTALS)), "align-totals")
    highest = (totals.where("chunk is null").select(F.explode(F.arrays_zip("a", "top")).alias("x"))
               .groupBy("x.a").agg(F.max("x.top").alias("top")).collect())  # at most a row for each id of the byte-level vocabulary
    best = np.zeros(max((r["a"] for r in highest), default=0) + 1, np.int64)
    best[[r["a"] for r in highest]] = [r["top"] for r in highest]
    best = spark.sparkContext.broadcast(best)

    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    result = pa.schema([(key, kind), *((c, pa.int64()) for c in names), ("groups_sha256", pa.string())])

    def finished(rows: pa.Table) -> pa.Table:
        """A chunk: the totals of its pairs, by number, summed over the links of its texts."""
        every = rows.to_pylist()
        texts = next(r for r in every if r["sizes"] is not None)
        asked = sorted(((r["first"], r["totals"], r["pairs"]) for r in every if r["sizes"] is None))
        none = np.empty(0, np.int64)
        total = np.concatenate([none, *(packed.unpack(t, np.int64) for _, t, _ in asked)])
        first_ids = np.concatenate([none, *(packed.unpack_sorted(p, np.int64) >> 32 for *_, p in asked)])
        is_best = total == best.value[first_ids]
        sizes, times = packed.unpack(texts["sizes"], np.int32).astype(np.int64), packed.unpack(texts["times"], np.int32).astype(np.int64)
        gaps, cuts = packed.unpack(texts["held"], np.int32).astype(np.int64), packed.bounds(sizes)
        run_ = np.cumsum(gaps)
        begins = cuts[:-1][sizes > 0]
        held = run_ - np.repeat(run_[begins] - gaps[begins], sizes[sizes > 0])
        sums = np.stack([np.diff(np.concatenate(([0], np.cumsum(x)))[cuts]) for x in (times * is_best[held], times * total[held])])
        facts = packed.unpack(texts["facts"], np.int64).reshape(4, len(sizes))
        keys = rows.column("keys").combine_chunks().flatten()
        return pa.Table.from_arrays([keys, *(pa.array(x) for x in facts), *(pa.array(x) for x in sums), pa.array(texts["digests"], pa.string())], schema=result)

    asked = totals.where("chunk is not null").select("chunk", "first", "pairs", "totals")
    here = ("keys", "facts", "digests", "sizes", "held", "times")
    both = (table.where("slot is null").select("chunk", *here)
            .withColumns({"first": F.lit(None).cast("long"), "pairs": F.lit(None).cast("binary"), "totals": F.lit(None).cast("binary")})
            .unionByName(asked.withColumns({c: F.lit(None).cast(table.schema[c].dataType) for c in here})))
    return both.groupBy("chunk").applyInArrow(finished, _spark(result))
