"""BPE encoding and decoding through a table of distinct words.

Texts are split at white space, which no token of the vocabulary crosses.  The texts of a task are
numbered in chunks: a chunk keeps each of its distinct words once, and the texts as arrays of word numbers.
Words go to slots by hash; in a slot the same word of all chunks meets, is encoded once by the
vocabulary's library, and its ids go back to the chunks that asked.  There the ids
are joined to their pieces, word by word, and texts get ids and pieces by position.

Scale: what is shuffled are distinct words of chunks and their ids.  Chunks are written bucketed by their number, so the packed word
numbers (about half the size of the compressed texts) stay where they are and ids come to them; texts are read once.
A word in every text is one row for each chunk.
Chunks and slots have a fixed size, so there are more of them, not larger ones, when the input grows.
The id-to-piece table is as large as the vocabulary and travels with the tasks.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type
from pyspark.sql.types import StructField, StructType

from . import packed
from .common import pick, shared_dir, small_batches

#: Characters of the texts in a chunk; bytes of input for each slot of the word table.
CHUNK_CHARS, SLOT_BYTES = 8 << 20, 16 << 20

#: Fixed value: the white space of the vocabularies' patterns.  Python's own also has U+001C to U+001F.
WHITE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_PYTHON_ONLY = regex.compile(r"[\x1c-\x1f]")


def split(text: str | None) -> list[str]:
    if not text:
        return []
    return text.split() if not _PYTHON_ONLY.search(text) else [w for w in WHITE.split(text) if w]


def checked(vocabulary: str) -> tuple[str, list[str]]:
    """The vocabulary file's content and its pieces by id, if it can be used word by word."""
    from tokenizers import Tokenizer
    with open(vocabulary, encoding="utf-8") as f:
        content = f.read()
    spec = json.loads(content)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    drops = any(s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] for s in steps)
    if not drops or spec.get("decoder") or spec.get("post_processor"):
        raise ValueError("words are encoded alone only where the vocabulary drops white space, and has no decoder")
    tokenizer = Tokenizer.from_str(content)
    return content, [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]


def _spark(schema: pa.Schema) -> StructType:
    return StructType([StructField(f.name, from_arrow_type(f.type)) for f in schema])


class _Chunk:
    """Texts of a task as numbers of distinct words."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.keys: list[pa.Array] = []
        self.positions: list[np.ndarray] = []
        self.chars = 0

    def add(self, keys: pa.Array, texts: list[str | None]) -> None:
        self.keys.append(keys)
        number = self.number
        for t in texts:
            words = split(t)
            self.positions.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
            self.chars += len(t or "")

    def rows(self, chunk: int, slots: int) -> list[dict]:
        """A row of texts, and a row of words for each slot; words are numbered anew, slot by slot."""
        by_slot: dict[int, list[str]] = {}
        for w in self.number:
            by_slot.setdefault(xxhash.xxh64_intdigest(w.encode("utf-8", "replace")) % slots, []).append(w)
        by_slot = {slot: sorted(by_slot[slot]) for slot in sorted(by_slot)}
        order = [w for words in by_slot.values() for w in words]
        new = np.empty(len(order), np.int32)
        new[np.fromiter(map(self.number.__getitem__, order), np.int64, len(order))] = np.arange(len(order), dtype=np.int32)
        flat = new[np.concatenate(self.positions)] if order else np.empty(0, np.int32)
        out = [{"chunk": chunk, "keys": pa.concat_arrays(self.keys), "sizes": packed.pack(np.array([len(p) for p in self.positions], np.int32)),
                "positions": packed.pack(flat)}]
        first = 0
        for slot, words in by_slot.items():
            out.append({"chunk": chunk, "slot": slot, "first": first, "words": packed.pack_strings(words)})
            first += len(words)
        return out


def _chunks(rows: DataFrame, key: str, text: str, slots: int, chunk_chars: int) -> DataFrame:
    kind = to_arrow_type(rows.schema[key].dataType)
    schema = pa.schema([("chunk", pa.int64()), ("slot", pa.int64()), ("first", pa.int32()), ("words", pa.binary()),
                        ("keys", pa.list_(kind)), ("sizes", pa.binary()), ("positions", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, chunk = TaskContext.get().partitionId(), 0, _Chunk()
        for b in batches:
            chunk.add(b.column(key), b.column(text).to_pylist())
            if chunk.chars >= chunk_chars:
                yield from packed.rows(schema, chunk.rows((part << 32) + n, slots))
                n, chunk = n + 1, _Chunk()
        if chunk.keys:
            yield from packed.rows(schema, chunk.rows((part << 32) + n, slots))

    spark, name = rows.sparkSession, f"word_chunks_{uuid.uuid4().hex}"
    (rows.mapInArrow(run, _spark(schema)).write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk")
     .option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name))
    return spark.table(name)


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", with_ids: bool = True,
           chunk_chars: int = CHUNK_CHARS, slot_bytes: int = SLOT_BYTES) -> DataFrame:
    """One row per row of `docs`: key, n_tokens, ids_sha256, decoded_sha256 (contract of op12), and with `with_ids` ids, decoded.

    ids: array<int>, what the library of the vocabulary file gives for the whole text without added special
    tokens (special strings inside texts are special tokens); decoded: what it makes of the ids again, special tokens kept.
    Null, empty and white texts have no ids and decode to the empty string.  Texts
    of any length are encoded whole; repeated rows and null keys are kept; an empty table gives an empty result; other
    columns are not looked at.
    """
    spark = docs.sparkSession
    content, pieces = checked(vocabulary)
    small_batches(spark)
    own = pick(docs, key, text)
    slots = (own.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0) // slot_bytes + 1
    table = _chunks(own, key, text, slots, chunk_chars)
    shared = spark.sparkContext.broadcast((content, pieces))

    ids_schema = pa.schema([("chunk", pa.int64()), ("first", pa.int32()), ("n_ids", pa.binary()), ("ids", pa.binary())])
    loaded: list = []

    def encoded(rows: pa.Table) -> pa.Table:
        """The words of a slot: each distinct one encoded once, ids back to every chunk."""
        from tokenizers import Tokenizer
        if not loaded:
            loaded.append(Tokenizer.from_str(shared.value[0]))
            loaded[0].no_padding()
            loaded[0].no_truncation()
        asked = [packed.unpack_strings(w) for w in rows.column("words").to_pylist()]
        number: dict[str, int] = {}
        at = [np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)) for words in asked]
        words, found = list(number), []
        for a in range(0, len(words), 1000):
            found += [np.array(e.ids, np.int32) for e in loaded[0].encode_batch_fast(words[a:a + 1000], add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], np.int32)
        out = [{"chunk": c, "first": f, "n_ids": packed.pack(sizes[x]), "ids": packed.pack(np.concatenate([found[i] for i in x.tolist()]))}
               for c, f, x in zip(rows.column("chunk").to_pylist(), rows.column("first").to_pylist(), at)]
        return pa.Table.from_batches(packed.rows(ids_schema, out))

    kind = to_arrow_type(own.schema[key].dataType)
    made = [(key, kind), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    if with_ids:
        made += [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
    schema = pa.schema(made)

    def joined(chunk: pa.Table, words: pa.Table) -> pa.Table:
        """A chunk: the ids of its words, joined to their pieces; ids and pieces of its texts, by position."""
        piece_of = pa.array(shared.value[1], pa.string())
        texts = chunk.to_pylist()[0]
        asked = sorted((r["first"], r["n_ids"], r["ids"]) for r in words.to_pylist())
        n_ids = np.concatenate([packed.unpack(n, np.int32) for _, n, _ in asked]) if asked else np.empty(0, np.int32)
        flat = np.concatenate([packed.unpack(x, np.int32) for *_, x in asked]) if asked else np.empty(0, np.int32)
        ends = packed.bounds(n_ids).tolist()
        kinds, which = np.unique(flat, return_inverse=True)
        names, said = [str(i) for i in kinds.tolist()], piece_of.take(pa.array(kinds)).to_pylist()
        names, said = np.array(names, object)[which].tolist(), np.array(said, object)[which].tolist()
        ids_of = [" ".join(names[a:b]) for a, b in zip(ends, ends[1:])]
        said_of = [" ".join(said[a:b]) for a, b in zip(ends, ends[1:])]
        positions, cuts = packed.unpack(texts["positions"], np.int32), packed.bounds(packed.unpack(texts["sizes"], np.int32)).tolist()
        blank = not n_ids.all()  # words of characters that the vocabulary drops
        n, ids_sha, said_sha, all_ids, all_said = [], [], [], [], []
        for a, b in zip(cuts, cuts[1:]):
            own = positions[a:b]
            n.append(int(n_ids[own].sum()))
            own = (own[n_ids[own] > 0] if blank else own).tolist()
            decoded = " ".join([said_of[i] for i in own])
            ids_sha.append(hashlib.sha256(" ".join([ids_of[i] for i in own]).encode()).hexdigest())
            said_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
            if with_ids:
                all_ids.append(np.concatenate([flat[ends[i]:ends[i + 1]] for i in own]) if own else np.empty(0, np.int32))
                all_said.append(decoded)
        keys = chunk.column("keys").combine_chunks().flatten()
        columns = [keys, pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(said_sha, pa.string())]
        if with_ids:
            columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(all_said, pa.string())]
        return pa.Table.from_arrays(columns, schema=schema)

    ids = table.where("slot is not null").select("chunk", "slot", "first", "words").groupBy("slot").applyInArrow(encoded, _spark(ids_schema))
    texts = table.where("slot is null").select("chunk", "keys", "sizes", "positions")
    return texts.groupBy("chunk").cogroup(ids.groupBy("chunk")).applyInArrow(joined, _spark(schema))
