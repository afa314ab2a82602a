"""BPE encoding and decoding through a table of distinct words.

Byte-level BPE never merges across certain white space, so a text may be cut
before a space or line feed that precedes a visible character, and after a
line feed, without changing its ids.  Spark cuts the texts into such words.
Each block of documents keeps its texts as positions into its own distinct
words and sends those words, grouped by hash, to the parts of the word table.
There every distinct word is encoded once, and its ids travel back to the
blocks that hold it, where they are joined by position.  Decoding joins ids
with the table of pieces, whose size the vocabulary bounds.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import block_names, parts_for, sized_batches, unzip_array, unzip_bytes, unzip_fields, unzip_strings, zip_array, zip_bytes, zip_fields, zip_strings
from .common import query, read_table, written_by_key

# A visible character: no white space, separator or control character by any definition.
_VISIBLE = r"[^\s\p{Z}\p{C}\x{1C}-\x{1F}\x{85}]"
STEP_WORDS = 1 << 18        # words whose ids are put together at a time
BLOCK_BYTES = 12 << 20
WORD_CUT = rf"(?=[ \n]{_VISIBLE})|(?<=\n)(?={_VISIBLE})"


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def byte_alphabet() -> dict[str, int]:
    """Characters that byte-level vocabularies write for bytes: visible Latin-1 as is, others from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def piece_table(path: str) -> list[bytes]:
    """Bytes of every id; bounded by the vocabulary file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    back = byte_alphabet()
    vocab = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec.get("added_tokens", [])}}
    added = {t["id"] for t in spec.get("added_tokens", [])}
    pieces = [b""] * (max(vocab.values()) + 1)
    for s, i in vocab.items():
        pieces[i] = s.encode() if i in added else bytes(back[c] for c in s)
    return pieces


def check_tokenizer(path: str) -> None:
    """The word cut holds for byte-level BPE with the standard split and no normalizer."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError(f"{path}: not a plain byte-level BPE")
    if any(t.get("lstrip") or t.get("rstrip") or " " in t["content"] or "\n" in t["content"] for t in spec.get("added_tokens", [])):
        raise ValueError(f"{path}: added tokens that reach across words")


def _pack(parts: int):
    def run(batches):
        names = block_names()
        for b in sized_batches(batches, "_t", BLOCK_BYTES):
            name = next(names)
            lists = b.column("_w")
            words = lists.flatten().cast(pa.binary()).dictionary_encode()
            codes = words.indices.to_numpy(zero_copy_only=False)
            distinct = words.dictionary.to_pylist()
            part = np.fromiter((zlib.crc32(w) for w in distinct), "u4", len(distinct)) % parts
            # the r-th most frequent word of part p has number r * parts + p: frequent words get small numbers
            order = np.lexsort((-np.bincount(codes, minlength=len(distinct)), part))
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            number = np.empty(len(distinct), "u4")
            number[order] = (np.arange(len(distinct)) - cuts[part[order]]) * parts + part[order]
            counts = np.array(pc.list_value_length(lists).to_pylist(), "<u4") if b.num_rows else np.empty(0, "<u4")
            sink = pa.BufferOutputStream()
            keys = b.select([c for c in b.schema.names if c not in ("_t", "_w")])
            with pa.ipc.new_stream(sink, keys.schema) as w:
                w.write_batch(keys)
            docs = zip_fields(zip_bytes(sink.getvalue().to_pybytes()), zip_array(counts), zip_array(number[codes].astype("<u4")))
            out_part, out_data = [-1], [docs]
            for p in range(parts):
                mine = order[cuts[p]:cuts[p + 1]]
                if len(mine):
                    out_part.append(p)
                    out_data.append(zip_strings([distinct[i] for i in mine]))
            for i in range(0, len(out_part), 64):
                yield pa.RecordBatch.from_pydict({"block": pa.array([name] * len(out_part[i:i + 64])), "part": pa.array(out_part[i:i + 64], pa.int32()),
                                                  "data": pa.array(out_data[i:i + 64], pa.binary())})
    return run


def _encode(path: str):
    """Words of a part's blocks -> their ids; each distinct word of the part is encoded once."""
    def run(batches):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # Spark's tasks are the parallelism
        tok, table = load_tokenizer(path), {}
        here = None
        for b in batches:
            for r in b.to_pylist():
                if r["part"] != here:
                    here, table = r["part"], {}
                words = unzip_strings(r["data"])
                new = [w for w in words if w not in table]
                for i in range(0, len(new), 4096):
                    some = new[i:i + 4096]
                    for w, e in zip(some, tok.encode_batch([w.decode() for w in some], add_special_tokens=False)):
                        table[w] = np.array(e.ids, "<u4").tobytes()
                ids = [table[w] for w in words]
                sizes = np.fromiter((len(x) >> 2 for x in ids), "<u4", len(ids))
                data = zip_fields(zip_array(sizes), zip_array(np.frombuffer(b"".join(ids), "<u4")))
                yield pa.RecordBatch.from_pydict({"block": pa.array([r["block"]]), "part": pa.array([r["part"]], pa.int32()), "data": pa.array([data], pa.binary())})
    return run


def _assemble(fields: list[str], out: str, parts: int, finish=None):
    """Documents of a block and the ids of its words -> ids of every document, by position.

    ``finish`` turns each batch of (fields, ids) into the rows to return.
    """
    def run(docs: pa.Table, ids: pa.Table) -> pa.Table:
        keys, counts, codes = unzip_fields(docs.column("data")[0].as_py())
        key_table = pa.ipc.open_stream(unzip_bytes(keys)).read_all().combine_chunks()
        counts, codes = unzip_array(counts, "<u4").astype("i8"), unzip_array(codes, "<u4")
        top = int(codes.max()) + 1 if len(codes) else 0
        sizes, starts = np.zeros(top, "i8"), np.zeros(top, "i8")
        flat, filled = [], 0
        for p, d in zip(ids.column("part").to_pylist(), ids.column("data").to_pylist()):
            n, words = (unzip_array(x, "<u4") for x in unzip_fields(d))
            at = np.arange(len(n)) * parts + p
            sizes[at], starts[at] = n, filled + np.cumsum(n, dtype="i8") - n
            flat.append(words)
            filled += len(words)
        flat = np.concatenate(flat) if flat else np.empty(0, "<u4")
        batches, at, ends = [], 0, np.cumsum(counts)
        i = 0
        while i < len(counts):                                     # some documents at a time
            j = max(i + 1, int(np.searchsorted(ends, at + STEP_WORDS, side="right")))
            c = codes[at:int(ends[j - 1])]
            n = sizes[c]
            pos = np.repeat(starts[c] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            edge = np.r_[0, np.cumsum(n)][np.r_[0, ends[i:j] - at]]
            lists = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(flat[pos].astype("i4"), pa.int32()))
            rows = key_table.slice(i, j - i).to_batches()
            columns = [rows[0].column(f) if rows else None for f in fields]
            b = pa.RecordBatch.from_arrays([*columns, lists], names=[*fields, out])
            batches.append(finish(b) if finish else b)
            at, i = int(ends[j - 1]), j
        return pa.Table.from_batches(batches)
    return run


def _coded(docs: DataFrame, tokenizer: str, text_col: str, finish, schema: str, out: str) -> DataFrame:
    """Cut, pack, encode and assemble; the result has ``schema`` with the other columns as k0, k1, ..."""
    check_tokenizer(tokenizer)
    others = [f for f in docs.schema.fields if f.name != text_col]
    parts = parts_for(docs.count())
    t = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = F.filter(F.split(t, WORD_CUT), lambda w: w != F.lit(""))
    # keys are renamed by number: names of other columns can't clash
    cut = docs.select(*[F.col(f"`{f.name}`").alias(f"k{i}") for i, f in enumerate(others)], t.alias("_t"), words.alias("_w"))
    packed = written_by_key(cut.mapInArrow(_pack(parts), "block string, part int, data binary"), "block", "bpe_blocks", parts)
    sent = packed.where("part >= 0")
    coded = sent.repartition("part").sortWithinPartitions("part").mapInArrow(_encode(tokenizer), "block string, part int, data binary")
    fields = [f"k{i}" for i in range(len(others))]
    return packed.where("part < 0").groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(_assemble(fields, out, parts, finish), schema)


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """The other columns of ``docs`` and, in place of the text, its ids (array of int).

    Ids equal those of the tokenizers library for the whole text without added
    special tokens, truncation or padding; the string of a special token inside
    a text becomes that token, as there.

    * NULL and empty texts give an empty array; texts of any length are encoded whole.
    * All other columns pass through, NULLs included; a column named like ``out`` is an error.
    * Repeated rows stay repeated and cost their words once; an empty table gives no rows.
    * A word that fills the table travels once per block and is encoded once.
    """
    others = [f for f in docs.schema.fields if f.name != text_col]
    if out in [f.name for f in others]:
        raise ValueError(f"docs has a column {out}")
    schema = ", ".join([*(f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(others)), f"`{out}` array<int>"])
    whole = _coded(docs, tokenizer, text_col, None, schema, out)
    return whole.select(*[F.col(f"k{i}").alias(f.name) for i, f in enumerate(others)], out)


def texts_of(ids: pa.Array, tokenizer: str) -> list[str | None]:
    """Join ids with the piece table and read the bytes as UTF-8."""
    pieces = piece_table(tokenizer)
    return [b"".join([pieces[i] for i in v.values.to_numpy().tolist()]).decode("utf-8", "replace") if v.is_valid else None for v in ids]


def decode(docs: DataFrame, tokenizer: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``docs`` with the text of its ids in a new column; invalid UTF-8 becomes U+FFFD, as in the library.

    Ids are joined with the piece table of the vocabulary inside the tasks.
    NULL ids give NULL, no ids an empty text; an id outside the vocabulary is an error.
    """
    if out in docs.columns:
        raise ValueError(f"docs has a column {out}")

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts_of(b.column(ids_col), tokenizer), pa.string())], [*b.schema.names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + f", `{out}` string"
    return docs.mapInArrow(run, schema)


def encode_and_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the round trip over ``docs(doc_id, text)``.

    The ids are those of ``encode`` and the text that of ``decode``; both are
    digested where they arise, so that neither travels further.
    """
    def finish(b: pa.RecordBatch) -> pa.RecordBatch:
        ids = b.column("ids")
        digest = [hashlib.sha256(v.values.to_numpy().astype("<u4").tobytes()).hexdigest() for v in ids]
        decoded = [hashlib.sha256(t.encode()).hexdigest() for t in texts_of(ids, tokenizer)]
        return pa.RecordBatch.from_arrays([b.column("k0"), pc.list_value_length(ids).cast(pa.int64()), pa.array(digest, pa.string()), pa.array(decoded, pa.string())],
                                          names=["k0", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _coded(docs.select("doc_id", "text"), tokenizer, "text", finish, f"k0 {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", "ids")
    return rows.withColumnRenamed("k0", "doc_id")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(read_table(spark, sf_dir, "documents"), vocabulary_path())
