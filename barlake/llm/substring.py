"""Substring deduplication by De Bruijn compaction.

Every window of k words is an edge of the De Bruijn graph of the corpus.  An
edge that starts in two documents is repeated; its source is the occurrence
in the smallest document.  Repeated edges that follow each other in a document
while their sources follow each other in one place form a nonbranching path
and are compacted into one span (document place, source place, length).  The
words of every span are then compared with the words at its source; only
verified spans remove anything.

How the edges meet.  Documents are packed into blocks, written once.
1. Seeds: equal windows share their smallest inner s-word hash, so a block
   sends only those (about 2 / (k - s + 2) of all places) to the parts of the
   hash space and learns, one bit each, which are held by two documents.
2. Edges: windows over a repeated seed are sent once per block with document
   and place; the part finds the source of each and answers the others.
3. Spans: each block compacts its edges and takes the covered words out.
   Pieces of spans, cut at a grid of the source block, join the words there.
Equal windows of one block meet inside it, so a passage that fills a third of
the table sends one message per block.  If a piece fails (two windows with one
hash), the blocks concerned are done again with another hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import block_names, parts_for, sized_batches, unzip_array, unzip_fields, unzip_strings, zip_array, zip_fields, zip_strings
from .common import query, read_table, written, written_by_key

WINDOW = 13
SEED_WORDS = 5
GRID = 64
BLOCK_BYTES = 8 << 20
HASH_BITS = 64
MAX_RUNS = 40
NO_ID = np.iinfo("i8").max          # a NULL id is larger than all others
_MESSAGE = "block string, part int, data binary"
_FOUND = "kind string, block string, cell int, lo int, hi int, data binary, dst string"


def _message(block: str, part: int, data: bytes) -> dict:
    return {"block": block, "part": part, "data": data}


def _batches(rows: list[dict], schema: pa.Schema, size: int = 64):
    for i in range(0, len(rows), size):
        yield pa.RecordBatch.from_pylist(rows[i:i + size], schema=schema)


_MESSAGE_SCHEMA = pa.schema([("block", pa.string()), ("part", pa.int32()), ("data", pa.binary())])
_FOUND_SCHEMA = pa.schema([("kind", pa.string()), ("block", pa.string()), ("cell", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()),
                           ("data", pa.binary()), ("dst", pa.string())])


def _pack_blocks(block_bytes: int):
    """Rows (id, text) -> one row per block: ids and texts in order of id."""
    def run(batches):
        names = block_names()
        for b in sized_batches(batches, "text", block_bytes):
            yield _pack(b, next(names))
    return run


def _pack(b: pa.RecordBatch, name: str) -> pa.RecordBatch:
    ids = b.column("id").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
    nulls = np.array([not v for v in b.column("id").is_valid().to_pylist()], "u1") if b.num_rows else np.empty(0, "u1")
    texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
    order = np.argsort(ids, kind="stable")
    data = zip_fields(zip_array(ids[order].astype("<i8")), zip_array(nulls[order]), zip_strings([texts[i] for i in order]))
    return pa.RecordBatch.from_pylist([_message(name, -1, data)], schema=_MESSAGE_SCHEMA)


class Block:
    """Words of a block one after the other, and the hashes of their windows."""

    def __init__(self, data: bytes, seed: int, bits: int):
        ids, nulls, texts = unzip_fields(data)
        self.ids, self.nulls = unzip_array(ids, "<i8"), unzip_array(nulls, "u1")
        words: list[bytes] = []
        counts = []
        for t in unzip_strings(texts):
            w = t.split()                              # bytes split at ASCII white space only
            counts.append(len(w))
            words += w
        self.words, self.counts = words, np.array(counts, "i8")
        self.starts = np.cumsum(self.counts) - self.counts
        self.doc = np.repeat(np.arange(len(counts)), self.counts)
        coded = pa.array(words, pa.binary()).dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False) if words else np.empty(0, "i4")
        own = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in coded.dictionary.to_pylist()], "u8") if words else np.empty(0, "u8")
        self.word_hash, self.seed, self.bits = own[self.codes], seed, bits

    def hashes(self, k: int) -> np.ndarray:
        """Hash of the k words from each place on (places near the end of a document run over it)."""
        n = len(self.words) - k + 1
        if n <= 0:
            return np.empty(0, "u8")
        odd = np.random.default_rng(1000 * self.seed + k).integers(0, 2 ** 63, k, dtype="u8") * np.uint64(2) + np.uint64(1)
        h = np.zeros(n, "u8")
        for j in range(k):
            h += self.word_hash[j:n + j] * odd[j]
        for shift, mul in ((np.uint64(29), np.uint64(0xBF58476D1CE4E5B9)), (np.uint64(32), np.uint64(0x94D049BB133111EB))):
            h ^= h >> shift
            h *= mul
        h ^= h >> np.uint64(31)
        return h & ~np.uint64((1 << (64 - self.bits)) - 1)

    def places(self, k: int) -> np.ndarray:
        """Places at which a window of k words lies inside one document."""
        n = len(self.words) - k + 1
        return np.flatnonzero(self.doc[:n] == self.doc[k - 1:]) if n > 0 else np.empty(0, "i8")

    def seeds(self, k: int, s: int) -> np.ndarray:
        """Smallest s-word hash inside each window (all places)."""
        h = self.hashes(s)
        n = len(self.words) - k + 1
        out = h[:max(0, n)].copy()
        for j in range(1, k - s + 1):
            np.minimum(out, h[j:n + j], out=out)
        return out

    def seed_table(self, k: int, s: int):
        """(places, seed of each, distinct seeds in order, True where two documents hold one)."""
        at = self.places(k)
        seed = self.seeds(k, s)[at]
        distinct, inverse = np.unique(seed, return_inverse=True)
        low, high = np.full(len(distinct), len(self.ids)), np.full(len(distinct), -1)
        np.minimum.at(low, inverse, self.doc[at])
        np.maximum.at(high, inverse, self.doc[at])
        return at, inverse, distinct, low != high


def _by_part(h: np.ndarray, parts: int) -> np.ndarray:
    """Cuts of sorted hashes by part; parts is a power of two."""
    shift = np.uint64(64 - (parts.bit_length() - 1))
    return np.searchsorted(h >> shift if parts > 1 else np.zeros(len(h), "u8"), np.arange(parts + 1).astype("u8"))


def _send_seeds(k, s, parts, seed, bits):
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                _, _, distinct, multi = Block(r["data"], seed, bits).seed_table(k, s)
                cuts = _by_part(distinct, parts)
                rows = [_message(r["block"], p, zip_fields(zip_array(distinct[a:z].astype("<u8")), np.packbits(multi[a:z]).tobytes()))
                        for p, (a, z) in enumerate(zip(cuts, cuts[1:])) if z > a]
                yield from _batches(rows, _MESSAGE_SCHEMA)
    return run


def _answer_seeds(t: pa.Table) -> pa.Table:
    """Seeds of all blocks in one part -> for each block, a bit for every seed: held by two documents."""
    got = [unzip_fields(d) for d in t.column("data").to_pylist()]
    seeds = [unzip_array(g[0], "<u8") for g in got]
    multi = [np.unpackbits(np.frombuffer(g[1], "u1"), count=len(x)).astype(bool) for g, x in zip(got, seeds)]
    flat = np.concatenate(seeds)
    distinct, inverse, n = np.unique(flat, return_inverse=True, return_counts=True)
    again = n > 1
    np.logical_or.at(again, inverse, np.concatenate(multi))
    bits, at = [], 0
    for x in seeds:
        bits.append(np.packbits(again[inverse[at:at + len(x)]]).tobytes())
        at += len(x)
    return pa.table({"block": t.column("block"), "part": t.column("part"), "data": pa.array(bits, pa.binary())})


def _edges(b: Block, k: int, s: int, parts: int, answers: dict[int, bytes]):
    """Windows over repeated seeds: (places, edge number of each, distinct edge hashes in order)."""
    at, inverse, distinct, _ = b.seed_table(k, s)
    again = np.zeros(len(distinct), bool)
    cuts = _by_part(distinct, parts)
    for p, bits in answers.items():
        again[cuts[p]:cuts[p + 1]] = np.unpackbits(np.frombuffer(bits, "u1"), count=cuts[p + 1] - cuts[p]).astype(bool)
    at = at[again[inverse]] if len(at) else at
    h = b.hashes(k)[at] if len(at) else np.empty(0, "u8")
    edges, number = np.unique(h, return_inverse=True)
    first = np.full(len(edges), len(b.words), "i8")
    np.minimum.at(first, number, at)                  # documents lie in order of id: the first place is the smallest document's
    return at, number, edges, first


def _send_edges(k, s, parts, seed, bits):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _MESSAGE_SCHEMA.empty_table()
        b = Block(docs.column("data")[0].as_py(), seed, bits)
        _, _, edges, first = _edges(b, k, s, parts, dict(zip(answers.column("part").to_pylist(), answers.column("data").to_pylist())))
        ids = b.ids[b.doc[first]] if len(first) else np.empty(0, "<i8")
        cuts = _by_part(edges, parts)
        name = docs.column("block")[0].as_py()
        rows = [_message(name, p, zip_fields(zip_array(edges[a:z].astype("<u8")), zip_array(first[a:z].astype("<u4")), zip_array(ids[a:z].astype("<i8"))))
                for p, (a, z) in enumerate(zip(cuts, cuts[1:])) if z > a]
        return pa.Table.from_pylist(rows, schema=_MESSAGE_SCHEMA)
    return run


def _answer_edges(t: pa.Table) -> pa.Table:
    """Edges of all blocks in one part -> for each block: its edges with a smaller source, and those that are sources."""
    got = [[unzip_array(f, d) for f, d in zip(unzip_fields(x), ("<u8", "<u4", "<i8"))] for x in t.column("data").to_pylist()]
    sizes = np.array([len(g[0]) for g in got])
    h, place, ids = (np.concatenate([g[i] for g in got]) for i in range(3))
    block = np.repeat(np.arange(len(got)), sizes)
    order = np.lexsort((place, block, ids, h))
    new = np.r_[True, h[order][1:] != h[order][:-1]]
    source = np.empty(len(h), "i8")
    source[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    copy = ids[source] < ids
    used = np.zeros(len(h), bool)
    used[source[copy]] = True
    names = t.column("block").to_pylist()
    starts, out = np.cumsum(sizes) - sizes, []
    for i, n in enumerate(sizes):
        mine = slice(starts[i], starts[i] + n)
        c = np.flatnonzero(copy[mine])
        src = source[mine][c]
        blocks, local = np.unique(block[src], return_inverse=True)
        out.append(zip_fields(zip_array(c.astype("<u4")), zip_strings([names[x].encode() for x in blocks]), zip_array(local.astype("<u4")),
                              zip_array(place[src].astype("<u4")), zip_array(np.flatnonzero(used[mine]).astype("<u4"))))
    return pa.table({"block": t.column("block"), "part": t.column("part"), "data": pa.array(out, pa.binary())})


def _spans(k, s, parts, seed, bits):
    """Compact the repeated edges of a block, take covered words out, and give pieces to verify and words to verify them with."""
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _FOUND_SCHEMA.empty_table()
        name = docs.column("block")[0].as_py()
        b = Block(docs.column("data")[0].as_py(), seed, bits)
        by_kind: dict[str, dict[int, bytes]] = {"seed": {}, "edge": {}}
        for kind, p, d in zip(answers.column("kind").to_pylist(), answers.column("part").to_pylist(), answers.column("data").to_pylist()):
            by_kind[kind][p] = d
        at, number, edges, first = _edges(b, k, s, parts, by_kind["seed"])
        # source of each edge: (block number, place); -1 is a place of this block
        blocks: list[str] = []
        src_block, src_place = np.full(len(edges), -1, "i8"), first.copy()
        used = np.zeros(len(edges), bool)
        cuts = _by_part(edges, parts)
        known: dict[bytes, int] = {}
        for p, d in sorted(by_kind["edge"].items()):
            c, names, local, place, sources = unzip_fields(d)
            c = unzip_array(c, "<u4").astype("i8") + cuts[p]
            numbers = []
            for x in unzip_strings(names):
                if x not in known:
                    known[x] = len(blocks)
                    blocks.append(x.decode())
                numbers.append(known[x])
            if len(c):
                src_block[c] = np.array(numbers, "i8")[unzip_array(local, "<u4")]
                src_place[c] = unzip_array(place, "<u4")
            used[unzip_array(sources, "<u4").astype("i8") + cuts[p]] = True
        sb, sp = src_block[number], src_place[number]
        outside = sb >= 0
        inside = ~outside & (b.ids[b.doc[np.where(outside, at, sp)]] < b.ids[b.doc[at]]) if len(at) else np.zeros(0, bool)
        same = np.ones(len(at), bool)
        for j in range(k):                             # sources in the block are compared at once
            same[inside] &= b.codes[at[inside] + j] == b.codes[sp[inside] + j]
        failed = bool((inside & ~same).any())
        covered = np.zeros(len(b.words) + 1, "i8")
        hit = at[outside | (inside & same)]
        np.add.at(covered, hit, 1)
        np.add.at(covered, np.minimum(hit + k, len(b.words)), -1)
        gone = np.cumsum(covered)[:-1] > 0
        rows = []
        # nonbranching paths: next place, next source place, same source block; cut at the grid of the source
        o, ob, os_ = at[outside], sb[outside], sp[outside]
        if len(o):
            breaks = np.r_[True, (np.diff(o) != 1) | (np.diff(os_) != 1) | (np.diff(ob) != 0) | (os_[1:] % GRID == 0)
                           | (b.doc[o[1:]] != b.doc[o[:-1]])]
            a = np.flatnonzero(breaks)
            z = np.r_[a[1:], len(o)] - 1
            pieces = {}
            for i, j in zip(a.tolist(), z.tolist()):
                text = b" ".join(b.words[o[i]:o[j] + k])
                pieces[int(ob[i]), int(os_[i]), int(os_[j]), hashlib.md5(text).digest()] = None
            for blk, lo, hi, digest in pieces:
                rows.append({"kind": "piece", "block": blocks[blk], "cell": lo // GRID, "lo": lo % GRID, "hi": hi - lo // GRID * GRID, "data": digest, "dst": name})
        for cell in np.unique(first[used] // GRID).tolist() if used.any() else ():
            rows.append({"kind": "cell", "block": name, "cell": cell, "data": b" ".join(b.words[cell * GRID:cell * GRID + GRID + k - 1])})
        if failed:
            rows.append({"kind": "failed", "block": name, "dst": name})
        kept, removed = [], []
        for st, n in zip(b.starts.tolist(), b.counts.tolist()):
            g = gone[st:st + n]
            kept.append(b" ".join([w for w, x in zip(b.words[st:st + n], g.tolist()) if not x]) if g.any() else b" ".join(b.words[st:st + n]))
            edge = np.flatnonzero(np.diff(np.r_[False, g, False]))
            removed.append(edge.astype("<u4").tobytes())
        rows.append({"kind": "docs", "block": name, "dst": name, "data": zip_fields(
            zip_array(b.ids), zip_array(b.nulls), zip_array(b.counts.astype("<u4")), zip_strings(removed), zip_strings(kept))})
        return pa.Table.from_pylist(rows, schema=_FOUND_SCHEMA)
    return run


def _unpack(batches):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for b in batches:
        for d in b.column("data").to_pylist():
            ids, nulls, counts, removed, kept = unzip_fields(d)
            ids, nulls, counts = unzip_array(ids, "<i8"), unzip_array(nulls, "u1"), unzip_array(counts, "<u4")
            edges = [np.frombuffer(x, "<u4").astype("i4") for x in unzip_strings(removed)]
            flat = np.concatenate(edges) if edges else np.empty(0, "i4")
            ends = np.cumsum([0, *(len(x) // 2 for x in edges)])
            spans = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[::2], pa.int32()), pa.array(flat[1::2], pa.int32())], ["start", "end"]))
            n_removed = [int((x[1::2] - x[::2]).sum()) for x in edges]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=nulls.astype(bool)), pa.array(counts.astype("i8"), pa.int64()),
                                              pa.array(n_removed, pa.int64()), spans.cast(kind), pa.array(unzip_strings(kept), pa.binary()).cast(pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "spans", "kept_text"])


def _run(blocks: DataFrame, parts: int, window: int, seed_words: int, seed: int, bits: int) -> DataFrame:
    """Spans, pieces and kept words of all blocks under one hash function."""
    args = (window, seed_words, parts, seed, bits)
    seeds = blocks.mapInArrow(_send_seeds(*args), _MESSAGE)
    seed_answers = written(seeds.groupBy("part").applyInArrow(_answer_seeds, _MESSAGE), "seed-answers")
    edges = blocks.groupBy("block").cogroup(seed_answers.groupBy("block")).applyInArrow(_send_edges(*args), _MESSAGE)
    edge_answers = edges.groupBy("part").applyInArrow(_answer_edges, _MESSAGE)
    answers = (seed_answers.withColumn("kind", F.lit("seed")).unionByName(edge_answers.withColumn("kind", F.lit("edge"))))
    found = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_spans(*args), _FOUND)
    return written(found, "spans")


def _unverified(found: DataFrame, window: int) -> DataFrame:
    """Blocks with a span whose words differ from those at its source."""
    cells = found.where("kind = 'cell'").select("block", "cell", F.split(F.decode("data", "UTF-8"), " ").alias("words"))
    pieces = found.where("kind = 'piece'").select("block", "cell", "lo", "hi", "data", "dst")
    size = F.col("hi") - F.col("lo") + window
    digest = F.md5(F.array_join(F.slice("words", F.col("lo") + 1, size), " "))
    wrong = pieces.join(cells, ["block", "cell"], "left").where(F.coalesce(digest != F.lower(F.hex("data")), F.lit(True)))
    return wrong.select("dst").unionByName(found.where("kind = 'failed'").select("dst")).distinct()


def remove_repeated_spans(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                          seed_words: int = SEED_WORDS, hash_bits: int = HASH_BITS,
                          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept_text) of every row.

    A word goes if a window of ``window`` words covers it whose words also
    start in a document with a smaller id; spans are its [start, end) word
    ranges and kept_text the other words, joined by one space.

    * NULL and empty texts have no words.  Texts shorter than the window stay.
    * A NULL id counts as larger than all ids; rows of equal id (repeated rows,
      or all NULL ids) never remove words from each other.
    * Texts of any length are compared whole; an empty table gives no rows;
      other columns are not read.
    """
    parts = 1 << (parts_for(docs.count()).bit_length() - 1)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    blocks = written_by_key(rows.mapInArrow(_pack_blocks(block_bytes), _MESSAGE), "block", "substring_blocks", parts).select("block", "data")
    result, todo = None, None
    for seed in range(MAX_RUNS):
        found = _run(blocks, parts, window, seed_words, seed, hash_bits)
        bad = written(_unverified(found, window), "unverified")
        mine = found.where("kind = 'docs'")
        if todo is not None:
            mine = mine.join(todo, "dst", "left_semi")
        good = mine.join(bad, "dst", "left_anti").select("data") if not bad.isEmpty() else mine.select("data")
        result = good if result is None else result.unionByName(good)
        if bad.isEmpty():
            break
        todo = bad if todo is None else written(bad.join(todo, "dst", "left_semi"), "unverified")
        if todo.isEmpty():
            break
    else:
        raise RuntimeError("spans could not be verified")
    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string"
    out = result.mapInArrow(_unpack, schema)
    return out.withColumnRenamed("doc_id", id_col)


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d WHERE len(w) >= 13),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM p),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM g),
c AS (SELECT DISTINCT doc_id, i + j AS k FROM m, (SELECT unnest(range(13)) AS j) WHERE first < doc_id),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
r AS (SELECT x.doc_id, count(*) FILTER (WHERE c.k IS NOT NULL) AS n_removed,
             coalesce(string_agg(word, ' ' ORDER BY x.k) FILTER (WHERE c.k IS NULL), '') AS kept
      FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.k = c.k GROUP BY x.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""


@query("op10_substring_dedup", SQL)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_spans(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
