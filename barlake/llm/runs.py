"""Periodic runs of words, by longest common extensions over suffix trees.

A run is a stretch of words with smallest period q that no neighbouring word
extends, here of ``max(6, 4 * q)`` words or more.  Every run holds a Lyndon
root: a longest Lyndon word at its place, under the order of the words or the
reverse order.  So a document's candidates are its longest Lyndon words under
both orders, two for each word.  Each is extended right and left by a longest
common extension: the depth of a lowest common ancestor in the suffix tree of
the document or of its reversal.  Trees are built by Ukkonen's algorithm; an
Euler tour gives the leaves in suffix order with the depths between them, and
a sparse table over blocks of those answers each ancestor query in constant
time, for all candidates at once.

Before, words that no run can hold are taken out.  In a run of that length a
window of five words starts at three places or more, or again one to three
words on; a stretch not covered by such windows holds no run.  What is left
goes through the same test until nothing changes.  Each gap becomes a word of
its own, which no extension crosses.  Most documents have nothing left and
need no tree.

A document is one row; no rows meet, so there is no shuffle.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .blocks import sized_batches
from .common import WORD_PATTERN, let, query, read_table, word_array

MIN_LENGTH = 6
MIN_PERIODS = 4
WINDOW = 5                  # words; see _stretches for why this fits MIN_LENGTH and MIN_PERIODS
BATCH_BYTES = 8 << 20
BLOCK = 16                  # leaves whose depths the sparse table takes together
_WORD = re.compile(WORD_PATTERN)


class Extensions:
    """Longest common extensions of a sequence of numbers >= 0, over its suffix tree by Ukkonen's algorithm.

    ``rank`` gives every suffix its place in ascending order, ``reverse_rank`` (if asked for) in the
    order of descending numbers; in both a proper prefix comes first.
    """

    def __init__(self, s: list[int], both: bool = False):
        self.n = len(s)
        start, stop, children = _ukkonen([*s, -1])     # the end is smaller than any number
        leaves, depths = _tour(start, stop, children, self.n, False)
        self.rank = _inverse(leaves)
        self.reverse_rank = _inverse(_tour(start, stop, children, self.n, True)[0]) if both else None
        # minima of depths within blocks of leaves, and a sparse table over whole blocks
        h = np.full(-(-len(depths) // BLOCK) * BLOCK, self.n + 1, "i8")
        h[:len(depths)] = depths
        rows = h.reshape(-1, BLOCK)
        self.depths = h
        self.until = np.minimum.accumulate(rows, axis=1).ravel()
        self.since = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [rows.min(axis=1)]
        step = 1
        while 2 * step <= len(rows):
            low = self.table[-1]
            self.table.append(np.minimum(low[:len(low) - step], low[step:]))
            step *= 2

    def lengths(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the suffixes i and j share at their start (0 where one is empty); i != j."""
        out = np.zeros(len(i), "i8")
        ok = np.flatnonzero((i < self.n) & (j < self.n))
        a, b = self.rank[i[ok]], self.rank[j[ok]]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b)   # depths[a..b] hold the depth of the lowest common ancestor
        first, last = a // BLOCK, b // BLOCK
        best = np.minimum(self.since[a], self.until[b])
        inner = last - first - 1
        wide = np.flatnonzero(inner > 0)
        if len(wide):
            level = np.frexp(inner[wide].astype("f8"))[1] - 1
            for k in np.unique(level):
                at = wide[level == k]
                t = self.table[int(k)]
                best[at] = np.minimum(best[at], np.minimum(t[first[at] + 1], t[last[at] - (1 << int(k))]))
        same = np.flatnonzero(inner < 0)
        if len(same):
            low = np.full(len(same), self.n + 1, "i8")
            for k in range(BLOCK):
                place = np.minimum(a[same] + k, b[same])
                np.minimum(low, self.depths[place], out=low)
            best[same] = low
        out[ok] = best
        return out


def _inverse(order: list[int]) -> np.ndarray:
    out = np.empty(len(order), "i8")
    out[order] = np.arange(len(order))
    return out


def _ukkonen(text: list[int]) -> tuple[list[int], list[int], list[dict[int, int] | None]]:
    """Edges into each node as text[start:stop], and children by first number (None: a leaf); the root is 0."""
    end = len(text)
    start, stop, link = [0], [0], [0]
    children: list[dict[int, int] | None] = [{}]
    node, edge, length, left = 0, 0, 0, 0              # the active point, and suffixes still to add
    for i, c in enumerate(text):
        left += 1
        fresh = 0                                      # inner node that waits for its suffix link
        while left:
            if not length:
                edge = i
            below = children[node].get(text[edge])
            if below is None:
                children[node][text[edge]] = len(start)
                if fresh:
                    link[fresh] = node
                    fresh = 0
            else:
                a = start[below]
                size = min(stop[below], i + 1) - a
                if length >= size:
                    edge, length, node = edge + size, length - size, below
                    continue
                if text[a + length] == c:
                    length += 1
                    if fresh:
                        link[fresh] = node
                    break
                mid = len(start)
                start.append(a)
                stop.append(a + length)
                link.append(0)
                children.append({text[a + length]: below, c: mid + 1})
                children[node][text[edge]] = mid
                start[below] = a + length
                if fresh:
                    link[fresh] = mid
                fresh = mid
            start.append(i)
            stop.append(end)
            link.append(0)
            children.append(None)
            left -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - left + 1
    return start, stop, children


def _tour(start: list[int], stop: list[int], children: list, n: int, descending: bool) -> tuple[list[int], list[int]]:
    """Suffixes in the order of the tour, and the depth of the lowest common ancestor of each and the one before it."""
    leaves, depths = [], []
    todo = [(0, 0, 0)]                                 # node, its depth, the depth where its first leaf leaves the tour so far
    while todo:
        v, depth, branch = todo.pop()
        kids = children[v]
        if kids is None:
            if depth > 1:                              # but for the empty suffix
                leaves.append(n + 1 - depth)
                depths.append(branch)
            continue
        keys = sorted(kids, reverse=not descending)    # pushed last first
        if descending and keys[0] == -1:
            keys = [*keys[1:], -1]
        first = keys.pop()
        for k in keys:
            w = kids[k]
            todo.append((w, depth + stop[w] - start[w], depth))
        w = kids[first]
        todo.append((w, depth + stop[w] - start[w], branch))
    return leaves, depths


def _longest_lyndon(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each place: up to the next smaller suffix."""
    n = len(rank)
    ranks, out, stack = rank.tolist(), [0] * n, []
    for i in range(n - 1, -1, -1):
        r = ranks[i]
        while stack and ranks[stack[-1]] > r:
            stack.pop()
        out[i] = (stack[-1] if stack else n) - i
        stack.append(i)
    return np.array(out, "i8")


def runs_of(s: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``max(6, 4 * period)`` numbers or more, by start, then period."""
    n = len(s)
    if n < MIN_LENGTH:
        return []
    ahead, back = Extensions(s, both=True), Extensions(s[::-1])
    i = np.tile(np.arange(n), 2)
    p = np.concatenate([_longest_lyndon(ahead.rank), _longest_lyndon(ahead.reverse_rank)])
    near = np.flatnonzero(MIN_PERIODS * p <= n)
    i, p = i[near], p[near]
    right = ahead.lengths(i, i + p)
    left = np.zeros(len(i), "i8")
    inside = np.flatnonzero(i > 0)
    left[inside] = back.lengths(n - i[inside], n - i[inside] - p[inside])
    length = left + p + right
    ok = length >= np.maximum(MIN_LENGTH, MIN_PERIODS * p)
    return sorted(set(zip((i - left)[ok].tolist(), length[ok].tolist(), p[ok].tolist())), key=lambda r: (r[0], r[2]))


def _stretches(words: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """Stretches [a, b) of a row of word hashes, each within one owner, outside of which no run can be.

    A window of a run with period 4 or more starts at three places of it, any other again 1 to 3 words on.
    Words are compared by hash: equal hashes of different words can only keep a stretch, not lose one.
    """
    place, group, before = np.arange(len(words)), owner, -1
    while len(place) >= MIN_LENGTH and len(place) != before:
        before = len(place)
        w, starts = words[place].view("u8"), len(place) - WINDOW + 1
        key = group[:starts].astype("u8")
        for k in range(WINDOW):
            key = (key ^ w[k:starts + k]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        whole = group[:starts] == group[WINDOW - 1:]
        ordered = np.sort(key[whole])
        thrice = np.unique(ordered[2:][ordered[2:] == ordered[:-2]])
        hit = np.isin(key, thrice) if len(thrice) else np.zeros(starts, bool)
        for d in (1, 2, 3):
            same = (key[d:] == key[:-d]) & (group[d:starts] == group[:starts - d])
            hit[d:] |= same
            hit[:-d] |= same
        hit &= whole
        change = np.zeros(len(place) + 1, "i8")
        np.add.at(change, np.flatnonzero(hit), 1)
        np.add.at(change, np.flatnonzero(hit) + WINDOW, -1)
        covered = np.cumsum(change[:-1]) > 0
        new = np.ones(len(place), bool)
        new[1:] = (group[1:] != group[:-1]) | (covered[1:] != covered[:-1])
        name = np.cumsum(new)
        keep = covered & (np.bincount(name)[name] >= MIN_LENGTH)
        place, group = place[keep], name[keep]
    if len(place) < MIN_LENGTH:
        return []
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    ends = np.r_[first[1:], len(place)]
    return list(zip(place[first].tolist(), (place[ends - 1] + 1).tolist()))


def runs_of_texts(texts: list[list[str]]) -> list[list[tuple[int, int, int]]]:
    """Runs of every text, given as words."""
    sizes = np.fromiter(map(len, texts), "i8", len(texts))
    hashes = np.fromiter((hash(w) for t in texts for w in t), "i8", int(sizes.sum()))
    ends = np.cumsum(sizes)
    by_text: dict[int, list[tuple[int, int]]] = {}
    for a, b in _stretches(hashes, np.repeat(np.arange(len(texts)), sizes)):
        by_text.setdefault(int(np.searchsorted(ends, a, side="right")), []).append((a, b))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, parts in by_text.items():
        words, base, code = texts[k], int(ends[k] - sizes[k]), {}
        line, place = [], []                           # the text with each gap as one word of its own
        for a, b in parts:
            line.append(len(words) + len(line))        # larger than any code, and used once
            place.append(-1)
            line += [code.setdefault(w, len(code)) for w in words[a - base:b - base]]
            place += range(a - base, b - base)
        out[k] = [(place[a], n, p) for a, n, p in runs_of(line)]
    return out


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """Words that no run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, "i8")
    for a, n, p in runs:
        change[a + p] += 1
        change[a + n] -= 1
    return [w for w, c in zip(words, np.cumsum(change[:-1]).tolist()) if not c]


_RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"
_ARROW_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, text_col: str = "text", out: str = "periodic") -> DataFrame:
    """All columns but ``text_col``, plus a struct ``out``: n_words, runs (by start, then period) and the collapsed text.

    * NULL and empty texts have no words and no runs; their collapsed text is empty.
    * A text is read whole; memory follows the longest stretch of a text that may hold runs.
    * Runs may overlap; of a run only the first period stays, unless another run drops it.
    * Repeated rows give equal results; an empty table gives no rows; columns of any name pass
      through, but for ``out``, which must not be one.
    """
    rest = [c for c in docs.columns if c != text_col]
    if out.lower() in [c.lower() for c in rest]:
        raise ValueError(f"docs has a column {out}")
    keys = [f"c{i}" for i in range(len(rest))]
    cut = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(rest, keys)], F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_t"))
    schema = StructType([*[StructField(k, docs.schema[c].dataType) for c, k in zip(rest, keys)], StructField("n_words", LongType()),
                         StructField("runs", _parse(_RUN)), StructField("collapsed", StringType())])

    def run(batches):
        for b in sized_batches(batches, "_t", BATCH_BYTES):
            texts = [_WORD.findall(t) for t in b.column("_t").to_pylist()]
            runs = runs_of_texts(texts)
            found = [[{"start": a, "length": n, "period": p} for a, n, p in r] for r in runs]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in keys], pa.array(list(map(len, texts)), pa.int64()), pa.array(found, _ARROW_RUN),
                 pa.array([" ".join(collapse(t, r)) for t, r in zip(texts, runs)], pa.string())], names=[*keys, "n_words", "runs", "collapsed"])

    done = cut.mapInArrow(run, schema)
    return done.select(*[F.col(k).alias(c) for c, k in zip(rest, keys)], F.struct("n_words", "runs", "collapsed").alias(out))


def _parse(ddl: str):
    return StructType.fromDDL(f"x {ddl}")["x"].dataType


def made_periodic(text: Column, doc_id: Column) -> Column:
    """The contract's text: in a tenth of the documents, by checksum of the id, the words from some place on repeat with a period."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def of(w: Column) -> Column:
        n = F.size(w)
        return let((g % n).cast("int"), lambda a: let(1 + F.floor((n - a) / (3 + g % 8)).cast("int"), lambda p: F.array_join(
            F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, a + (i - a) % p))), " ")))

    return F.when((h % 10 == 0) & (F.regexp_count(text, F.lit(WORD_PATTERN)) > 0), let(word_array(text), of)).otherwise(text)


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", made_periodic(F.col("text"), F.col("doc_id")).alias("text"))
    r = periodic_runs(docs).select("doc_id", "periodic.*")
    line = F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"]))
    none = F.lit(None).cast(_parse(_RUN).elementType)
    better = lambda b, x: b.isNull() | (x["length"] * b["period"] > b["length"] * x["period"])  # noqa: E731  equal: the earlier stays
    best = F.aggregate("runs", none, lambda b, x: F.when(better(b, x), x).otherwise(b))
    return r.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "").alias("l"), "collapsed").select(
        "doc_id", "n_runs", "b.start", "b.length", "b.period", F.floor(1000 * F.col("b.length") / F.col("b.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.col("l").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
