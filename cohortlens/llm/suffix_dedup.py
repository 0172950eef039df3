"""Suffix-array removal of repeated byte strings, with deep-shallow sorting.

Every byte covered by a ``LENGTH``-byte string that also starts earlier is removed. Sorting all suffixes of
a corpus in one place is neither possible nor needed, so:

1. Anchors. A window of ``LENGTH`` bytes has one anchor: its ``GRAM``-byte string with the least hash (the
   leftmost of equals). Equal windows have equal anchors at equal places, so only windows whose anchor occurs
   twice can repeat. Neighbouring windows with one anchor form a run (about 40 windows).
2. Runs with the same anchor and the same bytes: all but the earliest are repeats, as they stand (aggregate and join).
3. The earliest of each kind of run, if its anchor has several kinds: their windows are sorted as suffixes.
   Runs of an anchor meet in one task; it sorts the
   windows with multikey quicksort over 8-byte words to ``SHALLOW`` bytes, then orders the groups that are still
   equal with blind tries (skip value and branching byte per node). Windows equal in all ``LENGTH`` bytes
   are a class; all but its earliest are repeats.
   An anchor with more than ``BLOCK`` kinds of runs is split by content: its windows are dealt into segments by where the anchor
   stands in them, and windows of a segment can only be equal if the bytes that all of them cover are, so each segment of a run goes
   to the group of those 90 bytes. No window is in two groups, so classes need no merging. Segments with the same bytes
   are one before they are sorted.
4. The marked runs of each document meet its text once.

Hashes only choose what is compared in 1 and 3; step 2 takes equal 64-bit hashes of anchor and of the run's bytes as equality.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import slices

LENGTH, GRAM, SHALLOW = 100, 24, 24
BLOCK = 4096
SEGMENT = 11                                      # places of the anchor in a window that make one segment
BATCH_BYTES = 1 << 19
CHUNK_RUNS = 8192
TAG_BITS, START_BITS, RUN_BITS = 25, 31, 7        # code = tag of the text | start of the run | number of windows
_NONE = -(2**63)                                  # stands for a null id
_B = 0x100000001B3
_POW = {n: np.uint64(pow(_B, n, 2**64)) for n in (1, 2, 4, 8, 16)}
_HIGH = np.uint64(0xFFFFFFFF00000000)


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    """64-bit hash of the ``GRAM`` bytes at each place, by doubling."""
    h = {1: b.astype(np.uint64) + np.uint64(1)}
    for n in (1, 2, 4, 8):
        h[2 * n] = h[n][:-n] * _POW[n] + h[n][n:]
    x = h[16][:-8] * _POW[8] + h[8][16:]
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    n = 1
    while 2 * n <= w:
        v = np.minimum(v[:-n], v[n:])
        n *= 2
    return v if n == w else np.minimum(v[:len(v) - (w - n)], v[w - n:])


def runs_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Runs of windows of several texts: (text number, start in the text, windows, anchor hash, hash of the run's bytes, place of the anchor in the run)."""
    ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
    data = b"".join(texts)
    if len(data) < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    h = _gram_hashes(np.frombuffer(data, np.uint8))
    low = _sliding_min((h & _HIGH) | np.arange(len(h), dtype=np.uint64), LENGTH - GRAM + 1)
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)        # place of the anchor of the window at each place
    at = np.arange(len(anchor))
    owner = np.searchsorted(ends, at, "right")
    whole = at + LENGTH <= ends[owner]                              # windows never cross texts
    at, anchor, owner = at[whole], anchor[whole], owner[whole]
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    cut = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
    n = np.diff(cut, append=len(at))
    start, view = at[cut], memoryview(data)
    digest = xxhash.xxh3_64_intdigest
    g = np.array([digest(view[s:e]) for s, e in zip(start.tolist(), (start + n - 1 + LENGTH).tolist())], np.uint64).view(np.int64)
    first = np.concatenate([[0], ends[:-1]])
    return owner[cut], start - first[owner[cut]], n, h[anchor[cut]].view(np.int64), g, anchor[cut] - start


def _words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Big-endian 8-byte words of ``data`` at the given places."""
    w = np.zeros(len(at), np.uint64)
    for i in range(8):
        w = (w << np.uint64(8)) | data[at + i]
    return w


def deep_shallow_sort(data: np.ndarray, starts: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, class) of the strings ``data[s:s + length]``: sorted order, and a number per place in it, equal for equal strings.

    Shallow part: multikey quicksort with 8-byte keys; in each round only groups that are equal so far are
    split by their next word. Deep part: blind tries for the groups left, all tries a level at a time: a
    node skips to the first byte in which its strings differ and branches there.
    """
    order = np.arange(len(starts))
    new = np.zeros(len(starts), bool)                 # does a new group begin here?
    new[:1] = True
    for depth in range(0, min(shallow, length), 8):
        group = np.cumsum(new)
        size = np.bincount(group)
        open_at = np.flatnonzero(size[group] > 1)
        if not len(open_at):
            break
        word, g = _words(data, starts[order[open_at]] + depth), group[open_at]
        by = np.lexsort((word, g))
        order[open_at], word, g = order[open_at][by], word[by], g[by]
        new[open_at[1:]] |= (g[1:] == g[:-1]) & (word[1:] != word[:-1])
    equal = np.zeros(len(starts), bool)               # groups known to be equal to the end
    columns = np.arange(shallow, length)
    while len(columns):
        group = np.cumsum(new)
        size = np.bincount(group)
        open_at = np.flatnonzero((size[group] > 1) & ~equal)
        if not len(open_at):
            break
        rest = data[starts[order[open_at]][:, None] + columns]
        head = np.flatnonzero(np.diff(group[open_at], prepend=-1))
        n = np.diff(head, append=len(open_at))
        differs = rest != np.repeat(rest[head], n, axis=0)
        skip = np.where(differs.any(1), differs.argmax(1), len(columns))
        skip = np.repeat(np.minimum.reduceat(skip, head), n)
        same = skip == len(columns)
        equal[open_at[same]] = True
        split = np.flatnonzero(~same)
        at, byte, g = open_at[split], rest[split, skip[split]], group[open_at[split]]
        by = np.lexsort((byte, g))
        order[at], byte, g = order[at][by], byte[by], g[by]
        new[at[1:]] |= (g[1:] == g[:-1]) & (byte[1:] != byte[:-1])
    return order, np.cumsum(new)


def repeated_windows(segments: list[bytes], doc: np.ndarray, place: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of runs by class: (run, offset in the run, is it the earliest of its class?).

    ``doc`` and ``place`` (tag and start) order the runs; run i has ``n[i]`` windows in ``segments[i]``.
    """
    data = np.frombuffer(b"".join(segments) + b"\0" * 8, np.uint8)
    base = np.concatenate([[0], np.cumsum([len(s) for s in segments])])[:-1]
    run = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    order, kind = deep_shallow_sort(data, base[run] + offset)
    run, offset = run[order], offset[order]
    by = np.lexsort((place[run] + offset, doc[run], kind))
    first = np.diff(kind[by], prepend=0) != 0
    return run[by], offset[by], first


def _tag(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(1 << TAG_BITS))


def _inputs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NONE)).alias("doc"), _tag(text).alias("tag"), text.alias("text"))


def _bytes(part: pa.RecordBatch) -> list[bytes]:
    return part.column("text").cast(pa.binary()).to_pylist()


def anchor_runs(rows: DataFrame) -> DataFrame:
    """(doc, code, h, g, anchor) of all runs; code packs the tag of the text, the start and the number of windows."""
    def compute(batches):
        for part in slices(batches, "text", BATCH_BYTES):
            owner, start, n, h, g, anchor = runs_of(_bytes(part))
            doc, tag = (part.column(c).to_numpy()[owner] for c in ("doc", "tag"))
            code = (tag << (START_BITS + RUN_BITS)) | (start << RUN_BITS) | n
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (doc, code, h, g)), pa.array(anchor, pa.int8())], ["doc", "code", "h", "g", "anchor"])
    return rows.mapInArrow(compute, "doc long, code long, h long, g long, anchor byte")


def _later(code: str, doc: str = "doc") -> Column:
    """Does the run stand after the earliest one?"""
    place = F.shiftright(F.col(code), RUN_BITS)
    first = F.shiftright(F.col("first.code"), RUN_BITS)
    return (F.col(doc) > F.col("first.doc")) | ((F.col(doc) == F.col("first.doc")) & (place > first))


def _marks(rows: DataFrame) -> DataFrame:
    """doc, tag and (start, windows) of whole runs."""
    return rows.select("doc", F.shiftright("code", START_BITS + RUN_BITS).alias("tag"),
                       F.shiftright("code", RUN_BITS).bitwiseAND(F.lit((1 << START_BITS) - 1)).alias("start"),
                       F.col("code").bitwiseAND(F.lit((1 << RUN_BITS) - 1)).alias("n"))


def segments_of(run: bytes, anchor: int) -> list[tuple[int, int, bytes, bytes]]:
    """(first window, windows, bytes that all of them cover, their bytes) of the segments of a run whose anchor stands at ``anchor``."""
    n, out = len(run) - LENGTH + 1, []
    for low in range(0, LENGTH - GRAM + 1, SEGMENT):         # windows whose anchor stands at low .. high
        high = min(low + SEGMENT - 1, LENGTH - GRAM)
        first, last = max(0, anchor - high), min(n - 1, anchor - low)
        if first <= last:
            out.append((first, last - first + 1, bytes([low]) + run[anchor - low:anchor - high + LENGTH], run[first:last + LENGTH]))
    return out


def _sorted_marks(kinds: DataFrame, rows: DataFrame) -> DataFrame:
    """Marks of windows that repeat across different kinds of runs of one anchor (step 3)."""
    per_doc = (kinds.select(F.col("first.doc").alias("doc"), F.shiftright("first.code", START_BITS + RUN_BITS).alias("tag"),
                            F.struct(F.col("first.code").alias("code"), F.col("first.anchor").alias("anchor"), "h", "hot").alias("run"))
               .groupBy("doc", "tag").agg(F.collect_list("run").alias("runs")))       # the runs of one document
    with_text = rows.join(per_doc, ["doc", "tag"])

    def cut(batches):
        types = {"doc": pa.int64(), "place": pa.int64(), "key": pa.int64(), "hot": pa.bool_(), "bytes": pa.binary()}
        for part in slices(batches, "text", BATCH_BYTES):
            out = []
            for doc, text, runs in zip(part.column("doc").to_pylist(), _bytes(part), part.column("runs").to_pylist()):
                for r in runs:
                    place, n = r["code"] >> RUN_BITS, r["code"] & ((1 << RUN_BITS) - 1)
                    start = place & ((1 << START_BITS) - 1)
                    run = text[start:start + n - 1 + LENGTH]
                    if r["hot"]:
                        out += [(doc, place + first, int.from_bytes(xxhash.xxh3_64_digest(core), "big", signed=True), True, held)
                                for first, _, core, held in segments_of(run, r["anchor"])]
                    else:
                        out.append((doc, place, r["h"], False, run))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types.values())], list(types))
    segments = with_text.select("doc", "text", "runs").mapInArrow(cut, "doc long, place long, key long, hot boolean, bytes binary")
    segments = cut_lineage(segments, "segments")
    hot = segments.filter("hot").select("doc", "place", "key", "bytes")
    firsts = cut_lineage(hot.groupBy("key", "bytes").agg(F.min(F.struct("doc", "place")).alias("first"), F.count("*").alias("times")), "hot-segments")
    n = (F.length("bytes") - LENGTH + 1).cast("long")
    again = (hot.join(firsts.filter("times > 1").select("key", "bytes", "first"), ["key", "bytes"]).filter(F.struct("doc", "place") > F.col("first"))
             .select("doc", "place", n.alias("n")))
    sortable = segments.filter("NOT hot").select("doc", "place", "key", "bytes").union(firsts.select("first.doc", "first.place", "key", "bytes"))
    sortable = sortable.repartition("key").sortWithinPartitions("key")

    def classes(batches):
        for rows_ in _whole_groups(batches):
            doc, place, segment = rows_["doc"].to_numpy(), rows_["place"].to_numpy(), rows_["bytes"].to_pylist()
            n = np.array([len(x) for x in segment], np.int64) - LENGTH + 1
            run, offset, first = repeated_windows(segment, doc, place, n)
            # repeats of this task, as runs of neighbouring windows
            again = np.zeros(int(n.sum()) + 1, bool)
            begin = np.cumsum(n) - n
            again[(begin[run] + offset)[~first]] = True
            flat = np.repeat(np.arange(len(n)), n)
            edge = np.flatnonzero(again[:-1] & (~np.concatenate([[False], again[:-2]]) | (np.diff(flat, prepend=-1) != 0)))
            stop = np.flatnonzero(again[:-1] & (~again[1:] | (np.diff(flat, append=-1) != 0))) + 1
            at = flat[edge]
            yield pa.RecordBatch.from_arrays([pa.array(doc[at], pa.int64()), pa.array(place[at] + (edge - begin[at]), pa.int64()), pa.array(stop - edge, pa.int64())], ["doc", "place", "n"])
    found = sortable.mapInArrow(classes, "doc long, place long, n long")
    return again.union(found).select("doc", F.shiftright("place", START_BITS).alias("tag"), F.col("place").bitwiseAND(F.lit((1 << START_BITS) - 1)).alias("start"), "n")


def _whole_groups(batches):
    """Tables of about ``CHUNK_RUNS`` rows that never cut a group of one key."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            key = batch.column("key").to_numpy()
            if rows >= CHUNK_RUNS:                       # go on to the end of the group that is open
                other = np.flatnonzero(key != held[-1].column("key")[-1].as_py())
                end = int(other[0]) if len(other) else batch.num_rows
                if end:
                    held.append(batch.slice(0, end))
                if end < batch.num_rows:
                    yield pa.Table.from_batches(held)
                    held, rows = [], 0
                batch = batch.slice(end)
                continue
            take = min(batch.num_rows, CHUNK_RUNS - rows)
            held.append(batch.slice(0, take))
            rows += take
            batch = batch.slice(take)
    if held:
        yield pa.Table.from_batches(held)


def repeat_marks(rows: DataFrame) -> DataFrame:
    """(doc, tag, start, n): windows start..start+n-1 of the text are repeats (steps 1 to 3)."""
    runs = anchor_runs(rows)
    # written, so that both sides of the next join are plain shuffles and a frequent anchor can be split
    twice = cut_lineage(runs.groupBy("h").agg(F.count("*").alias("times")).filter("times > 1").select("h"), "anchors")
    shared = cut_lineage(runs.join(twice, "h"), "runs")
    kinds = shared.groupBy("h", "g").agg(F.min(F.struct("doc", "code", "anchor")).alias("first"), F.count("*").alias("times"))
    kinds = cut_lineage(kinds, "kinds")
    copies = shared.join(kinds.filter("times > 1").select("h", "g", "first"), ["h", "g"]).filter(_later("code")).select("doc", "code")
    several = kinds.groupBy("h").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("h", (F.col("kinds") > BLOCK).alias("hot"))
    mixed = kinds.join(several, "h")
    return _marks(copies).union(_sorted_marks(mixed, rows))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``kept`` (the bytes that stay).

    Documents are ordered by id (integers; a null id comes first). Null and empty texts have no bytes. Rows
    that repeat an id and its text are one document, and each returns that document's result; different texts
    under one id are different documents. Other columns are ignored. Empty input gives an empty result.
    Texts may have up to 2 GiB of UTF-8.
    """
    rows = _inputs(docs, id_col, text_col)
    spans = repeat_marks(rows).groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "n")).alias("spans"))  # of one document
    joined = rows.join(spans, ["doc", "tag"], "left").select("doc", "text", "spans")

    def remove(batches):
        for part in slices(batches, "text", BATCH_BYTES):
            cols = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for text, spans_ in zip(_bytes(part), part.column("spans")):
                kept, n_spans = text, 0
                if spans_.is_valid and len(spans_):
                    flat = spans_.values
                    start, n = flat.field("start").to_numpy(), flat.field("n").to_numpy()
                    change = np.bincount(start, minlength=len(text) + 1) - np.bincount(start + n - 1 + LENGTH, minlength=len(text) + 1)
                    gone = np.cumsum(change[:len(text)]) > 0
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    n_spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                for k, v in (("n_bytes", len(text)), ("n_removed", len(text) - len(kept)), ("n_spans", n_spans),
                             ("kept_sha256", hashlib.sha256(kept).hexdigest()), ("kept", kept)):
                    cols[k].append(v)
            types = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([part.column("doc"), *(pa.array(v, t) for v, t in zip(cols.values(), types))], ["doc", *cols])
    out = joined.mapInArrow(remove, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumn("doc", F.when(F.col("doc") != _NONE, F.col("doc"))).withColumnRenamed("doc", id_col)
