"""Benchmark decontamination by the q-gram lemma.

A leak is a stretch of a document that is within one edit per ``CHARS_PER_EDIT`` characters of a stretch of at least ``STRETCH``
characters of a benchmark item, wherever it begins in the item. A stretch of twice that length or more holds a shorter one
with no higher rate, and a budget of e edits first holds at e * ``CHARS_PER_EDIT`` characters, so windows of 48, 64 and 80
characters at every place of the item are enough; those of 96 (``UNIT``) widen the regions. Shorter items count as a whole:
from ``MIN_CHARS`` characters within their edits, below that exactly and as whole words.

If a stretch of a document is within e edits of a window of m characters, both share at least m - q + 1 - q e character q-grams,
and their diagonals (place in the document minus place in the item) lie within 2 e of each other. So:

1. every q-gram of a whole text is looked up in the benchmark's q-grams (a bit table, then exactly);
2. shared q-grams are counted per item in diagonal bands that overlap, so that any 2 e + 1 neighbouring
   diagonals lie inside some band; bands below the bound cannot hold a match and are dropped, and so are windows of the others;
3. exact runs are regions as they are; the other windows are verified by banded alignment with free start and end in the document.

Texts are compared in lower case with every control or space character as a space. The benchmark is the stated query
set: it is read in blocks of at most ``BLOCK_CHARS`` characters, each broadcast as an index and run against all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import small_batches
from .common import broadcast_value, received, slices, texts_of

Q, UNIT, STRETCH = 10, 96, 48
MIN_CHARS = 32                  # shorter items are looked for exactly and as whole words
CHARS_PER_EDIT = 16             # the edit budget is a sixteenth of the stretch
BLOCK_CHARS = 1 << 20
BATCH_BYTES = 1 << 18          # arrays of a slice stay in the processor's cache
TABLE_BITS = 22
CHUNK = 1 << 21
_B = np.uint64(0x100000001B3)
_B2, _B4 = (np.uint64(int(_B) ** n % 2**64) for n in (2, 4))
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def lower(text: str) -> str:
    """Lower case of the same length: a character whose lower case is longer stays as it is."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def code_points(low: str) -> np.ndarray:
    """Code points of a lower-case text; controls and spaces become a space."""
    c = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    c[(c < 32) | ((c > 126) & (c <= 160)) | (c == 0x2028) | (c == 0x2029)] = 32
    return c


def gram_hashes(c: np.ndarray) -> np.ndarray:
    """64-bit hash of the ``Q`` code points at each place (by doubling)."""
    if len(c) < Q:
        return np.zeros(0, np.uint64)
    h1 = c.astype(np.uint64)
    h2 = h1[:-1] * _B + h1[1:]
    h4 = h2[:-2] * _B2 + h2[2:]
    h8 = h4[:-4] * _B4 + h4[4:]
    return h8[:-2] * _B2 + h2[8:]


@dataclass
class Index:
    """Items of a benchmark block, the sizes of their windows (a unit is an item and a size) and the places of their q-grams."""

    item: np.ndarray            # unit -> row of ``ids``
    ids: list
    chars: np.ndarray           # code points of all items, one after the other
    start: np.ndarray           # row -> its first place in ``chars``
    size: np.ndarray            # row -> its characters
    length: np.ndarray          # unit -> characters of its windows
    edits: np.ndarray
    least: np.ndarray           # shared q-grams a match must have
    row_least: np.ndarray       # row -> the least of its units
    table: np.ndarray           # may a q-gram with this slot exist?
    grams: np.ndarray           # distinct q-grams, sorted
    first: np.ndarray           # postings of gram g: first[g]..first[g+1]
    row: np.ndarray
    place: np.ndarray


def edit_budget(m: np.ndarray) -> np.ndarray:
    """A sixteenth of the stretch, and so few that the lemma's bound stays at one shared q-gram or more."""
    return np.minimum(m // CHARS_PER_EDIT, (m - Q) // Q)


def slots(h: np.ndarray) -> np.ndarray:
    return (h * _GOLD) >> np.uint64(64 - TABLE_BITS)


def build_index(items: list[tuple], stretch: int = UNIT) -> Index | None:
    """Index of (id, text) items for stretches of ``stretch`` characters; None if no item is long enough.

    Items under ``stretch`` characters have one window, the whole item.
    """
    item, length, ids, texts, hashes = [], [], [], [], []
    for key, text in items:
        c = code_points(lower(text or ""))
        if len(c) < MIN_CHARS:
            continue
        sizes = [n for n in range(stretch, UNIT + 1, CHARS_PER_EDIT) if n <= len(c)] or [len(c)]
        item += [len(ids)] * len(sizes)
        length += sizes
        ids.append(key)
        texts.append(c)
        hashes.append(gram_hashes(c))
    if not ids:
        return None
    row = np.repeat(np.arange(len(ids)), [len(h) for h in hashes])
    place = np.concatenate([np.arange(len(h)) for h in hashes])
    hashes = np.concatenate(hashes)
    order = np.argsort(hashes, kind="stable")
    grams, first = np.unique(hashes[order], return_index=True)
    table = np.zeros(1 << TABLE_BITS, bool)
    table[slots(grams)] = True
    item, length, size = np.array(item), np.array(length), np.array([len(c) for c in texts])
    e = edit_budget(length)
    least = length - Q + 1 - Q * e
    row_least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(row_least, item, least)
    return Index(item, ids, np.concatenate(texts), np.cumsum(size) - size, size, length, e, least, row_least, table, grams,
                 np.append(first, len(order)), row[order], place[order])


def _dense(hits: np.ndarray, index: Index) -> np.ndarray:
    """Which hits lie in some stretch, as long as the longest match, with as many hits as the least bound."""
    t, span = int(index.least.min()), UNIT + int(index.edits.max()) - Q
    if len(hits) < t:
        return np.zeros(len(hits), bool)
    start = np.flatnonzero(hits[t - 1:] - hits[:len(hits) - t + 1] <= span)
    mark = np.bincount(start, minlength=len(hits) + 1) - np.bincount(start + t, minlength=len(hits) + 1)
    return np.cumsum(mark[:len(hits)]) > 0


def _postings(hits: np.ndarray, gram: np.ndarray, index: Index):
    """Blocks of (item row, diagonal, place in the item) of the shared q-grams."""
    n = index.first[gram + 1] - index.first[gram]
    total = np.concatenate([[0], np.cumsum(n)])
    start = 0
    while start < len(hits):
        end = max(start + 1, int(np.searchsorted(total, total[start] + CHUNK, "right")) - 1)
        size = n[start:end]
        post = np.repeat(index.first[gram[start:end]] - (total[start:end] - total[start]), size) + np.arange(total[end] - total[start])
        yield index.row[post], np.repeat(hits[start:end], size) - index.place[post], index.place[post]
        start = end


def _band_keys(row: np.ndarray, diagonal: np.ndarray, step: int) -> np.ndarray:
    """The two bands of each diagonal, as (row, band) in one number; band b covers diagonals b step .. b step + 2 step - 1."""
    key = row * np.int64(1 << 32) + diagonal // step + (1 << 31)
    return np.concatenate([key, key - 1])


def candidates(hits: np.ndarray, gram: np.ndarray, index: Index, step: int) -> tuple[np.ndarray, ...]:
    """(bands with enough shared q-grams, then band number, diagonal and place of each of their q-grams)."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for row, diagonal, _ in _postings(hits, gram, index):
        k, c = np.unique(_band_keys(row, diagonal, step), return_counts=True)
        keys, back = np.unique(np.concatenate([keys, k]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([counts, c]), len(keys)).astype(np.int64)
    keys = keys[counts >= index.row_least[keys >> 32]]
    parts = [(np.zeros(0, np.int64),) * 3]
    for row, diagonal, place in _postings(hits, gram, index) if len(keys) else ():
        both = _band_keys(row, diagonal, step)
        band = np.minimum(np.searchsorted(keys, both), len(keys) - 1)
        held = keys[band] == both
        parts.append((band[held], np.tile(diagonal, 2)[held], np.tile(place, 2)[held]))
    return keys, *(np.concatenate(x) for x in zip(*parts))


def exact_runs(c: np.ndarray, band: np.ndarray, diagonal: np.ndarray, place: np.ndarray, keys: np.ndarray, index: Index) -> list[tuple]:
    """(band, start in the item, end, start in the text) of the stretches that are equal, as long as the shortest window or longer."""
    order = np.lexsort((place, diagonal, band))
    band, diagonal, place = band[order], diagonal[order], place[order]
    new = (np.diff(band, prepend=-1) != 0) | (np.diff(diagonal, prepend=0) != 0) | (np.diff(place, prepend=-2) != 1)
    starts = np.flatnonzero(new)
    n = np.diff(np.append(starts, len(band))) + Q - 1
    shortest = np.full(len(index.ids), UNIT)
    np.minimum.at(shortest, index.item, index.length)
    out = []
    for i, m in zip(starts, n):
        row = keys[band[i]] >> 32
        if m >= shortest[row]:
            a, s = int(place[i]), int(place[i] + diagonal[i])
            if np.array_equal(index.chars[index.start[row] + a:index.start[row] + a + m], c[s:s + m]):
                out.append((int(band[i]), a, a + int(m), s))
    return out


def _windows(band: np.ndarray, place: np.ndarray, room: np.ndarray, m: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(band, start) of the windows of ``m`` characters with ``least`` shared q-grams; ``room``: last start of the band's item."""
    wide = np.int64(1 << 32)
    keys = np.unique(band * wide + place)
    if len(keys) < least:
        return keys[:0], keys[:0]
    near = np.flatnonzero(keys[least - 1:] - keys[:len(keys) - least + 1] <= m - Q)
    first, last = keys[near] % wide, keys[near + least - 1] % wide
    b = keys[near] // wide
    low, high = np.maximum(0, last - (m - Q)), np.minimum(first, room[b])
    n = high - low + 1
    all_ = np.unique(np.repeat(b * wide + low - (np.cumsum(n) - n), n) + np.arange(n.sum()))
    return all_ // wide, all_ % wide


def _inside(band: np.ndarray, start: np.ndarray, m: int, known: list[tuple]) -> np.ndarray:
    """Which windows lie in the union of the known (band, start, end) stretches of their band?"""
    merged: list[list] = []
    for b, s, e in sorted(known):
        if merged and merged[-1][0] == b and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([b, s, e])
    if not merged:
        return np.zeros(len(band), bool)
    wide = np.int64(1 << 32)
    starts, ends = (np.array([x[0] * int(wide) + x[i] for x in merged]) for i in (1, 2))
    at = np.searchsorted(starts, band * wide + start, "right") - 1
    return (at >= 0) & (ends[np.maximum(at, 0)] >= band * wide + start + m)


def align(text: np.ndarray, first: np.ndarray, low: np.ndarray, m: int, e: int, step: int, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Banded alignment of the windows at ``first`` in ``index.chars`` against ``text`` from place ``low``: (edits, start, end) of the best match.

    Row i of the band holds the cells (i, low - e + i + k). A cell is edits * SCALE + k at the start, so the
    least cell also tells where its alignment began. Free start and end in the text.
    """
    width = 2 * step + 2 * e + 2
    scale = np.int64(1 << 10)
    k = np.arange(width)
    pad = UNIT + width + e
    padded = np.concatenate([np.full(pad, 1 << 30, np.uint32), text, np.full(pad + width, 1 << 30, np.uint32)])
    base = np.maximum(low - e + pad, 0)                     # place of (row 0, k = 0) in ``padded``
    cell = np.tile(k.astype(np.int64), (len(first), 1))
    for i in range(m):
        differs = padded[np.minimum(base[:, None] + i + k, len(padded) - 1)] != index.chars[first + i][:, None]
        step_ = cell + differs * scale
        step_[:, :-1] = np.minimum(step_[:, :-1], cell[:, 1:] + scale)
        cell = np.minimum.accumulate(step_ - k * scale, 1) + k * scale
    end = cell.argmin(1)
    best = cell[np.arange(len(first)), end]
    return best // scale, base - pad + best % scale, base - pad + end + m


def find_regions(c: np.ndarray, hits: np.ndarray, gram: np.ndarray, index: Index) -> list[tuple]:
    """Merged regions (item id, start, end, edits) of a text's code points, sorted; end exclusive.

    ``hits``: places of the q-grams that the benchmark has, ``gram``: their numbers in the index.
    """
    step = 2 * int(index.edits.max()) + 1
    keys, band, diagonal, place = candidates(hits, gram, index, step)
    if not len(keys):
        return []
    rows, low = keys >> 32, ((keys & 0xFFFFFFFF) - (1 << 31)) * step
    found: dict[int, list] = {}
    known = []                                              # stretches of items that need no further window
    for b, s, e, at in exact_runs(c, band, diagonal, place, keys, index):
        known.append((b, s, e))
        found.setdefault(int(rows[b]), []).append((at, at + e - s, 0))
    unit = np.flatnonzero(np.isin(index.item, rows))
    for m in sorted(set(index.length[unit].tolist()), reverse=True):
        some = unit[index.length[unit] == m]
        here = np.isin(rows[band], index.item[some])
        e = int(index.edits[some[0]])
        b, start = _windows(band[here], place[here], index.size[rows] - m, m, int(index.least[some[0]]))
        rest = ~_inside(b, start, m, known)
        b, start = b[rest], start[rest]
        for i in range(0, len(b), 4096):
            bi, si = b[i:i + 4096], start[i:i + 4096]
            edits, s, t = align(c, index.start[rows[bi]] + si, low[bi] + si, m, e, step, index)
            for j in np.flatnonzero(edits <= e):
                known.append((int(bi[j]), int(si[j]), int(si[j]) + m))
                found.setdefault(int(rows[bi[j]]), []).append((max(0, int(s[j])), min(len(c), int(t[j])), int(edits[j])))
    out = []
    for row, regions in found.items():
        merged: list[list] = []
        for s, e, d in sorted(set(regions)):
            if merged and s <= merged[-1][1]:
                merged[-1][1], merged[-1][2] = max(merged[-1][1], e), min(merged[-1][2], d)
            else:
                merged.append([s, e, d])
        out += [(index.ids[row], *m) for m in merged]
    return sorted(out, key=lambda r: (r[1], r[2], str(r[0])))


@dataclass
class ShortItems:
    """Items under ``MIN_CHARS`` characters by length: sorted hashes, and the (id, code points) of each hash."""

    hashes: dict[int, np.ndarray]
    items: dict[tuple, list]


def _running_hashes(c: np.ndarray, longest: int):
    """(n, hash of the n code points at each place) for n = 1 .. ``longest``."""
    h, c = np.zeros(len(c) + 1, np.uint64), c.astype(np.uint64)
    for n in range(1, min(longest, len(c)) + 1):
        h = h[:-1] * _B + c[n - 1:] + np.uint64(1)
        yield n, h


def build_short(items: list[tuple]) -> ShortItems | None:
    """Index of the (id, text) items under ``MIN_CHARS`` characters, without spaces around them; None if there are none."""
    by: dict[tuple, list] = {}
    for key, text in items:
        c = code_points(lower(text or ""))
        solid = np.flatnonzero(c != 32)
        if len(c) < MIN_CHARS and len(solid):
            c = c[solid[0]:solid[-1] + 1]
            *_, (n, h) = _running_hashes(c, len(c))
            by.setdefault((n, int(h[0])), []).append((key, c))
    if not by:
        return None
    return ShortItems({n: np.array(sorted(h for m, h in by if m == n), np.uint64) for n in {n for n, _ in by}}, by)


def find_short(c: np.ndarray, index: ShortItems) -> list[tuple]:
    """(item id, start, end, 0) of every place where a short item stands exactly and as whole words."""
    part = lambda i: 0 <= i < len(c) and chr(c[i]).isalnum()
    out = []
    for n, h in _running_hashes(c, max(index.hashes)):
        if n not in index.hashes:
            continue
        at = np.minimum(np.searchsorted(index.hashes[n], h), len(index.hashes[n]) - 1)
        for s in np.flatnonzero(index.hashes[n][at] == h).tolist():
            cut = (part(s - 1) and part(s)) or (part(s + n - 1) and part(s + n))
            out += [(key, s, s + n, 0) for key, x in index.items[n, int(h[s])] if not cut and np.array_equal(x, c[s:s + n])]
    return sorted(out, key=lambda r: (r[1], r[2], str(r[0])))


def scan_texts(texts: list[str], index: Index | ShortItems) -> list[list[tuple]]:
    """Regions of each text; q-grams of all texts are looked up together."""
    if not hasattr(index, "table"):                            # ShortItems; classes are pickled by value, so no isinstance
        return [find_short(code_points(lower(t)), index) for t in texts]
    low = [lower(t) for t in texts]
    c, ends = code_points("".join(low)), np.cumsum([len(t) for t in low])
    out: list[list[tuple]] = [[] for _ in texts]
    h = gram_hashes(c)
    hits = np.flatnonzero(index.table[slots(h)])
    gram = np.minimum(np.searchsorted(index.grams, h[hits]), len(index.grams) - 1)
    owner = np.searchsorted(ends, hits, "right")
    real = (index.grams[gram] == h[hits])
    real[real] = hits[real] + Q <= ends[owner[real]]            # not across two texts
    hits, gram, owner = hits[real], gram[real], owner[real]
    dense = _dense(hits, index)
    hits, gram, owner = hits[dense], gram[dense], owner[dense]
    cuts = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
    for s, e in zip(cuts[:-1], cuts[1:]):
        i = owner[s]
        start = ends[i] - len(low[i])
        out[i] = find_regions(c[start:ends[i]], hits[s:e] - start, gram[s:e], index)
    return out


def _blocks(rows: DataFrame, block_chars: int):
    """(id, text) rows in blocks of ``block_chars`` characters, or a single longer item."""
    held, size = [], 0
    for r in rows.toLocalIterator():                 # block by block: the query set, never the documents
        held.append((r["id"], r["text"]))
        size += len(r["text"])
        if size >= block_chars:
            yield held
            held, size = [], 0
    yield held


def benchmark_indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> list[Index]:
    """One index per block of the items of ``MIN_CHARS`` characters or more."""
    rows = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.length("text") >= MIN_CHARS)
    return [x for x in (build_index(held, STRETCH) for held in _blocks(rows, block_chars)) if x is not None]


def short_indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> list[ShortItems]:
    """One index per block of the shorter items."""
    rows = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.length("text") < MIN_CHARS)
    return [x for x in (build_short(held) for held in _blocks(rows, block_chars)) if x is not None]


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``contaminated``, ``n_regions``, ``item_ids`` and ``regions``.

    ``regions``: ``item:start:end:edits`` by start, comma-joined (code points, end exclusive), overlapping
    regions of an item merged; ``item_ids``: the distinct items, sorted. Null and empty texts have none, and so have
    all texts if the benchmark is empty; null and blank benchmark texts define
    nothing. Repeated rows and null ids are rows like any other; other columns are ignored. Empty input gives an
    empty result.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.array().cast("array<string>").alias("found"))
    for index in benchmark_indexes(benchmark) + short_indexes(benchmark):
        shared = broadcast_value(docs.sparkSession, index)           # bounded by BLOCK_CHARS

        def search(batches, shared=shared):
            held = received(shared)
            for part in slices(batches, "text", BATCH_BYTES):
                new = scan_texts(texts_of(part), held)
                found = [a + [":".join(map(str, r)) for r in b] for a, b in zip(part.column("found").to_pylist(), new)]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("text"), pa.array(found, pa.list_(pa.string()))], ["id", "text", "found"])
        rows = rows.mapInArrow(search, rows.schema)
    ordered = F.transform(F.array_sort(F.transform("found", lambda x: F.struct(
        F.split(x, ":")[1].cast("long").alias("s"), F.split(x, ":")[2].cast("long").alias("e"), x.alias("x")))), lambda r: r["x"])
    items = F.array_sort(F.array_distinct(F.transform("found", lambda x: F.split(x, ":")[0].cast(benchmark_id_type(benchmark)))))
    return rows.select(F.col("id").alias(id_col), (F.size("found") > 0).alias("contaminated"), F.size("found").cast("long").alias("n_regions"),
                       items.alias("item_ids"), F.array_join(ordered, ",").alias("regions"))


def benchmark_id_type(benchmark: DataFrame, id_col: str = "item_id") -> str:
    return benchmark.schema[id_col].dataType.simpleString()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns as they are) in which no benchmark region is found."""
    small_batches(docs.sparkSession)
    for index in benchmark_indexes(benchmark) + short_indexes(benchmark):
        shared = broadcast_value(docs.sparkSession, index)

        def keep(batches, shared=shared):
            held = received(shared)
            for part in slices(batches, text_col, BATCH_BYTES):
                yield part.filter(pa.array([not r for r in scan_texts(texts_of(part, text_col), held)], pa.bool_()))
        docs = docs.mapInArrow(keep, docs.schema)
    return docs
