"""Statistics of one whole document, from its UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE, _SYMBOL = list(b" \t\n\v\f\r"), list(b"#*$%&|<>")
_DIGIT, _UPPER, _LOWER = list(b"0123456789"), list(range(65, 91)), list(range(97, 123))
_STOP, _PUNCT = list(b".!?"), list(b",;:'\"()-/\\[]{}=+_@~^`")

#: Columns of ``document_stats``: the counts first, then the ratios that the models read.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = ["mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "distinct_share", "digit_share", "upper_share",
          "letter_share", "stop_per_word", "punct_per_word", "lines_per_word", "short_line_share", "longest_word", "other_share"]


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """(words in 3-word windows that occur twice or more, distinct words)."""
    ids: dict[bytes, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    v = max(1, len(ids))
    if len(a) < 4:
        return 0, len(ids)
    pairs = a[:-1] * v + a[1:]
    if v > 1_000_000:                       # keeps the key of a window below 2**63
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * v + a[2:]
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0, len(ids)
    hit, mark = np.isin(keys, twice), np.zeros(len(a), bool)
    for i in range(3):
        mark[i:len(a) - 2 + i] |= hit
    return int(mark.sum()), len(ids)


def document_stats(raw: bytes) -> list[float]:
    """``COUNTS`` and ``RATIOS`` of a text; an empty text has zeros only."""
    words = raw.split()                     # cuts at space, tab, LF, VT, FF, CR: the words of the contract
    n = len(words)
    seen: set[bytes] = set()
    n_lines = n_dup = n_short = 0
    for line in raw.split(b"\n"):
        bare = line.strip()
        if bare:
            n_lines += 1
            n_short += len(bare) < 30
            if line in seen:
                n_dup += 1
            seen.add(line)
    by = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = len(raw) - int(by[128:192].sum())
    spaces, symbols = int(by[_SPACE].sum()), int(by[_SYMBOL].sum())
    repeat, distinct = repeated_words(words)
    w, c = max(1, n), max(1, chars - spaces)
    letters = int(by[_UPPER].sum() + by[_LOWER].sum())
    return [n, chars - spaces, symbols, n_dup, repeat,
            (chars - spaces) / w, symbols / w, n_dup / max(1, n_lines), repeat / w, distinct / w, by[_DIGIT].sum() / c,
            by[_UPPER].sum() / c, letters / c, by[_STOP].sum() / w, by[_PUNCT].sum() / w, n_lines / w, n_short / max(1, n_lines),
            float(max(map(len, words), default=0)), int(by[192:].sum()) / c]


def batch_stats(texts: pa.Array) -> np.ndarray:
    """One row of ``document_stats`` per text (null: empty)."""
    rows = [document_stats(t or b"") for t in texts.cast(pa.binary()).to_pylist()]
    return np.array(rows, float).reshape(len(rows), len(COUNTS) + len(RATIOS))
