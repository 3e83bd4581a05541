"""Word hashes of UTF-8 texts, vectorised: one pass of numpy over many texts at once."""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

SEGMENT = 1 << 20  # bytes handled at once; longer texts are taken in pieces cut between words

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = True
_IS_WORD[128:] = True  # letters beyond ASCII


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(int(base), done, 1 << 64))
        done += step
    return out


_POW = _powers(_P, SEGMENT + 2)
_INV = _powers(_P_INV, SEGMENT + 2)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, 64-bit hash) of each lower-cased word of at most ``SEGMENT`` bytes."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    word = _IS_WORD[data]
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _POW[: len(data)], out=sums[1:])
    return starts, _mix((sums[ends] - sums[starts]) * _INV[starts])


def pieces(texts: Iterable[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Yield (marks, bytes) of at most ``SEGMENT`` bytes; ``marks`` are (first byte, text number) rows.

    Short texts are joined by line feeds; a longer one is cut between words
    (or anywhere, where a word is longer than 4096 bytes)."""
    held, marks, size = [], [], 0
    for number, text in enumerate(texts):
        text = text or b""
        at = 0
        while True:
            room = SEGMENT - size - 1
            if len(text) - at <= room:
                held += [text[at:], b"\n"]
                marks.append((size, number))
                size += len(text) - at + 1
                break
            if size:
                yield np.array(marks), np.frombuffer(b"".join(held), np.uint8)
                held, marks, size = [], [], 0
                continue
            part = np.frombuffer(text, np.uint8, SEGMENT, at)
            gaps = np.flatnonzero(~_IS_WORD[part[-4096:]])
            cut = SEGMENT - 4096 + int(gaps[-1]) + 1 if len(gaps) else SEGMENT
            yield np.array([(0, number)]), part[:cut]
            at += cut
    if size:
        yield np.array(marks), np.frombuffer(b"".join(held), np.uint8)


def gram_features(texts: Iterable[bytes | None], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Yield (document number, feature) arrays: hashed single words, pairs of
    neighbours and skip-grams (one word left out between), in text order.
    Words on both sides of a cut form pairs as well."""
    shift = np.uint64(64 - bits)
    tail_doc, tail = np.empty(0, np.int64), np.empty(0, np.uint64)
    for marks, data in pieces(texts):
        starts, h = word_hashes(data)
        doc = marks[np.searchsorted(marks[:, 0], starts, "right") - 1, 1]
        new = len(tail)
        doc, h = np.concatenate([tail_doc, doc]), np.concatenate([tail, h])
        out_doc, out = [doc[new:]], [h[new:] >> shift]
        for gap, salt in ((1, 0xD6E8FEB86659FD93), (2, 0xA0761D6478BD642F)):
            right = np.arange(max(gap, new), len(h))
            right = right[doc[right] == doc[right - gap]]
            pair = _mix(h[right - gap] * np.uint64(salt) + h[right])
            out_doc.append(doc[right])
            out.append(pair >> shift)
        tail_doc, tail = doc[-2:], h[-2:]
        yield np.concatenate(out_doc), np.concatenate(out).astype(np.int64)
