"""Token ids of whole texts by the tokenizers library, fast on repeated words.

None of the tokenizers used here lets a token reach across the start of a run of
white space, across the end of an ASCII word before an ASCII mark, or across an added
token such as ``<|endoftext|>``, which is one id wherever it stands. So a text is cut
there, each distinct piece is encoded once, and the ids of the pieces are put together
again. The ids are those of the whole text.
"""

from __future__ import annotations

import functools
import json
import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from logintake.llm.tables import SPACE, bytes_of

# White space beyond ASCII in UTF-8, fixed values of the Unicode standard.
WIDE_SPACE = tuple(
    chr(c).encode()
    for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
# ASCII marks that end a word; a quote may belong to it (it's).
MARK = np.zeros(256, bool)
MARK[33:48] = MARK[58:65] = MARK[91:97] = MARK[123:127] = True
MARK[39] = False

# Pieces encoded by one call.
PIECES = 20_000

# Text encoded at a time: the more, the fewer pieces are encoded again. A process also
# keeps the ids of the first pieces it meets, which are the frequent ones, up to a number.
SLICE_BYTES = 8 << 20
KEPT = 400_000


@functools.cache
def tokenizer(path: str):
    """The tokenizer of a file, loaded once per process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@functools.cache
def added_tokens(path: str) -> dict[bytes, int]:
    """The strings that are one id each, wherever they stand in a text."""
    with open(path, encoding="utf-8") as file:
        listed = json.load(file).get("added_tokens") or []
    return {t["content"].encode(): t["id"] for t in listed}


@functools.cache
def _widths(path: str) -> np.ndarray:
    """Bytes that each id stands for. A word end counts for none."""
    names = tokenizer(path).get_vocab(with_added_tokens=True)
    out = np.zeros(max(names.values()) + 1, np.int64)
    for name, i in names.items():
        out[i] = len(name.removesuffix("</w>"))
    return out


def cuts(data: np.ndarray, starts: np.ndarray, added: dict[bytes, int]) -> np.ndarray:
    """Starts of the pieces: of each value, of each run of white space in it, of each ASCII
    mark behind an ASCII letter, and of what stands before and behind an added token."""
    space = SPACE[data]
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    # Wide white space before an ASCII one belongs to the same run: no cut.
    late = np.flatnonzero(cut[1:] & (data[:-1] >= 0x80)) + 1
    raw = data.tobytes() if len(late) or added else b""
    if len(late) and any(w in raw for w in WIDE_SPACE):
        for i in late.tolist():
            if raw[max(0, i - 3) : i].endswith(WIDE_SPACE):
                cut[i] = False
    cut[1:] |= MARK[data[1:]] & LETTER[data[:-1]]
    begins = starts[:-1][starts[:-1] < len(data)]
    cut[begins] = True
    found = []
    for token in added:
        i = raw.find(token)
        while i >= 0:
            found.append((i, -len(token)))
            i = raw.find(token, i + 1)
    # Leftmost and longest first; one that reaches into the next value is none.
    covered = 0
    for i, size in sorted(found):
        stop = i - size
        if i >= covered and not (cut[i + 1 : stop] & np.isin(np.arange(i + 1, stop), begins)).any():
            cut[i + 1 : stop] = False
            cut[i] = True
            if stop < len(cut):
                cut[stop] = True
            covered = stop
    return np.flatnonzero(cut)


def distinct_pieces(data: np.ndarray, at: np.ndarray) -> pa.DictionaryArray:
    """The pieces that begin at ``at``, each distinct one once, with its number."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at),
        [None, pa.py_buffer(np.append(at, len(data))), pa.py_buffer(np.ascontiguousarray(data))],
    ).dictionary_encode()


def ragged(flat: np.ndarray, where: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``where``, one after the other."""
    ends = np.cumsum(sizes)
    place = np.repeat((where - (ends - sizes)).astype(np.int32 if len(flat) < 1 << 30 else np.int64), sizes)
    place += np.arange(len(place), dtype=place.dtype)
    return flat[place]


class Kept:
    """Distinct pieces and their ids, one after the other, as far as a process keeps them."""

    def __init__(self, encode) -> None:
        self.encode = encode
        self.pieces = pa.array([], pa.large_binary())
        self.flat, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def look_up(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces: an array, and where each piece's begin in it and how many."""
        place = pc.index_in(pieces, self.pieces)
        new = np.flatnonzero(place.is_null().to_numpy(zero_copy_only=False))
        place = place.fill_null(0).to_numpy().astype(np.int64)
        flat, sizes = self.flat, self.sizes
        if len(new):
            unknown = pieces.take(pa.array(new))
            ids, each = self.encode(unknown)
            place[new] = len(sizes) + np.arange(len(new))
            flat, sizes = np.concatenate([flat, ids]), np.concatenate([sizes, each])
            room = min(KEPT - len(self.pieces), len(new))
            if room > 0:
                upto = len(self.sizes) + room
                self.pieces = pa.concat_arrays([self.pieces, unknown.slice(0, room)])
                self.sizes = sizes[:upto].copy()
                self.flat = flat[: int(self.sizes.sum())].copy()
        return flat, (np.cumsum(sizes) - sizes)[place], sizes[place]


@functools.cache
def _kept(path: str) -> Kept:
    return Kept(functools.partial(_encode, path=path))


def _encode(pieces: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, and how many each has. Pieces that begin with white space are
    encoded as one text, whose ids are cut by the bytes they stand for; the others, and
    any text whose bytes do not add up, one by one."""
    encoder = tokenizer(path)
    data, starts = bytes_of(pieces)
    solid = np.concatenate(([0], np.cumsum(~SPACE[data])))
    solid = solid[starts[1:]] - solid[starts[:-1]]
    heads = data[np.minimum(starts[:-1], max(0, len(data) - 1))] if len(data) else np.zeros(len(pieces), np.uint8)
    joined = np.flatnonzero(((heads == 32) | (heads == 10)) & (solid > 0))
    sizes = np.zeros(len(pieces), np.int64)
    # Ids come in two kinds of stretches, which are put in order at the end.
    parts, where, total = [], np.zeros(len(pieces), np.int64), 0
    alone = np.ones(len(pieces), bool)
    for lo in range(0, len(joined), PIECES):
        some = joined[lo : lo + PIECES]
        some_data, some_starts = bytes_of(pieces.take(pa.array(some)))
        text = some_data.tobytes().decode()
        widths = _solid_widths(text, some_data, some_starts, solid[some], encoder.normalizer is None)
        if widths is None:
            continue
        got = encoder.encode_batch_fast([text], add_special_tokens=False)[0].ids
        ids = np.array(got, np.uint32)
        ends = np.cumsum(widths)
        covered = np.concatenate(([0], np.cumsum(_widths(path)[ids])))
        upto = np.searchsorted(covered, ends, "right") - 1
        if not (covered[upto] == ends).all() or covered[-1] != ends[-1]:
            continue
        each = np.diff(upto, prepend=0)
        alone[some] = False
        sizes[some], where[some] = each, total + upto - each
        parts.append(ids)
        total += len(ids)
    single = np.flatnonzero(alone)
    for lo in range(0, len(single), PIECES):
        some = single[lo : lo + PIECES]
        texts = [p.decode() for p in pieces.take(pa.array(some)).to_pylist()]
        got = [e.ids for e in encoder.encode_batch_fast(texts, add_special_tokens=False)]
        each = np.fromiter(map(len, got), np.int64, len(got))
        sizes[some], where[some] = each, total + np.cumsum(each) - each
        parts.append(np.fromiter((i for ids in got for i in ids), np.uint32, int(each.sum())))
        total += int(each.sum())
    return ragged(np.concatenate([*parts, np.zeros(0, np.uint32)]), where, sizes), sizes


def _solid_widths(text: str, data: np.ndarray, starts: np.ndarray, solid: np.ndarray, lossless: bool):
    """Bytes of the ids of each piece of a text; None where they cannot be told."""
    if lossless:
        return np.diff(starts)
    if text.isascii():
        return solid
    if any(w in text for w in map(bytes.decode, WIDE_SPACE)):
        return None
    # Each piece begins with its only white space, so the changed text falls apart alike.
    changed = np.frombuffer(unicodedata.normalize("NFC", text).lower().encode(), np.uint8)
    space = SPACE[changed]
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins = np.flatnonzero(begins)
    if len(begins) != len(starts) - 1:
        return None
    upto = np.concatenate(([0], np.cumsum(~space)))
    return np.diff(np.append(upto[begins], upto[-1]))


def encode(column: pa.Array, path: str, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all values one after the other, and where each value's ids start
    (with the end of the last one). ``end_id`` closes each value."""
    data, starts = bytes_of(column)
    at = cuts(data, starts, added_tokens(path))
    pieces = distinct_pieces(data, at)
    codes = pieces.indices.to_numpy().astype(np.int64)
    flat, where, sizes = _kept(path).look_up(pieces.dictionary)
    return put_together(flat, where, sizes, codes, np.searchsorted(at, starts), end_id)


def put_together(
    flat: np.ndarray, where: np.ndarray, sizes: np.ndarray, codes: np.ndarray, first: np.ndarray,
    end_id: int | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the pieces ``codes``, and where those of each value start, whose pieces
    start at ``first``. ``end_id`` closes each value, as a piece of its own."""
    if end_id is not None:
        codes = np.insert(codes, first[1:], len(sizes))
        first = first + np.arange(len(first))
        sizes, where = np.append(sizes, 1), np.append(where, len(flat))
        flat = np.append(flat, np.uint32(end_id))
    each = sizes[codes]
    return ragged(flat, where[codes], each), np.concatenate(([0], np.cumsum(each)))[first]
