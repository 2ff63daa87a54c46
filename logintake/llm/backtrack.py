"""BPE by backtracking over longest matches, and decoding by an offset table.

A row of tokens is what the merges of a word give if, and only if, each two neighbours
are compatible: merging the two alone, by rank and leftmost first, never joins them. So
the encoder goes from left to right, takes the longest token that begins at a place (all
of them are found by an Aho-Corasick automaton in one pass), and looks the pair with the
token before up in a table. Where the pair is refused it tries the next shorter token, and
where none is left it takes the last token back. A place once found a dead end is never
tried again, which makes the time linear in the length of the word.

All words of a batch go on together, as arrays, as long as no token has to be taken back;
words in which one has are taken up one by one. A word ends in a mark of its own, so that the
tokens for word ends are plain strings, too.

Decoding gathers the bytes of each id from one table by an offset per id.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logintake.llm.tables import bytes_of, documents, slices
from logintake.llm.tokens import (
    Kept, added_tokens, cuts, distinct_pieces, put_together, ragged, tokenizer,
)

# Never part of a word: words are written in the letters that stand for bytes.
END, BREAK = "\n", "\t"
# Words encoded together, pieces normalised together, and ids decoded at a time.
WORDS = 50_000
PIECES = 20_000
DECODED = 1 << 18
# Entries of the pair table, which is filled as pairs are met, at most.
PAIRS = 2_000_000
SLICE_BYTES = 4 << 20
NEVER = 1 << 40


def letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, more = [], 256
    for byte in range(256):
        out.append(chr(byte) if byte in own else chr(more))
        more += byte not in own
    return out


class Merges:
    """The merges of a BPE model, and what the encoder derives from them."""

    def __init__(self, path: str) -> None:
        import ahocorasick

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("only BPE models with plain merges")
        for option in ("unk_token", "continuing_subword_prefix", "byte_fallback"):
            if model.get(option):
                raise ValueError(f"{option} is not supported")
        suffix = model.get("end_of_word_suffix") or ""
        self.end = END if suffix else ""

        def plain(name: str) -> str:
            return name.removesuffix(suffix) + END if suffix and name.endswith(suffix) else name

        ids = {plain(name): i for name, i in model["vocab"].items()}
        # Rank, left and right part of each token that a merge makes.
        self.rank: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = (ids[plain(part)] for part in (merge.split(" ") if isinstance(merge, str) else merge))
            whole = ids[(plain(merge.split(" ")[0]) + plain(merge.split(" ")[1])) if isinstance(merge, str)
                        else plain(merge[0]) + plain(merge[1])]
            if (left, right) not in self.rank:
                self.rank[left, right] = rank
                if whole in made:
                    raise ValueError("a token that two merges make")
                made[whole] = (rank, left, right)
        # A token that no merge makes can stand for one letter only.
        ids = {n: i for n, i in ids.items() if i in made or len(n.removesuffix(END)) == 1}
        self.names = {i: n for n, i in ids.items()}
        self.lengths = np.zeros(max(self.names) + 1, np.int64)
        for i, n in self.names.items():
            self.lengths[i] = len(n)
        self.made = made
        self.shorter = np.full(len(self.lengths), -1)
        for i, n in self.names.items():
            self.shorter[i] = self._prefix(n, ids)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for name, i in ids.items():
            self.automaton.add_word(name, i)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.edges: dict[int, list] = {}

    @staticmethod
    def _prefix(name: str, ids: dict[str, int]) -> int:
        """The longest token that a token begins with, itself left out; -1 for none."""
        for size in range(len(name) - 1, 0, -1):
            found = ids.get(name[:size])
            if found is not None:
                return found
        return -1

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at the left (1) or right (2) edge of a token while it is merged:
        each symbol, and the rank of the merge that ends it."""
        out, until = [], NEVER
        while True:
            out.append((token, until))
            if token not in self.made:
                return out[::-1]
            until = self.made[token][0]
            token = self.made[token][side]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges of both texts, put together, keep the two tokens apart."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        for token, side in ((left, 2), (right, 1)):
            if (token, side) not in self.edges:
                self.edges[token, side] = self._edge(token, side)
        a, b = self.edges[left, 2], self.edges[right, 1]
        i = j = 0
        while True:
            (one, one_ends), (other, other_ends) = a[i], b[j]
            # Of merges of equal rank the leftmost comes first.
            joined = self.rank.get((one, other), NEVER)
            if joined < one_ends and joined <= other_ends and joined < NEVER:
                return False
            if one_ends == other_ends == NEVER:
                return True
            if one_ends <= other_ends:
                i += 1
            else:
                j += 1

    def longest(self, text: str) -> np.ndarray:
        """The longest token that begins at each place of a text; -1 for none."""
        out = np.full(len(text), -1, np.int64)
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        # The automaton tells ends in order, so that the last one of a start is the longest.
        out[found[:, 0] - self.lengths[found[:, 1]] + 1] = found[:, 1]
        return out

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has."""
        text = BREAK.join(w + self.end for w in words) + BREAK
        found = self.longest(text)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + len(self.end)
        begin = np.cumsum(sizes + 1) - sizes - 1
        stop = begin + sizes
        # The first compatible match of all words, one step at a time.
        steps, live = [], np.flatnonzero(stop > begin)
        at, before = begin.copy(), np.full(len(words), -1)
        failed = []
        while len(live):
            token = found[at[live]]
            tried = np.arange(len(live))
            while len(tried):
                tried = tried[~self._all_compatible(before[live[tried]], token[tried])]
                token[tried] = self.shorter[token[tried]]
            good = token >= 0
            failed.append(live[~good])
            live, token = live[good], token[good]
            steps.append((live, token))
            before[live] = token
            at[live] += self.lengths[token]
            live = live[at[live] < stop[live]]
        lost = np.unique(np.concatenate([*failed, np.zeros(0, np.int64)]))
        one_by_one = [self._backtrack(found[begin[w] : stop[w]].tolist(), words[w]) for w in lost.tolist()]
        dropped = np.zeros(len(words), bool)
        dropped[lost] = True
        owner = np.concatenate([*(w[~dropped[w]] for w, _ in steps), np.repeat(lost, [len(x) for x in one_by_one])])
        ids = np.concatenate([*(t[~dropped[w]] for w, t in steps), np.array([i for x in one_by_one for i in x], np.int64)])
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.uint32), np.bincount(owner.astype(np.int64), minlength=len(words))

    def _all_compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pair table, looked up once for each distinct pair. -1 goes with all."""
        out = np.ones(len(left), bool)
        some = np.flatnonzero((left >= 0) & (right >= 0))
        pairs, back = np.unique(left[some] << 32 | right[some], return_inverse=True)
        known = [self.compatible(p >> 32, p & 0xFFFFFFFF) for p in pairs.tolist()]
        out[some] = np.array(known, bool)[back]
        return out

    def _backtrack(self, found: list[int], word: str) -> list[int]:
        tokens: list[int] = []
        dead = bytearray(len(found) + 1)
        at, token = 0, found[0]
        lengths, shorter, last = self.lengths, self.shorter, len(found)
        while at < last:
            while token >= 0:
                stop = at + int(lengths[token])
                if not dead[stop] and (not tokens or self.compatible(tokens[-1], token)):
                    break
                token = int(shorter[token])
            if token >= 0:
                tokens.append(token)
                at = stop
                token = found[at] if at < last else -1
                continue
            dead[at] = 1
            if not tokens:
                raise ValueError(f"the vocabulary cannot spell {word!r}")
            token = tokens.pop()
            at -= int(lengths[token])
            token = int(shorter[token])
        return tokens


class Encoder:
    """Ids as the tokenizers library gives them, without special tokens of its own, and
    its texts of ids. Normalisation and the cutting into words are the library's."""

    def __init__(self, path: str) -> None:
        self.merges = Merges(path)
        self.library = tokenizer(path)
        self.added = added_tokens(path)
        self.words = Kept(lambda words: self._by_word([w.decode() for w in words.to_pylist()]))
        self.pieces = Kept(self._by_piece)
        # The offset table: the bytes of each id, one after the other.
        names = self.library.get_vocab(with_added_tokens=True)
        spelled = [b""] * (max(names.values()) + 1)
        byte_of = {c: i for i, c in enumerate(letters())}
        # Without a decoder the names stand one after the other with spaces between.
        self.between = b"" if self.library.decoder is not None else b" "
        for name, i in names.items():
            raw = name.encode()
            if self.library.decoder is not None and all(c in byte_of for c in name):
                raw = bytes(byte_of[c] for c in name)
            spelled[i] = raw + self.between
        self.table = np.frombuffer(b"".join(spelled), np.uint8)
        self.widths = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.offsets = np.cumsum(self.widths) - self.widths

    def _by_word(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for lo in range(0, len(words), WORDS):
            some = self.merges.encode(words[lo : lo + WORDS])
            ids.append(some[0])
            sizes.append(some[1])
        return np.concatenate(ids), np.concatenate(sizes)

    def _by_piece(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for lo in range(0, len(pieces), PIECES):
            some = pieces.slice(lo, PIECES).to_pylist()
            words, upto = self._words_of([b"" if p in self.added else p for p in some])
            column = pa.array(words, pa.large_binary()).dictionary_encode()
            flat, where, each = self.words.look_up(column.dictionary)
            got, first = put_together(
                flat, where, each, column.indices.to_numpy().astype(np.int64), np.concatenate(([0], upto))
            )
            own = np.diff(first)
            for n, piece in enumerate(some):
                if piece in self.added:
                    got = np.insert(got, int(own[:n].sum()), self.added[piece])
                    own[n] = 1
            ids.append(got.astype(np.uint32))
            sizes.append(own)
        return np.concatenate(ids), np.concatenate(sizes)

    def _words_of(self, pieces: list[bytes]) -> tuple[list[str], list[int]]:
        """Words of all pieces, in the letters for bytes, and how many there are up to the
        end of each piece."""
        if self.library.normalizer is None:
            # White space counts here, so each piece is cut by itself.
            cut = [[w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(p.decode())] if p else [] for p in pieces]
            return list(chain.from_iterable(cut)), np.cumsum([len(c) for c in cut]).tolist()
        raw = b"".join(pieces).decode()
        # A letter for private use that is in none of the pieces stands between them.
        mark = next((c for c in map(chr, range(0xE000, 0xF900)) if c not in raw), None)
        if mark is None:
            parts = [self.library.normalizer.normalize_str(p.decode()) for p in pieces]
        else:
            parts = self.library.normalizer.normalize_str(mark.join(p.decode() for p in pieces)).split(mark)
        cut = self.library.pre_tokenizer.pre_tokenize_str(" ".join(parts))
        stops = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        begins = np.fromiter((at for _, (at, _) in cut), np.int64, len(cut))
        return [word for word, _ in cut], np.searchsorted(begins, stops).tolist()

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all values one after the other, and where each value's ids start (with
        the end of the last one)."""
        data, starts = bytes_of(column)
        at = cuts(data, starts, self.added)
        pieces = distinct_pieces(data, at)
        flat, where, sizes = self.pieces.look_up(pieces.dictionary)
        return put_together(
            flat, where, sizes, pieces.indices.to_numpy().astype(np.int64), np.searchsorted(at, starts)
        )

    def decode(self, ids: np.ndarray) -> Iterator[bytes]:
        """The text of ids, in UTF-8, in parts. Bytes that are none become U+FFFD."""
        held = b""
        for lo in range(0, len(ids), DECODED):
            some = ids[lo : lo + DECODED].astype(np.int64)
            held += ragged(self.table, self.offsets[some], self.widths[some]).tobytes()
            if lo + DECODED >= len(ids):
                held = held.removesuffix(self.between)
                yield held.decode(errors="replace").encode()
            else:
                # A letter that goes on in the next part waits for it.
                whole = len(held)
                for back in range(1, min(3, len(held)) + 1):
                    if held[-back] >= 0xC0:
                        whole -= back
                        break
                yield held[:whole].decode(errors="replace").encode()
                held = held[whole:]


@functools.cache
def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, made once per process."""
    return Encoder(path)


def encode_texts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    ids: bool = True, text: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, as
    asked for, ``ids`` and the ``decoded`` text.

    Ids are those of the file by the tokenizers library without added special tokens,
    truncation and padding; the decoded text is its ``decode`` with special tokens kept.
    ``ids_sha256`` is over the decimal ids with single spaces between. A null or empty text
    has no ids and an empty decoded text; null and repeated document ids are rows like
    others; no rows give no rows. A text is whole in its task's memory, however long.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()), *([("ids", pa.list_(pa.int64()))] if ids else []),
        *([("decoded", pa.string())] if text else []),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        names = [str(i) for i in range(len(coder.widths))]
        for batch in slices(batches, limit=SLICE_BYTES):
            flat, starts = coder.encode(batch.column("text"))
            rows: dict[str, list] = {name: [] for name in schema.names[1:]}
            for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
                own = flat[lo:hi]
                rows["n_tokens"].append(hi - lo)
                listed = " ".join([names[i] for i in own.tolist()])
                rows["ids_sha256"].append(hashlib.sha256(listed.encode()).hexdigest())
                digest, parts = hashlib.sha256(), []
                for part in coder.decode(own):
                    digest.update(part)
                    if text:
                        parts.append(part)
                rows["decoded_sha256"].append(digest.hexdigest())
                if ids:
                    rows["ids"].append(own.astype(np.int64))
                if text:
                    rows["decoded"].append(b"".join(parts).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(rows[n], schema.field(n).type) for n in schema.names[1:])],
                schema=schema,
            )

    kinds = {"doc_id": "long", "n_tokens": "long", "ids": "array<long>"}
    names = ", ".join(f"{n} {kinds.get(n, 'string')}" for n in schema.names)
    return documents(docs, id_col, text_col).mapInArrow(run, names)
