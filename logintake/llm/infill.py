"""Fill-in-middle: texts cut into prefix, middle and suffix, and put together anew.

A text is cut between units: code points, words or lines. It lies in blocks of a fixed
number of bytes, and a Fenwick tree over them stores how many units and how many code
points begin in each. The block of a cut is found by descending the tree by powers of two;
inside the block the cut is found by counting. So a text of any length is passed over once
to fill the tree, and each cut costs the logarithm of the blocks and one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logintake.llm.tables import SPACE, bytes_of, documents, slices

# Bytes of a block.
BLOCK = 1024
# Of 100 documents so many are changed at most, and of these so many get the suffix first.
RATE = 90
SPM = 20
UNITS = ("chars", "words", "lines")
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"


def unit_starts(data: np.ndarray, units: str) -> np.ndarray:
    """For each byte whether a unit begins there. A word begins the text or is a word's
    first byte, and takes the white space behind it; a line takes its newline."""
    if units == "chars":
        return (data & 0xC0) != 0x80
    out = np.zeros(len(data), bool)
    if units == "words":
        out[1:] = SPACE[data[:-1]] & ~SPACE[data[1:]]
    elif units == "lines":
        out[1:] = data[:-1] == 10
    else:
        raise ValueError(f"units must be one of {UNITS}, not {units!r}")
    out[:1] = True
    return out


class BlockTree:
    """Counts of units and code points over the blocks of one text."""

    def __init__(self, data: np.ndarray, units: str = "chars", block: int = BLOCK) -> None:
        self.data, self.units, self.block = data, units, block
        self.starts = unit_starts(data, units)
        heads = np.arange(0, len(data), block)
        self.n = len(heads)
        counts = np.zeros((2, self.n + 1), np.int64)
        if self.n:
            counts[0, 1:] = np.add.reduceat(self.starts, heads, dtype=np.int64)
            counts[1, 1:] = np.add.reduceat(unit_starts(data, "chars"), heads, dtype=np.int64)
        self.total, self.chars = counts.sum(axis=1).tolist()
        # Each node adds itself to the next one that covers it, level by level.
        step = 1
        while step <= self.n:
            child = np.arange(step, self.n + 1, 2 * step)
            parent = child + step
            child = child[parent <= self.n]
            counts[:, child + step] += counts[:, child]
            step *= 2
        self.tree = counts

    def cut(self, unit: int) -> tuple[int, int]:
        """The byte and the code point before which ``unit`` units lie."""
        if unit >= self.total:
            return len(self.data), self.chars
        at, left, chars = 0, unit, 0
        for level in range(self.n.bit_length() - 1, -1, -1):
            step = at + (1 << level)
            # The unit begins in the first block at whose end more than ``unit`` have begun.
            if step <= self.n and self.tree[0, step] <= left:
                at = step
                left -= int(self.tree[0, step])
                chars += int(self.tree[1, step])
        lo = at * self.block
        byte = lo + int(np.flatnonzero(self.starts[lo : lo + self.block])[left])
        return byte, chars + int(unit_starts(self.data[lo:byte], "chars").sum())


def draws(doc_id: int | None) -> list[int]:
    """Four numbers below 2**32 that hang on the id alone; a null id is an empty one."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def arranged(prefix: bytes, middle: bytes, suffix: bytes, form: str) -> bytes:
    parts = {"psm": (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle),
             "spm": (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)}[form]
    return b"".join(parts)


def restored(output: bytes, form: str) -> bytes:
    """The text that ``arranged`` cut, from what it made."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(first):
        raise ValueError(f"no {form} text")
    one, found, rest = output[len(first) :].partition(second)
    other, again, middle = rest.partition(MIDDLE)
    if not found or not again:
        raise ValueError(f"no {form} text")
    return one + middle + other if form == "psm" else other + middle + one


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", units: str = "chars",
    rate: int = RATE, spm: int = SPM, block: int = BLOCK, text: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n, form, prefix_chars, middle_chars,
    output_sha256, restored_sha256`` and, if asked for, the ``output``.

    ``n`` counts the units of the text. Form is plain, psm (prefix, suffix, middle) or spm;
    a text is plain, and its output the text itself, if it is empty, holds one of the marks,
    or is not drawn. What is drawn hangs on the document's id alone: rows of equal ids are
    cut at the same shares, and a null id is drawn like an empty one. A null text is empty;
    no rows give no rows. Lengths of prefix and middle are in code points, null if plain.
    A text is whole in its task's memory, however long.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
        ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
        ("output_sha256", pa.string()), ("restored_sha256", pa.string()),
        *([("output", pa.string())] if text else []),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, starts = bytes_of(batch.column("text"))
            rows = []
            for doc_id, lo, hi in zip(batch.column("doc_id").to_pylist(), starts[:-1].tolist(), starts[1:].tolist()):
                own = data[lo:hi]
                raw, tree = own.tobytes(), BlockTree(own, units, block)
                h1, h2, h3, h4 = draws(doc_id)
                form, output, lengths = "plain", raw, (None, None)
                if raw and h3 % 100 < rate and not any(m in raw for m in (PREFIX, SUFFIX, MIDDLE)):
                    form = "spm" if h4 % 100 < spm else "psm"
                    a, b = sorted((h1 % (tree.total + 1), h2 % (tree.total + 1)))
                    (a, chars_a), (b, chars_b) = tree.cut(a), tree.cut(b)
                    lengths = (chars_a, chars_b - chars_a)
                    output = arranged(raw[:a], raw[a:b], raw[b:], form)
                rows.append([
                    doc_id, tree.total, form, *lengths, hashlib.sha256(output).hexdigest(),
                    hashlib.sha256(restored(output, form)).hexdigest(), *([output.decode()] if text else []),
                ])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
            )

    kinds = {f.name: "long" if pa.types.is_int64(f.type) else "string" for f in schema}
    names = ", ".join(f"{n} {k}" for n, k in kinds.items())
    return documents(docs, id_col, text_col).mapInArrow(run, names)
