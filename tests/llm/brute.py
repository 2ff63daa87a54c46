"""The contracts of the operators, written down row by row."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def encoded(text: str | None, path: str, end_id: int) -> list[int]:
    from tokenizers import Tokenizer

    known = encoded.__dict__.setdefault("known", {})
    if path not in known:
        known[path] = Tokenizer.from_file(path)
    return [*known[path].encode(text or "", add_special_tokens=False).ids, end_id]


def digests(docs: list[tuple], path: str) -> list[tuple]:
    """op9: doc_id, start, n_tokens, ids_crc32."""
    out, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        ids = encoded(text, path, 0)
        out.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def simhash(text: str | None) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def clusters(values: list[int], radius: int) -> list[int]:
    """The first place of each value's component, by all pairs."""
    root = list(range(len(values)))

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(values))]


def captures(pages: list[tuple], least: int = 0) -> list[tuple]:
    """op8: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    data = [(i, (html or "").encode()) for i, _, html in pages]
    groups = defaultdict(list)
    for i, payload in data:
        groups[payload].append(i)
    out = []
    for i, payload in data:
        known = [x for x in groups[payload] if x is not None]
        top = max(known) if known else None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = len(payload) >= least and i != top
        out.append((i, len(payload), digest, "revisit" if revisit else "response", top if revisit else None))
    return out


def same_texts(docs: list[tuple]) -> list[tuple]:
    """op5: doc_id, keep_id, group_size, text_sha256."""
    norm = [(i, re.sub("[\x20\x09-\x0d]+", " ", t or "")) for i, t in docs]
    groups = defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    out = []
    for i, t in norm:
        known = [x for x in groups[t] if x is not None]
        out.append((i, min(known) if known else None, len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
    return out


KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 18),
    ("hex", r"([0-9a-f]+)", 1, 16),
]


def secrets(text: str | None) -> list[tuple]:
    """op1: start, rank, stop, kind, value of each span, by start, then kind."""
    out = []
    for rank, (kind, pattern, group, least) in enumerate(KINDS):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m[group]) >= least:
                out.append((m.start(), rank, m.end(), kind, m[group]))
    return sorted(out)


def chunks(text: str, window: int = 2, min_lines: int = 2, divisor: int = 2, long_line: int = 50) -> list[list[str]]:
    """op4: the lines of each chunk."""
    lines = text.split("\n")
    hashes = [xxhash.xxh64_intdigest(line.encode(), 42) for line in lines]
    out, held = [], []
    for i, line in enumerate(lines):
        long = len(line.encode().split()) >= long_line
        if long and held:
            out.append(held)
            held = []
        held.append(line)
        rolled = 0
        for back in range(min(window, i + 1)):
            h = hashes[i - back]
            rolled ^= ((h << back) | (h >> (64 - back))) & (2**64 - 1) if back else h
        mark = (rolled >> 32) % divisor == 0
        if long or (mark and len(held) >= min_lines):
            out.append(held)
            held = []
    return out + [held] if held else out


def without_repeats(docs: list[tuple], **options) -> dict[tuple, str]:
    """op4: the text left of each (doc_id, text)."""
    cut = {d: chunks(d[1] or "", **options) for d in set(docs)}
    first = {}
    long = options.get("long_line", 50)

    def counts(chunk: list[str]) -> bool:
        words = "\n".join(chunk).encode().split()
        return bool(words) and (len(chunk) > 1 or len(words) >= long)

    for d in sorted(cut, key=lambda d: (d[0] is None, d[0])):
        for n, chunk in enumerate(cut[d]):
            if counts(chunk):
                first.setdefault("\n".join(chunk), (d, n))
    out = {}
    for d, parts in cut.items():
        stay = [c for n, c in enumerate(parts) if not counts(c) or first["\n".join(c)] == (d, n)]
        out[d] = "\n".join("\n".join(c) for c in stay)
    return out


def n_words(line: str) -> int:
    return len(line.encode().split())


def repeated_lines(docs: list[tuple], least: int = 50) -> dict[tuple, set]:
    """The lines of each document that lie in a stretch of ``least`` words which equals an
    earlier one, extended line by line from each pair of equal lines with a word."""
    docs = sorted(set(docs), key=lambda d: (d[0] is None, d[0]))
    cut = [(d[1] or "").split("\n") for d in docs]
    places, gone = defaultdict(list), defaultdict(set)
    for d, lines in enumerate(cut):
        for q, line in enumerate(lines):
            if not n_words(line):
                continue
            for e, p in places[line]:
                if p and q and cut[e][p - 1] == lines[q - 1] and n_words(lines[q - 1]):
                    continue
                size = 0
                while p + size < len(cut[e]) and q + size < len(lines) and cut[e][p + size] == lines[q + size]:
                    size += 1
                while not n_words(lines[q + size - 1]):
                    size -= 1
                words = np.cumsum([n_words(x) for x in lines[q : q + size]])
                if words[-1] >= least:
                    # Where the two overlap, the first passage stays.
                    kept = p + 1 + int(np.searchsorted(words, least)) if e == d else 0
                    gone[docs[d]] |= set(range(max(q, kept), q + size))
            places[line].append((d, q))
    return gone


def without_stretches(docs: list[tuple]) -> dict[tuple, str]:
    """op4: what neither the chunks nor the stretches take from each (doc_id, text)."""
    stretches, first = repeated_lines(docs), {}
    out = {}
    for d in sorted(set(docs), key=lambda d: (d[0] is None, d[0])):
        gone, at = set(stretches[d]), 0
        for part in chunks(d[1] or ""):
            words = n_words("\n".join(part))
            if words and (len(part) > 1 or words >= 50) and first.setdefault("\n".join(part), (d, at)) != (d, at):
                gone |= set(range(at, at + len(part)))
            at += len(part)
        out[d] = "\n".join(x for n, x in enumerate((d[1] or "").split("\n")) if n not in gone)
    return out


def plain_words(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    kept = re.sub(r"[!-/:-@\[-`{-~]", "", lower)
    return [w for w in re.split("[\x20\x09-\x0d]+", kept) if w]


def overlaps(docs: list[tuple], items: list[tuple], window: int = 13, share: float = 0.8) -> set[tuple]:
    """op7: (doc_id, item_id) with a window of enough agreeing words, over all alignments."""
    found = set()
    for i, item in items:
        other = plain_words(item)
        size = min(window, len(other))
        if not other:
            continue
        places = defaultdict(list)
        for k, word in enumerate(other):
            places[word].append(k)
        for d, text in docs:
            lines = defaultdict(list)
            for at, word in enumerate(plain_words(text)):
                for k in places.get(word, ()):
                    lines[at - k].append(k)
            for same in lines.values():
                if len(same) >= share * size - 1e-9 and any(
                    sum(lo <= k < lo + size for k in same) >= share * size - 1e-9
                    for lo in range(len(other) - size + 1)
                ):
                    found.add((d, i))
    return found


def preferences(chosen: list[tuple], rejected: list[tuple]) -> set[tuple]:
    """op2: pair_id, part, number, role, text from (pair_id, turn, role, text), one per turn."""
    sides = []
    for side in (chosen, rejected):
        by = defaultdict(list)
        for pair, turn, role, text in sorted(set(side)):
            by[pair].append((role, text))
        sides.append(by)
    out = set()
    for pair in {*sides[0], *sides[1]}:
        one, other = sides[0].get(pair, []), sides[1].get(pair, [])
        n = 0
        while n < min(len(one), len(other)) and one[n] == other[n]:
            n += 1
        out |= {(pair, "prompt", k, *t) for k, t in enumerate(one[:n])}
        out |= {(pair, "chosen", k, *t) for k, t in enumerate(one) if k >= n}
        out |= {(pair, "rejected", k, *t) for k, t in enumerate(other) if k >= n}
    return out


def importance(docs: list[tuple], labels: list[tuple], buckets: int, sample: int = 100_000) -> list[tuple]:
    """op10: weight, key and kept of each (doc_id, text), and k, from (doc_id, quality, toxic)."""
    mix, whole = 0x9E3779B97F4A7C15, 2**64

    def grams(text: str | None) -> tuple[list[int], int]:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()
        words = re.findall(b"[^\x20\x09-\x0d]+", lower)
        hashes = [xxhash.xxh64_intdigest(w, 42) for w in words]
        out = [h % buckets for h in hashes]
        for w in words:
            w = b" " + w + b" "
            for i in range(len(w) - 3):
                value = 0
                for byte in w[i : i + 4]:
                    value = (value * 257 + byte) % whole
                out.append((value * mix % whole >> 20) % buckets + buckets)
        for a, b in zip(hashes, hashes[1:]):
            out.append((((a * mix + b) % whole * mix % whole) >> 17) % buckets + 2 * buckets)
        return out, len(words)

    good = defaultdict(lambda: True)
    for i, quality, toxic in labels:
        if i is not None:
            good[i] &= quality == 1 and toxic == 0
    seed = xxhash.xxh64_intdigest(np.int32(42).tobytes(), 42)
    draw = {i: xxhash.xxh64_intdigest(np.int64(i).tobytes(), seed) for i in good}
    order = sorted(good, key=lambda i: (draw[i] - whole * (draw[i] >> 63), i))[:sample]
    fit, held = ({i for i in order if draw[i] % 2 == odd} for odd in (0, 1))
    raw, target = np.zeros(3 * buckets), np.zeros(3 * buckets)
    found = [grams(t) for _, t in docs]
    for (i, _), (own, _) in zip(docs, found):
        for g in own:
            raw[g] += 1
            target[g] += i in fit and good[i]
    ratio = np.zeros(3 * buckets)
    for part in range(3):
        lo, hi = part * buckets, (part + 1) * buckets
        share = target[lo:hi].sum() / max(1, raw[lo:hi].sum())
        for g in range(lo, hi):
            value = np.log((target[g] + 1) / (raw[g] * share + 1))
            ratio[g] = value if value < -0.5 else 0
    weights = [sum(ratio[g] for g in own) / max(1, n) for own, n in found]
    judged = {}
    for (i, _), w in zip(docs, weights):
        if i in held:
            judged[i] = min(judged.get(i, np.inf), w)
    cut = -np.inf
    if len({good[i] for i in judged}) == 2:
        values = sorted(set(judged.values()))
        cuts = [-np.inf, *((a + b) / 2 for a, b in zip(values, values[1:])), np.inf]
        cut = min(cuts, key=lambda c: sum((w >= c) != good[i] for i, w in judged.items()))
    keys = []
    for (i, t), w in zip(docs, weights):
        u = (xxhash.xxh64_intdigest(f"{i}:".encode() + (t or "").encode(), 42) + 0.5) / 2.0**64 * (1 - 1e-12) + 5e-13
        keys.append(w / 0.01 - np.log(-np.log(u)))
    k = sum(w >= cut for w in weights)
    least = sorted(keys, reverse=True)[k - 1] if k else np.inf
    return [(i, w, key, bool(key >= least)) for (i, _), w, key in zip(docs, weights, keys)], k
