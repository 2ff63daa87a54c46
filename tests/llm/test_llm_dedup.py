"""Exact, near and line dedup, and components, against loops over all rows."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from logintake.llm.blocks import block_hashes, exact_duplicates
from logintake.llm.components import components
from logintake.llm.lines import _digests, drop_repeated_chunks
from logintake.llm.simhash import (
    BUCKET,
    _dealt,
    fingerprint_roots,
    keep_one,
    near_duplicates,
    shared_flips,
    within,
)

DOCS = "doc_id long, text string"
# Null ids and texts, empty texts, ties, repeated rows, and lengths around block borders.
ODD = [
    (5, "same text"), (3, "same\t\n text"), (3, "same text"), (None, "same text"), (9, None), (8, ""), (7, "  "),
    (10, "x" * 8), (11, "x" * 9), (12, "x" * 16), (13, "x" * 17), (14, "x" * 16), (None, "only null"),
    (None, "only null"), (15, "é" * 40), (16, "é" * 40), (17, "é" * 39 + "e"), (18, "ab" * 4000), (19, "ab" * 4000),
]


def pairs(df, *names):
    return sorted(map(tuple, df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("size", [8, 4096])
def test_exact_duplicates(spark, size):
    docs = spark.createDataFrame(ODD, DOCS).repartition(3).withColumns({"row": F.lit(1), "h1": F.lit(2), "name": F.lit("n")})
    got = exact_duplicates(docs, block_bytes=size)
    assert pairs(got, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(brute.same_texts(ODD), key=repr)
    # One row of each group stays, with the smallest id.
    kept = got.filter("kept").collect()
    assert len(kept) == got.select("text_sha256").distinct().count()
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_duplicates_when_hashes_collide(spark):
    def weak(block, seed):
        return (F.lit(0).cast("long"), F.lit(0).cast("long")) if seed < 2 else block_hashes(block, seed)

    docs = spark.createDataFrame(ODD, DOCS)
    got = exact_duplicates(docs, block_bytes=8, hashes=weak)
    assert pairs(got, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(brute.same_texts(ODD), key=repr)
    with pytest.raises(ValueError):
        exact_duplicates(docs, hashes=lambda block, seed: (F.lit(0).cast("long"), F.lit(0).cast("long")))


@pytest.mark.parametrize("run", [exact_duplicates, near_duplicates, keep_one, drop_repeated_chunks])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], DOCS)).count() == 0


def near(n: int, seed: int) -> list[int]:
    draw = random.Random(seed)
    values = [draw.getrandbits(64) for _ in range(n)]
    for _ in range(2 * n):
        value = draw.choice(values)
        for _ in range(draw.randint(1, 6)):
            value ^= 1 << draw.randrange(64)
        values.append(value)
    return sorted(set(values) | {0, 2**64 - 1, 7, 2**63})


def signed(value: int) -> int:
    return value - 2**64 if value >> 63 else value


@pytest.mark.parametrize("radius", [0, 3, 4])
def test_bit_sliced_pairs(radius):
    import numpy as np

    values = near(150, radius)
    fps, ends = np.array(values, np.uint64), np.full(len(values), len(values))
    # A second bucket that begins within a word.
    ends[:100] = 100
    got = set()
    for i, j in within(fps, ends, radius):
        got |= set(zip(i.tolist(), j.tolist()))
    want = {
        (i, j) for j in range(len(values)) for i in range(j)
        if (values[i] ^ values[j]).bit_count() <= radius and (j < 100 or i >= 100)
    }
    assert got == want


@pytest.mark.parametrize("bucket_rows", [2048, 20])
def test_roots(spark, bucket_rows):
    """Small buckets make every frequent one be dealt out again, several times."""
    values = near(60, 1)
    # A ball of near copies that share almost all buckets.
    values = sorted({*values, *(5 ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a))})
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    got = dict(map(tuple, fingerprint_roots(fps, bucket_rows=bucket_rows).collect()))
    want = brute.clusters(values, 4)
    mine = [got[signed(v)] for v in values]
    assert len(set(mine)) == len(set(want))
    assert len(set(zip(mine, want))) == len(set(want))


def ball(rows: int, seed: int, low: int = 3, high: int = 5, bits: int = 64) -> list[int]:
    """Distinct fingerprints that leave one centre in ``low`` to ``high`` of their bits."""
    draw = random.Random(seed)
    centre, out = draw.getrandbits(64), set()
    while len(out) < rows:
        places = draw.sample(range(bits), draw.randint(low, high))
        out.add(centre ^ sum(1 << b for b in places))
    return sorted(out)


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_shared_flips_meet(radius):
    """Every two linked members meet, or one of them has few flips left."""
    import numpy as np

    away = np.array([v ^ 99 for v in ball(400, radius, 0, 9, 14)], np.uint64)
    for flips in (0, 0b1, 0b101):
        held = away[away & np.uint64(flips) == np.uint64(flips)]
        under = {}
        shared = np.full(len(held), flips, np.uint64)
        for rows, masks in shared_flips(held, shared, radius):
            for row, mask in zip(rows.tolist(), masks.tolist()):
                assert mask not in under.setdefault(row, set())
                assert mask & flips == flips and int(held[row]) & mask == mask
                under[row].add(mask)
        for j, b in enumerate(held.tolist()):
            for i, a in enumerate(held.tolist()[:j]):
                rest = ~((1 << flips.bit_length()) - 1)
                # Those that share a smaller flip meet in another bucket.
                if (a ^ b).bit_count() > radius or a & b & ~rest & ~flips:
                    continue
                few = min((a & ~flips).bit_count(), (b & ~flips).bit_count()) <= -(-radius // 2)
                assert few or under.get(i, set()) & under.get(j, set())


@pytest.mark.parametrize("low, high, bits", [(3, 5, 64), (0, 12, 24), (6, 9, 40)])
def test_roots_of_a_ball(spark, low, high, bits):
    values = ball(1500, bits, low, high, bits)
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    got = dict(map(tuple, fingerprint_roots(fps, bucket_rows=50).collect()))
    want = brute.clusters(values, 4)
    mine = [got[signed(v)] for v in values]
    assert len(set(mine)) == len(set(want)) == len(set(zip(mine, want)))


def test_a_ball_is_dealt_evenly(spark):
    """A ball twice as large has about twice the rows in buckets, not four times."""
    each = []
    for rows in (15_000, 30_000):
        fps = spark.createDataFrame([(signed(v),) for v in ball(rows, 7)], "fp long")
        dealt = _dealt(fps, 4, 6, 256)
        assert dealt.groupBy(*BUCKET).count().agg(F.max("count")).first()[0] <= 2 * 256 + 2081
        each.append(dealt.count() / rows)
    assert each[1] < 1.25 * each[0]


def test_near_duplicates(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here to there again and again".split()
    rows = [(i, " ".join(w if k != 3 * i else "other" for k, w in enumerate(base * 4))) for i in range(1, 12)]
    rows += [(30, "A b C"), (29, "a\tB\nc"), (40, None), (39, ""), (41, " \n"), (None, "a b c"), (50, "é É z"), (50, "é É z")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"fp": F.lit(0), "root": F.lit(0), "row": F.lit(0)})
    fps = [brute.simhash(t) for _, t in rows]
    groups = brute.clusters(fps, 4)
    least = {}
    for (i, _), g in zip(rows, groups):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted(((i, f"{f:016x}", least[g]) for (i, _), f, g in zip(rows, fps, groups)), key=repr)
    assert pairs(near_duplicates(docs), "doc_id", "fingerprint", "component_id") == want
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())


def test_components(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(300)]
    # A long path and a star.
    edges += [(1000 + i, 1001 + i) for i in range(20)] + [(5000, 2000 + i) for i in range(200)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    joined = {n: r for n, r in root.items() if any(a != b and n in (a, b) for a, b in edges)}
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == joined


def lines_corpus() -> list[tuple]:
    draw = random.Random(4)
    word = lambda: draw.choice("alpha beta gamma delta omega kappa".split())
    line = lambda n: " ".join(word() for _ in range(n))
    shared = [[line(5) for _ in range(draw.randint(3, 9))] for _ in range(4)] + [[line(60)]]
    rows = []
    for i in range(40):
        own = [line(draw.randint(1, 8)) for _ in range(draw.randint(0, 6))]
        at = draw.randint(0, len(own))
        rows.append((i, "\n".join(own[:at] + draw.choice(shared) + own[at:])))
    return rows + [
        (50, None), (51, ""), (52, "\n\n"), (53, "one\ntwo\n"), (54, "one\ntwo\n"), (None, "one\ntwo\n"),
        (56, rows[0][1]), (57, "short"), (58, "short"), (59, "é\r\nü\n\nx"), (60, "\n\n"),
    ]


@pytest.mark.parametrize("options", [{}, {"window": 1, "divisor": 3}, {"window": 3, "min_lines": 1, "long_line": 6}])
def test_line_chunks(spark, options):
    rows = lines_corpus()
    docs = spark.createDataFrame(rows, DOCS).repartition(4).withColumns({"numbers": F.lit("n"), "k1": F.lit(0)})
    got = drop_repeated_chunks(docs, counts=True, **options)
    assert got.columns == ["doc_id", "text", "numbers", "k1", "removed_chunks", "removed_lines"]
    want = brute.without_repeats(rows, **options)
    left = {r.doc_id: r.text for r in got.collect()}
    assert left == {d[0]: None if d[1] is None else t for d, t in want.items()}
    removed = got.agg(F.sum("removed_lines")).first()[0]
    assert removed and removed >= 2 * got.agg(F.sum("removed_chunks")).first()[0] - len(rows)


def test_line_chunks_of_repeated_rows_and_colliding_hashes(spark):
    def weak(contents, seed):
        import numpy as np

        return _digests(contents, seed) if seed else (np.zeros(len(contents), np.int64),) * 2

    rows = lines_corpus()
    docs = spark.createDataFrame(rows + rows, DOCS)
    got = drop_repeated_chunks(docs, digests=weak).collect()
    want = brute.without_repeats(rows)
    assert len(got) == 2 * len(rows)
    assert {r.doc_id: r.text for r in got} == {d[0]: None if d[1] is None else t for d, t in want.items()}
