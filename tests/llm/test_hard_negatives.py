import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulrate.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute_force(rows, positives=5, negatives=3):
    """Every anchor against every row, sorted whole, as the contract words it."""
    ready = {}
    for vec_id, vector, label in sorted(rows, key=str):
        if vec_id is None or label is None or not vector:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        new = (label, vector)
        ready[vec_id] = min(ready.get(vec_id, new), new)
    whole = {k: [math.floor(256 * x) for x in v] for k, (_, v) in ready.items()}
    out = set()
    for anchor in ready:
        if anchor % 50:
            continue
        scored = [
            (-sum(a * b for a, b in zip(whole[anchor], whole[k])), k)
            for k in ready
            if k != anchor and len(whole[k]) == len(whole[anchor])
        ]
        scored.sort()
        same = [(-s, k) for s, k in scored if ready[k][0] == ready[anchor][0]][:positives]
        other = [(-s, k) for s, k in scored if ready[k][0] != ready[anchor][0]]
        for score, positive in same:
            fitting = [(s, k) for s, k in other if 50 * score <= 100 * s <= 95 * score]
            for rank, (s, k) in enumerate(fitting[:negatives], 1):
                out.add((anchor, positive, rank, k, score, s))
    return out


def found(df, **how):
    rows = [tuple(row) for row in hard_negatives.mine(df, **how).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_keys_order_as_bytes():
    keys = [(a, s, k, i) for a in (-3, 0, 50) for s in (-(2**63), -1, 0, 7, 2**63 - 1) for k in (0, 1) for i in (-1, 0, 9)]
    packed = {hard_negatives.pack_key(*key): key for key in keys}
    assert [packed[b] for b in sorted(packed)] == sorted(keys, key=lambda k: (k[0], -k[1], *k[2:]))
    assert all(hard_negatives.unpack_key(b) == key for b, key in packed.items())


def test_products_are_exact_beyond_doubles():
    big = np.array([[float(1 << 31), 3.0], [1.0, -7.0]])
    assert hard_negatives.products(big, big).tolist() == [[(1 << 62) + 9, (1 << 31) - 21], [(1 << 31) - 21, 50]]


def test_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    expected = brute_force([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])
    assert len(expected) > 50
    assert found(df) == expected
    assert found(df.repartition(6), rows_in_block=37, anchors_in_block=3) == expected


@pytest.mark.parametrize("seed", range(4))
def test_ties_zero_scores_and_a_hot_vector(spark, seed):
    rng = random.Random(seed)
    hot = [1.0, 0.5, 0.0]
    rows = [
        (k, hot if rng.random() < 0.4 else [rng.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(3)], rng.randrange(3))
        for k in rng.sample(range(900), 300)
    ]
    rows += [(950, [0.0, 0.0, 0.0], 1), (951, [1.0, 1.0, 1.0], 1), (952, [1.0, 1.0, 1.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for block in (8, 64):
        assert found(df, rows_in_block=block, anchors_in_block=2) == brute_force(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 1.0], 3), (1, [1.0, 0.9], 3), (2, [1.0, 0.5], 4), (3, [0.9, 0.5], 4),
        (50, [1.0, 1.0], 4), (50, [1.0, 1.0], 4), (100, [0.5, 0.5], 4), (100, [0.5, 0.25], 4),
        (4, None, 3), (5, [1.0, None], 3), (6, [nan, 1.0], 3), (8, [inf, 1.0], 3), (9, [], 3),
        (None, [1.0, 1.0], 4), (10, [1.0, 1.0], None), (150, [1.0, 1.0, 1.0], 3), (11, [1.0] * 3, 3),
        (12, [0.9, 0.8, 0.9], 5), (-50, [1.0, 0.75], 3), (13, [-1.0, -1.0], 3), (200, [1e6, -1e6], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    clashing = df.withColumns({name: F.lit("x") for name in ("id", "scores", "slice", "vector", "dim", "key")})
    assert found(clashing) == brute_force(rows)
    assert hard_negatives.mine(df.limit(0)).count() == 0


def test_groups_slices_and_short_blocks(spark, monkeypatch):
    rng = random.Random(9)
    rows = [
        (10 * k, [rng.choice([-3.5, 0.25, 0.5, 1.0, 300.0]) for _ in range(2 + k % 2)], rng.randrange(4))
        for k in range(-40, 260)
    ]
    df, expected = spark.createDataFrame(rows, SCHEMA).repartition(3), brute_force(rows)
    monkeypatch.setattr(hard_negatives, "NUMBERS_IN_BLOCK", 40)
    assert found(df, anchors_in_block=4, anchors_held=13) == expected
    monkeypatch.setattr(hard_negatives, "NUMBERS_HELD", 50)
    assert found(df, rows_in_block=11, anchors_in_block=4) == expected


def test_what_tasks_hold_and_send_does_not_grow_with_blocks(spark, monkeypatch):
    """Joined blocks stood beside each other in memory, and each of them sent its own pairs."""
    rng = random.Random(3)
    rows = [(k, [rng.uniform(0.2, 1.0) for _ in range(4)], k % 2) for k in range(1200)]
    seen, deal = [], hard_negatives._sorted_by_anchor

    def sent(pairs, partitions):
        plan = pairs._jdf.queryExecution().optimizedPlan().toString()
        seen.append((pairs.count(), "Join Inner, ((dim" in plan))
        return deal(pairs, partitions)

    monkeypatch.setattr(hard_negatives, "_sorted_by_anchor", sent)
    assert found(spark.createDataFrame(rows, SCHEMA), rows_in_block=16, anchors_in_block=4) == brute_force(rows)
    anchors, slices = 24, int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert not any(joined for _, joined in seen)
    assert seen[0][0] <= anchors * slices * 5
    assert seen[1][0] <= anchors * 5 + anchors * slices * 15


def test_files_hold_few_blocks(spark, monkeypatch):
    """A reader takes all blocks of a file at once."""
    files, staged = [], hard_negatives.staged

    def counted(df, purpose, *how):
        out = staged(df, purpose, *how)
        if purpose == "row-blocks":
            files.extend(out.groupBy(F.input_file_name()).count().collect())
        return out

    monkeypatch.setattr(hard_negatives, "staged", counted)
    rows = [(k, [1.0, k / 900], k % 3) for k in range(900)]
    assert found(spark.createDataFrame(rows, SCHEMA).coalesce(1), rows_in_block=4) == brute_force(rows)
    assert sum(n for _, n in files) >= 900 // 4 and max(n for _, n in files) <= 8


def test_pairs_are_thinned_to_the_best():
    rng = np.random.default_rng(5)
    for kind in ("f4", "f8", "i8"):
        scores = rng.integers(-3, 4, (30, 200)).astype(kind)
        among = rng.random(scores.shape) < rng.choice([0.0, 0.02, 0.9], (30, 1))
        lines, at = hard_negatives._thinned(scores, among, 3)
        assert among[lines, at].all() and len(lines) < among.sum()
        kept = hard_negatives._Best(30, 3)
        kept.add([(lines, scores[lines, at].astype("i8"), at)])
        best = sorted((k, -int(scores[k, j]), j) for k, j in zip(*np.nonzero(among)))
        best = [x for n, x in enumerate(best) if n < 3 or best[n - 3][0] != x[0]]
        assert [(k, -s, j) for k, s, j in zip(kept.slots, kept.scores, kept.ids)] == best


def test_packed_keys_are_those_of_single_pairs():
    numbers = np.array([-(2**63), -51, 0, 7, 2**63 - 1])
    packed = hard_negatives.pack_keys(numbers, numbers[::-1].copy(), 1, np.roll(numbers, 2))
    single = zip(numbers.tolist(), numbers[::-1].tolist(), np.roll(numbers, 2).tolist())
    assert packed.to_pylist() == [hard_negatives.pack_key(a, s, 1, r) for a, s, r in single]


def test_anchors_do_not_mix():
    stream = defaultdict(list)
    for anchor in (0, 50):
        stream[anchor] = [(anchor, 100, 0, 1), (anchor, 90, 1, 5), (anchor, 60, 1, 6), (anchor, 49, 1, 7)]
    keys = sorted(hard_negatives.pack_key(*key) for keys in stream.values() for key in keys)
    rows = list(hard_negatives.windows(iter(keys)))
    assert rows == [(a, 1, rank, k, 100, s) for a in (0, 50) for rank, k, s in ((1, 5, 90), (2, 6, 60))]
