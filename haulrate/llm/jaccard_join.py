"""Exact Jaccard self-join of word shingle sets, by set-relation skipping.

Texts of one shingle set are one node. A global order of shingles puts frequent ones last, by
counts of blocks over all texts; similar sets then share a shingle among the first few of both, so
only those are listed, with their position. Three steps find the components of all links:

* Nodes that share a short list are candidate pairs at once; sizes, positions and parity bitmaps
  rule most of the false ones out, and what the others join is a group. So is a long list, for the
  nodes of which it is the longest. A group goes to tasks in parts of bounded size. There a set is
  compared with the sets that no similar one has reached yet: what a highly similar set has
  answered is skipped, so a group of near copies costs a few rows of comparisons, not all pairs.
  Pairs that the parts have separated are compared one by one.
* Long lists whose nodes are of one component by now are skipped whole. Of the longer others, a few
  nodes of each component are compared, which joins the parts of a group.
* What is still open is compared in full, in blocks. Blocks skip pairs of one component, of sizes
  or positions too far apart, or whose parity bitmaps already differ in too many bits.

Every bound is exact: no candidate is capped or sampled away, and each link found is checked on the
full sets. Sets and shingles are 64-bit hashes (two of a billion different sets fall together with
a chance of about 3 %). Links within a component that is already joined are not listed one by one.

Defined cases: a null text is empty, has no shingle and is linked with nothing, its component is
its own id. A text of fewer words than a shingle has all of them as its only one. Repeated rows are
copies of each other. Null ids name no component; one of null ids only has a null id. Texts are
read whole, other columns are not read, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulrate.llm.common import filled, fresh
from haulrate.llm.words import mix, shingle_sets
from haulrate.sources.shared import staged

WORDS = 5
PERCENT = 80
#: Most frequent shingles whose order is known; others come before them, by hash.
MOST_HINTS = 1 << 21
#: Up to so many ids are sent to all tasks; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 20
#: All pairs of a list of at most so many rows are candidates at once.
SHORT_LIST = 16
COUNT_BLOCK = 1 << 21
#: Rows of a frequent list that go to one task, and the shingles of one group of sets.
PART_ROWS = 4096
GROUP_SHINGLES = 1 << 18
#: Lists of more rows are first compared by a few nodes of each component.
LONG_LIST = 64
REPRESENTATIVES = 3
BITS_PER_SHINGLE = 4
MOST_BITS = 1 << 16


def _sets(texts: pa.Array, words: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """The node and the shingles of each text."""
    for shingles in shingle_sets(texts, words):
        if not len(shingles):
            yield None, shingles
            continue
        digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
        yield int.from_bytes(digest, "little", signed=True), shingles


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _batch(columns: dict[str, tuple]) -> pa.RecordBatch:
    arrays = [pa.array(values, type_) for values, type_ in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


_PROFILE = ["doc_id", "unnamed", "node", "n", "token", "times"]


def _profile(docs: DataFrame, words: int) -> DataFrame:
    """Rows of two kinds: every document with its node, and the counts of shingles in blocks."""

    def counts(block: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(block)
        block.clear()
        every.sort()
        again = every[1:][every[1:] == every[:-1]]
        tokens, n = np.unique(again, return_counts=True)
        tokens, n = tokens.view(np.int64), n + 1
        none = pa.nulls(len(tokens), pa.int64())
        return pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(tokens), pa.array(n.astype(np.int64))],
            names=_PROFILE,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        block, held = [], 0
        for part in _parts(batches):
            nodes, sizes = [], []
            for node, shingles in _sets(part.column("text"), words):
                nodes.append(node)
                sizes.append(len(shingles))
                if node is not None and node not in seen:
                    seen.add(node)
                    block.append(shingles)
                    held += len(shingles)
            none = pa.nulls(part.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("unnamed"), pa.array(nodes, pa.int64())]
                + [pa.array(sizes, pa.int64()), none, none],
                names=_PROFILE,
            )
            if held > COUNT_BLOCK:
                yield counts(block)
                held = 0
        if block:
            yield counts(block)

    return docs.mapInArrow(run, ", ".join(f"{name} bigint" for name in _PROFILE))


def _hints(profile: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles (unsigned, rising), each with the power of two of its count.

    All of a power of two or none, so that at most ``most`` come to the driver.
    """
    times = profile.where("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
    times = times.select("token", F.floor(F.log2("times")).cast("tinyint").alias("level"))
    sizes = {row["level"]: row["count"] for row in times.groupBy("level").count().collect()}
    least, total = 64, 0
    for level in sorted(sizes, reverse=True):
        total += sizes[level]
        if total > most:
            break
        least = level
    found = times.where(F.col("level") >= least).toArrow()
    tokens = found.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], found.column("level").to_numpy()[order]


def prefix_length(size: int, percent: int) -> int:
    """Two sets that are similar enough share one of so many first shingles."""
    return size - math.ceil(percent * size / 100) + 1


def _postings(
    docs: DataFrame, words: int, percent: int, tokens: np.ndarray, levels: np.ndarray
) -> DataFrame:
    """The first shingles of each node in the global order, with positions.

    ``part`` deals the rows of a shingle that is known to be frequent to several tasks; 0 is a
    shingle whose rows stay together.
    """
    parts_of = {level: -(-(2 << level) // PART_ROWS) for level in set(levels.tolist())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in _parts(batches):
            out: list[tuple] = []
            for node, shingles in _sets(part.column("text"), words):
                if node is None or node in seen:
                    continue
                seen.add(node)
                size = len(shingles)
                length = prefix_length(size, percent)
                at = np.minimum(np.searchsorted(tokens, shingles), max(0, len(tokens) - 1))
                known = tokens[at] == shingles if len(tokens) else np.zeros(size, bool)
                first = shingles[~known][:length]
                deal = np.zeros(len(first), np.int64)
                if len(first) < length:
                    rest, where = shingles[known], at[known]
                    order = np.lexsort((rest, levels[where]))[: length - len(first)]
                    first = np.concatenate([first, rest[order]])
                    parts = [parts_of[level] for level in levels[where[order]].tolist()]
                    deal = np.concatenate([deal, [k if k > 1 else 0 for k in parts]])
                spread = node % np.maximum(deal, 1) + 1
                out.append((first, node, size, np.where(deal > 0, spread, 0)))
            if out:
                lengths = [len(first) for first, *_ in out]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([x[0] for x in out]).view(np.int64)),
                        pa.array(np.concatenate([x[3] for x in out]).astype(np.int32)),
                        pa.array(np.repeat([x[1] for x in out], lengths)),
                        pa.array(np.repeat([x[2] for x in out], lengths).astype(np.int32)),
                        pa.array(np.concatenate([np.arange(k) for k in lengths]).astype(np.int32)),
                    ],
                    names=["token", "part", "node", "n", "pos"],
                )

    return docs.mapInArrow(run, "token bigint, part int, node bigint, n int, pos int")


def _runs(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs of equal keys in sorted rows, and where each run starts."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        starts = _starts(table, keys)
        if len(starts) < 2:
            held = table
            continue
        held = table.slice(starts[-1])
        yield table.slice(0, starts[-1]).combine_chunks(), starts
    if held is not None and held.num_rows:
        held = held.combine_chunks()
        yield held, np.append(_starts(held, keys), held.num_rows)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    columns = [table.column(key).to_numpy() for key in keys]
    changed = reduce(np.logical_or, [np.diff(column) != 0 for column in columns])
    return np.concatenate([[0], np.flatnonzero(changed) + 1])


def _met(postings: DataFrame, percent: int) -> DataFrame:
    """What shares a list: pairs of nodes (``node``, ``other``) of short lists that size and
    position let pass, and the rows of long lists, whose ``other`` is null."""
    whole, short = pa.int64(), pa.int32()
    fields = [("token", whole), ("node", whole), ("n", short), ("pos", short), ("other", whole)]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _runs(batches, ["token", "part"]):
            edges = np.zeros(table.num_rows, bool)
            edges[starts[starts < table.num_rows]] = True
            node = table.column("node").to_numpy()
            fresh = edges.copy()
            fresh[1:] |= node[1:] != node[:-1]
            run_of = np.cumsum(edges)[fresh]
            table, node = table.filter(pa.array(fresh)), node[fresh]
            size = table.column("n").to_numpy().astype(np.int64)
            rest = size - table.column("pos").to_numpy()
            long = np.bincount(run_of)[run_of] > SHORT_LIST
            long |= table.column("part").to_numpy() > 0
            rows = table.select(["token", "node", "n", "pos"]).filter(pa.array(long))
            rows = rows.append_column("other", pa.nulls(rows.num_rows, pa.int64()))
            yield from rows.cast(schema).to_batches()
            for step in range(1, SHORT_LIST):
                same = np.flatnonzero((run_of[step:] == run_of[:-step]) & ~long[step:])
                if not len(same):
                    break
                total = size[same] + size[same + step]
                bound = np.minimum(rest[same], rest[same + step])
                passed = same[(100 + percent) * bound >= percent * total]
                empty = [pa.nulls(len(passed), field.type) for field in schema]
                empty[1], empty[4] = pa.array(node[passed]), pa.array(node[passed + step])
                yield pa.RecordBatch.from_arrays(empty, schema=schema)

    return (
        postings.repartition("token", "part")
        .sortWithinPartitions("token", "part", "node")
        .mapInArrow(run, "token bigint, node bigint, n int, pos int, other bigint")
    )


def parity_bitmap(shingles: np.ndarray) -> bytes:
    """For each bit the parity of the shingles that fall on it."""
    bits = 64
    while bits < min(MOST_BITS, BITS_PER_SHINGLE * len(shingles)):
        bits *= 2
    counts = np.bincount((mix(shingles) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1, bitorder="little").tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    """At most so many shingles are in one set only; the longer bitmap is folded."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    size = min(len(x), len(y))
    x = np.bitwise_xor.reduce(x.reshape(-1, size), axis=0)
    y = np.bitwise_xor.reduce(y.reshape(-1, size), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _sent(rows: DataFrame) -> DataFrame:
    """Written rows, which a join sends to all tasks if they are counted to be few enough.

    Otherwise the join shuffles both sides itself, so hot keys can be split as it runs.
    """
    rows = staged(rows, "few")
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _sets_of(docs: DataFrame, members: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """The shingles and the bitmap of each of the nodes, from one of its documents.

    A node stands here again for each row that repeats its document; pairs are made distinct.
    """
    first = F.min(F.struct("unnamed", "doc_id")).alias("first")
    firsts = members.groupBy("node").agg(first).join(nodes, "node")
    chosen = _sent(firsts.select("first.*", F.col("node").alias("wanted")))
    same = docs["doc_id"].eqNullSafe(chosen["doc_id"]) & (docs["unnamed"] == chosen["unnamed"])
    texts = docs.join(chosen, same).select("text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            made = zip(part.column("wanted").to_pylist(), _sets(part.column("text"), words))
            found = [(node, shingles) for wanted, (node, shingles) in made if node == wanted]
            yield _batch(
                {
                    "node": ([node for node, _ in found], pa.int64()),
                    "n": ([len(s) for _, s in found], pa.int32()),
                    "shingles": ([s.tobytes() for _, s in found], pa.binary()),
                    "bitmap": ([parity_bitmap(s) for _, s in found], pa.binary()),
                }
            )

    return texts.mapInArrow(run, "node bigint, n int, shingles binary, bitmap binary")


def enough(shared: int, a: int, b: int, percent: int) -> bool:
    """Whether the Jaccard similarity of sets of these sizes reaches the percentage."""
    return (100 + percent) * shared >= percent * (a + b)


def reach_similar(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join each set to its component; a set is compared with unreached ones only."""
    sizes = np.array([len(s) for s in sets])
    _, tokens = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    rows = [tokens[end - size : end] for size, end in zip(sizes, ends)]
    flags = np.zeros(len(tokens), dtype=np.int32)
    links: list[tuple[int, int]] = []
    unreached = list(range(len(sets)))
    while unreached:
        todo = [unreached.pop(0)]
        flat = np.concatenate([rows[k] for k in unreached]) if unreached else None
        while todo and unreached:
            k = todo.pop()
            flags[rows[k]] = 1
            starts = np.cumsum([0] + [sizes[j] for j in unreached[:-1]])
            shared = np.add.reduceat(flags[flat], starts)
            flags[rows[k]] = 0
            near = (100 + percent) * shared >= percent * (sizes[k] + sizes[unreached])
            if near.any():
                found = [j for j, is_near in zip(unreached, near) if is_near]
                links += [(k, j) for j in found]
                todo += found
                unreached = [j for j, is_near in zip(unreached, near) if not is_near]
                flat = np.concatenate([rows[j] for j in unreached]) if unreached else None
    return links


def _longest_lists(lists: DataFrame) -> DataFrame:
    """Each node with the longest list it stands in."""
    sizes = lists.groupBy("token").agg(F.count("*").alias("rows"))
    longest = F.max(F.struct("rows", "token")).alias("home")
    homes = lists.join(_sent(sizes), "token").groupBy("node").agg(longest, F.first("n").alias("n"))
    return homes.select("node", "n", F.col("home.token").alias("group"))


def _in_parts(groups: DataFrame) -> DataFrame:
    """Groups of nodes, dealt to parts of bounded size."""
    sizes = groups.groupBy("group").agg(F.sum("n").alias("shingles"))
    parts = F.greatest(F.ceil(F.col("shingles") / GROUP_SHINGLES), F.lit(1))
    part = F.pmod(F.xxhash64("node"), parts).cast("int").alias("part")
    return groups.join(sizes, "group").select("node", "group", part)


def _links_in_groups(dealt: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join the nodes of each part of a group to their components within it."""

    def run(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_pylist()
        order = np.argsort(nodes)
        found = group.column("shingles").to_pylist()
        links = reach_similar([np.frombuffer(found[k], np.uint64) for k in order], percent)
        ends = [[nodes[order[pair[side]]] for pair in links] for side in (0, 1)]
        return pa.table({"a": pa.array(ends[0], pa.int64()), "b": pa.array(ends[1], pa.int64())})

    with_sets = sets.select("node", "shingles").join(_sent(dealt), "node")
    return with_sets.groupBy("group", "part").applyInArrow(run, "a bigint, b bigint")


def _not_ruled_out(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps do not differ in too many bits."""
    bitmaps = sets.select("node", "n", "bitmap")
    left, right = bitmaps.toDF("a", "na", "x"), bitmaps.toDF("b", "nb", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, 1024):
            columns = [part.column(name).to_pylist() for name in ("na", "nb", "x", "y")]
            kept = [_may_be(*row, percent) for row in zip(*columns)]
            yield part.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a bigint, b bigint")


def _may_be(a: int, b: int, x: bytes, y: bytes, percent: int) -> bool:
    """Half of what is not different is shared at most."""
    total = a + b
    return (100 + percent) * (total - differing_bits(x, y)) >= 2 * percent * total


def _candidates(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of different components that share a list and that no bound rules out."""
    sizes = rows.groupBy("token").agg(F.count("*").alias("rows"))
    blocks = rows.join(_sent(sizes), "token")
    blocks = blocks.withColumn("blocks", F.ceil(F.col("rows") / PART_ROWS))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    blocks = (
        blocks.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select(
            "token",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            "own",
            "node",
            "n",
            "pos",
            "component",
        )
        .join(sets.select("node", "bitmap"), "node")
    )
    keys = ["token", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("i", "j", "own", "node", "n", "pos", "component")
        for table, starts in _runs(batches, keys):
            column = {name: table.column(name).to_numpy() for name in names}
            bitmaps = table.column("bitmap")
            found: set[tuple[int, int]] = set()
            for start, stop in zip(starts, [*starts[1:], table.num_rows]):
                if stop <= start:
                    continue
                group = {name: values[start:stop] for name, values in column.items()}
                for x, y in _pairs(group, percent):
                    a, b = int(start + x), int(start + y)
                    pair = int(column["node"][a]), int(column["node"][b])
                    if pair in found or pair[::-1] in found:
                        continue
                    x, y = bitmaps[a].as_py(), bitmaps[b].as_py()
                    if _may_be(int(column["n"][a]), int(column["n"][b]), x, y, percent):
                        found.add(pair)
            yield _batch(
                {
                    "a": ([min(pair) for pair in found], pa.int64()),
                    "b": ([max(pair) for pair in found], pa.int64()),
                }
            )

    return (
        blocks.repartition(*keys)
        .sortWithinPartitions(*keys, "n", "node")
        .mapInArrow(run, "a bigint, b bigint")
        .distinct()
    )


def _pairs(group: dict[str, np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Index pairs of a list by rising size that components, sizes and positions leave open."""
    n, rest = group["n"].astype(np.int64), group["n"].astype(np.int64) - group["pos"]
    component, own = group["component"], group["own"]
    across = group["i"][0] != group["j"][0]
    last = np.searchsorted(n, n * 100 // percent, side="right")
    for x in range(len(n) - 1):
        stop = last[x]
        if stop <= x + 1:
            continue
        y = np.arange(x + 1, stop)
        open_ = component[y] != component[x]
        if across:
            open_ &= own[y] != own[x]
        bound = np.minimum(rest[x], rest[y])
        open_ &= (100 + percent) * bound >= percent * (n[x] + n[y])
        for k in y[open_]:
            yield x, int(k)


def _checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = sets.join(_sent(nodes), "node", "left_semi")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, 1024):
            kept = []
            for x, y in zip(part.column("left").to_pylist(), part.column("right").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(enough(shared, len(x), len(y), percent))
            yield part.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it is linked to through any links.

    Each round takes the smallest label among neighbours and then the label's own label, so its
    number grows with the logarithm of the longest chain. Rounds are written to the shared folder.
    """
    both = links.union(links.select("b", "a")).distinct()
    edges = staged(both.toDF("node", "other"), "links")
    labels = edges.select("node").distinct().withColumn("component", F.col("node"))
    while True:
        seen = edges.join(labels.withColumnRenamed("node", "other"), "other")
        least = seen.groupBy("node").agg(F.min("component").alias("near"))
        lower = labels.join(least, "node").withColumn("near", F.least("component", "near"))
        jump = lower.select(F.col("node").alias("near"), F.col("near").alias("far"))
        lowest = F.least("near", F.coalesce("far", "near"))
        moved = staged(
            lower.join(jump, "near", "left").select(
                "node",
                lowest.alias("component"),
                (lowest != F.col("component")).alias("moved"),
            ),
            "labels",
        )
        labels = moved.select("node", "component")
        if moved.where("moved").isEmpty():
            return labels


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links between nodes."""
    of = labels.toDF("end", "label")
    ends = links.join(of.toDF("a", "x"), "a").join(of.toDF("b", "y"), "b").select("x", "y")
    joined = components(ends.where("x <> y").toDF("a", "b")).toDF("component", "lower")
    return staged(
        labels.join(joined, "component", "left").select(
            "node", F.coalesce("lower", "component").alias("component")
        ),
        "labels",
    )


def _open(lists: DataFrame, labels: DataFrame, more_than: int) -> DataFrame:
    """The rows of lists of more rows than that and several components, with their component."""
    labelled = lists.join(labels, "node")
    several = (
        labelled.groupBy("token")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count("*").alias("rows"),
        )
        .where((F.col("low") != F.col("high")) & (F.col("rows") > more_than))
        .select("token")
    )
    return labelled.join(_sent(several), "token")


def _few(rows: DataFrame) -> DataFrame:
    """A few rows of each component in each list."""
    picks = [
        F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("h"), "node", "n", "pos")).alias(f"p{k}")
        for k in range(REPRESENTATIVES)
    ]
    grouped = rows.groupBy("token", "component").agg(*picks)
    named = [
        F.struct(*[F.col(f"p{k}.{c}").alias(c) for c in ("node", "n", "pos")])
        for k in range(REPRESENTATIVES)
    ]
    return grouped.select(
        "token", "component", F.explode(F.array_distinct(F.array(*named))).alias("row")
    ).select("token", "component", "row.node", "row.n", "row.pos")


def node_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, hints: int = MOST_HINTS
) -> tuple[DataFrame, DataFrame]:
    """``doc_id, unnamed, node, n`` of every document, and ``node, component`` of nodes in lists.

    ``unnamed`` is 0, or a hash of the text in rows without an id.
    """
    hashed = F.xxhash64("text") % (1 << 62) + (1 << 62)
    docs = filled(docs).withColumn("unnamed", F.when(F.col("doc_id").isNull(), hashed).otherwise(0))
    profile = staged(_profile(docs, words), "shingles")
    members = profile.where("token is null").select("doc_id", "unnamed", "node", "n")
    tokens, levels = _hints(profile, hints)
    met = staged(_met(_postings(docs, words, percent, tokens, levels), percent), "met")
    lists = met.where("other is null").drop("other")
    pairs = met.where("other is not null").select(
        F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")
    )
    pairs = staged(pairs.distinct(), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    nodes = staged(lists.select("node").union(ends).distinct(), "nodes")
    sets = staged(_sets_of(docs, members, nodes, words), "sets")

    # Near copies that meet in short lists: groups are what the pairs left over join.
    pairs = staged(_not_ruled_out(pairs, sets, percent), "pairs")
    groups = components(pairs).withColumnRenamed("component", "group")
    dealt = staged(_in_parts(groups.join(sets.select("node", "n"), "node")), "groups")
    links = _links_in_groups(dealt, sets, percent)
    # Those that meet in long lists: groups are the lists.
    homes = staged(_in_parts(_longest_lists(lists)), "groups")
    links = links.union(_links_in_groups(homes, sets, percent))
    labels = nodes.withColumn("component", F.col("node"))
    labels = _relabel(labels, staged(links, "links"))

    # Pairs that a group's parts have separated.
    part = dealt.join(labels, "node").select("node", F.struct("part", "component").alias("at"))
    apart = pairs.join(part.toDF("a", "x"), "a").join(part.toDF("b", "y"), "b")
    apart = apart.where("x.part <> y.part and x.component <> y.component").select("a", "b")
    labels = _relabel(labels, _checked(staged(apart, "pairs"), sets, percent))
    for narrow, more_than in ((_few, LONG_LIST), (None, 1)):
        rows = _open(lists, labels, more_than)
        rows = staged(narrow(rows) if narrow else rows, "open")
        if not rows.isEmpty():
            found = staged(_candidates(rows, sets, percent), "pairs")
            labels = _relabel(labels, _checked(found, sets, percent))
    return members, labels


def near_duplicates(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, hints: int = MOST_HINTS
) -> DataFrame:
    """Per document: the size of its set, and the smallest id that links lead to."""
    members, labels = node_components(docs, words, percent, hints)
    full = members.where("node is not null").join(labels, "node", "left")
    full = full.withColumn("component", F.coalesce("component", "node"))
    firsts = full.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    alone = members.where("node is null")
    return (
        full.join(firsts, "component")
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
        .union(alone.select("doc_id", "n", "doc_id"))
    )


def keep_one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with the smallest id of each component only, all columns as they are.

    Rows that share an id are one document. Rows without an id cannot be named: they all stay.
    """
    found = near_duplicates(docs, words, percent)
    kept_id = fresh(docs, "_kept_id")
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias(kept_id))
    named = docs.join(kept, F.col("doc_id") == F.col(kept_id), "left_semi")
    return named.union(docs.where("doc_id is null"))
