"""Near duplicates by SimHash: fingerprints linked by a generalised pigeonhole search."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import LOWER, UPPER, fresh, prepare, row_key, settled
from murmur.llm.components import components

SHINGLE, MAX_BITS, SEED, BITS = 3, 3, 42, 64
#: Fingerprints of a bucket that one task compares at a time; a larger bucket is cut into blocks of this size.
BLOCK = 4096
#: Groups up to this size give all their links, larger ones the links of a spanning forest.
SMALL = 32
#: Cost of comparing two fingerprints against that of shuffling one.
COMPARE_COST = 0.02
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half the shingles' hashes; no words: zero."""
    words = (text or "").encode().translate(_LOWER).split()  # bytes split at space and \\x09-\\x0D
    if not words:
        return 0
    runs = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter((digest(run, SEED) for run in runs), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE, *keys: Column) -> DataFrame:
    """(doc_id, keys, fp): fp holds the 64 bits as a signed number."""
    prepare(documents.sparkSession)

    @F.pandas_udf("long")
    def prints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.fromiter((fingerprint(t, shingle) for t in batch), np.uint64, len(batch)).view(np.int64))
    return documents.select("doc_id", *keys, prints("text").alias("fp"))


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and for each two bits in how many both are set: 64 x 64 sums of all."""
    def sums(batches):
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fp), 1 << 15):
                ones = np.unpackbits(fp[at:at + (1 << 15)].copy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                both += ones.T @ ones
                n += len(ones)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(range(-1, BITS * BITS), pa.int32()),
                                          "n": pa.array([n, *both.ravel().astype(np.int64)], pa.int64())})
    rows = nodes.select("fp").mapInArrow(sums, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = {r["cell"]: r["n"] for r in rows}
    return cells.get(-1, 0), np.array([cells.get(i, 0) for i in range(BITS * BITS)], float).reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in `parts` groups of like size, each grown by the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    linked = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        group = [max(left, key=lambda b: (linked[b, left].sum() - linked[b, b], -b))]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: (linked[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def mask_of(bits) -> int:
    """The bits as a signed 64-bit mask."""
    return int(np.array([sum(1 << b for b in bits)], np.uint64).view(np.int64)[0])


def pairs_by_distance(p: np.ndarray, group: list[int], most: int) -> list[float]:
    """The chance that two fingerprints differ in at most t of the group's bits, t = 0..most, bits taken as independent."""
    chance = np.zeros(most + 2)
    chance[0] = 1.0
    for b in group:
        q = 2 * p[b] * (1 - p[b])
        chance[1:] = chance[1:] * (1 - q) + chance[:-1] * q
        chance[0] *= 1 - q
    return list(np.cumsum(chance[:most + 1]))


def allot(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = total of least cost; costs[i][t + 1] is part i's cost at t."""
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(math.inf, [])] * total
    for cost in costs:
        best = [min((best[s - k][0] + cost[k], best[s - k][1] + [k - 1]) for k in range(min(s, len(cost) - 1) + 1))
                for s in range(total + 1)]
    return best[total]


def plan_probes(nodes: DataFrame, max_bits: int = MAX_BITS) -> list[int]:
    """The masks under which fingerprints meet: two that differ in at most `max_bits` bits agree under one at least.

    For each number of parts the bits are grouped by correlation. Pairs that agree in a
    whole part are counted over all fingerprints, pairs within t bits of it estimated from
    that count and the bits' shares. A dynamic programme spreads the distance over the
    parts at least cost of probes and candidates; if part i gets t_i, any pair within the
    distance is within t_i in some part i, and agrees there under one of the masks that
    leave out t_i of its bits. The cheapest number of parts wins.
    """
    n, both = bit_counts(nodes)
    p = np.diag(both) / max(n, 1)
    plans = [group_bits(n, both, parts) for parts in range(2, max_bits + 2)] if max_bits else [[list(range(BITS))]]
    flat = [(k, i, g) for k, groups in enumerate(plans) for i, g in enumerate(groups)]
    met = (nodes.select(F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col("fp").bitwiseAND(F.lit(mask_of(g))).alias("v"))
                                            for j, (_, _, g) in enumerate(flat)])).alias("x"))
           .groupBy("x.j", "x.v").count().groupBy("j").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs")).collect())
    equal = {r["j"]: r["pairs"] for r in met}
    best = (math.inf, [], [])
    for k, groups in enumerate(plans):
        costs = []
        for j, (_, _, g) in enumerate(flat):
            if flat[j][0] == k:
                reach = pairs_by_distance(p, g, max_bits)
                costs.append([0.0] + [n * math.comb(len(g), t) + COMPARE_COST * max(equal.get(j, 0.0), 1.0) * reach[t] / max(reach[0], 1e-12)
                                      for t in range(max_bits + 1)])
        best = min(best, (*allot(costs, max_bits + 1), groups))
    _, thresholds, groups = best
    return [mask_of(set(g) - set(out)) for g, t in zip(groups, thresholds) if t >= 0 for out in combinations(g, t)]


def _forest(prints: np.ndarray, max_bits: int) -> tuple[list, list]:
    """Links that join what is within reach, one fewer than the prints of each cluster."""
    left, a, b = prints, [], []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                found = left[near]
                a += [x] * len(found)
                b += found.tolist()
                front += list(found)
                left = left[~near]
    return a, b


def _links(batches, max_bits: int):
    """Links among rows (key, i, j, fp) that come sorted by key, i, j; a group is at most two blocks."""
    rest = None

    def work(key, fp):
        a, b = [], []
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        small = np.repeat(sizes <= SMALL, sizes)
        k, f = key[small], fp[small]
        for d in range(1, min(SMALL, len(k))):
            same = k[d:] == k[:-d]
            if not same.any():
                break
            near = same & (np.bitwise_count(f[d:] ^ f[:-d]) <= max_bits)
            a += f[:-d][near].tolist()
            b += f[d:][near].tolist()
        for s, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
            x, y = _forest(np.unique(fp[s:s + size]), max_bits)
            a += x
            b += y
        pairs = np.array([a, b], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs.min(0)), pa.array(pairs.max(0))], ["u", "v"]) if a else None

    for batch in batches:
        ids = np.empty(batch.num_rows, np.dtype([("key", "i8"), ("i", "i4"), ("j", "i4")]))
        for name in ("key", "i", "j"):
            ids[name] = batch.column(name).to_numpy(zero_copy_only=False)
        fp = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        if rest is not None:
            ids, fp = np.concatenate([rest[0], ids]), np.concatenate([rest[1], fp])
        if not len(ids):
            continue
        last = np.flatnonzero(ids[1:] != ids[:-1])
        cut = last[-1] + 1 if len(last) else 0
        rest = ids[cut:], fp[cut:]
        if cut and (out := work(ids[:cut], fp[:cut])):
            yield out
    if rest is not None and len(rest[0]) and (out := work(*rest)):
        yield out


def near_links(nodes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (u < v) of distinct fingerprints (column fp) that join all within `max_bits` bits of each other.

    Every link is verified. In a group of over SMALL only the links of a spanning forest are
    given, so a cluster of g prints gives g - 1 links for a bucket, not g * g / 2. Buckets of
    more than `block` prints are cut in blocks by a hash, and pairs of blocks compared in
    tasks of their own.
    """
    masks = plan_probes(nodes, max_bits)
    keyed = nodes.select("fp", F.explode(F.array(*[F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(F.lit(m)))
                                                   for n, m in enumerate(masks)])).alias("key"))
    hot = keyed.groupBy("key").count().where(F.col("count") > block).select(
        "key", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    k = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64(F.lit("block"), "fp"), k).cast("int")
    others = F.filter(F.sequence(F.lit(0), k - 1), lambda x: x != F.col("own"))
    duels = F.when(k == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(F.transform(
        others, lambda x: F.struct(F.least(x, F.col("own")).alias("i"), F.greatest(x, F.col("own")).alias("j"))))
    dealt = (keyed.join(hot, "key", "left").withColumn("own", own)
             .select("key", F.explode(duels).alias("d"), "fp").select("key", "d.i", "d.j", "fp")
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))
    return dealt.mapInArrow(lambda batches: _links(batches, max_bits), "u long, v long").distinct()


def group_near_duplicates(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, *keys: Column) -> DataFrame:
    """Per row of documents: doc_id, keys, fp (signed 64 bits), component_id, the smallest doc_id reachable over links.

    Null, empty and blank texts have fingerprint zero and are linked like any other. Exact
    copies are one node from the start. A null doc_id is kept and names no component; one
    whose rows all lack an id is null. Repeated rows give equal rows each; other columns are
    not read; an empty table gives no rows.
    """
    prints = settled(fingerprints(documents, shingle, *keys), "prints")
    nodes = settled(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(near_links(nodes, max_bits))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    # Tables of their own: a large group's rows are then split in the joins.
    rooted = settled(rooted, "rooted")
    names = settled(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "names")
    named = rooted.select("fp", "root").join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(*prints.columns, "component_id")


def drop_near_duplicates(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """`documents` with the smallest doc_id of each group, all columns as they were.

    Each row is judged in the group of its own text: of several rows with the smallest id of
    their group all stay, but none stays because its id is the smallest of another group. Rows
    without an id stay only if no row of their group has one.
    """
    names = [fresh(documents, n) for n in ("_k1", "_k2")]
    keys = [k.alias(n) for k, n in zip(row_key(F.col("doc_id"), F.col("text")), names)]
    groups = group_near_duplicates(documents, shingle, max_bits, *keys)
    keep = groups.where("doc_id <=> component_id").select(*names).distinct()
    return documents.select("*", *keys).join(keep, names, "left_semi").select(*documents.columns)
