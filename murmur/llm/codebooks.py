"""Codes of vectors by small codebooks: Lloyd's rounds in which members stay with the entry that owns them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from murmur.llm.common import fresh, settled
from murmur.session import delete_folder, scratch_folder

#: Parts of a vector, entries of a codebook, rounds, and the grid a component is brought to: floor(GRID * x).
PARTS, ENTRIES, ROUNDS, GRID = 8, 16, 6, 4096
#: Components are under this in size on the grid, so that every squared distance and sum fits 64 bits.
LARGEST = 1 << 26
#: Components of one block of members at most, besides the rest of the last batch.
BLOCK = 1 << 20
#: A block of members, or what a task's members of an entry add up to (n and sums).
MEMBERS = "position int, entry int, salt int, n long, sums array<long>, parts array<int>"


def whole_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector is there and holds neither nulls nor non-finite components."""
    x = F.col(vector)
    return embeddings.where(x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))


def on_grid(vectors: pa.Array, parts: int = PARTS) -> np.ndarray:
    """Whole vectors as integers, rows x positions x places within the position."""
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * GRID)
    if len(flat) and np.abs(flat).max() >= LARGEST:
        raise ValueError(f"components of {LARGEST / GRID:g} or more in size are beyond the grid")
    lengths = np.unique(np.diff(vectors.offsets.to_numpy()))
    if len(lengths) != 1 or lengths[0] % parts:
        raise ValueError(f"vectors must have one length, a multiple of {parts}; found {lengths.tolist()}")
    return flat.astype(np.int64).reshape(len(vectors), parts, int(lengths[0]) // parts)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry for each row, the lower index of equals; all in whole numbers."""
    reach = int(np.abs(parts).max(initial=0) + np.abs(entries).max(initial=0)) ** 2 * max(parts.shape[1], 1)
    if reach < 1 << 51:  # every number below is a whole one that a double holds
        x, c = parts.astype(np.float64), entries.astype(np.float64)
        apart = (c * c).sum(1) - 2 * (x @ c.T) + (x * x).sum(1)[:, None]
    else:
        apart = np.stack([((parts - c) ** 2).sum(1) for c in entries], 1)
    index = apart.argmin(1)
    return index, np.take_along_axis(apart, index[:, None], 1)[:, 0].astype(np.int64)


class Owners:
    """What one task holds of the entries: tallies of all members it has judged, and blocks of those that move."""

    def __init__(self, books: np.ndarray, salts: int):
        positions, entries, width = books.shape
        self.n = np.zeros((positions, entries), np.int64)
        self.sums = np.zeros(books.shape, np.int64)
        self.moving: list[list[list[np.ndarray]]] = [[[] for _ in range(entries)] for _ in range(positions)]
        self.waiting, self.salts, self.salt = 0, salts, TaskContext.get().partitionId()

    def tally(self, position: int, entry: np.ndarray, parts: np.ndarray) -> None:
        self.n[position] += np.bincount(entry, minlength=self.n.shape[1])
        order = np.argsort(entry, kind="stable")
        used, first = np.unique(entry[order], return_index=True)
        self.sums[position, used] += np.add.reduceat(parts[order], first) if len(used) else 0

    def move(self, position: int, entry: np.ndarray, parts: np.ndarray) -> None:
        for e in np.unique(entry).tolist():
            self.moving[position][e].append(parts[entry == e].astype(np.int32))
        self.waiting += parts.size

    def _rows(self, rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          ["position", "entry", "salt", "n", "sums", "parts"])

    def leave(self) -> Iterator[pa.RecordBatch]:
        """A block for each entry that has gained members; its salt spreads an entry's blocks over many owners."""
        rows = [(p, e, self.salt % self.salts, None, None, np.concatenate(found).ravel())
                for p, entries in enumerate(self.moving) for e, found in enumerate(entries) if found]
        self.moving = [[[] for _ in entries] for entries in self.moving]
        self.waiting, self.salt = 0, self.salt + 1
        for row in rows:
            yield self._rows([row])

    def told(self) -> Iterator[pa.RecordBatch]:
        yield from self.leave()
        rows = [(p, e, self.salt % self.salts, int(self.n[p, e]), self.sums[p, e].tolist(), None)
                for p, e in zip(*np.nonzero(self.n))]
        if rows:
            yield self._rows([(int(p), int(e), *rest) for p, e, *rest in rows])


def first_entries(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """Codebooks as the parts of the smallest vec_ids' vectors: positions x entries x places.

    A null vec_id is none of the smallest; of one id's vectors the least by its components
    counts. Every task keeps its own smallest ids, so `entries` rows a task are compared.
    """
    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}
        for batch in batches:
            ids = batch.column(0)
            for i in np.argsort(ids.to_numpy(zero_copy_only=False), kind="stable").tolist():
                vec_id = ids[i].as_py()
                if len(kept) >= entries and vec_id > max(kept):
                    break
                own = batch.column(1)[i].as_py()
                kept[vec_id] = min(own, kept.get(vec_id, own))
                if len(kept) > entries:
                    del kept[max(kept)]
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(list(kept), ids.type), pa.array(list(kept.values()), batch.schema.field(1).type)],
                                             batch.schema.names)
    ids = vectors.where(F.col("vec_id").isNotNull()).select("vec_id", "embedding")
    found = (ids.mapInArrow(smallest, ids.schema).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
             .orderBy("vec_id").limit(entries).toArrow())
    if not found.num_rows:
        return np.zeros((parts, 0, 0), np.int64)
    return on_grid(found.column("embedding").combine_chunks(), parts).transpose(1, 0, 2)


def _updated(books: np.ndarray, state: DataFrame) -> np.ndarray:
    """The entries as floors of their members' means; sums of at most positions x entries x places numbers come here."""
    tallies = state.where(F.col("n").isNotNull())
    counts = tallies.groupBy("position", "entry").agg(F.sum("n").alias("n")).collect()
    sums = (tallies.select("position", "entry", F.posexplode("sums").alias("place", "x"))
            .groupBy("position", "entry", "place").agg(F.sum("x").alias("x")).collect())
    n, new = {(r["position"], r["entry"]): r["n"] for r in counts}, books.copy()
    for r in sums:
        new[r["position"], r["entry"], r["place"]] = r["x"] // n[r["position"], r["entry"]]
    return new


def _placed(made: DataFrame, owners: int, folder: str, born: int) -> DataFrame:
    """The blocks and tallies a round has sent, written where their owners are: by position, entry and salt."""
    path = f"{folder}/born-{born}"
    made.repartition(owners, "position", "entry", "salt").write.parquet(path)
    return made.sparkSession.read.schema(MEMBERS).parquet(path)


def train_codebooks(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks of `embeddings` (vec_id, embedding), positions x entries x places, by member-resident Lloyd rounds.

    The first round deals every part of every vector to the owner (position, entry, salt) of
    its nearest entry, in blocks of bare numbers. From then on a part stays in the file it
    lies in: an owner's task reads its resident members, judges them by the new entries and
    sends on only those that change entry; they are written, in the next shuffle, as a
    further generation beside the earlier ones. A member of generation g is resident where
    all codebooks since then have kept it; this follows from the codebooks alone, so nothing
    is kept about who left. Tallies travel with the blocks, a row for each task and entry.
    The salts, one for each shuffle partition, cut an entry that owns a third of all parts
    into many owners' blocks. All numbers are whole, so a lost task gives the same again.
    """
    spark = embeddings.sparkSession
    vectors = whole_vectors(embeddings.select("vec_id", "embedding"))
    owners = int(spark.conf.get("spark.sql.shuffle.partitions"))
    books = first_entries(vectors, parts, entries)
    if not books.shape[1]:
        return books
    folder, generations = scratch_folder(spark, "members"), []

    def deal(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
        own = Owners(books, owners)
        for batch in batches:
            if batch.num_rows:
                grid = on_grid(batch.column(0), len(books))
                for p, book in enumerate(books):
                    entry = nearest(grid[:, p], book)[0]
                    own.tally(p, entry, grid[:, p])
                    own.move(p, entry, grid[:, p])
                if own.waiting >= BLOCK:
                    yield from own.leave()
        yield from own.told()

    def stay_or_move(batches: Iterator[pa.RecordBatch], history: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        own, width = Owners(history[-1], owners), history[-1].shape[2]
        for batch in batches:
            for born, p, home, flat in zip(batch.column("born").to_pylist(), batch.column("position").to_pylist(),
                                           batch.column("entry").to_pylist(), batch.column("parts")):
                members = flat.values.to_numpy().reshape(-1, width).astype(np.int64)
                for books in history[born + 1:-1]:
                    members = members[nearest(members, books[p])[0] == home]
                entry = nearest(members, history[-1][p])[0]
                own.tally(p, entry, members)
                left = entry != home
                own.move(p, entry[left], members[left])
            if own.waiting >= BLOCK:
                yield from own.leave()
        yield from own.told()

    history = [books]
    for born in range(rounds):
        known = list(history)
        if not born:
            made = vectors.select("embedding").mapInArrow(lambda batches, b=known[0]: deal(batches, b), MEMBERS)
        else:
            resident = generations[0]
            for more in generations[1:]:
                resident = resident.unionAll(more)
            made = resident.mapInArrow(lambda batches, h=known: stay_or_move(batches, h), MEMBERS)
        state = _placed(made, owners, folder, born)
        generations.append(state.where(F.col("n").isNull()).select(F.lit(born).alias("born"), "position", "entry", "parts"))
        history.append(_updated(history[-1], state))
    delete_folder(spark, folder)
    return history[-1]


def encode(frame: DataFrame, books: np.ndarray, vector: Column) -> Column:
    """codes (array<int>, one for each position) and error (squared distances summed) of a whole vector."""
    shared = frame.sparkSession.sparkContext.broadcast(books)

    @F.arrow_udf("struct<codes:array<int>,error:bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        books = shared.value
        for batch in batches:
            if not books.shape[1] or not len(batch):
                yield pa.array([None] * len(batch), pa.struct([("codes", pa.list_(pa.int32())), ("error", pa.int64())]))
                continue
            grid = on_grid(batch, len(books))
            found = [nearest(grid[:, p], book) for p, book in enumerate(books)]
            codes = np.stack([f[0] for f in found], 1).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * len(books)), pa.array(codes.ravel()))
            yield pa.StructArray.from_arrays([lists, pa.array(sum(f[1] for f in found))], ["codes", "error"])
    return run(vector)


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Every row with a whole vector, all its columns and new ones codes, error and label_error; and the codebooks.

    Rows whose vector is null or holds null or non-finite components are dropped. Repeated
    rows are members each, and give equal rows. A null vec_id is coded but no first entry;
    fewer than `entries` ids give smaller codebooks; null labels are one label. Vectors of
    other lengths, or beyond the grid, are an error. If no row has a vec_id there are no
    entries: codes and errors are null. An empty table gives no rows. The new columns get
    other names if `embeddings` has such ones.
    """
    if not isinstance(embeddings.schema["embedding"].dataType, ArrayType):
        raise ValueError("embedding must be an array")
    books = train_codebooks(embeddings, parts, entries, rounds)
    code, error, total = fresh(embeddings, "codes"), fresh(embeddings, "error"), fresh(embeddings, "label_error")
    e = fresh(embeddings, "_coded")
    whole = whole_vectors(embeddings)
    coded = settled(whole.withColumn(e, encode(embeddings, books, F.col("embedding")))
                    .select(*embeddings.columns, F.col(f"{e}.codes").alias(code), F.col(f"{e}.error").alias(error)), "codes")
    # A table of its own: then adaptive execution can split the rows of one label.
    by_label = settled(coded.groupBy(F.col("label").alias(f"{e}_label")).agg(F.sum(error).alias(total)), "labels")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col(f"{e}_label")), "left").drop(f"{e}_label")
    return joined, books
