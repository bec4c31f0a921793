"""Token ids as equal-length sequences with masks in Arrow files, and reading them back."""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import batched, chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import held, prepare, qualified, settled, store_of
from murmur.llm.merging import Memo
from murmur.llm.token_counts import byte_symbols
from murmur.session import scratch_folder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END = 1
#: Ids of a sequence, and sequences of a record batch.
LENGTH, BATCH = 1024, 256
#: Bytes of rows whose words are looked up together.
GATHERED = 4 << 20
#: Words of printable ASCII and the letters of Latin-1 are parted here as this vocabulary's pre-tokeniser parts them;
#: composing changes nothing in them. Other words go to the library whole.
_OTHER = r"[^!-~À-ÖØ-öø-ÿ]|<\|"
#: Words stand one on a line; the line's end is a piece of its own.
_PIECES = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\na-z0-9ß-öø-ÿ]+")
MANIFEST = "part int, sequences string, documents string, n_documents long, n_tokens long"


class WordEncoder:
    """Ids by the tokenizers library, remembered by piece and, where words are not plain, by word.

    White space always parts words here and is dropped, so a text's ids are its words' ids
    in a row. Each distinct word of the texts given at once is encoded once: plain words are
    parted once more, as the vocabulary's pattern does, and the pieces' ids put together.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        # The largest number of the type is no id: it stands after each word.
        self.type = np.dtype("<u2" if max(self.library.get_vocab().values()) < (1 << 16) - 1 else "<u4")
        self.stop = int(np.iinfo(self.type).max)
        self.model = self.library.model
        self.symbols = byte_symbols()
        self.pieces = Memo(self._piece)
        self.words = Memo(self._word, 200_000)

    def _pack(self, ids: list[int]) -> bytes:
        return array(self.type.char, ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece == "\n":
            return self._pack([self.stop])
        symbols = piece if piece.isascii() else "".join([self.symbols[b] for b in piece.encode()])
        return self._pack([t.id for t in self.model.tokenize(symbols)])

    def _word(self, word: str) -> bytes:
        return self._pack([*self.library.encode(word, add_special_tokens=False).ids, self.stop])

    def _lists(self, words: pa.Array) -> pa.Array:
        """Each word's ids."""
        other = pa.compute.match_substring_regex(words, _OTHER)
        plain = words.filter(pa.compute.invert(other))
        lines = pa.compute.binary_join(pa.ListArray.from_arrays(pa.array([0, len(plain)], pa.int32()), plain), "\n")[0].as_py()
        found = chain(map(self.pieces.__getitem__, _PIECES.findall(lines.lower() + "\n" * (len(plain) > 0))),
                      map(self.words.__getitem__, words.filter(other).to_pylist()))
        # To join takes 80 bytes more for each part, so few are joined at once.
        flat = np.frombuffer(b"".join(map(b"".join, batched(found, 1 << 10))), self.type)
        stops = flat == self.stop
        ends = np.flatnonzero(stops) - np.arange(len(words))
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(flat[~stops]))
        # The plain words came first.
        place = np.empty(len(words), np.int64)
        place[np.argsort(other.to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(words))
        return lists.take(pa.array(place))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where those of each text end; null has none."""
        words = pa.compute.ascii_split_whitespace(texts.fill_null(""))
        coded = words.values.dictionary_encode()
        ids = self._lists(coded.dictionary.cast(pa.string())).take(coded.indices)
        return ids.values.to_numpy(), ids.offsets.to_numpy()[words.offsets.to_numpy()[1:]].astype(np.int64)


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The batches put together until they have `size` bytes; none is empty."""
    some, held = [], 0
    for batch in batches:
        if batch.num_rows:
            some.append(batch)
            held += batch.nbytes
        if held >= size:
            yield pa.concat_batches(some)
            some, held = [], 0
    if some:
        yield pa.concat_batches(some)


def sequence_schema(kind: np.dtype, length: int) -> pa.Schema:
    """Masks are bytes, 1 for an id and 0 for filling, as a list of bits would have to be copied to be used.

    All sequences of a file but the last have the same mask, so a sequence names one of the file's masks.
    """
    masks = pa.dictionary(pa.int8(), pa.list_(pa.uint8(), length))
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", masks)])


class SequenceWriter:
    """Packs ids into sequences of `length`, the last filled up with mask 0; one batch in memory at a time."""

    def __init__(self, path: str, kind: np.dtype, length: int):
        store, place = store_of(path)
        self.file = store.open_output_stream(place)
        self.length, self.kind = length, kind
        self.schema = sequence_schema(kind, length)
        # The last batch adds its own mask to the file's.
        self.out = pa.ipc.new_file(self.file, self.schema, options=pa.ipc.IpcWriteOptions(emit_dictionary_deltas=True))
        self.held, self.n_held = [], 0

    def _write(self, ids: np.ndarray, real: int) -> None:
        which, masks = np.zeros(len(ids) // self.length, np.int8), [np.ones(self.length, np.uint8)]
        if real < len(ids):
            which[-1] = 1
            masks.append((np.arange(len(ids) - self.length, len(ids)) < real).astype(np.uint8))
        rows, known = (pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, np.concatenate(masks)))
        self.out.write_batch(pa.record_batch([rows, pa.DictionaryArray.from_arrays(pa.array(which), known)], schema=self.schema))

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        size = self.length * BATCH
        if self.n_held >= size:
            whole = np.concatenate(self.held)
            for at in range(0, len(whole) - size + 1, size):
                self._write(whole[at:at + size], size)
            rest = whole[len(whole) // size * size:]
            self.held, self.n_held = [rest], len(rest)

    def close(self) -> None:
        whole = np.concatenate([*self.held, np.zeros(0, self.kind)])
        if len(whole):
            self._write(np.r_[whole, np.zeros(-len(whole) % self.length, self.kind)].astype(self.kind), len(whole))
        self.out.close()
        self.file.close()


DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def write_sequences(documents: DataFrame, folder: str | None = None, path: str = VOCABULARY, end: int = END,
                    length: int = LENGTH, parts: int | None = None) -> DataFrame:
    """Encode `documents` and write one pair of files for each range of doc_id; returns the manifest.

    A range's ids stand in a row in ascending doc_id order (nulls first, equal ids by a
    hash of the text, then the text; ranges are of both, so many rows of one id are several),
    each document ended by `end`, cut into sequences of `length` ids of which only the
    file's last is filled up. `sequences` is an Arrow file of fixed-size lists: sequence n is
    row n % 256 of record batch n // 256, found through the footer without reading others.
    `documents` is an Arrow file of doc_id, its first id in the row, and its ids' number.
    Each attempt of a task writes files of its own name and only those of the attempt that
    counts are in the manifest, so repeated tasks do no harm. The manifest, one row for a
    file, is a table in the shared folder.
    """
    spark = documents.sparkSession
    prepare(spark)
    folder = qualified(spark, folder or scratch_folder(spark, "sequences"))
    store, place = store_of(folder)
    store.create_dir(place, recursive=True)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), held(WordEncoder, path)
        stem = f"{folder.rstrip('/')}/part-{part:06d}-{uuid.uuid4().hex}"
        names = f"{stem}.sequences.arrow", f"{stem}.documents.arrow"
        out, start, n_documents = None, 0, 0
        for batch in gathered(batches, GATHERED):
            if out is None:
                out = SequenceWriter(names[0], encoder.type, length)
                store, place = store_of(names[1])
                index_file = store.open_output_stream(place)
                index = pa.ipc.new_file(index_file, DOCUMENTS)
            ids, ends = encoder.encode(batch.column("text"))
            out.add(np.insert(ids, ends, end))
            starts = start + np.r_[0, ends + np.arange(1, len(ends) + 1)]
            index.write_batch(pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(starts[:-1], pa.int64()),
                                               pa.array(np.diff(starts), pa.int64())], schema=DOCUMENTS))
            start, n_documents = int(starts[-1]), n_documents + batch.num_rows
        if out is not None:
            out.close()
            index.close()
            index_file.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "sequences": [names[0]], "documents": [names[1]],
                                              "n_documents": [n_documents], "n_tokens": [start]})
    keyed = documents.select("doc_id", "text", F.xxhash64("text").alias("h"))
    ordered = keyed.repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    return settled(ordered.mapInArrow(write, MANIFEST), "manifest")


def open_file(path: str) -> pa.ipc.RecordBatchFileReader:
    """A file on local or mounted storage is mapped, so that reading copies nothing; others are read through Arrow."""
    store, place = store_of(path)
    return pa.ipc.open_file(pa.memory_map(place) if isinstance(store, pa.fs.LocalFileSystem) else store.open_input_file(place))


def sequence(file: pa.ipc.RecordBatchFileReader, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of the n-th sequence, both views of the file."""
    batch = file.get_batch(n // BATCH)
    mask = batch.column("mask")
    return batch.column("ids")[n % BATCH].values.to_numpy(), mask.dictionary[mask.indices[n % BATCH].as_py()].values.to_numpy()


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Checksums are of the ids as unsigned 32-bit numbers. Null and empty texts have the end id
    alone. Repeated rows are documents of their own; an empty table has no files and no rows.
    """
    spark = manifest.sparkSession
    # One row for each file, so one task may order them.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = settled(manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "files")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            ids, index = open_file(row["sequences"]), open_file(row["documents"])
            n, held, values = -1, 0, np.zeros(0, np.uint32)
            for i in range(index.num_record_batches):
                batch = index.get_batch(i)
                sums = []
                for at, left in zip(batch.column("start").to_pylist(), batch.column("n_tokens").to_pylist()):
                    crc = 0
                    while left:
                        while at >= held:
                            n += 1
                            flat = ids.get_batch(n)
                            values = flat.column("ids").flatten().to_numpy()
                            first, held = held, held + len(values)
                        take = values[at - first:at - first + left]
                        crc = zlib.crc32(take.astype("<u4").tobytes(), crc)
                        at, left = at + len(take), left - len(take)
                    sums.append(crc)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.compute.add(batch.column("start"), row["base"]), batch.column("n_tokens"),
                     pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
    return files.repartition(parts, "part").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
