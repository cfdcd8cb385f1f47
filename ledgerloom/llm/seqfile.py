"""Token ids as Arrow stream files of equal-length sequences (operator 9).

Documents are dealt out by ranges of doc_id and sorted; each task tokenizes its range, appends the end id to each
document and packs the ids into sequences of one length, filled up and masked at the end of the file. All record
batches but the last have the same number of sequences, and ids and masks are fixed-size lists, so sequence i is a
slice of batch i // n, read without a copy from a memory-mapped file. A second small stream file holds the place of
each document.

Files go to the shared folder under names that depend on the partition only, first under another name and then
renamed, so a task that is run again replaces its file by the same one. The driver sees one row per file.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm.common import Batches, map_batches, partitions, texts_of
from ledgerloom.session import scratch_dir

END_ID = 1
SEQUENCE, BATCH_SEQUENCES = 1024, 64
#: Characters of a text that order the rows of one doc_id.
HEAD = 64
#: Words that a worker remembers; twice as many at most while the older half is let go.
CACHE_WORDS = 400_000


#: Stands between words that are encoded together, a control character that is a token of its own.
MARK, JOINED = "\x01", 1000
#: Punctuation that may end a word; after a letter or digit it is a token of its own, whatever it is.
_TAIL = ".,!?;:%$#&*"
#: Letters that neither lower case nor normal form changes.
_PLAIN = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_PLAIN_WORD = re.compile(f"[{_PLAIN}]+")
#: Capitals before anything that a normal form may move or join to them: no letter with a composed form of its own.
_COMPOSES = re.compile("[A-Z](?=[^\x00-\xff\u2010-\u2027\u4e00-\u9fff])")


def folded(text: str) -> str:
    """The text with ASCII capitals in lower case, but for special tokens and capitals that marks may be composed with.

    The library composes before it lowers the case, and a capital may compose with other marks than its small letter.
    """
    if "<|" in text:
        return text
    if text.isascii():
        return text.lower()
    lower = text.encode().lower().decode()  # bytes: ASCII letters only
    if _COMPOSES.search(text):
        letters = list(lower)
        for m in _COMPOSES.finditer(text):
            letters[m.start()] = m[0]
        return "".join(letters)
    return lower


class WordCache:
    """Ids of words, encoded by the library the first time they come up."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = id_type(self.tokenizer)
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.model = self.tokenizer.model
        self.letters = self._letters()
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _letters(self) -> dict[int, str]:
        """Byte-level spelling of the lower-case letters of Latin-1, as the library gives it.

        Words of these alone stay as they are until the merges, so they go to the library's model at once. Empty if
        some probe shows that this tokenizer treats them otherwise.
        """
        letters = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in _PLAIN}
        probes = [*_PLAIN, _PLAIN, _PLAIN[::-1], *(a + b for a in _PLAIN[::5] for b in _PLAIN[::3])]
        direct = [[t.id for t in self.model.tokenize(probe.translate(letters))] for probe in probes]
        whole = [e.ids for e in self.tokenizer.encode_batch_fast(probes, add_special_tokens=False)]
        return letters if direct == whole else {}

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Ids of each word; many are encoded as one text, with a mark between them that no word holds."""
        if len(self.mark) != 1 or any(MARK in word for word in words):
            return [np.array(e.ids, dtype=self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        (encoded,) = self.tokenizer.encode_batch_fast([f" {MARK} ".join(words)], add_special_tokens=False)
        ids = np.array(encoded.ids, dtype=self.kind)
        ends = (np.flatnonzero(ids == self.mark[0]) * ids.itemsize).tolist()
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip([0, *(e + ids.itemsize for e in ends)], [*ends, len(packed)], strict=True)]

    def learn(self, words: set[str]) -> None:
        """Make the words known: from the older half, from a word and its end, or by the library."""
        known, older = self.known, self.older
        parts: dict[str, tuple[str, str]] = {}
        needed = set()
        for word in words:
            if word in older:
                known[word] = older[word]
                continue
            core = word.rstrip(_TAIL)
            if core != word and core[-1:].lower()[-1:].isalnum():  # the lower case of a letter may end in a mark
                parts[word] = core, word[len(core) :]
                needed.update(parts[word])
            else:
                needed.add(word)
        others, tokenize, letters = [], self.model.tokenize, self.letters
        for word in needed:
            if word in known:
                continue
            if letters and _PLAIN_WORD.fullmatch(word):
                ids = [token.id for token in tokenize(word if word.isascii() else word.translate(letters))]
                known[word] = struct.pack(f"<{len(ids)}{self.code}", *ids)
            else:
                others.append(word)
        for at in range(0, len(others), JOINED):
            part = others[at : at + JOINED]
            known.update(zip(part, self._encoded(part), strict=True))
        for word, (core, tail) in parts.items():
            known[word] = known[core] + known[tail]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text. Words are what stands between blanks and line ends; other white space is left to the library."""
        if len(self.known) > CACHE_WORDS:
            self.older, self.known = self.known, {}
        found, unknown = [], []
        for text in texts:
            words = folded(text).replace("\n", " ").split(" ")
            ids = list(map(self.known.get, words))
            places, at = [], -1
            for _ in range(ids.count(None)):
                at = ids.index(None, at + 1)
                places.append((at, words[at]))
            found.append((ids, places))
            unknown += places
        self.learn({word for _, word in unknown})
        for ids, places in found:
            for at, word in places:
                ids[at] = self.known[word]
            yield np.frombuffer(b"".join(ids), dtype=self.kind)


class WholeTexts:
    """Ids of whole texts by the library, for tokenizers that keep white space."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = id_type(self.tokenizer)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for encoded in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(encoded.ids, dtype=self.kind)


def id_type(tokenizer: Tokenizer) -> np.dtype:
    return np.dtype("<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4")


@lru_cache(maxsize=2)
def _encoder(path: str, words_apart: bool) -> WordCache | WholeTexts:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    return WordCache(path) if words_apart else WholeTexts(path)


class SequenceWriter:
    """Packs ids into fixed-size-list batches of one stream."""

    def __init__(self, sink: pa.NativeFile, kind: np.dtype, length: int, sequences: int) -> None:
        self.length, self.size, self.kind = length, length * sequences, kind
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.stream = pa.ipc.new_stream(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.held_ids = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.held_ids += len(ids)
        if self.held_ids >= self.size:
            ids = np.concatenate(self.held)
            full = len(ids) // self.size * self.size
            for at in range(0, full, self.size):
                self._write(ids[at : at + self.size], self.size)
            self.held, self.held_ids = [ids[full:]], len(ids) - full

    def _write(self, ids: np.ndarray, valid: int) -> None:
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(values), self.length) for values in (ids, np.arange(len(ids)) < valid)]
        self.stream.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.held_ids:
            ids = np.concatenate(self.held)
            self._write(np.pad(ids, (0, -len(ids) % self.length)), len(ids))
        self.stream.close()


class SequenceFile:
    """Random access to the sequences of one file; ids and masks are views of the mapped file."""

    def __init__(self, path: str) -> None:
        with pa.memory_map(path) as source:
            self.batches = list(pa.ipc.open_stream(source))

    def __len__(self) -> int:
        return sum(batch.num_rows for batch in self.batches)

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.Array]:
        each = self.batches[0].num_rows
        batch, row = self.batches[i // each], i % each
        return batch.column("ids")[row].values.to_numpy(), batch.column("mask")[row].values


_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _place(folder: str, name: str) -> tuple[pyarrow.fs.FileSystem, str]:
    system, path = pyarrow.fs.FileSystem.from_uri(folder)
    return system, f"{path}/{name}"


def write_sequences(
    docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID, length: int = SEQUENCE, sequences: int = BATCH_SEQUENCES,
    words_apart: bool = True, id_col: str = "doc_id", text_col: str = "text",
) -> list[tuple[str, int, int]]:
    """Write all documents in ascending doc_id order; (file name, documents, ids) of each file, in that order.

    ``words_apart`` says that the tokenizer drops blanks, that no token spans one, that it ignores the case of ASCII
    letters but in its special tokens (``<|``...) and before marks they may be composed with, and that it splits
    punctuation off letters and digits. A null text counts as empty and
    has the end id only. Rows without doc_id come first; rows of one doc_id are ordered by the first HEAD characters of
    their text, then by a hash of it, then by their place in the table, and may lie in several files. Other columns are
    not read. An empty table gives no file.
    """

    def work(batches: Batches) -> Batches:
        encoder, name = _encoder(tokenizer_path, words_apart), f"part-{TaskContext.get().partitionId():05d}"
        system, path = _place(folder, name)
        attempt, end, writer, index, at = f"{path}.{uuid.uuid4().hex}", np.array([end_id], dtype=encoder.kind), None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(path.rpartition("/")[0], recursive=True)
                sinks = [system.open_output_stream(f"{attempt}{kind}") for kind in (".ids", ".index")]
                writer, index, documents = SequenceWriter(sinks[0], encoder.kind, length, sequences), pa.ipc.new_stream(sinks[1], _INDEX), 0
            sizes = []
            for ids in encoder.encode(batch.column("text").to_pylist()):
                writer.add(ids)
                writer.add(end)
                sizes.append(len(ids) + 1)
            starts = at + np.cumsum([0, *sizes])
            index.write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(starts[:-1]), pa.array(sizes, pa.int64())], schema=_INDEX))
            at, documents = int(starts[-1]), documents + len(sizes)
        if writer is not None:
            writer.close()
            index.close()
            for sink, kind in zip(sinks, (".arrows", ".index.arrows"), strict=True):
                sink.close()
            system.move(f"{attempt}.ids", f"{path}.arrows")
            system.move(f"{attempt}.index", f"{path}.index.arrows")
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (name, documents, at)], ["name", "documents", "ids"])

    own = texts_of(docs, id_col, text_col)
    # By the place in the table, too, so that no id and no repeated row must go into one task.
    place = own.withColumn("place", F.monotonically_increasing_id())
    order = [F.col("doc_id"), F.left("text", F.lit(HEAD)), F.xxhash64("text"), F.col("place")]
    ordered = place.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order).drop("place")
    written = map_batches(ordered, work, "name string, documents long, ids long").collect()
    return sorted((r["name"], r["documents"], r["ids"]) for r in written)


def read_documents(folder: str, files: list[tuple[str, int]]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """The documents of files given as (name, ids before it): batches of (doc_id, start, n_tokens) with their ids."""
    for name, before in files:
        system, path = _place(folder, name)
        with system.open_input_file(f"{path}.arrows") as source, system.open_input_file(f"{path}.index.arrows") as places:
            batches = (batch.column("ids").values.to_numpy() for batch in pa.ipc.open_stream(source))
            held, low = np.zeros(0, dtype=np.uint16), 0  # ids read and not yet given out; place of the first
            for batch in pa.ipc.open_stream(places):
                starts, sizes = batch.column("start").to_numpy(), batch.column("n_tokens").to_numpy()
                more, ids = [held], []
                have, need = low + len(held), int(starts[-1] + sizes[-1]) if len(starts) else 0
                while have < need:
                    more.append(next(batches))
                    have += len(more[-1])
                held = np.concatenate([m for m in more if len(m)]) if len(more) > 1 else held
                ids = [held[a - low : a - low + n] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
                held, low = held[need - low :], need
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(starts + before), batch.column(2)], schema=_INDEX), ids


def packed_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, folder: str | None = None, **how: object) -> DataFrame:
    """Write the files, then give (doc_id, start, n_tokens, ids_crc32) of each document as read back from them.

    ``start`` counts the ids of all documents before it, over all files; ids_crc32 covers the ids, end id included, as
    little-endian unsigned 32-bit integers. See :func:`write_sequences` for nulls, ties and empty tables.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "sequences")
    written = write_sequences(docs, tokenizer_path, folder, end_id, **how)
    starts = np.cumsum([0, *(ids for _, _, ids in written)]).tolist()
    files = [(name, start) for (name, _, _), start in zip(written, starts, strict=False)]

    def work(batches: Batches) -> Batches:
        for batch in batches:
            for places, ids in read_documents(folder, list(zip(*(c.to_pylist() for c in batch.columns), strict=True))):
                sums = [zlib.crc32(own.astype("<u4").tobytes()) for own in ids]
                yield pa.RecordBatch.from_arrays([*places.columns, pa.array(sums, pa.int64())], [*places.schema.names, "ids_crc32"])

    listed = spark.createDataFrame(files, "name string, before long").repartition(max(1, len(files)), "name")
    return map_batches(listed, work, "doc_id long, start long, n_tokens long, ids_crc32 long")
