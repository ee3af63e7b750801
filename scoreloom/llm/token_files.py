"""Token ids as flat binary files.

A corpus is a folder of shards. ``shard-N.bin`` holds the ids of its documents one after another as little-endian unsigned
integers of 16 or 32 bits; ``shard-N.idx`` holds 64-bit offsets, one more than documents, in ids from the shard's start.
Documents ascend by id over all shards. The manifest (a Parquet table beside them) has each shard's file names, counts
and base, the number of ids and of documents in all shards before it; bases are prefix sums of the shards' totals.
A document's ids are read by mapping the shard into memory.

Files get their final names by a rename after they are whole, so a task that runs twice or is lost leaves whole files only.

Null texts are encoded as empty texts: one document with the end id alone. Null ids come first. Repeated rows each have
their own document; equal ids are ordered by text. An empty table gives a manifest without rows.
"""

from __future__ import annotations

import itertools
import os
import string
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm.common import ready, stored
from scoreloom.session import new_table_path

END_ID = 1
#: Bytes of words and ids in one generation of what a worker keeps, with what Python needs for each; there are two generations.
CACHE_BYTES = 48 << 20
#: About what a word takes besides its characters and ids.
ENTRY_BYTES = 160
#: A special token of the vocabulary; joins words into one call of the library.
SEPARATOR = "<|endoftext|>"
#: Ends the name of a token that ends a piece of the pre-tokeniser.
PIECE_END = "</w>"
#: Marks that are a piece of their own behind a letter, whatever number of them.
MARKS = string.punctuation

MANIFEST = "shard string, bin_file string, idx_file string, ids_file string, dtype string, n_docs bigint, n_tokens bigint"

_encoders: dict[str, WordEncoder] = {}


class WordEncoder:
    """The library's encoding of a text, word by word.

    The vocabulary's normaliser and pre-tokeniser never join text over a white space, so a text's ids are those of the
    pieces between its spaces; each different piece is encoded by the library once per worker while it stays in use.
    """

    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        # The same model for words of lower-case ASCII letters: nothing to normalise in them, and each is one piece.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = WhitespaceSplit()
        self.dtype = dtype
        self.separator = self.tokenizer.token_to_id(SEPARATOR)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, code in self.tokenizer.get_vocab().items():
            self.ends[code] = token.endswith(PIECE_END)
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text, without the end id."""
        pieces = [(t.lower() if t.isascii() and "<|" not in t else t).replace("\n", " ").split(" ") for t in texts]
        if self.held > CACHE_BYTES:
            self.older, self.known, self.held = self.known, {"": b""}, 0
        known, older = self.known, self.older
        out, missing = [], []
        for i, words in enumerate(pieces):  # one look at each word; only texts with a new one are looked at again
            try:
                out.append(b"".join(map(known.__getitem__, words)))
            except KeyError:
                out.append(b"")
                missing.append(i)
        if not missing:
            return out
        new = set().union(*[pieces[i] for i in missing]).difference(known)
        again = {w: older[w] for w in new if w in older}  # new words are few against the table
        known.update(again)
        before = len(known) - len(again)
        self._learn(new.difference(again))
        added = len(known) - before
        self.held += added * ENTRY_BYTES + sum(sum(map(len, itertools.islice(reversed(x), added))) for x in (known, known.values()))
        for i in missing:
            out[i] = b"".join(map(known.__getitem__, pieces[i]))
        return out

    def _learn(self, new: set[str]) -> None:
        """Ids of new words. Marks behind a letter are pieces of their own, as the pre-tokeniser splits there."""
        known, parts = self.known, []
        # Most new words are letters alone and as they will be looked up: nothing to take off, nothing to lower.
        letters = {w for w in new if w.isalpha() and (w.islower() or not w.isascii())}
        marks, others = set(), set()
        for word in new.difference(letters):
            core = word.rstrip(MARKS)
            if not core or not core[-1].lower()[-1].isalpha() or "<|" in word:  # lower case can end in a mark
                core = word
            tail = word[len(core):]
            if core.isascii() and "<|" not in core:
                core = core.lower()
            if tail or core != word:
                parts.append((word, core, tail))
                marks.add(tail)
            (letters if core.isalpha() else others).add(core)
        others |= marks
        ascii_, foreign = [], []
        for word in letters.difference(known):
            (ascii_ if word.isascii() else foreign).append(word)
        self._encode_letters(ascii_, self.plain)
        self._encode_letters(foreign, self.tokenizer)
        wanted = [w for w in others if w not in known]
        plain = [w for w in wanted if "<|" not in w]
        for at in range(0, len(plain), 1000):
            self._encode_joined(plain[at: at + 1000])
        self._encode_each([w for w in wanted if "<|" in w])
        for word, core, tail in parts:
            known[word] = known[core] + known[tail]

    def _encode_letters(self, words: list[str], tokenizer) -> None:
        """Words of letters alone, many in one call: each is one piece, whose last token says so."""
        for at in range(0, len(words), 1000):
            some = words[at: at + 1000]
            codes = tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids
            ids = np.asarray(codes, self.dtype)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some):  # the normaliser parts some word
                self._encode_joined(some)
                continue
            self._keep(some, ids, np.append(0, ends[:-1]), ends)

    def _keep(self, words: list[str], ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
        width, data = ids.itemsize, ids.tobytes()
        self.known.update(zip(words, [data[a:b] for a, b in zip((begins * width).tolist(), (ends * width).tolist(), strict=True)],
                              strict=True))

    def _encode_joined(self, words: list[str]) -> None:
        """Many words in one call, told apart by a special token that none of them holds."""
        joined = self.tokenizer.encode_batch_fast([SEPARATOR.join(words)], add_special_tokens=False)[0].ids
        ids = np.asarray(joined, self.dtype)
        cuts = np.flatnonzero(ids == self.separator)
        if len(cuts) != len(words) - 1:
            self._encode_each(words)
            return
        self._keep(words, ids, np.append(0, cuts + 1), np.append(cuts, len(ids)))

    def _encode_each(self, words: list[str]) -> None:
        for word, code in zip(words, self.tokenizer.encode_batch(words, add_special_tokens=False), strict=True):
            self.known[word] = np.asarray(code.ids, self.dtype).tobytes()


def id_type(path: str) -> str:
    """The narrowest of u2 and u4 that holds every id of a vocabulary."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def _encoder(path: str, dtype: str) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, dtype) not in _encoders:
        _encoders[path, dtype] = WordEncoder(path, dtype)
    return _encoders[path, dtype]


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a URI or a plain path."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text: str = "text",
                 end_id: int = END_ID) -> DataFrame:
    """Write the corpus to ``folder`` (any URI that the executors share) and return its manifest with bases."""
    dtype = id_type(tokenizer)
    spark = ready(docs.sparkSession)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Sorting on the text too spreads an id that many rows share; a prefix of the digest is enough to order them.
    ordered = (docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange(partitions, "id", "tie").sortWithinPartitions("id", "tie")
               .withColumn("part", F.spark_partition_id()))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, root = open_folder(folder)
        disk.create_dir(root, recursive=True)
        attempt, width = uuid.uuid4().hex[:12], np.dtype(dtype).itemsize
        end = np.asarray([end_id], dtype).tobytes()
        encoder, out, sizes, ids, part = _encoder(tokenizer, dtype), None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                part = batch.column(3)[0].as_py()
                out = disk.open_output_stream(f"{root}/.{attempt}.bin")
            ids.append(batch.column(0))
            texts = batch.column(1)
            for at in range(0, batch.num_rows, 256):
                codes = encoder.encode(texts.slice(at, 256).to_pylist())
                sizes.extend(len(c) // width + 1 for c in codes)
                out.write(end.join([*codes, b""]))
        if out is None:
            return
        out.close()
        offsets = np.zeros(len(sizes) + 1, "<i8")
        np.cumsum(sizes, out=offsets[1:])
        with disk.open_output_stream(f"{root}/.{attempt}.idx") as idx:
            idx.write(offsets.tobytes())
        with disk.open_output_stream(f"{root}/.{attempt}.ids") as f:
            column = pa.chunked_array(ids).combine_chunks()
            table = pa.table({"id": column})
            with pa.ipc.new_file(f, table.schema) as writer:
                writer.write_table(table)
        name = f"shard-{part:06d}-{attempt}"
        for kind in ("bin", "idx", "ids"):
            disk.move(f"{root}/.{attempt}.{kind}", f"{root}/{name}.{kind}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (f"{part:06d}", f"{name}.bin", f"{name}.idx", f"{name}.ids", dtype)]
            + [pa.array([x], pa.int64()) for x in (len(sizes), int(offsets[-1]))],
            names=["shard", "bin_file", "idx_file", "ids_file", "dtype", "n_docs", "n_tokens"])

    shards = stored(ordered.mapInArrow(write, MANIFEST), "token-shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    base = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)).cast("long")
    manifest = shards.select("*", base("n_tokens").alias("base_token"), base("n_docs").alias("base_doc"))
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def local_copy(disk: fs.FileSystem, path: str) -> tuple[str, bool]:
    """A local file with the content: the file itself where it is local, else a temporary copy (then True)."""
    if isinstance(disk, fs.LocalFileSystem):
        return path, False
    handle, name = tempfile.mkstemp(prefix="shard-")
    with os.fdopen(handle, "wb") as out, disk.open_input_stream(path) as source:
        while block := source.read(1 << 22):
            out.write(block)
    return name, True


def map_file(disk: fs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """A file as a memory-mapped array; a temporary copy is unlinked at once and vanishes with the mapping."""
    name, temporary = local_copy(disk, path)
    try:
        return np.memmap(name, dtype, "r") if os.path.getsize(name) else np.zeros(0, dtype)
    finally:
        if temporary:
            os.unlink(name)


def read_tokens(manifest: DataFrame, folder: str, id_type_name: str = "bigint") -> DataFrame:
    """One row per document from the mapped files: id, start (ids of all documents before it), n_tokens, ids (bytes)."""
    # A task per shard: shards are of like size, and reading one needs no other.
    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    schema = f"id {id_type_name}, start bigint, n_tokens bigint, dtype string, ids binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, root = open_folder(folder)
        for shard in (row for batch in batches for row in batch.to_pylist()):
            tokens = map_file(disk, f"{root}/{shard['bin_file']}", shard["dtype"])
            offsets = map_file(disk, f"{root}/{shard['idx_file']}", "<i8")
            with disk.open_input_file(f"{root}/{shard['ids_file']}") as f:
                ids = pa.ipc.open_file(f).read_all().column("id").combine_chunks()
            low = 0
            while low < shard["n_docs"]:  # blocks of at most about four million ids, or one document
                high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + (1 << 22), "right")) - 1)
                start, stop = offsets[low:high], offsets[low + 1: high + 1]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(low, high - low), pa.array(start + shard["base_token"]), pa.array(stop - start),
                     pa.array([shard["dtype"]] * (high - low)),
                     pa.array([tokens[a:b].tobytes() for a, b in zip(start, stop, strict=True)], pa.binary())],
                    names=["id", "start", "n_tokens", "dtype", "ids"])
                low = high

    return manifest.repartition(n, "shard").mapInArrow(read, schema)


def token_digest(docs: DataFrame, folder: str, tokenizer: str) -> DataFrame:
    """Write, read back, and give each document's place, length and checksum of its ids as 32-bit integers."""
    import zlib

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = read_tokens(write_tokens(docs, folder, tokenizer), folder, kind)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = [zlib.crc32(np.frombuffer(ids, d).astype("<u4").tobytes())
                   for ids, d in zip(batch.column(4).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(digest, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def corpus_folder(docs: DataFrame) -> str:
    """A new folder for a corpus in the shared place."""
    return new_table_path(docs.sparkSession, "tokens")
