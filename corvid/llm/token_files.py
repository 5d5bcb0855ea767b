"""Token-ID output: documents in ascending id order, encoded and written as one wavelet matrix file a shard.

Texts are encoded where they lie, and written as packed ids (two bytes a token
where the vocabulary allows), which take less room than the texts.  Those rows
are dealt by id range and sorted inside each range, so shard order is id order.
Ranges are counted by bytes.  A task writes a shard whenever ``shard_tokens``
tokens are gathered: memory is bounded by the shard, not by the range.  Files
are written beside their place and moved there, so a task that runs again leaves
the same files.  The manifest has one row a shard; a running sum over it gives
every shard's first token position.

The tokenizer is the tokenizers library's.  Its own model encodes every
distinct pre-token; texts are split at white space, distinct words encoded once
a batch, and words of Latin characters pre-split here by the tokenizer's own
pattern (the library's normalizer and pre-tokenizer do any other word).

Defined results: a null or empty text is the end id alone; null ids come first;
rows that repeat an id are all written, ordered by a hash of their ids; an empty
table writes no shard; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import gc
import json
import os
import re
import unicodedata
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from corvid.llm.common import by_bytes, scratch_path, table, text_of, trim, written
from corvid.llm.wavelet import WaveletMatrix, from_bytes, opened, to_bytes

END = 1
MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long, bytes long"
READ = "id long, start long, n_tokens long, crc32 long"
#: Characters below this need no normalization beyond lower case, and the library's classes for them are spelled out in WordEncoder.
PLAIN = 0x250
CACHE = 300_000  # words kept by a worker; the cache is emptied beyond that


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level models use for each byte: itself where printable, else the next above 255."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + k) for k, b in enumerate(others)}}


class WordEncoder:
    """Ids of white-space-separated words, as the tokenizer file at ``path`` gives them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        pattern = json.loads(self.whole.to_str())["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        kinds = {k: "".join(re.escape(chr(c)) for c in range(PLAIN) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
        inner = pattern.replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}").replace(r"[^\s\p{L}\p{N}]", r"\0")
        self.split = re.compile("\n|" + inner.replace(r"\p{L}", f"[{kinds['L']}]").replace(r"\p{N}", f"[{kinds['N']}]").replace(r"\0", rf"[^\s{kinds['L']}{kinds['N']}]"))
        added = [re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join([f"[^\x21-\x7e\xa1-{chr(PLAIN - 1)}]", *added]))  # the library finds its added tokens in a text
        self.letters = _byte_letters()
        self.width = 2 if max(self.whole.get_vocab(with_added_tokens=True).values()) < 1 << 16 else 4  # bytes of a packed id
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}  # a word's place in starts
        self.pieces: dict[str, list[int]] = {}
        self.starts, self.flat = np.zeros(1, np.int64), np.empty(0, np.uint32)

    def _piece(self, piece: str) -> list[int]:
        if (got := self.pieces.get(piece)) is None:
            coded = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
            got = self.pieces[piece] = [t.id for t in self.model.tokenize(coded)]
        return got

    def _learn(self, words: list[str]) -> None:
        odd = self.odd.search
        plain = [w for w in words if not odd(w)]
        ids: list[int] = []
        ends: list[int] = []
        for piece in self.split.findall("\n".join(plain).lower()):
            if piece == "\n":
                ends.append(len(ids))
            else:
                ids += self._piece(piece)
        ends += [len(ids)] * bool(plain)
        if len(plain) < len(words):
            for word in (rest := [w for w in words if odd(w)]):
                ids += self.whole.encode(word, add_special_tokens=False).ids
                ends.append(len(ids))
            plain += rest
        base = len(self.known)
        self.known.update(zip(plain, range(base, base + len(plain)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.array(ends, np.int64)])
        self.flat = np.concatenate([self.flat, np.array(ids, np.uint32)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids in each text)."""
        words = pc.ascii_split_whitespace(texts)
        counts = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        coded = words.flatten().dictionary_encode()
        names = coded.dictionary
        distinct = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), "\n")[0].as_py().split("\n") if len(names) else []
        if len(self.known) > CACHE:
            self.forget()
        known = self.known
        if new := [w for w in distinct if w and w not in known]:
            gc.disable()  # a million new lists and no cycle among them
            self._learn(new)
            gc.enable()
        place = np.fromiter(map(known.__getitem__, filter(None, distinct)), np.int64)
        first, size = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        some = np.fromiter(map(bool, distinct), bool, len(distinct))
        first[some], size[some] = self.starts[place], self.starts[place + 1] - self.starts[place]
        index = coded.indices.to_numpy()
        each = size[index]
        total = np.cumsum(each)
        n = int(total[-1]) if len(total) else 0
        at = np.repeat(first[index] - (total - each), each)
        at += np.arange(n, dtype=np.int64)
        sums = np.concatenate([[0], total])
        ends = np.concatenate([[0], np.cumsum(counts)])
        return self.flat[at], np.diff(sums[ends])


@functools.lru_cache(2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def with_ends(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each document."""
    out = np.insert(ids, np.cumsum(sizes), end) if len(sizes) else ids
    return out, sizes + 1


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder.replace("file:///", "/").replace("file:/", "/") if folder.startswith("file:") else folder)


def _pack(tokenizer: str) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in by_bytes(batches):
            tokens, sizes = with_ends(*encoder.encode(batch.column("text")), END)
            ends = np.cumsum(sizes, dtype=np.int64) * encoder.width
            offsets = pa.py_buffer(np.concatenate([[0], ends]))
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, offsets, pa.py_buffer(tokens.astype(f"<u{encoder.width}"))])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), data.cast(pa.binary())], names=["id", "row", "ids"])
        encoder.forget()
        trim()

    return pack


def _write(folder: str, tokenizer: str, shard_tokens: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, part, seq = _encoder(tokenizer).width, TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def shard() -> pa.RecordBatch:
            nonlocal seq
            tokens, sizes, ids = (np.concatenate([h[k] for h in held]) for k in range(3))
            held.clear()
            data = to_bytes(WaveletMatrix.build(tokens), ids, sizes)
            fs, root = _open(folder)
            path, draft = f"{root}/part-{part:06d}-{seq:04d}.cwm", f"{root}/.draft-{uuid.uuid4().hex}"
            with fs.open_output_stream(draft) as out:
                out.write(data)
            fs.move(draft, path)
            row = {"part": [part], "seq": [seq], "path": [path], "n_docs": [len(ids)], "n_tokens": [len(tokens)], "bytes": [len(data)]}
            seq += 1
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("bytes", pa.int64())]))

        count = 0
        for batch in by_bytes(batches, "ids"):
            packed = batch.column("ids")
            sizes = pc.binary_length(packed).to_numpy().astype(np.int64) // width
            tokens = np.frombuffer(b"".join(packed.to_pylist()), f"<u{width}").astype(np.uint32)
            held.append((tokens, sizes, batch.column("id").to_numpy()))
            count += len(tokens)
            if count >= shard_tokens:
                count = 0
                yield shard()
        if held:
            yield shard()
        trim()

    return write


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = 8 << 20, shard_tokens: int = 4_000_000) -> DataFrame:
    """Write the shards under ``folder`` and return the manifest: (part, seq, path, n_docs, n_tokens, bytes, start).

    Ids must be integers; a null id is written as the smallest integer.  ``range_bytes``: packed ids of one task.
    """
    spark = docs.sparkSession
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63))).alias("id"), F.monotonically_increasing_id().alias("row"), text_of(text_col).alias("text"))
    packed = written(rows.mapInArrow(_pack(tokenizer), "id long, row long, ids binary"), "packed")
    ranges = -(-(packed.agg(F.sum(F.length("ids").cast("long"))).first()[0] or 1) // range_bytes)
    # rows that repeat an id are told apart too, so that no id makes a range hot
    order = ["id", F.xxhash64("ids"), "row"]
    dealt = packed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop("row")
    manifest = written(dealt.mapInArrow(_write(folder, tokenizer, shard_tokens), MANIFEST), "manifest")
    before = W.Window.orderBy("part", "seq").rowsBetween(W.Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))  # one row a shard


def _read(folder: str) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(folder)
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with fs.open_input_stream(path) as source:
                    matrix, ids, sizes = from_bytes(source.read())
                tokens = matrix.tokens().astype("<u4")
                ends = np.cumsum(sizes, dtype=np.int64)
                view = memoryview(tokens.tobytes())
                crcs = [zlib.crc32(view[4 * (e - s) : 4 * e]) for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
                none = ids == -(1 << 63)
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=none), pa.array(start + ends - sizes), pa.array(sizes.astype(np.int64)), pa.array(crcs, pa.int64())], names=["id", "start", "n_tokens", "crc32"])

    return read


def read_token_files(manifest: DataFrame, folder: str, task_bytes: int = 64 << 20) -> DataFrame:
    """(id, start, n_tokens, crc32) of every document, from the files; a task reads one file after another, ``task_bytes`` of them or so."""
    files = written(manifest.select("path", "start", "bytes"), "files")
    n, size = files.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(1, min(n, max(2 * files.sparkSession.sparkContext.defaultParallelism, -(-size // task_bytes))))
    return files.repartition(tasks).mapInArrow(_read(folder), READ)


def token_at(folder: str, path: str, position: int) -> int:
    """One token of a shard, read from the blocks that hold its bits."""
    fs, _ = _open(folder)
    with fs.open_input_file(path) as file:
        return opened(file)[0].access(position)


def op4_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "tokens")
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer or public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(manifest, folder).select(F.col("id").alias("doc_id"), "start", "n_tokens", F.col("crc32").alias("ids_crc32"))
