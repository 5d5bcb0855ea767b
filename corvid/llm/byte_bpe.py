"""Byte-level BPE by DuckDB recursive queries, one database a partition.

Encoding: each batch's texts are cut into chunks (white space with the word
after it: the pre-token pattern never looks across the end of one), distinct
chunks into pre-tokens by the pattern, and distinct pre-tokens become rows
(word, position, token).  A recursive query joins each pair of neighbours to the
merge table and contracts every word's leftmost pair of least rank, until no
pair of any word is in the table.  Decoding joins (document, position, id) rows
to the vocabulary and aggregates the bytes in order.

A query starts with ``ROWS`` rows or so and is cut off after ``STEPPED`` rows of
steps; words that are finished by then have left it, and the others begin the
next, split where no token can ever join their parts, and there a step contracts
all pairs that the next leftmost contractions are bound to take.  So memory is
bounded by the rows, and a text that is a single word takes few steps.

Defined results: a null or empty text has no ids and decodes to no bytes; null
ids are not expected inside an ids array; an id outside the vocabulary raises;
repeated rows are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import gc
import hashlib
from collections.abc import Callable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import by_bytes, table, text_of, trim

CACHE = 150_000  # chunks kept by a task, with their pre-tokens; emptied beyond that
SLICE = 2 << 20  # bytes of text encoded at once
DECODED = 200_000  # ids that a decoding query takes (a longer document is a query of its own)
ROWS = 60_000  # token-position rows that a recursive query starts with (one longer pre-token is a query of its own)
SPLIT = 16  # steps after which unfinished words are split where no token can join their parts
STEPPED = 3_000_000  # rows that a query may step through before it is cut off; unfinished words begin the next query
#: Unicode white space; a chunk is a run of it with the run of other characters after it.
SPACE = r"\x09-\x0d\x85\p{Z}"
CHUNK = regex.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
SPACED = regex.compile(rf"[{SPACE}]")
RE2_SPACE = SPACE.replace(r"\x85", r"\x{85}")

#: A row holds a token with the two after it (-1: none), so that a step needs no look at neighbours: r is the word's least
#: rank, hit its leftmost place.  The row after the hit takes the merged token over, the rows before it see it ahead of them.
#: A word without a pair has no row in the next step.
MERGE = """
WITH RECURSIVE state(w, p, a, b, c, step) AS (
  SELECT w, p, a, b, c, 0 FROM start
  UNION ALL
  SELECT w,
         CASE WHEN p > hit THEN p - 1 ELSE p END,
         CASE WHEN p = hit + 1 THEN r ELSE a END,
         CASE WHEN p = hit - 1 THEN r ELSE b END,
         CASE WHEN p = hit - 1 THEN third WHEN p = hit - 2 THEN r ELSE c END,
         step + 1
  FROM state JOIN (
    SELECT w, min(key) >> 32 AS r, min(key) & 4294967295 AS hit, arg_min(c, key) AS third
    FROM (SELECT s.w, (CAST(m.rank AS BIGINT) << 32) | s.p AS key, s.c FROM state s JOIN merges m ON m.pair = (CAST(s.a AS BIGINT) << 32) | s.b)
    GROUP BY w
  ) USING (w)
  WHERE p <> hit AND step < $steps
)
SELECT w, p, a, step FROM state
"""

#: The same for words that are still unfinished: a step contracts, beside the leftmost pair of least rank, those that the
#: next leftmost contractions are bound to take.  These are the other places of the least rank, from the left, unless the
#: merged token is in a pair of lesser rank (``free`` is false); and any pair of which neither token can be taken before by
#: a neighbour, however that grows, and whose merged token can't be taken at once: ``below`` and ``above`` of two neighbours
#: are the least ranks of pairs of the right one with a token that ends with the left one, and the other way round.
MERGE_ALL = """
WITH RECURSIVE state(w, p, a, step) AS (
  SELECT w, p, a, 0 FROM start
  UNION ALL
  SELECT w, p, CASE WHEN taken THEN rank ELSE a END, step + 1
  FROM (
    SELECT *, lag(taken, 1, false) OVER (PARTITION BY w ORDER BY p) AS gone
    FROM (
      SELECT *, bound OR (hit AND row_number() OVER (PARTITION BY w, run, hit ORDER BY p) % 2 = 1) AS taken
      FROM (
        SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY w ORDER BY p ROWS UNBOUNDED PRECEDING) AS run
        FROM (
          SELECT n.w, n.p, n.a, n.step, n.rank, n.rank IS NOT NULL AND n.rank = n.least AND (n.free OR n.p = n.first) AS hit,
                 n.rank IS NOT NULL AND n.rank < coalesce(l.below, $none) AND n.rank <= coalesce(r.above, $none)
                 AND (n.free OR (n.rank < coalesce(ll.below, $none) AND n.rank < coalesce(rr.above, $none))) AS bound
          FROM (
            SELECT s.*, i.rank, i.free, min(i.rank) OVER (PARTITION BY w) AS least, arg_min(p, (CAST(i.rank AS BIGINT) << 32) | p) OVER (PARTITION BY w) AS first
            FROM (
              SELECT w, p, CAST(a AS BIGINT) AS a, step, CAST(lag(a) OVER o AS BIGINT) AS z, CAST(lead(a) OVER o AS BIGINT) AS b, CAST(lead(a, 2) OVER o AS BIGINT) AS c
              FROM state WHERE step < $steps WINDOW o AS (PARTITION BY w ORDER BY p)
            ) s LEFT JOIN pairs i ON i.pair = s.a << 32 | s.b
          ) n
          LEFT JOIN pairs l ON l.pair = n.z << 32 | n.a
          LEFT JOIN pairs r ON r.pair = n.b << 32 | n.c
          LEFT JOIN pairs ll ON ll.pair = n.z << 32 | CAST(n.rank AS BIGINT)
          LEFT JOIN pairs rr ON rr.pair = CAST(n.rank AS BIGINT) << 32 | n.c
          WHERE n.least IS NOT NULL
        )
      )
    )
  )
  WHERE NOT gone
)
SELECT w, p, a, step FROM state
"""
NONE = 1 << 30  # above all ranks
RELATE = """
CREATE TABLE pairs AS
WITH m AS (SELECT pair, rank, pair >> 32 AS x, pair & 4294967295 AS y FROM merges),
l AS (SELECT part << 32 | y AS pair, min(rank) AS below FROM m JOIN ends ON token = x GROUP BY 1),
r AS (SELECT x << 32 | part AS pair, min(rank) AS above FROM m JOIN begins ON token = y GROUP BY 1),
alone AS (SELECT x AS token FROM m WHERE x > rank UNION SELECT y FROM m WHERE y > rank)
SELECT pair, rank, below, above, rank IS NOT NULL AND alone.token IS NULL AS free
FROM l FULL JOIN r USING (pair) LEFT JOIN merges USING (pair) LEFT JOIN alone ON alone.token = rank
"""

#: The vocabulary has a letter for each byte (its code point); the letters are joined in order.
DECODE = """
SELECT d, array_to_string(list(letters ORDER BY p), '') AS text, count(letters) AS known, count(*) AS n
FROM ids LEFT JOIN vocabulary USING (id) GROUP BY d
"""


class Coder:
    """One in-memory DuckDB with the vocabulary and merge table of a rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        pairs = [(self.ranks[x[:k]], self.ranks[x[k:]], r) for x, r in self.ranks.items() for k in range(1, len(x)) if x[:k] in self.ranks and x[k:] in self.ranks]
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        a, b, r = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "200MB"})
        self.db.register("given", pa.table({"pair": a << 32 | b, "rank": r}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.db.register("given", pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "letters": pa.array([x.decode("latin-1") for x in self.ranks])}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self.joined: np.ndarray | None = None
        self.forget()

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids in each): recursive queries over all of them."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes) - sizes
        # a word goes by the place of its first byte
        w, a = np.repeat(starts, sizes), self.single[np.frombuffer(b"".join(words), np.uint8)]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        query, most = MERGE, STEPPED
        while len(w):
            steps = max(1, min(most, STEPPED // len(w)))
            self.db.register("start", _rows(w, a))
            got = self.db.sql(query.replace("$steps", str(steps)).replace("$none", str(NONE))).to_arrow_table()
            w, p, a, step = (got.column(k).to_numpy() for k in ("w", "p", "a", "step"))
            last = np.zeros(int(w.max()) + 1, step.dtype)
            np.maximum.at(last, w, step)
            fixed = np.flatnonzero(step == last[w])
            fixed = fixed[np.lexsort((p[fixed], w[fixed]))]
            w, a = w[fixed], a[fixed].astype(np.int32)
            cut_off = last[w] == steps
            done.append((w[~cut_off], a[~cut_off]))
            w, a, query, most = w[cut_off], a[cut_off], MERGE_ALL, SPLIT
            if len(w):
                w = self._split(w, a)
        w, a = (np.concatenate([d[k] for d in done]) for k in (0, 1))
        order = np.argsort(w, kind="stable")
        return a[order].astype(np.uint32), np.diff(np.append(np.searchsorted(w[order], starts), len(w)))

    def _split(self, w: np.ndarray, a: np.ndarray) -> np.ndarray:
        """New words of rows in order: a word ends where no token can ever hold its last bytes and the next ones too."""
        if self.joined is None:
            self._relate()
        key = a[:-1].astype(np.int64) << 32 | a[1:]
        place = np.minimum(np.searchsorted(self.joined, key), len(self.joined) - 1)
        first = np.concatenate([[True], w[1:] != w[:-1]])
        begins = np.concatenate([[True], first[1:] | (self.joined[place] != key)])
        size = self.sizes[a]
        before = np.cumsum(size) - size
        at = w + before - np.repeat(before[first], np.diff(np.append(np.flatnonzero(first), len(w))))
        return np.repeat(at[begins], np.diff(np.append(np.flatnonzero(begins), len(w))))

    def _relate(self) -> None:
        """The table ``pairs`` of MERGE_ALL and the pairs that some token joins, made when a word first needs them."""
        ranks = self.ranks
        ends = [(r, ranks[x[k:]]) for x, r in ranks.items() for k in range(len(x)) if x[k:] in ranks]
        begins = [(r, ranks[x[:k]]) for x, r in ranks.items() for k in range(1, len(x) + 1) if x[:k] in ranks]
        for name, rows in (("ends", ends), ("begins", begins)):
            self.db.register("given", pa.table(dict(zip(("token", "part"), np.array(rows, np.int64).T, strict=True))))
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.execute(RELATE)
        self.joined = self.db.sql("SELECT DISTINCT e.part << 32 | f.part AS k FROM merges JOIN ends e ON e.token = pair >> 32 JOIN begins f ON f.token = pair & 4294967295 ORDER BY k").to_arrow_table().column(0).to_numpy()
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.sizes[list(ranks.values())] = list(map(len, ranks))
        self.db.execute("DROP TABLE ends; DROP TABLE begins")

    def _cut(self, chunks: list[str]) -> list[list[str]]:
        """The pre-tokens of each chunk.  Chunks that begin with white space are cut as one text: a chunk's end is always a pre-token's end."""
        spaced = [i for i, c in enumerate(chunks) if SPACED.match(c) and not SPACED.match(c[-1])]
        out: list[list[str]] = [[]] * len(chunks)
        pieces = self.pattern.findall("".join(chunks[i] for i in spaced))
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        bounds = np.searchsorted(ends, np.cumsum([len(chunks[i]) for i in spaced]), "left") + 1
        start = 0
        for i, end in zip(spaced, bounds.tolist(), strict=True):
            out[i], start = pieces[start:end], end
        mine = set(spaced)
        for i, c in enumerate(chunks):
            if i not in mine:
                out[i] = self.pattern.findall(c)
        return out

    def _learn_words(self, words: list[str]) -> None:
        parts, sizes = [self.word_flat], [np.diff(self.word_starts)]
        coded = [x.encode() for x in words]
        upto = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)))
        at = 0
        while at < len(coded):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + ROWS, "right")))
            ids, each = self.merge_words(coded[at:end])
            parts.append(ids)
            sizes.append(each)
            at = end
        base = len(self.words)
        self.words.update(zip(words, range(base, base + len(words)), strict=True))
        self.word_flat = np.concatenate(parts)
        self.word_starts = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])

    def _learn(self, chunks: list[str]) -> None:
        cut = self._cut(chunks)
        flat = [p for pieces in cut for p in pieces]
        if new := [x for x in dict.fromkeys(flat) if x not in self.words]:
            self._learn_words(new)
        place = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        ids, each = _gather(self.word_flat, self.word_starts, place)
        ends = np.concatenate([[0], np.cumsum(each)])[np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))]
        base = len(self.chunks)
        self.chunks.update(zip(chunks, range(base, base + len(chunks)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.flat) + ends])
        self.flat = np.concatenate([self.flat, ids])

    def forget(self) -> None:
        self.words: dict[str, int] = {}  # a pre-token's place in word_starts
        self.chunks: dict[str, int] = {}  # a chunk's place in starts
        self.starts, self.flat = np.zeros(1, np.int64), np.empty(0, np.uint32)
        self.word_starts, self.word_flat = np.zeros(1, np.int64), np.empty(0, np.uint32)

    def _chunks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(chunk of each place, chunks in each text, distinct chunks)."""
        split = pc.split_pattern(texts, " ")
        sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        words, ends = split.flatten(), np.cumsum(sizes)
        coded = words.dictionary_encode()
        names = coded.dictionary.to_pylist()
        index = coded.indices.to_numpy().astype(np.int64)
        distinct = [" " + x for x in names]
        # a text's first word has no space before it
        heads: dict[str, int] = {}
        for at in (ends - sizes).tolist():
            index[at] = heads.setdefault(names[index[at]], len(distinct) + len(heads))
        distinct += heads
        # where white space stands before a space the cut isn't at a chunk's end
        odd = np.flatnonzero(pc.match_substring_regex(texts, rf"[{RE2_SPACE}] ").to_numpy(zero_copy_only=False))
        if len(odd):
            parts = list(np.split(index, ends[:-1]))
            more: dict[str, int] = {}
            for i in odd.tolist():
                parts[i] = np.array([more.setdefault(c, len(distinct) + len(more)) for c in CHUNK.findall(texts[i].as_py())], np.int64)
                sizes[i] = len(parts[i])
            index = np.concatenate(parts)
            distinct += more
        return index, sizes, distinct

    def encode(self, texts: pa.Array, cache: int = CACHE) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids in each text)."""
        if len(self.chunks) > cache:
            self.forget()
        index, counts, distinct = self._chunks(texts)
        used = np.zeros(len(distinct), bool)
        used[index] = True
        gc.disable()  # many new lists and arrays, and no cycle among them
        if new := list(dict.fromkeys(c for c, u in zip(distinct, used.tolist(), strict=True) if u and c not in self.chunks)):
            self._learn(new)
        gc.enable()
        place = np.fromiter((self.chunks.get(c, 0) for c in distinct), np.int64, len(distinct))
        ids, each = _gather(self.flat, self.starts, place[index])
        sums, ends = np.concatenate([[0], np.cumsum(each)]), np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(sums[ends])

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The bytes of each document's ids; KeyError for an id outside the vocabulary.  A query takes ``DECODED`` ids or so."""
        upto = np.cumsum(sizes)
        out: list[bytes] = []
        while len(out) < len(sizes):
            done = len(out)
            first = int(upto[done - 1]) if done else 0
            end = max(done + 1, int(np.searchsorted(upto, first + DECODED, "right")))
            out += self._decode(ids[first : int(upto[end - 1])], sizes[done:end])
        return out

    def _decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        ends = np.cumsum(sizes)
        place = np.arange(len(ids), dtype=np.int32) - np.repeat(ends - sizes, sizes).astype(np.int32)
        self.db.register("ids", pa.table({"d": np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), "p": place, "id": ids.astype(np.int32)}))
        out = [b""] * len(sizes)
        for d, letters, known, n in self.db.execute(DECODE).fetchall():
            if known != n:
                raise KeyError(f"an id of document {d} of the batch isn't in the vocabulary")
            out[d] = letters.encode("latin-1")
        return out


def _rows(w: np.ndarray, a: np.ndarray) -> pa.Table:
    """The rows that a recursive query starts with: the tokens of each word (w is sorted) with their places and the two after."""
    starts = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
    sizes = np.diff(np.append(starts, len(w)))
    ends = starts + sizes
    place = (np.arange(len(w)) - np.repeat(starts, sizes)).astype(np.int32)
    second, third = np.append(a[1:], -1).astype(np.int32), np.append(a[2:], [-1, -1])[: len(a)].astype(np.int32)
    second[ends - 1] = third[ends - 1] = -1
    third[ends[sizes > 1] - 2] = -1
    return pa.table({"w": w, "p": place, "a": a, "b": second, "c": third})


def _gather(flat: np.ndarray, starts: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the slices of ``flat`` at these places, one after another, and their lengths)."""
    first = starts[place]
    each = starts[place + 1] - first
    total = np.cumsum(each)
    at = np.repeat(first - (total - each), each)
    at += np.arange(len(at), dtype=np.int64)
    return flat[at], each


@functools.lru_cache(2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def _encode(path: str, pattern: str, keep: list[str], cache: int, check: bool = False) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = coder(path, pattern)
        for batch in by_bytes(batches, most=SLICE):
            ids, sizes = mine.encode(batch.column("text"), cache)
            if check:
                for k, (data, text) in enumerate(zip(mine.decode(ids, sizes), batch.column("text").cast(pa.binary()), strict=True)):
                    if data != text.as_py():
                        raise ValueError(f"the ids of document {batch.column('id')[k].as_py()} don't decode to its text")
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], lists], names=[*keep, "ids"])
        mine.forget()
        trim()

    return run


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", cache: int = CACHE, check: bool = False) -> DataFrame:
    """(id, ids) of every document; ``cache``: chunks that a task remembers, which changes its memory and time, never its ids.

    With ``check``, the ids are decoded again where they are, and ValueError tells of a document whose text they don't give.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(_encode(path, pattern, ["id"], cache, check), T.StructType([rows.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def _decode(path: str, pattern: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = coder(path, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                lists = batch.column("ids")
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                data = mine.decode(lists.flatten().to_numpy(zero_copy_only=False), sizes)
                yield pa.RecordBatch.from_arrays([batch.column("id"), lists, pa.array(data, pa.binary())], names=["id", "ids", "decoded"])

    return run


def decode(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(id, ids, decoded) from (id, ids): the decoded bytes."""
    rows = coded.select("id", "ids")
    return rows.mapInArrow(_decode(path, pattern), T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())]))


def _round_trip(path: str, pattern: str, cache: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = coder(path, pattern)
        for batch in by_bytes(batches, most=2 * SLICE):
            ids, sizes = mine.encode(batch.column("text"), cache)
            ends, view = np.cumsum(sizes), memoryview(ids.astype("<u4").tobytes())
            coded = [hashlib.sha256(view[4 * (e - s) : 4 * e]).hexdigest() for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
            decoded = [hashlib.sha256(x).hexdigest() for x in mine.decode(ids, sizes)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(coded), pa.array(decoded)], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        mine.forget()
        trim()

    return run


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", cache: int = 2 * CACHE) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encoded, and the ids decoded again where they are, so that neither leaves the worker."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    fields = [rows.schema["id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return rows.mapInArrow(_round_trip(path, pattern, cache), T.StructType(fields))


def op6_byte_bpe(spark: SparkSession, sf_dir: str, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    import public_tokenizers

    ranks, pattern = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    return round_trip(table(spark, sf_dir, "documents"), ranks, pattern).withColumnRenamed("id", "doc_id")
