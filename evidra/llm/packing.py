"""Best-fit packing: hierarchical residual packing of token pieces into sequences of bounded length.

Each document's tokens, with an end token, are cut into pieces of the capacity only where they are
longer. Every task packs about ITEMS pieces best-fit, longest first. Bins filled to more than NEAR are
done; the others are items for a second round of best fit in tasks of ITEMS items. A round leaves a
task one bin at most that is half full or less, so only these go on, and rounds of them end in a
single task: of all sequences one at most is half full or less, and every bin that was not nearly
full has met others twice.

Defined results: a null text is an empty one, a piece of the end token alone; repeated rows are
packed each by itself; an empty table gives an empty one; ties go by order in the table; other
columns are left out. No piece is dropped and none but over-long documents are cut.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import Scratch, sized

CAPACITY, END_ID = 2048, 0
#: The most items that one task packs at a time, and the share of the capacity from which a bin counts as full.
ITEMS, NEAR = 250_000, 63 / 64
#: Pieces of text whose ids a worker remembers, and bytes of text it encodes at once.
REMEMBERED, SLICE = 400_000, 2 << 20

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


#: Bytes by what they are to the tokenizer: 0 white space, 1 letters (U+00C0 to U+017F lead with 0xC3 to 0xC5),
#: 2 digits, 3 other signs, 4 what may cut or change its neighbours, so that only the tokenizer itself is right.
KIND = np.full(256, 4, np.uint8)
KIND[W.SPACE] = 0
KIND[33:127] = 3
KIND[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = 1
KIND[48:58] = 2
KIND[39] = 4
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Pairs of bytes of kinds 1 and 3 that are not what their bytes say: the signs U+00D7 and U+00F7, U+0130 and U+0149.
_ODD_PAIRS = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0), (0xC5, 0x89), (0x3C, 0x7C))


class Encoder:
    """The tokenizer's ids of many texts at once, as 32-bit numbers.

    A space never lies within a token or changes what stands beside it. Strings between spaces that
    hold letters (Latin), digits and plain signs only are cut into pre-tokens by the tokenizer's rule; any
    other (other scripts, apostrophes, control characters, special tokens) stays whole. Arrow numbers
    the distinct pieces of a slice of texts, exactly; pieces not met before go through the tokenizer,
    many at a time; numpy then lays the pieces' ids out in the order of the text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.start, self.size, self.pool, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, "<u4"), 0

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _keep(self, pieces: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, m = len(self.known), len(self.known) + len(pieces)
        while m > len(self.start):
            self.start, self.size = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.size))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.size[n:m] = sizes
        self.start[n:m] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        self.known.update(zip(pieces, range(n, m)))

    def learn(self, plain: list[bytes], odd: list[bytes]) -> None:
        if plain:
            got = self.tokenizer.encode(b" ".join(plain).decode(), add_special_tokens=False)
            at = np.flatnonzero(np.diff(got.word_ids, prepend=-1))
            if len(at) == len(plain):
                self._keep(plain, np.array(got.ids, "<u4"), np.diff(at, append=len(got.ids)))
            else:  # a piece came apart or has no ids
                odd = plain + odd
        if odd:
            got = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch([s.decode() for s in odd], add_special_tokens=False)]
            self._keep(odd, np.concatenate(got), np.array([len(g) for g in got]))

    def pieces(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts' bytes, lower-cased where that is safe, where each piece or run of spaces begins, and which bytes lie in odd strings."""
        kind = KIND[data]
        edge = np.empty(len(data) + 1, bool)
        edge[0] = edge[-1] = True
        odd_at = kind == 4
        for a, b in _ODD_PAIRS:
            odd_at[:-1] |= (data[:-1] == a) & (data[1:] == b)
        space = kind == 0
        np.not_equal(space[1:], space[:-1], out=edge[1:-1])
        edge[bounds] = True
        at = np.flatnonzero(edge)
        odd_run = np.logical_or.reduceat(odd_at, at[:-1]) if len(data) else np.zeros(0, bool)
        odd = np.repeat(odd_run, np.diff(at))
        cut = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        edge[1:-1] |= cut & ~odd[1:]
        return np.where(odd, data, _LOWER[data]), np.flatnonzero(edge), odd

    def many(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts data[bounds[i]:bounds[i+1]], one after another, and where each text's begin."""
        import pyarrow as pa

        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(bounds), np.int64)
        low, at, odd = self.pieces(data, bounds)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(low)]).dictionary_encode()
        code, words = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        index = list(map(self.known.get, words))
        if None in index:
            if len(self.known) + len(words) > REMEMBERED:
                self.forget()
                index = [None] * len(words)
            first = np.empty(len(words), np.int64)
            first[code[::-1]] = at[:-1][::-1]
            new = [i for i, k in enumerate(index) if k is None]
            blank, strange = W.SPACE[low[first]], odd[first]
            self.learn([words[i] for i in new if not (blank[i] or strange[i])], [words[i] for i in new if strange[i] and not blank[i]])
            if none := [words[i] for i in new if blank[i]]:
                self._keep(none, np.zeros(0, "<u4"), np.zeros(len(none), np.int64))
            index = list(map(self.known.__getitem__, words))
        index = np.array(index)[code]
        size = self.size[index]
        ends = np.cumsum(size)
        ids = self.pool[np.repeat(self.start[index] - ends + size, size) + np.arange(ends[-1])]
        return ids, np.concatenate([[0], ends])[np.searchsorted(at, bounds)]

    def __call__(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        return self.many(raw, np.array([0, len(raw)]))[0]


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One a worker: what it has learnt serves its later tasks."""
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Each document's pieces: doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian 32-bit)."""

    def cut(batches):
        import pyarrow as pa

        encode = encoder(tokenizer)
        for b in batches:
            for lo, hi, data, bounds in W.texts(b.column(1), SLICE):
                ids, begin = encode.many(data, bounds)
                begin = begin + np.arange(hi - lo + 1)  # an end token after each text
                out = np.full(begin[-1], END_ID, "<u4")
                inside = np.ones(begin[-1], bool)
                inside[begin[1:] - 1] = False
                out[inside] = ids
                n = np.diff(begin)
                parts = -(-n // capacity)
                row = np.repeat(np.arange(hi - lo), parts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                at = np.concatenate([begin[:-1][row] + start, begin[-1:]]) * 4
                raw = out.tobytes()
                view = memoryview(raw)
                crc = [zlib.crc32(view[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
                doc = b.column(0)[lo:hi].take(pa.array(row))
                cols = [doc, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(raw)]).cast(pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """(bin, offset) of each item: longest first, each into the fullest bin that has room."""
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    open_, some, n = [[] for _ in range(capacity + 1)], 0, 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[i]
        if fits := some >> size:
            room = size + (fits & -fits).bit_length() - 1
            b = open_[room].pop()
            if not open_[room]:
                some ^= 1 << room
        else:
            room, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - room
        if left := room - size:
            open_[left].append(b)
            some |= 1 << left
    return bins, offsets


def _packed(rows: DataFrame, capacity: int, most: int) -> DataFrame:
    """rows with bin and offset, packed within each task in blocks of about `most`; a bin is numbered by task and block."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        task, block, held = TaskContext.get().partitionId() << 36, 0, []

        def flush():
            t = pa.Table.from_batches(held)
            bins, offsets = best_fit(t.column("length").to_pylist(), capacity)
            base = task + block
            return t.append_column("bin", pa.array([base + b for b in bins], pa.int64())).append_column("offset", pa.array(offsets, pa.int64())).to_batches()

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= most:
                yield from flush()
                block, held[:] = block + most + b.num_rows, []
        if held:
            yield from flush()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, bin bigint, offset bigint")


def _lengths(placed: DataFrame, name: str) -> DataFrame:
    return placed.groupBy(F.col(name).alias("bin")).agg(F.sum("length").alias("length"))


def pack(items: DataFrame, scratch: Scratch, capacity: int = CAPACITY, most: int = ITEMS) -> DataFrame:
    """items (with a length of at most the capacity) with sequence_id and offset. A task packs about `most` items at a time."""
    first = scratch.save(_packed(items.coalesce(max(1, -(-items.count() // most))), capacity, most), "packed")
    bins, moved, turn = scratch.save(_lengths(first, "bin"), "bins"), None, 0
    while True:
        room = NEAR * capacity if turn == 0 else capacity / 2  # after a round of best fit a task has one half empty bin at most
        left = bins.where(F.col("length") <= F.lit(room))
        n, turn = left.count(), turn + 1
        if n < 2:
            break
        tasks = -(-n // most)
        dealt = (left.coalesce(1) if tasks == 1 else left.repartition(tasks, F.xxhash64("bin", F.lit(turn)))).withColumnRenamed("bin", "item")
        done = scratch.save(_packed(dealt.sortWithinPartitions("item"), capacity, most if tasks > 1 else n), f"round{turn}")
        heads = done.where("offset = 0").select("bin", F.col("item").alias("root"))
        step = scratch.save(done.join(heads, "bin").select("item", "root", F.col("offset").alias("base"), "length"), f"step{turn}")
        bins = scratch.save(_lengths(step, "root"), f"bins{turn}")
        step = step.drop("length")
        if moved is None:
            moved = step
        else:
            b = step.select(F.col("item").alias("root"), F.col("root").alias("root2"), F.col("base").alias("base2"))
            moved = scratch.save(moved.join(b, "root", "left").select("item", F.coalesce("root2", "root").alias("root"), (F.col("base") + F.coalesce("base2", F.lit(0))).alias("base")), f"moved{turn}")
        if tasks == 1:
            break
    if moved is None:
        return first.withColumnRenamed("bin", "sequence_id")
    moved = sized(moved, 40).withColumnRenamed("item", "bin")
    cols = [c for c in first.columns if c not in ("bin", "offset")]
    return first.join(moved, "bin", "left").select(*cols, F.coalesce("root", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    scratch = Scratch(docs.sparkSession)
    return pack(scratch.save(pieces(docs, tokenizer, id_col, text_col, capacity), "pieces"), scratch, capacity)
