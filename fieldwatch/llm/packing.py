"""Sum-of-squares online packing of tokenised documents into fixed windows.

Every task packs the documents of its own partition as they come, so tokens are never shuffled. A document's whole windows are
full at once. Its rest goes to the fill level h, 0 being a new window, that least raises the sum over levels of the squared number
of windows filled to that level; the counts are kept in a level array. A window leaves when it is full. When ``max_open`` windows are
open, and at the partition's end, the open windows' pieces are cut anew and fill whole windows; what then remains at the end is
cut into sequences whose lengths are powers of two, which need no padding.

Defined results: a null or empty text is the end id alone. A null doc_id is carried along. Sequence ids hold the partition number in
their upper bits and so are distinct; the rows of one partition come from one task, also when it is run again.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Documents whose unknown words are encoded together.
TOGETHER = 256
NAMES = [field.split()[0] for field in SCHEMA.split(", ")]

Piece = tuple[int | None, int, bytes, int]
"""doc_id, the document's ids before it, ids, the document's ids."""


#: ASCII punctuation that the tokenizer splits from a letter or number before it, but for what special tokens are written with.
TAIL = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "<>|")
LETTER = regex.compile(r"[\p{L}\p{N}]")


def _splits(core: bytes) -> bool:
    """Whether a word without its punctuation at the end is split from it: its last letter or number must stay a single one when it is normalised."""
    if core[-1] < 128:
        return core[-1:].isalnum()
    last = unicodedata.normalize("NFC", core.decode()[-1]).lower()
    return len(last) == 1 and bool(LETTER.fullmatch(last))


class WordIds(dict):
    """word -> its ids as little-endian 32-bit integers, remembering the words of up to two generations of LIMIT.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its words in turn. Words that aren't known are encoded together, without their punctuation
    at the end, which is encoded apart. Capitals are ASCII lower case first, as the tokenizer would have it, unless the text has combining marks, with which small letters may join where capitals don't,
    or what may be a special token.
    """

    LIMIT = 600_000

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # each core has a task of its own
        from tokenizers import Tokenizer

        self.tokenizer, self.older = Tokenizer.from_file(path), {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends_word[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, words: set[bytes]) -> None:
        """Words of letters alone are encoded as one text, of which each gives one run of ids up to one that ends a word; the others, or all if the runs aren't as many, each apart."""
        apart, joined = [], []
        for word in words:
            (joined if word.decode().isalpha() else apart).append(word)
        ids = np.asarray(self.tokenizer.encode(b" ".join(joined).decode(), add_special_tokens=False).ids, "<u4")
        ends = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
        if len(ends) == len(joined):
            flat = ids.tobytes()
            self.update(zip(joined, map(flat.__getitem__, map(slice, [0, *ends], ends)), strict=True))
        else:
            apart += joined
        for word, found in zip(apart, self.tokenizer.encode_batch_fast([w.decode() for w in apart], add_special_tokens=False), strict=True):
            self[word] = np.asarray(found.ids, "<u4").tobytes()

    def _learn(self, words: set[bytes]) -> None:
        older, tailed, new = self.older, [], set()
        for word in words:
            if known := older.get(word):
                self[word] = known
            elif (core := word.rstrip(TAIL)) and len(core) < len(word) and _splits(core):
                tailed.append((word, core, word[len(core) :]))
            else:
                new.add(word)
        new.update(part for _, *parts in tailed for part in parts if part not in self)
        self._encode(new)
        for word, core, tail in tailed:
            self[word] = self[core] + self[tail]

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text."""
        if len(self) > self.LIMIT:
            self.older = dict(self)
            self.clear()
        words = []
        for text in texts:
            data = (text or "").encode()
            words.append((data if b"\xcc" in data or b"\xcd" in data or b"<|" in data else data.lower()).split())
        if missing := set().union(*words) - self.keys():
            self._learn(missing)
        return [b"".join(map(self.__getitem__, w)) for w in words]


_made: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One a Python worker, so that tasks share what it remembers."""
    if path not in _made:
        _made[path] = WordIds(path)
    return _made[path]


class Packer:
    """Windows of one partition. Takes documents, returns the rows of windows that are complete."""

    def __init__(self, size: int, first_sequence: int, max_open: int) -> None:
        self.size, self.sequence, self.max_open = size, first_sequence, max_open
        self.count = np.zeros(size + 1, np.int64)  # windows by fill level
        self.open: list[list[list[Piece]]] = [[] for _ in range(size + 1)]
        self.n_open = 0

    def _rows(self, pieces: list[Piece]) -> list[tuple]:
        rows, offset = [], 0
        for doc_id, start, ids, total in pieces:
            rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), total, self.sequence, offset))
            offset += len(ids) // 4
        self.sequence += 1
        return rows

    def _level(self, length: int) -> int:
        """The best level for a piece: emptier counts there, fuller ones here; of equals the fullest."""
        n, last = self.count, self.size - length
        change = np.where(np.arange(last + 1) > 0, 1 - 2 * n[: last + 1], 0) + np.where(np.arange(last + 1) < last, 2 * n[length : self.size + 1] + 1, 0)
        change[1:][n[1 : last + 1] == 0] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))

    def add(self, doc_id: int | None, ids: bytes) -> list[tuple]:
        rows, total, step = [], len(ids) // 4, 4 * self.size
        whole = len(ids) // step
        for k in range(whole):
            rows += self._rows([(doc_id, k * self.size, ids[k * step : (k + 1) * step], total)])
        rest = ids[whole * step :]
        if rest:
            length = len(rest) // 4
            level = self._level(length)
            window = self.open[level].pop() if level else []
            self.count[level] -= level > 0
            self.n_open -= level > 0
            window.append((doc_id, whole * self.size, rest, total))
            if level + length == self.size:
                rows += self._rows(window)
            else:
                self.open[level + length].append(window)
                self.count[level + length] += 1
                self.n_open += 1
                if self.n_open > self.max_open:
                    rows += self.refill(last=False)
        return rows

    def refill(self, last: bool) -> list[tuple]:
        """The open windows' pieces cut into full windows; the remainder stays open, or is cut by powers of two."""
        pieces = [p for level in range(self.size, 0, -1) for window in self.open[level] for p in window]
        left, rows = sum(len(p[2]) for p in pieces) // 4, []
        self.open, self.n_open = [[] for _ in range(self.size + 1)], 0
        self.count[:] = 0
        pieces.reverse()
        while left:
            want = self.size if left >= self.size else 1 << (left.bit_length() - 1) if last else left
            window, have = [], 0
            while have < want:
                doc_id, start, ids, total = pieces.pop()
                n = min(want - have, len(ids) // 4)
                window.append((doc_id, start, ids[: 4 * n], total))
                if 4 * n < len(ids):
                    pieces.append((doc_id, start + n, ids[4 * n :], total))
                have += n
            left -= want
            if want == self.size or last:
                rows += self._rows(window)
            else:
                self.open[want].append(window)
                self.count[want], self.n_open = 1, 1
        return rows


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, max_open: int = 4096) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. tokenizer: a file all executors have."""
    end = np.asarray([end_id], "<u4").tobytes()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = word_ids(tokenizer), Packer(size, TaskContext.get().partitionId() << 40, max_open)
        types = [pa.int64()] * len(NAMES)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=NAMES)

        rows: list[tuple] = []
        for batch in batches:
            for k in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(k, TOGETHER)
                for doc_id, ids in zip(some.column(0), words.ids(some.column(1).to_pylist()), strict=True):
                    rows += packer.add(doc_id.as_py(), ids + end)
                if len(rows) >= 10_000:
                    yield batch_of(rows)
                    rows = []
        rows += packer.refill(last=True)
        if rows:
            yield batch_of(rows)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(packed, SCHEMA)
