"""Packing of documents into sequences by Karmarkar-Karp multiway differencing.

A document's ids (and its end id) first fill whole sequences by themselves; what is left of
it is an item.  Every twelfth such rest is cut into small pieces, which level the windows.  The
items of a batch are divided over as few windows as their sum allows: partial partitions are
merged two at a time, always those with the largest spread, the fullest windows of one with
the emptiest of the other, so that imbalances cancel.  While the fullest window exceeds the
capacity the number of windows rises and the division is done again.  A batch closes where its
sum nearly fills its windows: the rest of its last item goes to the next batch.

Items of a batch are packed inside the task that read them: nothing is shuffled, and memory
is bounded by one Arrow batch and one batch of items.  A sequence's number is made of the
partition's number and a count, so a task that is run again gives the same numbers.

Ids come from the byte-level BPE vocabulary of the tokenizers library (tiktoken's form of the
same vocabulary is the faster encoder; the tests hold both against each other).

Defined cases: a null or empty text is the end id alone; repeated rows are packed like others;
a null doc_id stays null; other columns are not looked at.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import cycle
from zlib import crc32

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

RANKS = "byte_bpe_50k.tiktoken"
#: Fixed values of the tokenizer: its one special token, and the id that ends a document here.
SPECIAL, SPECIAL_ID, END_ID = "<|endoftext|>", 50256, 1
CAPACITY = 2048
ITEMS = 256  # items that are packed together
LEVEL_EVERY = 12  # every twelfth rest is cut into pieces of these sizes, over and over
LEVEL_SIZES = (128, 96, 64, 48, 32, 24, 16, 12, 8, 6, 4)
SLACK = 4  # ids a window may lack on average

FIELDS = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)

Partial = list[tuple[int, tuple]]  # windows, fullest first; empty ones are left out


def merged(a: Partial, b: Partial, k: int) -> Partial:
    """The i-th fullest window of one with the i-th emptiest of the other, of k each."""
    alone_a, alone_b = max(0, k - len(b)), max(0, k - len(a))
    both = [
        (a[i][0] + b[k - 1 - i][0], (a[i][1], b[k - 1 - i][1])) for i in range(alone_a, len(a))
    ]
    return sorted(a[:alone_a] + b[:alone_b] + both, key=lambda w: -w[0])


def difference(sizes: list[int], k: int) -> Partial:
    """k windows of nearly equal sums; a window is (sum, nested pairs of item numbers)."""
    heap = []
    for i, size in enumerate(sizes):
        heap.append((-size if k > 1 else 0, i, [(size, i)]))
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heap[0]
        new = merged(a, b, k)
        spread = new[0][0] - (new[-1][0] if len(new) == k else 0)
        heapq.heapreplace(heap, (-spread, number, new))
        number += 1
    return heap[0][2] if heap else []


def flat(items) -> list[int]:
    out, todo = [], [items]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):
            todo += x
        else:
            out.append(x)
    return sorted(out)


def windows(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Item numbers by window; no window holds more than the capacity."""
    if not sizes:
        return []
    k = -(-sum(sizes) // capacity)
    while (found := difference(sizes, k))[0][0] > capacity:
        k += 1
    return [flat(items) for _, items in found]


@cache
def _encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def token_ids(encoding: tiktoken.Encoding, text: str) -> array:
    """The ids of a text with its end id."""
    if SPECIAL not in text:
        ids = encoding.encode_ordinary(text)
    else:
        ids = []
        for piece in re.split(f"({re.escape(SPECIAL)})", text):
            ids += [SPECIAL_ID] if piece == SPECIAL else encoding.encode_ordinary(piece)
    ids.append(END_ID)
    return array("I", ids)


class Packer:
    """Takes documents one by one, gives rows (doc_id, start, length, crc, tokens, sequence, offset)."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.sequence = capacity, first_sequence
        self.items: list[tuple] = []  # (doc_id, start, length, ids, tokens)
        self.rests = 0
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: array) -> None:
        n, view, capacity = len(ids), memoryview(ids.tobytes()), self.capacity
        start = 0
        while n - start >= capacity:
            self._place((doc_id, start, capacity, view[4 * start :], n), 0)
            self.sequence += 1
            start += capacity
        if start < n:
            self.rests += 1
            sizes = LEVEL_SIZES if self.rests % LEVEL_EVERY == 0 else (capacity,)
            for size in cycle(sizes):
                length = min(size, n - start)
                self.items.append((doc_id, start, length, view[4 * start :], n))
                start += length
                if start == n:
                    break
            if len(self.items) >= ITEMS:
                self.flush(last=False)

    def _place(self, item: tuple, offset: int) -> None:
        doc_id, start, length, ids, tokens = item
        self.rows.append((doc_id, start, length, crc32(ids[: 4 * length]), tokens, self.sequence, offset))

    def flush(self, last: bool = True) -> None:
        """Pack what is waiting; unless it is the last, keep back what overfills the windows."""
        back = []
        if not last:
            total = sum(item[2] for item in self.items)
            surplus = total - total // self.capacity * (self.capacity - SLACK)
            while surplus > 0 and self.items:
                doc_id, start, length, ids, tokens = self.items.pop()
                keep = max(0, length - surplus)
                surplus -= length - keep
                if keep:
                    self.items.append((doc_id, start, keep, ids, tokens))
                back.append((doc_id, start + keep, length - keep, ids[4 * keep :], tokens))
        for window in windows([item[2] for item in self.items], self.capacity):
            offset = 0
            for i in window:
                self._place(self.items[i], offset)
                offset += self.items[i][2]
            self.sequence += 1
        self.items = back[::-1]

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def packed(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id and the fields of FIELDS."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {FIELDS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks_path)
        packer = Packer(capacity, TaskContext.get().partitionId() << 36)
        doc_type = None

        def out() -> pa.RecordBatch:
            columns = list(zip(*packer.taken())) or [()] * 7
            types = [doc_type, *[pa.int64()] * 6]
            names = ["doc_id", *(f.split()[0] for f in FIELDS.split(", "))]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            doc_type = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc_id, token_ids(encoding, text.as_py()))
                if len(packer.rows) >= 10_000:
                    yield out()
        if doc_type is not None:
            packer.flush()
            yield out()

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


def pack_documents(docs: DataFrame) -> DataFrame:
    return packed(docs, public_tokenizers.path(RANKS))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
