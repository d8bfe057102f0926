"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

Signature: 60 positions of 16 bits, each the least value of one hash over the text's distinct
five-word shingles.  Two sets of similarity 0.85 differ in 9 positions on average.

Join: the signature is split into 12 chunks of 5.  By the pigeonhole principle two signatures
that differ in at most 23 positions have a chunk that differs in at most one, so each chunk is
indexed once for every position that may be in error (that position left out): all pairs up to
that distance share a key, without exception.

A pair is tested once, at the first key that it shares: by the sizes of the sets, by the
signatures (up to those 23 positions may differ; 2 in a million pairs of similarity 0.85 have more,
3 in 10,000 of similarity 0.80), then exactly on the full sets.  The similarity is a parameter.  A key with many texts is cut into blocks of some thousand, and
each pair of blocks is a piece of work of its own; within one, texts that are already linked
through others aren't compared again, so a group of near copies gives a forest, not all pairs.

Equal sets are one node from the start.  Nothing but the sets of texts that passed the
signature test is moved, besides narrow rows.

Defined cases: null or empty texts, or texts without words, have an empty set and are linked
with nothing; repeated rows and equal sets are in one component; a null doc_id is nobody's
`component_id` but its own; other columns are not looked at; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.components import components
from ledgerline.llm.exact import keep_rows
from ledgerline.llm.shingles import mix, shingle_sets
from ledgerline.session import kept

POSITIONS, CHUNK = 60, 5
CHUNKS = POSITIONS // CHUNK
MOST_APART = 2 * CHUNKS - 1  # one error a chunk, and one more in all but one
SIMILAR = 85  # per cent
STAGE_SIMILAR = 80  # of the pipeline's stage
BLOCK = 1024

_random = np.random.default_rng(20240607)
_XOR = _random.integers(0, 1 << 63, POSITIONS, np.uint64)
_TIMES = _random.integers(0, 1 << 63, POSITIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_SLOT = mix(_random.integers(0, 1 << 63, POSITIONS, np.uint64))


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(POSITIONS, 0xFFFFFFFF, np.uint64)
    for start in range(0, len(shingles), 2048):
        part = shingles[start : start + 2048, None]
        values = ((part ^ _XOR) * _TIMES) >> np.uint64(32)
        least = np.minimum(least, values.min(axis=0))
    return (least * np.uint64(0x9E3779B1) >> np.uint64(16)).astype("<u2")


def index_keys(signatures: np.ndarray) -> np.ndarray:
    """n x 60 keys: key c*5+d is chunk c without its position d."""
    place = np.arange(POSITIONS, dtype=np.uint64) << np.uint64(16)
    terms = mix(signatures.astype(np.uint64) | place)
    whole = terms.reshape(-1, CHUNKS, CHUNK).sum(axis=2, dtype=np.uint64).repeat(CHUNK, axis=1)
    return mix((whole - terms) ^ _SLOT).view(np.int64)


def profiles(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the set, signature: one narrow row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            sizes, digests, signatures = [], [], []
            for s in shingle_sets(texts):
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s, digest_size=16).digest())
                signatures.append(signature(s).tobytes())
            columns = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["doc_id", "n_shingles", "digest", "signature"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(
        run, f"doc_id {kind}, n_shingles bigint, digest binary, signature binary"
    )


def _keys(nodes: DataFrame) -> DataFrame:
    """key, slot, node: sixty rows per node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = b"".join(batch.column(1).to_pylist())
            keys = index_keys(np.frombuffer(raw, "<u2").reshape(-1, POSITIONS))
            slots = np.tile(np.arange(POSITIONS, dtype=np.int32), batch.num_rows)
            ids = batch.column(0).to_numpy().repeat(POSITIONS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(slots), pa.array(ids)], ["key", "slot", "node"]
            )

    return nodes.select("node", "signature").mapInArrow(run, "key bigint, slot int, node bigint")


def whole_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Tables that hold complete groups of sorted rows; a group is as large as a block at most."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.zeros(batch.num_rows, bool)
        for name in names:
            column = batch.column(name).to_numpy(zero_copy_only=False)
            ends[1:] |= column[1:] != column[:-1]
        if waiting:
            last = waiting[-1]
            ends[0] = any(last.column(n)[-1].as_py() != batch.column(n)[0].as_py() for n in names)
        starts = np.flatnonzero(ends)
        if len(starts):
            cut = int(starts[-1])
            ready = [*waiting, batch.slice(0, cut)]
            waiting = [batch.slice(cut)]
            if sum(b.num_rows for b in ready):
                yield pa.Table.from_batches(ready)
        else:
            waiting.append(batch)
    if waiting:
        yield pa.Table.from_batches(waiting)


GROUP = ["key", "low", "high"]


def _pairs(table: pa.Table, similar: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers (s, t) of the pairs to be tested here, and in how many positions they differ."""
    column = lambda name: table.column(name).to_numpy()
    group = np.zeros(table.num_rows, np.int64)
    for name in GROUP:
        values = column(name)
        group[1:] += values[1:] != values[:-1]
    group = np.cumsum(group > 0)
    block, slot, node, size = column("block"), column("slot"), column("node"), column("n")
    inner = column("low") == column("high")
    signatures = np.frombuffer(
        b"".join(table.column("signature").to_pylist()), "<u2"
    ).reshape(-1, POSITIONS)
    for shift in range(1, int(np.bincount(group).max(initial=1))):
        s = np.flatnonzero(group[shift:] == group[:-shift])
        t = s + shift
        less, more = np.minimum(size[s], size[t]), np.maximum(size[s], size[t])
        test = (100 * less >= similar * more) & (node[s] != node[t])
        test &= inner[s] | (block[s] != block[t])
        s, t = s[test], t[test]
        for start in range(0, len(s), 1 << 15):
            a, b = s[start : start + (1 << 15)], t[start : start + (1 << 15)]
            apart = signatures[a] != signatures[b]
            errors = apart.reshape(-1, CHUNKS, CHUNK).sum(axis=2)
            chunk = (errors <= 1).argmax(axis=1)
            first = chunk * CHUNK + apart.reshape(-1, CHUNKS, CHUNK)[np.arange(len(a)), chunk].argmax(axis=1)
            total = errors.sum(axis=1)
            found = (total <= MOST_APART) & (first == slot[a])
            yield a[found], b[found], total[found]


ROW = "key bigint, low int, high int, block int, slot int, node bigint"


def _passing(batches: Iterator[pa.RecordBatch], similar: int) -> Iterator[pa.RecordBatch]:
    """The rows that have a partner by size and signature."""
    for table in whole_groups(batches, GROUP):
        marked = np.zeros(table.num_rows, bool)
        for s, t, _ in _pairs(table, similar):
            marked[s] = marked[t] = True
        out = table.select([f.split()[0] for f in ROW.split(", ")]).filter(pa.array(marked))
        yield from out.combine_chunks().to_batches()


def _linked(batches: Iterator[pa.RecordBatch], similar: int) -> Iterator[pa.RecordBatch]:
    """Links between sets of sufficient similarity; a forest for each piece of work."""
    for table in whole_groups(batches, GROUP):
        found = [np.concatenate(x) for x in zip(*_pairs(table, similar))]
        if not found or not len(found[0]):
            continue
        order = np.argsort(found[2], kind="stable")
        nodes, sets = table.column("node").to_pylist(), table.column("shingles")
        above: dict[int, int] = {}

        def top(x: int) -> int:
            while (y := above.get(x, x)) != x:
                above[x] = above.get(y, y)
                x = y
            return x

        links = []
        loaded: dict[int, np.ndarray] = {}

        def members(row: int) -> np.ndarray:
            if row not in loaded:
                loaded[row] = np.frombuffer(sets[row].as_py(), "<u8")
            return loaded[row]

        for s, t in zip(found[0][order].tolist(), found[1][order].tolist()):
            a, b = top(nodes[s]), top(nodes[t])
            if a == b:
                continue
            x, y = members(s), members(t)
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common >= similar * (len(x) + len(y) - common):
                above[a] = b
                links.append((nodes[s], nodes[t]))
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _sets(texts: DataFrame) -> DataFrame:
    """node, shingles of those rows (node, digest, text) whose set has that digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = {}
            for i, digest, s in zip(ids, digests, shingle_sets(batch.column(2).cast(pa.binary()).to_pylist())):
                if hashlib.blake2b(s, digest_size=16).digest() == digest:
                    out[i] = s.astype("<u8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.int64()), pa.array(out.values(), pa.binary())], ["node", "shingles"]
            )

    return texts.mapInArrow(run, "node bigint, shingles binary").dropDuplicates(["node"])


def similar_links(docs: DataFrame, nodes: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """Links (a, b) between nodes; they connect whatever is similar, directly or through others."""
    keys = _keys(nodes)
    shared = keys.groupBy("key").count().filter("count > 1")
    rows = (
        keys.join(shared, "key")
        .withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "slot", "node")
    )
    narrow = nodes.select("node", F.col("n_shingles").alias("n"), "signature")
    grouped = rows.join(narrow, "node").repartition(*GROUP).sortWithinPartitions(*GROUP)
    passing = kept(grouped.mapInArrow(lambda rows: _passing(rows, similar), ROW), "passing")
    wanted = passing.select("node").distinct().join(nodes, "node").select("node", "digest", "doc_id")
    texts = docs.select("doc_id", "text").join(wanted, "doc_id").select("node", "digest", "text")
    full = passing.join(narrow, "node").join(_sets(texts), "node")
    ordered = full.repartition(*GROUP).sortWithinPartitions(*GROUP)
    return ordered.mapInArrow(lambda rows: _linked(rows, similar), "a bigint, b bigint")


def near_groups(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs."""
    listed = kept(profiles(docs), "profiles")
    grouped = listed.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    nodes = kept(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")
    labels = kept(components(similar_links(docs, nodes, similar)), "labels")
    named = nodes.select("node", "digest", "doc_id").join(labels, "node", "left")
    named = named.withColumn("label", F.coalesce("label", "node"))
    # written, like the labels: the joins to them are between plain tables, which Spark splits
    least = kept(named.groupBy("label").agg(F.min("doc_id").alias("component_id")), "components")
    of_set = named.join(least, "label").select("digest", "component_id")
    out = listed.select("doc_id", "n_shingles", "digest").join(of_set, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """docs with the row of the smallest doc_id of each group of near copies."""
    return keep_rows(docs, near_groups(docs, STAGE_SIMILAR).filter("kept"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
