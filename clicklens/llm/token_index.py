"""Token ids in raw shard files, with a minimal perfect hash index.

Shard file: the ids of its documents as little-endian unsigned integers of two
bytes (four, if the vocabulary has more than 65,536 entries), in ascending doc_id
order, then the first id's position of each document and the
end (unsigned 64-bit), then the number of documents (unsigned 64-bit). Shards
follow the order of their numbers: the range shuffle that sorts the documents
deals each task one range, as many as the input has partitions.

Index file: keys are dealt to parts by hash; a part of about ``PART`` keys is a
cascade of bit arrays. A key that is alone at its place of a level sets that bit,
the others go to the next level; the rank of its bit is the key's slot, so n keys
fill the slots 0..n-1 without gaps. A slot stores a fingerprint of its key, the
shard, the row in the shard and the number of rows. A lookup hashes the key, reads
a bit and a rank, and compares the fingerprint, whatever the number of keys.

Files are written under new names by each attempt; the tables of shards and parts
are written by Spark and name only files of tasks that were committed, so retried
or lost tasks leave nothing that is read.

Defined results: a null text has no ids but the end id. A null doc_id sorts first
and is found under the null key, which is kept as the least 64-bit integer (that
integer is no other id). Rows that share a doc_id are documents of their own,
ordered by text; their key finds them all. No documents: no shards, no parts.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklens.llm.common import materialize, small_batches
from clicklens.llm.files import make_folder, opened, read_file, write_file
from clicklens.llm.word_ids import WordEncoder
from clicklens.session import scratch_path

NULL_KEY = -(1 << 63)
PART = 500_000
# Bytes of ids sent back at a time.
BATCH = 1 << 20


# -- minimal perfect hash ---------------------------------------------------

def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x ^ np.uint64((salt * 0x9E3779B97F4A7C15 + 0x1234567) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0..n-1 for n distinct 64-bit keys."""

    def __init__(self, bits: list[np.ndarray]) -> None:
        self.bits = bits  # of each level, in words of 64
        ones = np.concatenate([np.bitwise_count(b) for b in bits]) if bits else np.empty(0, np.uint8)
        self.rank = np.cumsum(ones, dtype=np.int64) - ones

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, bits = keys.astype(np.int64).view(np.uint64), []
        while len(left):
            size = -(-2 * len(left) // 64)
            at = _mix(left, len(bits)) % np.uint64(size * 64)
            places, n = np.unique(at, return_counts=True)
            alone = places[n == 1]
            level = np.zeros(size, np.uint64)
            np.bitwise_or.at(level, (alone >> np.uint64(6)).astype(np.int64), np.uint64(1) << (alone & np.uint64(63)))
            bits.append(level)
            left = left[~np.isin(at, alone)]
        return cls(bits)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key of the set; of other keys any slot, or -1."""
        left, out = keys.astype(np.int64).view(np.uint64), np.full(len(keys), -1, np.int64)
        open_, base = np.arange(len(keys)), 0
        for depth, level in enumerate(self.bits):
            at = _mix(left, depth) % np.uint64(len(level) * 64)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (level[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(level[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[hit]] = (self.rank[base + word] + below)[hit]
            left, open_, base = left[~hit], open_[~hit], base + len(level)
        return out


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys.astype(np.int64).view(np.uint64), 1 << 20) >> np.uint64(32)).astype(np.uint32)


# -- files ------------------------------------------------------------------

@dataclass
class TokenStore:
    """``shards``: shard, file, n_docs, n_ids, base. ``parts``: part, file, n_keys."""

    shards: DataFrame
    parts: DataFrame
    n_parts: int
    kind: str


def key_of(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_KEY))


def _part_of(key: str, n_parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_parts)).cast("int")


def _write_shards(folder: str, tokenizer_json: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordEncoder(tokenizer_json)
        end = np.array([end_id], encode.kind).tobytes()
        shard = TaskContext.get().partitionId()
        path, stream = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}", None
        begins, row = [np.zeros(1, np.int64)], 0
        for part in batches:
            n = part.num_rows
            if not n:
                continue
            if stream is None:
                system, inner = opened(path)
                stream = system.open_output_stream(inner)
            ids = [x + end for x in encode(part.column(1))]
            sizes = np.fromiter(map(len, ids), np.int64, n) // len(end)
            stream.write(b"".join(ids))
            begins.append(begins[-1][-1] + np.cumsum(sizes))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, shard, np.int32)), pa.array([path] * n), part.column(0),
                                              pa.array(np.arange(row, row + n)), pa.array(sizes)], ["shard", "file", "key", "row", "n_ids"])
            row += n
        if stream is not None:
            stream.write(np.concatenate(begins).astype("<u8").tobytes() + np.array([row], "<u8").tobytes())
            stream.close()

    return run


def _write_parts(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def write(rows: pd.DataFrame) -> pd.DataFrame:
            keys = rows["key"].to_numpy()
            table = PerfectHash.build(keys)
            order = np.argsort(table.slots(keys))
            out = io.BytesIO()
            np.savez(out, fingerprint=_fingerprint(keys)[order], **{c: rows[c].to_numpy()[order] for c in ("shard", "row", "n_rows")},
                     **{f"level{i:03d}": b for i, b in enumerate(table.bits)})
            path = f"{folder}/part-{int(rows['part'].iloc[0]):06d}-{uuid.uuid4().hex}"
            write_file(path, out.getvalue())
            return pd.DataFrame({"part": rows["part"].iloc[:1].to_numpy(), "file": path, "n_keys": len(rows)})

        held: list[pd.DataFrame] = []
        for batch in batches:
            for part, rows in batch.groupby("part", sort=False):
                if held and held[-1]["part"].iloc[0] != part:
                    yield write(pd.concat(held))
                    held = []
                held.append(rows)
        if held:
            yield write(pd.concat(held))

    return run


def write_store(docs: DataFrame, tokenizer_json: str, end_id: int) -> TokenStore:
    """Encodes (doc_id, text), writes shard files and index files, and returns their tables."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    make_folder(folder)
    ordered = (small_batches(docs).select(key_of().alias("key"), "text")
               .repartitionByRange(max(1, docs.rdd.getNumPartitions()), "key").sortWithinPartitions("key", "text"))
    rows = materialize(ordered.mapInArrow(_write_shards(folder, tokenizer_json, end_id),
                                           "shard int, file string, key long, row long, n_ids long"), "token-rows")
    shards = rows.groupBy("shard", "file").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_ids").alias("n_ids"))
    # one row a shard: the running sum is over files, not documents
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = materialize(shards.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "token-shards")
    keys = rows.groupBy("key").agg(F.min("shard").alias("shard"), F.min("row").alias("row"), F.count(F.lit(1)).alias("n_rows"))
    n_parts = max(1, -(-rows.count() // PART))
    parts = (keys.withColumn("part", _part_of("key", n_parts)).repartition(n_parts, "part").sortWithinPartitions("part", "key")
             .mapInPandas(_write_parts(folder), "part int, file string, n_keys long"))
    return TokenStore(shards, materialize(parts, "token-parts"), n_parts, WordEncoder(tokenizer_json).kind)


class IndexPart:
    """One index file."""

    def __init__(self, path: str) -> None:
        table = np.load(io.BytesIO(read_file(path)))
        self.hash = PerfectHash([table[n] for n in sorted(table.files) if n.startswith("level")])
        self.fingerprint, self.shard, self.row, self.n_rows = (table[n] for n in ("fingerprint", "shard", "row", "n_rows"))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which keys are known, their slots)."""
        slot = self.hash.slots(keys)
        known = np.flatnonzero(slot >= 0)
        known = known[self.fingerprint[slot[known]] == _fingerprint(keys[known])]
        return known, slot[known]


def lookup(keys: DataFrame, store: TokenStore) -> DataFrame:
    """(key) -> (key, shard, row, n_rows) of the keys in the index; unknown ones give nothing."""
    asked = (keys.select("key", _part_of("key", store.n_parts).alias("part"))
             .join(store.parts.select("part", "file"), "part")
             .repartition(store.n_parts, "part").sortWithinPartitions("part"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, index = None, None
        for batch in batches:
            for file, rows in batch.groupby("file", sort=False):
                if file != path:
                    path, index = file, IndexPart(file)
                own = rows["key"].to_numpy()
                known, slot = index.find(own)
                yield pd.DataFrame({"key": own[known], "shard": index.shard[slot], "row": index.row[slot], "n_rows": index.n_rows[slot]})

    return asked.mapInPandas(run, "key long, shard int, row long, n_rows long")


def read_ids(places: DataFrame, store: TokenStore) -> DataFrame:
    """(key, shard, row, n_rows) -> one row a document: key, start over all shards, ids (as
    little-endian unsigned 32-bit integers)."""
    # rows are small, so tasks are counted by the shards they read
    at = (places.join(store.shards.select("shard", "file", "base"), "shard")
          .repartition(max(1, store.shards.count()), "file").sortWithinPartitions("file", "row"))

    kind, width = store.kind, np.dtype(store.kind).itemsize

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, f, begins = None, None, None
        for batch in batches:
            for file, rows in batch.groupby("file", sort=False):
                if file != path:
                    system, inner = opened(file)
                    path, f = file, system.open_input_file(inner)
                    f.seek(f.size() - 8)
                    n = int(np.frombuffer(f.read(8), "<u8")[0])
                    f.seek(f.size() - 8 * (n + 2))
                    begins = np.frombuffer(f.read(8 * (n + 1)), "<u8").astype(np.int64)
                out, held = [], 0
                for key, row, n_rows, base in zip(rows["key"].tolist(), rows["row"].tolist(), rows["n_rows"].tolist(), rows["base"].tolist(), strict=True):
                    for r in range(row, row + n_rows):
                        f.seek(width * int(begins[r]))
                        ids = np.frombuffer(f.read(width * int(begins[r + 1] - begins[r])), kind).astype("<u4").tobytes()
                        out.append((key, base + int(begins[r]), ids))
                        held += len(ids)
                    if held > BATCH:
                        yield pd.DataFrame(out, columns=["key", "start", "ids"])
                        out, held = [], 0
                yield pd.DataFrame(out, columns=["key", "start", "ids"])

    return at.mapInPandas(run, "key long, start long, ids binary")


def query(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Writes all documents, then looks every doc_id up in the index and reads its ids back."""
    with open(tokenizer_path, encoding="utf-8") as f:
        store = write_store(docs, f.read(), end_id)
    keys = docs.select(key_of().alias("key")).distinct()
    read = read_ids(lookup(keys, store), store)
    return read.select(F.when(F.col("key") != NULL_KEY, F.col("key")).alias("doc_id"), "start",
                       F.expr("cast(octet_length(ids) / 4 as long)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
