"""Training-order materialisation: token sequences at permuted global slots, in fixed-stride shards.

Each text's tokens and one end-of-text token are cut into sequences of ``length`` tokens, which never cross documents.
The N sequences are numbered 0 to N - 1 in the order of the staged scan, and a keyed Feistel network over the next even
number of bits, walked until it falls below N, is a permutation of these numbers: a sequence's global slot. Shard
slot div ``shard_sequences`` holds its sequences in slot order as records of ``2 * length`` bytes (little-endian 16-bit
ids, filled up with end-of-text), so that a reader finds slot s at byte (s mod shard_sequences) * 2 * length and can
resume anywhere. No table of the permutation is needed: ``unpermuted`` gives a slot's number back.

Cases: null and empty texts are a single end-of-text token; repeated rows give repeated sequences; a null doc_id is
kept; an empty table gives no sequences; other columns are ignored. The numbering follows the scan's partitions: the
same table under the same settings gives the same order.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import parts_for, shared_dir, type_of

LENGTH = 512
SHARD_SEQUENCES = 16384
KEY = 0x5EED_0F_0DDBA11
ROUNDS = 6
#: Shards that a task puts in order, where there are many.
SHARDS_A_TASK = 8
#: Bytes of a vocabulary file that is sent to the tasks.
MOST_VOCABULARY = 64 << 20
_encodings: dict = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _walk(x: np.ndarray, n: int, key: int, order: list[int]) -> np.ndarray:
    w = np.uint64(_half_bits(n))
    mask = np.uint64((1 << int(w)) - 1)
    keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key & (2**64 - 1)))
    out = x.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        v = out[todo]
        left, right = v >> w, v & mask
        for r in order:
            if order[0] == 0:
                left, right = right, left ^ (_mix(right ^ keys[r]) & mask)
            else:
                left, right = right ^ (_mix(left ^ keys[r]) & mask), left
        out[todo] = (left << w) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def permuted(numbers: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Slots of ``numbers`` (0 to n - 1)."""
    return _walk(np.asarray(numbers), n, key, list(range(ROUNDS)))


def unpermuted(slots: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    return _walk(np.asarray(slots), n, key, list(range(ROUNDS))[::-1])


def encoding(vocabulary: bytes, pattern: str):
    """A tokenizer from the lines of a rank file; one for each worker."""
    import tiktoken

    name = (hash(vocabulary), pattern)
    if name not in _encodings:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        _encodings[name] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[name]


def tokenised(docs: DataFrame, vocabulary: bytes, pattern: str, end: int, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, at, id, seq, n_tokens, tokens BINARY): ``at`` counts the sequences of the scan's partition ``part``."""
    if len(vocabulary) > MOST_VOCABULARY:
        raise ValueError(f"vocabulary of {len(vocabulary)} bytes; at most {MOST_VOCABULARY} are sent to the tasks")
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    from pyspark.sql import types as T

    schema = T._parse_datatype_string(f"part int, at bigint, id {type_of(docs, id_col)}, seq int, n_tokens int, tokens binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(sent.value, pattern).encode_ordinary
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            source, seq, count, tokens = [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text or "")
                ids.append(end)
                data = np.array(ids, "<u2").tobytes()
                for k in range(0, len(ids), length):
                    source.append(row)
                    seq.append(k // length)
                    count.append(min(length, len(ids) - k))
                    tokens.append(data[2 * k : 2 * (k + length)])
            if source:
                n = len(source)
                columns = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n)), batch.column(0).take(pa.array(source)), pa.array(seq, pa.int32()), pa.array(count, pa.int32()), pa.array(tokens, pa.binary())]
                at += n
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, schema)


def training_order(
    docs: DataFrame, vocabulary: bytes, pattern: str, end: int, length: int = LENGTH, shard_sequences: int = SHARD_SEQUENCES, key: int = KEY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, seq, n_tokens, slot, shard, byte_offset, record BINARY): range partitions of whole shards, in slot order."""
    spark: SparkSession = docs.sparkSession
    path = f"{shared_dir(spark)}/sequences-{uuid.uuid4().hex}"
    made = tokenised(docs, vocabulary, pattern, end, length, id_col, text_col)
    made.write.option("compression", "zstd").parquet(path)
    made = spark.read.schema(made.schema).parquet(path)
    # A row for each partition of the scan.
    counts = sorted((r["part"], r["n"]) for r in made.groupBy("part").agg(F.count("*").alias("n")).collect())
    starts, n = [], 0
    for part, k in counts:
        starts.append((part, n))
        n += k
    starts_df = spark.createDataFrame(starts, "part int, start bigint")

    @F.pandas_udf("bigint")
    def slot_of(number: pd.Series) -> pd.Series:
        return pd.Series(permuted(number.to_numpy(np.int64), n, key))

    placed = made.join(F.broadcast(starts_df), "part").withColumn("slot", slot_of(F.col("start") + F.col("at")))
    # Range partitions whose splitters are shard ends: partition p holds shards in order, and before those of p + 1.
    shards = max(1, -(-n // shard_sequences))
    parts = parts_for(shards, SHARDS_A_TASK, 1)
    placed = placed.select("id", "seq", "n_tokens", "slot", F.expr(f"slot div {shard_sequences}").alias("shard"), "tokens")
    placed = placed.repartitionById(parts, F.expr(f"cast(shard * {parts} div {shards} as int)")).sortWithinPartitions("slot")
    fill = F.lit(int(end).to_bytes(2, "little"))
    return placed.select(
        F.col("id").alias(id_col), "seq", "n_tokens", "slot", "shard", (F.col("slot") % shard_sequences * (2 * length)).alias("byte_offset"), F.rpad("tokens", F.lit(2 * length), fill).alias("record")
    )


def write_shards(ordered: DataFrame, uri: str) -> DataFrame:
    """Writes each shard's records to ``uri``/shard-N.bin and returns (shard, first_slot, records, bytes, sha256).

    ``uri``: a folder that pyarrow.fs reaches from every executor. A shard is written to a name of the task attempt's own
    and moved when complete, so a repeated task leaves the same file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(uri)
        store.create_dir(root, recursive=True)
        tag = TaskContext.get().taskAttemptId()
        now, out, done = None, None, []

        def close():
            out["file"].close()
            store.move(out["name"], f"{root}/shard-{now:08d}.bin")
            done.append((now, out["first"], out["n"], out["bytes"], out["sha"].hexdigest()))

        for batch in batches:
            for shard, slot, record in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != now:
                    if out:
                        close()
                    name = f"{root}/_shard-{shard:08d}.{tag}"
                    now, out = shard, {"name": name, "file": store.open_output_stream(name), "first": slot, "n": 0, "bytes": 0, "sha": hashlib.sha256()}
                out["file"].write(record)
                out["sha"].update(record)
                out["n"] += 1
                out["bytes"] += len(record)
        if out:
            close()
        if done:
            shard, first, n, size, sha = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(first, pa.int64()), pa.array(n, pa.int64()), pa.array(size, pa.int64()), pa.array(sha)], names=["shard", "first_slot", "records", "bytes", "sha256"])

    return ordered.select("shard", "slot", "record").mapInArrow(run, "shard bigint, first_slot bigint, records bigint, bytes bigint, sha256 string")
