"""Shards by jump consistent hashing.

A key walks through ever larger shard numbers; a generator seeded by the key alone draws each jump,
and the last number below the count of shards is the key's shard. No table of shards or ring points
is kept, shares are even, and with one more shard exactly those keys move whose next jump lands on
it: nothing moves between old shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terratally.functions.keys import numbered
from terratally.llm.common import fresh, mix, staged

SHARDS = 16
#: Fixed values of the jump generator: a 64-bit linear congruence whose top 31 bits are used.
_FACTOR = 2862933555777941757
_TOP = 33
_SPAN = float(1 << 31)


def jump(ids: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit id among ``shards``."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    state = mix(ids.astype(np.int64).view(np.uint64))
    place = np.zeros(len(state), dtype=np.int64)
    open_ = np.arange(len(state))
    drawn = np.zeros(len(state), dtype=np.int64)
    while len(open_):
        place[open_] = drawn
        state = state * np.uint64(_FACTOR) + np.uint64(1)
        draw = ((state >> np.uint64(_TOP)) + np.uint64(1)).astype(np.float64)
        drawn = ((place[open_] + 1) * (_SPAN / draw)).astype(np.int64)
        inside = drawn < shards
        open_, state, drawn = open_[inside], state[inside], drawn[inside]
    return place


def assign(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Where every row goes: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's bytes plus one, ``slot`` the row's place in its shard by id, size and
    checksum, ``grown_shard`` its shard were there one more. Reads doc_id and text; other columns are
    ignored, whatever their names. A null text has size 1 and the checksum of an empty one; a null id
    goes where id 0 goes. Rows that repeat an id share its shard and have a slot each. An empty table
    gives no rows.
    """
    measured = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pc.fill_null(batch["doc_id"], 0).to_numpy()
            now, then = (pa.array(jump(ids, n), pa.int32()) for n in (shards, shards + 1))
            yield pa.record_batch([*batch.columns, now, then], names=[*batch.schema.names, "shard", "grown_shard"])

    layout = "doc_id long, size long, text_crc32 long, shard int, grown_shard int"
    rows = staged(measured.mapInArrow(placed, layout), "shards")
    order = [F.col(c) for c in ("doc_id", "size", "text_crc32")]
    slots = numbered(rows, "slot", order, ["shard"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def with_shard(documents: DataFrame, shards: int = SHARDS, name: str = "shard") -> DataFrame:
    """All columns and the shard, under a name of its own if ``name`` is taken."""

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        return pd.Series(jump(ids.to_numpy(), shards).astype(np.int32))

    (name,) = fresh(documents, name)
    return documents.withColumn(name, shard_of(F.coalesce(F.col("doc_id").cast("long"), F.lit(0))))


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write all rows below ``path``, one folder ``shard=K`` each; large shards get several files."""
    rows = with_shard(documents, shards)
    name = rows.columns[-1]
    rows.hint("rebalance", name).write.partitionBy(name).parquet(path)


def moving(documents: DataFrame, shards: int, more: int) -> DataFrame:
    """Rows that ``more`` shards, appended to ``shards``, take over, with both shards.

    Adds ``from_shard`` and ``to_shard``; all new shards are at ``shards`` or above.
    """
    before = with_shard(documents, shards, "from_shard")
    after = with_shard(before, shards + more, "to_shard")
    old, new = after.columns[-2:]
    return after.where(F.col(old) != F.col(new))


#: 64 bits of an unsigned product or sum, out of 128.
_LOW_64 = "18446744073709551616::UHUGEINT"


def _mixed_sql(value: str) -> str:
    """``mix`` over an unsigned 64-bit expression, step by step through subqueries."""
    first = f"(SELECT (xor(v, v >> 30)::UHUGEINT * 13787848793156543929 % {_LOW_64})::UBIGINT FROM (SELECT {value} AS v))"
    second = f"(SELECT (xor(v, v >> 27)::UHUGEINT * 10723151780598845931 % {_LOW_64})::UBIGINT FROM (SELECT {first} AS v))"
    return f"(SELECT xor(v, v >> 31) FROM (SELECT {second} AS v))"


_STATE = f"((state::UHUGEINT * {_FACTOR} + 1) % {_LOW_64})::UBIGINT"


def _jump_sql(shards: int) -> str:
    """Shard by id: walk until a jump leaves the shards."""
    return f"""
walk{shards} AS (
    SELECT id, 0::BIGINT AS place, 0::BIGINT AS drawn, state FROM seeds
    UNION ALL
    SELECT id, drawn, CAST(floor((drawn + 1) * (2147483648.0::DOUBLE / ((after >> {_TOP}) + 1)::DOUBLE)) AS BIGINT), after
    FROM (SELECT id, drawn, {_STATE} AS after FROM walk{shards} WHERE drawn < {shards})
), at{shards} AS (
    SELECT id, max(place) AS shard FROM walk{shards} GROUP BY id
)"""


SHARDING_SQL = f"""
WITH RECURSIVE steps AS (
    SELECT i, 0 AS bit, i::BIGINT AS value FROM range(256) t(i)
    UNION ALL
    SELECT i, bit + 1, CASE WHEN value % 2 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END
    FROM steps WHERE bit < 8
), bytes AS (
    SELECT list(value ORDER BY i) AS crc_of FROM steps WHERE bit = 8
), seeds AS (
    SELECT id, {_mixed_sql("CASE WHEN id < 0 THEN (id::HUGEINT + 18446744073709551616)::UBIGINT ELSE id::UBIGINT END")} AS state
    FROM (SELECT DISTINCT coalesce(doc_id, 0) AS id FROM documents)
), {_jump_sql(SHARDS)}, {_jump_sql(SHARDS + 1)},
measured AS (
    SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
        xor(list_reduce(
            list_prepend(4294967295, [('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')]),
            lambda crc, b: xor(crc >> 8, crc_of[xor(crc, b) % 256 + 1])), 4294967295) AS text_crc32
    FROM documents, bytes
)
SELECT m.doc_id, m.size, m.text_crc32, 'key' AS law, CAST(a.shard AS INTEGER) AS shard,
    row_number() OVER (PARTITION BY a.shard ORDER BY m.doc_id NULLS FIRST, m.size, m.text_crc32) - 1 AS slot,
    CAST(g.shard AS INTEGER) AS grown_shard
FROM measured m JOIN at{SHARDS} a ON a.id = coalesce(m.doc_id, 0) JOIN at{SHARDS + 1} g ON g.id = a.id
"""
