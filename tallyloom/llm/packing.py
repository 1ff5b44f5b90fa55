"""Best-fit packing of documents into sequences by minimum bin slack.

Only the lengths of the pieces matter to the packing, and there are at most `capacity` of them. So Spark counts the
pieces of each length, and the plan is made on that histogram: the largest length left opens a bin, a bitset subset-sum
over the lengths left finds the fullest combination for the rest of it, and the combination is removed as often as the
counts allow. A plan has few combinations, whatever the number of documents. Spark then ranks the pieces of each
length, and a piece's rank says which bin it is in and where.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.tables import checkpointed, columns_of, ordered, whole
from tallyloom.llm.tokens import tokenizer

_ROWS = 64
#: Pieces of one length that are ranked by one task.
_RANKED = 20_000


def token_pieces(
    docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, piece, start, length, crc): every document's ids and `end_id`, cut after each `capacity` ids."""
    rows = columns_of(docs, id=id_col, text=text_col).select("id", whole("text").alias("text"))
    id_type = pa.int64() if dict(rows.dtypes)["id"] == "bigint" else None
    end = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                ids, out = part.column(0).to_pylist(), []
                for key, data in zip(ids, encoder.encode(part.column(1).to_pylist())):
                    data += end
                    for k, a in enumerate(range(0, len(data), step)):
                        own = data[a : a + step]
                        out.append((key, k, a // 4, len(own) // 4, zlib.crc32(own)))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], id_type or part.schema.field(0).type), pa.array(cols[1], pa.int32()),
                     *[pa.array(c, pa.int64()) for c in cols[2:]]], ["id", "piece", "start", "length", "crc"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"id {kind}, piece int, start long, length long, crc long")


def fullest(space: int, left: dict[int, int]) -> dict[int, int]:
    """How many of each length fill `space` best: a subset-sum over bits, longer lengths first."""
    reach, steps = 1, []
    mask = (1 << space + 1) - 1
    for length in sorted((x for x in left if x <= space), reverse=True):
        many = min(left[length], space // length)
        take = 1
        while many > 0:
            take = min(take, many)
            new = (reach | reach << length * take) & mask
            if new != reach:
                steps.append((length, take, reach))
                reach = new
            many -= take
            take *= 2
        if reach >> space & 1:
            break
    at, found = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            found[length] = found.get(length, 0) + take
    return found


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: pieces in one bin}) for all pieces; each bin is the fullest that holds its longest piece."""
    left, out = {k: n for k, n in counts.items() if n}, []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        own = fullest(capacity - longest, {k: n for k, n in rest.items() if n})
        own[longest] = own.get(longest, 0) + 1
        times = min(left[k] // n for k, n in own.items())
        for k, n in own.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        out.append((times, own))
    return out


def places(bins: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first rank, pieces in a bin, first bin, offset in it), ordered by length and rank."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for times, own in bins:
        offset = 0
        for length, n in sorted(own.items(), reverse=True):
            rows.append((length, used.get(length, 0), n, first, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        first += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """With `rank`, from 0 within each length. A length's pieces are dealt into buckets, so none is ranked by one task."""
    buckets = max(1, -(-total // _RANKED))
    dealt = pieces.withColumn("bucket", F.pmod(ordered("id", "piece"), F.lit(buckets)))
    sums = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "bucket").orderBy("id", "piece")
    return dealt.withColumn("own", F.row_number().over(own) - 1).join(sums, ["length", "bucket"]).select(
        *pieces.columns, (F.col("own") + F.col("before")).alias("rank")
    )


def placed(pieces: DataFrame, rows: np.ndarray) -> DataFrame:
    """With sequence_id and offset, looked up by length and rank in the plan's rows."""
    if not len(rows):
        return pieces.withColumn("sequence_id", F.col("rank")).withColumn("offset", F.lit(0).cast("long")).drop("rank")
    keys = (rows[:, 0] << 48) + rows[:, 1]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = rows[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
            past = rank - at[:, 1]
            cols = [batch.column(n) for n in kept]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(at[:, 3] + past // at[:, 2]), pa.array(at[:, 4] + past % at[:, 2] * length)],
                [*kept, "sequence_id", "offset"],
            )

    kept = [c for c in pieces.columns if c != "rank"]
    return pieces.mapInArrow(look, pieces.select(kept).schema.add("sequence_id", "long").add("offset", "long"))


def pack(
    docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Every piece of every document with its sequence: (id, piece, start, length, ids_crc32, sequence_id, offset).

    A NULL or empty text is the end id alone. Only documents longer than `capacity` are cut. Sequences are filled
    without gaps from offset 0. Ids may be NULL or repeat: each row is a document of its own. An empty table gives no
    rows; further columns are ignored.
    """
    pieces = checkpointed(token_pieces(docs, path, capacity, end_id, id_col, text_col))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    done = placed(ranked(pieces, sum(counts.values())), places(plan(counts, capacity)))
    return done.select(
        F.col("id").alias(id_col), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset"
    )
