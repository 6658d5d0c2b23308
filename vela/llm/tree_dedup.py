"""Exact deduplication by a tree merge of sorted digest runs.

Every partition sorts its rows' digests into runs.  Runs then meet in binomial
rounds: with fan-in f and f**L nodes, round l exchanges digit l of the node
number for digit l of the digest's place, so a node always holds about one run
and after L rounds it holds one range of digests of the whole table.  Each
merge collapses equal texts to one entry (digest, identifier that stays, rows),
so a text that a third of all rows share costs one entry a run from the first
merge on.  Answers go back the same way: digest to runs, runs to rows.

Runs are sorted by 64 bits of SHA-256; entries are equal only if the other 192
bits and the byte length agree too (the verification; texts never travel).

Defined results: a null text is the empty text.  A null identifier ranks below
every other.  Rows that share text and identifier are told apart by their place
in the table, and exactly one of them stays.  An empty table gives no rows.
Identifiers of any orderable type; other columns only pass through ``carry``.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vela.llm.common import cut

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row in the partition below


def _layout(partitions: int, runs_each: int, fan_in: int) -> tuple[int, int]:
    """(fan-in, rounds) with fan-in**rounds at least the number of runs, and not much above it."""
    runs = max(2, partitions * runs_each)
    rounds = max(1, math.ceil(math.log(runs) / math.log(fan_in) - 1e-9))
    return max(2, math.ceil(runs ** (1 / rounds) - 1e-9)), rounds


def _words(digests: pa.Array) -> np.ndarray:
    if isinstance(digests, pa.ChunkedArray):
        digests = digests.combine_chunks()
    fixed = digests.cast(pa.binary(32))
    raw = np.frombuffer(fixed.buffers()[1], dtype=">u8", count=4 * len(fixed), offset=32 * fixed.offset) if len(fixed) else np.zeros(0)
    return raw.astype(np.uint64).reshape(-1, 4)


def merge_runs(entries: pa.Table, largest: bool) -> pa.Table:
    """Merges sorted runs (concatenated) into one run with one entry per text.

    A stable sort finds the runs and merges them.  Of equal texts the entry
    whose (keep_id, keep_row) is the largest (smallest) stays; rows add up.
    """
    n = entries.num_rows
    if n == 0:
        return entries
    words = _words(entries["digest"])
    length = entries["bytes"].to_numpy()
    order = np.argsort(words[:, 0], kind="stable")
    w, size = words[order], length[order]
    same_key = w[1:, 0] == w[:-1, 0]
    verified = same_key & (w[1:] == w[:-1]).all(axis=1) & (size[1:] == size[:-1])
    if (same_key != verified).any():  # other texts with the same 64 bits
        order = np.lexsort((length, words[:, 3], words[:, 2], words[:, 1], words[:, 0]))
        w, size = words[order], length[order]
        verified = (w[1:] == w[:-1]).all(axis=1) & (size[1:] == size[:-1])
    starts = np.flatnonzero(np.concatenate(([True], ~verified)))
    rank = pc.rank(entries["keep_id"], sort_keys="ascending", null_placement="at_start" if largest else "at_end", tiebreaker="dense")
    by_id = np.lexsort((entries["keep_row"].to_numpy(), np.asarray(rank)))
    place = np.empty(n, dtype=np.int64)
    place[by_id] = np.arange(n)
    choose = np.maximum if largest else np.minimum
    best = by_id[choose.reduceat(place[order], starts)]
    rows = np.add.reduceat(entries["rows"].to_numpy()[order], starts)
    out = entries.take(pa.array(best))
    return out.set_column(out.schema.get_field_index("rows"), "rows", pa.array(rows))


def _routed(run: pa.Table, at: np.ndarray, digit: int, fan_in: int, rounds: int) -> pa.Table:
    """The entries with their next node: digit ``digit`` of ``at`` gives way to that of the digest's place."""
    place = (_words(run["digest"])[:, 0] >> np.uint64(32)) * np.uint64(fan_in ** rounds) >> np.uint64(32)
    unit = fan_in ** digit
    old, new = at // unit % fan_in, place.astype(np.int64) // unit % fan_in
    node = pa.array(at + (new - old) * unit, type=pa.int64())
    return run.set_column(0, "node", node)


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", largest: bool = True, normal: Callable[[Column], Column] | None = None,
                carry: tuple[str, ...] = (), fan_in: int = 16, run_rows: int = 1_000_000) -> DataFrame:
    """Which row of each group of equal texts stays.

    Returns per row of ``docs``: id, keep_id (identifier of the row that stays),
    group_size, kept, digest (SHA-256, 32 bytes) and, with ``carry``, those
    columns in a struct ``rest``.  ``normal`` is applied to texts before they are
    compared (none: texts must be identical); ``largest`` tells whether the
    largest or the smallest identifier stays.  ``run_rows`` bounds a sorted run,
    ``fan_in`` the runs merged at once.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    text = normal(text) if normal else text
    rest = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("rest")] if carry else []
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), F.octet_length(text).cast("long").alias("bytes"),
                       F.monotonically_increasing_id().alias("row"), *rest)
    rows = cut(rows)
    inner = f"(row & {(1 << _ROW_BITS) - 1}L)"
    shape = rows.agg(F.max(F.shiftright("row", _ROW_BITS)), F.max(F.expr(inner))).first()
    partitions, runs_each = int(shape[0] or 0) + 1, int(shape[1] or 0) // run_rows + 1
    fan, rounds = _layout(partitions, runs_each, fan_in)
    rows = rows.withColumn("run", F.expr(f"({inner} div {run_rows}L) * {partitions}L + shiftright(row, {_ROW_BITS})"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"node long, digest binary, bytes long, keep_id {kind}, keep_row long, rows long"

    def first_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def release() -> Iterator[pa.RecordBatch]:
            if held:
                run = merge_runs(pa.concat_tables(held), largest)
                held.clear()
                yield from _routed(run, run["node"].to_numpy(), 0, fan, rounds).to_batches(max_chunksize=100_000)

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = pa.table({"node": t["run"], "digest": t["digest"], "bytes": t["bytes"], "keep_id": t["id"], "keep_row": t["row"], "rows": pa.array(np.ones(t.num_rows, dtype=np.int64))})
            at = t["node"].to_numpy()
            for lo, hi in _same(at):
                if held and held[-1]["node"][0].as_py() != int(at[lo]):
                    yield from release()
                held.append(t.slice(lo, hi - lo))
        yield from release()

    runs = rows.select("run", "digest", "bytes", "id", "row").mapInArrow(first_runs, schema)
    for level in range(1, rounds + 1):
        runs = runs.groupBy("node").applyInArrow(_merger(level, fan, rounds, largest), schema)
    found = runs.where("rows > 1").select("digest", "bytes", "keep_id", "keep_row", F.col("rows").alias("group_size"))
    asked = rows.groupBy("run", "digest", "bytes").agg(F.count(F.lit(1)).alias("here"))
    answers = asked.join(found, ["digest", "bytes"]).select("run", "digest", "bytes", "keep_id", "keep_row", "group_size")
    held = rows.join(answers, ["run", "digest", "bytes"], "left")
    alone = F.col("keep_row").isNull()
    return held.select("id", F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                       (alone | (F.col("keep_row") == F.col("row"))).alias("kept"), "digest", *(["rest"] if carry else []))


def _same(values: np.ndarray) -> list[tuple[int, int]]:
    """Spans of equal neighbouring values."""
    cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return list(zip(cuts[:-1], cuts[1:]))


def _merger(level: int, fan: int, rounds: int, largest: bool):
    def merge(entries: pa.Table) -> pa.Table:
        run = merge_runs(entries, largest)
        return run if level == rounds else _routed(run, run["node"].to_numpy(), level, fan, rounds)
    return merge
