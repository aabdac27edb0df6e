"""Fill-in-the-middle: each text is cut into prefix, middle and suffix of code points and rearranged with sentinels.

The cut points and the form come from a hash of the document id, so a rerun on any cluster gives the same rows.
Spark computes the hash numbers, the lengths and the form per row (JVM expressions); the cutting runs as a
pyarrow.compute pipeline over each Arrow batch: the texts are split into list arrays of code points (zero copy over
the UTF-8 buffer), the lists are flattened with their parent indices, each unit gets its ordinal in its text and a
role (prefix, middle, suffix), the units are filtered by role, rebuilt into one list per text and joined by
``binary_join``. Batches are cut into slices of at most ``SLICE_BYTES`` of text, so a task's memory is bounded by
that and by its longest single text, never by a group.

Cases: a null text is an empty one; an empty text, or one that holds a sentinel, is ``plain`` (its output is the text,
lengths null); a null id hashes as ``1:`` alone; repeated rows give repeated, equal rows; an empty table an empty one.
Input columns named like the ``fim_*`` outputs are replaced by them; all other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: The sentinels of the three pieces.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE_BYTES = 4 << 20
OUTPUTS = ("fim_form", "fim_lo", "fim_hi", "fim_output")
EMPTY = pa.scalar("", pa.large_string())


def hash_part(digest: Column, nth: int) -> Column:
    """The nth (from 1) group of eight hex digits of a digest as an unsigned number."""
    return F.conv(F.substring(digest, 8 * nth - 7, 8), 16, 10).cast("long")


def plan_cuts(docs: DataFrame, id_col: str, text_col: str, seed: int, fim_percent: int, spm_percent: int) -> DataFrame:
    """Adds ``fim_lo``, ``fim_hi`` (code points before the middle and after it) and ``fim_form``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    n = F.char_length(text).cast("long")
    a, b = (F.pmod(hash_part(digest, i), n + 1) for i in (1, 2))
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    form = (
        F.when((n == 0) | marked | (F.pmod(hash_part(digest, 3), F.lit(100)) >= fim_percent), F.lit("plain"))
        .when(F.pmod(hash_part(digest, 4), F.lit(100)) < spm_percent, F.lit("spm"))
        .otherwise(F.lit("psm"))
    )
    kept = [c for c in docs.columns if c not in OUTPUTS]
    return docs.select(*kept, F.least(a, b).alias("fim_lo"), F.greatest(a, b).alias("fim_hi"), form.alias("fim_form"))


def code_points(texts: pa.Array) -> pa.LargeListArray:
    """Each text as a list of its code points, sharing the UTF-8 buffer of the texts; null texts are empty lists."""
    texts = pc.fill_null(texts.cast(pa.large_string()), EMPTY)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first, last = int(bounds[0]), int(bounds[-1])
    starts = first + np.flatnonzero((raw[first:last] & 0xC0) != 0x80)
    unit_bounds = np.append(starts, last).astype(np.int64)
    units = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(unit_bounds), data)
    list_bounds = np.searchsorted(starts, bounds).astype(np.int64)
    return pa.LargeListArray.from_arrays(pa.array(list_bounds), units)


def pieces(lists: pa.LargeListArray, lo: np.ndarray, hi: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of every text: units with ordinal below ``lo``, below ``hi``, and the rest."""
    flat = lists.flatten()
    parent = np.asarray(pc.list_parent_indices(lists), np.int64)
    starts = np.asarray(lists.offsets, np.int64)
    ordinal = np.arange(len(flat), dtype=np.int64) - (starts[parent] - starts[0])
    role = (ordinal >= lo[parent]).astype(np.int8) + (ordinal >= hi[parent])
    out = []
    for r in range(3):
        keep = role == r
        counts = np.bincount(parent[keep], minlength=len(lists))
        bounds = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
        rebuilt = pa.LargeListArray.from_arrays(pa.array(bounds), flat.filter(pa.array(keep)))
        out.append(pc.binary_join(rebuilt, EMPTY))
    return out


def arrange(batch: pa.RecordBatch, text_col: str) -> pa.RecordBatch:
    texts = batch.column(text_col)
    lo = np.asarray(batch.column("fim_lo"), np.int64)
    hi = np.asarray(batch.column("fim_hi"), np.int64)
    form = batch.column("fim_form")
    prefix, middle, suffix = pieces(code_points(texts), lo, hi)
    p, s, m = (pa.scalar(tag, pa.large_string()) for tag in (PREFIX, SUFFIX, MIDDLE))
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, EMPTY)
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, EMPTY)
    whole = pc.fill_null(texts.cast(pa.large_string()), EMPTY)
    output = pc.if_else(pc.equal(form, "plain"), whole, pc.if_else(pc.equal(form, "spm"), spm, psm))
    return batch.append_column("fim_output", output.cast(pa.string()))


def slices(batch: pa.RecordBatch, text_col: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of the batch holding at most ``limit`` bytes of text, or one text if it is longer."""
    sizes = np.nan_to_num(np.asarray(pc.binary_length(batch.column(text_col)), np.float64)).astype(np.int64)
    at = 0
    while at < batch.num_rows:
        ends = np.searchsorted(np.cumsum(sizes[at:]), limit, side="right")
        step = max(1, int(ends))
        yield batch.slice(at, step)
        at += step


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, fim_percent: int = 90,
    spm_percent: int = 20,
) -> DataFrame:
    """Adds ``fim_form`` (plain, psm or spm), ``fim_lo``, ``fim_hi`` and ``fim_output`` to every row.

    The digest is sha256 of ``<seed>:<id>``; its first two groups of eight hex digits modulo n + 1 give the cut
    points, the third decides plain (at least ``fim_percent`` modulo 100), the fourth spm (below ``spm_percent``).
    """
    planned = plan_cuts(docs, id_col, text_col, seed, fim_percent, spm_percent)
    schema = StructType([*planned.schema.fields, StructField("fim_output", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                yield arrange(part, text_col)

    return planned.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text rebuilt from an output and its form (the inverse of the rearrangement)."""
    parts = F.split(output, "<P>|<S>|<M>", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "plain", output).when(form == "spm", spm).otherwise(psm)
