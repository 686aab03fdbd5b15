"""Fill-in-the-middle training texts, by a pipeline of ``pyarrow.compute`` steps inside each task.

Each text is cut twice, at places drawn from a hash of its id, into a prefix, a middle and a suffix,
and put together anew with a marker before each piece: prefix, suffix, middle (``psm``) or suffix,
prefix, middle (``spm``). Some texts stay as they are (``plain``): a share of all, empty ones, and
those that hold a marker, so that every output can be taken apart again.

The pipeline splits the texts of a batch into lists of units (code points), flattens the lists with
the index of each unit's text, numbers the units within their text, filters them by the role their
number gives them, rebuilds a list of each role for each text, and joins the pieces.

A batch is cut so that its units fit in memory; a text longer than that goes alone. A text's result
follows from its id and itself, so neither order nor repetition of rows matters.

Odd rows: a null text is empty; an empty text is plain. A null id is drawn as the empty id. Repeated
rows have equal results. Columns other than ``doc_id`` and ``text`` are left behind.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .inputs import texts

#: Bytes of text whose units are handled at a time: some 40 times as many bytes of memory.
SLICE = 1_000_000

PLAIN, PSM, SPM = "plain", "psm", "spm"
_OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Markers:
    """What stands before each piece. No marker may begin with the end of another."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        names = (self.prefix, self.suffix, self.middle)
        for name in names:
            ends = [name[k:] for k in range(1 if name else 0, len(name) or 1)]
            if any(not end or other.startswith(end) for end in ends for other in names) or names.count(name) > 1:
                raise ValueError(f"marker {name!r} could be read at the wrong place")


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four numbers below 2^32 that follow from the id: the first 8-digit groups of a hash."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digits, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    seed: int = 1,
    plain_percent: int = 10,
    spm_percent: int = 20,
    markers: Markers = Markers(),
) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output, one row for each row.

    ``plain_percent`` of the texts stay plain, ``spm_percent`` of the others have the suffix first.
    """
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    form = (
        F.when(h3 % 100 >= 100 - plain_percent, PLAIN).when(h4 % 100 < spm_percent, SPM).otherwise(PSM)
    )
    drawn = texts(docs).select("doc_id", "text", h1.alias("h1"), h2.alias("h2"), form.alias("form"))

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            yield _transformed(batch, markers)

    return drawn.mapInArrow(transform, _OUT)


def restored(output: Column, form: Column, markers: Markers = Markers()) -> Column:
    """The text an output was made of."""

    def between(start: str, end: str | None) -> Column:
        rest = F.substring_index(output, start, -1)
        return rest if end is None else F.substring_index(rest, end, 1)

    prefix_first = F.concat(
        between(markers.prefix, markers.suffix),
        between(markers.middle, None),
        between(markers.suffix, markers.middle),
    )
    suffix_first = F.concat(
        between(markers.prefix, markers.middle),
        between(markers.middle, None),
        between(markers.suffix, markers.prefix),
    )
    return F.when(form == PSM, prefix_first).when(form == SPM, suffix_first).otherwise(output)


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts have some ``SLICE`` bytes, a longer text being alone."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        portions = np.cumsum(sizes, dtype=np.int64) // SLICE
        cuts = [0, *(np.flatnonzero(np.diff(portions)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if start < end:
                yield batch.slice(start, end - start)


def _units(text: pa.Array) -> pa.ListArray:
    """The code points of each text: the bytes from one leading byte to the next."""
    text = pa.concat_arrays([text])  # offsets from 0
    sizes = pc.binary_length(text)
    body = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(text)], pa.int32()), text), "")
    octets = pa.Array.from_buffers(pa.uint8(), pc.sum(sizes).as_py() or 0, [None, body.buffers()[2]])
    leading = pc.not_equal(pc.bit_wise_and(octets, pa.scalar(0xC0, pa.uint8())), pa.scalar(0x80, pa.uint8()))
    starts = pc.indices_nonzero(leading).cast(pa.int32())
    offsets = pa.concat_arrays([starts, pa.array([len(octets)], pa.int32())])
    units = pa.Array.from_buffers(pa.string(), len(starts), [None, offsets.buffers()[1], body.buffers()[2]])
    return pa.ListArray.from_arrays(_offsets(pc.utf8_length(text)), units)


def _offsets(sizes: pa.Array) -> pa.Array:
    return pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes.cast(pa.int32()))])


def _transformed(batch: pa.RecordBatch, markers: Markers) -> pa.RecordBatch:
    text = batch.column("text")
    lists = _units(text)
    n = pc.list_value_length(lists).cast(pa.int64())
    places = pc.add(n, 1)
    cuts = [_remainder(batch.column(name), places) for name in ("h1", "h2")]
    low, high = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)

    units, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    first = lists.offsets.slice(0, len(lists)).cast(pa.int64())
    ordinals = pc.subtract(pa.array(np.arange(len(units), dtype=np.int64)), first.take(parents))
    after_low = pc.greater_equal(ordinals, low.take(parents))
    after_high = pc.greater_equal(ordinals, high.take(parents))
    roles = (
        (pc.invert(after_low), low),
        (pc.and_(after_low, pc.invert(after_high)), pc.subtract(high, low)),
        (after_high, pc.subtract(n, high)),
    )
    prefix, middle, suffix = (
        pc.binary_join(pa.ListArray.from_arrays(_offsets(size), pc.filter(units, mask)), "")
        for mask, size in roles
    )

    marked = [pc.match_substring(text, name) for name in (markers.prefix, markers.suffix, markers.middle)]
    bare = pc.or_(pc.equal(n, 0), pc.or_(marked[0], pc.or_(marked[1], marked[2])))
    form = pc.if_else(bare, PLAIN, batch.column("form"))
    p, s, m = (pa.scalar(name) for name in (markers.prefix, markers.suffix, markers.middle))
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, "")
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, "")
    plain = pc.equal(form, PLAIN)
    output = pc.if_else(plain, text, pc.if_else(pc.equal(form, SPM), spm, psm))
    none = pa.scalar(None, pa.int64())
    columns = {
        "doc_id": batch.column("doc_id"),
        "n": n,
        "form": form,
        "prefix_chars": pc.if_else(plain, none, low),
        "middle_chars": pc.if_else(plain, none, pc.subtract(high, low)),
        "output": output,
    }
    return pa.RecordBatch.from_pydict(columns)


def _remainder(number: pa.Array, divisor: pa.Array) -> pa.Array:
    return pc.subtract(number, pc.multiply(pc.divide(number, divisor), divisor))
