"""Column-wise parsing and writing of the binary heartbeat message.

All messages of an Arrow batch advance together: each step reads one field of
every message that has bytes left, so the work per batch is a few array
operations per field instead of a Python loop per message. A message that
uses anything but the declared fields in their declared form (unknown field,
other wire type, truncated or over-long value, text that is not UTF-8) is
only marked; the caller gives it to the message runtime, which decides.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from pulseline.schemas import WIRE_FIELDS

# travels by value with the codec, see there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values — wire type of each scalar kind.
_WIRE_TYPE = {"string": 2, "int64": 0, "double": 1, "bool": 0}
_TAGS = [number << 3 | _WIRE_TYPE[kind] for _, number, kind in WIRE_FIELDS]
_KINDS = [kind for _, _, kind in WIRE_FIELDS]


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary or string array, padded by 8, and its n+1 offsets (null = empty)."""
    values = values.fill_null(b"" if pa.types.is_binary(values.type) else "") if values.null_count else values
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int32)[values.offset:values.offset + len(values) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.concatenate([raw, np.zeros(16, np.uint8)]), offsets - offsets[0]


def _varints(raw: np.ndarray, at: np.ndarray, end: np.ndarray, most: int):
    """Values, next positions and failure flags of the varints at ``at``."""
    value, sound = np.zeros(len(at), np.uint64), np.zeros(len(at), bool)
    at, open_ = at.copy(), np.arange(len(at))
    for k in range(most):
        open_ = open_[at[open_] < end[open_]]
        byte = raw[at[open_]]
        value[open_] |= (byte & 0x7F).astype(np.uint64) << np.uint64(7 * k)
        at[open_] += 1
        sound[open_[byte < 0x80]] = True
        open_ = open_[byte >= 0x80]
        if not len(open_):
            break
    return value, at, ~sound


def _gather(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices end to end and their n+1 offsets."""
    ends = np.cumsum(size)
    offsets = np.concatenate([[0], ends])
    index = np.arange(int(offsets[-1])) + np.repeat(start - (ends - size), size)
    return raw[index], offsets


def parse(payloads: pa.Array) -> tuple[list[pa.Array], np.ndarray]:
    """One array per declared field (defaults where absent), and the rows left to the runtime."""
    raw, offsets = _bytes_of(payloads)
    n = len(payloads)
    at, end = offsets[:-1].copy(), offsets[1:]
    odd = np.zeros(n, bool)
    field_of = np.full(256, -1)
    field_of[_TAGS] = np.arange(len(_TAGS))
    words = np.ndarray(len(raw) - 7, "<u8", raw, 0, (1,))
    numbers = {j: np.zeros(n, np.uint64) for j, kind in enumerate(_KINDS) if kind != "string"}
    starts = {j: np.zeros(n, np.int64) for j, kind in enumerate(_KINDS) if kind == "string"}
    sizes = {j: np.zeros(n, np.int64) for j in starts}
    rows = np.flatnonzero(at < end)
    while len(rows):
        field = field_of[raw[at[rows]]]
        odd[rows[field < 0]] = True
        for j in np.unique(field[field >= 0]).tolist():
            mine = rows[field == j]
            here = at[mine] + 1
            if _KINDS[j] == "double":
                bad = here + 8 > end[mine]
                numbers[j][mine] = words[np.where(bad, 0, here)]
                at[mine] = here + 8
            elif _KINDS[j] == "string":
                size, here, bad = _varints(raw, here, end[mine], 5)
                size = np.where(bad, 0, size).astype(np.int64)
                bad |= here + size > end[mine]
                starts[j][mine], sizes[j][mine] = here, np.where(bad, 0, size)
                at[mine] = here + size
            else:
                numbers[j][mine], at[mine], bad = _varints(raw, here, end[mine], 10)
            odd[mine[bad]] = True
        rows = rows[~odd[rows]]
        rows = rows[at[rows] < end[rows]]
    out: list[pa.Array] = []
    for j, kind in enumerate(_KINDS):
        if kind == "string":
            size = np.where(odd, 0, sizes[j])
            data, cuts = _gather(raw, starts[j], size)
            high = np.concatenate([[0], np.cumsum(data >= 0x80)])[cuts]
            for i in np.flatnonzero(np.diff(high)).tolist():
                try:
                    data[cuts[i]:cuts[i + 1]].tobytes().decode()
                except UnicodeDecodeError:
                    odd[i] = True
            if odd.any():  # their bytes must not reach a text column
                data, cuts = _gather(raw, starts[j], np.where(odd, 0, sizes[j]))
            out.append(pa.StringArray.from_buffers(n, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)))
        elif kind == "double":
            out.append(pa.array(numbers[j].view(np.float64)))
        elif kind == "bool":
            out.append(pa.array(numbers[j] != 0))
        else:
            out.append(pa.array(numbers[j].view(np.int64)))
    return out, odd


def _varint_size(value: np.ndarray) -> np.ndarray:
    size = np.ones(len(value), np.int64)
    for k in range(1, 10):
        size += value >= np.uint64(1 << (7 * k))
    return size


def _put_varints(out: np.ndarray, at: np.ndarray, value: np.ndarray, size: np.ndarray) -> None:
    for k in range(int(size.max(initial=0))):
        some = np.flatnonzero(size > k)
        byte = ((value[some] >> np.uint64(7 * k)) & np.uint64(0x7F)).astype(np.uint8)
        out[at[some] + k] = byte | np.where(size[some] > k + 1, 0x80, 0).astype(np.uint8)


def write(columns: list[pa.Array]) -> pa.Array:
    """The message of every row; a null value is the default, defaults are left out."""
    n = len(columns[0])
    width = np.zeros((len(columns), n), np.int64)
    held = []
    for j, (kind, column) in enumerate(zip(_KINDS, columns)):
        if kind == "string":
            data, cuts = _bytes_of(column)
            size = np.diff(cuts)
            head = _varint_size(size.astype(np.uint64))
            width[j] = np.where(size > 0, 1 + head + size, 0)
            held.append((data, cuts, size, head))
        else:
            if kind == "double":
                bits = column.fill_null(0.0).to_numpy(zero_copy_only=False).astype(np.float64).view(np.uint64)
                size = np.full(n, 8)
            else:
                plain = column.fill_null(False if kind == "bool" else 0).to_numpy(zero_copy_only=False)
                bits = plain.astype(np.int64).view(np.uint64)
                size = _varint_size(bits)
            width[j] = np.where(bits != 0, 1 + size, 0)
            held.append((bits, size))
    ends = np.cumsum(width.sum(0))
    place = (ends - width.sum(0)) + np.cumsum(width, axis=0) - width  # first byte of every field
    out = np.zeros(int(ends[-1]) if n else 0, np.uint8)
    for j, kind in enumerate(_KINDS):
        rows = np.flatnonzero(width[j])
        at = place[j][rows]
        out[at] = _TAGS[j]
        if kind == "string":
            data, cuts, size, head = held[j]
            _put_varints(out, at + 1, size[rows].astype(np.uint64), head[rows])
            to = at + 1 + head[rows]
            text, ends_of = _gather(data, cuts[:-1][rows], size[rows])
            out[np.arange(len(text)) + np.repeat(to - ends_of[:-1], size[rows])] = text
        elif kind == "double":
            for k in range(8):
                out[at + 1 + k] = (held[j][0][rows] >> np.uint64(8 * k)).astype(np.uint8)
        else:
            _put_varints(out, at + 1, held[j][0][rows], held[j][1][rows])
    cuts = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(cuts), pa.py_buffer(out)])
