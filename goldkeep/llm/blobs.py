"""Arrow tables as compressed values of a column, and sizes of the groups they travel in.

Rows that go together, as all super-k-mers of one part of the corpus for one bucket, are sent
as one binary value. That keeps the shuffle small and the work on either side vectorised.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Effort of the compression; what is packed is shuffled and often stored as well.
LEVEL = 3


def pack(table: pa.Table) -> bytes:
    """``table`` as a compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(blob: bytes) -> pa.Table:
    """The table that :func:`pack` was given."""
    with pa.ipc.open_stream(blob) as reader:
        return reader.read_all()


def text_size(docs: DataFrame, text_column: str) -> int:
    """Bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0


def groups_for(size: int, group_size: int) -> int:
    """How many groups of about ``group_size`` bytes ``size`` bytes make."""
    return max(1, -(-size // group_size))


def group_of(groups: int, *columns: Column | str) -> Column:
    """A group number from a hash of ``columns``."""
    return F.pmod(F.xxhash64(*columns), F.lit(groups)).cast("int")


def pack_arrays(**arrays) -> bytes:
    """Number arrays of any lengths as one compressed value.

    The first bytes of all numbers come first, then the second ones and so on, as in Parquet's
    byte-stream-split encoding: bytes that hardly vary then compress to almost nothing.
    """
    columns, kinds = {}, {}
    for name, values in arrays.items():
        values = np.ascontiguousarray(values)
        planes = values.view(np.uint8).reshape(-1, values.itemsize).T.ravel()
        offsets = pa.array([0, len(planes)], pa.int64())
        columns[name] = pa.LargeListArray.from_arrays(offsets, pa.array(planes))
        kinds[name] = values.dtype.str
    return pack(pa.table(columns).replace_schema_metadata(kinds))


def unpack_arrays(blob: bytes) -> dict[str, np.ndarray]:
    """The arrays that :func:`pack_arrays` was given."""
    table = unpack(blob).combine_chunks()
    out = {}
    for name in table.column_names:
        kind = np.dtype(table.schema.metadata[name.encode()].decode())
        planes = table[name].chunk(0).flatten().to_numpy().reshape(kind.itemsize, -1)
        out[name] = np.ascontiguousarray(planes.T).view(kind).ravel()
    return out
