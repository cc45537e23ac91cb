"""Arrow batch helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Bytes of text worked on at a time inside a task, so that memory follows the longest text.
BATCH_BYTES = 4 << 20
# White space as the word pattern [^\x20\x09-\x0D]+ has it; bytes.split() cuts at just these.
SPACES = " \t\n\x0b\x0c\r"


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def raw(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in column(batch, name).cast(pa.large_binary()).to_pylist()]


def pieces(batch: pa.RecordBatch, name: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch where its texts pass ``limit`` bytes; a longer text stays whole."""
    if not batch.num_rows:
        return
    # Measured in Arrow: the texts of the whole batch need not be objects at once.
    lengths = pc.binary_length(column(batch, name)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    start = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    yield batch.slice(start)


def text_parts(batch: pa.RecordBatch, name: str = "text", limit: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """As ``pieces``, with the texts of each part as strings (null: empty), measured in
    Arrow and taken out once."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.binary_length(column(batch, name)).fill_null(0).to_numpy().astype(np.int64))
    start = 0
    while start < len(ends):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        part = batch.slice(start, stop - start)
        yield part, [t or "" for t in column(part, name).to_pylist()]
        start = stop


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str, text: str = "text",
                limit: int = BATCH_BYTES) -> DataFrame:
    """``mapInArrow`` over batches of at most ``limit`` bytes, or one text; ``fn`` returns columns by name."""
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for part in pieces(batch, text, limit):
                yield record(fn(part), out)

    return df.mapInArrow(run, schema)


def record(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c.cast(f.type) if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type, from_pandas=False)
         for f in schema], schema=schema)


def split_words(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Codes of all words of the texts in order, the word of each code, words per text."""
    words = [t.split() for t in texts]
    flat = np.empty(sum(map(len, words)), object)
    flat[:] = [w for ws in words for w in ws]
    codes, vocabulary = pd.factorize(flat)
    return codes.astype(np.int64), list(vocabulary), np.array([len(w) for w in words], np.int64)


def word_hashes(codes: np.ndarray, vocabulary: list[bytes]) -> np.ndarray:
    """XXH64 of every word, unsigned."""
    return np.array([xxhash.xxh64_intdigest(w) for w in vocabulary], np.uint64)[codes] if len(codes) else np.zeros(0, np.uint64)
